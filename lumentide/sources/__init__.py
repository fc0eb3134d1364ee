"""Readers of landed files and streams, and table writers."""
