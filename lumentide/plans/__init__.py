"""Composed runs."""
