"""Collective-attention analytics as Spark DataFrame transformations."""
