"""Terrain conditioning operators as Spark DataFrame transformations."""
