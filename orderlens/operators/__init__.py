"""Relational building blocks (DataFrame -> DataFrame)."""
