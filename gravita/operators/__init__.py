"""Relational and numerical operators: DataFrame in, DataFrame out."""
