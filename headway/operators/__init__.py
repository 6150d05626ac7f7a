"""Relational, statistical and model operators: DataFrame in, DataFrame out."""
