"""Relational, graph, vector and text operators over DataFrames."""
