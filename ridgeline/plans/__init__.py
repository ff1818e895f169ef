"""Declaring factors as nodes of a graph, and lowering the graph to DataFrames or to SQL."""
