"""Primitives, post transforms and factor families."""
