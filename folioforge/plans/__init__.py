"""Compositions of operators: the user-facing entry points."""
