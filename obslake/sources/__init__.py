"""Inputs: the given tables, observation views derived from them, CSV landing files."""
