"""Relational operators of the marts, as functions from DataFrame to DataFrame."""
