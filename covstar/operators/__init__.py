"""Relational operators of the warehouse, each a lazy DataFrame function."""
