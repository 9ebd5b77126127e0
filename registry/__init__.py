"""Registered queries: each operator over the given tables, with the equivalent SQL."""
