"""Relational operators of a slice refresh, each a composition of built-in DataFrame ops."""
