"""Continuous arrival of source files."""
