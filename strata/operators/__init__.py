"""Reusable operators. They take frames and column names, never fixed tables."""
