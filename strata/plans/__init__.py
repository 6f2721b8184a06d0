"""Layers and reports built from the operators."""
