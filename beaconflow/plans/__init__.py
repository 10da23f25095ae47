"""Catalogue-driven applications built from the operators."""
