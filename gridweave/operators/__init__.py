"""Operators over documents and tables."""
