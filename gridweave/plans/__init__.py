"""Whole jobs: parse, extract, assemble, report."""
