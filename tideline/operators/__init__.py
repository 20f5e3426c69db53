"""Batch operators: audit rows, archive candidates and file moves."""
