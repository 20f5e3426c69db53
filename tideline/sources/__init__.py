"""Readers: landing folders, stored tables and file listings."""
