"""Whole jobs, from landing folder to archive lists."""
