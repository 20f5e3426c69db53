"""Landed-file lifecycle on Spark: load, audit, report and archive folders of CSV files."""
