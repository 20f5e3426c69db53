"""Column expressions: provenance stamps and storage addresses."""
