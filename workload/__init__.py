"""The registered queries: the package run over the given tables, and the SQL they must equal."""
