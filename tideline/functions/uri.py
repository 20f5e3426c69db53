"""Rewriting of storage addresses, as column expressions that stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The forms of a data-lake address and of the matching blob address.
LAKE_PREFIX = "abfss://{container}@{account}.dfs.core.windows.net/"
LAKE_PATTERN = r"^abfss://([^@/]+)@([^/]+)\.dfs\.core\.windows\.net/"
BLOB_ADDRESS = "https://$2.blob.core.windows.net/$1/"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def container_prefix(container: str, account: str) -> str:
    return LAKE_PREFIX.format(container=container, account=account)


def strip_prefix(uri: Column | str, prefix: str) -> Column:
    """The address without a leading `prefix`; an address that does not start with it is kept.

    The prefix is literal and only the start is looked at, so dots in an account name match dots
    alone and a path that holds the prefix again further on keeps it there.
    """
    uri = _column(uri)
    return F.when(uri.startswith(prefix), F.substr(uri, F.lit(len(prefix) + 1))).otherwise(uri)


def blob_url(uri: Column | str) -> Column:
    """The https blob address of a data-lake address; any other address is kept."""
    return F.regexp_replace(uri, LAKE_PATTERN, BLOB_ADDRESS)


def plain_path(source_file: Column | str) -> Column:
    """The raw path behind a percent-encoded source file, as a file system wants it.

    Local addresses come out with one slash, however they were written. A plus sign is itself in a
    path, but `url_decode` reads it as a space, so it is protected.
    """
    encoded = F.replace(_column(source_file), F.lit("+"), F.lit("%2B"))
    return F.regexp_replace(F.url_decode(encoded), "^file:/+", "file:/")
