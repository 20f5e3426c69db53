"""Access to file stores from Spark tasks, for what Spark's readers and writers cannot do."""

from __future__ import annotations

from collections.abc import Callable


def store_finder() -> Callable:
    """A function from an address to its store and the path in it.

    It is made here and not imported in the tasks, so workers need no copy of this package.
    """
    stores: dict = {}

    def store_for(address: str):
        from urllib.parse import urlsplit

        from pyarrow import fs

        parts = urlsplit(address)
        if parts.scheme in ("", "file"):
            local = stores.setdefault("file", fs.LocalFileSystem())
            return local, "/" + address.removeprefix("file:").lstrip("/")
        key = (parts.scheme, parts.netloc)
        if key not in stores:
            scheme = "s3" if parts.scheme in ("s3a", "s3n") else parts.scheme
            store, root = fs.FileSystem.from_uri(f"{scheme}://{parts.netloc}/")
            stores[key] = store, root.rstrip("/")
        store, root = stores[key]
        return store, root + address.split(parts.netloc, 1)[1]

    return store_for
