"""Task-side helper: the first line of each file.

This module is pickled *by value* into tasks, so executors need no copy of the
package on their path; it depends only on the standard library, pandas and
pyarrow.
"""

from __future__ import annotations

import functools
import gzip
import sys

from pyspark import cloudpickle


# Hadoop connector schemes -> the scheme pyarrow's filesystem layer knows.
_ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3", "gcs": "gs"}


def arrow_uri(path: str) -> str:
    scheme, sep, rest = path.partition("://")
    return f"{_ARROW_SCHEMES.get(scheme.lower(), scheme)}{sep}{rest}" if sep else path


def _lines(fh):
    """Lines of a binary stream, however long."""
    held = b""
    while block := fh.read(1 << 16):
        *whole, held = (held + block).split(b"\n")
        yield from whole
    if held:
        yield held


def read_first_line(path: str, encoding: str = "utf-8", comment: str | None = None) -> str | None:
    """First line of a (possibly gzip-compressed) file that is neither blank nor a
    comment; None if there is none."""
    if path.startswith("file:"):
        local = path[5:]
        while local.startswith("//"):
            local = local[1:]
        opener = functools.partial(open, local, "rb")
    else:
        from pyarrow import fs as pafs

        filesystem, inner = pafs.FileSystem.from_uri(arrow_uri(path))
        opener = functools.partial(filesystem.open_input_stream, inner)
    with opener() as fh:
        for raw in _lines(gzip.GzipFile(fileobj=fh) if path.endswith(".gz") else fh):
            line = raw.decode(encoding, errors="replace").lstrip("\ufeff").rstrip("\r")
            if line.strip() and not (comment and line.startswith(comment)):
                return line
    return None


def first_lines(encoding: str = "utf-8", comment: str | None = None):
    """``mapInPandas`` body: (path) batches -> (path, header) batches."""

    def run(batches):
        import pandas as pd

        for pdf in batches:
            yield pd.DataFrame({"path": pdf["path"], "header": [read_first_line(p, encoding, comment) for p in pdf["path"]]})

    return run


cloudpickle.register_pickle_by_value(sys.modules[__name__])
