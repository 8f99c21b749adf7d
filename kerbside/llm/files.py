"""Files in the shared folder, written whole by tasks through pyarrow's file systems.

The folder's address decides the store (file, hdfs, s3, gs ...). A file has a name that no other attempt
uses, so a retried task leaves a stray file but never a torn one; only files named in the returned
manifest are read.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyarrow import fs


def locate(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


@contextmanager
def new_file(folder: str, suffix: str):
    """Yields (path, stream) of a new file in the folder."""
    store, base = locate(folder)
    store.create_dir(base, recursive=True)
    name = f"{uuid.uuid4().hex}{suffix}"
    with store.open_output_stream(f"{base}/{name}", compression=None) as stream:
        yield f"{folder.rstrip('/')}/{name}", stream


def open_file(path: str):
    store, name = locate(path)
    return store.open_input_file(name)
