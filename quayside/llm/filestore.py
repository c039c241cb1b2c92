"""Files that tasks write to shared storage and commit by renaming.

Paths are URIs that Arrow's filesystems open (``file:``, ``s3:``, ``gs:``, ``hdfs:``, or a plain
path). A task writes ``_temporary/<random>`` and renames it to the final name, which depends on
the partition only: a retried or doubled task replaces a file by an equal one, and a lost one
leaves nothing that a reader sees. Readers go by the manifest, which is written last, also under
a temporary name.
"""

from __future__ import annotations

import json
import uuid
from contextlib import contextmanager

from pyarrow import fs


def _at(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if ":" in uri.split("/")[0] else (fs.LocalFileSystem(), uri)


@contextmanager
def committed(folder: str, name: str):
    """A binary file to write, which gets its name when the block ends without an error."""
    store, root = _at(folder)
    temporary = f"{root}/_temporary/{uuid.uuid4().hex}"
    store.create_dir(f"{root}/_temporary", recursive=True)
    with store.open_output_stream(temporary) as out:
        yield out
    store.move(temporary, f"{root}/{name}")


def read(folder: str, name: str, start: int = 0, size: int | None = None) -> bytes:
    store, root = _at(folder)
    with store.open_input_file(f"{root}/{name}") as f:
        f.seek(start)
        return f.read(size) if size is not None else f.read()


@contextmanager
def opened(folder: str, name: str):
    store, root = _at(folder)
    with store.open_input_file(f"{root}/{name}") as f:
        yield f


def write_manifest(folder: str, rows: list[dict]) -> None:
    """A row per file; the files count as written from now on."""
    with committed(folder, "manifest.json") as out:
        out.write(json.dumps(rows).encode())


def manifest(folder: str) -> list[dict]:
    return json.loads(read(folder, "manifest.json"))
