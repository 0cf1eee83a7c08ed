"""Blocks of rows as Arrow files in the shared folder, written by tasks and read by tasks.

A block is one file of one record batch. Where the folder is a path of the machine a reader maps the
file into memory, so workers of one machine share it; elsewhere it is read by the file system of
the address (``hdfs``, ``s3``, ``gs``). A file appears under its name when it is whole, and a
repeated task puts the same rows in its place.
"""

from __future__ import annotations

import posixpath
import re
import uuid
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyarrow import fs as files


def _locate(address: str) -> tuple[files.FileSystem, str, bool]:
    if is_mapped(address):
        return files.LocalFileSystem(), unquote(urlsplit(address).path), True
    system, path = files.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", address))
    return system, path, False


def is_mapped(address: str) -> bool:
    """Whether blocks under an address are mapped into memory and not read into it."""
    return urlsplit(address).scheme in ("", "file")


def write_block(address: str, rows: pa.Table) -> None:
    system, path, _ = _locate(address)
    system.create_dir(posixpath.dirname(path), recursive=True)
    draft = f"{path}.{uuid.uuid4().hex}"
    whole = rows.combine_chunks()
    with system.open_output_stream(draft) as out, pa.ipc.new_file(out, whole.schema) as writer:
        writer.write_table(whole)
    system.move(draft, path)


def read_block(address: str) -> pa.Table:
    system, path, local = _locate(address)
    with pa.memory_map(path) if local else system.open_input_file(path) as source:
        return pa.ipc.open_file(source).read_all()
