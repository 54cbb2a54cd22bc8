"""Shared file systems as seen from Python tasks (pyarrow file systems by URI)."""

from __future__ import annotations

import json
import uuid

from pyarrow import fs

from reelrank.llm.common import ship

MANIFEST = "_manifest.json"

ship(__name__)


def open_fs(path: str) -> tuple[fs.FileSystem, str]:
    """File system and inner path of a URI; a path without scheme is local."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    if "://" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def new_part(path: str, partition: int, suffix: str) -> str:
    """A file name that no other task attempt uses: a retry never meets leftovers."""
    return f"{path.rstrip('/')}/part-{partition:06d}-{uuid.uuid4().hex}{suffix}"


def write_manifest(path: str, entries: list[dict]) -> None:
    system, inner = open_fs(path)
    system.create_dir(inner, recursive=True)
    with system.open_output_stream(f"{inner}/{MANIFEST}") as out:
        out.write(json.dumps(entries).encode())


def read_manifest(path: str) -> list[dict] | None:
    system, inner = open_fs(path)
    if system.get_file_info(f"{inner}/{MANIFEST}").type != fs.FileType.File:
        return None
    with system.open_input_stream(f"{inner}/{MANIFEST}") as src:
        return json.loads(src.read())


def delete_files(paths: list[str]) -> None:
    for p in paths:
        system, inner = open_fs(p)
        if system.get_file_info(inner).type == fs.FileType.File:
            system.delete_file(inner)
