"""Files that Spark tasks and the driver write and list through pyarrow (paths by URI)."""

from __future__ import annotations

import json
import sys
import uuid

from pyarrow import fs
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def open_fs(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    if "://" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def new_name(suffix: str) -> str:
    """A name that no other task attempt uses."""
    return uuid.uuid4().hex + suffix


def entries(path: str) -> dict[str, list]:
    """The JSON files of a folder by name, in order of their names."""
    system, inner = open_fs(path)
    found = system.get_file_info(fs.FileSelector(inner, allow_not_found=True))
    out = {}
    for info in sorted(found, key=lambda f: f.base_name):
        if info.base_name.endswith(".json"):
            with system.open_input_stream(info.path) as src:
                out[info.base_name] = json.loads(src.read())
    return out


def publish(path: str, name: str, entry: list) -> None:
    """Write a JSON file so that it is there whole or not at all."""
    system, inner = open_fs(path)
    system.create_dir(inner, recursive=True)
    hidden = f"{inner}/.{new_name('')}"
    with system.open_output_stream(hidden) as out:
        out.write(json.dumps(entry).encode())
    system.move(hidden, f"{inner}/{name}")


def delete(path: str, names: list[str]) -> None:
    system, inner = open_fs(path)
    for name in names:
        if system.get_file_info(f"{inner}/{name}").type == fs.FileType.File:
            system.delete_file(f"{inner}/{name}")
