"""Files of any store that Arrow opens by address: local and shared folders, HDFS, object stores."""

from __future__ import annotations

import json
import posixpath
import re
from typing import Any

from pyarrow import fs


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or address, and the path in it."""
    if re.match(r"[a-z][a-z0-9+.-]*://", path) and not path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), re.sub(r"^file:/+", "/", path)


def files_in(store: fs.FileSystem, folder: str, deep: bool = True) -> list[fs.FileInfo]:
    """The files below a folder by path, none if it is missing; a single file is itself."""
    info = store.get_file_info(folder)
    if info.type == fs.FileType.File:
        return [info]
    found = store.get_file_info(fs.FileSelector(folder, allow_not_found=True, recursive=deep))
    return sorted((f for f in found if f.type == fs.FileType.File), key=lambda f: f.path)


def put_json(store: fs.FileSystem, path: str, value: Any) -> None:
    """A small file, replaced as a whole."""
    new = f"{posixpath.dirname(path)}/.new-{posixpath.basename(path)}"
    with store.open_output_stream(new) as f:
        f.write(json.dumps(value, indent=1, sort_keys=True).encode())
    store.move(new, path)


def get_json(store: fs.FileSystem, path: str) -> Any:
    """What `put_json` wrote; None if there is no such file."""
    if store.get_file_info(path).type != fs.FileType.File:
        return None
    with store.open_input_stream(path) as f:
        return json.loads(f.read())
