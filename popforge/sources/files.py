"""Files of any store that executors reach, by URI: local paths, file:, hdfs:, s3:, gs:."""

from __future__ import annotations

import hashlib

from pyarrow import fs


def store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path within it."""
    return fs.FileSystem.from_uri(path)


def read_bytes(path: str) -> bytes:
    at, name = store(path)
    with at.open_input_file(name) as f:
        return f.read()


def put_bytes(path: str, data: bytes) -> None:
    """Writes a file that readers see whole or not at all: under another name first, then moved into place."""
    at, name = store(path)
    at.create_dir(name.rsplit("/", 1)[0], recursive=True)
    with at.open_output_stream(f"{name}.part") as f:
        f.write(data)
    at.move(f"{name}.part", name)


def exists(path: str) -> bool:
    at, name = store(path)
    return at.get_file_info(name).type != fs.FileType.NotFound


def folders(path: str) -> list[str]:
    """Names of the folders in a folder."""
    at, name = store(path)
    return [x.base_name for x in at.get_file_info(fs.FileSelector(name)) if x.type == fs.FileType.Directory]


def remove(path: str) -> None:
    """Deletes a folder with all it has; nothing if there is none."""
    at, name = store(path)
    if at.get_file_info(name).type == fs.FileType.Directory:
        at.delete_dir(name)


def sha256(path: str, chunk: int = 1 << 22) -> str:
    """The hash of a file's bytes, read a chunk at a time."""
    at, name = store(path)
    digest = hashlib.sha256()
    with at.open_input_stream(name) as f:
        while data := f.read(chunk):
            digest.update(data)
    return digest.hexdigest()
