"""Files that tasks write into the shared folder, by any file system that pyarrow knows."""

from __future__ import annotations

from pyarrow import fs


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def make_folder(uri: str) -> None:
    system, path = file_system(uri)
    system.create_dir(path, recursive=True)


def read_bytes(uri: str) -> bytes:
    system, path = file_system(uri)
    with system.open_input_file(path) as f:
        return f.read()


def write_bytes(uri: str, data: bytes) -> None:
    system, path = file_system(uri)
    with system.open_output_stream(path, compression=None) as f:
        f.write(data)
