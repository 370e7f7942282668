"""Files of the shared folder for Python workers, which have no Spark reader."""

from __future__ import annotations

from pyarrow import fs


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def read_bytes(path: str) -> bytes | None:
    """The whole of a small file, None if there is none."""
    store, inner = store_of(path)
    if store.get_file_info(inner).type != fs.FileType.File:
        return None
    with store.open_input_stream(inner) as file:
        return file.read()


def replace_bytes(path: str, content: bytes) -> None:
    """Write a small file beside its place and move it there: readers see the old or the new one."""
    store, inner = store_of(path)
    store.create_dir(inner.rpartition("/")[0], recursive=True)
    with store.open_output_stream(inner + ".next") as file:
        file.write(content)
    store.move(inner + ".next", inner)
