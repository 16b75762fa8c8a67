"""What the Python data sources share: file systems by URI, listings, and files that appear only when a job commits."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import pyarrow.fs as pafs
from pyspark.sql.datasource import WriterCommitMessage


def located(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI or of a plain local path, and the path in it."""
    if "://" in uri or uri.startswith("file:"):
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri


def listed(uri: str, suffix: str) -> list[tuple[str, int]]:
    """Files (path in the file system, bytes) by name; those of a folder whose names begin with _ or . are no data."""
    fs, path = located(uri)
    info = fs.get_file_info(path)
    if info.type == pafs.FileType.File:
        return [(path, info.size)]
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(uri)
    found = fs.get_file_info(pafs.FileSelector(path))
    return sorted((f.path, f.size) for f in found if f.type == pafs.FileType.File and f.base_name.endswith(suffix) and f.base_name[0] not in "_.")


@dataclass
class Written(WriterCommitMessage):
    """A task's files: the folder that it wrote them to, and their names."""

    folder: str
    names: tuple[str, ...]


class Attempt:
    """A folder of one attempt of a task, beside the final files; an attempt that fails leaves nothing that counts."""

    def __init__(self, uri: str):
        self.fs, path = located(uri)
        self.folder = f"{path}/_temporary/{uuid.uuid4().hex}"
        self.fs.create_dir(self.folder, recursive=True)

    def opened(self, name: str):
        return self.fs.open_output_stream(f"{self.folder}/{name}")


def committed(uri: str, messages: list[Written | None]) -> None:
    """Move the files of the attempts that count to their places, and delete all others."""
    fs, path = located(uri)
    seen: set[str] = set()
    for m in messages:
        for name in m.names if m else ():
            if name in seen:
                raise ValueError(f"two tasks wrote {name}: deal rows to tasks by their file")
            seen.add(name)
    fs.create_dir(path, recursive=True)
    for m in messages:
        for name in m.names if m else ():
            fs.move(f"{m.folder}/{name}", f"{path}/{name}")
    cleared(uri)
    with fs.open_output_stream(f"{path}/_SUCCESS"):
        pass


def cleared(uri: str) -> None:
    fs, path = located(uri)
    if fs.get_file_info(f"{path}/_temporary").type == pafs.FileType.Directory:
        fs.delete_dir(f"{path}/_temporary")


def emptied(uri: str) -> None:
    """For a write that overwrites: the folder goes before any task writes."""
    fs, path = located(uri)
    if fs.get_file_info(path).type == pafs.FileType.Directory:
        fs.delete_dir(path)


def vacant(uri: str) -> None:
    fs, path = located(uri)
    if fs.get_file_info(f"{path}/_SUCCESS").type == pafs.FileType.File:
        raise FileExistsError(f"{uri} is written already")
