"""Files in the stores that tasks can open: folders that all executors mount, by path or file: URI, and what pyarrow has a
file system for (s3:, gs:, hdfs: and others, with their libraries and settings)."""

from __future__ import annotations

import glob
import os
import re
import uuid
from typing import BinaryIO

import pyarrow.fs as pafs
from pyspark.sql.datasource import DataSourceWriter, WriterCommitMessage

#: Listing a pattern needs its fixed part.
_WILD = re.compile(r"[*?\[]")


def store(path: str) -> tuple[pafs.FileSystem, str]:
    """(file system, path there). A path without a scheme, or with file:, is one of mounted folders."""
    if re.match(r"(?!file:)[a-zA-Z][a-zA-Z0-9+.-]+:", path):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), os.path.abspath(re.sub(r"^/{2,}", "/", path.removeprefix("file:")))


def opened(path: str) -> BinaryIO:
    """The file, to be read from any place on."""
    fs, at = store(path)
    return fs.open_input_file(at)


def listed(path: str, ends: tuple[str, ...]) -> list[tuple[str, int]]:
    """(path, bytes) in order of the files below a folder, or the file, or those of a mounted folder that a pattern names."""
    fs, at = store(path)
    if isinstance(fs, pafs.LocalFileSystem) and _WILD.search(at):
        found = [f for f in glob.glob(at, recursive=True) if os.path.isfile(f)]
        return sorted((f, os.path.getsize(f)) for f in found if f.endswith(ends))
    info = fs.get_file_info(at)
    infos = [info] if info.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(at, recursive=True))
    prefix = "" if isinstance(fs, pafs.LocalFileSystem) else path.removesuffix("/").removesuffix(at.removesuffix("/"))
    return sorted((prefix + i.path, i.size) for i in infos if i.type == pafs.FileType.File and i.path.endswith(ends))


class FolderWriter(DataSourceWriter):
    """Files appear under their names, which may hold folders or be whole paths, when the job commits: a task writes each
    under a name of its own beside it, the driver moves them. What a failed or repeated task has written is removed, by the
    task if it can and else as left over at the next commit of that name."""

    def __init__(self, folder: str):
        self.folder = folder

    def save(self, file: str, content: bytes) -> tuple[str, str]:
        """(where it is for now, where it belongs)."""
        whole = file if re.match(r"/|[a-zA-Z][a-zA-Z0-9+.-]+:", file) else f"{self.folder.rstrip('/')}/{file}"
        fs, at = store(whole)
        home, _, name = at.rpartition("/")
        fs.create_dir(home, recursive=True)
        part = f"{whole.rpartition('/')[0]}/.{name}.{uuid.uuid4().hex}"
        try:
            with fs.open_output_stream(store(part)[1]) as f:
                f.write(content)
        except BaseException:
            _remove(part)
            raise
        return part, whole

    @staticmethod
    def message(files: list[tuple[str, str]]) -> WriterCommitMessage:
        message = WriterCommitMessage()
        message.files = files
        return message

    def commit(self, messages) -> None:
        for m in messages:
            for part, whole in m.files if m else ():
                fs, at = store(whole)
                fs.move(store(part)[1], at)
                home, _, name = at.rpartition("/")
                left = rf"\.{re.escape(name)}\.[0-9a-f]{{32}}"
                for i in fs.get_file_info(pafs.FileSelector(home)):
                    if re.fullmatch(left, i.base_name):
                        fs.delete_file(i.path)

    def abort(self, messages) -> None:
        for m in messages:
            for part, _ in m.files if m else ():
                _remove(part)


def _remove(path: str) -> None:
    fs, at = store(path)
    if fs.get_file_info(at).type == pafs.FileType.File:
        fs.delete_file(at)
