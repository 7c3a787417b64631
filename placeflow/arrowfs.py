"""File systems that tasks open themselves: local or mounted folders, and those that Arrow knows (HDFS, S3, GCS)."""

from __future__ import annotations

import re
from contextlib import suppress

import pyarrow as pa
import pyarrow.fs

_URI = re.compile(r"^([A-Za-z][\w+.-]*):(?://([^/]*))?(/.*)$", re.S)


class Store:
    """The file system of a path, as Hadoop writes it (scheme://host/path, nothing escaped)."""

    def __init__(self, path: str):
        m = _URI.match(path)
        scheme, host = (m[1], m[2] or "") if m else ("file", "")
        self.local = scheme == "file"
        if self.local:
            self.fs, self.before = pyarrow.fs.LocalFileSystem(), ""
        else:
            self.fs, _ = pyarrow.fs.FileSystem.from_uri(f"{scheme}://{host}/")
            self.before = host if scheme in ("s3", "s3a", "gs", "gcs") else ""

    def bare(self, path: str) -> str:
        m = _URI.match(path)
        return self.before + (m[3] if m else path)

    def open(self, path: str):
        return self.fs.open_input_stream(self.bare(path))

    def create(self, path: str):
        bare = self.bare(path)
        self.fs.create_dir(bare.rpartition("/")[0], recursive=True)
        return self.fs.open_output_stream(bare)

    def move(self, path: str, to: str) -> None:
        """Puts a file in the place of another, if there is one."""
        bare = self.bare(to)
        self.fs.create_dir(bare.rpartition("/")[0], recursive=True)
        if not self.local and self.fs.get_file_info(bare).type != pyarrow.fs.FileType.NotFound:
            self.fs.delete_file(bare)
        self.fs.move(self.bare(path), bare)

    def delete_folder(self, path: str) -> None:
        with suppress(FileNotFoundError):
            self.fs.delete_dir(self.bare(path))


def reachable(path: str) -> bool:
    """Whether tasks can open files there themselves."""
    with suppress(pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError, ImportError):
        Store(path)
        return True
    return False
