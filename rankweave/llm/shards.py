"""Raw arrays as files in the shared folder: written once per shard by a task, memory-mapped by workers."""

from __future__ import annotations

import os
import shutil
import tempfile
import urllib.parse
import uuid

import numpy as np
import pyarrow.fs as pafs


class Shards:
    """Named arrays below ``root`` (a folder from ``session.scratch_path``).

    A write goes to a name of its own and is then renamed, so a task that runs twice leaves the same file.
    On a store that the operating system cannot map, a reader copies the shard to an unlinked temporary
    file and maps that; the copy is gone with the mapping.
    """

    def __init__(self, root: str):
        self.root = root
        self._open: dict[tuple[str, str], np.ndarray] = {}

    def __getstate__(self):
        return self.root

    def __setstate__(self, root):
        self.__init__(root)

    def _place(self, name: str) -> tuple[pafs.FileSystem, str]:
        if self.root.startswith("file:") or "://" not in self.root:
            return pafs.LocalFileSystem(), os.path.join(urllib.parse.urlparse(self.root).path, name)
        store, path = pafs.FileSystem.from_uri(self.root)
        return store, f"{path}/{name}"

    def write(self, name: str, values: np.ndarray) -> None:
        store, path = self._place(name)
        store.create_dir(os.path.dirname(path), recursive=True)
        own = f"{path}.{uuid.uuid4().hex}"
        with store.open_output_stream(own) as out:
            out.write(np.ascontiguousarray(values).tobytes())
        store.move(own, path)

    def read(self, name: str, dtype) -> np.ndarray:
        """The array as a read-only map; empty where no task had anything to write."""
        key = (name, np.dtype(dtype).str)
        if key not in self._open:
            self._open[key] = self._map(name, dtype)
        return self._open[key]

    def _map(self, name: str, dtype) -> np.ndarray:
        store, path = self._place(name)
        info = store.get_file_info(path)
        if info.type == pafs.FileType.NotFound or not info.size:
            return np.zeros(0, dtype)
        if isinstance(store, pafs.LocalFileSystem):
            return np.memmap(path, dtype, mode="r")
        with tempfile.TemporaryFile() as copy, store.open_input_stream(path) as source:
            shutil.copyfileobj(source, copy)
            copy.flush()
            return np.memmap(copy, dtype, mode="r")
