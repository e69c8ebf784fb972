"""Delivery of a range once: a file per token, there whole or not at all."""

from __future__ import annotations

import uuid

from pyarrow import fs

from sortproof._pickling import ship_by_value


class OnceFiles:
    """Files named by token below ``root``, a folder that every executor reaches.

    For callbacks that get ``(token, rows)``: :meth:`put` writes the token's
    file beside its place and moves it there, so two attempts of one task, even
    at the same time, leave one file; :meth:`has` says whether a token is done.
    """

    def __init__(self, root: str) -> None:
        self.root = root.rstrip("/")

    def _open(self) -> tuple[fs.FileSystem, str]:
        own, path = fs.FileSystem.from_uri(self.root if "://" in self.root or self.root.startswith("file:") else f"file://{self.root}")
        own.create_dir(path, recursive=True)
        return own, path

    def has(self, token: str) -> bool:
        own, path = self._open()
        return own.get_file_info(f"{path}/{token}").type == fs.FileType.File

    def put(self, token: str, data: bytes) -> None:
        own, path = self._open()
        part = f"{path}/.{token}.{uuid.uuid4().hex}"
        with own.open_output_stream(part) as out:
            out.write(data)
        own.move(part, f"{path}/{token}")

    def get(self, token: str) -> bytes:
        own, path = self._open()
        with own.open_input_stream(f"{path}/{token}") as file:
            return file.read()

    def tokens(self) -> list[str]:
        """Tokens that are done."""
        own, path = self._open()
        return sorted(f.base_name for f in own.get_file_info(fs.FileSelector(path)) if not f.base_name.startswith("."))


ship_by_value(__name__)
