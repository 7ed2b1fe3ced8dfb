"""A filesystem of its own scheme, which only its factory opens: vault://name/path is a path below a folder."""

from __future__ import annotations

from pyarrow import fs

FACTORY = "vault:filesystem"


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    root, inner = uri.removeprefix("vault://").split("/~/")
    return fs.SubTreeFileSystem(f"/{root}", fs.LocalFileSystem()), inner
