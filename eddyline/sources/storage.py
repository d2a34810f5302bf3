"""Files on any file system that pyarrow knows, for the user-defined source and sink."""

from __future__ import annotations

from pyarrow import fs


def resolve(uri: str) -> tuple[fs.FileSystem, str]:
    """(file system, path) of `file:/x`, `file:///x`, `hdfs://...`, `s3://...` or a plain path. On a cluster name a folder that all executors reach."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def sizes(uri: str, suffix: str) -> dict[str, int]:
    """Bytes of the files with that suffix in a folder, by path; none if the folder does not exist."""
    store, path = resolve(uri)
    found = store.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return {f.path: f.size for f in sorted(found, key=lambda f: f.path) if f.is_file and f.path.endswith(suffix)}
