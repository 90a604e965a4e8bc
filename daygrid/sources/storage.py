"""Storage reached from tasks: folder trees, first bytes, seekable archives.

Tasks open paths through Arrow's filesystems (local folders, and hdfs, s3 or gs URIs);
what cannot be listed or opened becomes a row with ``error``, never a gap.
"""

from __future__ import annotations

import os
import re
from typing import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage

# Folders that are no data.
SYSTEM_FOLDERS = ("__pycache__", "$recycle.bin")
_ENTRY = "relative_path string, is_folder boolean, size_bytes long, modification_time timestamp, error string"


def local_path(uri: str) -> str | None:
    """The local path of a plain path or file URI; None for other stores."""
    if re.match(r"^[a-zA-Z][a-zA-Z0-9+.-]*:", uri):
        return re.sub(r"^file:/+", "/", uri) if uri.startswith("file:/") else None
    return uri


def _said(exc: BaseException) -> str:
    return f"{type(exc).__name__}:{exc}"


def open_file(uri: str):
    """A seekable binary file of any store Arrow knows."""
    path = local_path(uri)
    if path is not None:
        return open(path, "rb")
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    return store.open_input_file(path)


def _children(root: str, folder: str) -> Iterator[tuple]:
    """Entries of one folder: (relative path, is folder, bytes, time, error)."""
    here = f"{root}/{folder}" if folder else root
    path = local_path(here)
    if path is None:
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(here)
        for info in store.get_file_info(fs.FileSelector(path)):
            rel = f"{folder}/{info.base_name}" if folder else info.base_name
            yield rel, info.type == fs.FileType.Directory, info.size, info.mtime, None
        return
    with os.scandir(path) as entries:
        for e in entries:
            rel = f"{folder}/{e.name}" if folder else e.name
            try:
                if e.is_dir():
                    if not e.is_symlink():  # links to folders are not followed
                        yield rel, True, None, None, None
                    continue
                stat = e.stat()
            except FileNotFoundError:  # a link to nothing, or gone meanwhile
                continue
            except OSError as exc:
                yield rel, False, None, None, f"stat_error={_said(exc)}"
                continue
            yield rel, False, stat.st_size, pd.Timestamp(stat.st_mtime, unit="s", tz="UTC"), None


def list_tree(spark: SparkSession, root: str, skip: str | None = None) -> DataFrame:
    """SRC1: every file under ``root``: (path, relative_path, file_name, size_bytes,
    modification_time, scan_error).

    The tree is listed level by level, each level's folders spread over tasks and written
    to the shared folder; the rounds are the tree's depth. Names beginning with ``_`` or
    ``.`` are files like others; hidden and system folders and ``skip`` (a folder of
    generated files) are left out. A folder or file that cannot be read is a row
    with ``scan_error`` and no size.
    """
    root = root.rstrip("/") or "/"

    def listed(batches):
        for batch in batches:
            for folder in batch.column("relative_path").to_pylist():
                rows = []
                try:
                    for row in _children(root, folder):
                        rows.append(row)
                        if len(rows) == 10_000:
                            yield _entries(rows)
                            rows = []
                except Exception as exc:  # noqa: BLE001 - reported as a row
                    rows.append((folder, True, None, None, f"list_error={_said(exc)}"))
                if rows:
                    yield _entries(rows)

    def _entries(rows):
        types = (pa.string(), pa.bool_(), pa.int64(), pa.timestamp("us", tz="UTC"), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["relative_path", "is_folder", "size_bytes", "modification_time", "error"])

    name = F.regexp_extract("relative_path", r"([^/]+)$", 1)
    hidden = name.startswith(".") | F.lower(name).isin(*SYSTEM_FOLDERS)
    full = F.concat(F.lit("" if root == "/" else root), F.lit("/"), F.col("relative_path"))
    generated = F.lit(False) if not skip else full == skip.rstrip("/")
    width = spark.sparkContext.defaultParallelism
    level = spark.createDataFrame([("",)], "relative_path string")
    files = []
    while True:
        entries = cut_lineage(level.repartition(width).mapInArrow(listed, _ENTRY))
        files.append(entries.filter("NOT is_folder OR error IS NOT NULL"))
        level = entries.filter("is_folder AND error IS NULL").filter(~hidden & ~generated).select("relative_path")
        if level.isEmpty():
            break
    out = files[0]
    for f in files[1:]:
        out = out.unionByName(f)
    return out.select(full.alias("path"), "relative_path", name.alias("file_name"), "size_bytes", "modification_time", F.col("error").alias("scan_error"))


def first_bytes(files: DataFrame, n_bytes: int) -> DataFrame:
    """(path, head, members, error) of the files named by ``path``: their first ``n_bytes``
    bytes, and of zip archives the member names. A task reads no more than that."""

    def read(batches):
        import zipfile

        for batch in batches:
            for path in batch.column("path").to_pylist():
                head = members = error = None
                try:
                    with open_file(path) as fh:
                        if path.lower().endswith(".zip"):
                            with zipfile.ZipFile(fh) as z:
                                members = z.namelist()
                        else:
                            head = fh.read(n_bytes)
                except Exception as exc:  # noqa: BLE001 - reported as a row
                    error = _said(exc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path]), pa.array([head], pa.binary()), pa.array([members], pa.list_(pa.string())), pa.array([error], pa.string())],
                    names=["path", "head", "members", "error"],
                )

    return files.select("path").mapInArrow(read, "path string, head binary, members array<string>, error string")
