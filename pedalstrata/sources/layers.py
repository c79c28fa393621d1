"""Layer folders with committed versions.

``base/<name>.<format>`` holds one folder per version and, under ``_commits``, one empty file per
committed version, whose name has a number and the version. The version of the highest number
is the layer. Creating an empty file is one step on every file system, where renaming a folder is
a copy on object stores: until it is there readers find the old version, from then on the new
one, and both are complete. Old versions are deleted after that.

A folder or file without ``_commits``, from another writer, is a layer as it is.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import SparkSession

from pedalstrata.errors import DatasetError
from pedalstrata.sources.staging import children, create_empty, is_file, remove

COMMITS = "_commits"


def _committed(spark: SparkSession, layer: str) -> tuple[int, str | None]:
    """Number and version of the last commit."""
    names = children(spark, f"{layer}/{COMMITS}")
    last = max((n for n in names if "-" in n), default=None)
    return (0, None) if last is None else (int(last.split("-")[0]), last.split("-", 1)[1])


def current(spark: SparkSession, layer: str) -> str:
    """The folder to read: of the committed version, or the path itself where there are no versions."""
    _, version = _committed(spark, layer)
    return layer if version is None else f"{layer}/{version}"


def _commit_file(layer: str, number: int, version: str) -> str:
    # Fixed width, so that names sort as numbers do.
    return f"{layer}/{COMMITS}/{number:012d}-{version}"


def _commit(spark: SparkSession, layer: str, number: int, version: str) -> None:
    create_empty(spark, _commit_file(layer, number, version))


def _clean_up(spark: SparkSession, layer: str, number: int, version: str) -> None:
    """Delete what is older: commits, versions, and files from before there were versions."""
    newest = _commit_file(layer, number, version).rsplit("/", 1)[1]
    old = [n for n in children(spark, f"{layer}/{COMMITS}") if n < newest]
    gone = {n.split("-", 1)[1] for n in old}
    for name in children(spark, layer):
        if name in gone or not name.startswith(("v_", "_")):
            remove(spark, f"{layer}/{name}")
    for name in old:
        remove(spark, f"{layer}/{COMMITS}/{name}")


def replace_all(spark: SparkSession, writes: Mapping[str, Callable[[str], None]]) -> dict[str, str]:
    """Have each function fill the folder of a new version of its layer, then commit all of them.

    Returns the folders. Whatever fails leaves the old versions in place, and what was written goes:
    all folders are complete before the first commit, and commits are taken back if a later one fails.
    """
    new: dict[str, tuple[int, str]] = {}
    committed: list[str] = []
    try:
        for layer, write in writes.items():
            if is_file(spark, layer):
                raise DatasetError(f"{layer} is a single file; a layer is a folder")
            new[layer] = _committed(spark, layer)[0] + 1, f"v_{uuid.uuid4().hex}"
            write(f"{layer}/{new[layer][1]}")
        for layer, (number, version) in new.items():
            committed.append(layer)
            _commit(spark, layer, number, version)
    except BaseException:
        for layer in committed:
            remove(spark, _commit_file(layer, *new[layer]))
        for layer, (_, version) in new.items():
            remove(spark, f"{layer}/{version}")
        raise
    for layer, (number, version) in new.items():
        _clean_up(spark, layer, number, version)
    return {layer: f"{layer}/{version}" for layer, (_, version) in new.items()}
