"""Metadata operations on the Hadoop file system that holds the lake."""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from itertools import islice

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target, hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, target, _ = _fs(spark, path)
    return fs.exists(target)


def children(spark: SparkSession, path: str) -> set[str]:
    """Names directly below a directory; empty if it does not exist."""
    fs, target, _ = _fs(spark, path)
    if not fs.exists(target):
        return set()
    return {status.getPath().getName() for status in fs.listStatus(target)}


def present(spark: SparkSession, root: str, wanted: list[str]) -> list[str]:
    """Which of the directories `wanted` (relative to `root`) exist: one listing per parent."""
    below: dict[str, set[str]] = {}
    for directory in wanted:
        parent = ""
        for name in directory.split("/"):
            below.setdefault(parent, set()).add(name)
            parent = f"{parent}/{name}"
    found, level = [], [""]
    while level:
        deeper = []
        for parent in level:
            if parent not in below:
                found.append(parent[1:])
            else:
                names = children(spark, f"{root.rstrip('/')}{parent}") & below[parent]
                deeper += [f"{parent}/{name}" for name in sorted(names)]
        level = deeper
    return found


def delete(spark: SparkSession, path: str) -> bool:
    """Remove a file or directory; False if it was not there."""
    fs, target, _ = _fs(spark, path)
    return fs.delete(target, True)


def delete_all(spark: SparkSession, paths: Iterator[str], threads: int = 16) -> None:
    """Delete many files, a bounded number of paths at a time."""
    with ThreadPoolExecutor(threads) as pool:
        while chunk := list(islice(paths, 10_000)):
            for _ in pool.map(lambda path: delete(spark, path), chunk):
                pass


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file in one go, replacing an old one."""
    fs, target, _ = _fs(spark, path)
    out = fs.create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def move(spark: SparkSession, source: str, destination: str) -> None:
    fs, origin, hadoop = _fs(spark, source)
    target = hadoop.Path(destination)
    fs.mkdirs(target.getParent())
    if not fs.rename(origin, target):
        raise OSError(f"cannot move {source} to {destination}")


def beside(target: str, suffix: str) -> str:
    """A sibling path that table scans ignore, because its name starts with `_`."""
    parent, name = target.rstrip("/").rsplit("/", 1)
    return f"{parent}/_{name}.{suffix}"


def retired(target: str) -> str:
    """Where the old version of a table waits while a new one is swapped in."""
    return beside(target, "retired")


def recover(spark: SparkSession, target: str) -> None:
    """Bring back the old version if a swap was cut off between its two moves."""
    if not exists(spark, target) and exists(spark, retired(target)):
        move(spark, retired(target), target)


def swap_in(spark: SparkSession, staged: str, target: str) -> None:
    """Publish a finished directory in place of `target`; the old one goes last."""
    if exists(spark, target):
        delete(spark, retired(target))
        move(spark, target, retired(target))
    move(spark, staged, target)
    delete(spark, retired(target))
