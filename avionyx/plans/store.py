"""Stored warehouse: folders of loads, published by one small manifest file.

A load writes each table to a fresh folder ``data/<table>/_load=<version>-<id>``
and then creates ``_manifest/<version>.json``, which lists for every table the
folders that hold it.  The file is created exclusively, so of two loads that
start from the same version one is published and the other fails.  It ends
with a mark: a manifest that a crashed load left unfinished is passed over by
readers, and its number is not used again, so it blocks no later load.
Readers follow the newest whole manifest: they see a load whole or not at all.

Facts are partitioned by ``_period`` (year and month, 199803), so a check
against the stored keys reads the periods of the new rows only.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..sources import schemas

PERIOD = "_period"
OPEN = "-open"  # ends the folders that the next load writes anew
_END = "end"


class AlreadyPublished(RuntimeError):
    """Another load was published from the same version."""


@dataclass(frozen=True)
class Published:
    root: str
    version: int
    folders: dict[str, list[str]]
    # the highest manifest number seen, whole or not
    highest: int = field(default=0, compare=False)

    def read(self, spark: SparkSession, table: str, with_period: bool = False, closed: bool = False) -> DataFrame:
        """A stored table; ``closed`` leaves its open folders out, ``with_period`` keeps the partition column."""
        folders = [f for f in self.folders[table] if not (closed and f.endswith(OPEN))]
        if not folders:
            return self.read(spark, table, with_period).limit(0)
        paths = [f"{self.root}/{f}" for f in folders]
        reader = spark.read.option("basePath", f"{self.root}/data/{table}")
        if table in schemas.WAREHOUSE_TABLES:  # a partitioned table without a row has no file to tell its columns
            declared = schemas.WAREHOUSE_TABLES[table].fields
            kinds = [T.StructField("_load", T.StringType()), T.StructField(PERIOD, T.IntegerType())]
            reader = reader.schema(T.StructType([*declared, *kinds]))
        out = reader.parquet(*paths).drop("_load")
        return out if with_period else out.drop(PERIOD)


def _manifests(spark: SparkSession, root: str):
    """The Hadoop file system of ``root`` and the folder of manifests."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/_manifest")
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _numbers(fs, folder) -> list[int]:
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]  # one name a load
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _content(spark: SparkSession, fs, path) -> dict | None:
    """A manifest's folders, or None if it is not whole."""
    stream = fs.open(path)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        found = json.loads(text)
    except ValueError:
        return None
    return found["folders"] if isinstance(found, dict) and found.get("mark") == _END else None


def published(spark: SparkSession, root: str) -> Published | None:
    """The newest published version, or None where nothing was published yet."""
    root = root.rstrip("/")
    fs, folder = _manifests(spark, root)
    numbers = _numbers(fs, folder)
    path = spark._jvm.org.apache.hadoop.fs.Path
    for version in reversed(numbers):
        folders = _content(spark, fs, path(folder, f"{version}.json"))
        if folders is not None:
            return Published(root, version, folders, numbers[-1])
    return None


def _next(spark: SparkSession, root: str, before: Published | None) -> int:
    if before is not None:
        return max(before.version, before.highest) + 1
    fs, folder = _manifests(spark, root)
    numbers = _numbers(fs, folder)
    return (numbers[-1] if numbers else 0) + 1


def new_folders(root: str, before: Published | None, tables: list[str]) -> dict[str, str]:
    """A fresh folder for each table of one load, relative to ``root``."""
    load = f"{(before.version if before else 0) + 1}-{uuid.uuid4().hex}"
    return {t: f"data/{t}/_load={load}" for t in tables}


def publish(spark: SparkSession, root: str, before: Published | None, folders: dict[str, list[str]]) -> Published:
    """Make ``folders`` the current version; fails if another load was published since ``before``."""
    root = root.rstrip("/")
    version = _next(spark, root, before)
    if before is None and published(spark, root) is not None:
        raise AlreadyPublished(f"a warehouse already exists under {root}")
    fs, folder = _manifests(spark, root)
    fs.mkdirs(folder)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder, f"{version}.json")
    try:
        stream = fs.create(path, False)
    except Exception as e:
        if not fs.exists(path):
            raise
        raise AlreadyPublished(f"version {version} under {root} already exists: another load was published first") from e
    try:
        stream.write(bytearray(json.dumps({"folders": dict(sorted(folders.items())), "mark": _END}).encode()))
    finally:
        stream.close()
    return Published(root, version, folders, version)


def forget(spark: SparkSession, root: str, folders: list[str], before_version: int) -> None:
    """Delete folders that no current version lists, and the manifests under ``before_version``."""
    root = root.rstrip("/")
    fs, manifests = _manifests(spark, root)
    path = spark._jvm.org.apache.hadoop.fs.Path
    for version in _numbers(fs, manifests):
        if version < before_version:
            fs.delete(path(manifests, f"{version}.json"), False)
    for folder in folders:
        fs.delete(path(f"{root}/{folder}"), True)


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    now = published(spark, root)
    if now is None:
        raise ValueError(f"no warehouse is published under {root}")
    return now.read(spark, table)
