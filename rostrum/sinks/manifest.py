"""Published versions of tables: S14, S20.

Data files are written below folders of their own. A version is a manifest, a small file that names the
folders of each of its tables; it is written aside and renamed into place as the last step. A
version is therefore there as a whole or not at all, and a folder of a writer that died is
named by none. A new version may name folders of an older one, so what didn't change isn't written again.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MANIFESTS = "_manifests"


@dataclass(frozen=True)
class Part:
    """A folder of a table; `key` tells parts of a partitioned table apart."""

    path: str
    key: str = ""


@dataclass(frozen=True)
class Published:
    """A table of a version."""

    schema: T.StructType
    parts: tuple[Part, ...]

    def read(self, spark: SparkSession, keys: list[str] | None = None) -> DataFrame:
        """The rows; with `keys` of those parts alone, whose folders are the only ones listed."""
        paths = [p.path for p in self.parts if keys is None or p.key in keys]
        if not paths:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*paths)


def _files(spark: SparkSession, path: str):
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names below a folder; none where it doesn't exist."""
    fs, at = _files(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def write_part(df: DataFrame, root: str, key: str = "") -> Part:
    """`df` in a folder of its own below `root`."""
    path = f"{root}/data/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return Part(path, key)


def write_parts(df: DataFrame, root: str, by: str) -> tuple[Part, ...]:
    """`df` in a folder per value of column `by`, which is not stored in the files."""
    path = f"{root}/data/{uuid.uuid4().hex}"
    df.write.partitionBy(by).parquet(path)
    prefix = f"{by}="
    unquote = df.sparkSession._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    return tuple(Part(f"{path}/{n}", unquote(n[len(prefix):])) for n in list_names(df.sparkSession, path) if n.startswith(prefix))


def publish(spark: SparkSession, root: str, version: int, tables: dict[str, Published]) -> None:
    """Make `version` readable: one rename, after all its folders are complete. A retry replaces its
    own version and nothing else; a root has one writer at a time."""
    content = {
        name: {"schema": table.schema.json(), "parts": [[p.key, p.path] for p in table.parts]} for name, table in tables.items()}
    fs, folder = _files(spark, f"{root}/{MANIFESTS}")
    fs.mkdirs(folder)
    path = spark._jvm.org.apache.hadoop.fs.Path
    aside, final = path(folder, f".{uuid.uuid4().hex}"), path(folder, f"{version:020d}.json")
    out = fs.create(aside)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    if fs.exists(final):
        fs.delete(final, False)
    if not fs.rename(aside, final):
        raise OSError(f"version {version} of {root} could not be published")


def versions(spark: SparkSession, root: str) -> list[int]:
    """The published versions, ascending."""
    return [int(n[:-5]) for n in list_names(spark, f"{root}/{MANIFESTS}") if n.endswith(".json")]


def tables_of(spark: SparkSession, root: str, version: int | None = None, before: int | None = None) -> dict[str, Published]:
    """The tables of a version: the given one, or the newest (below `before`)."""
    if version is None:
        known = [v for v in versions(spark, root) if before is None or v < before]
        if not known:
            raise FileNotFoundError(f"{root} has no published version")
        version = known[-1]
    fs, at = _files(spark, f"{root}/{MANIFESTS}/{version:020d}.json")
    stream = fs.open(at)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return {
        name: Published(T.StructType.fromJson(json.loads(t["schema"])), tuple(Part(path, key) for key, path in t["parts"]))
        for name, t in json.loads(text).items()}


def publish_tables(tables: dict[str, DataFrame], root: str, version: int) -> None:
    """Several tables as one version: readers of a version see all of them as they were together."""
    spark = next(iter(tables.values())).sparkSession
    publish(spark, root, version, {name: Published(df.schema, (write_part(df, root),)) for name, df in tables.items()})
