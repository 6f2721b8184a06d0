"""Layers that readers can trust while they are refreshed.

A refresh writes every table of a layer under a new version. Readers see it once one small record names that version: the last step, after the gate.
A run that stops before leaves readers on the whole old layer. Old versions are removed later, so readers that began on them can end.

    <folder>/versions/<version>/<table>    Parquet
    <folder>/published/<version>           one record: the version, when, its tables with rows and digests
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from strata.operators.digest import Digest, observed

RECORD = ("version string, published_at bigint, tables array<struct<name: string, rows: bigint, first: decimal(38,0), second: decimal(38,0), "
          "sums: map<string, decimal(38,3)>>>")


class UnpublishedError(LookupError):
    """A layer has no published version (or not the one asked for)."""


@dataclass(frozen=True)
class Written:
    """What a table held when it was written."""

    digest: Digest
    sums: Mapping[str, object]


@dataclass
class Draft:
    """A version that is being written; :meth:`publish` shows it to readers."""

    spark: SparkSession
    folder: str
    version: str = field(default_factory=lambda: f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}")
    tables: dict[str, Written] = field(default_factory=dict)

    def path(self, name: str) -> str:
        return f"{self.folder}/versions/{self.version}/{name}"

    def write(self, frames: Mapping[str, DataFrame], sums: Sequence[tuple[str, str]] = (), kind: str = "parquet") -> Draft:
        """Write tables as snappy Parquet (or another ``kind``); rows, digests and the ``sums`` (table, column) are taken in the same pass. Nothing passes through the driver."""
        for name, frame in frames.items():
            wanted = [column for table, column in sums if table == name]
            columns = [f.name for f in frame.schema.fields if not isinstance(f.dataType, MapType)]  # maps have no hash
            watched, watch = observed(frame, columns, *[F.sum(F.col(c).cast("decimal(28,3)")).cast("decimal(38,3)").alias(f"sum {c}") for c in wanted])
            packed = {"compression": "snappy"} if kind == "parquet" else {"ignoreNullFields": "false"}
            watched.write.mode("overwrite").format(kind).options(**packed).save(self.path(name))
            got = watch.get
            self.tables[name] = Written(Digest.of(got), {c: got[f"sum {c}"] for c in wanted})
        return self

    def read(self) -> dict[str, DataFrame]:
        """The written tables: what follows goes on from them instead of computing them again."""
        return {name: self.spark.read.parquet(self.path(name)) for name in self.tables}

    def publish(self) -> str:
        entries = [(name, w.digest.rows, w.digest.first, w.digest.second, dict(w.sums)) for name, w in self.tables.items()]
        record = self.spark.createDataFrame([(self.version, time.time_ns(), entries)], RECORD)
        record.coalesce(1).write.parquet(f"{self.folder}/published/{self.version}")
        return self.version


def history(spark: SparkSession, folder: str) -> DataFrame:
    """Published versions of a layer: version, published_at, tables."""
    try:
        return spark.read.schema(RECORD).option("recursiveFileLookup", True).parquet(f"{folder}/published")
    except AnalysisException:  # nothing has been published yet
        return spark.createDataFrame([], RECORD)


def resolve(spark: SparkSession, folder: str, version: str | None = None) -> Draft:
    """The version published last (or the one named), as it was written."""
    known = history(spark, folder)
    row = (known.where(F.col("version") == version) if version else known).agg(F.max_by(F.struct("version", "tables"), "published_at").alias("r")).first()["r"]
    if row is None:
        raise UnpublishedError(f"{folder} has no published version" + (f" {version}" if version else ""))
    tables = {t["name"]: Written(Digest(t["rows"], t["first"], t["second"]), t["sums"] or {}) for t in row["tables"]}
    return Draft(spark, folder, row["version"], tables)


def read_layer(spark: SparkSession, folder: str, names: Sequence[str] | None = None, version: str | None = None) -> dict[str, DataFrame]:
    """Tables of the version published last, all of the same version."""
    found = resolve(spark, folder, version)
    missing = set(names or ()) - set(found.tables)
    if missing:
        raise UnpublishedError(f"version {found.version} of {folder} has no {sorted(missing)}")
    return {name: spark.read.parquet(found.path(name)) for name in (names or found.tables)}


def remove_old(spark: SparkSession, folder: str, keep: int = 2) -> list[str]:
    """Delete the tables of all but the ``keep`` versions published last, and of drafts older than those that nobody published.

    Younger drafts may still be written and stay. The records stay, too: they are the layer's history.
    """
    kept = [r["version"] for r in history(spark, folder).orderBy(F.desc("published_at")).limit(max(1, keep)).select("version").collect()]
    if not kept:
        return []
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/versions")
    files = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone = sorted(name for name in (s.getPath().getName() for s in files.listStatus(top)) if name not in kept and name < max(kept))
    for name in gone:
        files.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(top, name), True)
    return gone


def sums_of(layer: str, checked: Sequence[tuple[str, str, str]]) -> list[tuple[str, str]]:
    return [(table, column) for where, table, column in checked if where == layer]


def total(column: str) -> Column:
    """A checked sum in units of 0.001."""
    return (F.sum(F.col(column).cast("decimal(28,3)")) * 1000).cast("bigint")
