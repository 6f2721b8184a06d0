"""Load control: an append-only list of events; the newest event of a file version is its state.

The key of a version is (domain, table, checksum). A load counts only once its ``success`` event is
written, which is the last step, so readers never see half a batch.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import asdict, dataclass, replace
from decimal import Decimal

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.catalog import SourceSpec
from strata.operators.digest import Digest, digest, observed
from strata.sources.delimited import SourceError, check_contents, with_lineage

ERROR_LENGTH = 4000
#: Batches of streamed arrivals begin with this; they add to the last load of a source instead of taking its place.
ARRIVAL = "arrival-"
EVENT = T.StructType([
    T.StructField("batch_id", T.StringType()), T.StructField("source_domain", T.StringType()),
    T.StructField("source_table", T.StringType()), T.StructField("target_table", T.StringType()),
    T.StructField("source_file", T.StringType()), T.StructField("source_checksum", T.StringType()),
    T.StructField("expected_rows", T.LongType()), T.StructField("loaded_rows", T.LongType()),
    T.StructField("status", T.StringType()), T.StructField("started_at", T.LongType()),
    T.StructField("completed_at", T.LongType()), T.StructField("error_message", T.StringType()),
    T.StructField("event_ns", T.LongType()),
    T.StructField("first_digest", T.DecimalType(38, 0)), T.StructField("second_digest", T.DecimalType(38, 0)),
])
#: What a stored row is told by: its place in the source and its content.
ROW_MARKS = ("_source_row_number", "_row_hash")


@dataclass(frozen=True)
class Batch:
    batch_id: str
    source_domain: str
    source_table: str
    target_table: str
    source_file: str
    source_checksum: str
    expected_rows: int
    loaded_rows: int
    status: str
    started_at: int | None
    completed_at: int | None
    error_message: str | None
    event_ns: int
    first_digest: Decimal | None = None
    second_digest: Decimal | None = None


@dataclass(frozen=True)
class LoadResult:
    source: str
    target: str
    status: str
    rows: int
    batch_id: str


def append(spark: SparkSession, ledger: str, event: Batch) -> None:
    """Every event is a folder of its own, so that loads side by side do not clear each other's unfinished files."""
    event = replace(event, event_ns=time.time_ns())
    row = tuple(asdict(event)[f.name] for f in EVENT.fields)
    spark.createDataFrame([row], EVENT).coalesce(1).write.parquet(f"{ledger}/{event.event_ns}-{uuid.uuid4()}")


def events(spark: SparkSession, ledger: str) -> DataFrame:
    try:
        return spark.read.schema(EVENT).option("recursiveFileLookup", True).parquet(ledger)
    except AnalysisException:  # no load has been recorded yet
        return spark.createDataFrame([], EVENT)


def current(spark: SparkSession, ledger: str) -> DataFrame:
    """State of every file version."""
    newest = F.max_by(F.struct(*EVENT.fieldNames()), "event_ns").alias("e")
    return events(spark, ledger).groupBy("source_domain", "source_table", "source_checksum").agg(newest).select("e.*")


def batch_listing(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger as analysts read it, with a short checksum."""
    return current(spark, ledger).select(
        "source_domain", "source_table", "expected_rows", "loaded_rows", "status",
        F.substring("source_checksum", 1, 12).alias("checksum_prefix")).orderBy("source_domain", "source_table")


def latest_batches(spark: SparkSession, ledger: str) -> DataFrame:
    """The newest successful batch of each source: the version readers should use."""
    done = current(spark, ledger).where("status = 'success'")
    return done.groupBy("source_domain", "source_table").agg(F.max_by("batch_id", "completed_at").alias("batch_id"))


def batch_path(bronze: str, spec: SourceSpec, batch: str) -> str:
    return f"{bronze}/{spec.name}/_batch_id={batch}"


def totals(spark: SparkSession, ledger: str) -> DataFrame:
    """One row: file versions, how many of them are loaded, failed or unfinished, and the rows of those loaded."""
    done = F.col("status") == "success"
    return current(spark, ledger).agg(
        F.count(F.lit(1)).alias("versions"), F.count_if(done).alias("loaded"), F.count_if(F.col("status") == "failed").alias("failed"),
        F.count_if(F.col("status") == "loading").alias("unfinished"),
        F.coalesce(F.sum(F.when(done, F.col("loaded_rows"))), F.lit(0)).alias("loaded_rows"),
        F.coalesce(F.sum(F.when(done, F.col("expected_rows"))), F.lit(0)).alias("expected_rows"))


def stored_digest(spark: SparkSession, path: str) -> Digest:
    """What a batch folder holds now; reads row numbers and hashes only."""
    try:
        return digest(spark.read.parquet(path), ROW_MARKS)
    except AnalysisException:
        return Digest(0, Decimal(0), Decimal(0))


def visible(state: DataFrame, spec: SourceSpec) -> DataFrame:
    """Batches of a source that readers see: the newest successful load and the arrivals after it."""
    mine = state.where((F.col("source_domain") == spec.domain) & (F.col("source_table") == spec.table) & (F.col("status") == "success"))
    arrived = F.col("batch_id").startswith(ARRIVAL)
    newest = mine.agg(F.max_by("batch_id", F.when(~arrived, F.col("completed_at"))).alias("full"),
                      F.coalesce(F.max(F.when(~arrived, F.col("completed_at"))), F.lit(0)).alias("since"))
    later = (arrived & (F.col("completed_at") > F.col("since"))) | F.col("batch_id").eqNullSafe(F.col("full"))
    return mine.join(F.broadcast(newest), later).drop("full", "since")  # one row


def read_bronze(spark: SparkSession, bronze: str, ledger: str, spec: SourceSpec) -> DataFrame:
    """Rows of the newest successful load of a source and of the arrivals after it; only their partitions are read."""
    batches = visible(current(spark, ledger), spec).select("batch_id")
    row = batches.agg(F.count(F.lit(1)).alias("n"), F.min("batch_id").alias("only")).first()
    if not row["n"]:
        raise SourceError(f"no successful load of {spec.name}")
    if row["n"] == 1:
        return spark.read.parquet(batch_path(bronze, spec, row["only"])).withColumn("_batch_id", F.lit(row["only"]))
    return spark.read.parquet(f"{bronze}/{spec.name}").join(batches.withColumnRenamed("batch_id", "_batch_id"), "_batch_id", "left_semi")


def ingest(spark: SparkSession, spec: SourceSpec, bronze: str, ledger: str) -> LoadResult:
    """Load one source once per content.

    The same content again is skipped when its rows are all there, unchanged. An incomplete or damaged batch keeps its id, and
    its folder is replaced. A new content becomes an additional batch. The source is parsed once: the digest of what was parsed is
    observed while it is written, compared with what is stored, and kept in the ledger. Whether files can be cut into blocks is seen when their lines
    are fingerprinted, unless the source says it.
    """
    found = check_contents(spark, spec)
    checksum = found.checksum
    if spec.line_breaks is None:
        spec = replace(spec, line_breaks=found.line_breaks)
    known = current(spark, ledger).where(
        (F.col("source_domain") == spec.domain) & (F.col("source_table") == spec.table)
        & (F.col("source_checksum") == checksum)).first()
    if known is not None and known.status == "success" and known.loaded_rows == spec.expected_rows:
        if stored_digest(spark, batch_path(bronze, spec, known.batch_id)) == Digest(known.loaded_rows, known.first_digest, known.second_digest):
            return LoadResult(spec.path, spec.name, "skipped", spec.expected_rows, known.batch_id)
    batch_id = known.batch_id if known is not None else str(uuid.uuid4())
    event = Batch(batch_id, spec.domain, spec.table, spec.name, spec.path, checksum, spec.expected_rows, 0,
                  "loading", time.time_ns(), None, None, 0)
    append(spark, ledger, event)
    path = batch_path(bronze, spec, batch_id)
    try:
        watched, watch = observed(with_lineage(spark, spec, batch_id).drop("_batch_id"), ROW_MARKS)
        watched.write.mode("overwrite").parquet(path)
        parsed, stored = Digest.of(watch.get), stored_digest(spark, path)
        if stored.rows != spec.expected_rows:
            raise SourceError(f"{spec.path}: expected {spec.expected_rows} rows, stored {stored.rows}")
        if stored != parsed:
            raise SourceError(f"{spec.path}: what is stored is not what was parsed")
    except Exception as error:
        append(spark, ledger, replace(event, status="failed", completed_at=time.time_ns(),
                                      error_message=str(error)[:ERROR_LENGTH]))
        raise
    append(spark, ledger, replace(event, status="success", loaded_rows=stored.rows, completed_at=time.time_ns(),
                                  first_digest=stored.first, second_digest=stored.second))
    return LoadResult(spec.path, spec.name, "loaded", stored.rows, batch_id)
