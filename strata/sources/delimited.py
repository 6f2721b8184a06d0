"""All-text scans of delimited files with header contract, row numbers, row hashes and file fingerprints.

One way for files of every size. Whether fields hold line breaks is a property of the source (``SourceSpec.line_breaks``) or seen when a load
takes the fingerprint of its lines: if they do, a file is parsed by one task; if not, files are cut into blocks that are parsed side by side.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.catalog import SourceSpec
from strata.functions.text import row_hash

CSV = {"quote": '"', "escape": '"', "encoding": "UTF-8"}


class SourceError(ValueError):
    """A source does not keep its contract."""


def csv_options(spec: SourceSpec) -> dict[str, object]:
    return {"header": True, "multiLine": spec.line_breaks is not False, **CSV}


def header_of(spark: SparkSession, path: str) -> list[str]:
    """The first line of a file, as values. One row reaches the driver."""
    row = spark.read.options(multiLine=True, **CSV).csv(path, header=False).limit(1).collect()
    return [value or "" for value in row[0]] if row else []


def scan(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """All columns as text; blank fields come as NULL (see :func:`numbered_scan`)."""
    return spark.read.schema(spec.schema).options(enforceSchema=True, **csv_options(spec)).csv(spec.path)


def _placed(rows: DataFrame) -> DataFrame:
    """Rows with file, block and a task-local id that grows in file order."""
    return rows.select(
        *rows.columns, F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__at"))


def _before(blocks: DataFrame, *counts: str) -> DataFrame:
    """Sums of block counts over the earlier blocks of the same file. There is one row per block here."""
    earlier = Window.partitionBy("__file").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.withColumns({c: F.coalesce(F.sum(c).over(earlier), F.lit(0)) for c in counts})


def number_rows(scanned: DataFrame, name: str = "_source_row_number") -> DataFrame:
    """1-based row number in file order, without sorting rows.

    A file block is read by one task in order, so a row's place in its block follows from the task-local
    row id, and the row counts of the earlier blocks give the offset of its block.
    """
    return place_numbers(_placed(scanned), scanned.columns, name)


def place_numbers(placed: DataFrame, columns: Sequence[str], name: str = "_source_row_number") -> DataFrame:
    """Row numbers of rows that have their file, block and task-local id with them."""
    blocks = placed.groupBy("__file", "__block").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__skip"))
    number = F.col("__at") - F.col("__first") + F.col("__skip") + 1
    return placed.join(_before(blocks, "__skip"), ["__file", "__block"]).select(
        *columns, F.col("__file").alias("_source_file"), number.alias(name))


def numbered_scan(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """Source columns with file and 1-based row number."""
    rows = number_rows(scan(spark, spec))
    return rows.na.fill("", list(spec.columns)).withColumn("_source_row_number", F.col("_source_row_number").cast("bigint"))


def with_lineage(spark: SparkSession, spec: SourceSpec, batch: str) -> DataFrame:
    """Source columns with file, domain, row number, row hash, batch and load time."""
    return numbered_scan(spark, spec).select(
        *spec.columns, F.lit(batch).alias("_batch_id"), "_source_file", F.lit(spec.domain).alias("_source_domain"),
        "_source_row_number", row_hash(spec.columns).alias("_row_hash"), F.current_timestamp().alias("_ingested_at"))


def file_facts(spark: SparkSession, path: str, columns: Sequence[str] = ()) -> DataFrame:
    """(file, bytes, checksum, header_ok, line_breaks) per file that is not empty, in one pass over blocks read side by side.

    The checksum stands for all bytes of the file in their order: size, number of lines (ended by a line feed alone, so a carriage
    return counts as content), and for both halves of the lines' hashes their sum and their sum weighted by line number. It
    does not depend on how a file is cut into blocks: weights within a block are moved by the lines before the block.
    ``header_ok``: the first line names ``columns``, quoted or not. ``line_breaks``: some line has an odd number of quotes, so a quoted field goes
    on behind it, or a carriage return that does not end it.
    """
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # within the task
    named = F.replace(F.regexp_replace("value", "^\ufeff|\r$", ""), F.lit('"'), F.lit("")) == F.lit(",".join(columns))
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_size").alias("bytes"),
        F.col("_metadata.file_block_start").alias("__block"), place.alias("__at"), F.xxhash64("value").alias("__hash"),
        ((F.char_length(F.regexp_replace("value", '[^"]', "")) % 2 == 1) | F.col("value").rlike("\r.")).alias("__open"),
        F.when(F.col("_metadata.file_block_start") == 0, named).alias("__named"))
    halves = {"lo": F.col("__hash").bitwiseAND(F.lit((1 << 32) - 1)), "hi": F.shiftrightunsigned("__hash", 32)}
    whole = {k: v.cast("decimal(10,0)") for k, v in halves.items()}
    blocks = lines.groupBy("__file", "__block").agg(
        F.first("bytes").alias("bytes"), F.count(F.lit(1)).alias("n"), F.count(F.lit(1)).alias("__skip"), F.min("__at").alias("__first"),
        F.min_by("__named", "__at").alias("__named"), F.bool_or("__open").alias("__open"), *[F.sum(v).alias(f"s_{k}") for k, v in whole.items()],
        *[F.sum(v * F.col("__at").cast("decimal(10,0)")).alias(f"w_{k}") for k, v in whole.items()])
    moved = (F.col("__skip") - F.col("__first")).cast("decimal(16,0)")
    files = _before(blocks, "__skip").groupBy(F.col("__file").alias("file")).agg(
        F.first("bytes").alias("bytes"), F.sum("n").alias("n"), F.bool_or((F.col("__block") == 0) & F.col("__named")).alias("header_ok"),
        F.bool_or("__open").alias("line_breaks"),
        *[F.sum(f"s_{k}").alias(f"s_{k}") for k in whole],
        *[F.sum(F.col(f"w_{k}") + moved * F.col(f"s_{k}")).alias(f"w_{k}") for k in whole])
    return files.select("file", "bytes", F.sha2(F.concat_ws(":", "bytes", "n", "s_lo", "s_hi", "w_lo", "w_hi"), 256).alias("checksum"),
                        F.coalesce("header_ok", F.lit(False)).alias("header_ok"), "line_breaks")


@dataclass(frozen=True)
class Contents:
    """What the files of a source are: how many, one of those with another header, one checksum for all, whether fields go over lines."""

    files: int
    other_header: str | None
    checksum: str
    line_breaks: bool


def examine(spark: SparkSession, path: str, columns: Sequence[str] = ()) -> Contents:
    """One row reaches the driver. The checksum of several files is an order-free digest over their names and checksums."""
    name = F.element_at(F.split("file", "/"), -1)
    row = file_facts(spark, path, columns).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.when(~F.col("header_ok"), F.col("file"))).alias("other"), F.max("checksum").alias("only"),
        F.sum(F.xxhash64(name, "checksum").cast("decimal(38,0)")).alias("h"), F.coalesce(F.bool_or("line_breaks"), F.lit(True)).alias("line_breaks"),
    ).select("n", "other", "line_breaks", F.when(F.col("n") == 1, F.col("only")).otherwise(F.sha2(F.concat_ws(":", "n", "h"), 256)).alias("checksum")).first()
    return Contents(row["n"], row["other"], row["checksum"], row["line_breaks"])


def fingerprint(spark: SparkSession, path: str) -> str:
    return examine(spark, path).checksum


def check_contents(spark: SparkSession, spec: SourceSpec) -> Contents:
    """Contents of a source whose files all begin with the declared header. Files without a byte hold no rows and are not seen."""
    found = examine(spark, spec.path, spec.columns)
    if not found.files:
        raise SourceError(f"empty file: {spec.path}")
    if found.other_header:
        got = header_of(spark, found.other_header)
        raise SourceError(f"unexpected columns in {found.other_header}: expected {list(spec.columns)}, got {got}")
    return found


def check_source(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """One row per contract rule: check, ok, detail."""
    found = examine(spark, spec.path, spec.columns)
    header = header_of(spark, found.other_header or spec.path)
    rows = numbered_scan(spark, spec).agg(F.count(F.lit(1)).alias("n"))
    header_ok = found.files > 0 and found.other_header is None

    def rule(check: str, ok: Column, detail: Column) -> Column:
        return F.struct(F.lit(check).alias("check"), ok.alias("ok"), detail.alias("detail"))

    return rows.select(F.inline(F.array(
        rule("header", F.lit(header_ok), F.lit(",".join(header))),
        rule("rows", F.col("n") == spec.expected_rows, F.col("n").cast("string")),
    )))


def inventory(spark: SparkSession, raw_dir: str, specs: Sequence[SourceSpec]) -> DataFrame:
    """Declared sources against the files that are there: source, present, declared."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").load(
        raw_dir).select(F.regexp_extract("path", r"([^/]+/[^/]+)\.csv$", 1).alias("source"), F.lit(True).alias("present"))
    declared = spark.createDataFrame(
        [(f"{s.domain}/{s.table}", True) for s in specs],
        T.StructType([T.StructField("source", T.StringType()), T.StructField("declared", T.BooleanType())]))
    return declared.join(found, "source", "full").na.fill(False, ["present", "declared"])
