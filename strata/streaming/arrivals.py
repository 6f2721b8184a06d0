"""Incremental form of the idempotent load: each file that arrives is loaded exactly once.

The file source's checkpoint remembers the files it has seen. Each micro-batch replaces its own
partition, so a batch that runs again after a failure leaves the same rows.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.catalog import SourceSpec
from strata.functions.text import row_hash
from strata.operators.digest import metrics
from strata.sources.delimited import csv_options, place_numbers
from strata.sources.ledger import ARRIVAL, ROW_MARKS, Batch, append, batch_path


def load_arrivals(spark: SparkSession, spec: SourceSpec, landing: str, bronze: str, ledger: str, checkpoint: str,
                  files_per_batch: int = 1000) -> StreamingQuery:
    """Load every new file of a folder and stop. ``spec.path`` is not used; the folder takes its place.

    Rows carry the same lineage as those of a load. A file whose header names other columns stops the query, and its micro-batch
    stays unseen. A micro-batch becomes visible with its ledger event, which a repeated batch writes again under the same key.
    """
    arriving = (
        spark.readStream.schema(spec.schema).options(enforceSchema=False, maxFilesPerTrigger=files_per_batch, **csv_options(spec))
        .csv(landing).select(*spec.columns, F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"))
    )

    def write(batch: DataFrame, number: int) -> None:
        began, name = time.time_ns(), f"{ARRIVAL}{number:012d}"
        path = batch_path(bronze, spec, name)
        placed = batch.withColumn("__at", F.monotonically_increasing_id())
        rows = place_numbers(placed, spec.columns).na.fill("", list(spec.columns)).select(
            *spec.columns, "_source_file", F.lit(spec.domain).alias("_source_domain"), F.col("_source_row_number").cast("bigint"),
            row_hash(spec.columns).alias("_row_hash"), F.current_timestamp().alias("_ingested_at"))
        rows.write.mode("overwrite").parquet(path)
        mark = F.xxhash64("_source_file", "_source_row_number", "_row_hash").cast("decimal(38,0)")
        done = spark.read.parquet(path).agg(F.sum(mark).alias("h"), *metrics(ROW_MARKS)).select(
            "rows", "first", "second", F.sha2(F.concat_ws(":", F.lit(name), "rows", "h"), 256).alias("checksum")).first()
        append(spark, ledger, Batch(name, spec.domain, spec.table, spec.name, landing, done["checksum"], done["rows"], done["rows"], "success",
                                    began, time.time_ns(), None, 0, done["first"], done["second"]))

    return (
        arriving.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
