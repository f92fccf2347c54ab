"""Manifests and receipts of batch jobs."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

MANIFEST = "input_path string, output_path string, status string, raw_bytes long, compressed_bytes long, cr double, duration_ms double, error string, prd double, pearson_r double, lqs_pass boolean"


def write_manifest(results: DataFrame, path: str) -> None:
    """Batch results as CSV with a header; null is the empty field."""
    results.write.mode("overwrite").option("header", "true").option("emptyValue", "").csv(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).option("header", "true").csv(path)


def receipts(imported: DataFrame, known: DataFrame) -> DataFrame:
    """Receipts ``(source_hash, path)`` for what was not imported before: running a job again adds none."""
    first = imported.groupBy("source_hash").agg(F.min("path").alias("path"))
    return first.join(known.select("source_hash"), "source_hash", "left_anti")


def dispositions(fields: DataFrame, exact: list[str], quarantined: list[str]) -> DataFrame:
    """What became of each source field: exact, quarantined or unsupported."""
    kind = F.when(F.col("field").isin(exact), "exact").when(F.col("field").isin(quarantined), "quarantined").otherwise("unsupported")
    return fields.withColumn("disposition", kind)


def run_totals(results: DataFrame) -> DataFrame:
    """One row of what a run did: files by status, bytes in and out, their ratio (0 where nothing was packed)."""
    ok, done = F.col("status") == "success", F.col("status")
    g = results.agg(
        F.count_if(ok).alias("files_ok"),
        F.count_if(done == "failed").alias("files_error"),
        F.count_if(done == "skipped").alias("files_skipped"),
        F.coalesce(F.sum(F.when(ok, F.col("raw_bytes"))), F.lit(0)).alias("bytes_in"),
        F.coalesce(F.sum(F.when(ok, F.col("compressed_bytes"))), F.lit(0)).alias("bytes_out"),
    )
    return g.withColumn("compression_ratio", F.round(F.when(F.col("bytes_out") > 0, F.col("bytes_in") / F.col("bytes_out")).otherwise(0.0), 4))


def write_json_manifest(results: DataFrame, path: str, run: dict[str, str] | None = None) -> None:
    """A run as JSON lines below ``path``: ``totals`` is one line, with the facts of ``run``, ``files`` a line a file.
    Spark's committer makes each visible as a whole or not at all; files never pass through the driver."""
    facts = F.struct(*(F.lit(v).alias(k) for k, v in sorted((run or {}).items()))) if run else F.lit(None)
    run_totals(results).select(F.to_json(F.struct(F.lit("1.0").alias("schema_version"), facts.alias("run"), F.struct("*").alias("statistics"))).alias("value")).coalesce(1).write.mode("overwrite").text(f"{path}/totals")
    name = F.element_at(F.split("input_path", "/"), -1)
    files = results.select(F.to_json(F.struct(name.alias("path"), F.col("raw_bytes").alias("bytes_in"), F.col("compressed_bytes").alias("bytes_out"), F.round("cr", 3).alias("ratio"), "status")).alias("value"))
    files.write.mode("overwrite").text(f"{path}/files")


def audit_line(kind: Column, fields: dict[str, Column]) -> Column:
    """A line of an audit log: the kind, then ``name=value`` pairs, values with a blank in quotes; a null value
    is left out."""
    shown = [F.when(F.contains(v.cast("string"), F.lit(" ")), F.concat(F.lit(f'{n}="'), v.cast("string"), F.lit('"'))).otherwise(F.concat(F.lit(f"{n}="), v.cast("string"))) for n, v in fields.items()]
    return F.concat_ws("  ", F.rpad(kind, 9, " "), *shown)


class StatusLines(StreamingQueryListener):
    """One JSON line for each batch of a stream, given to ``put``: query, batch, rows, rates and duration; and
    one for its end."""

    def __init__(self, put):
        self.put = put

    def onQueryStarted(self, event) -> None:
        self.put(json.dumps({"type": "started", "query": str(event.id), "name": event.name}))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.put(json.dumps({"type": "progress", "query": str(p.id), "batch": p.batchId, "rows": p.numInputRows, "rows_per_s": p.processedRowsPerSecond, "ms": p.batchDuration}))

    def onQueryIdle(self, event) -> None:
        self.put(json.dumps({"type": "idle", "query": str(event.id)}))

    def onQueryTerminated(self, event) -> None:
        self.put(json.dumps({"type": "ended", "query": str(event.id), "error": event.exception}))
