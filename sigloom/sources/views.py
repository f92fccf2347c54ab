"""Signal-shaped views of plain tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sigloom.operators.windows import numbered


def signal(events: DataFrame, recording: str = "event_type") -> DataFrame:
    """``(recording, t, v)``: one channel per value of ``recording``, samples in event order, in cents."""
    v = F.round(F.col("value") * 100).cast("long").alias("v")
    rows = events.select(F.col(recording).alias("recording"), "event_id", v)
    return numbered(rows, "recording", "event_id").select("recording", "t", "v")


def strip_low_bits(samples: DataFrame, bits: int = 3) -> DataFrame:
    """The signal with its low bits cleared: a lossy reconstruction to measure."""
    return samples.withColumn("v", F.shiftleft(F.shiftright("v", bits), bits))


def ramp(spark: SparkSession, channels: int, samples: int, n_windows: int) -> DataFrame:
    """A test signal without a file: ``v = seq * 1000 + channel * 100 + t``."""
    n = channels * samples
    at = spark.range(n_windows * n).select(F.floor(F.col("id") / n).alias("seq"), (F.floor(F.col("id") / samples) % channels).cast("int").alias("channel"), (F.col("id") % samples).alias("t"))
    return at.withColumn("v", F.col("seq") * 1000 + F.col("channel") * 100 + F.col("t"))


#: The first bytes of each binary profile.
MAGICS = ((b"LMLCRYPT", "LMLCRYPT"), (b"BCS1", "BCS1"), (b"LML1", "LML1"), (b"LMA1", "LMA1"), (b"LMA2", "LMA2"), (b"LMQC", "LMQC"), (b"LQT2", "LQT2"), (b"LQT3", "LQT3"), (b"LQTP\x01", "LQTP1"))


def sniff(content: Column) -> Column:
    """Profile of a binary by its first bytes; null if unknown."""
    return F.coalesce(*(F.when(F.substring(content, 1, len(m)) == F.lit(m), F.lit(name)) for m, name in MAGICS))


_EVENT = "type string, ts_ms long, op_id string, total long, current long, message string, path string, success boolean, ms long, cr double, bytes_in long, bytes_out long, sha256 string, n_windows int"


def operation_events(lines: DataFrame) -> DataFrame:
    """Parse ``line`` as an operation event; one that is not JSON is a log message."""
    e = F.from_json("line", _EVENT, {"mode": "PERMISSIVE"})
    rows = lines.withColumn("_e", e)
    odd = F.col("_e.type").isNull()
    known = [f.split()[0] for f in _EVENT.split(", ") if not f.startswith(("type", "message"))]
    return rows.select(*lines.columns, F.when(odd, "log").otherwise(F.col("_e.type")).alias("kind"), *(F.col(f"_e.{n}").alias(n) for n in known), F.when(odd, F.col("line")).otherwise(F.col("_e.message")).alias("message"))


def inspect(files: DataFrame) -> DataFrame:
    """Facts of ``binaryFile`` rows: profile, size and SHA-256."""
    return files.select("path", sniff(F.col("content")).alias("profile"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


def watch(spark: SparkSession, folder: str, endings: tuple[str, ...] = ("lml", "edf", "bdf"), per_batch: int = 64) -> DataFrame:
    """A stream of the files that come to be below ``folder``, each once, at most ``per_batch`` at a time."""
    return (
        spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
        .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{" + ",".join(endings) + "}").option("maxFilesPerTrigger", per_batch).load(folder)
    )
