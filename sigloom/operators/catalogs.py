"""Catalog operators: archive entries, dedup, offsets, rollups, splits, picks and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def entries(docs: DataFrame) -> DataFrame:
    """``(path, size, sha256)`` of stored texts, as an archive lists its files."""
    return docs.select(F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("path"), F.col("n_chars").alias("size"), F.sha2(F.col("text").cast("binary"), 256).alias("sha256"))


def first_seen(rows: DataFrame, content: str = "sha256", order: str = "path") -> DataFrame:
    """Every entry with the path that its content was first seen at, and whether it repeats that.

    The first path is a grouped minimum joined back, so content that very many entries share is
    combined before the shuffle rather than sorted in one task."""
    first = rows.groupBy(content).agg(F.min(order).alias("first_path"))
    return rows.join(first, content).withColumn("dedup", F.col(order) != F.col("first_path"))


def offsets(rows: DataFrame, by: str, order: str, size: str = "size", dedup: str = "dedup") -> DataFrame:
    """Byte offset of each entry within its archive; a repeat stores nothing and has its first's."""
    w = Window.partitionBy(by).orderBy(order)
    stored = F.when(F.col(dedup), 0).otherwise(F.col(size))
    return rows.withColumn("offset", F.coalesce(F.sum(stored).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))


def top_folder(path: Column) -> Column:
    """The first folder of a path, or ``_root`` for a file at the top."""
    return F.when(F.contains(path, F.lit("/")), F.split(path, "/")[0]).otherwise(F.lit("_root"))


def rollup(rows: DataFrame) -> DataFrame:
    """Files, bytes and bytes of content first seen, by top folder."""
    return rows.groupBy(top_folder(F.col("path")).alias("dataset")).agg(F.count("*").alias("files"), F.sum("size").alias("bytes"), F.coalesce(F.sum(F.when(~F.col("dedup"), F.col("size"))), F.lit(0)).alias("unique_bytes"))


#: How a file is packed by its extension, and data sets by a part of their path.
METHODS = ((("edf", "bdf"), "lml"), (("lml", "lmq", "lma", "gz", "zst", "zip", "7z", "png", "jpg", "jpeg", "mp4", "avi"), "store"))


def method(path: Column) -> Column:
    ext = F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))
    out = F.lit("secondary")
    for names, kind in reversed(METHODS):
        out = F.when(ext.isin(*names), kind).otherwise(out)
    return out


def dataset(path: Column, names: tuple[str, ...]) -> Column:
    """The first of ``names`` that the path holds; null if none."""
    return F.coalesce(*(F.when(F.contains(F.lower(path), F.lit(n)), F.lit(n)) for n in names))


def is_safe_stem(stem: Column) -> Column:
    """A name that leads nowhere else: no separator or parent, no odd first character."""
    return ~(F.contains(stem, F.lit("/")) | F.contains(stem, F.lit("\\")) | F.contains(stem, F.lit("..")) | F.substring(stem, 1, 1).isin("-", "~", ".") | (stem == ""))


def human_size(n: Column) -> Column:
    """Bytes as a short text."""
    x = n.cast("double")
    out = F.format_string("%.1f TB", F.bround(x / 1024.0**4, 1))
    for k, unit in reversed(list(enumerate(("B", "KB", "MB", "GB")))):
        out = F.when(x < 1024.0 ** (k + 1), F.format_string(f"%.1f {unit}", F.bround(x / 1024.0**k, 1))).otherwise(out)
    return out


def fingerprint(rows: DataFrame, item: str, *by: str) -> DataFrame:
    """First 16 hex digits of SHA-256 over each group's items in order. For groups of bounded size."""
    return rows.groupBy(*by).agg(F.substring(F.sha2(F.array_join(F.sort_array(F.collect_list(F.col(item).cast("string"))), "\n"), 256), 1, 16).alias("fingerprint"))


def first_wins(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row for each key: that of the lowest order."""
    return rows.groupBy(key).agg(F.min_by(F.struct(*rows.columns), order).alias("r")).select("r.*")


def seeded_sample(rows: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows without replacement, by a hash of the key: the same ones on every run and cluster."""
    return rows.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")).cast("binary")), key).limit(n)


def evenly_spaced(rows: DataFrame, by: str, order: str, k: int) -> DataFrame:
    """k rows of each group at the truncated places of an even spacing from first to last."""
    w = Window.partitionBy(by).orderBy(order)
    n = F.count("*").over(Window.partitionBy(by))
    r = rows.withColumn("_r", F.row_number().over(w) - 1).withColumn("_n", n)
    at = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.floor(i * (F.col("_n") - 1) / F.lit(max(k - 1, 1))))
    return r.where(F.array_contains(at, F.col("_r").cast("long"))).drop("_r", "_n")


def capped(rows: DataFrame, by: str, order: str, size: str, most: int) -> DataFrame:
    """Rows in order while their sizes fit ``most``, the last one in part: column ``take``."""
    w = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(size).over(w), F.lit(0))
    return rows.withColumn("take", F.greatest(F.least(F.lit(most) - before, F.col(size)), F.lit(0))).where("take > 0")


#: The montage in its order, and the newer names of four of its electrodes.
MONTAGE = "Fp1 Fp2 F3 F4 C3 C4 P3 P4 O1 O2 F7 F8 T3 T4 T5 T6 Fz Cz Pz A1 A2".split()
RENAMED = {"T7": "T3", "T8": "T4", "P7": "T5", "P8": "T6"}


def resolve_channel(label: Column) -> Column:
    """Montage name of a recorded label, null if none. The label is cut into words at everything but
    letters and digits; each word that names an electrode counts, the first one wins, whether it stands
    alone, behind a prefix, before a reference or in a pair. Annotation channels have none."""
    known = F.create_map(*(F.lit(x) for k, v in ({c.upper(): c for c in MONTAGE} | RENAMED).items() for x in (k, v)))
    words = F.split(F.upper(label), "[^A-Z0-9]+")
    found = F.filter(F.transform(words, lambda w: F.try_element_at(known, w)), lambda c: c.isNotNull())
    return F.when(~F.array_contains(words, "ANNOTATIONS"), F.get(found, F.lit(0)))


#: Electrodes of the montage that a recording may lack.
OPTIONAL = ("A1", "A2")


def select_channels(labels: DataFrame, least: int = 16) -> DataFrame:
    """``(recording, idx, label)`` -> montage name and the first index that has it, for each recording with
    ``least`` of them. An electrode that no label names first is taken from a pair that names it second, the
    optional ones excepted."""
    named = labels.withColumn("channel", resolve_channel(F.col("label")))
    pick = named.where("channel is not null").groupBy("recording", "channel").agg(F.min("idx").alias("idx"))
    second = F.get(F.split("label", "-"), F.lit(1))
    pairs = labels.withColumn("channel", resolve_channel(second)).where(F.col("channel").isNotNull() & ~F.col("channel").isin(*OPTIONAL))
    lent = pairs.groupBy("recording", "channel").agg(F.min("idx").alias("idx")).join(pick.select("recording", "channel"), ["recording", "channel"], "left_anti")
    both = pick.unionByName(lent)
    many = both.groupBy("recording").agg(F.count("*").alias("channels")).where(F.col("channels") >= least)
    return both.join(many.select("recording"), "recording", "left_semi")


def recording_stem(path: Column) -> Column:
    """Stem of a packed recording, null for any other path."""
    return F.nullif(F.regexp_extract(path, r"([^/]+)\.lml$", 1), F.lit(""))


def label_stem(path: Column) -> Column:
    """Stem of the recording that a label file is for, null for any other path."""
    return F.nullif(F.regexp_extract(path, r"([^/]+)_labels\.npz$", 1), F.lit(""))


def epoch(rows: DataFrame, key: str, draws: int, stride: int = 7919) -> DataFrame:
    """``draws`` rows with repeats where there are fewer: draw k takes the row at ``k * stride`` modulo
    the number of rows, for keys 0 to n - 1. Draws and rows meet by key."""
    n = rows.count()
    spark = rows.sparkSession
    wanted = spark.range(draws).select(F.col("id").alias("draw"), (F.col("id") * stride % max(n, 1)).alias(key))
    return wanted.join(rows, key)


def provenance(windows: DataFrame) -> DataFrame:
    """A node for each window, named by its content, with the node before it in its recording."""
    node = F.sha2(F.array_join(F.transform("samples", lambda x: x.cast("string")), ",").cast("binary"), 256)
    w = Window.partitionBy("recording").orderBy("seq")
    return windows.select("recording", "seq", node.alias("node")).withColumn("parent", F.lag("node").over(w))


def channel_grid(channels: DataFrame, slots: int) -> DataFrame:
    """``(recording, slot, idx)`` with a row for each of ``slots`` slots: -1 and a flag where there is none."""
    every = channels.select("recording").distinct().withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slots - 1).cast("long"))))
    got = every.join(channels, ["recording", "slot"], "left")
    return got.select("recording", "slot", F.coalesce("idx", F.lit(-1)).alias("idx"), F.col("idx").isNull().alias("was_missing"))
