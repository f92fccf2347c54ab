"""SimHash near-duplicate detection by tiled exact comparison.

Fingerprints are collapsed to their distinct values first, so a group of exact copies costs one row.
Two values within ``radius`` bits agree in at least ``BLOCKS - radius`` of ``BLOCKS`` blocks of bits; the
blocks' choices are the buckets in which values meet, so no link can be missed, and with 32 of the 64
bits in each key a bucket stays small however many values there are. Rows sorted by bucket and
population count are cut into tiles, XORed in numpy and counted with ``bitwise_count``; a tile pair that
shares no bucket, or whose population counts there lie further apart than the radius, is skipped, as
the counts of two values differ by no more than their bits do. Only a spanning forest of the links
leaves a task.

A bucket above ``HOT`` values is not given to one task: it is dealt out as pairs of tiles, which
the same population count rule prunes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, in_arrow, join_hot, share_code, stored, text_of
from .components import components

RADIUS = 3
SHINGLE = 3
BITS = 64
#: Blocks of bits whose choices are the buckets: 6 for 3 bits, any 3 of which are equal.
BLOCKS = 6
#: Side of a tile of the comparison, and values above which a bucket is dealt out as tile pairs.
TILE = 256
HOT = 8192


def shingle_hashes(text: str, shingle: int = SHINGLE, seed: int = 42) -> np.ndarray:
    """XXH64 of each shingle of a text, repeats included; none if it has no words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    start = end - size
    k = min(shingle, len(words))
    hashed = xxhash.xxh64_intdigest
    return np.fromiter((hashed(line[a:b], seed) for a, b in zip(start.tolist(), end[k - 1 :].tolist(), strict=False)), np.uint64, len(words) - k + 1)


def majority(h: np.ndarray) -> int:
    """SimHash: a bit is set if it is set in over half of the hashes; 0 of none."""
    counts = np.zeros(BITS, np.int64)
    octets = h.view(np.uint8).reshape(-1, 8)
    for at in range(0, len(octets), 1 << 16):
        counts += np.unpackbits(octets[at : at + (1 << 16)], axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(h), bitorder="little").view(np.uint64)[0])


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    return majority(shingle_hashes(text, shingle))


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = np.fromiter((fingerprint(x.as_py()) for x in b.column(1)), np.uint64, b.num_rows)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, fp)``; fp holds the 64 bits as a signed long. Null text counts as empty: 0."""
    share_code(docs.sparkSession)
    return in_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of()), _fingerprints, "doc_id long, fp long")


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest member of each node's component for n nodes and links i-j."""
    low = np.arange(n)
    while len(i):
        m = np.minimum(low[i], low[j])
        np.minimum.at(low, low[i], m)
        np.minimum.at(low, low[j], m)
        while (low != (up := low[low])).any():
            low = up
        keep = low[i] != low[j]
        i, j = i[keep], j[keep]
    return low


def tile_links(key: np.ndarray, side: np.ndarray, fp: np.ndarray, radius: int) -> np.ndarray:
    """Smallest position of each row's component, for rows sorted by bucket ``key`` and population
    count; rows with a side (1 or 2) meet only those of the other one."""
    n, count = len(fp), np.bitwise_count(fp).astype(np.int64)
    one, two = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for x in range(0, n, TILE):
        a = slice(x, min(x + TILE, n))
        last = key[a.stop - 1]
        for y in range(x, n, TILE):
            b = slice(y, min(y + TILE, n))
            if y > x and (key[y] != last or count[y] > count[a.stop - 1] + radius):
                break
            near = np.bitwise_count(fp[a, None] ^ fp[None, b]) <= radius
            near &= key[a, None] == key[None, b]
            near &= (side[a, None] != side[None, b]) | (side[a, None] == 0)
            i, j = np.nonzero(near)
            i, j = i[j + y > i + x] + x, j[j + y > i + x] + y
            if len(i):  # a forest of the tile pair's links
                nodes, at = np.unique(np.r_[i, j], return_inverse=True)
                low = forest(len(nodes), at[: len(i)], at[len(i) :])
                far = np.flatnonzero(low != np.arange(len(low)))
                one.append(nodes[low[far]])
                two.append(nodes[far])
    return forest(n, np.concatenate(one), np.concatenate(two))


def _links(rep: np.ndarray, low: np.ndarray) -> pa.RecordBatch:
    far = np.flatnonzero(low != np.arange(len(low)))
    return pa.RecordBatch.from_arrays([pa.array(rep[far]), pa.array(rep[low[far]])], ["u", "v"])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Whole buckets from batches sorted by ``key``: columns key, side, fp, rep."""
    held: list[np.ndarray] | None = None
    for b in batches:
        cols = [np.asarray(b.column(k)) for k in range(4)]
        if held is not None:
            cols = [np.concatenate(x) for x in zip(held, cols, strict=True)]
        if not len(cols[0]):
            continue
        cut = int(np.searchsorted(cols[0], cols[0][-1]))
        held = [x[cut:] for x in cols]
        if cut:
            yield tuple(x[:cut] for x in cols)
    if held is not None and len(held[0]):
        yield tuple(held)


def linker(radius: int):
    """Batches of ``key, side, fp, rep``, sorted by key and population count -> links between reps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, side, fp, rep in _runs(batches):
            twin = np.r_[False, key[1:] == key[:-1]]
            some = np.flatnonzero(twin | np.r_[twin[1:], False])  # who is alone in a bucket has none to meet
            if len(some):
                yield _links(rep[some], tile_links(key[some], side[some], fp[some].view(np.uint64), radius))

    return run


def block_keys(radius: int, blocks: int = BLOCKS) -> list[int]:
    """A mask for each choice of ``blocks - radius`` blocks of bits."""
    cuts = [BITS * k // blocks for k in range(blocks + 1)]
    one = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:], strict=False)]
    return [sum(m) for m in combinations(one, blocks - radius)]


def _blocks(values: DataFrame, radius: int) -> DataFrame:
    """A row for each value and choice of blocks: key, side 0, fp, rep."""
    signed = [m - (1 << 64) if m >> 63 else m for m in block_keys(radius)]
    keys = [F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(m).cast("long"))) for k, m in enumerate(signed)]
    return values.select(F.explode(F.array(*keys)).alias("key"), F.lit(0).alias("side"), "fp", "rep")


def tile_pairs(rows: DataFrame, tile: int, reach: int) -> DataFrame:
    """``rows(key, p, id, weight, ...)`` dealt to pairs of tiles, as ``(key, side, ...)`` with a key for
    each pair. A tile holds rows of one key and ``p``, of about ``tile`` weight in sum; tiles whose p differ
    by more than ``reach`` are no pair."""
    count = rows.groupBy("key", "p").agg(F.ceil(F.sum("weight") / tile).cast("int").alias("m"))
    rows = rows.join(count, ["key", "p"]).withColumn("s", F.pmod(F.xxhash64("id"), F.col("m")).cast("int")).drop("m")
    tile_of = count.select("key", "p", F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("s"))
    other = tile_of.select("key", F.col("p").alias("p2"), F.col("s").alias("s2"))
    pair = tile_of.join(other, "key").where((F.col("p2") - F.col("p")).between(0, reach) & ((F.col("p2") > F.col("p")) | (F.col("s2") >= F.col("s"))))
    unit = F.xxhash64("key", "p", "s", "p2", "s2")
    same = (F.col("p") == F.col("p2")) & (F.col("s") == F.col("s2"))
    left = pair.select("key", "p", "s", unit.alias("unit"), F.when(same, 0).otherwise(1).alias("side"))
    right = pair.where(~same).select("key", F.col("p2").alias("p"), F.col("s2").alias("s"), unit.alias("unit"), F.lit(2).alias("side"))
    dealt = rows.join(left.unionByName(right), ["key", "p", "s"])
    return dealt.select(F.col("unit").alias("key"), "side", *(c for c in rows.columns if c not in ("key", "p", "s", "weight")))


def meet(rows: DataFrame, radius: int, hot: int = HOT, tile: int = HOT // 2) -> DataFrame:
    """``rows(key, side, fp, rep)`` -> links ``(u, v)`` between reps that share a key and whose fp are
    within the radius; a spanning forest of them rather than all, so components are exact."""
    large = stored(rows.groupBy("key").count().where(F.col("count") > hot).select("key"))
    run, columns, count = linker(radius), ["key", "side", "fp", "rep"], F.bit_count("fp")
    plain = rows.join(large.hint("merge"), "key", "left_anti") if not large.isEmpty() else rows
    out = in_arrow(plain.select(*columns).repartition("key").sortWithinPartitions("key", count), run, "u long, v long")
    if not large.isEmpty():
        big = rows.join(large.hint("merge"), "key", "left_semi").select("key", count.cast("int").alias("p"), "fp", "rep", F.col("rep").alias("id"), F.lit(1).alias("weight"))
        units = tile_pairs(big, tile, radius).select(*columns)
        out = out.unionByName(in_arrow(units.repartition("key").sortWithinPartitions("key", count), run, "u long, v long"))
    return out


def link(values: DataFrame, radius: int = RADIUS, hot: int = HOT, tile: int = HOT // 2) -> DataFrame:
    """``values(fp, rep)``, distinct fp -> links ``(u, v)`` between reps whose fp are within the radius."""
    return meet(_blocks(values, radius), radius, hot, tile)


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``docs(doc_id, text, ...)`` -> ``(doc_id, fingerprint, component_id, n_copies, is_kept)``, a row
    for each input row.

    ``component_id`` is the smallest doc_id that links reach, ``n_copies`` the rows with the same
    fingerprint, ``is_kept`` true for a row whose id is the component's. Nulls: a null text is the
    empty one; a null doc_id is carried and leads no component unless all of its copies are null. Empty
    and word-less texts have fingerprint zero and link like any other. Very long texts are read whole.
    Ties: links are symmetric, so there are none. Repeated rows repeat. An empty table gives no rows.
    Extra columns of any name are left out."""
    spark = docs.sparkSession
    prints = stored(fingerprints(docs))
    values = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")))
    root = components(link(values.where("rep is not null").select("fp", "rep"), radius))
    named = values.join(root.select(F.col("u").alias("rep"), F.col("v").alias("root")), "rep", "left")
    named = stored(named.select("fp", F.coalesce("root", "rep").alias("component_id"), "n"))
    discard(spark, root)
    discard(spark, values)
    total = named.agg(F.sum("n")).first()[0] or 0
    return join_hot(prints, named, "fp", total).select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
        F.col("n").alias("n_copies"),
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("is_kept"),
    )
