"""Near copies by SimHash, held to their exact similarity.

Fingerprints within 3 bits are only the closest copies (a similarity of about 0.97). Texts of a
similarity of 0.8 differ in about 10 of 64 bits, which no choice of equal blocks can find, so here
the buckets of the tiled comparison come from the shingles: each text has ``BANDS`` keys of ``ROWS`` minimum
hashes, and two texts of similarity s share a key with probability ``1 - (1 - s**ROWS)**BANDS`` (0.9998 at
0.8). What the tiles find within ``RADIUS`` bits makes coarse groups; inside these, texts are linked by the
Jaccard similarity of their whole shingle sets, so nothing is a copy by its fingerprint alone. Coarse
groups above ``TILE_SHINGLES`` are dealt out as pairs of tiles of like set sizes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, in_arrow, join_hot, quoted, share_code, stored, text_of
from .components import components
from .simhash import forest, majority, meet, shingle_hashes, tile_pairs

SHINGLE = 5
SIMILARITY = 0.8
#: Bits within which texts of that similarity lie: 9.7 expected, a deviation of 2.9.
RADIUS = 22
BANDS, ROWS = 16, 4
#: Shingles of the sets that a task compares with one another at once.
TILE_SHINGLES = 2_000_000

_random = np.random.default_rng(7)
_FACTOR = _random.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _random.integers(0, 1 << 63, BANDS * ROWS, np.uint64)


def shingle_set(text: str, shingle: int) -> np.ndarray:
    return np.unique(shingle_hashes(text, shingle))


def band_keys(own: np.ndarray) -> np.ndarray:
    """A key for each band of a shingle set's minimum hashes."""
    low = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(own), 4096):
        low = np.minimum(low, (_FACTOR[:, None] * own[None, at : at + 4096] + _SHIFT[:, None]).min(1))
    return np.array([xxhash.xxh64_intdigest(low[k * ROWS : (k + 1) * ROWS].tobytes(), k) for k in range(BANDS)], np.uint64)


def _sketch(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            name, fp, keys = [], [], []
            for x in b.column(2):
                h = shingle_hashes(x.as_py(), shingle)
                own = np.unique(h)
                name.append(xxhash.xxh64_intdigest(own.tobytes(), 1))
                fp.append(majority(h))
                keys.append(band_keys(own))
            flat = np.concatenate(keys).view(np.int64) if keys else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1) * BANDS, pa.int32()), pa.array(flat))
            cols = [b.column(0), b.column(1), *(pa.array(np.array(v, np.uint64).view(np.int64)) for v in (name, fp)), lists]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "text_hash", "set", "fp", "keys"])

    return run


def similar(sets: list[np.ndarray], side: np.ndarray, similarity: float) -> np.ndarray:
    """Smallest position of each set's component; sets of a side (1 or 2) meet those of the other."""
    m = len(sets)
    size = np.fromiter(map(len, sets), np.int64, m)
    low = np.arange(m)
    of = np.repeat(low, size)
    _, element = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(element, kind="stable")
    holders = of[order]
    start = np.searchsorted(element[order], np.arange(int(element.max(initial=-1)) + 2))
    many, first = np.diff(start), np.cumsum(size) - size
    for i in range(m):
        may = (low != low[i]) & (np.minimum(size, size[i]) >= similarity * np.maximum(size, size[i])) & ((side != side[i]) | (side == 0))
        may[:i] = False
        if not may.any():
            continue
        own = element[first[i] : first[i] + size[i]]
        place = np.arange(many[own].sum()) - np.repeat(np.cumsum(many[own]) - many[own], many[own]) + np.repeat(start[own], many[own])
        both = np.bincount(holders[place], minlength=m)
        hit = np.flatnonzero(may & (both >= similarity * (size + size[i] - both)))
        if len(hit):
            low = forest(m, np.r_[np.arange(m), np.full(len(hit), i)], np.r_[low, hit])
    return low


def _compare(similarity: float):
    """Batches of ``key, side, rep, own`` sorted by key -> links between reps."""

    def links(rows: list[tuple]) -> pa.RecordBatch:
        rep = np.array([r[2] for r in rows], np.int64)
        low = similar([np.frombuffer(r[3], np.uint64) for r in rows], np.array([r[1] for r in rows]), similarity)
        far = np.flatnonzero(low != np.arange(len(low)))
        return pa.RecordBatch.from_arrays([pa.array(rep[far]), pa.array(rep[low[far]])], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if row[0] != at:
                    if len(held) > 1:
                        yield links(held)
                    at, held = row[0], []
                held.append(row)
        if len(held) > 1:
            yield links(held)

    return run


def _sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [shingle_set(x.as_py(), shingle) for x in b.column(2)]
            cols = [b.column(0), b.column(1), pa.array([x.tobytes() for x in own], pa.binary()), pa.array([len(x) for x in own], pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, ["key", "rep", "own", "weight"])

    return run


def _identity(docs: DataFrame, *more) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("text_hash"), *more)


def _same(a: DataFrame, b: DataFrame):
    return a["doc_id"].eqNullSafe(b["_i"]) & (a["text_hash"] == b["_t"])


def groups(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """``docs(doc_id, text, ...)`` -> ``(doc_id, text_hash, n, set, root)``, a row for each different id and
    text: the rows that repeat it, its shingle set's name (a 64-bit hash) and that of its group."""
    spark = docs.sparkSession
    share_code(spark)
    sketch = in_arrow(_identity(docs, text_of()), _sketch(shingle), "doc_id long, text_hash long, set long, fp long, keys array<long>")
    texts = stored(sketch.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n"), *(F.min(c).alias(c) for c in ("set", "fp", "keys"))))
    values = stored(texts.groupBy("set").agg(F.min("fp").alias("fp"), F.min("keys").alias("keys"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("text_hash"))).alias("one"), F.count("*").alias("n")))
    rows = values.select(F.explode("keys").alias("key"), F.lit(0).alias("side"), "fp", F.col("set").alias("rep"))
    coarse = components(meet(rows, RADIUS))

    # one text of each set in a coarse group, with the group's root
    member = coarse.select(F.col("u").alias("set"), F.col("v").alias("key")).unionByName(coarse.select(F.col("v").alias("set"), F.col("v").alias("key")).distinct())
    chosen = stored(member.join(values.select("set", "one"), "set").select(F.col("one.doc_id").alias("_i"), F.col("one.text_hash").alias("_t"), "key", F.col("set").alias("rep")))
    rows = _identity(docs, text_of())
    rows = in_arrow(rows.join(chosen.hint("merge"), _same(rows, chosen)).select("key", "rep", "text"), _sets(shingle), "key long, rep long, own binary, weight long")
    rows = stored(rows.dropDuplicates(["rep"]))
    large = stored(rows.groupBy("key").agg(F.sum("weight").alias("weight")).where(F.col("weight") > TILE_SHINGLES).select("key"))
    run, columns = _compare(similarity), ["key", "side", "rep", "own"]
    plain = rows.join(large.hint("merge"), "key", "left_anti").withColumn("side", F.lit(0))
    links = in_arrow(plain.select(*columns).repartition("key").sortWithinPartitions("key"), run, "u long, v long")
    if not large.isEmpty():
        # sets of a like size: those of classes further apart than one differ by more than the similarity allows
        like = F.floor(F.log(F.greatest("weight", F.lit(1))) / F.lit(-np.log(similarity))).cast("int")
        big = rows.join(large.hint("merge"), "key", "left_semi").select("key", like.alias("p"), "rep", "own", F.col("rep").alias("id"), F.greatest("weight", F.lit(1)).alias("weight"))
        units = tile_pairs(big, TILE_SHINGLES // 2, 1).select(*columns)
        links = links.unionByName(in_arrow(units.repartition("key").sortWithinPartitions("key"), run, "u long, v long"))
    root = components(links)
    sized = values.select("set", "n").join(root.select(F.col("u").alias("set"), F.col("v").alias("root")), "set", "left")
    sized = stored(sized.select("set", "n", F.coalesce("root", "set").alias("root")))
    for used in (coarse, chosen, rows, large, root, values):
        discard(spark, used)
    total = sized.agg(F.sum("n")).first()[0] or 0
    return join_hot(texts.select("doc_id", "text_hash", F.col("n").alias("repeats"), "set"), sized, "set", total).select("doc_id", "text_hash", F.col("repeats").alias("n"), "set", "root")


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each group of near copies, all columns kept, whatever their names.

    Texts are copies if their sets of five-word shingles (ASCII letters in small; fewer words: the
    whole text) have a Jaccard similarity of 0.8 or more, and groups are what these links join. Each
    text is judged for itself, so two different texts under one doc_id are no copies. The row that
    stays has the smallest doc_id (a null comes last), then the smallest hash of its text, then, of
    rows that repeat both, the smallest JSON of all columns: a total order, the same on every run.

    Nulls: a null text is the empty one; a null doc_id is a row like any other. Empty and word-less
    texts are copies of one another. Very long texts are read whole. An empty table gives no rows. The
    buckets miss a link of similarity 0.8 with a probability of 0.0002, closer ones with less; texts are
    told apart by 64-bit hashes of their shingles and sets."""
    found = groups(docs, shingle, similarity)
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("text_hash"), F.col("n"))
    best = found.groupBy("root").agg(F.min(order).alias("b"))
    best = stored(best.select(F.col("b.doc_id").alias("_i"), F.col("b.text_hash").alias("_t"), F.col("b.n").alias("n")))
    rows = _identity(docs, F.struct(*map(quoted, docs.columns)).alias("row"))
    kept = rows.join(best.hint("merge"), _same(rows, best))
    more = kept.where("n > 1").groupBy("_i", "_t").agg(F.min_by("row", F.to_json("row")).alias("row"))
    out = kept.where("n = 1").select("row").unionByName(more.select("row"))
    return out.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
