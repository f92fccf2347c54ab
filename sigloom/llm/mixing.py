"""Mixing sources to target weights along a time-varying curriculum.

Targets come from water-filling over the (few) sources. Each source has a weight schedule over
training time from 0 to 1: its share times ``1 + slope * (2 t - 1)``. Its integral is the demand for
the source's words up to ``t``; a document standing at ``c`` cumulative words, in a fixed random order
of its source, is due when the demand reaches ``c``, so inverting the integral gives its position.
Everything is DataFrame operations; prefix sums run over hash buckets, whose number follows from that of
the rows, and over groups of buckets, so no source is one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, quoted, stored

WEIGHTS = (5, 2, 1)
#: Slope of each weight's schedule: heavy sources fade, light ones rise.
SLOPES = (-0.5, 0.0, 0.5)
MAX_REPEATS = 3
#: Rows of a bucket in expectation, at most, if all rows were of one source; hex digits of the order hash name it.
BUCKET_ROWS = 10_000


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _cycle(values: tuple, rank: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(rank, F.lit(len(values))) + 1).cast("int"))


def targets(sources: DataFrame, weights: tuple = WEIGHTS, slopes: tuple = SLOPES, repeats: int = MAX_REPEATS) -> DataFrame:
    """``(source, source_size)``, one row a source -> with weight, slope and target.

    Sources are ranked by code point, null last, and weigh ``weights`` in turn. The targets share the
    sum of all sizes; one at ``repeats`` times its source's size stays there and the rest is shared
    again by weight. Sorted by cap over weight, the level that fills all is the largest of those that
    result if exactly the sources before each row are at their caps."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.withColumn("rank", F.row_number().over(order) - 1)
    ranked = ranked.withColumn("weight", _cycle(weights, F.col("rank")).cast("long")).withColumn("slope", _cycle(slopes, F.col("rank")).cast("double"))
    ranked = ranked.withColumn("cap", F.col("source_size") * repeats)
    by_level = Window.orderBy((F.col("cap") / F.col("weight")).asc(), "rank")
    everything = Window.partitionBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = (F.sum("source_size").over(everything) - before) / left
    filled = ranked.withColumn("level", level).withColumn("level", F.max("level").over(everything))
    return filled.select("source", "source_size", "weight", "slope", F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")).alias("target"))


def _key(source: Column) -> Column:
    """The source as a key that is never null, so joins and windows on it share one partitioning."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit("-"))


def _ordered(docs: DataFrame, *more: Column) -> DataFrame:
    """``more`` and what decides a row's place: source, size, ``mark`` (its order hash) and ``tie``. A row
    without an id takes the hash of its text for one, so such rows are spread like any others."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = F.md5(text.cast("binary"))
    name = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.concat(F.lit("~"), own))
    source = F.col("source").cast("string")
    return docs.select(*more, F.col("doc_id").cast("long").alias("doc_id"), source.alias("source"), _key(source).alias("key"), words_in(text).alias("size"), F.md5(name.cast("binary")).alias("mark"), own.alias("tie"))


def _digits(rows: int) -> int:
    """Hex digits that name so many buckets that none has over ``BUCKET_ROWS`` rows in expectation."""
    n = 1
    while 16**n * BUCKET_ROWS < rows:
        n += 1
    return n


def _placed(rows: DataFrame, sized: DataFrame, plan: DataFrame, *ties: str) -> DataFrame:
    """``rows`` with ``from``, the words of its source before each row in hash order, and the source's
    plan. ``sized`` has the same sizes without the texts. The window and the join both need a source's
    bucket together, so the rows are dealt out once for both."""
    digits = _digits(sized.count())
    bucket, upper = F.substring("mark", 1, digits), F.substring("bucket", 1, digits // 2)
    sums = stored(sized.groupBy("key", bucket.alias("bucket")).agg(F.sum("size").alias("sum")).withColumn("upper", upper))
    before = lambda by, at: F.coalesce(F.sum("sum").over(Window.partitionBy(*by).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    top = sums.groupBy("key", "upper").agg(F.sum("sum").alias("sum")).select("key", "upper", before(["key"], "upper").alias("base"))
    sums = sums.select("key", "upper", "bucket", before(["key", "upper"], "bucket").alias("inner")).join(top, ["key", "upper"])
    base = sums.select("key", "bucket", (F.col("base") + F.col("inner")).alias("base")).join(plan.withColumn("key", _key(F.col("source"))).drop("source"), "key")
    along = Window.partitionBy("key", "bucket").orderBy("mark", "tie", *ties).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("bucket", bucket).withColumn("within", F.coalesce(F.sum("size").over(along), F.lit(0)))
    rows = rows.join(base.hint("merge"), ["key", "bucket"])
    return rows.withColumn("from", F.col("base") + F.col("within"))


def _taken(copy: Column) -> Column:
    """Words that a copy of a document contributes: those below the source's target."""
    left = F.round("target").cast("long") - copy * F.col("source_size") - F.col("from")
    return F.greatest(F.least(left, F.col("size")), F.lit(0)).cast("long")


def position(words: Column) -> Column:
    """Training time in [0, 1] at which the source's demand reaches ``words``: the root of
    ``slope * t**2 + (1 - slope) * t = words / target``, in the form that is stable at slope 0."""
    share = F.least(words / F.greatest(F.col("target"), F.lit(1e-9)), F.lit(1.0))
    one = F.lit(1.0) - F.col("slope")
    return 2 * share / (one + F.sqrt(F.greatest(one * one + 4 * F.col("slope") * share, F.lit(0.0))))


def _sources(sized: DataFrame) -> DataFrame:
    return targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")))


def plan(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text, source, ...)`` -> ``(doc_id, size, source_size, target, taken, position)``,
    a row for each input row, in training order of the first copy.

    Every copy of a source's documents, in the order of their MD5, takes up the next words of the
    source's target; the copy at the target's end gives only the words that fit, so a source's taken
    words are its rounded target and no document exceeds 3 times its size.

    Nulls: a null text has size 0; a null source is one more source, last in order; rows without an id
    are ordered by the hash of their text. Empty texts have size 0; nothing is taken of these, and
    their position is null. Very long texts are cut like others where a target ends. Ties: rows of
    one id stand in the order of their texts' hashes, and those of one text take the same words. Repeated
    rows are taken each on their own. An empty table gives no rows. Extra columns of any name are left out."""
    sized = stored(_ordered(docs))
    rows = _placed(sized, sized, _sources(sized))
    taken = sum((_taken(F.lit(k)) for k in range(1, MAX_REPEATS)), _taken(F.lit(0)))
    rows = rows.withColumn("taken", taken)
    at = F.when(F.col("taken") > 0, F.round(position(F.col("from").cast("double")), 9))
    return rows.select("doc_id", "size", "source_size", "target", "taken", at.alias("position")).orderBy("position", "doc_id")


def mix(docs: DataFrame) -> DataFrame:
    """The mix itself: ``docs`` with a row for each copy taken, in training order, its own columns
    only, whatever their names. The copy at a source's target is cut after the words that fit, which
    are then joined by spaces; others are whole. Of rows that repeat id and text, the hash of the other
    columns decides which is first. Nulls, empty and long texts and empty tables: as ``plan`` says."""
    others = F.xxhash64(F.to_json(F.struct(F.lit(0).alias("_"), *(quoted(n) for n in docs.columns if n != "text"))))
    rows = _ordered(docs, F.struct(*map(quoted, docs.columns)).alias("row"), others.alias("other"))
    sized = stored(rows.drop("row", "other"))
    whole = _placed(rows, sized, _sources(sized), "other")
    copies = F.array(*(F.struct(F.lit(k).alias("copy"), _taken(F.lit(k)).alias("words")) for k in range(MAX_REPEATS)))
    each = whole.select("*", F.explode(copies).alias("c")).where("c.words > 0")
    at = position(F.col("c.copy") * F.col("source_size").cast("double") + F.col("from"))
    text = F.col("row").getField("text")
    first = F.array_join(F.slice(F.regexp_extract_all(text.cast("string"), F.lit(WORD), F.lit(0)), F.lit(1), F.col("c.words").cast("int")), " ")
    cut = F.when(F.col("c.words") < F.col("size"), first).otherwise(text)
    out = each.select(F.col("row"), cut.alias("cut"), at.alias("at"), "mark", "tie", "other").sort("at", "mark", "tie", "other")
    return out.select(*(F.col("cut").alias(n) if n == "text" else F.col("row").getField(n).alias(n) for n in docs.columns))


ORACLE = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
  md5(coalesce(CAST(doc_id AS VARCHAR), '~' || md5(coalesce(text, '')))) AS mark, md5(coalesce(text, '')) AS tie FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rk FROM s),
w AS (SELECT *, CASE rk % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
  CASE rk % 3 WHEN 0 THEN -0.5::DOUBLE WHEN 1 THEN 0::DOUBLE ELSE 0.5::DOUBLE END AS slope, 3 * source_size AS cap FROM r),
l AS (SELECT *, (CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
  / CAST(sum(weight) OVER (ORDER BY cap / weight, rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level FROM w),
t AS (SELECT source, source_size, slope, least(CAST(cap AS DOUBLE), max(level) OVER () * weight) AS target FROM l),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.slope,
  CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.mark, d.tie ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
k AS (SELECT *, CAST(greatest(least(CAST(round(target) AS BIGINT) - start, size), 0) + greatest(least(CAST(round(target) AS BIGINT) - source_size - start, size), 0)
  + greatest(least(CAST(round(target) AS BIGINT) - 2 * source_size - start, size), 0) AS BIGINT) AS taken FROM p)
SELECT doc_id, size, source_size, target, taken, CASE WHEN taken > 0 THEN round(2 * least(start / greatest(target, 1e-9), 1.0)
  / (1.0 - slope + sqrt(greatest((1.0 - slope) * (1.0 - slope) + 4 * slope * least(start / greatest(target, 1e-9), 1.0), 0.0))), 9) END AS position FROM k
"""
