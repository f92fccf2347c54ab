"""Benchmark decontamination by templates, in DataFrame operations alone.

Texts become templates: numbers, names and units turn into typed placeholders, marks go, letters are
lowered. Windows of ``WINDOW`` template words are hashed and joined with those of the benchmark, so a
question whose parameters were changed still meets its source. What met is held to its slots: along
one alignment a benchmark value has to stand for one document value and the other way round; windows
that are mostly slots do not count as templates. What templates leave out (such windows, items of under 5
words, names in other letters) is met by the words themselves in small letters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import quoted, stored, text_of

WINDOW = 8
#: Windows of an item that must be met: this share of them, or as many as a run of ``RUN`` words has.
SHARE = 0.5
RUN = 13
#: Benchmark windows up to which they are broadcast (about 40 bytes each), and flagged texts likewise.
MOST_BROADCAST = 500_000

NUMBER, NAME, UNIT = "", "", ""
# Fixed lists: words for numbers, and units of measure and money.
NUMERALS = "two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion dozen"
UNITS = "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms pound pounds lb lbs ounce ounces oz ton tons ml l liter liters litre litres gallon gallons cup cups s sec second seconds min minute minutes h hour hours day days week weeks month months year years hz khz mhz ghz w kw v volt volts watt watts percent degree degrees dollar dollars cent cents euro euros eur usd gbp mph kmh"

#: A capital and small letters in the middle of a sentence; the look-behind is tried at capitals only.
_NAME = r"\p{Lu}(?<=[\p{Ll}\p{N},;:] .)[\p{Ll}\p{M}]+(?!\p{L})"
#: What separates words: ASCII but letters and digits, and the marks of the common Unicode blocks.
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\xA9\xAB-\xB1\xB4\xB6-\xB8\xBB\xBF -⁯　-〃〈-】]+"
_DECIMAL = r"\d[.,]\d"


def _split(text: Column) -> Column:
    """Runs of letters and digits, a decimal being one of them; the first and last may be empty."""
    whole = F.when(text.rlike(_DECIMAL), F.regexp_replace(text, F.lit(r"(?<=\d)[.,](?=\d)"), F.lit(""))).otherwise(text)
    return F.split(whole, _BETWEEN)


def _inner(words: Column) -> Column:
    """Without the empty words at either end. To be given a column."""
    head, tail = (F.get(words, F.lit(0)) == "").cast("int"), (F.get(words, F.size(words) - 1) == "").cast("int")
    return F.when(head + tail > 0, F.slice(words, head + 1, F.greatest(F.size(words) - head - tail, F.lit(0)))).otherwise(words)


def words_of(text: Column) -> Column:
    """The words that ``template_words`` stand for, one for one."""
    return _split(text)


def named_words(text: Column) -> Column:
    """The words in small letters with names replaced."""
    return _split(F.lower(F.regexp_replace(text, F.lit(_NAME), F.lit(NAME))))


def _number(w: Column) -> Column:
    return w.between("0", "9\U0010ffff") | w.isin(*NUMERALS.split())


def template_words(named: Column) -> Column:
    """``named_words`` with numbers, and units behind numbers, replaced. To be given a column."""

    def one(w: Column, i: Column) -> Column:
        unit = w.isin(*UNITS.split()) & (i > 0) & _number(F.get(named, i - 1))
        return F.when(_number(w), F.lit(NUMBER)).when(unit, F.lit(UNIT)).otherwise(w)

    return F.transform(named, one)


def _hash(words: Column, at: Column | int, size: int) -> Column:
    """Hash of the ``size`` words from position ``at`` (from 0), null-free inside the array."""
    return F.xxhash64(*(F.get(words, (at + k) if isinstance(at, Column) else F.lit(at + k)) for k in range(size)))


def _some(words: Column, at: Column, size: int) -> Column:
    """Hash of four of the ``size`` words from position ``at``: windows that are equal have it in common."""
    return F.xxhash64(*(F.get(words, at + k) for k in (0, size // 3, 2 * size // 3, size - 1)))


def _is_slot(x: Column) -> Column:
    return x.isin(NUMBER, NAME, UNIT)


def _templates(texts: DataFrame, *keep: str, exact: bool = False) -> DataFrame:
    """``keep`` and the template words ``t`` of ``text``; if ``exact``, its words in small letters."""
    if exact:
        rows = texts.select(*keep, _split(F.lower(F.col("text"))).alias("n"))
        return rows.select(*keep, _inner(F.col("n")).alias("t"))
    rows = texts.select(*keep, named_words(F.col("text")).alias("n"))
    rows = rows.select(*keep, _inner(F.col("n")).alias("n"))
    return rows.select(*keep, template_words(F.col("n")).alias("t"))


def _benchmark(items: DataFrame, window: int, exact: bool) -> DataFrame:
    """``(h, item_id, at, size, item_windows, item_tmpl, item_words)``; an item of fewer words than
    the window is one window of its own size. Templates need 5 words and half of them no slots;
    ``item_windows`` counts the windows that are left. Items of one template whose values are equal at
    the same slots cannot be told apart by a changed copy: the smallest item_id stands for them, so a
    window of a template that very many items share has one row."""
    rows = _templates(items, "item_id", "text", exact=exact).withColumn("w", words_of(F.col("text")))
    rows = rows.withColumn("w", _inner(F.col("w")))
    if not exact:
        slot = F.zip_with("t", "w", lambda k, w: F.when(_is_slot(k), F.concat(k, F.lower(w))))
        rows = rows.withColumn("_s", slot).withColumn("_s", F.transform("_s", lambda x: F.coalesce(F.array_position(F.col("_s"), x), F.lit(0))))
        rows = rows.groupBy("t", "_s").agg(F.min(F.struct("item_id", "w")).alias("_r")).select("_r.item_id", "_r.w", "t")
    # stored, as a window would otherwise take the item's text apart anew
    rows = stored(rows.withColumn("size", F.least(F.lit(window), F.size("t"))).where(F.col("size") >= (1 if exact else 5)))
    each = rows.select("item_id", "t", "w", "size", F.explode(F.sequence(F.lit(1), F.size("t") - F.col("size") + 1)).alias("at"))
    each = each.select("item_id", "size", "at", F.slice("t", F.col("at"), F.col("size")).alias("item_tmpl"), F.slice("w", F.col("at"), F.col("size")).alias("item_words"))
    if not exact:
        each = each.where(2 * F.size(F.filter("item_tmpl", lambda y: ~_is_slot(y))) >= F.col("size"))
    each = each.join(each.groupBy("item_id").agg(F.count("*").cast("int").alias("item_windows")), "item_id")
    hashes = F.lit(None).cast("long")
    for size in range(1, window + 1):
        hashes = F.when(F.col("size") == size, _hash(F.col("item_tmpl"), 0, size)).otherwise(hashes)
    return each.select(hashes.alias("h"), "item_id", "at", "size", "item_windows", "item_tmpl", "item_words")


def matches(docs: DataFrame, items: DataFrame, window: int = WINDOW, exact: bool = False) -> DataFrame:
    """``(doc_id, text_hash, item_id, shift, at, pos, size, item_windows, slots)``: each document
    window that equals a benchmark window word for word, as a template or, if ``exact``, in small letters."""
    bench = stored(_benchmark(items.select("item_id", text_of()), window, exact))
    sizes = sorted(r["size"] for r in bench.select("size").distinct().collect()) or [window]  # at most `window` values
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of()).where(F.length("text") > 0)
    rows = _templates(rows.withColumn("text_hash", F.xxhash64("text")), "doc_id", "text_hash", "text", exact=exact)
    few = bench.count() <= MOST_BROADCAST

    def exploded(rows: DataFrame, size: int, *more: str) -> DataFrame:
        """A row for each window of a text whose ``_some`` words are those of a benchmark window, with its hash.
        The outer form has no filter on ``t`` inferred, which would be pushed down with all that makes ``t`` inside it."""
        at = rows.select("doc_id", "text_hash", "t", *more, F.posexplode_outer("t").alias("p", "_w"))
        at = at.where(F.col("p") <= F.size("t") - size)
        if few and size > 4:
            keys = bench.where(F.col("size") == size).select(_some(F.col("item_tmpl"), F.lit(0), size).alias("_k")).distinct()
            at = at.withColumn("_k", _some(F.col("t"), F.col("p"), size)).join(F.broadcast(keys), "_k", "left_semi")
        return at.withColumn("h", _hash(F.col("t"), F.col("p"), size)).drop("_w", "_k")

    got = None
    for size in sizes:
        of_size = bench.where(F.col("size") == size)
        if few:
            hit = exploded(rows, size, "text").join(F.broadcast(of_size), "h")
            hit = hit.select("doc_id", "text_hash", "text", "h", "p", F.slice("t", F.col("p") + 1, F.lit(size)).alias("tmpl"), *_ITEM)
            hit = hit.where(F.col("tmpl").eqNullSafe(F.col("item_tmpl"))).withColumn("w", words_of(F.col("text"))).withColumn("w", _inner(F.col("w")))
            hit = hit.withColumn("words", F.slice("w", F.col("p") + 1, F.lit(size)))
        else:
            # places first, as ids and hashes alone; then each text once, for the words at its own places
            place = exploded(rows, size).select("doc_id", "text_hash", "h", "p").join(of_size.select("h").distinct().hint("merge"), "h", "left_semi")
            place = place.groupBy(F.col("doc_id").alias("_i"), F.col("text_hash").alias("_h")).agg(F.collect_set(F.struct("p", "h")).alias("_places"))
            held = rows.join(place.hint("merge"), rows["doc_id"].eqNullSafe(place["_i"]) & (rows["text_hash"] == place["_h"]))
            held = held.withColumn("w", words_of(F.col("text"))).withColumn("w", _inner(F.col("w")))
            cut = F.transform("_places", lambda x: F.struct(x["p"].alias("p"), x["h"].alias("h"), F.slice("t", x["p"] + 1, F.lit(size)).alias("tmpl"), F.slice("w", x["p"] + 1, F.lit(size)).alias("words")))
            hit = held.select("doc_id", "text_hash", F.explode(cut).alias("x")).select("doc_id", "text_hash", "x.*").join(of_size.hint("merge"), "h")
            hit = hit.where(F.col("tmpl").eqNullSafe(F.col("item_tmpl")))
        hit = hit.select("doc_id", "text_hash", "p", "words", *_ITEM)
        got = hit if got is None else got.unionByName(hit)
    triples = F.zip_with(F.arrays_zip(F.col("item_tmpl").alias("k"), F.col("item_words").alias("was")), "words", lambda a, b: F.struct(a["k"].alias("k"), F.lower(a["was"]).alias("was"), F.lower(b).alias("now")))
    slots = F.when(F.exists("item_tmpl", _is_slot), F.filter(triples, lambda x: _is_slot(x["k"]))).otherwise(F.array().cast("array<struct<k:string,was:string,now:string>>"))
    return got.select("doc_id", "text_hash", "item_id", (F.col("p") + 1 - F.col("at")).alias("shift"), "at", (F.col("p") + 1).alias("pos"), "size", "item_windows", slots.alias("slots"))


_ITEM = ("item_id", "at", "size", "item_windows", "item_tmpl", "item_words")


def contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs(doc_id, text, ...)`` and ``items(item_id, text)`` -> a row for each document and item
    that it holds: ``(doc_id, text_hash, item_id, n_windows, item_windows, first_word, last_word,
    n_changed)``, the last the slots whose value differs from the benchmark's.

    An item is held if, along one alignment with consistent slots, a document meets half of the
    item's windows or as many as a run of 13 words has: of those that count as templates, or of all,
    as templates or as they stand in small letters. An item of under ``WINDOW`` words is one window,
    which has to stand whole; under 5 words it is met by its words in small letters alone. Of items
    that only differ in their values, the smallest item_id is reported for a changed copy; a verbatim
    copy is reported for its own item.

    Nulls: null texts hold nothing and a null item is none; a null doc_id is reported as null. Empty
    and word-less texts hold nothing. Very long texts are searched whole, a row for each window that
    is met. Ties: of alignments the one with most windows, then the first in the text. Rows that repeat
    a doc_id and text are reported once. Empty tables give no rows. Extra columns of any name are left out."""
    by_words = matches(docs, items, window, exact=True).withColumn("exact", F.lit(True))
    m = stored(matches(docs, items, window).withColumn("exact", F.lit(False)).unionByName(by_words))
    key = ["doc_id", "text_hash", "item_id", "shift"]
    runs = m.groupBy(*key).agg(
        F.count_distinct("at").alias("n_windows"),
        F.count_distinct(F.when(~F.col("exact"), F.col("at"))).alias("_as_templates"),
        F.max(F.when(~F.col("exact"), F.col("item_windows"))).alias("_templates"),
        F.max("item_windows").alias("item_windows"),
        F.min("pos").alias("first_word"),
        F.max(F.col("pos") + F.col("size") - 1).alias("last_word"),
    )
    most = F.lit(RUN - window + 1)
    # without an exact window ``item_windows`` is that of the templates
    enough = (F.col("n_windows") >= F.least(F.ceil(F.col("item_windows") * SHARE), most)) | (F.col("_as_templates") >= F.least(F.ceil(F.col("_templates") * SHARE), most))
    runs = runs.where(enough)
    pairs = m.where(F.size("slots") > 0).select(*key, F.explode("slots").alias("s")).select(*key, "s.*").distinct()
    changed = pairs.groupBy(*key).agg(
        F.count_distinct("k", "was").alias("_was"), F.count_distinct("k", "now").alias("_now"), F.count_distinct("k", "was", "now").alias("_pairs"), F.sum(F.when(F.col("was") != F.col("now"), 1).otherwise(0)).alias("n_changed")
    )
    same = [runs[k].eqNullSafe(changed[k]) for k in key]
    held = runs.join(changed, same[0] & same[1] & same[2] & same[3], "left").select(*(runs[c] for c in runs.columns), "_was", "_now", "_pairs", "n_changed")
    held = held.where(F.col("_pairs").isNull() | ((F.col("_pairs") == F.col("_was")) & (F.col("_pairs") == F.col("_now"))))
    best = F.max(F.struct("n_windows", -F.col("first_word"), "item_windows", "first_word", "last_word", F.coalesce("n_changed", F.lit(0)).alias("n_changed")))
    out = held.groupBy("doc_id", "text_hash", "item_id").agg(best.alias("b"))
    return out.select("doc_id", "text_hash", "item_id", "b.n_windows", "b.item_windows", "b.first_word", "b.last_word", "b.n_changed")


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item; all columns, whatever their names,
    and repeated rows are kept. Null and empty texts hold nothing and stay; a row is judged by its own
    id and text, so ids that are null or repeat do not matter; for the rest see ``contaminated``."""
    found = contaminated(docs, items)
    bad = stored(found.select(F.col("doc_id").alias("_i"), F.col("text_hash").alias("_h")).distinct())
    few = bad.count() <= MOST_BROADCAST
    rows = docs.select(F.struct(*map(quoted, docs.columns)).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("text_hash"))
    clean = rows.join(F.broadcast(bad) if few else bad.hint("merge"), rows["doc_id"].eqNullSafe(bad["_i"]) & (rows["text_hash"] == bad["_h"]), "left_anti")
    return clean.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
