"""Quality rules over repeated substrings, found with suffix arrays over code points.

Texts of a batch lie behind one another as code points. A window of ``MIN_REPEAT`` code points that a
text holds once is in no repeat of that length, so only the places of windows that come again, and the
places behind these, are sorted into a suffix array: by their windows first, then by prefix doubling.
Neighbours' longest common prefixes come from a binary search with prefix hashes. An interval of equal
prefixes that grows on neither side is a maximal repeat; the union of all spans, in code points of
words, gives the covered share, and the deepest interval the longest repeat.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import in_arrow, quoted, share_code, text_of

#: Bytes of a batch's texts that share one suffix array; a longer text has one of its own. A task holds
#: about 75 bytes for each code point of these; where all of a text repeats, about 220: 2.2 GB for 10 MB.
BATCH_BYTES = 1 << 20
#: Code points from which a repeat counts; shorter ones are common phrases.
MIN_REPEAT = 32
SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SCHEMA = "doc_id long, " + ", ".join(f"{x} long" for x in COUNTS) + ", n_maximal_repeats long, covered_chars long, longest_repeat_chars long"

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_SPACES = (9, 10, 11, 12, 13, 32)
_BASE = np.uint64(0x5851F42D4C957F2D)


def _powers(n: int) -> np.ndarray:
    """Powers 0 to n of ``_BASE``, mod 2**64."""
    out = np.full(n + 1, _BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out, dtype=np.uint64)


class Places:
    """Code points of texts, each text ended by a 0; ``code`` numbers them densely from 1."""

    def __init__(self, texts: list[str]):
        self.points = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.size = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.end = np.cumsum(self.size) - 1
        held = np.zeros(int(self.points.max(initial=0)) + 1, bool)
        held[self.points] = True
        number = np.cumsum(held).astype(np.int32)
        self.code = number[self.points]
        self.symbols = int(number[-1]) + 1
        self.code[self.end] = 0
        self.owner = np.repeat(np.arange(len(texts), dtype=np.int32), self.size)
        self.power = _powers(len(self.points))
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(self.code.astype(np.uint64) * self.power[:-1], dtype=np.uint64)])

    def same(self, i: np.ndarray, j: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the substrings of these lengths at i and at j > i have one hash."""
        a, b = self.sums[i + length] - self.sums[i], self.sums[j + length] - self.sums[j]
        return a * self.power[j - i] == b

    def repeated(self, least: int) -> np.ndarray:
        """Places whose window of ``least`` code points, all in one text, comes again in that text. The
        hashes may only name a place too many, which the suffix array then finds to stand alone."""
        n = len(self.points)
        at = np.flatnonzero(np.arange(n) + least <= self.end[self.owner])
        if not len(at):
            return at
        h = (self.sums[at + least] - self.sums[at]) * self.power[n - at]
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + self.owner[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        held = np.sort(h)
        more = held[1:][held[1:] == held[:-1]]
        if not len(more):
            return at[:0]
        more = more[np.r_[True, more[1:] != more[:-1]]]
        k = np.minimum(np.searchsorted(more, h), len(more) - 1) if len(more) < 64 else _find(more, h)
        return at[more[k] == h]


def _find(values: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Index in ``values`` (sorted) at which each h could stand; those that cannot are not searched."""
    bits = np.zeros(1 << 22, bool)
    low = np.uint64((1 << 22) - 1)
    bits[(values & low).astype(np.int64)] = True
    out = np.zeros(len(h), np.int64)
    some = np.flatnonzero(bits[(h & low).astype(np.int64)])
    out[some] = np.minimum(np.searchsorted(values, h[some]), len(values) - 1)
    return out


def suffix_array(p: Places, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes, in order within each text, of the places that ``least`` code points repeat at, with
    those that stand right behind such a window; and the common prefix of each with the one before, 0
    where it is shorter than ``least``.

    A suffix that is still tied after a doubling has repeated windows all along what was compared, so
    the place behind that is one of those held."""
    hot = p.repeated(least)
    if not len(hot):
        return hot, hot.copy()
    n = len(p.points)
    held = np.zeros(n, bool)
    held[hot] = held[hot + least] = True
    at = np.flatnonzero(held)
    m = len(at)
    bits = max(p.symbols.bit_length(), 1)
    each = 62 // bits
    code = np.concatenate([p.code, np.zeros(least + each, np.int32)])
    keys = []
    for first in range(0, least, each):
        key = np.zeros(m, np.int64)
        for k in range(first, min(first + each, least)):
            key = key << bits | code[at + k]
        keys.append(key)
    order = np.lexsort([*reversed(keys), p.owner[at]])
    new = np.ones(m, bool)
    new[1:] = p.owner[at[order[1:]]] != p.owner[at[order[:-1]]]
    for key in keys:
        sorted_key = key[order]
        new[1:] |= sorted_key[1:] != sorted_key[:-1]
    rank = np.empty(m, np.int64)  # of a group: the number of smaller suffixes
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(m), 0))
    place = np.zeros(n + 1, np.int32)
    place[at] = np.arange(m)
    step = least
    while step < n:
        tied = np.flatnonzero(np.bincount(rank, minlength=m)[rank] > 1)
        if not len(tied):
            break
        key = rank[tied] * (m + 1) + rank[place[np.minimum(at[tied] + step, n)]] + 1
        by = np.argsort(key, kind="stable")
        k, base = key[by], rank[tied[by]]
        start = np.maximum.accumulate(np.where(np.r_[True, base[1:] != base[:-1]], np.arange(len(k)), 0))
        inner = np.maximum.accumulate(np.where(np.r_[True, k[1:] != k[:-1]], np.arange(len(k)), 0)) - start
        rank[tied[by]] += inner
        step *= 2
    suffix = np.empty(m, np.int64)
    suffix[rank] = at
    return suffix, _common(p, suffix, least)


def _common(p: Places, suffix: np.ndarray, least: int) -> np.ndarray:
    """LCP of each suffix with the one before it, where it is at least ``least``."""
    lcp = np.zeros(len(suffix), np.int64)
    a, b = suffix[:-1], suffix[1:]
    i, j = np.minimum(a, b), np.maximum(a, b)
    most = np.where(p.owner[a] == p.owner[b], p.end[p.owner[j]] - j, 0)
    live = np.flatnonzero(most >= least)
    live = live[p.same(i[live], j[live], np.int64(least))]
    i, j, low, high = i[live], j[live], np.full(len(live), least, np.int64), most[live]
    while (low < high).any():
        middle = (low + high + 1) // 2
        ok = p.same(i, j, middle)
        low, high = np.where(ok, middle, low), np.where(ok, high, middle - 1)
    lcp[1:][live] = low
    return lcp


def interval_starts(code: np.ndarray, suffix: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """Text positions of the first suffix of each LCP interval that is maximal to the left."""
    live = np.flatnonzero(lcp)
    if not len(live):
        return np.zeros(0, np.int64)
    before = np.where(suffix > 0, code[np.maximum(suffix, 1) - 1], -1)
    before[before == 0] = -1  # a text's first suffix
    before, values = before.tolist(), lcp.tolist()
    out: list[int] = []
    stack: list[list[int]] = []  # open intervals: depth, first index, value before its suffixes (-2: several)

    def close(depth: int, first: int, left: int) -> tuple[int, int]:
        """Close what is deeper than ``depth``, handing on to each parent what stands before its child's
        suffixes; returns where an interval of ``depth`` would begin, and what stands before that."""
        while stack and stack[-1][0] > depth:
            _, first, left = stack.pop()
            if left == -2:
                out.append(first)
            if stack and stack[-1][0] >= depth:
                stack[-1][2] = left if stack[-1][2] == left else -2
        return first, left

    last = -2
    for i in live.tolist():
        if i != last + 1:
            close(0, 0, 0)
        last, depth = i, values[i]
        first, left = close(depth, i - 1, before[i - 1])
        if not stack or stack[-1][0] < depth:
            stack.append([depth, first, left])
        if stack[-1][2] != before[i]:
            stack[-1][2] = -2
    close(0, 0, 0)
    return suffix[np.array(out, np.int64)] if out else np.zeros(0, np.int64)


def repeats(texts: list[str], least: int = MIN_REPEAT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each text: its maximal repeats of ``least`` code points or more, the code points of words
    that these cover, and the code points of the longest.

    The longest repeat at a suffix is the larger of its LCPs with its neighbours. It is the start of
    a left-maximal one unless every occurrence has the same value before it, in which case the repeat
    one place earlier covers the same span and more; so its span adds nothing and may be kept."""
    p = Places(texts)
    n, many = len(p.points), len(texts)
    suffix, lcp = suffix_array(p, least)
    if not len(suffix):
        return (np.zeros(many, np.int64),) * 3
    deep = np.maximum(lcp, np.r_[lcp[1:], 0])
    reach = np.arange(n)
    reach[suffix] += deep
    covered = np.maximum.accumulate(reach) > np.arange(n)
    covered &= ~np.isin(p.points, _SPACES)
    best = np.zeros(many, np.int64)
    np.maximum.at(best, p.owner[suffix], deep)
    found = np.bincount(p.owner[interval_starts(p.code, suffix, lcp)], minlength=many)
    return found, np.bincount(p.owner[covered], minlength=many), best


def _repeat_words(spaced: list[list[bytes]]) -> np.ndarray:
    """Of each text, the words in 3-word windows that it holds at least twice."""
    ids: defaultdict[bytes, int] = defaultdict(count(1).__next__)
    number = ids.__getitem__
    size = np.fromiter(map(len, spaced), np.int64, len(spaced)) + 1
    flat: list[int] = []
    for words in spaced:
        flat += map(number, words)
        flat.append(0)
    word, owner = np.array(flat, np.int64), np.repeat(np.arange(len(spaced)), size)
    n = len(word)
    at = np.flatnonzero(np.arange(n) + 2 < (np.cumsum(size) - 1)[owner])
    pair = owner[at] * (len(ids) + 1) + word[at]  # below 2**63: texts times words of a batch
    for k in (1, 2):
        _, pair = np.unique(pair, return_inverse=True)
        pair = pair * (len(ids) + 1) + word[at + k]
    _, back, times = np.unique(pair, return_inverse=True, return_counts=True)
    hit = np.zeros(n + 2, bool)
    twice = at[times[back] > 1]
    for k in range(3):
        hit[twice + k] = True
    return np.bincount(owner[hit[:n]], minlength=len(spaced))


def _dup_lines(text: bytes) -> int:
    seen: set[bytes] = set()
    twice = 0
    for x in text.split(b"\n"):
        if x in seen:
            twice += 1
        elif x and not x.isspace():
            seen.add(x)
    return twice


def measure(texts: list[bytes]) -> list[np.ndarray]:
    """The columns of ``SCHEMA`` behind the id, for UTF-8 texts; one suffix array serves all of them."""
    spaced = [t.split() for t in texts]
    raw = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([0, *map(len, texts)])
    space = np.zeros(256, bool)
    space[list(_SPACES)] = True
    along = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[ends])
    chars = along((raw & 0xC0) != 0x80) - along(space[raw])
    found, cover, best = repeats([t.decode("utf-8", "replace") for t in texts])
    words = np.fromiter(map(len, spaced), np.int64, len(texts))
    lines = np.fromiter(map(_dup_lines, texts), np.int64, len(texts))
    return [words, chars, along(_SYMBOL[raw]), lines, _repeat_words(spaced), found, cover, best]


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    for b in batches:
        held, rows, size = [], [], 0
        for x in b.column(1):
            held.append(x.as_buffer().to_pybytes() if x.is_valid else b"")
            size += len(held[-1])
            if size >= BATCH_BYTES:
                rows.append(measure(held))
                held, size = [], 0
        if held:
            rows.append(measure(held))
        cols = [np.concatenate(c).astype(np.int64) for c in zip(*rows, strict=True)] if rows else [np.zeros(0, np.int64)] * (len(names) - 1)
        yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, cols)], names)


def measures(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text, ...)`` -> a row for each input row with the counts of ``SCHEMA``; for nulls
    and other cases see ``verdicts``."""
    share_code(docs.sparkSession)
    text = text_of().cast("binary").alias("text")
    return in_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text), _batches, SCHEMA)


def _verdict(m: DataFrame, min_words: int = 50, max_repeat: float = 0.5, max_covered: float = 0.35, max_longest: int = 1000, max_longest_share: float = 0.25) -> DataFrame:
    n = F.col("n_words")
    share = F.when(F.col("word_chars") > 0, F.col("covered_chars") / F.col("word_chars")).otherwise(F.lit(0.0))
    base = (n < min_words) | (F.col("n_repeat_words") > max_repeat * n)
    long = (F.col("longest_repeat_chars") > max_longest) & (F.col("longest_repeat_chars") > max_longest_share * F.col("word_chars"))
    return m.withColumn("covered_share", share).withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & (F.col("covered_share") <= max_covered) & ~long)


def verdicts(docs: DataFrame, **limits: float) -> DataFrame:
    """``docs(doc_id, text, ...)`` -> counts, ``base_failed``, ``covered_share`` and ``kept``.

    The base rule rejects a text of under ``min_words`` (50) words or with over ``max_repeat`` (half) of
    them in 3-word windows that occur again. The suffix-array rule rejects one whose maximal repeats
    (``MIN_REPEAT`` code points or more) cover over ``max_covered`` (0.35) of the code points of its
    words, or whose longest repeat has over ``max_longest`` (1000) code points and over
    ``max_longest_share`` (a quarter) of them. All is counted in code points, so a text's alphabet does
    not matter, and repeats are found inside unspaced text as well.

    Nulls: a null text is the empty one, a null doc_id is carried. Empty and word-less texts fail the
    base rule. Very long texts are measured whole; see ``BATCH_BYTES`` for memory. Ties: none, each row
    is judged alone. Repeated rows: each has its row. An empty table gives no rows. Extra columns of
    any name are left out. Two unequal substrings of one 64-bit hash would count as equal."""
    return _verdict(measures(docs), **limits)


def keep(docs: DataFrame, **limits: float) -> DataFrame:
    """The rows of ``docs`` that ``verdicts`` keeps, with all of their columns, whatever their names.
    The id is not needed: text and verdict stay in one row, so nothing is joined or dealt out. Nulls,
    empty and long texts, repeated rows and empty tables: as ``verdicts`` says."""
    share_code(docs.sparkSession)
    names = docs.columns
    row = docs.select(F.struct(*map(quoted, names)).alias("row"), text_of().cast("binary").alias("text"))
    passed = in_arrow(row.select("text", "row"), _beside, StructType([StructField("row", docs.schema), *(StructField(x.split()[0], LongType()) for x in SCHEMA.split(", ")[1:])]))
    kept = _verdict(passed, **limits).where("kept")
    return kept.select(*(F.col("row").getField(n).alias(n) for n in names))


def _beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``text, row`` -> the row with the counts of its text."""
    for b in batches:
        ids = pa.array(np.zeros(b.num_rows, np.int64))
        for m in _batches(iter([pa.RecordBatch.from_arrays([ids, b.column(0)], ["doc_id", "text"])])):
            yield pa.RecordBatch.from_arrays([b.column(1), *m.columns[1:]], ["row", *m.schema.names[1:]])
