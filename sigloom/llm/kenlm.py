"""Quality classifier: an interpolated modified Kneser-Ney model of trusted text, over words.

The model has word n-grams up to ``WORDS`` as 64-bit hashes; a word that trusted text does not have is
spelled by a Kneser-Ney model over characters (64 symbols, histories of three, inside the word), which
is the base distribution of the word model. Counts, continuation counts, history sums and probabilities
come from grouping n-grams by suffix and by history. Trigrams are dealt out as blocks of many, first by their last
word, where they meet its probability, then by their middle word, where all that is known of history and suffix
is at hand; those of a frequent word are dealt out by two words, as its own sums are known to all.

The logarithm of an interpolated model is a sum over a text's n-grams: a word's term, and for each
longer n-gram what it adds to the shorter one and what its history takes. So each n-gram has its weights,
and texts meet them in joins: n-grams of texts are packed by the shard of their weights, a row for a
chunk of texts and a shard, and a shard's weights are held against them by a sorted search. Shards grow
in number with the input. A trusted text is not measured with n-grams that only it has. A text's
perplexity is held against a quantile of the trusted texts of its language.

Nearly every n-gram is distinct, so counts and packed n-grams together are many times the input. They
are made in rounds of the hash of a trigram's middle word: a trigram's history, its suffix and that
one's history are of the same round, and only single words are counted over all. A round reads all texts
again, adds its sums to those of the texts, and leaves nothing else behind.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import partial, reduce
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import HOT_KEYS, discard, from_arrays, in_arrow, share_code, stored, text_of

ORDER = 4
BITS = 6
SYMBOLS = 1 << BITS
#: Share of a language's trusted texts that are above its threshold before the margin, in nats a
#: character, is added; and trusted texts below which all languages' threshold holds.
QUANTILE = 0.995
MARGIN = 0.05
MIN_TRUSTED = 50
GRID = 1000
CHUNK = 1 << 20
#: Characters that are hashed at once where words are all that is needed: what fits a core's cache.
SLICE = 1 << 18
#: Characters of all texts for each shard of the join and for each round, the most rounds, and characters
#: of the texts that are packed together; trigrams that are packed together; share of the base distribution that is a text's end; and steps of
#: a weight in a nat (whole numbers add up in any order).
SHARD = 32_000_000
ROUND = 8_000_000
ROUNDS = 12
PACK = 4 << 20
PACKED = 1 << 20
END = 0.01
STEPS = 1_000_000


def _symbol_table() -> np.ndarray:
    """Symbols of the first 0x250 code points: 0 space, 1-26 a-z, 27 A-Z, 28 digit, 29-31 marks,
    32-62 other letters, 63 other."""
    t = np.full(0x250, 63, np.uint8)
    for c in range(0x250):
        ch = chr(c)
        if ch.isspace():
            t[c] = 0
        elif "a" <= ch <= "z":
            t[c] = 1 + c - ord("a")
        elif ch.isalpha() and ch.isupper():
            t[c] = 27
        elif ch.isdigit():
            t[c] = 28
        elif ch in ".,;:!?":
            t[c] = 29
        elif ch in "'\"()[]{}-_/\\":
            t[c] = 30
        elif ch.isalpha():
            t[c] = 32 + c % 31
        elif c < 127 and ch.isprintable():
            t[c] = 31
    return t


_TABLE = _symbol_table()
_INSIDE = _TABLE != 0


def symbols(text: str) -> np.ndarray:
    """Symbol of each character; beyond the table, those of scripts are spread over the letters'."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = _TABLE[np.minimum(points, 0x24F)]
    far = points >= 0x250
    if far.any():
        out = np.where(far, np.where((points >= 0x2000) & (points < 0x2070), 30, 32 + points % 31), out).astype(np.uint8)
    return out


def codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """n-gram codes of ``ORDER`` symbols ending at each character of each text, with a space before
    the first and behind the last; and the number of codes of each text."""
    parts, size = [], []
    pad = np.zeros(ORDER - 1, np.uint8)
    for t in texts:
        parts += [pad, symbols(t), pad[:1]]
        size.append(len(parts[-2]) + 1)
    line = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
    code = np.zeros(len(line), np.int32)
    for k in range(ORDER):
        code[k:] |= line[: len(line) - k].astype(np.int32) << (BITS * k)
    n = np.array(size, np.int64)
    keep = np.ones(len(line), bool)
    start = np.cumsum(n + ORDER - 1) - (n + ORDER - 1)
    for k in range(ORDER - 1):
        keep[start + k] = False
    return code[keep], n


def _chunks(b: pa.RecordBatch, most: int | None = None) -> Iterator[tuple[int, list[str]]]:
    """First row and texts of parts of a batch of about ``CHUNK`` characters, or ``most`` if that is less."""
    most = min(CHUNK, most or CHUNK)
    texts, size = [], 0
    for k, x in enumerate(b.column(0)):
        texts.append(x.as_py())
        size += len(texts[-1])
        if size >= most:
            yield k + 1 - len(texts), texts
            texts, size = [], 0
    if texts:
        yield b.num_rows - len(texts), texts


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _pair(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    return _mix(a * np.uint64(0x9E3779B97F4A7C15) + b + np.uint64(n))


_BASE = 0x5851F42D4C957F2D
_BACK = pow(_BASE, -1, 1 << 64)
_START_WORD, _END_WORD = np.uint64(0x1234567), np.uint64(0x89ABCDEF)
_POWERS = np.zeros((2, 0), np.uint64)


def _powers(n: int) -> np.ndarray:
    """Powers of ``_BASE`` and of its inverse mod 2**64."""
    global _POWERS
    if _POWERS.shape[1] < n:
        steps = np.array([[_BASE], [_BACK]], np.uint64) * np.ones((1, n), np.uint64)
        steps[:, 0] = 1
        _POWERS = np.multiply.accumulate(steps, axis=1, dtype=np.uint64)
    return _POWERS


def _words(texts: list[str], points: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Position of the text and hash of each word, from where it starts and ends in the joined texts."""
    first = np.searchsorted(start, np.cumsum([0, *(len(t) + 1 for t in texts)]))
    of = np.repeat(np.arange(len(texts)), np.diff(first))
    power = _powers(len(points))
    total = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(np.multiply(points, power[0, : len(points)]), out=total[1:])
    return of, _mix((total[end] - total[start]) * power[1, start])


def spelled(texts: list[str]) -> tuple[np.ndarray, ...]:
    """Codes of the characters of each word and of the space behind it, with no history before the
    word; and of each word its first and behind its last code, its text's position and its hash."""
    line = " ".join([*texts, ""])
    points = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32)
    sym = symbols(line)
    code, past = sym.astype(np.int32), np.ones(len(sym), bool)
    for k in range(1, ORDER):
        past[k:] &= sym[: len(sym) - k] != 0
        past[:k] = False
        code[k:] |= np.where(past[k:], sym[: len(sym) - k], 0).astype(np.int32) << (BITS * k)
    inside = np.r_[False, sym != 0]
    start, end = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:])
    of, word = _words(texts, points, start, end)
    keep = sym != 0
    keep[end] = True
    at = np.cumsum(np.r_[0, keep])
    return code[keep], at[start], at[end] + 1, of, word


def _spelled_codes(texts: list[str]) -> tuple[np.ndarray]:
    return (spelled(texts)[0],)


def hashed(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The text's position and the hash of each word, as ``spelled`` has them."""
    points = np.frombuffer(" ".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = np.zeros(len(points) + 1, bool)
    np.take(_INSIDE, points, mode="clip", out=inside[1:])
    turn = np.flatnonzero(inside[1:] != inside[:-1])  # the last of all is a space
    return _words(texts, points, turn[::2], turn[1::2])


def _line(of: np.ndarray, word: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of ``n`` texts, each two start words, its words and its end; how many these are, and where they begin."""
    size = np.bincount(of, minlength=n) + 3
    top = np.cumsum(size) - size
    line = np.full(size.sum(), _START_WORD, np.uint64)
    line[np.arange(len(word)) + 3 * of + 2] = word
    line[top + size - 1] = _END_WORD
    return line, size, top


def chain(of: np.ndarray, word: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
    """Of ``n`` texts, each two start words, its words and its end: the text and the place inside it of each
    of these, the hashes of the 1, 2 and 3 words that end there, and where the texts end."""
    line, size, top = _line(of, word, n)
    one = _pair(line, line, 1)
    two = np.r_[np.uint64(0), _pair(line[:-1], line[1:], 2)]
    three = np.r_[np.zeros(2, np.uint64), _pair(two[1:-1], line[2:], 3)]
    return np.repeat(np.arange(n), size), np.arange(len(line)) - np.repeat(top, size), one, two, three, top + size - 1


def grams(texts: list[str], log_p: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Of texts: ``n, g, h, s, q, of, event`` of each n-gram of 1 to 3 words, those being its
    hash, history's and suffix's, log base probability if n is 1, text and whether it predicts a word
    (the start does not); the log base probability of all words and the characters of each text."""
    code, a, b, of, word = spelled(texts)
    sums = np.concatenate([[0], np.cumsum(log_p[code], dtype=np.float64)])
    q = sums[b] - sums[a] + np.log(1 - END)
    n = len(texts)
    text, inner, one, two, three, end = chain(of, word, n)
    lq = np.zeros(len(text))
    lq[np.arange(len(word)) + 3 * of + 2] = q
    lq[end] = np.log(END)
    i1, e = np.flatnonzero(inner >= 1), np.flatnonzero(inner >= 2)
    out = {
        "n": np.repeat(np.array([1, 2, 3], np.int32), [len(i1), len(i1), len(e)]),
        "g": np.r_[one[i1], two[i1], three[e]].view(np.int64),
        "h": np.r_[np.zeros(len(i1), np.uint64), one[i1 - 1], two[e - 1]].view(np.int64),
        "s": np.r_[np.zeros(len(i1), np.uint64), one[i1], two[e]].view(np.int64),
        "q": np.r_[lq[i1], np.zeros(len(i1) + len(e))],
        "of": np.r_[text[i1], text[i1], text[e]],
        "event": np.r_[inner[i1] >= 2, inner[i1] >= 2, np.ones(len(e), bool)],
    }
    base = np.bincount(text, lq, n)
    chars = np.bincount(of, b - a, n).astype(np.int64) + 1
    return out, base, chars


_TALLY = "g long, q double, c long"
#: The history of a text's first word, which nothing predicts.
_START = int(_pair(np.full(1, _START_WORD), np.full(1, _START_WORD), 2).view(np.int64)[0])
_ROUND_BITS = 40


def _of_round(one: np.ndarray, rounds: int, r: int) -> np.ndarray:
    return (one >> np.uint64(_ROUND_BITS)) % np.uint64(rounds) == np.uint64(r)


def _tally(model, name: str):
    """Base probability and count of each predicted word in a chunk of trusted texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log_p = _dense(model, name)
        for batch in batches:
            for _, texts in _chunks(batch):
                x, _, _ = grams(texts, log_p)
                single = x["event"] & (x["n"] == 1)
                g, at, c = np.unique(x["g"][single], return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(g), pa.array(x["q"][single][at]), pa.array(c.astype(np.int64))], list("gqc"))

    return run


def _block(*cols: np.ndarray) -> bytes:
    """Columns, the first ascending and so by differences, byte by byte of their places, compressed."""
    cols = np.r_[cols[0][:1], np.diff(cols[0])], *cols[1:]
    raw = b"".join(np.ascontiguousarray(v.view(np.uint8).reshape(len(v), -1).T).tobytes() for v in cols)
    return pa.compress(raw, "zstd", asbytes=True)


def _unblock(body: bytes, n: int, kinds: str) -> list[np.ndarray]:
    sizes = [np.dtype(k).itemsize for k in kinds]
    raw = np.frombuffer(pa.decompress(body, n * sum(sizes), "zstd", asbytes=True), np.uint8)
    ends = np.cumsum([0, *sizes]) * n
    cols = [np.ascontiguousarray(raw[i:j].reshape(-1, n).T).view(k).ravel() for i, j, k in zip(ends, ends[1:], kinds, strict=False)]
    return [np.cumsum(cols[0], dtype=cols[0].dtype), *cols[1:]]


def _dealt(shard: np.ndarray, shards: int, kind: int, *cols: np.ndarray, ids: bytes = b"") -> pa.RecordBatch:
    """A row for each shard: its part of the columns, of which the first ascends."""
    order = np.argsort(shard.astype(np.int32), kind="stable")
    cols = [v[order] for v in cols]
    cut = np.searchsorted(shard[order], np.arange(shards + 1))
    have = np.flatnonzero(cut[1:] > cut[:-1])
    body = [_block(*(v[cut[k] : cut[k + 1]] for v in cols)) for k in have]
    rows = [pa.array(have.astype(np.int32)), pa.array(np.full(len(have), kind, np.int32)), pa.array((cut[1:] - cut[:-1])[have].astype(np.int32)), pa.array(body, pa.binary()), pa.array([ids] * len(have), pa.binary())]
    return pa.RecordBatch.from_arrays(rows, ["shard", "kind", "n", "body", "id"])


def _find(table: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where ``x`` is in the ascending table, and whether it is."""
    if not len(table):
        return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(table, x), len(table) - 1)
    return at, table[at] == x


def _deal(hot: np.ndarray, one: np.ndarray, two: np.ndarray, shards: int) -> np.ndarray:
    """The shard of a word, of a frequent one that of the two words."""
    return np.where(_find(hot, one)[1], two, one) % np.uint64(shards)


def _edges(x: np.ndarray) -> np.ndarray:
    """Where ascending ``x`` has a new value."""
    return np.flatnonzero(np.r_[True, x[1:] != x[:-1]][: len(x)])


def _groups(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of ``x``, where in that order a new value begins, and of each row the number of its value."""
    order = np.argsort(x)
    edge = _edges(x[order])
    of = np.empty(len(x), np.int64)
    of[order] = np.repeat(np.arange(len(edge)), np.diff(np.r_[edge, len(x)]))
    return order, edge, of


def _trigrams(rounds: int, r: int, shards: int, hot: np.ndarray | None = None):
    """The round's trigrams of trusted texts that are packed together, word by word, and their counts: dealt
    out by their last word and, if that is frequent or ``hot`` is not given, the middle word as well."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _forget()
        held, size = [], 0

        def packed():
            b, c, a = (np.concatenate(v) for v in zip(*held, strict=True))
            order = np.lexsort((a, c, b)) if len(b) else np.zeros(0, np.int64)
            a, b, c = a[order], b[order], c[order]
            edge = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (c[1:] != c[:-1])][: len(a)])
            n = np.diff(np.r_[edge, len(a)]).astype(np.int64)
            a, b, c = a[edge], b[edge], c[edge]
            two = _pair(b, c, 2)
            shard = two % np.uint64(shards) if hot is None else _deal(hot, _pair(c, c, 1), two, shards)
            return _dealt(shard, shards, 0, b, c, a, n)

        for batch in batches:
            for _, texts in _chunks(batch, SLICE):
                line, _, top = _line(*hashed(texts), len(texts))
                here = np.ones(len(line), bool)
                here[top] = here[top + 1] = False
                e = np.flatnonzero(here)
                b = line[e - 1]
                e = e[_of_round(_pair(b, b, 1), rounds, r)]
                held.append((line[e - 1], line[e], line[e - 2]))
                size += len(e)
                if size >= PACKED:
                    yield packed()
                    held, size = [], 0
        if size:
            yield packed()

    return run


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[dict]]]:
    """The rows of each shard, which come together."""
    rows = (dict(zip(("shard", "kind", "n", "body", "id"), x, strict=True)) for b in batches for x in zip(*(c.to_pylist() for c in b.columns), strict=True))
    yield from groupby(rows, lambda r: r["shard"])


def _distinct(held: list[list[np.ndarray]]) -> tuple[np.ndarray, ...]:
    """Words and count of each trigram of several blocks."""
    b, c, a, n = (np.concatenate(v) for v in zip(*held, strict=True))
    order, edge, _ = _groups(_pair(_pair(a, b, 2), c, 3))
    first = order[edge]
    return a[first], b[first], c[first], np.add.reduceat(n[order], edge)


def _sums(k: np.ndarray, of: np.ndarray, size: int) -> list[np.ndarray]:
    """Sum of the counts of each group, and how many are 1, 2 and more."""
    return [np.bincount(of, k, size), *(np.bincount(of[m], minlength=size) for m in (k == 1, k == 2, k > 2))]


def _cut_of(n: list[np.ndarray], d: tuple[float, float, float]) -> np.ndarray:
    """Share that the discounts of ``_sums`` take."""
    return (n[1] * d[0] + n[2] * d[1] + n[3] * d[2]) / n[0]


def _minus(k: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return k - np.where(k == 1, d[0], np.where(k == 2, d[1], d[2]))


_CONTINUATIONS = [*"gkamno", *(f"t{j}" for j in range(1, 5)), *(f"b{j}" for j in range(1, 5))]


def _continuations(hot: np.ndarray):
    """Of each shard's trigrams: before how many words a word stands, the sums of the words behind a frequent one, and
    in one row how many trigrams and two words have a count of 1 to 4."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _shards(batches):
            a, b, c, n = _distinct([_unblock(r["body"], r["n"], _UUUI) for r in rows])
            order, edge, _ = _groups(_pair(b, c, 2))
            k = np.diff(np.r_[edge, len(b)])
            b, c = b[order[edge]], c[order[edge]]
            g, times = np.unique(_pair(c, c, 1), return_counts=True)
            at, often = _find(hot, _pair(b, b, 1))
            behind = _sums(k[often], at[often], len(hot))
            some = np.flatnonzero(behind[0])
            totals = [np.array([np.count_nonzero(v == j)]) for v in (n, k) for j in range(1, 5)]
            zeros = lambda m: np.zeros(m, np.int64)
            cols = [np.r_[g, hot[some]].view(np.int64), np.r_[times, zeros(len(some))], *(np.r_[zeros(len(g)), v[some].astype(np.int64)] for v in behind)]
            cols += [np.r_[v, zeros(len(cols[0]) - 1)] for v in totals]
            yield pa.RecordBatch.from_arrays([pa.array(v.astype(np.int64)) for v in cols], _CONTINUATIONS)

    return run


def kept(df: DataFrame) -> DataFrame:
    """``stored``, after which the shuffle files of the writing are removed at once."""
    conf, name = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(name, None)
    conf.set(name, "true")
    try:
        return stored(df)
    finally:
        conf.unset(name) if before is None else conf.set(name, before)


def _cut(k: str, d: tuple[float, float, float]):
    """Sum of the discounts of counts ``k``, from whole numbers, so in any order the same."""
    return F.count_if(F.col(k) == 1) * d[0] + F.count_if(F.col(k) == 2) * d[1] + F.count_if(F.col(k) > 2) * d[2]


def _less(k: str, d: tuple[float, float, float]):
    return F.col(k) - F.when(F.col(k) == 1, d[0]).when(F.col(k) == 2, d[1]).otherwise(d[2])


_PACKED = "shard int, kind int, n int, body binary, id binary"
_SUMS = "_row long, full long, others long, chars long"
#: Kinds of the columns of blocks of trigrams, of what is known of them, of single words and of weights.
_UUUI, _UUUIID, _UD, _UDI = ["u8", "u8", "u8", "i8"], ["u8", "u8", "u8", "i8", "i8", "f8"], ["u8", "f8"], ["u8", "f8", "i8"]


def _by_shard(rows: DataFrame, run, schema: str) -> DataFrame:
    return in_arrow(rows.repartition("shard").sortWithinPartitions("shard", "kind"), run, schema)


class Frequent(NamedTuple):
    """Words that are over 1/``HOT_KEYS`` of all, ascending; log probability of each, and of what is behind it
    the sum of counts and the log share that it leaves."""

    g: np.ndarray
    p: np.ndarray
    all: np.ndarray
    left: np.ndarray


def singles(texts: DataFrame, shared, name: str, rounds: int = 1, shards: int = 16) -> tuple[DataFrame, list[tuple[float, float, float]], float, Frequent]:
    """``texts(text)`` -> ``(g, p, w, c)`` of the single words, log probability, weight and count; the discounts of
    the three orders; the log share that single words leave to the base distribution; and the frequent words."""
    spark, have = texts.sparkSession, None
    own = in_arrow(texts.select("text"), _tally(shared, name), _TALLY).groupBy("g").agg(F.min("q").alias("q"), F.sum("c").alias("c"))
    own = kept(own)
    total = own.agg(F.sum("c")).first()[0] or 0
    often = own.where(F.col("c") * HOT_KEYS > total).select("g").toPandas().g.to_numpy(np.int64)
    # the start is no word that is predicted, but two words begin with it in every text
    hot = np.unique(np.r_[often.view(np.uint64), _pair(np.full(1, _START_WORD), np.full(1, _START_WORD), 1)])
    few = -(-rounds // 3)
    sums = ", ".join(f"{v} long" for v in _CONTINUATIONS)
    for r in range(few):
        x = _by_shard(in_arrow(texts.select("text"), _trigrams(few, r, shards), _PACKED), _continuations(hot), sums)
        x = x if have is None else x.unionByName(have)
        x, old = kept(x.groupBy("g").agg(*(F.sum(v).alias(v) for v in _CONTINUATIONS[1:]))), have
        if old is not None:
            discard(spark, old)
        have = x
    of = have.agg(F.sum("k").alias("all"), *(F.count_if(F.col("k") == j).alias(f"o{j}") for j in range(1, 5)), *(F.sum(v).alias(v) for v in _CONTINUATIONS[6:])).first()
    d = [discounts([int(of[f"{o}{j}"] or 0) for j in range(1, 5)]) for o in "obt"]
    left = (have.agg(_cut("k", d[0]).alias("cut")).first()["cut"] / of["all"]) if of["all"] else 1.0
    t = own.join(have.where("k > 0").select("g", "k"), "g")
    t = t.select("g", F.log(_less("k", d[0]) / F.lit(of["all"] or 1) + F.lit(left) * F.exp("q")).alias("p"), "q", "c")
    words = kept(t.select("g", "p", (F.col("p") - F.col("q") - F.lit(float(np.log(left)))).alias("w"), "c"))
    known = from_arrays(spark, g=hot.view(np.int64))
    x = have.join(F.broadcast(known), "g", "left_semi").toPandas().set_index("g").reindex(hot.view(np.int64), fill_value=0)
    p = words.join(F.broadcast(known), "g", "left_semi").select("g", "p").toPandas().set_index("g").reindex(hot.view(np.int64), fill_value=0.0).p.to_numpy()
    behind = [x[v].to_numpy(np.int64) for v in "amno"]
    with np.errstate(divide="ignore", invalid="ignore"):  # without trusted text nothing is behind a word
        frequent = Frequent(hot, p, behind[0], np.log(_cut_of(behind, d[1])))
    discard(spark, have)
    discard(spark, own)
    return words, d, float(np.log(left)), frequent


def _pack_words(shards: int, kind: int, *names: str):
    """Rows of words in blocks, a word in its own shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def packed():
            cols = [np.concatenate(v) for v in zip(*held, strict=True)]
            g = cols[0].view(np.uint64)
            order = np.argsort(g)
            return _dealt(g[order] % np.uint64(shards), shards, kind, g[order], *(v[order] for v in cols[1:]))

        for b in batches:
            held.append([b.column(b.schema.get_field_index(v)).to_numpy() for v in names])
            n += b.num_rows
            if n >= CHUNK:
                yield packed()
                held, n = [], 0
        if n:
            yield packed()

    return run


def _lower(shards: int, d: list[tuple[float, float, float]], hot: Frequent):
    """Trigrams with the count of their two last words and the log probability of their last, dealt out anew by the
    middle word or, if that is frequent, the two first; and the weights of two words that begin with a frequent one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _shards(batches):
            held, known = [], [(hot.g, hot.p)]
            for r in rows:
                held.append(_unblock(r["body"], r["n"], _UUUI)) if r["kind"] == 0 else known.append(_unblock(r["body"], r["n"], _UD))
            if not held:
                continue
            a, b, c, n = _distinct(held)
            del held
            order, edge, of = _groups(_pair(b, c, 2))
            first, k = order[edge], np.diff(np.r_[edge, len(b)])
            g, p = (np.concatenate(v) for v in zip(*known, strict=True))
            by = np.argsort(g, kind="stable")
            low = p[by][_find(g[by], _pair(c[first], c[first], 1))[0]]
            at, often = _find(hot.g, _pair(b[first], b[first], 1))
            j, at = first[often], at[often]
            w = np.log(_minus(k[often], d[1]) / hot.all[at] + np.exp(hot.left[at] + low[often])) - hot.left[at] - low[often]
            two, met = _pair(b[j], c[j], 2), np.bincount(of, n, len(edge)).astype(np.int64)[often]
            by = np.argsort(two)
            yield _dealt((two % np.uint64(shards))[by], shards, 0, two[by], w[by], met[by])
            k, low = k[of], low[of]
            by = np.argsort(b)
            a, b, c, n, k, low = (v[by] for v in (a, b, c, n, k, low))
            yield _dealt(_deal(hot.g, _pair(b, b, 1), _pair(a, b, 2), shards), shards, 1, b, c, a, n, k.astype(np.int64), low)

    return run


def _weigh(held: list[list[np.ndarray]], given: list[list[np.ndarray]], d: list[tuple[float, float, float]], hot: Frequent) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The n-grams of a shard in order, their weights in steps and their counts (very many for those of the start)."""
    parts = list(given)
    if held:
        b, c, a, n, k, low = (np.concatenate(v) for v in zip(*held, strict=True))
        h, s = _pair(a, b, 2), _pair(b, c, 2)
        order, edge, of_h = _groups(h)
        behind = _sums(n, of_h, len(edge))
        left2 = np.log(_cut_of(behind, d[2]))
        own = h[order[edge]]
        parts.append((~own, left2, np.where(own == np.uint64(_START % (1 << 64)), -1, behind[0].astype(np.int64))))
        order, edge, of_s = _groups(s)
        i, met = order[edge], np.bincount(of_s, n, len(edge)).astype(np.int64)
        one = _pair(b[i], b[i], 1)
        at, often = _find(hot.g, one)
        all1, left1 = hot.all[at].astype(np.float64), hot.left[at]
        rest = np.flatnonzero(~often)
        if len(rest):
            order, edge, of_b = _groups(one[rest])
            behind = _sums(k[i][rest], of_b, len(edge))
            log = np.log(_cut_of(behind, d[1]))
            all1[rest], left1[rest] = behind[0][of_b], log[of_b]
            parts.append((one[rest][order[edge]], log, np.full(len(edge), -1)))
        p2 = np.log(_minus(k[i], d[1]) / all1 + np.exp(left1 + low[i]))
        parts.append((s[i][rest], (p2 - left1 - low[i])[rest], met[rest]))
        p2, left2 = p2[of_s], left2[of_h]
        p3 = np.log(_minus(n, d[2]) / np.bincount(of_h, n)[of_h] + np.exp(left2 + p2))
        parts.append((_pair(h, c, 3), p3 - left2 - p2, n))
    g, w, c = (np.concatenate(v) for v in zip(*parts, strict=True))
    order = np.argsort(g)
    edge = _edges(g[order])
    w, c = np.add.reduceat(w[order], edge), np.maximum.reduceat(c[order], edge)
    return g[order][edge], np.round(w * STEPS).astype(np.int64), np.where(c < 0, 1 << 40, c)


def round_weights(texts: DataFrame, words: DataFrame, d: list[tuple[float, float, float]], hot: Frequent, shards: int = 16, rounds: int = 1, r: int = 0) -> DataFrame:
    """Blocks, by shard, from which ``_weigh`` makes the weights of a round's n-grams: trigrams by their middle word,
    two words by their first, histories by their last, and the round's words."""
    spark = texts.sparkSession
    tri = in_arrow(texts.select("text"), _trigrams(rounds, r, shards, hot.g), _PACKED)
    tri = tri.unionByName(in_arrow(words.select("g", "p"), _pack_words(shards, 1, "g", "p"), _PACKED))
    tri = _by_shard(tri, _lower(shards, d, hot), _PACKED)
    here = words.select("g", "w", "c")
    begun = np.flatnonzero(hot.all > 0)
    if len(begun):
        here = here.unionByName(from_arrays(spark, g=hot.g[begun].view(np.int64), w=hot.left[begun], c=np.full(len(begun), -1)))
    here = here.where(F.pmod(F.shiftrightunsigned("g", _ROUND_BITS), F.lit(rounds)) == r)
    return kept(tri.unionByName(in_arrow(here, _pack_words(shards, 0, "g", "w", "c"), _PACKED)))


def _weights(d: list[tuple[float, float, float]], hot: Frequent):
    """Weights row by row; those of histories have the n-gram itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _shards(batches):
            given, held = [], []
            for r in rows:
                given.append(_unblock(r["body"], r["n"], _UDI)) if r["kind"] == 0 else held.append(_unblock(r["body"], r["n"], _UUUIID))
            past = {int(v) for x in held for v in ~_pair(x[2], x[0], 2)}
            g, w, c = _weigh(held, given, d, hot)
            g = np.array([~np.uint64(v) if int(v) in past else v for v in g], np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in (g.view(np.int64), w, c)], list("gwc"))

    return run


def weights(texts: DataFrame, shared, name: str) -> tuple[DataFrame, float]:
    """``texts(text)`` -> ``(g, w, c)`` of all n-grams, in one round, and the log share that single words leave
    to the base distribution."""
    words, d, log_left, hot = singles(texts, shared, name)
    rows = _by_shard(round_weights(texts, words, d, hot), _weights(d, hot), "g long, w long, c long")
    return rows.groupBy("g").agg(F.sum("w").alias("w"), F.max("c").alias("c")), log_left


def _pack_texts(rounds: int, r: int, shards: int, hot: np.ndarray):
    """The round's n-grams of texts, each with its text among those packed together and its count there; two
    words as the history of a third are ``~g``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _forget()

        def packed(ids):
            g, of, shard = (np.concatenate(v) for v in zip(*held, strict=True))
            order = np.argsort(g, kind="stable")  # texts of one n-gram are in order already
            g, of = g[order], of[order]
            edge = np.flatnonzero(np.r_[True, (g[1:] != g[:-1]) | (of[1:] != of[:-1])][: len(g)])
            return _dealt(shard[order[edge]], shards, 2, g[edge], of[edge].astype(np.int32), np.diff(np.r_[edge, len(g)]).astype(np.int32), ids=ids.tobytes())

        for b in batches:
            row = b.column(1).to_numpy()
            held, first, size = [], 0, 0
            for a, texts in _chunks(b, SLICE):
                text, inner, one, two, three, _ = chain(*hashed(texts), len(texts))
                last = _of_round(one, rounds, r)
                before = np.r_[False, last[:-1]]
                i = np.flatnonzero((inner >= 1) & last)
                j, e = np.flatnonzero((inner >= 1) & before), np.flatnonzero((inner >= 2) & before)
                past = i[inner[i] >= 1]
                g = np.concatenate([one[i], ~two[past], two[j], three[e]])
                shard = [one[i] % np.uint64(shards), _deal(hot, one[past], two[past], shards), _deal(hot, one[j - 1], two[j], shards), _deal(hot, one[e - 1], two[e - 1], shards)]
                held.append([g, text[np.concatenate([i, past, j, e])] + a - first, np.concatenate(shard).astype(np.int32)])
                size += sum(map(len, texts))
                if size >= PACK:
                    yield packed(row[first : a + len(texts)])
                    held, first, size = [], a + len(texts), 0
            if held:
                yield packed(row[first:])

    return run


def _base(model, name: str, log_left: float):
    """Sums of texts by the base distribution alone, and their characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log_p = _dense(model, name)
        for b in batches:
            row = b.column(1).to_numpy()
            for a, texts in _chunks(b):
                x, base, chars = grams(texts, log_p)
                words = np.bincount(x["of"][(x["n"] == 1) & x["event"]], minlength=len(texts))
                base = np.round((base + words * log_left) * STEPS).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in (row[a : a + len(texts)], base, base, chars)], ["_row", "full", "others", "chars"])

    return run


def _meet(d: list[tuple[float, float, float]], hot: Frequent):
    """Sums of texts in each shard: of all their n-grams, and of those that others have as well. What
    gives the shard's weights comes first."""
    names = ["_row", "full", "others", "chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _shards(batches):
            given, held, table = [], [], None
            for r in rows:
                if r["kind"] < 2:
                    given.append(_unblock(r["body"], r["n"], _UDI)) if r["kind"] == 0 else held.append(_unblock(r["body"], r["n"], _UUUIID))
                    continue
                if table is None:
                    table = _weigh(held, given, d, hot) if held or given else ()
                    given, held = [], []
                if not table:
                    continue
                ids = np.frombuffer(r["id"], np.int64)
                g, of, own = _unblock(r["body"], r["n"], ["u8", "i4", "i4"])
                k, met = _find(table[0], g)
                k, of, own = k[met], of[met], own[met]
                # below 2**53, so sums of floats are exact
                part = table[1][k].astype(np.float64) * own
                full = np.bincount(of, part, len(ids)).astype(np.int64)
                others = np.bincount(of, np.where(table[2][k] > own, part, 0), len(ids)).astype(np.int64)
                some = np.flatnonzero(np.bincount(of, minlength=len(ids)))
                yield pa.RecordBatch.from_arrays([pa.array(v[some]) for v in (ids, full, others, np.zeros(len(ids), np.int64))], names)

    return run


def _count(batches: Iterator[pa.RecordBatch], of=codes) -> Iterator[pa.RecordBatch]:
    held = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(held, texts):
        got, n = np.unique(of(texts)[0], return_counts=True)
        keys, back = np.unique(np.r_[held[0], got], return_inverse=True)
        return keys, np.bincount(back, np.r_[held[1], n], len(keys)).astype(np.int64)

    for b in batches:
        for _, texts in _chunks(b):
            held = add(held, texts)
    yield pa.RecordBatch.from_arrays([pa.array(held[0]), pa.array(held[1])], ["g", "c"])


def counts(texts: DataFrame, of=codes) -> DataFrame:
    """``texts(text)`` -> ``(g, c)``, the count of each n-gram of characters of the highest order."""
    share_code(texts.sparkSession)
    each = in_arrow(texts.select(text_of()).where(F.length("text") > 0), partial(_count, of=of), "g long, c long")
    return each.groupBy("g").agg(F.sum("c").alias("c"))


def discounts(n: list[int]) -> tuple[float, float, float]:
    """D1, D2, D3+ of one order from its counts of counts n1..n4, kept in range where those are few."""
    y = n[0] / max(n[0] + 2 * n[1], 1)
    d = [k + 1 - (k + 2) * y * n[k + 1] / max(n[k], 1) for k in range(3)]
    return tuple(min(max(x, 0.1), k + 0.95) for k, x in enumerate(d))


def model(top: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """For orders 1 to ``ORDER``: ``(g, p)``, the discounted share of each n-gram, and ``(h, back)``,
    what each history leaves to the order below."""
    tables = [stored(top)]
    for n in range(ORDER - 1, 0, -1):
        suffix = F.col("g").bitwiseAND(F.lit((1 << (BITS * n)) - 1))
        tables.insert(0, stored(tables[0].groupBy(suffix.alias("g")).agg(F.count("*").alias("c"))))
    out = []
    for t in tables:
        few = t.agg(*(F.count_if(F.col("c") == k) for k in range(1, 5))).first()
        d = discounts([int(x) for x in few])
        cut = F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])
        t = t.withColumn("h", F.shiftright("g", BITS)).withColumn("d", cut)
        sums = t.groupBy("h").agg(F.sum("c").alias("all"), F.count_if(F.col("c") == 1).alias("n1"), F.count_if(F.col("c") == 2).alias("n2"), F.count_if(F.col("c") > 2).alias("n3"))
        left = (F.col("n1") * d[0] + F.col("n2") * d[1] + F.col("n3") * d[2]) / F.col("all")
        out.append((t.join(sums, "h").select("g", ((F.col("c") - F.col("d")) / F.col("all")).alias("p")), sums.select("h", left.alias("back"))))
    return out


def dense(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
    """Log probability of each n-gram's last symbol from ``(g, p, h, back)`` of each order."""
    below = np.full(SYMBOLS, 1 / SYMBOLS, np.float32)
    for n, (g, p, h, back) in enumerate(parts, 1):
        rest = np.ones(SYMBOLS ** (n - 1), np.float32)
        rest[h] = back
        # the order below, at the history without its first symbol: its table once for each such symbol
        now = np.repeat(rest, SYMBOLS)
        now.reshape(-1, len(below))[:] *= below
        now[g] += p.astype(np.float32)
        below = now
    return np.log(np.maximum(below, 1e-12, out=below), out=below)


_DENSE: dict[str, np.ndarray] = {}


def _dense(model, name: str) -> np.ndarray:
    """``name`` tells a worker that keeps a dense table whether it is this model's."""
    if name not in _DENSE:
        _DENSE.clear()
        _DENSE[name] = dense(model.value)
    return _DENSE[name]


def _forget() -> None:
    """Free the worker's dense table, which no round needs. (Functions within functions are sent with copies of the
    globals they name, so those cannot clear it themselves.)"""
    _DENSE.clear()


def quantiles(scored: DataFrame, q: float = QUANTILE, margin: float = MARGIN, least: int = MIN_TRUSTED) -> DataFrame:
    """``(lang, limit)`` from trusted rows ``(lang, nats)``, exact on a grid of 1/``GRID`` nats; the row of
    null language-and-all is ``(null, limit)`` with ``is_all`` set."""
    bins = scored.select("lang", F.ceil(F.col("nats") * GRID).cast("long").alias("bin")).groupBy("lang", "bin").count()
    bins = bins.withColumn("is_all", F.lit(0)).unionByName(bins.groupBy("bin").agg(F.sum("count").alias("count")).select(F.lit(None).cast("string").alias("lang"), "bin", "count", F.lit(1).alias("is_all")))
    by = Window.partitionBy("is_all", "lang")
    along = by.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bins = bins.withColumn("up_to", F.sum("count").over(along)).withColumn("all", F.sum("count").over(by))
    hit = bins.where((F.col("up_to") >= F.col("all") * q) & ((F.col("all") >= least) | (F.col("is_all") == 1)))
    return hit.groupBy("is_all", "lang").agg((F.min("bin") / GRID + margin).alias("limit"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs(doc_id, text, lang, ...)``, ``labels(doc_id, quality, ...)`` -> ``(doc_id, lang, trusted,
    perplexity, limit, kept)``, a row for each input row.

    Trusted are the documents labelled quality 1; all of them train and set the limits. A document
    is kept if its perplexity a character is within its language's limit; a language (or null) with
    under 50 trusted texts has that of all. Null counts as the empty text, whose end is scored. Without trusted text all is kept. Of repeated labels the higher counts; repeated rows
    repeat; a null doc_id is never trusted; empty tables give no rows; other columns are ignored."""
    spark = docs.sparkSession
    share_code(spark)
    good = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("long").alias("_id")).distinct().withColumn("trusted", F.lit(True))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), text_of())
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    rounds = min(ROUNDS, max(1, -(-size // ROUND)))
    shards = max(16, -(-size // (SHARD * rounds)))
    # The labels grow with the corpus, so they are never broadcast: texts meet them by id at every size,
    # in parts, of which one is dealt out at a time.
    part = lambda df, c, k: df.where(F.pmod(F.xxhash64(c), F.lit(min(rounds, 3))) == k)
    train = [kept(part(rows, "doc_id", k).join(part(good, "_id", k).hint("merge"), F.col("doc_id") == F.col("_id"), "left_semi").select("text")) for k in range(min(rounds, 3))]
    train = reduce(DataFrame.unionByName, train)
    parts = []
    for g, h in model(counts(train, _spelled_codes)):  # spelling: at most 64**4 rows each, 12 bytes a row
        x, y = g.toPandas(), h.toPandas()
        parts.append((x.g.to_numpy(np.int64), x.p.to_numpy(np.float64).astype(np.float32), y.h.to_numpy(np.int64), y.back.to_numpy(np.float64).astype(np.float32)))
    shared, name = spark.sparkContext.broadcast(parts), uuid.uuid4().hex
    # counts alone are made in a third of the rounds, so in more shards
    words, d, log_left, hot = singles(train, shared, name, rounds, max(16, -(-size // (SHARD * -(-rounds // 3)))))
    row = F.xxhash64("doc_id", "text").alias("_row")  # rows that repeat share it, and their sums' quotient
    keyed = rows.select("text", row)
    total = lambda df: df.groupBy("_row").agg(F.sum("full").alias("full"), F.sum("others").alias("others"), F.sum("chars").alias("chars"))
    sums = kept(total(in_arrow(keyed, _base(shared, name, log_left), _SUMS)))
    for r in range(rounds):
        table = round_weights(train, words, d, hot, shards, rounds, r)
        met = _by_shard(table.unionByName(in_arrow(keyed, _pack_texts(rounds, r, shards, hot.g), _PACKED)), _meet(d, hot), _SUMS)
        now = kept(total(met.unionByName(sums)))
        discard(spark, table)
        discard(spark, sums)
        sums = now
    discard(spark, train)
    discard(spark, words)
    scored = rows.select("doc_id", "lang", row)
    scored = scored.join(good.hint("merge"), scored["doc_id"] == good["_id"], "left").withColumn("trusted", F.coalesce("trusted", F.lit(False))).join(sums.hint("merge"), "_row")
    nats = -F.when(F.col("trusted"), F.col("others")).otherwise(F.col("full")) / F.col("chars") / STEPS
    scored = stored(scored.select("doc_id", "lang", "trusted", F.round(nats, 5).alias("nats")))
    limits = stored(quantiles(scored.where("trusted")))
    own = limits.where("is_all = 0").select(F.col("lang").alias("_lang"), F.col("limit").alias("_own"))
    of_all = limits.where("is_all = 1").select(F.max("limit")).first()[0]
    out = scored.join(own, scored["lang"].eqNullSafe(own["_lang"]), "left")
    limit = F.coalesce("_own", F.lit(of_all).cast("double"))
    return out.select("doc_id", "lang", "trusted", F.round(F.exp("nats"), 6).alias("perplexity"), F.round(F.exp(limit), 6).alias("limit"), F.coalesce(F.col("nats") <= limit, F.lit(True)).alias("kept"))
