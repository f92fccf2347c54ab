"""Transcript parsing: a hidden Markov model over lines finds who speaks; turns are then rendered.

A message is cut at lines that open with a speaker marker. Each part gives evidence for each role:
the marker if there is one, the lengths and endings of its lines, its number of lines and words.
Emission and transition tables are counts over conversations whose roles are known. Viterbi runs in
ranges of ``RANGE`` turns: a range is first reduced to the best score from each role before it to each
role at its end, a scan over a conversation's ranges fixes the roles at their ends, and each range then
finds its path between these. So a conversation of any length is many tasks, and the path is exact.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import share_code, stored, text_of

ROLES = ("system", "user", "assistant")
RANGE = 1024
#: Added to each count, and the trust in a marker.
SMOOTH, MARKED = 0.5, 0.99999
# Fixed list: words that open a turn in transcripts, by role.
MARKERS = {"system": "system", "user": "user|human|me|q|customer|question", "assistant": "assistant|bot|ai|model|agent|a|answer"}
_OPEN = re.compile(rf"^[\s>*#\[<|]*(?:{'|'.join(f'(?P<{r}>{w})' for r, w in MARKERS.items())})[\]|>*]*\s*[:>]\s*", re.IGNORECASE)
WORD_STEPS = (0, 4, 8, 12, 20, 35, 60, 100, 200)
LINE_STEPS = (1, 2, 3, 5, 9)


def _step(n: int, steps: tuple[int, ...]) -> int:
    return sum(n > s for s in steps)


def parts(text: str) -> list[tuple[str | None, str]]:
    """The marker's role (None: none) and the text of each part of a message."""
    out: list[tuple[str | None, list[str]]] = []
    for line in text.split("\n"):
        role = None
        if m := _OPEN.match(line):
            role, line = m.lastgroup, line[m.end() :]
        if role or not out:
            out.append((role, [line]))
        else:
            out[-1][1].append(line)
    return [(role, "\n".join(lines)) for role, lines in out]


def observations(text: str) -> list[str]:
    """Features of a part: its lines', its number of lines and its words."""
    lines = text.split("\n")
    out = [f"lines{_step(len(lines), LINE_STEPS)}", f"words{_step(len(text.split()), WORD_STEPS)}"]
    for x in lines:
        out.append(f"line{_step(len(x.split()), WORD_STEPS)}")
        if x.rstrip().endswith("?"):
            out.append("asks")
        if x.lstrip()[:1] in ("-", "*", "|", "`"):
            out.append("listed")
    return out


class Model:
    """Log tables: ``start[r]``, ``step[r][s]``, ``emit[feature][r]``."""

    def __init__(self, start: dict, step: dict, emit: dict, total: dict):
        n = len(ROLES)
        first = sum(start.values()) + SMOOTH * n
        self.start = np.log([(start.get(r, 0) + SMOOTH) / first for r in ROLES])
        self.step = np.log([[(step.get((r, s), 0) + SMOOTH) / (sum(step.get((r, t), 0) for t in ROLES) + SMOOTH * n) for s in ROLES] for r in ROLES])
        kinds = {re.sub(r"\d+$", "", k) for k, _ in emit}
        size = {k: {r: sum(v for (f, x), v in emit.items() if x == r and re.sub(r"\d+$", "", f) == k) if k not in ("asks", "listed") else total.get(r, 0) for r in ROLES} for k in kinds}
        width = {"lines": len(LINE_STEPS) + 1, "words": len(WORD_STEPS) + 1, "line": len(WORD_STEPS) + 1, "asks": 2, "listed": 2}
        self.emit = {f: [math.log((emit.get((f, r), 0) + SMOOTH) / (size[re.sub(r"\d+$", "", f)][r] + SMOOTH * width[re.sub(r"\d+$", "", f)])) for r in ROLES] for f in {k for k, _ in emit}}

    def scores(self, role: str | None, text: str) -> np.ndarray:
        e = np.zeros(len(ROLES))
        seen = observations(text)
        many = max(1, len(seen) - 2)
        for k, f in enumerate(seen):
            e += np.array(self.emit.get(f, (0.0,) * len(ROLES))) * (1.0 if k < 2 else 1.0 / many)
        if role:
            e += np.log([MARKED if r == role else (1 - MARKED) / (len(ROLES) - 1) for r in ROLES])
        return np.round(e, 9)


def train(messages: DataFrame) -> Model:
    """Tables from ``messages(conv_id, turn, role, text)``: counts over all rows, with other and null roles,
    null turns and null conversations left out. Repeated rows count again; a conversation opens with the
    role of its smallest turn (of the smallest name, if rows share it); without rows all is even."""
    share_code(messages.sparkSession)
    known = messages.where(F.col("role").isin(*ROLES) & F.col("turn").isNotNull() & F.col("conv_id").isNotNull())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got: dict[tuple[str, str], int] = {}
            for role, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for f in observations(text):
                    got[f, role] = got.get((f, role), 0) + 1
            yield pa.RecordBatch.from_pydict({"f": pa.array([k for k, _ in got], pa.string()), "role": pa.array([r for _, r in got], pa.string()), "n": pa.array(got.values(), pa.int64())})

    emitted = known.select("role", text_of()).mapInArrow(count, "f string, role string, n long").groupBy("f", "role").agg(F.sum("n").alias("n"))
    turns = known.select("conv_id", F.col("turn").cast("long").alias("turn"), "role")
    then = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("role").alias("next"))
    pairs = turns.join(then, ["conv_id", "turn"]).groupBy("role", "next").count()
    first = turns.groupBy("conv_id").agg(F.min(F.struct("turn", "role")).alias("x")).select("x.role").groupBy("role").count()
    total = turns.groupBy("role").count()
    return Model({r["role"]: r["count"] for r in first.collect()}, {(r["role"], r["next"]): r["count"] for r in pairs.collect()}, {(r["f"], r["role"]): r["n"] for r in emitted.collect()}, {r["role"]: r["count"] for r in total.collect()})


def through(model: Model, e: np.ndarray, first: bool) -> np.ndarray:
    """Best score from each role before to each role at the end of a range; the first range of a
    conversation has the same row for each."""
    now = (model.start[None, :] if first else model.step) + e[0]
    now = np.broadcast_to(now, (len(ROLES), len(ROLES)))
    for x in e[1:]:
        now = (now[:, :, None] + model.step[None]).max(1) + x
    return now


def path(model: Model, e: np.ndarray, before: int | None, last: int | None) -> list[int]:
    """Best roles along a range after role ``before`` (None: it is the first), ending in ``last``."""
    score = (model.start if before is None else model.step[before]) + e[0]
    back = []
    for x in e[1:]:
        move = score[:, None] + model.step
        back.append(move.argmax(0))
        score = move.max(0) + x
    at = int(score.argmax()) if last is None else last
    out = [at]
    for b in reversed(back):
        at = int(b[at])
        out.append(at)
    return out[::-1]


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Whole groups of rows with equal first ``keys`` columns (no nulls), from batches that have them
    together. What is held are slices, put together once, when their group ends."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        value = np.stack([b.column(k).to_numpy() for k in range(keys)])
        edge = np.flatnonzero((value[:, 1:] != value[:, :-1]).any(0)) + 1
        for start, stop in zip([0, *edge.tolist()], [*edge.tolist(), b.num_rows], strict=True):
            key = tuple(value[:, start])
            if key != last and held:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(b.slice(start, stop - start))
    if held:
        yield pa.Table.from_batches(held)


def _cut(messages: DataFrame) -> DataFrame:
    """Messages with their range. Null turns stand first, in the order of their texts' hashes, and the
    upper bits of these are their ranges."""
    turn, h = F.col("turn").cast("long"), F.xxhash64(text_of())
    rank = F.coalesce(F.floor(turn / RANGE), F.shiftright(h, 52) - 2048 - (1 << 54)).cast("long")
    return messages.select(F.col("conv_id").cast("long").alias("conv_id"), rank.alias("range"), turn.alias("turn"), text_of(), h.alias("h"))


def _evidence(model: Model, texts: list[str]) -> tuple[np.ndarray, list[int], list[tuple[str | None, str]]]:
    cut = [parts(t) for t in texts]
    flat = [p for c in cut for p in c]
    return np.array([model.scores(*p) for p in flat]), [len(c) for c in cut], flat


def _turns(model: Model, texts: list[str], before: int | None, last: int | None) -> list[tuple[int, str, str]]:
    """Of each text: its parts, their roles, and the parts as canonical turns."""
    e, n, flat = _evidence(model, texts)
    names = [ROLES[r] for r in path(model, e, before, last)]
    out, at = [], 0
    for k in n:
        turns = "".join(f"<|{r}|>\n{t.strip()}\n<|end|>\n" for r, (_, t) in zip(names[at : at + k], flat[at : at + k], strict=True))
        out.append((k, ",".join(names[at : at + k]), turns))
        at += k
    return out


_PARSED = "conv_id long, turn long, n_parts long, roles string, rendered string"


def _rows(conv: pa.Array, turn: pa.Array, found: list[tuple[int, str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([conv, turn, *(pa.array([x[k] for x in found], t) for k, t in enumerate((pa.int64(), pa.string(), pa.string())))], [x.split()[0] for x in _PARSED.split(", ")])


def is_held_out(conv_id):
    """A quarter of the conversations, for a figure over what no table was counted from."""
    return F.coalesce(F.pmod(F.xxhash64(conv_id), F.lit(4)) == 0, F.lit(False))


def parse(messages: DataFrame, model: Model) -> DataFrame:
    """``messages(conv_id, turn, text, ...)`` -> ``(conv_id, turn, n_parts, roles, rendered)``, a row
    for each input row: the roles of its parts, comma-joined, and the parts as canonical turns.

    Nulls: a row with a null conv_id belongs to no conversation and is parsed alone; a null turn comes
    first in its conversation; a null text is the empty one, a turn without words. Empty texts are one
    part. Very long texts are cut and read whole. Ties: rows of one turn follow one another by their
    texts' hashes. Repeated rows are turns of their own. An empty table gives no rows. Extra columns
    of any name are left out. Rows that share conversation and turn are one range, so one task."""
    spark = messages.sparkSession
    share_code(spark)
    rows = _cut(messages)

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield _rows(b.column(0), b.column(1), [_turns(model, [x.as_py()], None, None)[0] for x in b.column(2)])

    lone = rows.where("conv_id is null").select("conv_id", "turn", "text").mapInArrow(alone, _PARSED)
    rows = rows.where("conv_id is not null")

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches, 2):
            e, _, _ = _evidence(model, g.column("text").to_pylist())
            m = [through(model, e, False), through(model, e, True)]
            yield pa.RecordBatch.from_pydict({"conv_id": pa.array([g.column(0)[0].as_py()], pa.int64()), "range": pa.array([g.column(1)[0].as_py()], pa.int64()), "inner": pa.array([m[0].ravel().tolist()], pa.list_(pa.float64())), "head": pa.array([m[1][0].tolist()], pa.list_(pa.float64()))})

    dealt = rows.repartition("conv_id", "range").sortWithinPartitions("conv_id", "range", "turn", "h").select("conv_id", "range", "turn", "text")
    ranges = stored(dealt.mapInArrow(reduce, "conv_id long, range long, inner array<double>, head array<double>"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches, 1):
            inner, head = g.column("inner").to_pylist(), g.column("head").to_pylist()
            score, back = np.array(head[0]), []
            for x in inner[1:]:
                move = score[:, None] + np.array(x).reshape(len(ROLES), len(ROLES))
                back.append(move.argmax(0))
                score = move.max(0)
            ends = [int(score.argmax())]
            for b in reversed(back):
                ends.append(int(b[ends[-1]]))
            ends = ends[::-1]
            yield pa.RecordBatch.from_pydict({"_c": g.column(0).combine_chunks(), "_r": g.column(1).combine_chunks(), "before": pa.array([None, *ends[:-1]], pa.int32()), "last": pa.array(ends, pa.int32())})

    ends = stored(ranges.repartition("conv_id").sortWithinPartitions("conv_id", "range").mapInArrow(scan, "_c long, _r long, before int, last int"))

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches, 2):
            found = _turns(model, g.column("text").to_pylist(), g.column("before")[0].as_py(), g.column("last")[0].as_py())
            yield _rows(g.column(0).combine_chunks(), g.column(2).combine_chunks(), found)

    known = rows.join(ends, (rows["conv_id"] == ends["_c"]) & (rows["range"] == ends["_r"]))
    known = known.repartition("conv_id", "range").sortWithinPartitions("conv_id", "range", "turn", "h").select("conv_id", "range", "turn", "text", "before", "last")
    return known.mapInArrow(render, _PARSED).unionByName(lone)
