"""Stateful stream operators, each with a batch twin that gives the same rows.

State is one small record a stream key; order within a key is that of arrival, as a source that
replays a log gives it. Watermarks are not needed for results, only to let idle state go.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

SEQ_SCHEMA = "key string, seq long, verdict string, missing long"
WINDOW_SCHEMA = "key string, seq long, n long, ts_first long, v_sum long"
PROGRESS_SCHEMA = "key string, events long, last_ts long, last_state string, done boolean"


def sequence_verdicts(rows: DataFrame) -> DataFrame:
    """Batch twin of ``stream_sequence``: rows ``(key, arrival, seq)``; a row at or below the highest
    sequence so far is a repeat, one beyond the next is a gap with the number missing before it."""
    before = Window.partitionBy("key").orderBy("arrival").rowsBetween(Window.unboundedPreceding, -1)
    top = F.max("seq").over(before)
    verdict = F.when(top.isNull(), "first").when(F.col("seq") <= top, "repeat").when(F.col("seq") > top + 1, "gap").otherwise("ok")
    missing = F.when(F.col("seq") > top + 1, F.col("seq") - top - 1).otherwise(0)
    return rows.select("key", "seq", verdict.alias("verdict"), missing.alias("missing"))


def _sequence(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    top = state.get[0] if state.exists else None
    out = []
    for b in batches:
        for seq in b.sort_values("arrival")["seq"].tolist():
            if top is None:
                out.append((key[0], seq, "first", 0))
            elif seq <= top:
                out.append((key[0], seq, "repeat", 0))
            else:
                out.append((key[0], seq, "gap" if seq > top + 1 else "ok", seq - top - 1))
            top = seq if top is None else max(top, seq)
    if top is not None:
        state.update((top,))
    yield pd.DataFrame(out, columns=["key", "seq", "verdict", "missing"])


def stream_sequence(rows: DataFrame) -> DataFrame:
    """Verdicts over a stream of ``(key, arrival, seq)``."""
    return rows.groupBy("key").applyInPandasWithState(_sequence, SEQ_SCHEMA, "top long", "append", GroupStateTimeout.NoTimeout)


def count_windows(rows: DataFrame, size: int, expected: int, tolerance: int) -> DataFrame:
    """Batch twin of ``stream_windows``: complete windows of ``size`` samples of ``(key, arrival, ts, v)``.

    A timestamp that does not advance drops the partial window and the sample; a step beyond the
    expected one by more than the tolerance drops the partial window and starts anew with the sample.
    Every sample kept or dropped advances nothing but the windows that are complete get numbers, and a
    dropped partial window takes one, so holes can be seen."""
    near = min(tolerance, (expected - 1) // 2)
    w = Window.partitionBy("key").orderBy("arrival")
    top = F.max("ts").over(w.rowsBetween(Window.unboundedPreceding, -1))
    back = F.coalesce(F.col("ts") <= top, F.lit(False))
    gap = F.coalesce(~back & (F.col("ts") - top > expected + near), F.lit(False))
    marked = rows.withColumns({"_back": back, "_gap": gap})
    marked = marked.withColumn("_piece", F.sum((F.col("_back") | F.col("_gap")).cast("int")).over(w)).where(~F.col("_back"))
    within = Window.partitionBy("key", "_piece").orderBy("arrival")
    placed = marked.withColumn("_k", F.floor((F.row_number().over(within) - 1) / size))
    each = placed.groupBy("key", "_piece", "_k").agg(F.count("*").alias("n"), F.min("ts").alias("ts_first"), F.sum("v").alias("v_sum"), F.min("arrival").alias("_at"))
    last = Window.partitionBy("key").orderBy("_at")
    pieces = Window.partitionBy("key").orderBy(F.desc("_at"))
    numbered = each.withColumn("seq", F.row_number().over(last) - 1).withColumn("_open", (F.row_number().over(pieces) == 1) & (F.col("n") < size))
    return numbered.where(F.col("n") == size).select("key", F.col("seq").cast("long").alias("seq"), "n", "ts_first", "v_sum")


def _windows(size: int, expected: int, tolerance: int):
    near = min(tolerance, (expected - 1) // 2)

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seq, n, first, total, top = state.get if state.exists else (0, 0, 0, 0, None)
        out = []
        for b in batches:
            b = b.sort_values("arrival")
            for ts, v in zip(b["ts"].tolist(), b["v"].tolist(), strict=True):
                if top is not None and ts <= top:
                    seq, n = seq + (n > 0), 0
                    continue
                if top is not None and ts - top > expected + near:
                    seq, n = seq + (n > 0), 0
                if n == 0:
                    first, total = ts, 0
                n, total, top = n + 1, total + v, ts
                if n == size:
                    out.append((key[0], seq, n, first, total))
                    seq, n = seq + 1, 0
        state.update((seq, n, first, total, top))
        yield pd.DataFrame(out, columns=["key", "seq", "n", "ts_first", "v_sum"])

    return run


def stream_windows(rows: DataFrame, size: int, expected: int, tolerance: int) -> DataFrame:
    """Complete count windows over a stream of ``(key, arrival, ts, v)``."""
    return rows.groupBy("key").applyInPandasWithState(_windows(size, expected, tolerance), WINDOW_SCHEMA, "seq long, n long, first long, total long, top long", "append", GroupStateTimeout.NoTimeout)


def progress(rows: DataFrame) -> DataFrame:
    """Fold of an operation's events ``(key, ts, state)`` into its last state; an end state stays."""
    ended = F.min_by("state", F.struct("ts", "arrival"))
    over = rows.where(F.col("state").isin("done", "error")).groupBy("key").agg(ended.alias("_end"))
    g = rows.groupBy("key").agg(F.count("*").alias("events"), F.max("ts").alias("last_ts"), F.max_by("state", F.struct("ts", "arrival")).alias("_last"))
    return g.join(over, "key", "left").select("key", "events", "last_ts", F.coalesce("_end", "_last").alias("last_state"), F.col("_end").isNotNull().alias("done"))


def fan_out(batch: DataFrame, epoch: int, sinks: dict) -> dict[str, str]:
    """One micro-batch to every sink; one that fails does not stop the others. Returns the errors."""
    kept, errors = batch.persist(), {}
    try:
        for name, sink in sinks.items():
            try:
                sink(kept, epoch)
            except Exception as e:  # noqa: BLE001  the sink is someone else's code
                errors[name] = f"{type(e).__name__}: {e}"
    finally:
        kept.unpersist()
    return errors


def check_layout(windows: DataFrame, key: str = "recording") -> DataFrame:
    """Windows whose channel count, length or rate is not that of their recording's first one."""
    layout = F.struct("channels", "length", "rate")
    first = windows.groupBy(key).agg(F.min_by(layout, "seq").alias("_first"))
    return windows.join(first, key).where(layout != F.col("_first")).drop("_first")


def deliver(receipts: DataFrame, token: str = "token") -> DataFrame:
    """Receipts without repeats of a token: the first one of each counts."""
    return receipts.groupBy(token).agg(F.min_by(F.struct(*receipts.columns), "seq").alias("r")).select("r.*")


# --- stream twins of the folds --------------------------------------------------------------------

END = ("done", "error")


def _progress(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    events, last_ts, last_state, done = state.get if state.exists else (0, None, None, False)
    for b in batches:
        for ts, what in b.sort_values(["ts", "arrival"])[["ts", "state"]].itertuples(index=False):
            events += 1
            last_ts = ts if last_ts is None else max(last_ts, ts)
            if not done:
                last_state, done = what, what in END
    state.update((events, last_ts, last_state, done))
    yield pd.DataFrame([(key[0], events, last_ts, last_state, done)], columns=["key", "events", "last_ts", "last_state", "done"])


def stream_progress(rows: DataFrame) -> DataFrame:
    """``progress`` over a stream of ``(key, arrival, ts, state)`` that comes in order of time: each batch gives
    the fold so far of the keys that it has events of."""
    return rows.groupBy("key").applyInPandasWithState(_progress, PROGRESS_SCHEMA, "events long, last_ts long, last_state string, done boolean", "update", GroupStateTimeout.NoTimeout)


LAYOUT_SCHEMA = "recording string, seq long, channels int, length int, rate int"


def _layout(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    first = tuple(state.get) if state.exists else None
    out = []
    for b in batches:
        for seq, *layout in b.sort_values("seq")[["seq", "channels", "length", "rate"]].itertuples(index=False):
            if first is None:
                first = tuple(layout)
                state.update(first)
            elif tuple(layout) != first:
                out.append((key[0], seq, *layout))
    yield pd.DataFrame(out, columns=["recording", "seq", "channels", "length", "rate"])


def stream_layout(windows: DataFrame) -> DataFrame:
    """``check_layout`` over a stream of ``(recording, seq, channels, length, rate)``."""
    return windows.groupBy("recording").applyInPandasWithState(_layout, LAYOUT_SCHEMA, "channels int, length int, rate int", "append", GroupStateTimeout.NoTimeout)


ADMIT_SCHEMA = "key string, seq long, token string, verdict string"


def admit(rows: DataFrame, capacity: int) -> DataFrame:
    """Receipts ``(key, seq, token)`` of bounded ledgers, one a key: the first ones with a token are accepted while
    the ledger has room, a token that was accepted before is a duplicate, the others find it full."""
    first = rows.groupBy("key", "token").agg(F.min("seq").alias("seq"))
    place = F.row_number().over(Window.partitionBy("key").orderBy("seq"))
    taken = first.withColumn("_place", place).where(F.col("_place") <= capacity).select("key", "token", F.col("seq").alias("_first"))
    verdict = F.when(F.col("_first").isNull(), "full").when(F.col("seq") > F.col("_first"), "duplicate").otherwise("accepted")
    return rows.join(taken, ["key", "token"], "left").select("key", "seq", "token", verdict.alias("verdict"))


def _admit(capacity: int):
    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = list(state.get[0]) if state.exists else []
        known, out = set(held), []
        for b in batches:
            for seq, token in b.sort_values("seq")[["seq", "token"]].itertuples(index=False):
                verdict = "duplicate" if token in known else "accepted" if len(held) < capacity else "full"
                if verdict == "accepted":
                    held.append(token)
                    known.add(token)
                out.append((key[0], seq, token, verdict))
        state.update((held,))
        yield pd.DataFrame(out, columns=["key", "seq", "token", "verdict"])

    return run


def stream_admit(rows: DataFrame, capacity: int) -> DataFrame:
    """``admit`` over a stream of ``(key, seq, token)``; the state is what a ledger holds, so bounded."""
    return rows.groupBy("key").applyInPandasWithState(_admit(capacity), ADMIT_SCHEMA, "tokens array<string>", "append", GroupStateTimeout.NoTimeout)


def evidence(rows: DataFrame, key: str, order: str, capacity: int) -> DataFrame:
    """What a bounded ledger of each key tells: its first ``capacity`` issues, and one more row, without an
    order, that counts those it had no room for. Rows ``(key, order, issue)``."""
    w = Window.partitionBy(key).orderBy(order)
    kept = rows.select(key, order, "issue", F.row_number().over(w).alias("_r")).where(F.col("_r") <= capacity).select(key, order, "issue", F.lit(0).cast("long").alias("suppressed"))
    lost = rows.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > capacity)
    return kept.unionByName(lost.select(key, F.lit(None).cast(rows.schema[order].dataType).alias(order), F.lit("overflow").alias("issue"), (F.col("_n") - capacity).alias("suppressed")))
