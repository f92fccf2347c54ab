"""Ordered operators over ``(recording, t, v)``: every window is partitioned by recording."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BIAS_CONTEXT = 32
LPC_SHIFT = 27


def _along(by: tuple[str, ...] = ("recording",), order: str = "t"):
    return Window.partitionBy(*by).orderBy(order)


#: Samples of a recording that one task orders together.
BLOCK = 1 << 20


def numbered(rows: DataFrame, by: str, order: str, name: str = "t", block: int = BLOCK) -> DataFrame:
    """Row number within ``by`` by an integer ``order``, from 0, without sorting a whole group in one task:
    ranges of the order are counted, their counts summed up, and rows numbered within their range."""
    rows = rows.withColumn("_range", F.floor(F.col(order) / block))
    counts = rows.groupBy(by, "_range").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(by, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    at = F.row_number().over(Window.partitionBy(by, "_range").orderBy(order)) - 1
    return rows.withColumn(name, at).join(base, [by, "_range"]).withColumn(name, (F.col(name) + F.col("_base")).cast("long")).drop("_range", "_base")


def blocked(samples: DataFrame, kernel: Callable[[DataFrame], DataFrame], before: int, after: int = 0, block: int = BLOCK, place: str = "t") -> DataFrame:
    """An ordered kernel with bounded context run on blocks of each recording: a block also gets the
    ``before`` and ``after`` samples around it, and gives only the rows that are its own by ``place``.

    The result is that of the kernel on whole recordings, but a long one is many tasks. ``block`` has to be
    even for a kernel that works by pairs, and above the context."""
    if block % 2 or block <= before + after:
        raise ValueError("the block must be even and longer than the context")
    near = F.array_distinct(F.array(F.floor(F.col("t") / block), F.floor((F.col("t") + before) / block), F.floor((F.col("t") - after) / block)))
    rows = samples.withColumn("_b", F.explode(near)).where("_b >= 0")
    rows = rows.withColumn("recording", F.struct("recording", "_b")).drop("_b")
    out = kernel(rows)
    own = out.where(F.floor(F.expr(place) / block) == F.col("recording._b"))
    return own.withColumn("recording", F.col("recording.recording"))


def tumbling(samples: DataFrame, size: int) -> DataFrame:
    """Count windows ``floor(t / size)``; the last of a recording may be short."""
    return samples.withColumn("seq", F.floor(F.col("t") / size)).groupBy("recording", "seq").agg(
        F.count("*").alias("n"), F.min("t").alias("t_first"), F.sum("v").alias("v_sum"), F.min("v").alias("v_min"), F.max("v").alias("v_max")
    )


def scaled_window(size: int, rate_hz: float, base_hz: float = 250.0) -> int:
    """A window of the same duration at another rate, within an unsigned 16-bit count."""
    n = int(size * rate_hz / base_hz)
    if n < 1:
        raise ValueError("the window has no sample at this rate")
    return min(n, 65535)


def arrays(samples: DataFrame, size: int) -> DataFrame:
    """``(recording, seq, samples)``: windows as ordered arrays, at most ``size`` values each."""
    each = samples.withColumn("seq", F.floor(F.col("t") / size))
    packed = each.groupBy("recording", "seq").agg(F.sort_array(F.collect_list(F.struct("t", "v"))).alias("s"))
    return packed.select("recording", "seq", F.col("s.v").alias("samples"))


def bias_cancel(samples: DataFrame, context: int = BIAS_CONTEXT) -> DataFrame:
    """``v - floor(sum of the previous values / context)``; a short prefix is still divided by context."""
    shift = context.bit_length() - 1
    if 1 << shift != context:
        raise ValueError("the context must be a power of two")
    w = _along().rowsBetween(-context, -1)
    return samples.withColumn("residual", F.col("v") - F.shiftright(F.coalesce(F.sum("v").over(w), F.lit(0)), shift))


def lpc_residual(samples: DataFrame, coefficients: list[int], shift: int = LPC_SHIFT) -> DataFrame:
    """``v - (sum of c[k] * v[t-1-k] >> shift)``; at the start only as many lags as there are."""
    w = _along()
    guess = sum((F.coalesce(F.lag("v", k + 1).over(w), F.lit(0)) * F.lit(c) for k, c in enumerate(coefficients)), F.lit(0))
    return samples.withColumn("residual", F.col("v") - F.shiftright(guess.cast("long"), shift))


def lifting_forward(samples: DataFrame) -> DataFrame:
    """Integer 5/3 wavelet step: ``(recording, band, idx, v)``, bands approx and detail.

    A detail is an odd value less the mean of its even neighbours, the last of which repeats the one
    before where there is none; an even value takes up a quarter of its neighbouring details."""
    w = _along()
    odd = F.col("t") % 2 == 1
    left, right = F.lag("v").over(w), F.lead("v").over(w)
    d = samples.withColumn("d", F.when(odd, F.col("v") - F.shiftright(left + F.coalesce(right, left), 1)))
    before, after = F.lag("d").over(w), F.lead("d").over(w)
    step = F.shiftright(F.coalesce(before, after, F.lit(0)) + F.coalesce(after, before, F.lit(0)) + 2, 2)
    out = d.withColumn("s", F.when(odd, F.col("d")).otherwise(F.col("v") + step))
    return out.select("recording", F.when(odd, "detail").otherwise("approx").alias("band"), F.floor(F.col("t") / 2).alias("idx"), F.col("s").alias("v"))


def lifting_inverse(bands: DataFrame) -> DataFrame:
    """The samples that ``lifting_forward`` gives these bands for; the evens need details only."""
    t = F.col("idx") * 2 + F.when(F.col("band") == "detail", 1).otherwise(0)
    rows = bands.select("recording", t.alias("t"), F.col("v").alias("s"))
    w = _along()
    odd = F.col("t") % 2 == 1
    before, after = F.lag("s").over(w), F.lead("s").over(w)
    step = F.shiftright(F.coalesce(before, after, F.lit(0)) + F.coalesce(after, before, F.lit(0)) + 2, 2)
    even = rows.withColumn("e", F.when(~odd, F.col("s") - step))
    left, right = F.lag("e").over(w), F.lead("e").over(w)
    value = F.when(odd, F.col("s") + F.shiftright(left + F.coalesce(right, left), 1)).otherwise(F.col("e"))
    return even.select("recording", "t", value.alias("v"))


def lifting_levels(samples: DataFrame, levels: int = 3) -> DataFrame:
    """Cascade: the approximation of each level is split again. Bands l1_detail ... lN_detail, lN_approx."""
    out, now = None, samples
    for n in range(1, levels + 1):
        bands = lifting_forward(now)
        detail = bands.where("band = 'detail'").withColumn("band", F.lit(f"l{n}_detail"))
        out = detail if out is None else out.unionByName(detail)
        now = bands.where("band = 'approx'").select("recording", F.col("idx").alias("t"), "v")
    return out.unionByName(now.select("recording", F.lit(f"l{levels}_approx").alias("band"), F.col("t").alias("idx"), "v"))


def depth(n: Column, most: int = 3) -> Column:
    """Levels that a window of n samples is split into: the most for which ``n >= 4 * 2**levels``."""
    out = F.lit(0)
    for k in range(1, most + 1):
        out = F.when(n >= 4 << k, k).otherwise(out)
    return out


def first_difference(samples: DataFrame) -> DataFrame:
    """Each value less the one before; the first as it is."""
    return samples.withColumn("delta", F.col("v") - F.coalesce(F.lag("v").over(_along()), F.lit(0)))


def runs(samples: DataFrame, cap: int = 255) -> DataFrame:
    """Run-length rows ``(recording, run, t_first, v, length)``; a run above ``cap`` is several."""
    w = _along()
    new = F.coalesce(F.col("v") != F.lag("v").over(w), F.lit(True)).cast("int")
    island = samples.withColumn("_new", new).withColumn("_run", F.sum("_new").over(w))
    at = island.withColumn("_in", F.row_number().over(Window.partitionBy("recording", "_run").orderBy("t")) - 1)
    return at.groupBy("recording", "_run", F.floor(F.col("_in") / cap).alias("piece")).agg(F.min("t").alias("t_first"), F.min("v").alias("v"), F.count("*").alias("length")).drop("_run", "piece")


def bit_autocorrelation(samples: DataFrame, bits: int = 10) -> DataFrame:
    """Lag-1 correlation of each of the lowest bit planes: noise has none."""
    w = _along()
    nxt = samples.withColumn("_next", F.lead("v").over(w))
    plane = nxt.select("recording", F.explode(F.array(*(F.struct(F.lit(k).alias("bit"), F.shiftright("v", k).bitwiseAND(F.lit(1)).alias("a"), F.shiftright("_next", k).bitwiseAND(F.lit(1)).alias("b")) for k in range(bits)))).alias("p"))
    plane = plane.select("recording", "p.*")
    mean = plane.groupBy("recording", "bit").agg(F.avg("a").alias("mean"), F.count("*").alias("n"), F.sum("a").alias("sa"), F.sum(F.col("a") * F.col("b")).alias("sab"), F.sum(F.when(F.col("b").isNotNull(), F.col("a"))).alias("sa1"), F.sum("b").alias("sb"))
    var = F.col("sa") - F.col("n") * F.col("mean") * F.col("mean")
    cov = F.col("sab") - F.col("mean") * (F.col("sa1") + F.col("sb")) + (F.col("n") - 1) * F.col("mean") * F.col("mean")
    return mean.select("recording", "bit", F.round(F.when(var > 1e-12, cov / var).otherwise(0.0), 6).alias("r1"))


def noise_bits(samples: DataFrame, threshold: float = 0.05, bits: int = 10) -> DataFrame:
    """Number of contiguous lowest bits whose lag-1 correlation is below the threshold; none in a
    recording of under 64 samples, and a bit that never changes is no noise."""
    r = bit_autocorrelation(samples, bits)
    n = samples.groupBy("recording").agg(F.count("*").alias("_n"), *(F.count_distinct(F.shiftright("v", k).bitwiseAND(1)).alias(f"_{k}") for k in range(bits)))
    still = F.array(*(F.col(f"_{k}") < 2 for k in range(bits)))
    r = r.join(n.select("recording", "_n", still.alias("_still")), "recording")
    first = F.min(F.when((F.abs("r1") >= threshold) | F.get("_still", F.col("bit").cast("int")), F.col("bit")))
    found = r.groupBy("recording").agg(F.max("_n").alias("_n"), F.coalesce(first, F.lit(bits)).alias("noise_bits"))
    return found.select("recording", F.when(F.col("_n") < 64, 0).otherwise(F.col("noise_bits")).alias("noise_bits"))


def gaps(events: DataFrame, by: str, ts: str, order: str, expected: int, tolerance: int) -> DataFrame:
    """Each row's step from the one before: start, regression (not above zero), gap, or ok; within
    ``min(tolerance, (expected - 1) / 2)`` of the expected step it is no gap."""
    w = Window.partitionBy(by).orderBy(order)
    near = min(tolerance, (expected - 1) // 2)
    step = F.col(ts) - F.lag(ts).over(w)
    state = F.when(step.isNull(), "start").when(step <= 0, "regression").when(step > expected + near, "gap").otherwise("ok")
    return events.withColumn("step", step).withColumn("state", state)


def sequence_gaps(rows: DataFrame, by: str, seq: str) -> DataFrame:
    """Missing ranges of a sequence: ``(by, first_missing, last_missing)``."""
    w = Window.partitionBy(by).orderBy(seq)
    had = rows.select(by, seq, F.lag(seq).over(w).alias("_had"))
    return had.where(F.col(seq) > F.col("_had") + 1).select(by, (F.col("_had") + 1).alias("first_missing"), (F.col(seq) - 1).alias("last_missing"))


def record_gaps(records: DataFrame, by: str, onset: str, expected: float, tolerance: float = 0.001) -> DataFrame:
    """Places where a discontinuous recording breaks: ``(by, onset, step)`` of each record whose onset is not
    the expected time after the one before, beyond the tolerance."""
    step = F.col(onset) - F.lag(onset).over(Window.partitionBy(by).orderBy(onset))
    return records.select(by, onset, step.alias("step")).where(F.abs(F.col("step") - expected) > tolerance)


def moving_average(samples: DataFrame, size: int) -> DataFrame:
    """Centred mean with a fixed divisor: what is outside counts as zero."""
    w = _along().rowsBetween(-((size - 1) // 2) if size % 2 else -(size // 2), (size - 1) // 2)
    return samples.withColumn("ma", F.round(F.sum("v").over(w) / F.lit(size), 6))


def strata(scored: DataFrame, by: str, value: str, key: str, each: int = 10) -> DataFrame:
    """Lowest and highest ``each`` rows and as many strided ones between, by value and then key."""
    w = Window.partitionBy(by).orderBy(value, key)
    n = F.count("*").over(Window.partitionBy(by))
    r = scored.withColumn("_r", F.row_number().over(w) - 1).withColumn("_n", n)
    inner = F.col("_n") - 2 * each
    stride = F.greatest(F.floor(inner / each), F.lit(1))
    place = F.col("_r") - each
    kind = F.when(F.col("_r") < each, "low").when(F.col("_r") >= F.greatest(F.col("_n") - each, F.lit(each)), "high").when((place % stride == 0) & (place / stride < each), "middle")
    return r.withColumn("stratum", kind).where("stratum is not null").drop("_r", "_n")


def break_sessions(rows: DataFrame, by: str, order: str, broken: str = "state") -> DataFrame:
    """Session number of each row: a gap or regression starts a new one."""
    w = Window.partitionBy(by).orderBy(order)
    return rows.withColumn("session", F.sum(F.col(broken).isin("gap", "regression").cast("int")).over(w))
