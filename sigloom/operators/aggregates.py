"""Grouped statistics: summaries, percentiles by three rules, histograms, entropy, votes, sweeps."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Relative rank error of the sketch that places a percentile, and the group size below which all values are ranked.
SKETCH, RANKED = 100_000, 100_000


def at_ranks(rows: DataFrame, value: str, ranks: dict[str, tuple[float, Callable[[Column], Column]]], *by: str) -> DataFrame:
    """Exact values at 0-based ranks of each group: ``ranks`` gives a name its share p of the group, and the
    rank, which is within 2 of p times the count, as a function of the count.

    A sketch gives a narrow range around each rank first. What lies below the range is only counted, what
    lies in it is counted by value and ranked, so no task orders a whole group, however large. Nulls have no
    rank; a null group is one of its own."""
    wide = 3 / SKETCH
    key = F.struct(*by) if by else F.lit(0)
    x = rows.where(F.col(value).isNotNull()).select(key.alias("_key"), F.col(value).alias("_x"))
    ends = [min(max(p + d, 0.0), 1.0) for p, _ in ranks.values() for d in (-wide, wide)]
    g = x.groupBy("_key").agg(F.count("*").alias("_n"), F.percentile_approx("_x", ends, SKETCH).alias("_q"))
    large = F.col("_n") >= RANKED
    bands = [
        F.struct(F.lit(k).alias("k"), rank(F.col("_n")).cast("long").alias("r"), F.when(large & F.lit(p > wide), F.col("_q")[2 * k]).alias("lo"), F.when(large & F.lit(p < 1 - wide), F.col("_q")[2 * k + 1]).alias("hi"))
        for k, (p, rank) in enumerate(ranks.values())
    ]
    met = x.join(g.select("_key", F.array(*bands).alias("_bands")), "_key")
    up_to = F.filter("_bands", lambda b: F.coalesce(F.col("_x") <= b.hi, F.lit(True)))
    each = met.select("_key", "_x", F.explode(up_to).alias("_b"))
    inside = F.coalesce(F.col("_x") >= F.col("_b.lo"), F.lit(True))
    counted = each.groupBy("_key", F.col("_b.k").alias("_k"), F.col("_b.r").alias("_r"), F.when(inside, F.col("_x")).alias("_x")).agg(F.count("*").alias("_c"))
    up = Window.partitionBy("_key", "_k").orderBy(F.asc_nulls_first("_x"))
    placed = counted.withColumn("_up", F.sum("_c").over(up)).where("_up > _r AND _up - _c <= _r")
    out = placed.groupBy("_key").agg(*(F.max(F.when(F.col("_k") == k, F.col("_x"))).alias(name) for k, name in enumerate(ranks)))
    return out.select(*(F.col(f"_key.{c}").alias(c) for c in by), *ranks)


def percentiles(rows: DataFrame, value: str, points: dict[str, float], *by: str) -> DataFrame:
    """Percentiles with linear interpolation between the two values around ``p * (n - 1)``."""
    ranks: dict[str, tuple[float, Callable[[Column], Column]]] = {}
    for name, p in points.items():
        ranks[f"_lo_{name}"] = (p, lambda n, p=p: F.floor(F.lit(p) * (n - 1)))
        ranks[f"_hi_{name}"] = (p, lambda n, p=p: F.ceil(F.lit(p) * (n - 1)))
    key = F.struct(*by) if by else F.lit(0)
    n = rows.where(F.col(value).isNotNull()).groupBy(key.alias("_key")).agg(F.count("*").alias("_n"))
    got = at_ranks(rows, value, ranks, *by).withColumn("_key", key)
    out = {}
    for name, p in points.items():
        lo, hi, at = F.col(f"_lo_{name}").cast("double"), F.col(f"_hi_{name}").cast("double"), F.lit(p) * (F.col("_n") - 1)
        out[name] = F.when(lo == hi, lo).otherwise(lo * (F.ceil(at) - at) + hi * (at - F.floor(at)))
    return got.join(n, "_key").select(*by, *(c.alias(name) for name, c in out.items()))


def channel_stats(samples: DataFrame) -> DataFrame:
    """Per recording: count, range, mean, population deviation, median and median absolute deviation."""
    base = samples.groupBy("recording").agg(
        F.count("*").alias("n"),
        F.min("v").alias("v_min"),
        F.max("v").alias("v_max"),
        F.round(F.avg("v"), 6).alias("v_mean"),
        F.round(F.stddev_pop("v"), 6).alias("v_std"),
    )
    middle = percentiles(samples, "v", {"v_median": 0.5}, "recording")
    away = samples.join(middle, "recording").select("recording", F.abs(F.col("v") - F.col("v_median")).alias("_d"))
    far = percentiles(away, "_d", {"v_mad": 0.5}, "recording")
    return base.join(middle, "recording").join(far, "recording").withColumns({"v_median": F.round("v_median", 6), "v_mad": F.round("v_mad", 6)})


def batch_summary(results: DataFrame, *by: str) -> DataFrame:
    """Counts by status; bytes and their ratio over successes only, 0 where nothing was packed."""
    ok = F.col("status") == "success"
    raw, packed = F.coalesce(F.sum(F.when(ok, F.col("raw_bytes"))), F.lit(0)), F.coalesce(F.sum(F.when(ok, F.col("packed_bytes"))), F.lit(0))
    g = results.groupBy(*by).agg(
        F.count("*").alias("total"),
        F.count_if(ok).alias("success"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.count_if(F.col("status") == "skipped").alias("skipped"),
        raw.alias("raw_bytes"),
        packed.alias("packed_bytes"),
    )
    return g.withColumn("ratio", F.round(F.when(F.col("packed_bytes") > 0, F.col("raw_bytes") / F.col("packed_bytes")).otherwise(0.0), 6))


def run_gap(ratio: Column, width: int = 16, floor: float = 6.63) -> dict[str, Column]:
    """How far a compression ratio stands from the entropy floor, in bits a sample and per cent."""
    left = F.lit(float(width)) / ratio - floor
    return {"gap_bits": F.greatest(left, F.lit(0.0)), "gap_pct": (1 - left / (width - floor)) * 100}


def robust_summary(rows: DataFrame, value: str, *by: str) -> DataFrame:
    """n, mean, interpolated 5/50/95 percentiles and range of the values that are numbers, infinities included;
    for one group at least."""
    x = F.when(~F.isnan(value), F.col(value).cast("double")).alias("_v")
    numbers = rows.select(*by, x)
    g = numbers.groupBy(F.struct(*by).alias("_g")).agg(F.count("_v").alias("n"), F.round(F.avg("_v"), 6).alias("mean"), F.min("_v").alias("min"), F.max("_v").alias("max"))
    p = percentiles(numbers, "_v", {"p5": 0.05, "p50": 0.5, "p95": 0.95}, *by).withColumn("_g", F.struct(*by)).drop(*by)
    return g.join(p, "_g", "left").select("_g.*", "n", "mean", *(F.round(c, 6).alias(c) for c in ("p5", "p50", "p95")), "min", "max")


def ranked_percentiles(rows: DataFrame, value: str, by: str, points: dict[str, float], rule: str = "nearest") -> DataFrame:
    """Percentiles that are values of the data. ``nearest``: index ``min(int(p * n), n - 1)``; ``plain``: the
    same without the bound, which p < 1 never needs."""
    at = lambda p: lambda n: F.least(F.floor(F.lit(p) * n), n - 1) if rule == "nearest" else F.floor(F.lit(p) * n)
    return at_ranks(rows, value, {name: (p, at(p)) for name, p in points.items()}, by)


def histogram(rows: DataFrame, value: str, by: str, bins: int = 30) -> DataFrame:
    """Equal bins over each group's finite range, the last one closed; a flat group is one bin."""
    x = rows.select(by, F.col(value).cast("double").alias("x")).where(F.abs("x") < float("inf"))
    span = x.groupBy(by).agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    k = F.when(F.col("hi") > F.col("lo"), F.least(F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1))).otherwise(0)
    return x.join(span, by).groupBy(by, k.cast("int").alias("bin")).agg(F.count("*").alias("n"))


def entropy(rows: DataFrame, symbol: str, *by: str) -> DataFrame:
    """Bits a symbol, from counts: two grouped steps, the first combined before its shuffle."""
    c = rows.groupBy(*by, symbol).agg(F.count("*").alias("c"))
    h = F.log2(F.sum("c")) - F.sum(F.col("c") * F.log2("c")) / F.sum("c")
    return c.groupBy(*by).agg(F.round(F.abs(h), 6).alias("bits"), F.count("*").alias("symbols"), F.sum("c").alias("n"))


def mutual_information(rows: DataFrame, a: str, b: str, *by: str) -> DataFrame:
    """Bits that two symbol columns tell of one another."""
    joint = rows.groupBy(*by, a, b).agg(F.count("*").alias("c"))
    over = lambda *k: Window.partitionBy(*k) if k else Window.partitionBy(F.lit(1))
    w = joint.withColumns({"ca": F.sum("c").over(over(*by, a)), "cb": F.sum("c").over(over(*by, b)), "n": F.sum("c").over(over(*by))})
    bits = F.sum(F.col("c") / F.col("n") * F.log2(F.col("c") * F.col("n") / (F.col("ca") * F.col("cb"))))
    return w.groupBy(*by).agg(F.round(bits, 6).alias("bits"))


def utilisation(rows: DataFrame, symbol: str, levels: int, *by: str) -> DataFrame:
    """Per cent of the levels in use, and population excess kurtosis."""
    return rows.groupBy(*by).agg(F.round(F.count_distinct(symbol) * 100.0 / levels, 6).alias("used_pct"), F.round(F.kurtosis(symbol), 4).alias("kurtosis"))


def spread(rows: DataFrame, value: str, inner: str, outer: str) -> DataFrame:
    """Mean within each inner group, then mean, deviation and range of these across the outer one."""
    m = rows.groupBy(outer, inner).agg(F.avg(value).alias("m"))
    return m.groupBy(outer).agg(F.count("*").alias("groups"), F.round(F.avg("m"), 6).alias("mean"), F.round(F.stddev_pop("m"), 6).alias("std"), F.round(F.min("m"), 6).alias("min"), F.round(F.max("m"), 6).alias("max"), F.round(F.max("m") - F.min("m"), 6).alias("range"))


def best_f1(rows: DataFrame, score: str, truth: str, by: str) -> DataFrame:
    """Threshold with the best F1 among the distinct scores; of equal ones the highest."""
    each = rows.groupBy(by, score).agg(F.sum(F.col(truth).cast("long")).alias("tp"), F.count("*").alias("n"))
    down = Window.partitionBy(by).orderBy(F.desc(score)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = each.withColumns({"ctp": F.sum("tp").over(down), "cn": F.sum("n").over(down), "p": F.sum("tp").over(Window.partitionBy(by))})
    f1 = F.when(F.col("p") + F.col("cn") > 0, 2 * F.col("ctp") / (F.col("cn") + F.col("p"))).otherwise(0.0)
    top = cum.withColumn("f1", F.round(f1, 9)).groupBy(by).agg(F.max_by(F.struct(F.col(score).alias("threshold"), "f1", "ctp", "p"), F.struct("f1", score)).alias("b"))
    return top.select(by, F.col("b.threshold").alias("threshold"), F.round("b.f1", 6).alias("f1"), F.round(F.when(F.col("b.p") > 0, F.col("b.ctp") / F.col("b.p")).otherwise(0.0), 6).alias("sensitivity"))


def state_counts(rows: DataFrame, state: str, states: tuple[str, ...]) -> DataFrame:
    """Count of each state, with a zero for one that does not occur."""
    return rows.agg(*(F.count_if(F.col(state) == s).alias(s) for s in states))


def head_to_head(rows: DataFrame, codec: str = "codec") -> DataFrame:
    """Means by codec, and whether each is the best there is."""
    g = rows.groupBy(codec).agg(F.round(F.avg("cr"), 6).alias("cr"), F.round(F.avg("prd"), 6).alias("prd"), F.round(F.median("latency"), 6).alias("latency"))
    everything = Window.partitionBy(F.lit(1))
    return g.withColumns({"best_cr": F.col("cr") == F.max("cr").over(everything), "best_prd": F.col("prd") == F.min("prd").over(everything), "best_latency": F.col("latency") == F.min("latency").over(everything)})


def rollup_percentiles(rows: DataFrame, value: str, group: str) -> DataFrame:
    """Median, 5th and 95th percentile cut to integers, for each group and for all (group null)."""
    both = F.explode(F.array(F.struct(F.col(group).alias("g"), F.lit(False).alias("all")), F.struct(F.lit(None).alias("g"), F.lit(True).alias("all")))).alias("_of")
    x = rows.select(both, value).select(F.col("_of.g").alias(group), F.col("_of.all").alias("_all"), value)
    n = x.groupBy(F.struct(group, "_all").alias("_g")).agg(F.count("*").alias("n"))
    p = percentiles(x, value, {"p50": 0.5, "p5": 0.05, "p95": 0.95}, group, "_all").withColumn("_g", F.struct(group, "_all")).drop(group, "_all")
    return n.join(p, "_g", "left").select(F.col(f"_g.{group}").alias(group), "n", *(F.col(c).cast("long").alias(c) for c in ("p50", "p5", "p95")))


def normalised_frequencies(rows: DataFrame, symbol: str, total: int, by: str, alphabet: int) -> DataFrame:
    """``(by, symbol, c, f)`` for each symbol from 0 to ``alphabet - 1``: counts scaled to sum to ``total``, or
    to twice the alphabet if that is more. A symbol that does not occur has 1, one that does at least 1 of
    what is left in proportion; the most frequent (of these the lowest) takes up the rest."""
    total = max(total, 2 * alphabet)
    c = rows.groupBy(by, F.col(symbol).cast("long").alias(symbol)).agg(F.count("*").alias("c"))
    every = c.select(by).distinct().withColumn(symbol, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(alphabet - 1).cast("long"))))
    c = every.join(c, [by, symbol], "left").withColumn("c", F.coalesce("c", F.lit(0)))
    w = Window.partitionBy(by)
    shared = F.lit(total) - F.count_if(F.col("c") == 0).over(w)
    f = c.withColumn("f", F.when(F.col("c") == 0, 1).otherwise(F.greatest(F.floor(F.col("c") / F.sum("c").over(w) * shared), F.lit(1))))
    f = f.withColumn("_top", F.row_number().over(w.orderBy(F.desc("c"), symbol)) == 1)
    return f.withColumn("f", F.when(F.col("_top"), F.col("f") + total - F.sum("f").over(w)).otherwise(F.col("f"))).drop("_top")


#: Modality tags, markers in order, and electrode and lead names.
MODALITIES = (("eeg", ("EEG",)), ("ecg", ("ECG", "EKG")), ("emg", ("EMG",)), ("eog", ("EOG",)), ("resp", ("RESPIRATION", "RESP", "AIRFLOW")), ("accel", ("ACCEL", "ACC")))
ELECTRODES = "FP1 FP2 F3 F4 C3 C4 P3 P4 O1 O2 F7 F8 T3 T4 T5 T6 T7 T8 P7 P8 FZ CZ PZ OZ A1 A2".split()
LEADS = "I II III AVR AVL AVF V1 V2 V3 V4 V5 V6".split()


def vote_modality(labels: DataFrame, by: str = "recording", label: str = "label", hint: str | None = None) -> DataFrame:
    """Modality of each recording: a declared hint wins; otherwise labels vote and more than half of all
    of them have to agree. Bare lead names count as votes only if there are at least two."""
    up = F.upper(label)
    marked = lambda text: F.coalesce(*(F.when(F.greatest(*(F.contains(text, F.lit(m)).cast("int") for m in marks), F.lit(0)) == 1, F.lit(name)) for name, marks in MODALITIES))
    token = F.split(up, r"[-_/\s]+")
    kind = F.coalesce(marked(up), F.when(F.arrays_overlap(token, F.array(*map(F.lit, ELECTRODES))), F.lit("eeg")), F.when(F.arrays_overlap(token, F.array(*map(F.lit, LEADS))), F.lit("lead")))
    voted = labels.withColumn("_k", kind)
    declared = F.first(marked(F.upper(hint)), ignorenulls=True) if hint else F.lit(None).cast("string")
    count = voted.groupBy(by).agg(F.count("*").alias("n"), declared.alias("_declared"), F.count_if(F.col("_k") == "lead").alias("_lead"), *(F.count_if(F.col("_k") == name).alias(name) for name, _ in MODALITIES))
    ecg = F.col("ecg") + F.when(F.col("_lead") >= 2, F.col("_lead")).otherwise(0)
    votes = {name: (ecg if name == "ecg" else F.col(name)) for name, _ in MODALITIES}
    winner = F.coalesce("_declared", *(F.when(2 * v > F.col("n"), F.lit(name)) for name, v in votes.items()), F.lit("untyped"))
    return count.select(by, "n", winner.alias("modality"))


def energy_summary(rows: DataFrame, by: str, value: str, key: str) -> DataFrame:
    """Count and mean by group and energy tenth (lowest, highest, between), by group, and of all."""
    w = Window.partitionBy(by).orderBy(value, key)
    r, n = F.row_number().over(w) - 1, F.count("*").over(Window.partitionBy(by))
    s = rows.select(by, value, r.alias("_r"), n.alias("_n"))
    s = s.withColumn("energy", F.when(F.col("_r") * 10 < F.col("_n"), "low").when(F.col("_r") * 10 >= F.col("_n") * 9, "high").otherwise("middle"))
    return s.groupingSets([[by, "energy"], [by], []], by, "energy").agg(F.count("*").alias("n"), F.round(F.avg(value), 6).alias("mean"))


def paper_aggregate(results: DataFrame, *by: str) -> DataFrame:
    """Of ``(status, raw_bytes, packed_bytes, exact)``: counts, bytes, the ratio of the sums, and mean, deviation, range and percentiles
    of the ratios of the files that succeeded and hold something."""
    ok = (F.col("status") == "success") & (F.col("packed_bytes") > 0)
    r = results.withColumn("_cr", F.when(ok, F.col("raw_bytes").cast("double") / F.col("packed_bytes")))
    raw, packed = F.sum(F.when(ok, F.col("raw_bytes"))), F.sum(F.when(ok, F.col("packed_bytes")))
    g = r.groupBy(*by).agg(
        F.count("_cr").alias("ok"), F.count_if(F.col("status") == "failed").alias("errors"), F.count_if(ok & F.col("exact")).alias("bit_perfect"), raw.alias("raw_bytes"), packed.alias("packed_bytes"),
        F.round(raw.cast("double") / packed, 6).alias("ratio_of_sums"), F.round(F.avg("_cr"), 4).alias("mean_of_ratios"), F.round(F.stddev_pop("_cr"), 4).alias("std"), F.round(F.min("_cr"), 6).alias("min"), F.round(F.max("_cr"), 6).alias("max"),
    )
    p = percentiles(r, "_cr", {"median": 0.5, "p5": 0.05, "p95": 0.95}, *by)
    return g.join(p, list(by), "left").withColumns({c: F.round(c, 6) for c in ("median", "p5", "p95")})


def principal_axes(rows: DataFrame, item: str, dim: str, value: str, most: int = 1024) -> DataFrame:
    """``(component, variance, dim, weight)``: eigenvectors of the covariance of the dimensions, the largest variance
    first; the largest weight of each is positive. Only the covariance matrix reaches the driver, and only
    if it has no more than ``most`` dimensions."""
    n = rows.select(dim).distinct().count()
    if n > most:
        raise ValueError(f"{n} dimensions are more than {most}")
    other = rows.select(item, F.col(dim).alias("_j"), F.col(value).alias("_y"))
    got = rows.join(other, item).where(F.col(dim) <= F.col("_j")).groupBy(dim, "_j").agg(F.covar_samp(value, "_y").alias("c")).collect()
    names = sorted({r[0] for r in got})
    at = {d: k for k, d in enumerate(names)}
    c = np.zeros((len(names), len(names)))
    for i, j, v in got:
        c[at[i], at[j]] = c[at[j], at[i]] = v if v is not None else 0.0
    variance, axes = np.linalg.eigh(c)
    out = []
    for k, m in enumerate(np.argsort(-variance, kind="stable").tolist()):
        axis = axes[:, m] * (np.sign(axes[np.abs(axes[:, m]).argmax(), m]) or 1.0)
        out += [(k, float(variance[m]), d, float(w)) for d, w in zip(names, axis, strict=True)]
    kind = rows.schema[dim].dataType.simpleString()
    return rows.sparkSession.createDataFrame(out, f"component int, variance double, `{dim}` {kind}, weight double")
