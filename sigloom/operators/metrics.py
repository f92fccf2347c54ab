"""Quality metrics between a signal and its reconstruction, in three dialects that differ at the edges.

``paired`` rows are ``(recording, t, x, y)``. The dialects are named for what they return on a silent
or flat signal: ``strict`` gives infinities, ``capped`` finite caps, ``guarded`` zeros.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIALECTS = ("strict", "capped", "guarded")


def paired(original: DataFrame, recon: DataFrame, keys: tuple[str, ...] = ("recording", "t")) -> DataFrame:
    """Samples of both signals side by side, joined on their place."""
    return original.withColumnRenamed("v", "x").join(recon.withColumnRenamed("v", "y"), list(keys))


def _sums() -> dict[str, Column]:
    x, y = F.col("x").cast("double"), F.col("y").cast("double")
    d = x - y
    return {
        "n": F.count("*"),
        "sxx": F.sum(x * x),
        "sdd": F.sum(d * d),
        "sd_x": F.stddev_pop(x),
        "sd_y": F.stddev_pop(y),
        "cov": F.covar_pop(x, y),  # corr() divides by zero on a flat signal
        "mean_x": F.avg(x),
        "max_error": F.max(F.abs(d)),
        "lossless": F.bool_and(F.round(x) == F.round(y)),
    }


def prd(sxx: Column, sdd: Column, dialect: str) -> Column:
    """Percent root-mean-square difference: ``100 * |x - y| / |x|``."""
    ratio = 100 * F.sqrt(sdd) / F.sqrt(sxx)
    if dialect == "strict":
        silent = F.when(sdd < 1e-24, 0.0).otherwise(F.lit(float("inf")))
        return F.when(F.sqrt(sxx) < 1e-12, silent).otherwise(ratio)
    if dialect == "capped":
        return F.when(sxx < 1e-30, F.when(sdd < 1e-30, 0.0).otherwise(100.0)).otherwise(ratio)
    return 100 * F.sqrt(sdd / (sxx + 1e-12))


def pearson(cov: Column, sd_x: Column, sd_y: Column, sdd: Column, dialect: str) -> Column:
    flat = (sd_x < (1e-10 if dialect == "capped" else 1e-12)) | (sd_y < (1e-10 if dialect == "capped" else 1e-12))
    on_flat = F.when(sdd == 0, 1.0).otherwise(0.0) if dialect == "capped" else F.lit(0.0)
    return F.when(flat, on_flat).otherwise(cov / (sd_x * sd_y))


def snr_db(sxx: Column, sdd: Column, dialect: str) -> Column:
    db = 10 * F.log10(sxx / sdd)
    if dialect == "strict":
        return F.when(sdd == 0, F.lit(float("inf"))).otherwise(db)
    if dialect == "capped":
        return F.when(sdd < 1e-30, 120.0).otherwise(db)
    return F.when(sxx == 0, F.lit(float("-inf"))).otherwise(10 * F.log10(sxx / (sdd + 1e-12)))


def metrics(pairs: DataFrame, dialect: str = "strict", by: tuple[str, ...] = ("recording",), digits: int = 6) -> DataFrame:
    """One row a group: ``prd``, ``prdn`` (mean removed), ``r``, ``snr_db``, ``rmse``, ``max_error``,
    ``lossless``; one shuffle on the group for all of them."""
    if dialect not in DIALECTS:
        raise ValueError(f"dialect must be one of {DIALECTS}")
    g = pairs.groupBy(*by).agg(*(c.alias(n) for n, c in _sums().items()))
    sxx, sdd = F.col("sxx"), F.col("sdd")
    centred = sxx - F.col("n") * F.col("mean_x") * F.col("mean_x")
    out = {
        "prd": prd(sxx, sdd, dialect),
        "prdn": F.when(centred > 1e-12, 100 * F.sqrt(sdd / centred)).otherwise(0.0),
        "r": pearson(F.col("cov"), F.col("sd_x"), F.col("sd_y"), sdd, dialect),
        "snr_db": snr_db(sxx, sdd, dialect),
        "rmse": F.sqrt(sdd / F.col("n")),
        "max_error": F.col("max_error"),
    }
    return g.select(*by, "n", *(F.round(c, digits).alias(n) for n, c in out.items()), "lossless")


def compression_ratio(raw: Column, packed: Column, dialect: str = "strict") -> Column:
    """Raw over packed bytes: infinite, or by at least one byte, where nothing was packed."""
    if dialect == "capped":
        return raw / F.greatest(packed, F.lit(1))
    return F.when(packed == 0, F.lit(float("inf"))).otherwise(raw / F.when(packed != 0, packed))


# Thresholds of the quality levels, of the batch gate, and of the codec contracts.
LEVELS = (
    # level, max_prd, min_r, min_cr, bit_exact
    ("L", 0.0, 1.0, 2.0, True),
    ("C", 9.0, 0.95, 20.0, False),
    ("M", 20.0, 0.85, 100.0, False),
    ("A", 40.0, 0.70, 200.0, False),
)
GATES = (
    # level, max_prd, min_r
    ("A", 25.0, 0.85),
    ("M", 15.0, 0.92),
    ("C", 9.0, 0.96),
    ("L", 0.001, 0.9999),
)
CONTRACTS = (
    # mode, max_prd, min_r, min_cr, max_cr, lossless
    ("lossless", 0.0, 1.0, 3.0, 10.0, True),
    ("neural", 20.0, 0.80, 200.0, 600.0, False),
)


def with_each(rows: DataFrame, thresholds: tuple, names: tuple[str, ...]) -> DataFrame:
    """Every row with each line of a fixed table, which is a literal of the plan: nothing is joined."""
    line = [F.struct(*(F.lit(v).alias(n) for n, v in zip(names, t, strict=True))) for t in thresholds]
    return rows.withColumn("_each", F.explode(F.array(*line))).select(*rows.columns, "_each.*")


#: PRD in each band (Hz: 0.5, 4, 8, 13, 30 and 50 between them) by level, and of the codec.
BANDS = ("delta", "theta", "alpha", "beta", "gamma")
BAND_PRD = {"C": (5.0, 7.0, 8.0, 12.0, 20.0), "M": (10.0, 12.0, 15.0, 25.0, 40.0), "A": (20.0, 25.0, 30.0, 40.0, 60.0), "neural": (10.0, 12.0, 15.0, 25.0, 50.0)}
BAND_R = {"C": (0.98, 0.97, 0.96, 0.93, 0.85), "M": (0.95, 0.93, 0.90, 0.80, 0.60), "A": (0.85, 0.80, 0.75, 0.65, 0.40)}
#: Divergence of the spectra and milliseconds to encode, by level.
DIVERGENCE = {"C": 0.05, "M": 0.15, "A": 0.30}
LATENCY = {"L": 1000.0, "C": 500.0, "M": 1000.0, "A": 5000.0}


def _limit(of: dict, name: str, k: int | None = None):
    """A level's limit of a fixed table; null for a level that has none."""
    out = F.lit(None).cast("double")
    for level, value in of.items():
        out = F.when(F.col(name) == level, F.lit(value if k is None else value[k])).otherwise(out)
    return out


def check_contract(measured: DataFrame, thresholds: tuple = LEVELS, names: tuple[str, ...] = ("level", "max_prd", "min_r", "min_cr", "bit_exact"), slack: float = 1e-6, prd_slack: float = 0.0) -> DataFrame:
    """Each measured row against each level: what it violates, and whether it passes. A correlation that
    is no number violates. What needs a column is checked if ``measured`` has it: ``cr``, ``lossless`` (an exact
    level then asks for that in place of the correlation), ``psd_divergence``, ``latency_ms``, and
    ``band_<name>_prd`` and ``band_<name>_r``."""
    both, have, level = with_each(measured, thresholds, names), set(measured.columns), names[0]
    exact = F.col(names[-1]) if "lossless" in have else F.lit(False)
    tests = [F.when(exact & ~F.col("lossless"), "bit_exact" if level == "level" else "lossless")] if "lossless" in have else []
    tests.append(F.when(F.col("prd") > F.col("max_prd") + prd_slack, "prd"))
    low = F.isnan("r") | (F.col("r") < F.col("min_r") - slack)
    tests.append(F.when((low & ~exact) if level == "level" else low, "r"))
    if "cr" in have:
        tests.append(F.when(F.col("cr") < F.col("min_cr"), "cr"))
        if "max_cr" in names:
            tests.append(F.when(F.col("cr") > F.col("max_cr"), "cr"))
    if "psd_divergence" in have:
        tests.append(F.when(F.col("psd_divergence") > _limit(DIVERGENCE, level), "psd_divergence"))
    if "latency_ms" in have:
        tests.append(F.when(F.col("latency_ms") > _limit(LATENCY, level), "latency"))
    for k, band in enumerate(BANDS):
        if f"band_{band}_prd" in have:
            tests.append(F.when(F.col(f"band_{band}_prd") > _limit(BAND_PRD, level, k), f"band_{band}_prd"))
        if f"band_{band}_r" in have:
            tests.append(F.when(F.col(f"band_{band}_r") < _limit(BAND_R, level, k), f"band_{band}_r"))
    return both.withColumn("violations", F.array_compact(F.array(*tests))).withColumn("passed", F.size("violations") == 0)


def codec_contract(measured: DataFrame) -> DataFrame:
    """``check_contract`` with the codec's own thresholds, the upper ratio bound included."""
    return check_contract(measured, CONTRACTS, ("mode", "max_prd", "min_r", "min_cr", "max_cr", "lossless_only"), 1e-9, 1e-9)


def gate(measured: DataFrame) -> DataFrame:
    """The batch gate: both bounds in one, without slack."""
    both = with_each(measured, GATES, ("level", "max_prd", "min_r"))
    return both.select("recording", "level", ((F.col("prd") <= F.col("max_prd")) & (F.col("r") >= F.col("min_r"))).alias("passed"))


def first_violations(checked: DataFrame, order: str = "recording") -> DataFrame:
    """Distinct violations with the first place each was seen at, for a report without repeats."""
    seen = checked.select(F.col(order), "level", F.posexplode("violations").alias("pos", "violation"))
    return seen.groupBy("level", "violation").agg(F.min(order).alias("first_seen"), F.count("*").alias("times"))


def spectral_bandwidth(spectra: DataFrame, by: str, smooth: int = 5, limit: float = 3.0, lowest: float = 0.3) -> DataFrame:
    """``(by, hz, p, q)``, a row for each window and frequency -> mean of the absolute error in dB and the lowest frequency at
    which its moving average, zero beyond both ends, is above ``limit``; null if none. Spectra are averaged over all
    windows first, so a group is as many rows as there are frequencies."""
    mean = spectra.groupBy(by, "hz").agg(F.avg("p").alias("p"), F.avg("q").alias("q"))
    db = mean.withColumn("db", F.abs(10 * F.log10((F.col("q") + 1e-30) / (F.col("p") + 1e-30))))
    near = Window.partitionBy(by).orderBy("hz").rowsBetween(-(smooth // 2), smooth // 2)
    level = db.withColumn("level", F.sum("db").over(near) / smooth)
    over = (F.col("level") > limit) & (F.col("hz") >= lowest)
    return level.groupBy(by).agg(F.avg("db").alias("db"), F.min(F.when(over, F.col("hz"))).alias("f3db"))
