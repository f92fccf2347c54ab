"""Integer and quantiser kernels as column expressions and grouped plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def zigzag(v: Column) -> Column:
    """Signed to unsigned, small magnitudes first: 0, -1, 1, -2 become 0, 1, 2, 3."""
    return F.when(v >= 0, 2 * v).otherwise(-2 * v - 1)


def unzigzag(z: Column) -> Column:
    return F.when(z % 2 == 0, F.shiftright(z, 1)).otherwise(-F.shiftright(z, 1) - 1)


def rice_parameter(residuals: DataFrame, value: str, *by: str, most: int = 31) -> DataFrame:
    """``(by, n, k)``: floor of the binary logarithm of the mean zigzagged value, of those that are not zero."""
    m = residuals.groupBy(*by).agg(F.count("*").alias("n"), F.avg(F.when(F.col(value) != 0, zigzag(F.col(value)))).alias("_m"))
    return m.select(*by, "n", F.when(F.col("_m") >= 1, F.least(F.floor(F.log2("_m")), F.lit(most))).otherwise(0).cast("int").alias("k"))


def rice_size(residuals: DataFrame, value: str, *by: str) -> DataFrame:
    """Bytes that Golomb-Rice coding takes, from sums alone: a 3-byte head and the codes' bits."""
    k = rice_parameter(residuals, value, *by)
    bits = F.sum(F.expr(f"shiftright(CASE WHEN {value} >= 0 THEN 2 * {value} ELSE -2 * {value} - 1 END, k)") + 1 + F.col("k"))
    return residuals.join(k.select(*by, "k"), list(by)).groupBy(*by).agg(F.max("k").alias("k"), F.count("*").alias("n"), (3 + F.ceil(bits / 8)).alias("bytes"))


def _butterflies(block: Column, n: int, inverse: bool) -> Column:
    """Natural-order Walsh-Hadamard transform of an array of ``n`` values (a power of two), in log n rounds."""

    def round_(v: Column, h: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.when(i.bitwiseAND(h) == 0, F.get(v, i) + F.get(v, i + h)).otherwise(F.get(v, i - h) - F.get(v, i)))

    out = F.aggregate(F.array(*(F.lit(1 << k) for k in range(n.bit_length() - 1))), block, round_) if n > 1 else block
    return F.transform(out, lambda x: x / n) if inverse else out


def hadamard(values: Column, n: int = 32, inverse: bool = False) -> Column:
    """``walsh_hadamard`` of an array within its row: blocks of n, the last one filled up with zeros; null counts
    as zero."""

    def blocks(v: Column) -> Column:
        at = F.filter(F.sequence(F.lit(0), F.size(v)), lambda i: (i % n == 0) & (i < F.size(v)))
        block = lambda k: F.transform(F.sequence(k, k + n - 1), lambda i: F.coalesce(F.get(v, i), F.lit(0)))
        return F.flatten(F.transform(at, lambda k: _butterflies(block(k), n, inverse)))

    # as a bound variable, so that what makes the array is not done again for each of its elements
    return F.get(F.transform(F.array(values), blocks), F.lit(0))


def walsh_hadamard(rows: DataFrame, by: str, dim: str, value: str, n: int = 32, inverse: bool = False) -> DataFrame:
    """Natural-order transform of each block of n (a power of two) dimensions, as ``(by, dim, y)``. A block is
    one group of n sums, not one for each output; rows that repeat a dimension add up."""
    at = F.col(dim).cast("long")
    sums = F.array(*(F.coalesce(F.sum(F.when(F.pmod(at, F.lit(n)) == k, F.col(value))), F.lit(0)) for k in range(n)))
    each = rows.groupBy(by, (at - F.pmod(at, F.lit(n))).alias("_block")).agg(sums.alias("_x"), F.count(value).alias("_n"))
    each = each.select(by, "_block", "_n", F.posexplode(_butterflies(F.col("_x"), n, inverse)).alias("_k", "y"))
    return each.select(by, (F.col("_block") + F.col("_k")).alias(dim), F.when(F.col("_n") > 0, F.col("y")).alias("y"))


def fsq_index(x: Column, lo: Column, span: Column, levels: int) -> Column:
    """Level of a value in its range; a flat range is in the middle."""
    return F.when(span <= 0, levels // 2).otherwise(F.greatest(F.least(F.floor((x - lo) / span * levels), F.lit(levels - 1)), F.lit(0))).cast("int")


def fsq_value(s: Column, lo: Column, span: Column, levels: int) -> Column:
    """Middle of a level."""
    return lo + (s + 0.5) * (span + 1e-8) / levels


def fsq(rows: DataFrame, by: str, value: str, levels: int) -> DataFrame:
    """Rows with level ``s`` and value ``y`` by their group's range."""
    span = rows.groupBy(by).agg(F.min(value).cast("double").alias("lo"), (F.max(value) - F.min(value)).cast("double").alias("span"))
    s = rows.join(span, by).withColumn("s", fsq_index(F.col(value).cast("double"), F.col("lo"), F.col("span"), levels))
    return s.withColumn("y", fsq_value(F.col("s"), F.col("lo"), F.col("span"), levels)).drop("lo", "span")


def strip_guard(samples: DataFrame, bits: int) -> DataFrame:
    """Per recording, whether the low bits are clear already, so that they are not stripped twice."""
    return samples.groupBy("recording").agg(F.count_if(F.col("v").bitwiseAND(F.lit((1 << bits) - 1)) != 0).alias("dirty")).withColumn("stripped", F.col("dirty") == 0)


def calibrate(v: Column, dig_min: Column, dig_max: Column, phys_min: Column, phys_max: Column) -> Column:
    """Digital to physical; a channel without a digital range is zero."""
    scale = (phys_max - phys_min) / (dig_max - dig_min)
    return F.when(dig_max == dig_min, 0.0).otherwise((v - dig_min) * scale + phys_min)


def block_float(rows: DataFrame, by: str, value: str, bits: int = 8) -> DataFrame:
    """Block floating point: a scale for each block and signed mantissas of ``bits``, and what they
    stand for. A block of zeros has scale zero."""
    top = (1 << (bits - 1)) - 1
    scale = rows.groupBy(by).agg((F.max(F.abs(F.col(value).cast("double"))) / top).alias("scale"))
    m = F.when(F.col("scale") > 0, F.floor(F.col(value) / F.col("scale") + 0.5)).otherwise(0).cast("int")
    return rows.join(scale, by).withColumn("mantissa", m).withColumn("y", F.col("mantissa") * F.col("scale"))


def two_stage(rows: DataFrame, by: str, value: str, coarse: int, fine: int) -> DataFrame:
    """A quantiser, and a second one over what the first leaves: columns ``s``, ``y``, ``s2``, ``y2``."""
    one = fsq(rows, by, value, coarse).withColumn("_rest", F.col(value) - F.col("y"))
    span = one.groupBy(by).agg(F.min("_rest").alias("lo"), (F.max("_rest") - F.min("_rest")).alias("span"))
    two = one.join(span, by).withColumn("s2", fsq_index(F.col("_rest"), F.col("lo"), F.col("span"), fine))
    return two.withColumn("y2", F.col("y") + fsq_value(F.col("s2"), F.col("lo"), F.col("span"), fine)).drop("lo", "span", "_rest")
