"""Predicates and small projections over single rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_finite(x: Column) -> Column:
    """Neither null, NaN nor infinite."""
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def is_hash(x: Column) -> Column:
    """Exactly 64 small hexadecimal digits."""
    return F.coalesce(x.rlike("^[0-9a-f]{64}$"), F.lit(False))


def all_or_none(*parts: Column) -> Column:
    """Values that make sense only together: all there or all absent."""
    there = sum((p.isNotNull().cast("int") for p in parts), F.lit(0))
    return (there == 0) | (there == len(parts))


def mirror(path: Column, root: str, ext: str) -> Column:
    """The same place below another root, with another extension."""
    return F.concat(F.lit(f"{root}/"), F.regexp_replace(path, r"\.[A-Za-z0-9]+$", ""), F.lit(f".{ext}"))


def translate_status(lines: DataFrame) -> DataFrame:
    """Stage status lines ``{"stage": ..., "count": ...}`` as operation events."""
    stage = F.get_json_object("line", "$.stage")
    kind = F.when(stage == "failed", "error").when(stage == "finished", "done").when(stage.isNotNull(), "progress").otherwise("log")
    return lines.withColumns({"kind": kind, "current": F.get_json_object("line", "$.count").cast("long")})
