"""Named passes over signals, chains of them, and a small text form.

A pass is a function on DataFrames with a tag that says whether it can be undone; a chain is built from
a registry, run with ``DataFrame.transform``, and refused where a lossless one holds a lossy pass.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom.operators import windows


@dataclass(frozen=True)
class Pass:
    name: str
    forward: Callable[..., DataFrame]
    inverse: Callable[..., DataFrame] | None = None
    params: dict[str, int | float | str] = field(default_factory=dict)

    @property
    def lossless(self) -> bool:
        return self.inverse is not None


class Registry:
    """Passes by name; a name that is registered again replaces the one before."""

    def __init__(self) -> None:
        self._makers: dict[str, Callable[..., Pass]] = {}

    def add(self, name: str, maker: Callable[..., Pass]) -> None:
        self._makers[name] = maker

    def build(self, name: str, **params) -> Pass:
        if name not in self._makers:
            raise KeyError(f"no pass named {name!r}; there are {', '.join(sorted(self._makers))}")
        return self._makers[name](**params)


def _shifted(bits: int, up: bool) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.withColumn("v", F.shiftleft("v", bits) if up else F.shiftright("v", bits))


def default_registry() -> Registry:
    r = Registry()
    r.add("lift", lambda: Pass("lift", windows.lifting_forward, windows.lifting_inverse))
    r.add("negate", lambda: Pass("negate", lambda df: df.withColumn("v", -F.col("v")), lambda df: df.withColumn("v", -F.col("v"))))
    r.add("offset", lambda by=0: Pass("offset", lambda df: df.withColumn("v", F.col("v") + by), lambda df: df.withColumn("v", F.col("v") - by), {"by": by}))
    r.add("strip", lambda bits=3: Pass("strip", _shifted(int(bits), False), None, {"bits": bits}))
    return r


class Chain:
    def __init__(self, passes: list[Pass]):
        self.passes = passes

    @property
    def lossless(self) -> bool:
        return all(p.lossless for p in self.passes)

    def then(self, p: Pass) -> Chain:
        return Chain([*self.passes, p])

    def run(self, df: DataFrame) -> DataFrame:
        for p in self.passes:
            df = df.transform(p.forward)
        return df

    def undo(self, df: DataFrame) -> DataFrame:
        if not self.lossless:
            raise ValueError("a chain with a lossy pass cannot be undone")
        for p in reversed(self.passes):
            df = df.transform(p.inverse)
        return df

    def to_json(self) -> str:
        return json.dumps([{"pass": p.name, **p.params} for p in self.passes])


_ITEM = re.compile(r'\s*([A-Za-z_][\w-]*)\s*(?:=\s*("(?:\\.|[^"\\])*"|[^\s,]+))?')


def parse(text: str) -> list[tuple[str, dict]]:
    """Lines ``name key=value ...``: comments start with ``;`` or ``#``, values may be quoted."""
    out = []
    for k, line in enumerate(text.splitlines(), 1):
        kept = re.sub(r'("(?:\\.|[^"\\])*")|[;#].*', lambda m: m[1] or "", line).strip()
        if not kept:
            continue
        items, at = [], 0
        while at < len(kept):
            m = _ITEM.match(kept, at)
            if not m or m.end() == at:
                raise ValueError(f"line {k}: cannot read {kept[at:]!r}")
            items.append((m[1], m[2]))
            at = m.end()
            while at < len(kept) and kept[at] in " ,\t":
                at += 1
        name, value = items[0]
        if value is not None or any(v is None for _, v in items[1:]):
            raise ValueError(f"line {k}: a pass name and then key=value")
        out.append((name, {n: _value(v) for n, v in items[1:]}))
    return out


def _value(text: str):
    if text.startswith('"'):
        return json.loads(text)
    for kind in (int, float):
        try:
            return kind(text)
        except ValueError:
            pass
    return text


def build(text: str, registry: Registry | None = None, lossless: bool = True) -> Chain:
    """The chain that ``text`` describes; with ``lossless`` a lossy pass in it is an error."""
    registry = registry or default_registry()
    chain = Chain([registry.build(name, **params) for name, params in parse(text)])
    if lossless and not chain.lossless:
        raise ValueError("a lossy pass: " + ", ".join(p.name for p in chain.passes if not p.lossless))
    return chain
