"""Secret scans with multipart credential linking.

The base kinds are reported wherever they stand. Weak parts (an identifier, an unlabelled random
string, an endpoint) mean little alone: they are reported only when complementary parts stand
together, which an interval join over the parts of one scope decides. A scope is a run of lines
without a blank one; inside it two parts are together if at most ``REACH`` characters lie between.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import share_code, text_of

REACH = 240

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
BASE = ("assign", "access", "hex")
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Weak kinds: an account or client name, a random string without a label, and where it would be used.
ACCOUNT = re.compile(r"""\b(?:client|app|account|user|access|tenant)[_-]?(?:id|name|key_id)?["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}""", re.ASCII | re.IGNORECASE)
RANDOM = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}(?![A-Za-z0-9+/_=-])")
ENDPOINT = re.compile(r"""[a-z][a-z0-9+.-]{1,15}://[^\s"'<>]{4,}|\b(?:host|hostname|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._:-]{4,}|(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?::\d{2,5})?(?![\w.])""", re.ASCII | re.IGNORECASE)
WEAK = ("account", "random", "endpoint")
KINDS = BASE + WEAK
#: What a kind is a part of, and the parts that complete it.
ROLE = {"assign": "secret", "hex": "secret", "random": "secret", "access": "id", "account": "id", "endpoint": "place"}
NEEDS = {"secret": ("id", "place"), "id": ("secret",), "place": ("secret",)}
_BLANK = re.compile(r"\n[\x20\t\r]*\n")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Leftmost non-overlapping matches of each base kind that are long enough."""
    out = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        out += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [(*m.span(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    return out + [(*m.span(), "hex") for m in HEX.finditer(text)]


def looks_random(s: str) -> bool:
    """A string of letters of both cases and digits whose characters hardly repeat."""
    if not (any(c.isdigit() for c in s) and any(c.islower() for c in s) and any(c.isupper() for c in s)):
        return False
    n = len(s)
    return -sum(c / n * math.log2(c / n) for c in Counter(s).values()) >= 3.5


def weak_spans(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Weak parts; the value of an assignment that ``base`` has is not taken for a second secret."""
    out, assigned = [], sorted((a, b) for a, b, kind in base if kind == "assign")

    def known(a: int, b: int) -> bool:
        k = bisect_left(assigned, (a + 1,)) - 1
        return k >= 0 and b <= assigned[k][1] and text[a - 1] in "=."

    if ":" in text or "=" in text:
        out += [(*m.span(), "account") for m in ACCOUNT.finditer(text)]
    out += [(*m.span(), "endpoint") for m in ENDPOINT.finditer(text)]
    return out + [(*m.span(), "random") for m in RANDOM.finditer(text) if looks_random(m[0]) and not known(*m.span())]


def linked(text: str, base: list[tuple[int, int, str]], weak: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """The weak parts that a complementary part, base or weak, stands together with in a scope."""
    if not weak or len(base) + len(weak) < 2:
        return []
    breaks = [m.start() for m in _BLANK.finditer(text)]
    parts: dict[str, list[tuple[int, int]]] = {"secret": [], "id": [], "place": []}
    for a, b, kind in base + weak:
        if kind != "hex" or not text[a:b].isdigit():  # a long number is no secret that a place completes
            parts[ROLE[kind]].append((a, b))
    longest = {}
    for role, spans in parts.items():
        spans.sort()
        longest[role] = max((b - a for a, b in spans), default=0)
    out = []
    for a, b, kind in weak:
        scope = bisect_left(breaks, a)
        for role in NEEDS[ROLE[kind]]:
            spans = parts[role]
            k = bisect_left(spans, (a - REACH - longest[role],))
            while k < len(spans) and spans[k][0] <= b + REACH:
                x, y = spans[k]
                if y >= a - REACH and (y <= a or x >= b) and bisect_left(breaks, x) == scope:
                    out.append((a, b, kind))
                    break
                k += 1
            else:
                continue
            break
    return out


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1])))


def scan(text: str) -> tuple[int, int, int, str, str, int]:
    """Base counts, digest of the base spans, all spans, and the number of linked weak parts."""
    base = base_spans(text)
    more = linked(text, base, weak_spans(text, base))
    count = Counter(kind for _, _, kind in base)
    own = _joined(base)
    return count["assign"], count["access"], count["hex"], hashlib.sha256(own.encode()).hexdigest(), _joined(base + more) if more else own, len(more)


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_linked long"
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string()), ("n_linked", pa.int64())])


def _scans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [scan(x.as_py()) for x in b.column(1)]
        yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([r[k] for r in rows], _ARROW.field(k + 1).type) for k in range(6))], schema=_ARROW)


def find_secrets(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text, ...)`` -> a row for each input row: counts of the base kinds, SHA-256 of
    their spans, and all spans as ``kind:start:end`` in code points, end exclusive.

    Null counts as the empty text: no spans. Repeated rows repeat, a null doc_id is carried, an empty
    table gives no rows, other columns are ignored. The work of a text grows with its length."""
    share_code(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of()).mapInArrow(_scans, SCHEMA)
