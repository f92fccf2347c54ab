"""Archives of files: a manifest of what is inside, payloads stored once by content, a checksum.

Layout, little-endian: ``SGA1`` | manifest length u64 | manifest (JSON) | payloads | SHA-256 of all before.
"""

from __future__ import annotations

import hashlib
import json
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from sigloom.sources.edf import files

MAGIC = b"SGA1"
MANIFEST = "archive string, path string, original_size long, packed_size long, method string, sha256 string, offset long, dedup boolean"
CONTENT = "archive string, path string, content binary, verified boolean"
#: Extensions that are packed already.
STORED = ("zst", "gz", "bz2", "xz", "zip", "7z", "png", "jpg", "jpeg")


def pack(entries: list[tuple[str, bytes]]) -> bytes:
    """An archive of ``(path, content)``, in path order; content that was seen before is not stored again."""
    seen: dict[str, dict] = {}
    manifest, body = [], bytearray()
    for path, content in sorted(entries):
        if path.startswith("/") or ".." in path.split("/"):
            raise ValueError(f"a path that leads out of the archive: {path}")
        sha = hashlib.sha256(content).hexdigest()
        first = seen.get(sha)
        if first:
            manifest.append({**first, "path": path, "dedup": True})
            continue
        small = zlib.compress(content) if path.rsplit(".", 1)[-1].lower() not in STORED else content
        method = "deflate" if len(small) < len(content) else "store"
        raw = small if method == "deflate" else content
        entry = {"path": path, "original_size": len(content), "packed_size": len(raw), "method": method, "sha256": sha, "offset": len(body), "dedup": False}
        seen[sha] = entry
        manifest.append(entry)
        body += raw
    head = json.dumps(manifest, separators=(",", ":")).encode()
    out = MAGIC + struct.pack("<Q", len(head)) + head + bytes(body)
    return out + hashlib.sha256(out).digest()


def manifest(raw: bytes) -> list[dict]:
    """The entries, from the head alone."""
    if raw[:4] != MAGIC:
        raise ValueError("not an archive")
    (size,) = struct.unpack_from("<Q", raw, 4)
    return json.loads(raw[12 : 12 + size])


def unpack(raw: bytes) -> list[tuple[str, bytes, bool]]:
    """Path, content and whether its hash is that of the manifest."""
    entries = manifest(raw)
    if hashlib.sha256(raw[:-32]).digest() != raw[-32:]:
        raise ValueError("the archive's checksum does not match")
    (size,) = struct.unpack_from("<Q", raw, 4)
    base, out = 12 + size, []
    for e in entries:
        part = raw[base + e["offset"] : base + e["offset"] + e["packed_size"]]
        content = zlib.decompress(part) if e["method"] == "deflate" else part
        out.append((e["path"], content, hashlib.sha256(content).hexdigest() == e["sha256"]))
    return out


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in MANIFEST.split(", ")]
    for b in batches:
        rows = [{"archive": p, **e} for p, c in zip(b.column(0).to_pylist(), b.column(1), strict=True) for e in manifest(c.as_py())]
        kinds = {"original_size": pa.int64(), "packed_size": pa.int64(), "offset": pa.int64(), "dedup": pa.bool_()}
        yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds.get(n, pa.string())) for n in names], names)


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for p, c in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            got = unpack(c.as_py())
            yield pa.RecordBatch.from_arrays([pa.array([p] * len(got), pa.string()), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.binary()), pa.array([g[2] for g in got], pa.bool_())], ["archive", "path", "content", "verified"])


def list_archives(spark: SparkSession, path: str) -> DataFrame:
    """Manifest rows of every archive below ``path``."""
    return files(spark, path, "*.sga").select("path", "content").mapInArrow(_listed, MANIFEST)


def open_archives(spark: SparkSession, path: str, dataset: str | None = None) -> DataFrame:
    """Contents of every archive below ``path``, or of one top folder in them, with their check."""
    got = files(spark, path, "*.sga").select("path", "content").mapInArrow(_opened, CONTENT)
    return got.where(got["path"].startswith(f"{dataset}/")) if dataset else got
