"""Containers of window packets with a seek table, so a reader takes the head alone or a range of windows.

Layout, little-endian: ``SGC1`` | channels u16 | window u32 | rate mHz u64 | packets | seek table | footer.
A packet is that of ``sigloom.functions.codecs`` for one channel of one window; the seek table has
(offset u64, length u32, first sample u64) for each window, whose packets are in channel order, each after its
length u32. The footer is the number of windows u32, the table's offset u64 and the magic.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from sigloom.functions import codecs
from sigloom.sources.edf import files

MAGIC = b"SGC1"
HEAD = struct.Struct("<4sHIQ")
SEEK = struct.Struct("<QIQ")
FOOT = struct.Struct("<IQ4s")
SCHEMA = "path string, seq long, channel int, rate_millihz long, t_first long, samples array<long>"


def pack(data: np.ndarray, window: int, rate_millihz: int) -> bytes:
    """A container of ``data[channel, t]``; the last window may be short."""
    if data.ndim != 2 or not data.shape[0] or not data.shape[1]:
        raise ValueError("no channel or no sample")
    out, seek = bytearray(HEAD.pack(MAGIC, data.shape[0], window, rate_millihz)), []
    for first in range(0, data.shape[1], window):
        at = len(out)
        for x in data[:, first : first + window]:
            p = codecs.encode_window(x)
            out += struct.pack("<I", len(p)) + p
        seek.append(SEEK.pack(at, len(out) - at, first))
    table = len(out)
    return bytes(out + b"".join(seek) + FOOT.pack(len(seek), table, MAGIC))


class Reader:
    def __init__(self, raw: bytes):
        if raw[:4] != MAGIC or raw[-4:] != MAGIC:
            raise ValueError("not a container")
        self.raw = raw
        _, self.channels, self.window, self.rate_millihz = HEAD.unpack_from(raw)
        n, table, _ = FOOT.unpack(raw[-FOOT.size :])
        self.seek = [SEEK.unpack_from(raw, table + k * SEEK.size) for k in range(n)]

    def __len__(self) -> int:
        return len(self.seek)

    def read(self, seq: int) -> np.ndarray:
        """``[channel, t]`` of one window."""
        at, size, _ = self.seek[seq]
        out, end = [], at + size
        while at < end:
            (n,) = struct.unpack_from("<I", self.raw, at)
            out.append(codecs.decode_window(self.raw[at + 4 : at + 4 + n]))
            at += 4 + n
        return np.array(out)

    def at_sample(self, t: int) -> int | None:
        """Window that holds a sample: the last that starts at or before it, none before the first."""
        k = int(np.searchsorted([s[2] for s in self.seek], t, side="right")) - 1
        return k if k >= 0 else None

    def range(self, start: int, end: int) -> range:
        """Windows that overlap samples ``start`` to ``end`` (exclusive); an empty range is an error."""
        if end <= start:
            raise ValueError("an empty range")
        first = [s[2] for s in self.seek]
        return range(max(int(np.searchsorted(first, start, side="right")) - 1, 0), int(np.searchsorted(first, end, side="left")))


def _decode(start: int | None, end: int | None):
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
    names = [f.split()[0] for f in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                r = Reader(content.as_py())
                for seq in range(len(r)) if start is None else r.range(start, end):
                    rows = [(path, seq, c, r.rate_millihz, r.seek[seq][2], x.tolist()) for c, x in enumerate(r.read(seq))]
                    yield pa.RecordBatch.from_arrays([pa.array(col, k) for col, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return run


def read_windows(spark: SparkSession, path: str, start: int | None = None, end: int | None = None) -> DataFrame:
    """Windows of every container below ``path``; with a sample range only those that overlap it are
    decoded."""
    return files(spark, path, "*.sgc").select("path", "content").mapInArrow(_decode(start, end), SCHEMA)


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        r = [Reader(c.as_py()) for c in b.column(1)]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x.channels for x in r], pa.int32()), pa.array([x.window for x in r], pa.int64()), pa.array([x.rate_millihz for x in r], pa.int64()), pa.array([len(x) for x in r], pa.int64())], ["path", "channels", "window", "rate_millihz", "n_windows"])


def inspect(spark: SparkSession, path: str) -> DataFrame:
    """Head of every container below ``path``; no packet is decoded."""
    return files(spark, path, "*.sgc").select("path", "content").mapInArrow(_heads, "path string, channels int, window long, rate_millihz long, n_windows long")


def _packer(window: int, rate_millihz: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [pack(np.array(x.as_py(), np.int64), window, rate_millihz) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], ["name", "content"])

    return run


def pack_rows(recordings: DataFrame, window: int, rate_millihz: int) -> DataFrame:
    """``(name, channels array<array<long>>)`` -> ``(name, content)``, a container for each row."""
    return recordings.select("name", "channels").mapInArrow(_packer(window, rate_millihz), "name string, content binary")
