"""Array files: ``.npy`` signals of channels by samples, read through Spark's ``binaryFile`` source."""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from sigloom.sources.edf import files

WINDOW = 2500
ROWS = "path string, channel int, seq long, t_first long, samples array<float>"


def signal(raw: bytes) -> np.ndarray:
    """A two-dimensional array as 32-bit floats; a leading axis of one is dropped, objects are refused."""
    x = np.load(io.BytesIO(raw), allow_pickle=False)
    if x.ndim == 3 and len(x) == 1:
        x = x[0]
    if x.ndim != 2:
        raise ValueError(f"expected channels by samples, not {x.shape}")
    return x.astype(np.float32, copy=False)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.float32())]
    for b in batches:
        for path, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            for k, x in enumerate(signal(content.as_py())):
                at = list(range(0, len(x), WINDOW))
                cols = [[path] * len(at), [k] * len(at), list(range(len(at))), at, [x[a : a + WINDOW] for a in at]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], [f.split()[0] for f in ROWS.split(", ")])


def read(spark: SparkSession, path: str) -> DataFrame:
    """Windows of every array file below ``path``."""
    return files(spark, path, "*.npy").select("path", "content").mapInArrow(_windows, ROWS)
