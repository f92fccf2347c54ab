"""What executors hold in memory: batches, tables that workers keep, and the workers themselves."""

import tracemalloc

import numpy as np
import pyarrow as pa
from samples import prose

from sigloom.llm import common, kenlm, quality


def test_python_workers_get_small_batches(spark, monkeypatch):
    def seen(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([b.nbytes])], ["doc_id", "n_words"])

    monkeypatch.setattr(quality, "_batches", seen)
    monkeypatch.setattr(quality, "SCHEMA", "doc_id long, n_words long")
    docs = spark.range(0, 40, 1, 1).selectExpr("id AS doc_id", "repeat('x', 500000) AS text")
    size = [r.n_words for r in quality.measures(docs).collect()]
    assert sum(size) >= 20_000_000
    assert max(size) < 2 * common.ARROW_BYTES


def test_a_limit_of_the_session_stays(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    try:
        spark.conf.set(key, "1234567")
        common.in_arrow(spark.range(1), iter, "id long").collect()
        assert spark.conf.get(key) == "1234567"
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def test_small_tables_need_no_python_worker(spark):
    df = common.from_arrays(spark, g=np.arange(3), w=np.ones(3))
    assert df.dtypes == [("g", "bigint"), ("w", "double")]
    assert [tuple(r) for r in df.orderBy("g").collect()] == [(0, 1.0), (1, 1.0), (2, 1.0)]
    assert "PythonRDD" not in df._jdf.queryExecution().toRdd().toDebugString()


def _levels():
    rng = np.random.default_rng(3)
    parts = []
    for n in range(1, kenlm.ORDER + 1):
        g = rng.choice(kenlm.SYMBOLS**n, 50, replace=False)
        h = rng.choice(kenlm.SYMBOLS ** (n - 1), min(30, kenlm.SYMBOLS ** (n - 1)), replace=False)
        parts.append((g, rng.random(len(g)).astype(np.float32), h, rng.random(len(h)).astype(np.float32)))
    return parts


def test_the_dense_table_is_made_in_place():
    parts = _levels()
    tracemalloc.start()
    try:
        got = kenlm.dense(parts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 1.5 * got.nbytes
    below = np.full(kenlm.SYMBOLS, 1 / kenlm.SYMBOLS, np.float32)
    for n, (g, p, h, back) in enumerate(parts, 1):
        rest = np.ones(kenlm.SYMBOLS ** (n - 1), np.float32)
        rest[h] = back
        below = np.repeat(rest, kenlm.SYMBOLS) * (below if n == 1 else np.tile(below, kenlm.SYMBOLS))
        below[g] += p
    assert np.array_equal(got, np.log(np.maximum(below, 1e-12)))


def test_rounds_do_not_keep_the_dense_table(spark):
    texts = spark.createDataFrame([(prose(1),)], "text string").coalesce(1)

    def left(run):
        def go(batches):
            kenlm._DENSE["one"] = np.zeros(1)
            for _ in run(batches):
                pass
            yield pa.RecordBatch.from_arrays([pa.array([len(kenlm._DENSE)])], ["n"])

        return go

    row = texts.selectExpr("text", "1L AS _row")
    for run in (kenlm._trigrams(1, 0, 4), kenlm._pack_texts(1, 0, 4, np.zeros(0, np.uint64))):
        assert row.mapInArrow(left(run), "n long").collect()[0].n == 0
