import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sigloom import catalog
from sigloom.functions import codecs as c
from sigloom.functions import kernels

signals = st.lists(st.integers(-(2**20), 2**20), max_size=120).map(lambda x: np.array(x, np.int64))


@settings(max_examples=60, deadline=None)
@given(signals)
def test_everything_comes_back(x):
    assert (c.bias_restore(c.bias_cancel(x)) == x).all()
    assert (c.fixed_restore(c.fixed_residual(x)) == x).all()
    assert (c.unlift(*c.lift(x)) == x).all()
    assert (c.rice_decode(c.rice_encode(x)) == x).all()
    assert (c.sparse_decode(c.sparse_encode(x)) == x).all()
    assert (c.runs_unpack(c.runs_pack(x)) == x).all()
    assert (c.unrotate(c.rotate(x)) == x).all()
    assert (c.decode_window(c.encode_window(x)) == x).all()


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 15), min_size=1, max_size=200))
def test_range_coder(symbols):
    s = np.array(symbols)
    f = c.frequencies(np.bincount(s, minlength=16), 1 << 12)
    assert f.sum() == 1 << 12
    assert (c.rans_decode(c.rans_encode(s, f), len(s), f) == s).all()


def test_a_damaged_packet_is_refused():
    raw = bytearray(c.encode_window(np.arange(100)))
    raw[30] ^= 1
    with pytest.raises(ValueError):
        c.decode_window(bytes(raw))


def test_scalar_specification_of_bias_cancelling():
    x = np.random.default_rng(1).integers(-500, 500, 200)
    want = [int(x[i]) - sum(int(v) for v in x[max(0, i - 32) : i]) // 32 for i in range(len(x))]
    assert c.bias_cancel(x).tolist() == want


def test_spectra():
    t = np.arange(1000) / 250
    x = np.sin(2 * np.pi * 10 * t)
    p = c.welch(x, 250.0)
    assert abs(np.fft.rfftfreq(256, 1 / 250)[p.argmax()] - 10) < 1
    assert c.psd_divergence(x, x, 250.0) == 0
    assert c.band_prd(x, x, 250.0)["alpha"] == 0
    assert np.abs(c.high_pass(np.ones(2000), 0.5, 250.0)[-10:]).max() < 1e-3


def test_levels_of_a_flat_window_are_in_the_middle():
    assert np.allclose(c.decode_levels(c.encode_levels(np.full(5, 3.0), 8)), 3.0, atol=1e-6)


@settings(max_examples=40, deadline=None)
@given(signals)
def test_floating_kernels_come_back(x):
    assert (c.float_unlift(*c.float_lift(x)) == x).all()
    w = c.float_coefficients(x.astype(float), 4)
    assert np.allclose(c.float_restore_all([c.float_residual(x, w)], [w])[0], x, atol=1e-3)


def test_order_follows_the_band():
    assert [c.band_order(k, 3, 100) for k in range(4)] == [3, 2, 1, 1]
    assert [c.band_order(0, 3, n) for n in (0, 2, 3, 4, 11, 12)] == [0, 0, 1, 1, 2, 3]


def test_walsh_hadamard_of_rows_and_arrays_equals_the_matrix(spark):
    m = np.array([[1 - 2 * (bin(i & j).count("1") % 2) for j in range(32)] for i in range(32)])
    x = np.random.default_rng(3).integers(-5000, 5000, 64)
    want = np.concatenate([m @ x[:32], m @ x[32:]]).tolist()
    arrays = spark.createDataFrame([(0, x.tolist()), (1, []), (2, [3]), (3, None)], "id long, x array<long>")
    got = {r.id: r for r in arrays.select("id", kernels.hadamard(F.col("x")).alias("y")).withColumn("z", kernels.hadamard(F.col("y"), inverse=True)).collect()}
    assert got[0].y == want and got[0].z == x.tolist() and got[1].y == [] and got[2].y == [3] * 32 and not got[3].y
    # a dimension in two rows, a block without values, one that is short
    rows = spark.createDataFrame([("a", d, int(v)) for d, v in enumerate(x)] + [("a", 0, 7), ("b", 0, None), ("c", 33, 2)], "id string, d long, v long")
    y = {(r.id, r.d): r.y for r in kernels.walsh_hadamard(rows, "id", "d", "v").collect()}
    assert [y["a", d] for d in range(64)] == [w + 7 * (d < 32) for d, w in enumerate(want)]
    assert {y["b", d] for d in range(32)} == {None} and [y["c", 32 + d] for d in range(32)] == (2 * m[:, 1]).tolist()


def test_walsh_hadamard_round_trip_keeps_repeated_vectors_and_groups_nothing(spark, tmp_path):
    rows = [(1, [0.5, -1.25] * 32, 0), (1, [0.25, 2.0] * 32, 0)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    back = catalog.QUERIES["walsh_hadamard_round_trip"](spark, str(tmp_path))
    assert sorted((r.dim, r.x) for r in back.collect()) == sorted((d, round(1000 * v)) for _, e, _ in rows for d, v in enumerate(e))
    assert "Exchange" not in back._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["lpc_round_trip", "bias_round_trip", "codec_window_round_trip", "codec_rice_round_trip"])
def test_a_round_trip_is_one_python_worker_a_task(spark, data, name):
    plan = catalog.QUERIES[name](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[0].count("MapInArrow") == 1


def test_windows_are_held_by_their_values(spark, monkeypatch):
    lines = [list(range(n)) for n in (0, 3, 2000, 5, 0, 700, 700, 1)]
    rows = spark.createDataFrame(list(enumerate(lines)), "k long, samples array<long>").coalesce(1)

    def most(many):
        total = sum(map(len, many))
        return [np.r_[x, total, len(many)] for x in many]

    got = {r.k: r.samples for r in c.over_windows(rows, most, many=True).collect()}
    assert [got[k][:-2] for k in range(len(lines))] == lines
    monkeypatch.setattr(c, "VALUES", 1000)
    monkeypatch.setattr(c, "TOGETHER", 3)
    import pyarrow as pa

    column = pa.array([[9], *lines], pa.list_(pa.int64())).slice(1)
    parts = list(c._slices(column))
    assert [n for _, n in parts] == [2, 1, 3, 2] and [list(x) for a, n in parts for x in c._rows(column.slice(a, n))] == lines
