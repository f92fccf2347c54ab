import random

import pytest
from pyspark.sql import functions as F

from sigloom import catalog
from sigloom.operators import aggregates, catalogs, joins, metrics, windows


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_dialects_on_silent_and_flat_signals(spark):
    p = spark.createDataFrame([("silent", 0, 0, 1), ("silent", 1, 0, 1), ("same", 0, 5, 5), ("same", 1, 5, 5), ("ok", 0, 3, 3), ("ok", 1, 4, 5)], "recording string, t long, x long, y long")
    by = {d: {r.recording: r for r in metrics.metrics(p, d).collect()} for d in metrics.DIALECTS}
    assert by["strict"]["silent"].prd == float("inf") and by["capped"]["silent"].prd == 100
    assert by["capped"]["same"].r == 1.0 and by["strict"]["same"].r == 0.0
    assert by["strict"]["same"].snr_db == float("inf") and by["capped"]["same"].snr_db == 120
    assert by["strict"]["ok"].prd == 20.0 and by["strict"]["ok"].max_error == 1 and not by["strict"]["ok"].lossless
    with pytest.raises(ValueError):
        metrics.metrics(p, "other")


def test_contracts_differ(spark):
    m = spark.createDataFrame([("a", 22.0, 0.9, 150.0)], "recording string, prd double, r double, cr double")
    passed = {r.level: r.passed for r in metrics.check_contract(m.drop("cr")).collect()}
    assert passed == {"L": False, "C": False, "M": False, "A": True}
    assert {r.level: r.passed for r in metrics.gate(m).collect()}["A"]
    assert [r.violations for r in metrics.codec_contract(m).orderBy("mode").collect()] == [["prd", "r", "cr"], ["prd", "cr"]]


def test_overlaps_of_all_lengths_equal_all_pairs(spark):
    rng = random.Random(7)
    spans = lambda n: [(rng.choice("ab"), k, a := rng.randrange(-3000, 3000), a + rng.choice([-1, 0, 1, 2, 9, 10, 11, 64, 500, 4000])) for k in range(n)]
    r, w = spans(150), spans(150)
    got = joins.overlaps(spark.createDataFrame(r, "k string, r long, lo long, hi long"), spark.createDataFrame(w, "k string, w long, start long, stop long"), "k", 10, ["r", "w"])
    want = sorted((x[1], y[1]) for x in r for y in w if x[0] == y[0] and x[2] < x[3] and y[2] < y[3] and y[2] < x[3] and y[3] > x[2])
    assert len(want) > 100 and rows(got, "r", "w") == want


def test_overlaps_lays_a_long_range_in_few_bins(spark):
    """Behind the last window or over many, a range is a few rows: bins of the windows' size would be 10**11."""
    r = spark.createDataFrame([("a", 0, 10**12)], "k string, lo long, hi long")
    w = spark.range(5000).select(F.lit("a").alias("k"), "id", (F.col("id") * 10).alias("start"), (F.col("id") * 10 + 10).alias("stop"))
    assert joins.overlaps(r, w, "k", 10, ["id"]).count() == 5000


def shuffled(spark, df):
    """Rows that ``df`` writes to shuffle files when it is run, and its rows."""
    sc = spark.sparkContext

    def stages():
        sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        none = spark._jvm.java.util.ArrayList()
        got = sc._jsc.sc().statusStore().stageList(none, False, False, sc._gateway.new_array(spark._jvm.double, 0), none)
        return {x.stageId(): x.shuffleWriteRecords() for x in (got.apply(k) for k in range(got.size()))}

    last = max(stages(), default=-1)
    found = df.collect()
    return sum(n for k, n in stages().items() if k > last), found


@pytest.fixture
def sized(spark):
    """Spark sends no side of a join to all tasks because it is small, as with large tables."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _many_ranges(spark):
    """5,000 ranges of 1 to 400 over 600 windows of 10, and the number of their pairs; some start before the first or behind the last window."""
    r = spark.range(5000).select(F.lit("a").alias("k"), "id", (F.col("id") * 7919 % 6100 - 50).alias("lo"), (F.col("id") * 7919 % 6100 - 49 + F.col("id") % 400).alias("hi"))
    w = spark.range(600).select(F.lit("a").alias("k"), F.col("id").alias("w"), (F.col("id") * 10).alias("start"), (F.col("id") * 10 + 10).alias("stop"))
    spans = [(a := k * 7919 % 6100 - 50, a + 1 + k % 400) for k in range(5000)]
    return r, w, sum(max(0, (min(b, 6000) + 9) // 10 - max(a, 0) // 10) for a, b in spans)


def test_overlaps_shuffles_no_range_to_few_windows(spark, data, sized):
    r, w, pairs = _many_ranges(spark)
    n, found = shuffled(spark, joins.overlaps(r, w, "k", 10, ["id", "w"]))
    assert len(found) == len(set(found)) == pairs and n < 2500  # copies of the windows
    # of the query, event ids alone are shuffled, to be numbered; each range was sent once or twice
    n, found = shuffled(spark, catalog.QUERIES["join_range_overlap"](spark, data))
    events = spark.read.parquet(f"{data}/events.parquet").count()
    assert found and n < 1.5 * events


def test_overlaps_shuffles_a_range_once_to_many_windows(spark, monkeypatch, sized):
    """Windows that are too many to be broadcast, with the same pairs: also for lengths that differ on both sides."""
    r, w, pairs = _many_ranges(spark)
    monkeypatch.setattr(joins, "MOST_BROADCAST", 599)
    for n_windows in (None, 600):
        n, found = shuffled(spark, joins.overlaps(r, w, "k", 10, ["id", "w"], n_windows))
        assert len(found) == len(set(found)) == pairs
        assert 5000 <= n < 5000 + 600 * 3 * 8  # windows: three bins of at most seven levels, and a few partial sums
    monkeypatch.setattr(joins, "MOST_BROADCAST", -1)
    test_overlaps_of_all_lengths_equal_all_pairs(spark)
    test_overlaps_lays_a_long_range_in_few_bins(spark)


def test_overlaps_of_the_longest_rows_that_a_long_holds(spark, monkeypatch):
    r = [("a", k, a, b) for k, (a, b) in enumerate([(-(2**61), 2**61), (0, 2**62 + 5), (2**62, 2**62 + 1), (-5, 5), (2**62 + 4, 2**62 + 9)])]
    want = sorted((x[1], y[1]) for x in r for y in r if x[2] < y[3] and x[3] > y[2])
    for most in (100, -1):
        monkeypatch.setattr(joins, "MOST_BROADCAST", most)
        for bin_size in (1, 10, 250):
            got = joins.overlaps(spark.createDataFrame(r, "k string, r long, lo long, hi long"), spark.createDataFrame(r, "k string, w long, start long, stop long"), "k", bin_size, ["r", "w"])
            assert rows(got, "r", "w") == want


def test_gather_keeps_order_and_repeats_and_refuses_what_is_not_there(spark):
    table = spark.createDataFrame([(0, "a"), (1, "b")], "row long, v string")
    want = spark.createDataFrame([(0, 1), (1, 0), (2, 1)], "pos long, row long")
    assert [r.v for r in joins.gather(want, table, "row").orderBy("pos").collect()] == ["b", "a", "b"]
    with pytest.raises(Exception, match="no such row"):
        joins.gather(spark.createDataFrame([(0, 9)], "pos long, row long"), table, "row").collect()


def test_as_of_before_the_first_and_behind_the_last(spark):
    w = spark.createDataFrame([("s", 10, 1), ("s", 20, 2)], "k string, start long, n long")
    p = spark.createDataFrame([("s", 5), ("s", 10), ("s", 19), ("s", 99)], "k string, at long")
    assert rows(joins.as_of(p, w, "k", "at", "start", "n").where("n is not null"), "at", "n") == [(10, 1), (19, 1), (99, 2)]
    assert rows(joins.next_or_last(p, w, "k", "at", "start", "n"), "at", "n") == [(5, 1), (10, 1), (19, 2), (99, 2)]


def test_next_or_last_without_a_key_and_by_running_frames_alone(spark):
    p = spark.createDataFrame([("a", 5), ("a", None), (None, 5)], "k string, at long")
    w = spark.createDataFrame([("a", 10, 1), ("a", 20, 2), (None, 10, 3), ("a", None, 4), ("b", None, 5)], "k string, start long, n long")
    got = joins.next_or_last(p, w, "k", "at", "start", "n")
    assert {(r["k"], r["at"]): r["n"] for r in got.collect()} == {("a", 5): 1, ("a", None): 2, (None, 5): None}
    # a frame from each row to the end of its group takes the square of the group's rows
    assert "currentrow$(), unboundedfollowing$()" not in got._jdf.queryExecution().executedPlan().toString().lower()


def test_runs_above_the_cap(spark):
    s = spark.createDataFrame([("r", t, 7 if t < 5 else 1) for t in range(6)], "recording string, t long, v long")
    assert rows(windows.runs(s, cap=2), "t_first", "v", "length") == [(0, 7, 2), (2, 7, 2), (4, 7, 1), (5, 1, 1)]


@pytest.mark.parametrize("n", [1, 2, 3, 8, 9])
def test_lifting_inverts_at_edges(spark, n):
    s = spark.createDataFrame([("r", t, (t * 37) % 23 - 11) for t in range(n)], "recording string, t long, v long")
    assert rows(windows.lifting_inverse(windows.lifting_forward(s)), "t", "v") == rows(s, "t", "v")


def test_empty_tables(spark):
    e = spark.createDataFrame([], "recording string, t long, v long")
    for df in (aggregates.channel_stats(e), windows.bias_cancel(e), windows.lifting_forward(e), windows.runs(e), windows.noise_bits(e), aggregates.histogram(e, "v", "recording")):
        assert df.count() == 0


def test_first_seen_and_offsets(spark):
    e = spark.createDataFrame([("a", "x/1", 5, "h"), ("a", "x/2", 5, "h"), ("a", "x/3", 7, "g")], "archive string, path string, size long, sha256 string")
    got = catalogs.offsets(catalogs.first_seen(e), "archive", "path")
    assert rows(got, "path", "dedup", "offset") == [("x/1", False, 0), ("x/2", True, 5), ("x/3", False, 5)]


def test_scaled_windows():
    assert windows.scaled_window(2500, 500) == 5000
    with pytest.raises(ValueError):
        windows.scaled_window(1, 10)


def test_a_declared_modality_wins(spark):
    d = spark.createDataFrame([(1, "I", "ECG file"), (1, "EEG C3", None)], "recording long, label string, hint string")
    assert aggregates.vote_modality(d, hint="hint").first().modality == "ecg"


def test_select_channels_takes_the_first_index(spark):
    names = [(1, k, c) for k, c in enumerate(catalogs.MONTAGE)] + [(1, 99, "EEG Fp1-REF"), (2, 0, "Cz")]
    got = catalogs.select_channels(spark.createDataFrame(names, "recording long, idx long, label string"))
    assert got.count() == 21 and got.where("channel = 'Fp1'").first().idx == 0


def test_nearest_rank_differs_from_interpolation(spark):
    d = spark.createDataFrame([("a", float(v)) for v in range(10)], "k string, v double")
    assert aggregates.ranked_percentiles(d, "v", "k", {"p95": 0.95}).first().p95 == 9
    assert aggregates.robust_summary(d, "v", "k").first().p95 == 8.55


def test_pushdown_reaches_the_scan(spark, data):
    plan = spark.read.parquet(f"{data}/events.parquet").where("event_type = 'click'").groupBy("user_id").agg(F.sum("value"))._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(event_type)" in plan and "props" not in plan.split("ReadSchema")[-1]


@pytest.mark.parametrize("block", [64, 100])
def test_blocks_give_what_whole_recordings_give(spark, block):
    s = spark.range(700).select(F.concat(F.lit("r"), (F.col("id") % 2).cast("string")).alias("recording"), F.floor(F.col("id") / 2).alias("t"), (F.col("id") * 7919 % 1013 - 500).alias("v"))
    place = "2 * idx + CASE WHEN band = 'detail' THEN 1 ELSE 0 END"
    for kernel, before, after, at, cols in (
        (windows.bias_cancel, 32, 0, "t", ("recording", "t", "residual")),
        (lambda x: windows.lpc_residual(x, [90_000_000, -9_000_000]), 2, 0, "t", ("recording", "t", "residual")),
        (windows.first_difference, 1, 0, "t", ("recording", "t", "delta")),
        (lambda x: windows.moving_average(x, 5), 2, 2, "t", ("recording", "t", "ma")),
        (windows.lifting_forward, 4, 4, place, ("recording", "band", "idx", "v")),
    ):
        assert rows(windows.blocked(s, kernel, before, after, block, at), *cols) == rows(kernel(s), *cols)
    with pytest.raises(ValueError):
        windows.blocked(s, windows.bias_cancel, 32, 0, 32)


def test_numbering_by_ranges(spark):
    e = spark.range(500).select((F.col("id") * 13 % 501).alias("k"), (F.col("id") % 3).alias("g"))
    got = {(r.g, r.k): r.t for r in windows.numbered(e, "g", "k", block=50).collect()}
    for g in range(3):
        ks = sorted(k for a, k in got if a == g)
        assert [got[g, k] for k in ks] == list(range(len(ks)))


def test_percentiles_are_exact_beyond_the_ranked_size(spark, monkeypatch):
    """A group above the size that is ranked whole, one with a value that most rows share, a null group and nulls."""
    import numpy as np

    monkeypatch.setattr(aggregates, "RANKED", 1000)
    monkeypatch.setattr(aggregates, "SKETCH", 1000)
    big, same = np.random.default_rng(0).normal(size=30_000) ** 3, [1.0] * 5000 + [2.0, -7.0]
    rows = [("big", float(x)) for x in big] + [("same", x) for x in same] + [(None, 4.0), (None, 8.0), ("big", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(7)
    got = {r.g: r for r in aggregates.percentiles(df, "x", {"a": 0.05, "b": 0.5, "c": 0.999}, "g").collect()}
    assert np.allclose([got["big"][n] for n in "abc"], np.percentile(big, [5, 50, 99.9]), rtol=0, atol=1e-12)
    assert np.allclose([got["same"][n] for n in "abc"], np.percentile(same, [5, 50, 99.9])) and got[None].b == 6.0
    ranked = {r.g: r for r in aggregates.ranked_percentiles(df, "x", "g", {"a": 0.05, "z": 1.0}).collect()}
    assert ranked["big"].a == np.sort(big)[1500] and ranked["big"].z == big.max() and ranked["same"].z == 2.0


def test_second_electrodes_fill_what_is_missing(spark):
    labels = [("r", k, c) for k, c in enumerate(catalogs.MONTAGE[:15])] + [("r", 20, "F7-T6"), ("r", 21, "F8-A1"), ("few", 0, "Cz")]
    got = {r.channel: r.idx for r in catalogs.select_channels(spark.createDataFrame(labels, "recording string, idx int, label string")).collect()}
    assert len(got) == 16 and got["T6"] == 20 and "A1" not in got and got["F7"] == catalogs.MONTAGE.index("F7")


def test_principal_axes_rebuild_the_covariance(spark):
    import numpy as np

    x = np.random.default_rng(2).normal(size=(200, 5)) @ np.random.default_rng(3).normal(size=(5, 5))
    df = spark.createDataFrame([(i, d, float(x[i, d])) for i in range(200) for d in range(5)], "item int, dim int, x double")
    got = aggregates.principal_axes(df, "item", "dim", "x").orderBy("component", "dim").collect()
    axes, variance = np.array([r.weight for r in got]).reshape(5, 5), np.array([got[5 * k].variance for k in range(5)])
    assert np.allclose(axes.T @ np.diag(variance) @ axes, np.cov(x.T)) and (np.diff(variance) <= 0).all()
    with pytest.raises(ValueError):
        aggregates.principal_axes(df, "item", "dim", "x", most=4)
