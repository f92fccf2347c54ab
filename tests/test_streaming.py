from pyspark.sql import functions as F

from sigloom.streaming import engine, processors


def replay(spark, df, build, path, order="arrival", mode="append"):
    """Rows of a stream operator over ``df`` as an ordered replay of files, and of its state between them."""
    n = df.count()
    cut = n // 3 + 1
    for k in range(3):
        df.where((F.col(order) >= k * cut) & (F.col(order) < (k + 1) * cut)).coalesce(1).write.mode("append").parquet(f"{path}/in")
    out = []
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    q = build(stream).writeStream.foreachBatch(lambda b, _: out.extend(tuple(r) for r in b.collect())).outputMode(mode).option("checkpointLocation", f"{path}/cp").trigger(availableNow=True).start()
    q.awaitTermination()
    return sorted(out)


def test_sequence_stream_equals_batch(spark, tmp_path):
    df = spark.range(60).select((F.col("id") % 2).cast("string").alias("key"), F.col("id").alias("arrival"), F.when(F.col("id") % 7 == 0, F.col("id") - 9).otherwise(F.col("id") * 1).alias("seq"))
    want = sorted(tuple(r) for r in processors.sequence_verdicts(df).collect())
    assert replay(spark, df, processors.stream_sequence, tmp_path) == want


def test_window_stream_equals_batch(spark, tmp_path):
    ts = F.when(F.col("id") % 19 == 18, F.col("id") - 30).when(F.col("id") > 70, F.col("id") + 50).otherwise(F.col("id"))
    df = spark.range(120).select(F.lit("s").alias("key"), F.col("id").alias("arrival"), ts.alias("ts"), (F.col("id") % 5).alias("v"))
    want = sorted(tuple(r) for r in processors.count_windows(df, 4, 3, 1).collect())
    assert want and replay(spark, df, lambda s: processors.stream_windows(s, 4, 3, 1), tmp_path) == want


def test_a_failing_sink_does_not_stop_the_others(spark, tmp_path):
    spark.range(10).selectExpr("id AS seq").write.parquet(f"{tmp_path}/in")
    got = []
    sinks = {"good": lambda b, _: got.extend(r.seq for r in b.collect()), "bad": lambda b, _: 1 / 0, "files": engine.rotating_files(f"{tmp_path}/out", 4)}
    stream = spark.readStream.schema("seq long").parquet(f"{tmp_path}/in")
    report = engine.run(stream, sinks, f"{tmp_path}/cp")
    assert sorted(got) == list(range(10)) and report.windows_in == 10 and report.dropped == 0
    assert report.consumed == {"good": 10, "bad": 0, "files": 10} and "ZeroDivisionError" in report.errors["bad"]
    assert 'sink_errored{sink="bad"} 1' in report.prometheus()
    assert {r.part for r in spark.read.parquet(f"{tmp_path}/out").select("part").collect()} == {0, 1, 2}


def test_layout_and_receipts(spark):
    w = spark.createDataFrame([("r", 0, 2, 10, 250), ("r", 1, 2, 10, 250), ("r", 2, 3, 10, 250)], "recording string, seq long, channels int, length int, rate int")
    assert [r.seq for r in processors.check_layout(w).collect()] == [2]
    r = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3)], "token string, seq long")
    assert sorted((x.token, x.seq) for x in processors.deliver(r).collect()) == [("a", 1), ("b", 3)]


def last_of(rows):
    """Of rows in order of their batches, the last one of each key."""
    return sorted({r[0]: r for r in rows}.values())


def test_progress_stream_ends_where_batch_does(spark, tmp_path):
    state = F.when(F.col("id") == 31, "error").when(F.col("id") == 50, "done").otherwise("running")
    df = spark.range(60).select((F.col("id") % 2).cast("string").alias("key"), F.col("id").alias("arrival"), F.col("id").alias("ts"), state.alias("state"))
    want = sorted(tuple(r) for r in processors.progress(df).collect())
    got = replay(spark, df, processors.stream_progress, tmp_path, mode="update")
    assert want == [("0", 30, 58, "done", True), ("1", 30, 59, "error", True)] and last_of(sorted(got, key=lambda r: r[1])) == want


def test_layout_stream_equals_batch(spark, tmp_path):
    length = F.when(F.col("id").isin(13, 40), 249).otherwise(250)
    df = spark.range(60).select((F.col("id") % 2).cast("string").alias("recording"), F.col("id").alias("seq"), F.lit(21).alias("channels"), length.alias("length"), F.lit(250).alias("rate"))
    want = sorted(tuple(r) for r in processors.check_layout(df).select("recording", "seq", "channels", "length", "rate").collect())
    assert [r[1] for r in want] == [40, 13] and replay(spark, df, processors.stream_layout, tmp_path, "seq") == want


def test_receipt_ledger_stream_equals_batch(spark, tmp_path):
    df = spark.range(60).select((F.col("id") % 2).cast("string").alias("key"), F.col("id").alias("seq"), (F.col("id") * 7 % 22).cast("string").alias("token"))
    want = sorted(tuple(r) for r in processors.admit(df, 5).collect())
    assert {r[3] for r in want} == {"accepted", "duplicate", "full"} and sum(r[3] == "accepted" for r in want) == 10
    assert replay(spark, df, lambda s: processors.stream_admit(s, 5), tmp_path, "seq") == want


def test_evidence_beyond_the_ledger_is_counted(spark):
    df = spark.range(7).select((F.col("id") % 2).alias("key"), F.col("id").alias("at"), F.lit("late").alias("issue"))
    got = sorted((r.key, r.at or -1, r.issue, r.suppressed) for r in processors.evidence(df, "key", "at", 3).collect())
    assert got == [(0, -1, "late", 0), (0, -1, "overflow", 1), (0, 2, "late", 0), (0, 4, "late", 0), (1, 1, "late", 0), (1, 3, "late", 0), (1, 5, "late", 0)]


def test_watched_folder_gives_each_file_once(spark, tmp_path):
    from sigloom.sources import views

    (tmp_path / "in" / "deep").mkdir(parents=True)
    for name in ("a.edf", "deep/b.lml", "c.txt"):
        (tmp_path / "in" / name).write_bytes(b"LML1" + name.encode())
    got = []
    for more in (None, "d.bdf"):
        if more:
            (tmp_path / "in" / more).write_bytes(b"x")
        q = views.watch(spark, str(tmp_path / "in")).writeStream.foreachBatch(lambda b, _: got.extend((r.path.rsplit("/", 1)[1], r.profile) for r in views.inspect(b).collect())).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination()
    assert sorted(got, key=str) == [("a.edf", "LML1"), ("b.lml", "LML1"), ("d.bdf", None)]
