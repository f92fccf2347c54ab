import pytest

from sigloom.plans import passes, reports


def samples(spark):
    return spark.createDataFrame([("r", t, t * t % 31) for t in range(20)], "recording string, t long, v long")


def test_a_chain_is_undone(spark):
    chain = passes.build("offset by=5  ; first\n# nothing\nnegate\nlift")
    s = samples(spark)
    assert sorted(map(tuple, chain.undo(chain.run(s)).select("t", "v").collect())) == sorted(map(tuple, s.select("t", "v").collect()))
    assert chain.to_json() == '[{"pass": "offset", "by": 5}, {"pass": "negate"}, {"pass": "lift"}]'


def test_a_lossy_pass_is_refused():
    with pytest.raises(ValueError, match="lossy"):
        passes.build("strip bits=2")
    with pytest.raises(ValueError):
        passes.build("strip bits=2", lossless=False).undo(None)


def test_the_text_form():
    assert passes.parse('a x=1, y=2.5 z="q ; \\"r\\""') == [("a", {"x": 1, "y": 2.5, "z": 'q ; "r"'})]
    for bad in ("a x", "=1", "a x=1 y"):
        with pytest.raises(ValueError):
            passes.parse(bad)


def test_an_unknown_pass_names_the_known_ones():
    with pytest.raises(KeyError, match="lift, negate, offset, strip"):
        passes.default_registry().build("x")


def test_the_manifest_comes_back(spark, tmp_path):
    row = ("in", None, "success", 10, 4, 2.5, 1.0, None, None, 0.5, True)
    df = spark.createDataFrame([row], reports.MANIFEST)
    reports.write_manifest(df, str(tmp_path / "m"))
    assert tuple(reports.read_manifest(spark, str(tmp_path / "m")).first()) == row


def test_receipts_are_given_once(spark):
    got = spark.createDataFrame([("h1", "a"), ("h1", "b"), ("h2", "c")], "source_hash string, path string")
    known = spark.createDataFrame([("h2",)], "source_hash string")
    assert [tuple(r) for r in reports.receipts(got, known).collect()] == [("h1", "a")]


def test_json_manifest(spark, tmp_path):
    import json

    from sigloom.plans import reports

    rows = [("d/a.edf", "a.lml", "success", 100, 40, 2.5, 1.0, None, 0.0, 1.0, True), ("d/b.edf", None, "failed", 50, None, None, 1.0, "bad", None, None, None)]
    reports.write_json_manifest(spark.createDataFrame(rows, reports.MANIFEST), str(tmp_path), {"codec": "x"})
    (totals,) = (json.loads(r.value) for r in spark.read.text(f"{tmp_path}/totals").collect())
    assert totals["run"] == {"codec": "x"} and totals["statistics"]["files_ok"] == 1 and totals["statistics"]["compression_ratio"] == 2.5
    files = sorted((json.loads(r.value) for r in spark.read.text(f"{tmp_path}/files").collect()), key=str)
    assert files == [{"path": "a.edf", "bytes_in": 100, "bytes_out": 40, "ratio": 2.5, "status": "success"}, {"path": "b.edf", "bytes_in": 50, "status": "failed"}]


def test_status_lines_of_a_stream(spark, tmp_path):
    import json
    import time

    from sigloom.plans import reports

    got = []
    listener = reports.StatusLines(got.append)
    spark.streams.addListener(listener)
    try:
        spark.range(9).write.parquet(f"{tmp_path}/in")
        spark.readStream.schema("id long").parquet(f"{tmp_path}/in").writeStream.foreachBatch(lambda b, _: b.count()).option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination()
        for _ in range(50):
            if any('"ended"' in x for x in got):
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    kinds = [json.loads(x) for x in got]
    assert kinds[0]["type"] == "started" and kinds[-1]["type"] == "ended" and sum(k.get("rows", 0) for k in kinds) == 9
