import numpy as np
import pytest

from sigloom.sources import archive, edf, live, views


def test_edf_round_trip(spark, tmp_path):
    x = {"EEG Fp1-REF": np.arange(-500, 500), "C3": np.arange(1000) * 3}
    (tmp_path / "a.edf").write_bytes(edf.write(x, 250, notes=[(1.5, 2.0, "spike")]))
    got = edf.read_samples(spark, str(tmp_path)).orderBy("channel", "seq").collect()
    assert [r.label for r in got] == list(x) and got[0].rate == 250
    assert got[0].samples == list(range(-500, 500)) and got[1].samples == (np.arange(1000) * 3).tolist()
    note = edf.read_annotations(spark, str(tmp_path)).collect()
    assert [(n.onset, n.duration, n.text) for n in note] == [(1.5, 2.0, "spike")]


def test_int24_sign():
    assert edf.int24(b"\x01\x00\x00\xff\xff\xff\x00\x00\x80").tolist() == [1, -1, -(1 << 23)]


def test_annotation_list():
    assert edf.annotations(b"+1.5\x152\x14a\x14b\x14\x00+2\x14\x14\x00junk\x00") == [(1.5, 2.0, "a"), (1.5, 2.0, "b"), (2.0, None, "")]


def test_archive(spark, tmp_path):
    files = [("x/a.txt", b"hello" * 50), ("x/b.txt", b"hello" * 50), ("y/c.png", b"\x89"), ("z", b"")]
    raw = archive.pack(files)
    (tmp_path / "one.sga").write_bytes(raw)
    listed = {r.path: r for r in archive.list_archives(spark, str(tmp_path)).collect()}
    assert listed["x/b.txt"].dedup and listed["x/b.txt"].offset == listed["x/a.txt"].offset
    opened = {r.path: r for r in archive.open_archives(spark, str(tmp_path)).collect()}
    assert all(bytes(opened[p].content) == c and opened[p].verified for p, c in files)
    assert archive.open_archives(spark, str(tmp_path), "x").count() == 2
    with pytest.raises(ValueError):
        archive.unpack(raw[:-1] + b"\x00")
    with pytest.raises(ValueError):
        archive.pack([("../x", b"")])


def test_live_source_gives_every_window_once(spark, tmp_path):
    live.register(spark)
    got = []
    q = (
        spark.readStream.format("sigloom_ramp").option("windows", 5).option("windowsPerBatch", 2).load()
        .writeStream.foreachBatch(lambda df, _: got.extend(df.collect())).option("checkpointLocation", str(tmp_path)).start()
    )
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    want = {(r.seq, r.channel) for r in views.ramp(spark, 3, 50, 5).collect()}
    assert {(r.seq, r.channel) for r in got} == want and len(got) == len(want)


def test_operation_events(spark):
    lines = spark.createDataFrame([('{"type":"done","success":true,"ms":5}',), ("plain text",)], "line string")
    got = {r.kind: r for r in views.operation_events(lines).collect()}
    assert got["done"].success and got["done"].ms == 5 and got["log"].message == "plain text"


def test_container(spark, tmp_path):
    from sigloom.sources import container

    x = np.random.default_rng(0).integers(-900, 900, (3, 1030)).cumsum(1)
    raw = container.pack(x, 250, 250_000)
    (tmp_path / "a.sgc").write_bytes(raw)
    head = container.inspect(spark, str(tmp_path)).first()
    assert (head.channels, head.window, head.n_windows) == (3, 250, 5)
    got = container.read_windows(spark, str(tmp_path)).collect()
    assert len(got) == 15 and all(r.samples == x[r.channel, r.t_first : r.t_first + 250].tolist() for r in got)
    assert {r.seq for r in container.read_windows(spark, str(tmp_path), 249, 501).collect()} == {0, 1, 2}
    r = container.Reader(raw)
    assert r.at_sample(-1) is None and r.at_sample(0) == 0 and r.at_sample(250) == 1 and r.at_sample(9999) == 4
    with pytest.raises(ValueError):
        r.range(5, 5)
    with pytest.raises(ValueError):
        container.pack(np.zeros((0, 5)), 5, 1)


def test_array_files(spark, tmp_path):
    from sigloom.sources import arrays

    x = np.arange(2 * 5100).reshape(2, 5100)
    np.save(tmp_path / "a.npy", x[None])
    got = arrays.read(spark, str(tmp_path)).collect()
    assert len(got) == 6 and all(r.samples == x[r.channel, r.t_first : r.t_first + 2500].tolist() for r in got)
    with pytest.raises(ValueError):
        arrays.signal((lambda f: (np.save(f, np.zeros(3)), f.getvalue())[1])(__import__("io").BytesIO()))
