import itertools

import numpy as np
from pyspark.sql import functions as F

from sigloom.llm import chat as c


def model(spark, data):
    return c.train(spark.read.parquet(f"{data}/conversations.parquet"))


def test_paths_equal_brute_force(spark, data):
    m, r = model(spark, data), np.random.default_rng(3)
    for n in (1, 2, 5):
        e = r.normal(size=(n, 3))
        score = lambda p: m.start[p[0]] + sum(m.step[a, b] for a, b in zip(p, p[1:], strict=False)) + sum(e[i, s] for i, s in enumerate(p))  # noqa: E731,B023
        best = max(itertools.product(range(3), repeat=n), key=score)
        assert tuple(c.path(m, e, None, None)) == best


def test_ranges_give_the_same_path(spark, data, monkeypatch):
    messages = spark.read.parquet(f"{data}/conversations.parquet")
    m = c.train(messages)
    whole = {(r.conv_id, r.turn): r.roles for r in c.parse(messages, m).collect()}
    monkeypatch.setattr(c, "RANGE", 2)
    assert {(r.conv_id, r.turn): r.roles for r in c.parse(messages, m).collect()} == whole


def test_roles_of_held_out_conversations_are_recovered(spark):
    messages = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    m = c.train(messages.where(~c.is_held_out(messages.conv_id)))
    got = c.parse(messages, m).where(c.is_held_out(F.col("conv_id"))).select("conv_id", "turn", "roles")
    rows = got.join(messages, ["conv_id", "turn"]).collect()
    assert len(rows) > 80 and sum(r.roles == r.role for r in rows) / len(rows) > 0.95


def test_the_tables_are_counts(spark, data):
    rows = spark.read.parquet(f"{data}/conversations.parquet").collect()
    m = model(spark, data)
    turns, first = {(r.conv_id, r.turn): r.role for r in rows}, {}
    for r in sorted(rows, key=lambda r: r.turn):
        first.setdefault(r.conv_id, r.role)
    share = lambda n, of, k: np.log((n + c.SMOOTH) / (of + c.SMOOTH * k))
    for i, a in enumerate(c.ROLES):
        assert np.isclose(m.start[i], share(sum(x == a for x in first.values()), len(first), 3))
        after = [turns[i, t + 1] for (i, t), role in turns.items() if role == a and (i, t + 1) in turns]
        for j, b in enumerate(c.ROLES):
            assert np.isclose(m.step[i][j], share(after.count(b), len(after), 3))
        seen = [f for r in rows if r.role == a for f in c.observations(r.text)]
        lines = sum(f.startswith("line") and not f.startswith("lines") for f in seen)
        assert np.isclose(m.emit["line3"][i], share(seen.count("line3"), lines, len(c.WORD_STEPS) + 1))


def test_parse_equals_one_viterbi_pass_a_conversation(spark, data, monkeypatch):
    rows = [(r.conv_id, r.turn, r.text) for r in spark.read.parquet(f"{data}/conversations.parquet").collect()]
    rows += [(9000, k % 7 if k % 3 else None, f"User: a {k}\nok {k}?\nBot: b") for k in range(40)] + [(9000, 3, "same"), (9000, 3, "same")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, text string")
    m, want = model(spark, data), []
    hashed = df.withColumn("h", F.xxhash64("text")).collect()
    for conv in {r.conv_id for r in hashed}:
        own = sorted((r for r in hashed if r.conv_id == conv), key=lambda r: (r.turn is not None, r.turn or 0, r.h))
        parts = [c.parts(r.text) for r in own]
        found = c.path(m, np.array([m.scores(*p) for x in parts for p in x]), None, None)
        for r, x in zip(own, parts, strict=True):
            names, found = [c.ROLES[k] for k in found[: len(x)]], found[len(x) :]
            want.append((conv, r.turn, len(x), ",".join(names), "".join(f"<|{n}|>\n{t.strip()}\n<|end|>\n" for n, (_, t) in zip(names, x, strict=True))))
    for size in (1024, 3):
        monkeypatch.setattr(c, "RANGE", size)
        assert sorted(map(str, map(tuple, c.parse(df, m).collect()))) == sorted(map(str, want))


def test_rows_without_a_conversation_stand_alone_and_null_turns_are_spread(spark, data):
    rows = [(None, k, f"User: {k}\nBot: yes") for k in range(50)] + [(1, None, f"text {k}") for k in range(500)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, text string")
    got = c.parse(df, model(spark, data)).collect()
    assert len(got) == 550 and all(r.roles == "user,assistant" for r in got if r.conv_id is None)
    assert c._cut(df).where("conv_id = 1").select("range").distinct().count() > 100


def test_markers_cut_a_message(spark, data):
    df = spark.createDataFrame([(1, 0, "User: hi there\nBot: hello\nsecond line\n**User**: ok?")], "conv_id long, turn long, text string")
    r = c.parse(df, model(spark, data)).first()
    assert r.roles == "user,assistant,user" and r.n_parts == 3
    assert r.rendered == "<|user|>\nhi there\n<|end|>\n<|assistant|>\nhello\nsecond line\n<|end|>\n<|user|>\nok?\n<|end|>\n"


def test_edges(spark, data):
    rows = [(1, 0, None, "user"), (1, 0, None, "user"), (None, None, "x", None), (2, None, "", "odd"), (2, 5, "word " * 30_000, "assistant"), (2, 5000, "y", "user")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, text string, role string").selectExpr("*", "1 AS range", "2 AS last", "3 AS roles")
    got = c.parse(df, c.train(df)).collect()
    assert len(got) == len(rows) and all(r.roles for r in got)
    none = df.where("conv_id > 9")
    assert c.parse(none, c.train(none)).count() == 0
