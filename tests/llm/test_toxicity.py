import itertools
import random

import pytest

from sigloom.llm import toxicity as t


def test_the_grammar_weighs_what_stands_around():
    s = t.Scorer({"idiot": 2.0, "lowe*": 2.0})
    plain, target, negated, reported = (s.features(x)[0] for x in ("what an idiot", "you are an idiot", "not an idiot", "he said idiot"))
    assert target > plain > negated and plain > 0 and reported < target
    title, quotation, behind = (s.features(x)[0] for x in ("The Idiot is a novel by Dostoevsky", 'a scene called "the idiot"', "an idiot is what you are"))
    assert title == plain < target == behind and quotation < plain
    assert s.features("i will kill you")[0] > 0 and s.features("kill the lights")[0] == s.features("i will kill the lights")[0] == s.features("you kill")[0] == 0
    assert s.features("i will not kill you")[0] < s.features("i will kill you")[0]
    assert s.features("you loweing thing")[0] == target
    assert s.features("idiot. fine. idiot.")[2] > s.features("idiot")[2]
    assert s.features("") == (0.0, 0.0, 0.0)


def slow_clause(kinds):
    """Weight of a clause by looking around each of its insults and threats."""
    total = 0.0
    before = lambda i, kind, reach: any(k == kind for k, _ in kinds[max(0, i - reach) : i])
    for i, (kind, weight) in enumerate(kinds):
        if kind not in ("insult", "threat"):
            continue
        quoted = sum(k == "quote" for k, _ in kinds[:i]) % 2 == 1
        directed = any(k == "target" for k, _ in kinds[max(0, i - 6) : i + 7])
        share = (0.5 if before(i, "negation", 3) else 1) * (0.6 if before(i, "report", i) or quoted else 1)
        if kind == "insult":
            total += weight * share * (1 if directed else 0.6)
        elif directed and before(i, "modal", 4):
            total += weight * share
    return total


def test_all_short_clauses_equal_brute_force():
    g, classes = t.Grammar(), ("", "insult", "threat", "target", "negation", "report", "modal", "quote")
    weigh = lambda kinds: [(k, {"insult": 2.0, "threat": 2.5}.get(k, 0.0)) for k in kinds]
    for n in range(6):
        for kinds in itertools.product(classes, repeat=n):
            assert abs(g.clause(weigh(kinds)) - slow_clause(weigh(kinds))) < 1e-9, kinds
    r = random.Random(5)
    for _ in range(3000):
        kinds = weigh(r.choices(classes, (9, 2, 2, 1, 1, 1, 2, 1), k=r.randint(6, 30)))
        assert abs(g.clause(kinds) - slow_clause(kinds)) < 1e-9, kinds


def test_held_out_rows_follow_the_checksum(spark, data):
    docs, labels = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/labels.parquet")
    got = t.score(docs, labels).collect()
    assert len(got) == docs.count() and all(r.held_out == t.held_out(r.doc_id) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)


def test_held_out_labels_change_nothing(spark, data):
    docs, labels = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/labels.parquet")
    kept = labels.where(~t.is_held_out(labels.doc_id))
    a = {r.doc_id: r.score for r in t.score(docs, labels).collect()}
    assert a == {r.doc_id: r.score for r in t.score(docs, kept).collect()}


def test_held_out_accuracy(spark):
    big = "/root/testdata/sf0.1"
    try:
        docs, labels = spark.read.parquet(f"{big}/documents.parquet"), spark.read.parquet(f"{big}/labels.parquet")
    except Exception:  # noqa: BLE001  the larger table is not everywhere
        pytest.skip("no larger table")
    rows = t.score(docs, labels).where("held_out").join(labels, "doc_id").select("predicted", "toxic").collect()
    hit = sum(r.predicted and r.toxic for r in rows)
    assert hit / sum(r.predicted for r in rows) > 0.95 and hit / sum(r.toxic for r in rows) > 0.8


def test_edges(spark, edges, edge_rows, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (4, 0), (8, 0), (None, 1), (6, None)], "doc_id long, toxic int")
    for table in (labels, labels.where("doc_id < 0")):
        got = t.score(edges, table).collect()
        assert len(got) == len(edge_rows)
        by = {r.doc_id: r for r in got}
        assert by[3].score == by[4].score and not by[None].held_out
    assert t.score(no_docs, labels).count() == 0


def test_an_insult_scores_without_labels(spark):
    docs = spark.createDataFrame([(1, "you stupid idiot, you moron"), (2, "a fine day")], "doc_id long, text string")
    got = {r.doc_id: r.predicted for r in t.score(docs, spark.createDataFrame([], "doc_id long, toxic int")).collect()}
    assert got == {1: 1, 2: 0}
