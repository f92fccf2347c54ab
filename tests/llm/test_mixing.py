import pytest
from oracle import duck, duck_rows, spark_rows

from sigloom.llm import mixing as m


def level(sizes, weights):
    """Targets by raising the level until all is shared."""
    total, capped = sum(sizes), set()
    while True:
        left = total - sum(3 * sizes[k] for k in capped)
        w = sum(x for k, x in enumerate(weights) if k not in capped)
        t = [3 * s if k in capped else left * weights[k] / w for k, s in enumerate(sizes)]
        over = {k for k, s in enumerate(sizes) if t[k] > 3 * s} - capped
        if not over:
            return t
        capped |= over


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1, 500, 500], [1, 1, 1000, 2, 3, 5, 8], [7], [0, 5, 5], [100, 1, 1, 1]])
def test_targets_equal_water_filling(spark, sizes):
    rows = [(f"s{k}", s) for k, s in enumerate(sizes)]
    got = {r.source: r.target for r in m.targets(spark.createDataFrame(rows, "source string, source_size long")).collect()}
    want = level(sizes, [(5, 2, 1)[k % 3] for k in range(len(sizes))])
    assert [got[f"s{k}"] for k in range(len(sizes))] == pytest.approx(want)


def test_whole_table_equals_sql(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    assert spark_rows(m.plan(docs)) == duck_rows(duck(data), m.ORACLE)


def test_sources_come_near_their_targets_and_runs_agree(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = m.plan(docs).join(docs.select("doc_id", "source"), "doc_id").collect()
    again = {r.doc_id: r.taken for r in m.plan(docs.repartition(7)).collect()}
    assert {r.doc_id: r.taken for r in rows} == again
    by = {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        by.setdefault(r.source, [r.target, 0])[1] += r.taken
    assert all(abs(a - b) <= 0.5 for a, b in by.values())


def test_positions_follow_the_schedule(spark):
    one = spark.createDataFrame([(c, 1000, 0.5) for c in range(0, 1000, 100)], "c long, target long, slope double")
    at = [r.p for r in one.select(m.position(one.c.cast("double")).alias("p")).collect()]
    assert at == sorted(at)
    for c, p in zip(range(0, 1000, 100), at, strict=True):
        assert 1000 * (p + 0.5 * (p * p - p)) == pytest.approx(c, abs=1e-6)


def test_the_mix_holds_the_words_of_the_plan(spark, data, edges, edge_rows):
    for docs in (spark.read.parquet(f"{data}/documents.parquet"), edges):
        mixed, plan = m.mix(docs), m.plan(docs)
        assert mixed.columns == docs.columns
        assert mixed.select(m.words_in(mixed.text).alias("w")).agg({"w": "sum"}).first()[0] == plan.agg({"taken": "sum"}).first()[0]


def test_edges(edges, edge_rows, no_docs):
    got = m.plan(edges).collect()
    assert len(got) == len(edge_rows)
    assert {r.size for r in got if r.doc_id in (3, 4, 5)} == {0}
    assert m.plan(no_docs).count() == 0 and m.mix(no_docs).count() == 0


def test_more_buckets_give_the_same_plan(spark, data, monkeypatch):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    want = sorted(m.plan(docs).collect())
    for rows in (3, 0.05):
        monkeypatch.setattr(m, "BUCKET_ROWS", rows)
        assert m._digits(docs.count()) > 1 and sorted(m.plan(docs).collect()) == want


def test_rows_without_ids_are_spread_and_ties_have_an_order(spark):
    rows = [(None, f"w{k} x y", None, k) for k in range(300)] + [(7, f"one two {k} four five", "s", k) for k in range(40)] + [(8, "same text here", "s", k) for k in range(40)]
    schema = "doc_id long, text string, source string, extra long"
    one = m.mix(spark.createDataFrame(rows, schema)).collect()
    other = m.mix(spark.createDataFrame(rows[::-1], schema).repartition(5)).collect()
    assert one == other
    marks = m._ordered(spark.createDataFrame(rows[:300], schema)).select("mark").distinct().count()
    assert marks == 300
