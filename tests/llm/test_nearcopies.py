import random

import numpy as np
from samples import prose

from sigloom.llm import nearcopies as n


def shingles(text):
    w = (text or "").encode().lower().split()
    k = min(5, len(w))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()


def slow_groups(texts):
    """Smallest key of each text's group, by all pairs."""
    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in texts:
        for b in texts:
            both = len(sets[a] & sets[b])
            if a < b and (sets[a] == sets[b] or both >= 0.8 * len(sets[a] | sets[b]) > 0):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in texts}


def edited(text, seed, share):
    r, words = random.Random(seed), text.split()
    for k in r.sample(range(len(words)), max(1, int(len(words) * share))):
        words[k] = f"edit{r.randrange(10**6)}"
    return " ".join(words)


def planted():
    """Groups of texts with edits, from one word in 300 to one in 30."""
    rows = []
    for k in range(30):
        base = prose(1000 + k, 120 + 9 * k)
        rows += [(10 * k, base), (10 * k + 1, edited(base, k, 0.003)), (10 * k + 2, edited(base, k + 100, 0.01)), (10 * k + 3, edited(base, k + 200, 0.02)), (10 * k + 4, edited(base, k + 300, 0.2))]
    return rows


def stays(spark, rows, **more):
    return sorted((r.doc_id, r.text) for r in n.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), **more).collect())


def test_planted_near_copies_equal_brute_force(spark):
    rows = planted()
    root = slow_groups(dict(rows))
    assert 30 < len(set(root.values())) < 120
    assert stays(spark, rows) == [(i, t) for i, t in rows if root[i] == i]


def test_whole_table_equals_brute_force(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    root = slow_groups({r.doc_id: r.text for r in docs.collect()})
    kept = n.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(root.values()))


def test_groups_dealt_out_as_tiles_give_the_same(spark, monkeypatch):
    rows = planted()
    want = stays(spark, rows)
    monkeypatch.setattr(n, "TILE_SHINGLES", 300)
    assert stays(spark, rows) == want


def test_sets_of_two_sides():
    a, b, c = (np.arange(k, k + 100, dtype=np.uint64) for k in (0, 3, 200))
    assert n.similar([a, b, c], np.zeros(3, int), 0.8).tolist() == [0, 0, 2]
    assert n.similar([a, b, c], np.array([1, 1, 2]), 0.8).tolist() == [0, 1, 2]
    assert n.similar([a, b, c], np.array([1, 2, 2]), 0.8).tolist() == [0, 0, 2]
    none = np.zeros(0, np.uint64)
    assert n.similar([none, none], np.zeros(2, int), 0.8).tolist() in ([0, 0], [0, 1])


def test_texts_under_one_id_are_judged_for_themselves(spark):
    a, b, c, d = (prose(k) for k in range(4))
    rows = [(3, a), (5, b), (5, a), (7, c), (7, d)]
    assert stays(spark, rows) == stays(spark, rows[::-1]) == sorted([(3, a), (5, b), (7, c), (7, d)])


def test_edges(spark, edges, no_docs):
    kept = n.drop_near_duplicates(edges)
    assert kept.columns == edges.columns and kept.dtypes == edges.dtypes
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 3, 6, 7, 8, 9] and ids.count(None) == 1
    assert n.drop_near_duplicates(edges.where("doc_id = 2")).count() == 1
    nameless = edges.where("doc_id = 1").withColumn("doc_id", edges.doc_id * None)
    assert n.drop_near_duplicates(nameless.union(nameless)).count() == 1
    assert n.drop_near_duplicates(nameless.union(edges)).where("doc_id is null").count() == 1
    assert n.drop_near_duplicates(no_docs).count() == 0
