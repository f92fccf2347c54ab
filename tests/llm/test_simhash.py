import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sigloom.llm import simhash
from sigloom.llm.components import components


def slow_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    k = min(3, len(words))
    h = [xxhash.xxh64_intdigest(b" ".join(words[i : i + k]), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(prints):
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_prints_and_components_equal_brute_force(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    prints = {r.doc_id: slow_print(r.text) for r in docs.collect()}
    assert {i: int(r.fingerprint, 16) for i, r in got.items()} == prints
    assert {i: r.component_id for i, r in got.items()} == slow_components(prints)


@pytest.mark.parametrize("hot,tile", [(8192, 4096), (4, 3)])
def test_links_of_clustered_values_hot_buckets_included(spark, hot, tile):
    r = np.random.default_rng(5)
    centres = r.integers(0, 1 << 63, 6, dtype=np.int64)
    values = {int(c) for c in centres}
    for c in centres.tolist():
        for _ in range(60):
            x = c
            for b in r.integers(0, 63, r.integers(1, 7)):
                x ^= 1 << int(b)
            values.add(x)
    values = sorted(values)
    df = spark.createDataFrame([(v, k) for k, v in enumerate(values)], "fp long, rep long")
    got = {r.u: r.v for r in components(simhash.link(df, 3, hot, tile)).collect()}
    want = slow_components(dict(enumerate(values)))
    assert {k: got.get(k, k) for k in want} == want


def test_forest_of_a_chain():
    assert simhash.forest(6, np.array([4, 3, 2, 1]), np.array([5, 4, 3, 2])).tolist() == [0, 1, 1, 1, 1, 1]


def test_components_of_a_long_path_and_a_hub(spark):
    path = [(k, k + 1) for k in range(1, 60)]
    hub = [(1000, k) for k in range(100, 400)]
    df = spark.createDataFrame(path + hub + [(7, 7), (2, 1)], "u long, v long")
    got = {r.u: r.v for r in components(df).collect()}
    assert all(got[k] == 1 for k in range(2, 61)) and all(got[k] == 100 for k in [*range(101, 400), 1000])
    assert components(df.where("u < 0")).count() == 0


def test_edges(edges, edge_rows, no_docs):
    got = simhash.near_duplicates(edges).collect()
    assert len(got) == len(edge_rows)
    by = {r.doc_id: r for r in got}
    assert by[3].fingerprint == by[4].fingerprint == by[5].fingerprint == "0" * 16
    assert {by[i].component_id for i in (3, 4, 5)} == {3} and by[2].component_id == 1 and by[10].component_id == 8
    assert simhash.near_duplicates(no_docs).count() == 0


def test_case_and_space_do_not_matter(spark):
    df = spark.createDataFrame([(1, "One Two  three\tfour"), (2, "one two three four"), (3, "ÉCOLE one"), (4, "école one")], "doc_id long, text string")
    got = {r.doc_id: r.fingerprint for r in simhash.near_duplicates(df).select("doc_id", F.col("fingerprint")).collect()}
    assert got[1] == got[2] and got[3] != got[4]


def test_blocks_meet_whatever_three_bits_differ():
    masks = simhash.block_keys(3)
    assert len(masks) == 20 and all(29 <= m.bit_count() <= 33 for m in masks)
    r = np.random.default_rng(2)
    for _ in range(2000):
        x = sum(1 << int(b) for b in r.integers(0, 64, 3))
        assert any(x & m == 0 for m in masks)


def test_tiles_of_any_side_find_all_links(spark, data, monkeypatch):
    """One bucket of all values: its components are those of all pairs, whatever the tile's side."""
    prints = simhash.fingerprints(spark.read.parquet(f"{data}/documents.parquet")).toPandas()
    fp = np.unique(prints.fp.to_numpy())
    key, order = np.zeros(len(fp), np.int64), np.argsort(np.bitwise_count(fp.view(np.uint64)), kind="stable")
    bits = fp[order].view(np.uint64)
    want = slow_components(dict(enumerate(bits.tolist())))
    for tile in (1, 7, 256):
        monkeypatch.setattr(simhash, "TILE", tile)
        assert dict(enumerate(simhash.tile_links(key, key, bits, 3).tolist())) == want
