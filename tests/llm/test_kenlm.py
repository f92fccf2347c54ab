import collections
import math

import numpy as np
from samples import prose

from sigloom.llm import kenlm as k


def slow(texts):
    tabs = {4: collections.Counter()}
    for t in texts:
        x = [0] * 3 + [int(v) for v in k.symbols(t)] + [0]
        for i in range(3, len(x)):
            tabs[4][tuple(x[i - 3 : i + 1])] += 1
    for n in (3, 2, 1):
        tabs[n] = collections.Counter(g[1:] for g in tabs[n + 1])
    cut = {n: k.discounts([sum(v == j for v in tabs[n].values()) for j in (1, 2, 3, 4)]) for n in tabs}

    def p(g):
        n = len(g)
        low = p(g[1:]) if n > 1 else 1 / 64
        same = {x: v for x, v in tabs[n].items() if x[:-1] == g[:-1]}
        if not same:
            return low
        total, c = sum(same.values()), same.get(g, 0)
        left = sum(cut[n][min(v, 3) - 1] for v in same.values()) / total
        return max(c - (cut[n][min(c, 3) - 1] if c else 0), 0) / total + left * low

    return p


def parts(spark, texts):
    out = []
    for g, h in k.model(k.counts(spark.createDataFrame([(t,) for t in texts], "text string"))):
        x, y = g.toPandas(), h.toPandas()
        out.append((x.g.to_numpy(), x.p.to_numpy(), y.h.to_numpy(), y.back.to_numpy()))
    return out


def test_probabilities_equal_the_recursion_and_sum_to_one(spark):
    texts = ["the cat sat on the mat.", "The dog, the CAT ran 12", "über die brücke gehen", ""]
    p, table = slow(texts[:3]), k.dense(parts(spark, texts))
    for t in [*texts, "a zebra %"]:
        for c in k.codes([t])[0].tolist():
            assert math.isclose(math.exp(table[c]), p(tuple(c >> 6 * j & 63 for j in (3, 2, 1, 0))), rel_tol=1e-4)
    assert np.allclose(np.exp(table.astype(float)).reshape(-1, 64).sum(1)[::997], 1, atol=1e-4)


def test_junk_has_a_high_perplexity(spark):
    docs = [(i, prose(i), "en") for i in range(200)] + [(900, "%%# zq ||| xx## $$$ qqq kz &&& " * 5, "en"), (901, "ALPHA BRAVO CHARLIE DELTA " * 5, "xx")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(150)] + [(0, 1), (900, 0)], "doc_id long, quality int")
    got = {r.doc_id: r for r in k.classify(df, labels).collect()}
    assert len(got) == 202 and not got[900].kept and not got[901].kept
    assert sum(got[i].kept for i in range(200)) >= 195


def test_quantiles_are_exact_on_the_grid(spark):
    df = spark.createDataFrame([("a", x / 1000) for x in range(1000)] + [("b", 5.0)], "lang string, nats double")
    got = {(r.is_all, r.lang): r.limit for r in k.quantiles(df, 0.5, 0.0, 50).collect()}
    assert got == {(0, "a"): 0.499, (1, None): 0.5}


def test_edges(spark, edges, edge_rows, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (8, 1), (None, 1), (4, None)], "doc_id long, quality int")
    got = k.classify(edges, labels).collect()
    assert len(got) == len(edge_rows) and all(r.perplexity > 0 for r in got)
    assert all(r.kept for r in k.classify(edges, labels.where("quality = 0")).collect())
    assert k.classify(no_docs, labels).count() == 0


def in_order(seed, n=60):
    """Words that look alike at both ends, each followed by the next one of a fixed round."""
    words = [f"anda{a}{b}anda" for a in "bcdfg" for b in "klmnpr"]
    return [words[(7 * seed + j) % 30] for j in range(n)]


def test_shuffled_words_are_rejected(spark):
    import random

    docs = [(i, " ".join(in_order(i)), "en") for i in range(120)]
    mixed = [(1000 + i, " ".join(random.Random(i).sample(in_order(i), 60)), "en") for i in range(20)]
    df = spark.createDataFrame(docs + mixed, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(100)], "doc_id long, quality int")
    got = {r.doc_id: r.kept for r in k.classify(df, labels).collect()}
    assert all(got[i] for i in range(120)) and not any(got[1000 + i] for i in range(20))


def test_word_weights_equal_the_recursion(spark):
    """The sums of weights against modified Kneser-Ney worked out word by word."""
    texts = ["a b c a b d", "a b c", "b c a e", "a b d d"]
    spell = np.full(64**4, math.log(0.05), np.float32)
    shared = spark.sparkContext.broadcast(None)
    k._DENSE["test"] = spell
    tabs = {3: collections.Counter()}
    for t in texts:
        w = ["<", "<", *t.split(), ">"]
        tabs[3].update(zip(w, w[1:], w[2:]))
    for n in (2, 1):
        tabs[n] = collections.Counter(g[1:] for g in tabs[n + 1])
    cut = {n: k.discounts([sum(v == j for v in tabs[n].values()) for j in (1, 2, 3, 4)]) for n in tabs}

    def p(g):
        low = p(g[1:]) if len(g) > 1 else (k.END if g[0] == ">" else (1 - k.END) * 0.05 ** (len(g[0]) + 1))
        same = {x: v for x, v in tabs[len(g)].items() if x[:-1] == g[:-1]}
        if not same:
            return low
        total, c = sum(same.values()), same.get(g, 0)
        left = sum(cut[len(g)][min(v, 3) - 1] for v in same.values()) / total
        return max(c - (cut[len(g)][min(c, 3) - 1] if c else 0), 0) / total + left * low

    k_tally, k._tally = k._tally, lambda model, name: _tally_with(k_tally, spell)
    try:
        table, left = k.weights(spark.createDataFrame([(t,) for t in texts], "text string"), shared, "test")
        got = {r.g: r.w for r in table.collect()}
    finally:
        k._tally = k_tally
    for t in [*texts, "a b a", "zz a b c", ""]:
        x, base, _ = k.grams([t], spell)
        mine = base[0] + len(t.split() + [">"]) * left + sum(got.get(g, 0) for g in x["g"].tolist()) / k.STEPS
        w = ["<", "<", *t.split(), ">"]
        assert math.isclose(mine, sum(math.log(p(g)) for g in zip(w, w[1:], w[2:])), abs_tol=1e-3)


def _tally_with(tally, spell):
    def run(batches):
        from sigloom.llm import kenlm

        kenlm._DENSE["test"] = spell
        return tally(None, "test")(batches)

    return run


def test_rounds_change_nothing_and_leave_nothing(spark, monkeypatch):
    """Word n-grams in three rounds, also with texts packed one by one, give what one round gives; no
    round's n-grams are left in the shared folder."""
    rows = [(i, prose(i, 30), "en") for i in range(60)] + [(60, prose(3, 30), "en"), (61, "", "en"), (62, None, None), (63, "zz top " * 9, "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(55)], "doc_id long, quality int")
    want = sorted(k.classify(df, labels).collect())
    tables, stored = [], k.stored
    monkeypatch.setattr(k, "stored", lambda x: tables.append(stored(x)) or tables[-1])
    monkeypatch.setattr(k, "ROUND", 5_000)
    monkeypatch.setattr(k, "PACK", 1)
    monkeypatch.setattr(k, "CHUNK", 1)
    assert sorted(k.classify(df, labels).collect()) == want

    def there(x):
        path = spark._jvm.org.apache.hadoop.fs.Path(next(iter(x._jdf.inputFiles()), "file:///none").rsplit("/", 1)[0])
        return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)

    assert tables and not any(there(x) for x in tables if {"g", "w"} <= set(x.columns) or "h" in x.columns and "s" in x.columns)


def test_trigrams_travel_in_blocks_and_those_of_a_frequent_word_in_many_shards(spark, monkeypatch):
    """A block holds many trigrams, a word in the middle of half of them is in many shards, and weights do not depend
    on which words count as frequent."""
    texts = spark.createDataFrame([(" ".join(f"w{i * 7 % 90} the w{(i * j) % 80}" for j in range(30)),) for i in range(60)], "text string").coalesce(1)
    k._DENSE["test"] = np.full(64**4, math.log(0.05), np.float32)
    tally = k._tally
    monkeypatch.setattr(k, "_tally", lambda model, name: _tally_with(tally, k._DENSE["test"]))
    got = {}
    for often in (1, 10, 10_000):
        monkeypatch.setattr(k, "HOT_KEYS", often)
        got[often] = sorted(k.weights(texts, None, "test")[0].collect())
    assert got[1] == got[10] == got[10_000] and len(got[1]) > 2000
    words, d, _, hot = k.singles(texts, None, "test")
    blocks = k.round_weights(texts, words, d, hot).where("kind = 1").collect()
    assert sum(r.n for r in blocks) > 5 * len(blocks)
    the = k._pair(k.hashed(["the"])[1], k.hashed(["the"])[1], 1)
    middle = lambda r: k._pair(*[k._unblock(r.body, r.n, k._UUUIID)[0]] * 2, 1)
    assert len({r.shard for r in blocks if the[0] in middle(r)}) > 8
