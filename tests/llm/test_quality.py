import collections
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sigloom.llm import quality


def slow(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for x in lines:
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in seen
            seen.add(x)
    at = collections.defaultdict(list)
    for i in range(len(words) - 2):
        at[tuple(words[i : i + 3])].append(i)
    rep = len({i + k for v in at.values() if len(v) > 1 for i in v for k in range(3)})
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, rep


def slow_repeats(text, least):
    """Number of maximal repeats, covered code points of words, and the longest, by all pairs of places."""
    n, best, at = len(text), [0] * len(text), collections.defaultdict(set)
    for i in range(n):
        for j in range(i + 1, n):
            k = 0
            while j + k < n and text[i + k] == text[j + k]:
                k += 1
            best[i], best[j] = max(best[i], k), max(best[j], k)
            if k >= least and (i == 0 or text[i - 1] != text[j - 1]):
                at[text[i : i + k]] |= {i, j}
    best = [b if b >= least else 0 for b in best]
    covered = {i + k for i in range(n) for k in range(best[i])}
    return len(at), sum(text[i] not in " \t\n\v\f\r" for i in covered), max(best, default=0)


texts = st.lists(st.lists(st.sampled_from("a b cc ddd e# \n".split(" ")), max_size=40).map(" ".join), min_size=1, max_size=5)
scripts = st.lists(st.text(st.sampled_from("ab я漢字👧\n "), max_size=60), min_size=1, max_size=5)


@settings(max_examples=150, deadline=None)
@given(texts)
def test_a_batch_equals_brute_force(batch):
    got = list(zip(*quality.measure([t.encode() for t in batch]), strict=True))
    for t, g in zip(batch, got, strict=True):
        assert g[:5] == slow(t)


@settings(max_examples=200, deadline=None)
@given(st.one_of(texts, scripts), st.sampled_from([1, 2, 3, 5, 8]))
def test_repeats_in_any_script_equal_brute_force(batch, least):
    got = list(zip(*quality.repeats(batch, least), strict=True))
    assert got == [slow_repeats(t, least) for t in batch]


@settings(max_examples=100, deadline=None)
@given(scripts, st.sampled_from([1, 3, 7]))
def test_the_suffix_array_is_in_order(batch, least):
    p = quality.Places(batch)
    suffix, lcp = quality.suffix_array(p, least)
    tail = [(int(p.owner[i]), p.code[i : p.end[p.owner[i]] + 1].tolist()) for i in suffix]
    assert tail == sorted(tail)
    common = [0] + [next(k for k, (x, y) in enumerate(zip([*a[1], -1], [*b[1], -2], strict=False)) if x != y or a[0] != b[0]) for a, b in zip(tail, tail[1:], strict=False)]
    assert lcp.tolist() == [k if k >= least else 0 for k in common[: len(suffix)]]


def test_the_alphabet_does_not_matter(spark):
    import random

    r, to = random.Random(3), str.maketrans("abcdefghijklmnop", "абвгдежзийклмноп")
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 9)))
    rows = []
    for k in range(12):
        passage = " ".join(word() for _ in range(5 * k))
        rows.append((k, f"{passage} {' '.join(word() for _ in range(100))} {passage}"))
    both = rows + [(100 + k, t.translate(to)) for k, t in rows] + [(200 + k, t.translate(str.maketrans("abcdefghijklmnop", "一二三四五六七八九十百千万上下中"))) for k, t in rows]
    got = {r.doc_id: r for r in quality.verdicts(spark.createDataFrame(both, "doc_id long, text string")).collect()}
    assert {got[k].kept for k, _ in rows} == {True, False}
    for k, _ in rows:
        for j in (100, 200):
            assert (got[k].kept, got[k].covered_share, got[k].longest_repeat_chars, got[k].n_maximal_repeats) == (got[k + j].kept, got[k + j].covered_share, got[k + j].longest_repeat_chars, got[k + j].n_maximal_repeats)


def test_repetition_without_spaces_is_seen(spark):
    import random

    r = random.Random(1)
    phrase = "".join(r.choice("abcdefghij") for _ in range(211))
    rows = [(1, phrase * 40), (2, "".join(r.choice("漢字仮名交文章") for _ in range(97)) * 30), (3, "x" * 200_000)]
    got = {x.doc_id: x for x in quality.verdicts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(x.covered_share > 0.9 for x in got.values())
    assert got[1].longest_repeat_chars == 211 * 39 and got[3].longest_repeat_chars == 199_999


def test_whole_table(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in quality.verdicts(docs).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == slow(text[r.doc_id])
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)


def test_edges(edges, edge_rows, no_docs):
    got = quality.verdicts(edges).collect()
    assert len(got) == len(edge_rows)
    text = {r[0]: r[1] for r in edge_rows}
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == slow(text[r.doc_id])
    by = {r.doc_id: r for r in got}
    assert not by[3].kept and not by[4].kept and by[1].kept and by[None].kept
    kept = quality.keep(edges)
    assert kept.columns == edges.columns and kept.dtypes == edges.dtypes
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in got if r.kept)
    assert quality.verdicts(no_docs).count() == 0 and quality.keep(no_docs).count() == 0


@pytest.mark.parametrize("words,kept", [(60, True), (49, False)])
def test_short_texts_fail(spark, words, kept):
    df = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(words)))], "doc_id long, text string")
    assert quality.verdicts(df).first().kept is kept


def test_a_text_that_repeats_one_long_passage_is_rejected_by_the_suffix_array(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    text = passage + " " + " ".join(f"w{i}" for i in range(100)) + " " + passage
    r = quality.verdicts(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert not r.base_failed and r.longest_repeat_chars >= len(passage) and r.covered_share > 0.35 and not r.kept
