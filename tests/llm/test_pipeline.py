import zlib

import numpy as np
import pytest
from test_decontaminate import found
from test_mixing import level
from test_nearcopies import slow_groups

pipeline = pytest.importorskip("corpus_pipeline")

from sigloom.llm import mixing, quality, tokens  # noqa: E402


def test_stages_equal_brute_force(spark, data):
    """Each stage against what its contract says of its own input; the last against the library."""
    import hashlib

    from sigloom.llm.common import stored

    docs = spark.read.parquet(f"{data}/documents.parquet")
    assert [n for n, _ in pipeline.STAGES] == ["quality rules", "SimHash near-dedup", "benchmark decontamination", "mixing sources", "token output"]
    now, names = docs, docs.columns
    seen = [now.collect()]
    for k, (_, stage) in enumerate(pipeline.STAGES):
        now = stored(stage(spark, now, data))
        assert k == 4 or now.columns == names
        seen.append(now.collect())
    ids = [sorted(r.doc_id for r in rows) for rows in seen]
    kept = {r.doc_id for r in quality.verdicts(docs).collect() if r.kept}
    assert ids[1] == sorted(kept)
    roots = slow_groups({r.doc_id: r.text for r in seen[1]})
    assert ids[2] == sorted(set(roots.values()))
    leaks = {i for i, _ in found(spark.createDataFrame(seen[2], docs.schema), spark.read.parquet(f"{data}/benchmark.parquet"))}
    assert leaks and ids[3] == sorted(set(ids[2]) - leaks)

    words = {r.doc_id: len(r.text.encode().split()) for r in seen[3]}
    sources = sorted({r.source for r in seen[3]})
    size = [sum(words[r.doc_id] for r in seen[3] if r.source == s) for s in sources]
    want = {}
    for k, (s, target) in enumerate(zip(sources, level(size, [(5, 2, 1)[k % 3] for k in range(len(sources))]), strict=True)):
        left = round(target)
        order = sorted((hashlib.md5(str(r.doc_id).encode()).hexdigest(), r.doc_id) for r in seen[3] if r.source == s)
        for _ in range(3):
            for _, i in order:
                take = min(words[i], max(left, 0))
                if take:
                    want.setdefault(i, []).append(take)
                left -= take
    got = {}
    for r in seen[4]:
        got.setdefault(r.doc_id, []).append(len(r.text.encode().split()))
    assert {i: sorted(v) for i, v in got.items()} == {i: sorted(v) for i, v in want.items()}

    tok = tokens.Encoder(tokens.default_vocabulary()[0]).tok
    crc = lambda x: zlib.crc32(np.array([*tok.encode(x, add_special_tokens=False).ids, 1], "<u4").tobytes())
    assert sorted((r.doc_id, r.ids_crc32) for r in seen[5]) == sorted((r.doc_id, crc(r.text)) for r in seen[4])
    at = sorted((r.start, r.n_tokens, r.doc_id) for r in seen[5])
    assert all(a[0] + a[1] == b[0] and a[2] <= b[2] for a, b in zip(at, at[1:], strict=False))


def test_run_equals_its_stages(spark, data):
    got = pipeline.run(spark, data)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and got.count() > 0


def test_edges(spark, edges, no_docs, data):
    for docs in (edges, no_docs):
        now = docs
        for _, stage in pipeline.STAGES:
            now = stage(spark, now, data)
        rows = now.collect()
        assert len(rows) == 0 if docs is no_docs else rows
    assert mixing.MAX_REPEATS == 3
