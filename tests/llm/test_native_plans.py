import re

import pytest

from sigloom.llm import decontaminate, queries


def test_every_operator_is_registered():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{k}" for k in range(1, 11)]


@pytest.mark.parametrize("bound", [500_000, 0])
def test_the_native_operator_has_no_python_worker_in_any_plan(spark, data, monkeypatch, bound):
    """Plans of the result, of both window joins and of the filtering stage, on either side of the bound."""
    monkeypatch.setattr(decontaminate, "MOST_BROADCAST", bound)
    docs, items = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/benchmark.parquet")
    frames = [queries.op2_decontamination(spark, data), decontaminate.matches(docs, items), decontaminate.matches(docs, items, exact=True), decontaminate.decontaminate(docs, items)]
    plans = [f._jdf.queryExecution().toString() for f in frames]
    assert not any(re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", p) for p in plans)
    if not bound:  # the join of windows deals out ids, places and hashes, no text
        sent = [x for p in plans[1:3] for x in re.findall(r"Exchange hashpartitioning\(h#\d+L[^\n]*\n[^\n]*", p)]
        assert sent and not any("text#" in x for x in sent)
