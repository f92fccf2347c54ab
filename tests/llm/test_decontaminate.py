import collections
import re

from samples import prose

from sigloom.llm import decontaminate as d

QUESTION = "A train travels 120 km in 3 hours from Springfield to Shelbyville at constant speed. What is the average speed of the Springfield train?"


def found(docs, items):
    return {(r.doc_id, r.item_id) for r in d.contaminated(docs, items).collect()}


def table(spark, rows, name="doc_id"):
    return spark.createDataFrame(rows, f"{name} long, text string")


def test_whole_table_equals_brute_force(spark, data):
    docs, items = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/benchmark.parquet")
    plain = lambda t: re.sub(r"[^\w\s]|_", "", t).lower().split()
    at, size = collections.defaultdict(set), {}
    for r in items.collect():
        w = plain(r.text)
        size[r.item_id] = len(w) - 7
        for k in range(len(w) - 7):
            at[tuple(w[k : k + 8])].add(r.item_id)
    want = set()
    for r in docs.collect():
        w, met = plain(r.text), collections.defaultdict(set)
        for k in range(len(w) - 7):
            for i in at.get(tuple(w[k : k + 8]), ()):
                met[i].add(tuple(w[k : k + 8]))
        want |= {(r.doc_id, i) for i, v in met.items() if len(v) >= min(6, -(-size[i] // 2))}
    assert want and found(docs, items) == want


def words_and_template(text):
    """Words as they stand and their templates, by the rules alone: one name, number or unit a slot."""
    text = text or ""
    split = lambda t: [w for w in re.split(r"[^0-9A-Za-z\x00]+", re.sub(r"(?<=\d)[.,](?=\d)", "\x00", t)) if w]
    words, out = split(text), []
    named = split(re.sub(r"(?<=[a-z0-9,;:] )[A-Z][a-z]+(?![A-Za-z])", "\x00name\x00", text).lower())
    number = lambda w: w[0].isdigit() or w in d.NUMERALS.split()
    for k, w in enumerate(named):
        unit = w in d.UNITS.split() and k and number(named[k - 1])
        out.append("NAME" if w == "\x00name\x00" else "NUMBER" if number(w) else "UNIT" if unit else w)
    return [w.lower() for w in words], out


def slow(docs, items):
    """Pairs by all alignments of all documents with all items."""
    held = set()
    for i, doc in docs:
        for j, item in items:
            (dw, dt), (iw, it) = words_and_template(doc), words_and_template(item)
            size = min(8, len(iw))
            starts = range(len(iw) - size + 1) if iw else ()
            plain = [k for k in starts if len(iw) >= 5 and 2 * sum(x not in ("NAME", "NUMBER", "UNIT") for x in it[k : k + size]) >= size]
            for shift in range(-len(iw), len(dw) + 1):
                inside = [k for k in starts if 0 <= k + shift <= len(dw) - size]
                tmpl = [k for k in plain if k in inside and it[k : k + size] == dt[k + shift : k + shift + size]]
                same = [k for k in inside if iw[k : k + size] == dw[k + shift : k + shift + size]]
                enough = lambda got, of: bool(of) and len(got) >= min(-(-len(of) // 2), 6)
                met = enough(tmpl, plain) or (bool(same) and enough({*tmpl, *same}, [*starts]))
                pairs = {(it[k + x], iw[k + x], dw[k + x + shift]) for k in tmpl for x in range(size) if it[k + x] in ("NAME", "NUMBER", "UNIT")}
                one = len({p[:2] for p in pairs}) == len(pairs) == len({p[::2] for p in pairs})
                if met and one:
                    held.add((i, j))
    return held


def test_templates_and_slots_equal_brute_force(spark):
    import random

    r, people = random.Random(8), "Alice Bruno Clara Dmitri Elena Farid".split()
    shapes = [
        "a farmer called {a} sells {n} kg of apples and {m} kg of pears to {b} who pays {n} dollars for them all",
        "how many days does {a} need for {n} pages if the friend of {b} reads {m} pages in {n} hours without rest",
        "the pump of {b} fills {n} l in {m} minutes and then {a} opens the second valve for {n} minutes more",
        "add {n} to {m}",
    ]
    fill = lambda s: s.format(a=(x := r.sample(people, 2))[0], b=x[1], n=r.randint(2, 9), m=r.randint(10, 99))
    items = [(k, fill(shapes[k])) for k in range(4)]
    docs = []
    for k in range(120):
        text = fill(r.choice(shapes)) if r.random() < 0.7 else r.choice(items)[1]
        words = text.split()
        if r.random() < 0.4:  # one value differs from what it was elsewhere
            at = r.choice([i for i, w in enumerate(words) if w[0].isdigit() or w in people])
            words[at] = str(r.randint(100, 999)) if words[at][0].isdigit() else r.choice(people)
        cut = words[: r.randint(8, len(words))] if r.random() < 0.3 and len(words) > 8 else words
        text = " ".join(cut)
        docs.append((k, f"so {text.lower() if r.random() < 0.2 else text} and {prose(k, 5)}"))
    want = slow(docs, items)
    assert 20 < len(want) < 120 and found(table(spark, docs), table(spark, items, "item_id")) == want


def test_changed_parameters_are_caught_and_inconsistent_ones_are_not(spark):
    items = table(spark, [(1, QUESTION)], "item_id")
    docs = table(spark, [
        (1, "Intro here. " + QUESTION.replace("120", "2.5").replace("km", "miles").replace("Springfield", "Gotham").replace("Shelbyville", "Metropolis") + " End."),
        (2, QUESTION.upper()),
        (3, QUESTION.replace("the Springfield", "the Metropolis").replace("from Springfield", "from Gotham")),
        (4, prose(9)),
        (5, "It travels 1 km in 2 hours from Here to There."),
    ])
    got = {r.doc_id: r for r in d.contaminated(docs, items).collect()}
    assert set(got) == {1, 2} and got[1].n_changed >= 4 and got[2].n_changed == 0


def test_items_that_differ_in_values_alone_are_met_once(spark):
    same = "what is {} plus {} if we count all of the small green apples"
    items = table(spark, [(k, same.format(k + 2, k + 40)) for k in range(30)] + [(99, same.format(5, 5))], "item_id")
    docs = table(spark, [(1, "so " + same.format(700, 800)), (2, "so " + same.format(7, 7)), (3, "so " + same.format(12, 50))])
    assert found(docs, items) == {(1, 0), (2, 99), (3, 0), (3, 10)}


def test_small_letters_and_capitals_of_a_plain_item(spark):
    text = prose(11, 30)
    docs = table(spark, [(1, text.upper()), (2, f"so it goes {text} and on"), (3, " ".join(w + "%%%" for w in text.split())), (4, text[: len(text) // 4])])
    assert found(docs, table(spark, [(7, text)], "item_id")) == {(1, 7), (2, 7), (3, 7)}


def test_a_benchmark_beyond_the_broadcast_bound(spark, monkeypatch):
    items = table(spark, [(k, prose(k, 30)) for k in range(20)], "item_id")
    docs = table(spark, [(k, f"x {prose(k, 30)} y") for k in range(5)] + [(99, prose(99))])
    want = found(docs, items)
    monkeypatch.setattr(d, "MOST_BROADCAST", 0)
    assert found(docs, items) == want == {(k, k) for k in range(5)}
    assert sorted(r.doc_id for r in d.decontaminate(docs, items).collect()) == [99]


def test_edges(spark, edges, edge_rows, no_docs):
    items = table(spark, [(1, edge_rows[0][1]), (2, None), (3, ""), (4, "one two")], "item_id")
    assert {r.doc_id for r in d.contaminated(edges, items).collect()} == {1, 2}
    clean = d.decontaminate(edges, items)
    assert clean.columns == edges.columns and clean.count() == len(edge_rows) - 3
    none = items.where("item_id < 0")
    assert d.contaminated(edges, none).count() == 0 and d.decontaminate(edges, none).count() == len(edge_rows)
    assert d.contaminated(no_docs, items).count() == 0 and d.decontaminate(no_docs, items).count() == 0


def test_only_dataframe_operations(spark, data):
    docs, items = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/benchmark.parquet")
    plan = d.contaminated(docs, items)._jdf.queryExecution().toString() + d.matches(docs, items)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


def test_verbatim_copies_of_what_templates_leave_out(spark):
    numbers = "12 plus 7 minus 3 times 40 kg and 5 cm or 9 miles over 2 hours"
    named = "Ask Alice Brown and Bob Green or Carol White if Dave Black met Erin Gray and Frank Hill"
    items = table(spark, [(1, numbers), (2, "who wrote hamlet"), (3, named), (4, "is it 7 or 8"), (5, "")], "item_id")
    docs = table(spark, [(1, f"so {numbers} end"), (2, f"Say: Who wrote HAMLET? {prose(3)}"), (3, f"so {named.lower()} it goes"), (4, "Now is it 7 or 8 then"), (5, prose(5)), (6, "12 plus 7 minus 3"), (7, "who wrote it")])
    assert found(docs, items) == {(k, k) for k in range(1, 5)}


def test_half_of_the_windows_that_count_are_enough(spark):
    item = "2 kg 3 kg 4 kg 5 kg 6 kg 7 kg we weigh all of these heavy boxes"
    changed = "11 kg 12 kg 13 kg 14 kg 15 kg 16 kg we weigh all of these heavy boxes"
    assert found(table(spark, [(1, changed), (2, prose(2))]), table(spark, [(1, item)], "item_id")) == {(1, 1)}


def test_windows_are_hashed_whole_only_where_some_of_their_words_are_met(spark):
    """Four words are looked up before all of a window are hashed; windows that share just those are not met."""
    item = "a b c d e f g h".split()
    at = {k for k in range(8) if k in (0, 8 // 3, 16 // 3, 7)}
    other = " ".join(w if k in at else f"x{w}" for k, w in enumerate(item))
    items = table(spark, [(1, " ".join(item))], "item_id")
    docs = table(spark, [(1, f"so {' '.join(item)} it"), (2, f"so {other} it"), (3, f"{other} {' '.join(item)}")])
    for exact in (False, True):
        m = d.matches(docs, items, exact=exact)
        assert {(r.doc_id, r.pos) for r in m.collect()} == {(1, 2), (3, 9)}
        assert re.search(r"BroadcastHashJoin \[_k#\d+L\], \[_k#\d+L\], LeftSemi", m._jdf.queryExecution().executedPlan().toString())
