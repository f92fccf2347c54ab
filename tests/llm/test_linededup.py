from oracle import duck, duck_rows, spark_rows
from pyspark.sql import functions as F

from sigloom.llm import linededup as d
from sigloom.llm import queries


def page(k, *lines):
    return (k, f"https://WWW.a.example/p{k}", "<html><body>" + "".join(f"<p>{x}</p>" for x in lines) + "</body></html>")


def test_whole_table_equals_sql(spark, data):
    assert spark_rows(queries.op8_line_dedup(spark, data)) == duck_rows(duck(data), d.ORACLE)


def test_boilerplate_goes_where_it_is_boilerplate(spark, monkeypatch):
    rows = [page(k, "menu", f"own {k}", "menu") for k in range(10)] + [(99, "https://b.example/", "<p>menu</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for bound in (500_000, -1):
        monkeypatch.setattr(d, "MOST_BROADCAST", bound)
        got = {r.page_id: r for r in d.drop_boilerplate(df).collect()}
        assert all(got[k].kept_text == f"own {k}" and got[k].n_dropped == 2 for k in range(10))
        assert got[99].kept_text == "menu" and got[0].host == "www.a.example"


def test_a_line_at_the_ratio_stays(spark):
    rows = [page(k, "x" if k < 4 else "y", str(k)) for k in range(20)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert d.drop_boilerplate(df).where(F.col("n_dropped") > 0).count() == 16  # y is on 16 of 20, x on 4 of 20


def test_hidden_parts_are_no_lines(spark):
    html = "<script>var t='</p>';</script><!-- <p>no</p> --><STYLE>p{}</STYLE><p>a <b>b</b><br/>c</p>\n\n <pre>d</pre>"
    assert spark.createDataFrame([(html,)], "h string").select(d.lines_of(F.col("h")).alias("l")).first().l == ["a b", "c", "d"]


def test_edges(spark):
    rows = [(1, None, None), (None, "nonsense", ""), (2, "http://h/", "<p>" + "long " * 50_000 + "</p>"), (2, "http://h/", "x"), (2, "http://h/", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"host": F.lit("z"), "lines": F.lit(1), "kept": F.lit(2)})
    got = d.drop_boilerplate(df).collect()
    assert len(got) == 5 and {r.n_lines for r in got if r.page_id != 2} == {0}
    assert d.drop_boilerplate(df.where("page_id > 9")).count() == 0
