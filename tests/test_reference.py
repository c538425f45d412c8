"""Reference operators: literal cases, and SQL twins on the small tables."""

import duckdb
import pytest
from pyspark.sql import functions as F

from millrace.functions import normal, text
from millrace.operators import dates, evaluation
from millrace.plans import catalogue, relational
from millrace.sources.html import decode_html, line_rows, unwrap_json, visible_lines
from millrace.streaming import resume

SF = "/root/testdata/sf0.001"


def one(spark, expression, value):
    return spark.createDataFrame([(value,)], "x string").select(expression(F.col("x"))).first()[0]


@pytest.mark.parametrize(("raw", "want"), [("2,315,008", 2315008), ("7.041,25", 7041.25), (".75", 0.75), ("6,2", 6.2), ("-18", -18), ("none", None)])
def test_parse_number(spark, raw, want):
    assert one(spark, text.parse_number, raw) == want


def test_labels_and_tokens(spark):
    assert one(spark, text.normalize_label, "Maximum Height [cm]") == "max height"
    assert one(spark, text.tokens, "Der Krug fasst 2 Liter") == ["der", "krug", "fasst", "2", "liter"]
    assert one(spark, text.tokens, "東京都 a") == ["東京", "京都", "a"]
    assert one(spark, text.locale, "https://shop.example.com/fr/krug") == "fr"
    assert one(spark, text.host, "https://www.Example.com/fr/krug") == "example.com"


def test_visible_lines(spark):
    html = "<nav>Start</nav><p>A <b>blue</b> jug</p><table><tr><td>Volume</td><td>2 l</td></tr></table><script>var t='</p>'</script>"
    assert [r[0] for r in line_rows(html)] == ["Start", "A blue jug", "Volume | 2 l"]
    assert line_rows("<ul><li><a href=x>Go</a></ul>")[0][1] == 1.0
    assert line_rows(None) == []
    assert [r[0] for r in line_rows("<html><head><title>Jug</title><body><p>Shown")] == ["Shown"]
    assert [r[0] for r in line_rows("<head><title>Jug</title><p>Shown<p>Too")] == ["Shown", "Too"]
    pages = spark.createDataFrame([("a", "<p>x"), ("b", None)], "page_id string, html string")
    assert [tuple(r)[:3] for r in visible_lines(pages).collect()] == [("a", 1, "x")]


def test_stored_pages():
    for raw in ("é".encode(), b"\xef\xbb\xbf\xc3\xa9", "é".encode("utf-16"), b"\xe9", "<?xml version='1.0'?>é", '<meta charset="iso-8859-2">'.encode() + "é".encode("iso-8859-2")):
        assert decode_html(raw).endswith("é") and not decode_html(raw).startswith("<?xml")
    assert decode_html(None) == "" and decode_html(b'<meta charset="unheard-of">\xe9').endswith("é")
    saved = '[{"title": {"rendered": "Jug"}, "content": {"rendered": "<p>Blue &amp; round</p>"}}, {"name": "Lid", "slug": "l", "size": 4}]'
    want = ["Jug", "Blue & round", "Lid", "name", "Lid", "size", "4"]
    assert [r[0] for r in line_rows(saved)] == want
    assert [r[0] for r in line_rows(f"<html><body><pre>{saved.replace('&', '&amp;').replace('<', '&lt;')}</pre></body></html>")] == want
    assert unwrap_json("{not json") == "{not json" and unwrap_json("<pre>[1]</pre>") == "<pre>[1]</pre>"


def test_normal_forms():
    assert normal.text_form("  Kettle\u00a0No\u2011Drip – “Oak”\u00ad ") == 'kettle no-drip - "oak"'
    assert normal.name_form("(Brook® Kettle™)") == "brook kettle" and normal.answer_form("24 × 30 cm.") == "24 x 30 cm"
    assert normal.numbers("1,200 or 3,5 or 7,250.5") == [1200, 3.5, 7250.5] and normal.unit_words("24 cm x 3 kg") == {"cm", "kg"}
    assert normal.holds("about 24 cm", "24 cm") and not normal.holds("124 cm", "24 cm") and not normal.holds("0.24 cm", "24 cm") and not normal.holds("x", "")
    assert normal.text_form(None) == normal.name_form("") == ""


def test_value_and_product_match():
    match = lambda v, got, **more: evaluation.value_match({"v": v} | more, got)
    assert match("24 cm", "24 CM.") == "exact" and match("24 cm", "height 24 cm") == "contains" and match("oak", "Wood", any=["wood"]) == "alt"
    assert match("24 cm high", "24 cm hi") is None or match("24 cm high", "24 cm hi") == "numeric"
    assert match("40 km range", "40 km/h speed") is None and match("40 cm", "40 kg") is None and match("40 cm", None) is None
    assert match("2 to 3 l", "3 l and 2 l") == "numeric" and match("waxed blue oak", "oak waxed blue") == "fuzzy"
    assert evaluation.same_product("kettle 12", "kettle 12 oak") and not evaluation.same_product("kettle 12", "kettle 123") and not evaluation.same_product("", "x")
    assert evaluation.ancestors({"a": "b", "b": "c", "c": "a"}, "a") == {"b", "c", "a"}


def test_score_edges(spark):
    keys = spark.createDataFrame([("a", None, [("P", "Jug", None)], [("P", "2 l", None, None, None, None, None, None, None)], None), ("b", True, None, None, None), ("c", False, [], [], ["bad"])], evaluation.KEY)
    part = '{"products": [{"entity_id": "j", "name": "Jug"}, {"entity_id": "l", "name": "Lid", "parent_entity_id": "j", "specifications": [{"value_text": "2 l", "parameter": {"id": "v"}, "verification": "verified"}]}]}'
    results = spark.createDataFrame([("a", part), ("b", "broken"), ("z", None)], "doc_id string, result string")
    judged = evaluation.score_documents(keys, results)
    got = {r.doc_id: r for r in judged.collect()}
    assert [(x.outcome, x.match) for x in got["a"].rows] == [("matched", "via_subsystem")]
    assert got["b"].scored and not got["b"].rows and not got["c"].scored
    totals = evaluation.run_totals(judged).first()
    assert (totals.documents, totals.scored, totals.core_recall, totals.text_recall) == (3, 2, 1.0, None)
    assert evaluation.run_totals(judged.limit(0)).first().documents == 0


def test_dates(spark):
    rows = [
        ("https://x.org/2021/04/05/jug", None, None, None, None),
        ("https://x.org/20210405-jug", "<link rel=canonical href=2020-01-01><time datetime='2021-04-06'>", "Town, 6 April 2021", None, None),
        ("https://x.org/jug", None, "Body", "2021-04-05T10:00", "2021-04-05T11:00"),
        ("https://x.org/jug", None, "Body", "2021-04-05", "2021-05-01"),
        ("https://x.org/2021/13/45/jug", None, "On March 3, 2041 it ends", None, None),
        ("https://x.org/tag/jug", None, "5 May 2021", None, None),
        ("https://x.org/jug", None, "a... b... c... d... e...", None, None),
        (None, None, None, None, None),
    ]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "date int, url string, html string, text string, published_at string, fetched_at string")
    got = [(r.date, r.status) for r in dates.resolve(docs.orderBy("date"), F.to_date(F.lit("2030-01-01"))).collect()]
    want = [("2021-04-05", "proven"), ("2021-04-06", "proven"), (None, "undated"), ("2021-04-05", "single"), (None, "undated"), (None, "listing"), (None, "listing"), (None, "listing")]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_resume(spark):
    log = spark.createDataFrame([("a", 1, "m", None), ("b", 2, "m", None), ("b", 3, "m", "fetch:timeout"), ("c", 4, "old", None)], "document_id string, seq int, method string, error string")
    assert {r[0] for r in resume.done_ids(log).collect()} == {"a", "c"}
    assert {r[0] for r in resume.done_ids(log, method="m").collect()} == {"a"}
    items = spark.createDataFrame([("a",), ("b",), ("z",)], "document_id string")
    assert {r[0] for r in resume.todo(items, log).collect()} == {"b", "z"}


def test_resume_stream(spark, tmp_path):
    spark.createDataFrame([("a",), ("b",)], "document_id string").write.parquet(str(tmp_path / "in"))
    sink = str(tmp_path / "out")
    log = spark.createDataFrame([("a", 1, "m", None)], "document_id string, seq int, method string, error string")
    stream = spark.readStream.schema("document_id string").parquet(str(tmp_path / "in"))
    resume.run_stream(stream, lambda: log, lambda d: d.withColumn("n", F.lit(1)), sink, str(tmp_path / "state")).awaitTermination()
    assert [r[0] for r in spark.read.parquet(sink).collect()] == ["b"]


def test_content(spark):
    rows = catalogue.flagship(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/pages.parquet").count() and sum(bool(r.content) for r in rows) > len(rows) / 2


def canonical(rows):
    return sorted(tuple(f"{v:.6g}" if isinstance(v, float) else str(v) for v in r) for r in rows)


def test_views_stay(spark):
    spark.range(3).createOrReplaceTempView("orders")
    catalogue.QUERIES["latest_copy"](spark, SF).collect()
    assert spark.table("orders").columns == ["id"] and [t.name for t in spark.catalog.listTables() if t.name.startswith("millrace_")] == []
    spark.catalog.dropTempView("orders")


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in relational.TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = catalogue.QUERIES[name](spark, SF)
    want = con.sql(catalogue.ORACLES[name])
    assert got.columns == want.columns
    assert canonical(got.collect()) == canonical(want.fetchall())
