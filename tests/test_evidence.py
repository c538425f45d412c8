"""Measurements, blocks, chunks, similarities and budget state."""

import random

import pytest

from millrace.functions import measure, similarity
from millrace.operators import chunks, measurements
from millrace.sources.blocks import block_rows, blocks
from millrace.streaming import budget

PAGE = """<html><head><title>Brook kettle</title><script type="application/ld+json">{"@type":"Product","weight":"900 g"}</script></head><body>
<nav><ul><li><a>Kitchen</a><li><a>Garden</a></ul></nav><div><h1>Brook kettle</h1><p>A kettle of <b>blue</b> steel.<p>It pours well<h2>Data sheet</h2>
<table><tr><th>Name</th><th>Value</th></tr><tr><td>Height</td><td>24 cm</td></tr></table>
<table><tr><th></th><th>Small</th><th>Large</th></tr><tr><td>Volume</td><td>1 l</td><td>2 l</td></tr><tr><td rowspan=2>Lid</td><td colspan=2>flat</td></tr><tr><td>round</td><td>open</td></tr></table>
<div class="spec"><div class="label">Weight</div><div class="value">900 g</div></div><dl><dt>Handle</dt><dd>Oak (waxed)</dd></dl><div><span data-count="12">0</span> <span>h</span></div></div><footer><p>Imprint</p></footer>"""


def found(text):
    return [(text[f.a : f.b], f.kind) for f in measure.find(text)]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Width 81.5 cm, mass 1,204 kg", [("81.5 cm", "scalar"), ("1,204 kg", "scalar")]),
        ("up to 12 km or > 900 ft", [("up to 12 km", "bound"), ("> 900 ft", "bound")]),
        ("from the valley 1.5 m to 2.5 m; outside -4°C to +31°C", [("1.5 m to 2.5 m", "range"), ("-4°C to +31°C", "range")]),
        ("a box of 310 x 220 x 95 mm", [("310 x 220 x 95 mm", "composite")]),
        ("84 percent of it", [("84 percent", "percent")]),
        ("Opened in 1987 by the river", []),
        ("", []),
    ],
)
def test_measurements(text, want):
    assert found(text) == want


def test_units_by_case():
    want = {"77 Nm": "torque", "12 NM": "length", "6 KN": "force", "9 kn": "speed", "60 W": "power"}
    assert {t: measure.dimension(measure.find(t)[0].values[0][1]) for t in want} == want


def test_measurement_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "no digits"), (4, "up to 12km " * 20000)], "doc_id long, text string")
    rows = measurements.measurements(docs).groupBy("doc_id", "base").count().collect()
    assert [tuple(r) for r in rows] == [(4, 12000.0, 20000)]
    assert measurements.measurements(docs.limit(0)).collect() == []


def test_blocks():
    got = [(b["type"], b["text"], b["scope"], b["section"]) for b in block_rows(PAGE)]
    for want in [("list_item", "Garden", "navigation", 0), ("paragraph", "A kettle of blue steel.", "unknown", 1), ("table_row", "Height: 24 cm", "unknown", 2), ("table_row", "Volume — Small: 1 l; Large: 2 l", "unknown", 2)]:
        assert want in got
    texts = [t for _, t, _, _ in got]
    assert {"Lid — Small: flat; Large: flat", "Lid — Small: round; Large: open", "Weight: 900 g", "weight: 900 g", "Handle: Oak (waxed)", "12 h"} <= set(texts)
    assert [b["path"] for b in block_rows(PAGE) if b["text"] == "12 h"] == [["Brook kettle", "Data sheet"]]
    assert block_rows(None) == [] and len(block_rows("<div>" * 5000 + "x")) == 1


def test_blocks_keep_every_word(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, None), (3, "")], "page_id long, html string")
    assert {r.page_id for r in blocks(pages).collect()} == {1}


def test_chunks(spark):
    assert chunks.assign([10] * 10, [1] * 10, [2] * 10, max_items=6) == [1, 1, 1, 2, 2, 2, 3, 3, 3, 4]
    assert chunks.assign([700, 10], [1, 2], [0, 0], 1000) == [1, 2] and chunks.assign([9000, 1], [1, 1], [0, 0]) == [1, 2]
    pages = spark.createDataFrame([(1, PAGE)], "page_id long, html string")
    rows = chunks.build_chunks(blocks(pages), max_tokens=60).orderBy("ord").collect()
    assert rows[0].chunk == 1 and sorted({r.chunk for r in rows}) == list(range(1, rows[-1].chunk + 1))


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_similarity(spark):
    draw = random.Random(5)
    for _ in range(300):
        a, b = ("".join(draw.choices("abc ", k=draw.randrange(12))) for _ in range(2))
        assert similarity.indel(a, b) == pytest.approx(200 * lcs(a, b) / (len(a) + len(b)) if a or b else 100)
    assert similarity.token_set("blue steel", "steel blue kettle") == 100 and similarity.token_set("", "a") == 0
    labels = spark.createDataFrame([("Blue lid",), (None,), ("zzz",)], "label string")
    names = spark.createDataFrame([("blue round lid",), ("lid screw",), (None,)], "name string")
    assert [tuple(r)[:2] for r in similarity.shortlist(labels, names).orderBy("place").collect()][0] == ("Blue lid", "blue round lid")


def test_budget_stream(spark, tmp_path):
    rows = [("a", 1, 0.1), ("a", 2, 0.25), ("a", 3, 0.06), ("b", 4, None)]
    spark.createDataFrame(rows, budget_schema := "doc_id string, call_id long, cost double").write.parquet(str(tmp_path / "in"))
    stream = budget.guard(spark.readStream.schema(budget_schema).parquet(str(tmp_path / "in")), 0.4)
    stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    got = {r.call_id: (round(r.spent, 6), r.over_cap) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {1: (0.1, False), 2: (0.35, False), 3: (0.41, True), 4: (0.0, False)}
