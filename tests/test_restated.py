"""Operators on DataFrames against plain Python."""

import datetime as dt
import os
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.functions import similarity
from millrace.operators import content, dealing, evaluation, facts, lineage, nearest, ordering, ranking, spans
from millrace.plans import catalogue
from millrace.streaming.breaker import breaker


def test_numbered(spark):
    draw = random.Random(5)
    # One group holds a third of the rows; places of 5,000 rows need more than one range.
    rows = [(i, None if draw.random() < 0.1 else "a" if draw.random() < 0.4 else draw.choice("bcd"), draw.randrange(50)) for i in range(5000)]
    table = spark.createDataFrame(rows, "id int, g string, place int")
    got = {r.id: r.place for r in ordering.numbered(table, F.col("place"), F.col("id")).collect()}
    assert got == {r[0]: n for n, r in enumerate(sorted(rows, key=lambda r: (r[2], r[0])), 1)}
    got = {r.id: r.n for r in ordering.numbered(table, F.col("place"), F.col("id"), name="n", within=F.col("g")).collect()}
    want = {}
    for g in {r[1] for r in rows}:
        want |= {r[0]: n for n, r in enumerate(sorted((r for r in rows if r[1] == g), key=lambda r: (r[2], r[0])), 1)}
    assert got == want
    assert ordering.numbered(table.limit(0), F.col("id")).collect() == []
    twice = ordering.numbered(spark.createDataFrame([(1,), (1,), (None,)], "id int"), F.col("id")).collect()
    assert sorted((r.place, r.id) for r in twice) == [(1, None), (2, 1), (3, 1)]


def test_orders(spark):
    table = spark.createDataFrame([(i, "a" if i < 6 else None, 10 - i) for i in range(8)], "id int, g string, size int")
    turns = [r.g for r in ordering.interleave(table, "g", "id").orderBy("place").collect()]
    assert turns == [None, "a", None, "a", "a", "a", "a", "a"]
    rows = ordering.budget_order(table, "g", "id", "size").orderBy("place").collect()
    # Six rows give round(1.5) = 2 heads, two give one.
    assert [r.part for r in rows] == ["head"] * 3 + ["tail"] * 5
    sizes = [10 - r.id for r in rows if r.part == "tail"]
    assert sizes == sorted(sizes)


def test_bm25(spark):
    docs = spark.createDataFrame([(1, "the jug is blue"), (2, "the cup is red red"), (3, ""), (4, None), (5, "the the")], "doc_id int, text string")
    asked = spark.createDataFrame([("q", "blue RED red"), ("r", "the"), ("s", None), ("t", "green")], "item_id string, text string")
    rows = [tuple(r)[:2] for r in ranking.bm25(docs, asked).orderBy("item_id", "place").collect()]
    assert rows[:2] == [("q", 2), ("q", 1)] and {r[0] for r in rows} == {"q", "r"}
    assert ranking.bm25(docs, asked, keep=1).count() == 2 and ranking.bm25(docs.limit(0), asked).count() == 0


def test_spans(spark):
    uses = spark.createDataFrame([("d", "*", 3, "u3"), ("d", "*", 9, "u9"), ("d", "*", 5, "u5"), ("d", "x", 1, "none")], "doc_id string, marker string, ord int, u string")
    legends = spark.createDataFrame([("d", "*", 2, "L2"), ("d", "*", 5, "L5b"), ("d", "*", 5, "L5a"), ("e", "*", 9, "L9")], "doc_id string, marker string, ord int, legend string")
    assert {r.u: r.legend for r in spans.nearest_legend(uses, legends).collect()} == {"u3": "L5a", "u5": "L5a", "u9": "L5a"}
    inner = spark.createDataFrame([("d", 0, 5, "a"), ("d", 2, 4, "b"), ("d", 4, 9, "c"), ("e", 1, 2, "d"), (None, 1, 2, "n")], "doc_id string, a int, b int, t string")
    covers = spark.createDataFrame([("d", 0, 5), ("d", 3, 8), (None, 0, 3)], "doc_id string, a int, b int")
    assert {r.t for r in spans.uncovered(inner, covers, "doc_id").collect()} == {"c", "d"}
    facts = spark.createDataFrame([("d", "b1", "f", 0, 4, "24 CM"), ("d", "b1", "g", None, None, "tall 24 cm"), ("d", "b1", "h", None, None, " ")], "doc_id string, block_id string, fact_id string, a int, b int, text string")
    items = spark.createDataFrame([("d", "b1", "i", 3, 9, "oak"), ("d", "b1", "j", 20, 25, "24  cm"), ("d", "b2", "k", 0, 4, "24 cm")], "doc_id string, block_id string, item_id string, a int, b int, text string")
    assert {tuple(r)[1:] for r in spans.link_items(facts, items).collect()} == {("f", "i"), ("f", "j"), ("g", "j")}


def test_breaker(spark):
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    calls = [(0, True), (10, True), (20, True), (909, True), (910, True), (920, False), (1810, False), (1820, True), (1830, False), (1840, True), (1850, None)]
    rows = [("m", at(s), i, bad) for i, (s, bad) in enumerate(calls)] + [(None, at(15), 99, True), ("n", None, 98, True)]
    table = spark.createDataFrame(rows, "m string, ts timestamp, refused int, bad boolean").withColumn("i", F.col("refused"))
    got = {r.i for r in breaker(table, "m", "ts", "i", F.col("bad")).collect() if r.refused}
    # The second failure, at 10, opens until 910; refused ones don't prolong it; that at 910 is made and opens until 1810; the success then clears.
    assert got == {2, 3, 5}


def test_shortlist_is_complete(spark):
    draw = random.Random(3)
    words = ["".join(draw.choice("aeiorst") for _ in range(draw.randint(2, 8))) for _ in range(50)]
    text = lambda k: " ".join(draw.choice(words) for _ in range(draw.randint(0, k)))
    labels, names = [text(4) for _ in range(40)] + ["armour", text(30), None], [text(5) for _ in range(90)] + ["Armor", None, "é" * 70]
    got = similarity.shortlist(spark.createDataFrame([(x,) for x in labels], "label string"), spark.createDataFrame([(x,) for x in names], "name string"), label_rows=10, name_rows=30)
    want = set()
    for label in {x for x in labels if x is not None}:
        scored = sorted((-round(similarity.token_set(label.lower(), n.lower()), 6), n) for n in {x for x in names if x is not None})
        want |= {(label, n, -s, place) for place, (s, n) in enumerate([x for x in scored if -x[0] >= 55][:5], 1)}
    assert {tuple(r) for r in got.collect()} == want and ("armour", "Armor", 90.909091, 1) in want


def test_ancestors(spark, tmp_path):
    # Two ways up are two rows, a loop ends at the last step, and a missing parent is an ancestor without further ones.
    links = [("a", "b"), ("a", "c"), ("b", "d"), ("c", "d"), ("d", "e"), ("x", "y"), ("y", "x"), ("z", None), (None, "a")]
    edges = spark.createDataFrame(links, "child string, parent string")
    want, step = [], [(c, p, 1) for c, p in links]
    while step:
        want += step
        step = [(c, q, k + 1) for c, p, k in step if k < 6 for r, q in links if r == p and p is not None]
    assert sorted(map(str, (tuple(r) for r in lineage.ancestors(edges).collect()))) == sorted(map(str, want))
    assert lineage.ancestors(edges, most=1).count() == len(links) and lineage.ancestors(edges.limit(0)).count() == 0
    # More rows than a recursive query may have: 600,000 customers have 1,200,000.
    spark.range(600_000).selectExpr("id as c_custkey", "cast(id % 25 as int) as c_nationkey").write.parquet(str(tmp_path / "customer.parquet"))
    spark.range(25).selectExpr("cast(id as int) as n_nationkey", "cast(id % 5 as int) as n_regionkey").write.parquet(str(tmp_path / "nation.parquet"))
    assert catalogue.QUERIES["product_ancestors"](spark, str(tmp_path)).count() == 1_200_025


def test_cosine_blocks(spark):
    draw = random.Random(2)
    # Copies tie, a vector of zeros has no angle (NaN, before all), and one without numbers or of another length no score (last).
    some = [[draw.uniform(-1, 1) for _ in range(4)] for _ in range(40)]
    rows = [(i, some[i % 40]) for i in range(200)] + [(200, None), (201, [1.0]), (202, [1.0, None, 1.0, 1.0]), (None, some[0])]
    table = spark.createDataFrame(rows, "id long, e array<float>")
    got = sorted((tuple(r) for r in nearest.cosine(table.filter("id % 50 = 0"), table, query_rows=3, rows=30).collect() if r.score is not None), key=lambda r: (r[0], r[3]))
    single = {i: np.array(e, dtype=np.float32).astype(float) for i, e in rows[:200]}
    want = []
    for q in range(0, 200, 50):
        cos = sorted((-round(float(single[q] @ v / np.sqrt((single[q] @ single[q]) * (v @ v))), 6), i) for i, v in single.items() if i != q)
        want += [(q, i, -s, n) for n, (s, i) in enumerate(cos[:5], 1)]
    assert [(q, i, n) for q, i, _, n in got] == [(q, i, n) for q, i, _, n in want] and [g[2] for g in got] == pytest.approx([w[2] for w in want])
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [0.0, 0.0]), (2, None), (3, [2.0, 4.0]), (4, [1.0])], "id long, e array<float>")
    assert [(r.vec_id, str(r.score)) for r in nearest.cosine(few.filter("id = 0"), few).orderBy("place").collect()] == [(1, "nan"), (3, "1.0"), (2, "None"), (4, "None")]
    assert [r.vec_id for r in nearest.cosine(few.filter("id = 2"), few, keep=2).orderBy("place").collect()] == [0, 1]
    assert nearest.cosine(few.limit(0), few).count() == 0


def test_cosine_is_one_product(spark):
    """Twenty million pairs in the time of matrix products, and no more scores at once than CELLS."""
    draw = np.random.default_rng(1)
    table = lambda n: pa.table({"id": pa.array(np.arange(n)), "e": pa.array(list(draw.normal(size=(n, 16)).astype(np.float32)))})
    schema = pa.schema([("qid", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
    assert nearest.block_nearest(table(1200), table(16384), 5, schema).num_rows == 6000


def tasks_of(frame):
    """The shuffles whose number of parts the plan fixes."""
    return [int(n) for n in re.findall(r"hashpartitioning\([^)]*, (\d+)\), REPARTITION_BY_NUM", frame._jdf.queryExecution().executedPlan().toString())]


def shuffles(frame):
    return frame._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.mark.parametrize("name", ["bm25_topk", "token_prf", "dot_leaders", "usable_keys", "structural_owner"])
def test_parts_grow_with_the_table(spark, monkeypatch, name):
    sf = "/root/testdata/sf0.001"
    monkeypatch.setattr(dealing.parts, "__defaults__", (10_000,))
    frame = catalogue.QUERIES[name](spark, sf)
    stored = os.path.getsize(f"{sf}/{'lineitem' if name in ('dot_leaders', 'structural_owner') else 'documents'}.parquet")
    assert -(-stored // 10_000) in tasks_of(frame)
    if name in ("token_prf", "dot_leaders"):
        assert shuffles(frame) == 1


def test_run_free_prf(spark):
    docs = spark.createDataFrame([(1, "a b\na b\nc"), (2, ""), (3, None), (None, "a"), (4, "x\n\n\nx"), (5, "only\nONE one")], "doc_id long, text string")
    got = {r.doc_id: (r.prec, r.rec, r.f1) for r in content.run_free_prf(docs).collect()}
    assert got == {1: (0.6, 1.0, 0.75), 4: (1.0, 1.0, 1.0), 5: (1.0, 1.0, 1.0)}


def test_holding(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (1, "e"), (2, "A B c"), (3, None), (None, "a b c d e")], "doc_id long, text string")
    asked = spark.createDataFrame([("q", "a b c d e e"), ("r", "z"), (None, "a"), ("s", None)], "item_id string, text string")
    want = {("q", 1, 5, 5), ("q", None, 5, 5)}
    assert {tuple(r) for r in ranking.holding(docs, asked).collect()} == want


def test_totals_judge_once(spark):
    judged = spark.createDataFrame([], evaluation._JUDGED).mapInArrow(lambda batches: batches, evaluation._JUDGED)
    assert evaluation.run_totals(judged)._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_forms_are_made_once(monkeypatch):
    """Ten facts against ten values of other products: forms by text, no similarity of names whose numbers differ, no pattern for texts that don't occur."""
    asked = []
    monkeypatch.setattr(evaluation, "token_set", lambda a, b: asked.append((a, b)) or 0.0)
    key = {"products": [{"id": f"P {i}", "name": f"P {i}", "aliases": None} for i in range(10)], "facts": [{"p": f"P {i}", "v": f"9{i} mm", "k": None, "param": None, "alt": None, "any": None, "nums": None, "pos": None, "page": None} for i in range(10)], "negatives": None, "partial": False}
    theirs = [{"entity_id": f"e{i}", "name": f"P {i}", "aliases": None, "parent_entity_id": None} for i in range(10)]
    got = [{"entity_id": f"e{i}", "value": f"9{i} mm", "param": None, "label": None, "status": "verified", "kind": "spec", "ontology_status": None, "pages": []} for i in range(10)]
    evaluation.answer_form.cache_clear()
    rows = evaluation.judge(key, got, theirs, [])["rows"]
    assert [r["match"] for r in rows] == ["exact"] * 10 and asked == [] and evaluation.answer_form.cache_info().misses <= 20


def test_structural_owner_meets(spark):
    evidence = spark.createDataFrame([("d", "f", 0, "b", "s"), ("d", "g", 0, None, None), ("d", "h", 0, "c", "u"), (None, "f", 0, "b", "s"), ("d", "i", 0, "x", "t"), ("d", "i", 1, "b", "s")], "doc_id string, fact_id string, place int, block_id string, section_id string")
    by_row = spark.createDataFrame([("d", "b", "q"), ("d", "b", "p"), ("d", None, "n"), (None, "b", "n")], "doc_id string, block_id string, owner string")
    by_column = spark.createDataFrame([("d", "h", "c", "k"), ("d", "f", "b", "k"), ("d", "f", "c", "k")], "doc_id string, fact_id string, block_id string, owner string")
    sections = spark.createDataFrame([("d", "s", ["o"], "heading"), ("d", "t", ["o"], None), ("d", None, ["o"], None)], "doc_id string, section_id string, owners array<string>, source string")
    got = facts.structural_owner(evidence, by_row, by_column, sections, 3)
    assert shuffles(got) == 1
    assert {tuple(r) for r in got.collect()} == {("d", "f", "p", "table_row"), ("d", "h", "k", "table_column"), ("d", "i", "p", "table_row")}
