"""Rules on facts: nulls, ties and the order of reasons."""

from pyspark.sql import functions as F

from millrace.operators import facts


def test_dismissal(spark):
    rows = [("€ 5", "price"), ("5 million", "price"), ("3 May 2021", "date"), ("May 3, 2021", "date"), ("1999", "date"), ("2199", None), ("+44 555 1234", "not_technical"), ("(020) 555-1234", "not_technical"), ("at 9.30 hrs", "not_technical"), ("24 cm", None), ("", None), (None, None)]
    table = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "i int, t string")
    got = {r.i: r.why for r in table.select("i", facts.dismissal(F.col("t"), F.lit("main"), F.lit(None).cast("string"), F.lit(False)).alias("why")).collect()}
    assert [got[i] for i in range(len(rows))] == [w for _, w in rows]
    marks = spark.createDataFrame([("0.0 kg", True), ("TBD", True), ("–", True), ("0.5 kg", False), ("", False), (None, False)], "t string, want boolean")
    assert all(r.got == r.want for r in marks.select("want", facts.is_placeholder(F.col("t")).alias("got")).collect())


def test_extractable(spark):
    blocks = spark.createDataFrame(
        [("d", "s", 1, "main", "paragraph", "body", None), ("d", "s", 2, "sidebar", None, None, ""), ("d", "t", 3, "sidebar", "p", "body", None), ("d", None, 4, "main", "metadata", "title", None), ("d", None, 5, "main", "metadata", "meta", None), ("d", "s", 6, "main", "p", "body", "1"), ("d", "s", 7, None, "p", "body", None), ("d", "s", 8, "cookie", "p", "body", None)],
        "doc_id string, section_id string, b int, scope string, type string, source string, dup_of string",
    )
    sections = spark.createDataFrame([("d", "s", "variants"), ("d", "s", "variants"), ("d", "t", None)], "doc_id string, section_id string, role string")
    assert sorted(r.b for r in facts.extractable(blocks, sections).collect()) == [1, 2, 4, 7]
    assert facts.extractable(blocks.limit(0), sections).count() == 0


def test_gate(spark):
    given = spark.createDataFrame([(f, v, c, o, s, w) for f, v, c, o, s, w in [("a", "24  CM", "x", "p", "pending", None), ("b", "24 cm", None, None, "pending", None), ("c", "9 cm", None, "p", "pending", None), ("d", None, None, "p", "pending", None), ("e", "24 cm", None, "p", "pending", "split_into_parts"), ("f", "24 cm", None, "p", "verified", None), ("g", "n/a", None, "p", "pending", None), ("h", "24 cm", None, "p", "pending", None)]], "fact_id string, value string, fact_class string, owner string, verification string, rejection_reason string").withColumn("doc_id", F.lit("d"))
    evidence = spark.createDataFrame([("d", f, "b1") for f in "abcdfg"] + [("d", "h", "b1"), ("d", "h", "gone"), ("d", "a", "b1")], "doc_id string, fact_id string, block_id string")
    blocks = spark.createDataFrame([("d", "b1", "n/a: height 24 cm"), ("d", "b2", None)], "doc_id string, block_id string, text string")
    got = {r.fact_id: (r.verification, r.rejection_reason) for r in facts.gate(given, evidence, blocks).collect()}
    out = ("rejected", "unsupported")
    assert got == {"a": ("pending", None), "b": ("unresolved", "no_owner"), "c": out, "d": out, "e": ("rejected", "split_into_parts"), "f": ("verified", None), "g": ("rejected", "placeholder"), "h": out}


def test_conflicts_and_owners(spark):
    rows = spark.createDataFrame([(1, "p", "height", None, "24 CM", True), (2, "p", "height", None, "24  cm", True), (3, "q", "height", None, "1", True), (4, "q", "height", None, "2", True), (5, None, "height", None, "1", True), (6, None, "height", None, "2", True), (7, "q", "height", "open", "3", True), (8, "q", "set", None, "1", None), (9, "q", "set", None, "2", None)], "i int, owner string, param string, conditions string, value string, single boolean").withColumn("doc_id", F.lit("d"))
    assert {r.i for r in facts.conflicting(rows).collect() if r.conflict} == {3, 4}
    sections = spark.createDataFrame([("d", "s", ["o"], None), ("d", "t", None, "heading")], "doc_id string, section_id string, owners array<string>, source string")
    evidence = spark.createDataFrame([("d", "f", 0, "b", "t"), ("d", "f", 1, "c", "s"), ("d", "g", 0, "b", "s"), ("d", "h", 0, None, None)], "doc_id string, fact_id string, place int, block_id string, section_id string")
    none = spark.createDataFrame([], "doc_id string, block_id string, owner string")
    by_column = spark.createDataFrame([], "doc_id string, fact_id string, block_id string, owner string")
    assert [tuple(r) for r in facts.structural_owner(evidence, none, by_column, sections).collect()] == [("d", "g", "o", "section:")]
