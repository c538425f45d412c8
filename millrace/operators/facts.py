"""Rules on blocks, inventory items and facts: what is read, dismissed, verified, owned, and how the ledger closes (F1, F2, F3, F9, F10, AG11, AG13, J8, J9).

Rows carry doc_id; ids are unique inside a document. Everything but structural_owner is joined or grouped by document and a finer key. Other columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.normal import normal_text

#: Scopes that are never content, and roles of sections that are read outside the main one.
NO_CONTENT = ("navigation", "footer", "cookie", "form", "header")
READ_ROLES = ("product_overview", "specifications", "features_capabilities", "variants", "comparison", "catalogue_listing", "accessories")
#: Signs of values that are no technical data.
MONTH = "(?:jan|feb|mar|apr|may|jun|jul|aug|sept?|oct|nov|dec)[a-z]*"
PRICE = r"(?i)(?:[$€£¥₹]|\b(?:usd|eur|gbp|inr|rs\.?|dollars?|euros?|rupees?)\b)\s?\d|\d\s?(?:million|billion|bn|mn|crore|lakh)\b"
DATE = rf"(?i)\b(?:\d{{1,2}}[./-]\d{{1,2}}[./-]\d{{2,4}}|{MONTH}\.?\s+\d{{1,2}},?\s+\d{{4}}|\d{{1,2}}\s+{MONTH}\.?\s+\d{{4}})\b"
YEAR = r"^\s*(?:19|20)\d{2}\s*$"
PHONE = r"^\s*(?:\+\d{1,3}[\s-]?)?(?:\(\d{2,4}\)[\s-]?)?\d{3,4}[\s-]\d{3,4}(?:[\s-]\d{2,4})?\s*$"
CONTACT = r"(?i)\b(?:phone|tel|telephone|fax|mobile|contact|e-?mail|address|hours|available|opening|postcode|zip|vat|cin|gst|registration|reg\.? no|p\.?o\.? box)\b"
CLOCK = r"(?i)\b\d{1,2}[:.]\d{2}\s?(?:am|pm|hrs)\b"
PLACEHOLDER = r"(?i)^\s*(?:0+(?:[.,]0+)?\s*[a-z%°]*|-|–|—|n/?a|tbd|tba|xx+|\?)\s*$"
#: Classes of facts that are no specifications, and why they are rejected.
CLASS_REASONS = {"procurement_information": "procurement_information", "marketing_claim": "marketing_only", "operational_event": "operational_event"}
ACCEPTED = ("verified", "verified_low_confidence")


def extractable(blocks: DataFrame, sections: DataFrame) -> DataFrame:
    """The blocks that are read (F1): content, no copies, no metadata but titles; outside the main scope only in sections of a read role.

    `blocks` has doc_id, section_id, scope, type, source, dup_of; `sections` has doc_id, section_id, role. A null scope isn't main.
    """
    roles = sections.filter(F.col("role").isin(*READ_ROLES)).select(F.col("doc_id").alias("_d"), F.col("section_id").alias("_s")).distinct()
    plain = ~F.coalesce(F.col("scope").isin(*NO_CONTENT, "breadcrumb"), F.lit(False)) & (F.coalesce("dup_of", F.lit("")) == "") & ((F.coalesce("type", F.lit("")) != "metadata") | (F.coalesce("source", F.lit("")) == "title"))
    held = blocks.filter(plain).join(roles, (F.col("doc_id") == F.col("_d")) & (F.col("section_id") == F.col("_s")), "left")
    return held.filter((F.coalesce("scope", F.lit("")) == "main") | F.col("_s").isNotNull()).select(*blocks.columns)


def dismissal(text: Column, scope: Column, label: Column, measured: Column) -> Column:
    """The first reason that dismisses an inventory item, else null (F2, F3). Null texts and labels match nothing."""
    said = lambda c, pattern: F.coalesce(c.rlike(pattern), F.lit(False))
    reason = F.when(F.coalesce(scope.isin(*NO_CONTENT), F.lit(False)), "navigation_contamination").when(said(text, PRICE), "price").when(said(text, DATE) | said(text, YEAR), "date")
    return reason.when((~F.coalesce(measured, F.lit(False)) & said(text, PHONE)) | said(label, CONTACT) | said(text, CLOCK), "not_technical")


def is_placeholder(value: Column) -> Column:
    return F.coalesce(value.rlike(PLACEHOLDER), F.lit(False))


def conflicting(facts: DataFrame) -> DataFrame:
    """facts with `conflict` (F9, AG13): whether one owner's parameter under equal conditions has several values.

    `facts` has doc_id, owner, param, conditions, value, single (the parameter is a number with one value). Values are compared in normal
    form. Without owner or parameter nothing conflicts; null conditions are conditions of their own.
    """
    group = Window.partitionBy("doc_id", "owner", "param", "conditions")
    formed = facts.withColumn("_v", normal_text(F.col("value")))
    differs = F.min("_v").over(group) != F.max("_v").over(group)
    counts = F.col("owner").isNotNull() & F.col("param").isNotNull() & F.coalesce("single", F.lit(False))
    return formed.withColumn("conflict", counts & differs).drop("_v")


def gate(facts: DataFrame, evidence: DataFrame, blocks: DataFrame) -> DataFrame:
    """facts with verification and rejection_reason after the rules that need no model.

    `facts` has doc_id, fact_id, value, fact_class, owner, verification, rejection_reason; `evidence` has doc_id, fact_id, block_id;
    `blocks` has doc_id, block_id, text. Only pending facts change: parts of a split and classes that are no specifications are rejected, then
    facts without evidence, with evidence on unknown blocks, or whose value stands in none of them in normal form, then placeholders; those
    without an owner are unresolved. The rest stay pending.
    """
    texts = blocks.select(F.col("doc_id").alias("_bd"), F.col("block_id").alias("_bb"), normal_text(F.col("text")).alias("_bt"))
    values = facts.select(F.col("doc_id").alias("_fd"), F.col("fact_id").alias("_ff"), normal_text(F.col("value")).alias("_fv"))
    named = evidence.select("doc_id", "fact_id", "block_id").distinct().join(values, (F.col("doc_id") == F.col("_fd")) & (F.col("fact_id") == F.col("_ff")))
    named = named.join(texts, (F.col("doc_id") == F.col("_bd")) & (F.col("block_id") == F.col("_bb")), "left")
    sound = F.bool_and(F.col("_bb").isNotNull()) & F.coalesce(F.bool_or((F.col("_fv") != "") & F.contains("_bt", "_fv")), F.lit(False))
    shown = named.groupBy("_fd", "_ff").agg(sound.alias("_sound"))
    held = facts.join(shown, (F.col("doc_id") == F.col("_fd")) & (F.col("fact_id") == F.col("_ff")), "left")
    pending, split = F.col("verification") == "pending", F.coalesce(F.col("rejection_reason") == "split_into_parts", F.lit(False))
    reason = F.when(split, "split_into_parts")
    for kind, why in CLASS_REASONS.items():
        reason = reason.when(F.col("fact_class") == kind, why)
    reason = reason.when(~F.coalesce("_sound", F.lit(False)), "unsupported").when(is_placeholder(F.col("value")), "placeholder")
    held = held.withColumn("_why", reason)
    verification = F.when(pending & F.col("_why").isNotNull(), "rejected").when(pending & F.col("owner").isNull(), "unresolved").otherwise(F.col("verification"))
    why = F.when(pending & F.col("_why").isNotNull(), F.col("_why")).when(pending & F.col("owner").isNull(), "no_owner").otherwise(F.col("rejection_reason"))
    new = {"verification": verification, "rejection_reason": why}
    return held.select(*[new[c].alias(c) if c in new else F.col(c) for c in facts.columns])


def fact_status(verification: Column, reason: Column) -> Column:
    """(status, reason) of a fact in the ledger."""
    pair = lambda status, why: F.struct(F.lit(status).alias("status"), why.cast("string").alias("reason"))
    return F.when(verification.isin(*ACCEPTED), pair("extracted", F.lit(None))).when(verification == "unresolved", pair("unresolved", F.coalesce(reason, F.lit("unresolved")))).when(reason == "split_into_parts", pair("duplicate", reason)).otherwise(pair("rejected", F.coalesce(reason, F.lit("unsupported"))))


def ledger(items: DataFrame, facts: DataFrame, links: DataFrame, sections: DataFrame) -> DataFrame:
    """(doc_id, origin, id, status, reason): each inventory item once, and each fact that no item has (AG11).

    `items` has doc_id, item_id, section_id, scope, dismissed_reason, audit_reason, skipped; `facts` has doc_id, fact_id, place, verification,
    rejection_reason; `links` has doc_id, fact_id, item_id; `sections` has doc_id, section_id, role. An item with facts is extracted if one is,
    else unresolved with the first such reason, else what the first fact is; facts split into parts count only if it has no others. An item
    without facts is rejected for its own reason, the audit's, or its place outside what is read; else it is unresolved.
    """
    told = facts.select("doc_id", "fact_id", F.struct("place", "fact_id", fact_status(F.col("verification"), F.col("rejection_reason")).alias("s")).alias("f"), F.coalesce(F.col("rejection_reason") == "split_into_parts", F.lit(False)).alias("split"))
    met = links.select("doc_id", "fact_id", "item_id").distinct().join(told, ["doc_id", "fact_id"])
    status = F.col("f.s.status")
    least = lambda test: F.min(F.when(test, F.col("f")))
    sums = {f"{n}_{k}": least(test & own) for n, test in (("e", status == "extracted"), ("u", status == "unresolved"), ("a", F.lit(True))) for k, own in (("own", ~F.col("split")), ("any", F.lit(True)))}
    found = met.groupBy(F.col("doc_id").alias("_d"), F.col("item_id").alias("_i")).agg(*[c.alias(n) for n, c in sums.items()])
    best = F.when(F.col("a_own").isNotNull(), F.coalesce("e_own", "u_own", "a_own")).otherwise(F.coalesce("e_any", "u_any", "a_any"))["s"]
    roles = sections.groupBy(F.col("doc_id").alias("_sd"), F.col("section_id").alias("_ss")).agg(F.min("role").alias("_role"))
    held = items.join(found, (F.col("doc_id") == F.col("_d")) & (F.col("item_id") == F.col("_i")), "left").join(roles, (F.col("doc_id") == F.col("_sd")) & (F.col("section_id") == F.col("_ss")), "left")
    pair = lambda s, why: F.struct(F.lit(s).alias("status"), why.alias("reason"))
    outside = (F.col("scope") != "main") & ~F.coalesce(F.col("_role").isin(*READ_ROLES), F.lit(False))
    related = F.coalesce(F.col("_role") == "related_products", F.lit(False)) | (F.col("scope") == "related_content")
    closed = F.when(best.isNotNull(), best).when(F.col("dismissed_reason").isNotNull(), pair("rejected", F.col("dismissed_reason"))).when(F.col("audit_reason").isNotNull(), pair("rejected", F.col("audit_reason")))
    closed = closed.when(outside, pair("rejected", F.when(related, "related_content").otherwise("out_of_scope_section"))).when(F.col("skipped"), pair("unresolved", F.lit("not_processed_document_budget"))).otherwise(pair("unresolved", F.lit("unexplained_inventory_item")))
    first = held.select("doc_id", F.lit("inventory").alias("origin"), F.col("item_id").cast("string").alias("id"), closed.alias("s"))
    free = told.join(links, ["doc_id", "fact_id"], "left_anti").select("doc_id", F.lit("discovery").alias("origin"), F.col("fact_id").cast("string").alias("id"), F.col("f.s").alias("s"))
    return first.unionByName(free).select("doc_id", "origin", "id", "s.status", "s.reason")


def row_owners(rows: DataFrame) -> DataFrame:
    """(doc_id, table_id, block_id, owner) of tables keyed by products (J8): two distinct ones or more, and at least half of the labelled rows, rounded down, two or more.

    `rows` has doc_id, table_id, block_id, label (may be null) and owner, the only product its label names, else null. Tables that go on
    after a page break share a table_id.
    """
    named = F.col("label").isNotNull() & F.col("owner").isNotNull()
    tables = rows.groupBy("doc_id", "table_id").agg(F.min(F.when(named, F.col("owner"))).alias("lo"), F.max(F.when(named, F.col("owner"))).alias("hi"), F.count(F.when(named, 1)).alias("n"), F.count("label").alias("all"))
    keyed = tables.filter((F.col("lo") != F.col("hi")) & (F.col("n") >= F.greatest(F.lit(2), F.floor(F.col("all") / 2)))).select("doc_id", "table_id")
    return rows.filter(named).join(keyed, ["doc_id", "table_id"], "left_semi").select("doc_id", "table_id", "block_id", "owner")


def structural_owner(evidence: DataFrame, by_row: DataFrame, by_column: DataFrame, sections: DataFrame, parts: int | None = None) -> DataFrame:
    """(doc_id, fact_id, owner, via): the owner that a document's structure gives a fact (J9); facts without one are left out.

    `evidence` has doc_id, fact_id, place, block_id, section_id; `by_row` has doc_id, block_id, owner; `by_column` has doc_id, fact_id, block_id, owner
    (a value under a product's column); `sections` has doc_id, section_id, owners, source. The first evidence with an owner by row or
    column counts, its row first; else the only owner of the first evidence's section. A document's rows are dealt to one of `parts` parts,
    once, and meet there.
    """
    single = F.when(F.size("owners") == 1, F.struct(F.get("owners", F.lit(0)).alias("owner"), F.concat(F.lit("section:"), F.coalesce("source", F.lit(""))).alias("via")))
    rows = by_row.select("doc_id", "block_id", F.col("owner").alias("r"))
    columns = by_column.select("doc_id", "fact_id", "block_id", F.col("owner").alias("c"))
    named = sections.select("doc_id", "section_id", F.struct(single.alias("o")).alias("s"))
    every = evidence.select("doc_id", "fact_id", "place", "block_id", "section_id", F.lit(True).alias("asks"))
    for more in (rows, columns, named):
        every = every.unionByName(more, allowMissingColumns=True)
    every = every.repartition("doc_id") if parts is None else every.repartition(parts, "doc_id")
    for name, keys in (("r", ["doc_id", "block_id"]), ("c", ["doc_id", "fact_id", "block_id"]), ("s", ["doc_id", "section_id"])):
        # Null keys meet nothing.
        known = F.lit(True)
        for k in keys:
            known = known & F.col(k).isNotNull()
        every = every.withColumn(name, F.when(known, F.min(name).over(Window.partitionBy(*keys))))
    held = every.filter("asks")
    own = F.when(F.col("r").isNotNull(), F.struct(F.col("r").alias("owner"), F.lit("table_row").alias("via"))).when(F.col("c").isNotNull(), F.struct(F.col("c").alias("owner"), F.lit("table_column").alias("via")))
    best = held.groupBy("doc_id", "fact_id").agg(F.min(F.when(own.isNotNull(), F.struct("place", own.alias("o")))).alias("a"), F.min(F.struct("place", F.col("s.o").alias("o"))).alias("b"))
    return best.select("doc_id", "fact_id", F.coalesce("a.o", "b.o").alias("o")).filter("o is not null").select("doc_id", "fact_id", "o.owner", "o.via")
