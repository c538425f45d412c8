"""Scoring of results against answer keys (E1 to E4, E7, J11 to J13, J16, AG5).

Keys are rows (doc_id, partial, products, facts, negatives) of KEY; results are rows (doc_id, result) with the result's JSON. A
document's key and result meet in one row by a join on doc_id, and are judged there; totals are aggregations over the judged rows.
Documents without a result count as not scored. Null fields count as absent, nulls and broken JSON as a result without content.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import normal
from millrace.functions.normal import holds
from millrace.functions.similarity import token_set

KEY = (
    "doc_id string, partial boolean, products array<struct<id:string,name:string,aliases:array<string>>>, "
    "facts array<struct<p:string,v:string,k:string,param:string,alt:array<string>,any:array<string>,nums:array<double>,pos:string,page:int>>, negatives array<string>"
)
#: Statuses that count as accepted, and a product's collections of texts.
ACCEPTED = frozenset(("verified", "verified_low_confidence"))
TEXTS = ("capabilities", "features", "technologies", "components", "compatibility", "missions", "targets")
RANKS = ("exact", "contains", "alt", "numeric", "fuzzy", "partial")
_TEXT = "array<struct<text:string,source_parameter:string,verification:string>>"
_OPEN = "array<struct<owner_entity_id:string,value_text:string,parameter:string,label:string>>"
_SPEC = "array<struct<value_text:string,parameter:struct<id:string,source_label:string,status:string>,verification:string,evidence:array<struct<page:int>>>>"
RESULT = (
    f"struct<products:array<struct<entity_id:string,name:string,aliases:array<string>,parent_entity_id:string,specifications:{_SPEC},"
    f"{','.join(f'{t}:{_TEXT}' for t in TEXTS)},unresolved:{_OPEN}>>,entities:array<struct<entity_id:string,name:string,aliases:array<string>,parent_entity_id:string>>,unattributed:{_OPEN}>"
)
_FACT = "array<struct<entity_id:string,value:string,param:string,label:string,status:string,kind:string,ontology_status:string,pages:array<int>>>"
#: Every key fact of a document meets every value: forms are made once for a text, and a bounded number of them is held.
answer_form, numbers, unit_words = (lru_cache(maxsize=20_000)(f) for f in (normal.answer_form, normal.numbers, normal.unit_words))
_SPEED, _PLACE = re.compile(r"km/h|kmh|kph|mph|\bkn\b|\bkt\b|knots|m/s"), re.compile(r"\bkm\b|\bm\b|nm")


def _fact(entity: Column, value: Column, param: Column, label: Column, status: Column, kind: str, known: Column | None = None, pages: Column | None = None) -> Column:
    pages = F.array().cast("array<int>") if pages is None else pages
    known = F.lit(None).cast("string") if known is None else known
    return F.struct(entity.alias("entity_id"), value.alias("value"), param.alias("param"), label.alias("label"), status.alias("status"), F.lit(kind).alias("kind"), known.alias("ontology_status"), pages.alias("pages"))


def predicted(result: Column) -> Column:
    """All facts of a parsed result (RESULT): each product's specifications, texts and open values, then those without an owner."""
    some = lambda c, kind: F.coalesce(c, F.array().cast(kind))

    def spec(p: Column, s: Column) -> Column:
        pages = F.array_sort(F.array_distinct(F.filter(F.transform(some(s["evidence"], "array<struct<page:int>>"), lambda e: e["page"]), lambda n: F.coalesce(n, F.lit(0)) != 0)))
        return _fact(p["entity_id"], s["value_text"], s["parameter"]["id"], s["parameter"]["source_label"], s["verification"], "spec", s["parameter"]["status"], pages)

    def of(p: Column) -> Column:
        said = lambda t: lambda x: _fact(p["entity_id"], x["text"], F.lit(t), x["source_parameter"], x["verification"], "text")
        texts = [F.transform(some(p[t], _TEXT), said(t)) for t in TEXTS]
        left = F.transform(some(p["unresolved"], _OPEN), lambda u: _fact(p["entity_id"], u["value_text"], u["parameter"], u["label"], F.lit("unresolved"), "spec"))
        return F.concat(F.transform(some(p["specifications"], _SPEC), lambda s: spec(p, s)), *texts, left)

    loose = F.transform(some(result["unattributed"], _OPEN), lambda u: _fact(F.coalesce(u["owner_entity_id"], F.lit("")), u["value_text"], u["parameter"], u["label"], F.lit("unresolved"), "spec"))
    return F.concat(F.coalesce(F.flatten(F.transform(result["products"], of)), F.array().cast(_FACT)), loose).cast(_FACT)


def value_match(want: dict, value: str | None) -> str | None:
    """How a value answers a key fact (v, any, nums), if it does."""
    key, got = answer_form(want["v"]), answer_form(value)
    if not got:
        return None
    if key == got:
        return "exact"
    if holds(got, key) and len(got) <= 3 * len(key) + 12:
        return "contains"
    others = [a for a in map(answer_form, want.get("any") or []) if a]
    if any(a == got or (holds(got, a) and len(got) <= 3 * len(a) + 15) for a in others):
        return "alt"
    if holds(key, got) and len(got) >= max(3, 0.6 * len(key)):
        return "partial"
    ours, theirs = unit_words(want["v"]), unit_words(value)
    if ours and theirs and not ours & theirs:
        return None
    if bool(_SPEED.search(key)) != bool(_SPEED.search(got)) and _PLACE.search(f"{key} {got}"):
        return None  # a speed is no distance
    given = list(want.get("nums") or [])
    need, have = given or numbers(want["v"]), numbers(value)
    if need and have and len(have) <= len(need) + 3 and all(any(abs(x - y) < 1e-6 for y in have) for x in need) and (given or len(need) >= 2 or token_set(key, got) >= 50):
        return "numeric"
    return "fuzzy" if not need and len(key) >= 6 and token_set(key, got) >= 92 else None


@lru_cache(maxsize=20_000)
def _digits(name: str) -> frozenset[str]:
    return frozenset(re.findall(r"\d+(?:\.\d+)?", name))


def same_product(name: str, other: str) -> bool:
    """Normal forms of a key's and a result's name: equal, one within the other, or nearly so; and no number of the key's is missing."""
    if not name or not other or name == other:
        return bool(name and other)
    if not _digits(name) <= _digits(other):  # cheaper than the similarity, so it comes first
        return False
    return (len(name) >= 3 and (name in other or other in name)) or token_set(name, other) >= 92


def parameter_outcome(want: dict, got: dict) -> str:
    allowed = {want["param"], *(want.get("alt") or [])}
    if want["param"] is None or got["kind"] == "text":
        return "n/a"
    if got["param"] in allowed:
        return "correct"
    if got["ontology_status"] != "dynamic":
        return "wrong_canonical"
    label = f"{answer_form(got['label'])} {(got['param'] or '').replace('_', ' ')}"
    return "dynamic_ok" if any(token_set(a.replace("_", " "), label) >= 70 for a in allowed) else "dynamic_other"


def ancestors(parent: dict[str, str | None], start: str, most: int = 6) -> set[str]:
    seen: list[str] = []
    at = parent.get(start)
    while at and at not in seen and len(seen) < most:
        seen.append(at)
        at = parent.get(at)
    return set(seen)


def judge(key: dict, facts: list[dict], products: list[dict], entities: list[dict]) -> dict:
    """Of one document, an outcome for every key fact, and counts."""
    parent: dict[str, str | None] = {}
    for e in [*reversed(products), *entities]:  # an entity's own link comes before its product's
        parent[e["entity_id"]] = e["parent_entity_id"]
    forms = lambda x: [answer_form(n) for n in [x["name"], *(x["aliases"] or [])]]
    named = [(e["entity_id"], forms(e)) for e in [*products, *entities] if e["entity_id"]]
    own = {p["id"]: {i for i, theirs in named if any(same_product(a, b) for a in forms(p) for b in theirs)} for p in key["products"] or []}
    everyone = set().union(*own.values())
    accepted = [f for f in facts if f["status"] in ACCEPTED]
    undecided = [f for f in facts if f["status"] == "unresolved"]
    wanted = key["facts"] or []
    match = [{i: m for i, f in enumerate(accepted) if (m := value_match(w, f["value"]))} for w in wanted]
    # A value that answers a fact of its own product is no stray of another's.
    rightful = {i for w, found in zip(wanted, match, strict=True) for i in found if accepted[i]["entity_id"] in own.get(w["p"], ())}
    used: Counter = Counter()
    rows = []
    for n, (w, found) in enumerate(zip(wanted, match, strict=True)):
        mine = own.get(w["p"], set())
        near = lambda f: not w["page"] or not len(f["pages"]) or any(abs(p - w["page"]) <= 1 for p in f["pages"])  # noqa: B023, E731
        best = min((i for i in found if accepted[i]["entity_id"] in mine), key=lambda i: (RANKS.index(found[i]), used[i], i), default=None)  # noqa: B023
        part = next((i for i in found if ancestors(parent, accepted[i]["entity_id"]) & mine), None)
        stray = next((i for i in found if i not in rightful and accepted[i]["entity_id"] not in mine and near(accepted[i])), None)
        hit, how = (best, found.get(best)) if best is not None else (part, "via_subsystem")
        if hit is not None:
            used[hit] += 1
            row = ("matched", how, accepted[hit], parameter_outcome(w, accepted[hit]))
        elif stray is not None:
            row = ("misattributed", None, accepted[stray], None)
        else:
            left = next((f for f in undecided if value_match(w, f["value"])), None)
            row = ("unresolved" if left else "missed", None, left, None)
        outcome, how, got, param = row
        rows.append({"fact": n, "k": w["k"] or "spec", "pos": w["pos"], "outcome": outcome, "match": how, "value": got and got["value"], "entity_id": got and got["entity_id"], "param": param})
    banned = [x for x in map(answer_form, key["negatives"] or []) if x]
    judged = [f for f in accepted if f["entity_id"] in everyone or not own]
    return {
        "rows": rows,
        "merged": sum(n > 1 for n in used.values()),
        "extras": sum(i not in used and f["entity_id"] in everyone for i, f in enumerate(accepted)),
        "others": 0 if key["partial"] else sum(f["entity_id"] not in everyone for f in accepted),
        "violations": sum(x in answer_form(f["value"]) for x in banned for f in judged),
        "accepted": len(accepted),
        "undecided": len(undecided),
    }


_JUDGED = "doc_id string, scored boolean, rows array<struct<fact:int,k:string,pos:string,outcome:string,match:string,value:string,entity_id:string,param:string>>, merged int, extras int, others int, violations int, accepted int, undecided int"


def score_documents(keys: DataFrame, results: DataFrame) -> DataFrame:
    """One judged row (rows and counts) for every key."""
    parsed = F.from_json("result", RESULT)
    rows = keys.join(results.select("doc_id", parsed.alias("r"), F.lit(True).alias("scored")), "doc_id", "left")
    rows = rows.select("doc_id", "partial", "products", "facts", "negatives", F.coalesce("scored", F.lit(False)).alias("scored"), predicted(F.col("r")).alias("got"), F.col("r.products").alias("theirs"), F.col("r.entities").alias("entities"))
    fact = pa.struct([("fact", pa.int32()), *[(n, pa.string()) for n in ("k", "pos", "outcome", "match", "value", "entity_id", "param")]])
    counts = ("merged", "extras", "others", "violations", "accepted", "undecided")
    kind = pa.schema([("doc_id", pa.string()), ("scored", pa.bool_()), ("rows", pa.list_(fact)), *[(n, pa.int32()) for n in counts]])
    nothing = judge({"products": [], "facts": [], "negatives": [], "partial": True}, [], [], [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [{"doc_id": r["doc_id"], "scored": r["scored"]} | (judge(r, r["got"], r["theirs"] or [], r["entities"] or []) if r["scored"] else nothing) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_pylist(out, schema=kind)

    return rows.mapInArrow(run, _JUDGED)


def outcomes(judged: DataFrame) -> DataFrame:
    return judged.select("doc_id", F.explode("rows").alias("r")).select("doc_id", "r.*")


def run_totals(judged: DataFrame) -> DataFrame:
    """One row: counts and recall of core and text facts, parameters, share of verbatim matches, and the documents' counts."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    number = lambda c: F.count(F.when(c, 1))
    # One pass: a document's own counts stand beside its first fact, or alone.
    rows = judged.select("scored", "merged", "extras", "others", "violations", F.posexplode_outer("rows").alias("place", "r")).withColumn("own", F.coalesce("place", F.lit(0)) == 0)
    rows = rows.select("scored", "merged", "extras", "others", "violations", "own", "r.*")
    columns = [number(F.col("own")).alias("documents"), number(F.col("own") & F.col("scored")).alias("scored"), *[total(F.when(F.col("own"), F.col(c))).alias(c) for c in ("merged", "extras", "others", "violations")]]
    is_in = {"core": F.col("k").isin("spec", "compat", "target"), "text": F.col("k") == "text"}
    for name, inside in is_in.items():
        hit = inside & (F.col("outcome") == "matched")
        columns += [number(inside).alias(f"{name}_n"), *[number(inside & (F.col("outcome") == o)).alias(f"{name}_{o}") for o in ("matched", "misattributed", "unresolved", "missed")]]
        columns += [number(inside & (F.col("match") == "via_subsystem")).alias(f"{name}_via_subsystem"), F.round(number(hit) / F.nullif(number(inside), F.lit(0)), 4).alias(f"{name}_recall")]
    columns += [number(F.col("param") == p).alias(f"param_{p}") for p in ("correct", "dynamic_ok", "dynamic_other", "wrong_canonical")]
    columns.append(F.round(number(F.col("match").isin("exact", "contains", "alt")) / F.greatest(number(F.col("outcome") == "matched"), F.lit(1)), 4).alias("verbatim_share"))
    return rows.agg(*columns)


def by_position(judged: DataFrame) -> DataFrame:
    """Recall by position in the document, of facts whose key names one."""
    hit = F.count(F.when(F.col("outcome") == "matched", 1))
    return outcomes(judged).filter(F.col("pos").isin("start", "middle", "end")).groupBy("pos").agg(F.count(F.lit(1)).alias("n"), hit.alias("matched"), F.round(hit / F.count(F.lit(1)), 4).alias("recall"))
