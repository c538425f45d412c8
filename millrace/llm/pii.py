"""Personal data by weak supervision, in DataFrame expressions only.

Base spans: e-mail addresses, IP addresses, card and phone numbers by their patterns, leftmost and not overlapping within a kind, kept
if their checks hold (parts to 255; 13 to 19 digits with a right Luhn sum; 9 to 15 digits). They are always spans.

Candidates: base spans, and matches of looser patterns of each kind (LOOSE), which the base patterns miss. Labelers vote on every
candidate: pattern labelers (a strict form of the kind), gazetteers (fixed lists: domain endings, dialling codes, address ranges) and
context labelers (cue words in the CONTEXT characters before, as far as no other candidate of the pattern stands there; a check of the
digits). Votes are yes, no or none. Expectation-maximisation over the counts of vote patterns gives the labelers' reliabilities and each
pattern's probability; these are the soft labels of a logistic span classifier over the votes and the span's length class. Loose
candidates with a probability of at least THRESHOLD that touch no base span and no earlier one are added.

Positions count code points, end exclusive. Null and empty texts have no spans. Repeated rows are each answered. What reaches the driver
are counts by vote pattern, at most KINDS x 3^labelers x 3 rows whatever the corpus.

Splitting a text by a pattern and listing the pattern's matches give, together, all positions, by running sums in blocks: the work on n
matches grows as n^(4/3) at most, and a text full of matches is no quadratic case. Patterns are written with possessive
loops, so that long runs neither recurse nor are tried again from their middle; the matches are those of the plain forms.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import materialize

KINDS = ("email", "ip", "card", "phone")
THRESHOLD, CONTEXT = 0.9, 24
_LOCAL = r"[A-Za-z0-9._%+-]"
#: A run that is no address from its start is none from its middle either; \G lets a match begin where the last one ended.
BASE = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?+[0-9])++",
    "phone": r"\+[0-9](?:[ ().-]*+[0-9])++",
}
#: Forms that the base patterns don't take: written-out signs in addresses, a letter-free grouping, numbers without a plus.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?(?i:\[at\]|\(at\)| at ) ?[A-Za-z0-9-]{1,63}+(?: ?(?i:\[dot\]|\(dot\)| dot |\.) ?[A-Za-z0-9-]{1,63}+){1,4}+",
    "ip": r"(?<![0-9A-Fa-f:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:.])",
    "card": r"(?<![0-9A-Za-z.])(?:[0-9]{4}[./_]){3}[0-9]{4}(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+(.-])(?:00[1-9][0-9]{0,2}[ .-]|\([0-9]{2,4}\) ?|0[0-9]{1,4}[ ./-])[0-9]{2,5}(?:[ .-][0-9]{2,5}){1,3}(?![0-9A-Za-z-])",
}
#: Fixed lists.
ENDINGS = (
    *("com", "org", "net", "edu", "gov", "mil", "int", "info", "biz", "name", "pro", "dev", "app", "io", "ai", "co", "me", "tv"),
    *("at", "au", "be", "br", "ca", "ch", "cn", "cz", "de", "dk", "es", "eu", "fi", "fr", "gr", "hu", "ie", "in", "it", "jp", "kr", "mx"),
    *("nl", "no", "nz", "pl", "pt", "ro", "ru", "se", "sk", "tr", "ua", "uk", "us", "za"),
)
DIALLING = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "52", "55", "61", "64", "81", "82", "86", "90", "91")
LOCAL_RANGES = ("10", "127", "192.168", "169.254", "fe80", "fd00", "2001")
CUES = {
    "email": ("mail", "e-mail", "email", "contact", "write", "reach", "kontakt", "schreiben", "contacto", "escriba", "courriel", "écrire", "correo", "posta"),
    "ip": ("ip", "ipv6", "host", "hosts", "server", "address", "adresse", "dirección", "login", "client", "gateway", "dns"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "debit", "karte", "kreditkarte", "carte", "tarjeta", "carta", "pan"),
    "phone": ("phone", "tel", "call", "fax", "mobile", "cell", "telephone", "telefon", "handy", "anruf", "telefono", "teléfono", "llame", "téléphone", "appeler", "whatsapp"),
}
LABELERS = ("strict", "gazetteer", "context", "check")


_SPAN = "array<struct<kind:string,base:boolean,s:int,e:int,t:string,b:string>>"


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with the value evaluated once however often it is used."""
    return F.get(F.transform(F.array(value), then), 0)


def running(values: Column, op: Callable[[Column, Column], Column], zero: int = 0) -> Column:
    """op over all values up to each, of an array of ints. In blocks of the cube root, so that no long array is built by appending."""
    none = F.array().cast("array<int>")

    def fold(xs: Column, value: Callable[[Column], Column], kept: Callable[[Column, Column], Column]) -> Column:
        start = F.struct(F.lit(zero).alias("at"), none.alias("out"))
        return F.aggregate(xs, start, lambda st, x: _let(op(st["at"], value(x)), lambda now: F.struct(now.alias("at"), F.concat(st["out"], F.array(kept(st["at"], now))).alias("out"))))

    def blocked(v: Column) -> Column:
        size = F.greatest(F.ceil(F.cbrt(2 * F.size(v))).cast("int"), F.lit(1))
        begins = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(v) / size).cast("int") - 1, F.lit(0)))
        return F.transform(begins, lambda i: fold(F.slice(v, i * size + 1, size), lambda x: x, lambda was, now: now))

    def joined(blocks: Column) -> Column:
        before = fold(blocks, lambda x: x["at"], lambda was, now: was)["out"]
        return F.flatten(F.zip_with(blocks, before, lambda x, first: F.transform(x["out"], lambda y: op(first, y))))

    return F.when(F.size(values) > 0, _let(values, lambda v: _let(blocked(v), joined))).otherwise(none)


def _spans(text: Column, kind: str, pattern: str, base: bool) -> Column:
    """The pattern's matches (_SPAN): t is the match, b the CONTEXT characters before it."""
    parts = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("between"))

    def placed(x: Column) -> Column:
        both = F.zip_with(x["found"], x["between"], lambda m, b: F.struct(m.alias("t"), F.substring(b, -CONTEXT, CONTEXT).alias("b"), (F.length(b) + F.coalesce(F.length(m), F.lit(0))).alias("n")))
        both = F.slice(both, 1, F.size(x["found"]))
        return _let(both, lambda y: F.zip_with(y, running(F.transform(y, lambda z: z["n"]), lambda p, q: p + q), span))

    def span(y: Column, e: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.lit(base).alias("base"), (e - F.length(y["t"])).alias("s"), e.alias("e"), y["t"].alias("t"), y["b"].alias("b"))

    return _let(parts, placed).cast(_SPAN)


def _digits(t: Column) -> Column:
    return F.regexp_replace(t, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    n = F.length(digits)
    total = F.aggregate(
        F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
        F.lit(0),
        lambda t, i: t + F.when((n - i) % 2 == 1, F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), F.coalesce(F.substring(digits, i, F.lit(1)).try_cast("int"), F.lit(0)) + 1)).otherwise(F.coalesce(F.substring(digits, i, F.lit(1)).try_cast("int"), F.lit(0))),
    )
    return (n > 0) & (total % 10 == 0)


def _valid(kind: str, t: Column) -> Column:
    if kind == "ip":
        # Leading zeros don't count; over three digits left is over 255.
        return F.forall(F.split(t, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.coalesce(F.substring(F.ltrim(p, F.lit("0")), 1, 3).try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return F.length(_digits(t)).between(13, 19) & luhn(F.substring(_digits(t), 1, 19))
    if kind == "phone":
        return F.length(_digits(t)).between(9, 15)
    return F.lit(True)


def _check(kind: str) -> Callable[[Column], Column]:
    return lambda x: _valid(kind, x["t"])


def base_spans(text: Column) -> Column:
    none = F.array().cast(_SPAN)
    digits = text.rlike("[0-9]")
    possible = {"email": F.contains(text, F.lit("@")), "ip": digits & text.rlike(r"[0-9]\.[0-9]"), "card": digits, "phone": F.contains(text, F.lit("+"))}
    checked = {k: F.filter(_spans(text, k, BASE[k], True), _check(k)) for k in KINDS}
    return F.concat(*[F.when(possible[k], checked[k]).otherwise(none) for k in KINDS])


def _loose_spans(text: Column) -> Column:
    none = F.array().cast(_SPAN)
    possible = {"email": text.rlike(r"(?i)\[at\]|\(at\)| at "), "ip": text.rlike("[0-9A-Fa-f]:[0-9A-Fa-f]{1,4}:"), "card": text.rlike("[0-9]{4}[./_][0-9]{4}"), "phone": text.rlike("[0-9][ ./)-] ?[0-9]{2}")}
    return F.concat(*[F.when(possible[k], _spans(text, k, LOOSE[k], False)).otherwise(none) for k in KINDS])


def _votes(x: Column) -> Column:
    """The labelers' votes on a candidate, one sign each (1 yes, 0 no, - none), then its length class."""
    t, kind, base, before = F.lower(x["t"]), x["kind"], x["base"], F.lower(x["b"])
    n = F.length(_digits(t))
    pick = lambda cases: F.coalesce(*[F.when(kind == k, c) for k, c in cases.items()])
    sign = lambda c: F.when(c, "1").otherwise("0")
    any_of = lambda words: "|".join(w.replace(".", r"\.") for w in words)
    strict = F.when(base, "1").otherwise(pick({"email": sign(t.rlike(r"[\[(](?:at|dot)[\])]")), "ip": sign(t.rlike("[0-9]")), "card": sign(~t.rlike("_")), "phone": sign(t.rlike(r"^(?:\(|00)"))}))
    gazetteer = pick(
        {
            "email": sign(t.rlike(rf"(?:\.|dot[\])]? ?)(?:{any_of(ENDINGS)})$")),
            "ip": F.when(t.rlike(rf"^(?:{any_of(LOCAL_RANGES)})[.:]"), "1").otherwise("-"),
            "card": sign(t.rlike("^[3-6]")),
            "phone": F.when(t.rlike(rf"^(?:00|\+)(?:{any_of(DIALLING)})(?![0-9]{{2}})"), "1").otherwise("-"),
        }
    )
    context = pick({k: F.when(before.rlike(rf"(?:^|[^\p{{L}}])(?:{any_of(CUES[k])})[^\p{{L}}]{{0,3}}"), "1").otherwise("-") for k in KINDS})
    check = F.when(base, "1").otherwise(pick({"email": sign(~t.rlike(r" at .* dot .* dot ")), "ip": sign(~t.rlike("^0:")), "card": sign(luhn(_digits(t))), "phone": sign(n.between(9, 15))}))
    length = F.when(F.length(t) < 14, "s").when(F.length(t) < 22, "m").otherwise("l")
    return F.concat(strict, gazetteer, context, check, length)


def expectation_maximisation(counts: dict[str, int], rounds: int = 50) -> tuple[float, list[dict[str, tuple[float, float]]]]:
    """Of vote patterns with counts, the share of true candidates, and per labeler the probability of each vote given true and given false."""
    prior, n = 0.3, len(LABELERS)
    tables = [{"1": (0.6, 0.15), "0": (0.1, 0.5), "-": (0.3, 0.35)} for _ in range(n)]
    for _ in range(rounds):
        total = true = 0.0
        sums = [{v: [0.5, 0.5] for v in "10-"} for _ in range(n)]
        for pattern, count in counts.items():
            p = posterior(pattern, prior, tables)
            total, true = total + count, true + p * count
            for table, v in zip(sums, pattern, strict=False):
                table[v][0] += p * count
                table[v][1] += (1 - p) * count
        prior = (true + 1) / (total + 2)
        tables = [{v: (a / sum(x[0] for x in t.values()), b / sum(x[1] for x in t.values())) for v, (a, b) in t.items()} for t in sums]
    return prior, tables


def posterior(pattern: str, prior: float, tables: list[dict[str, tuple[float, float]]]) -> float:
    yes, no = prior, 1 - prior
    for table, v in zip(tables, pattern, strict=False):
        yes, no = yes * table[v][0], no * table[v][1]
    return yes / (yes + no)


def train(counts: dict[str, int], soft: dict[str, float], rounds: int = 300, rate: float = 0.5) -> dict[str, float]:
    """Logistic weights by (place, sign) of the patterns, and a bias, from soft labels."""
    weights: dict[str, float] = {"bias": 0.0}
    keys = {p: ["bias", *(f"{i}{v}" for i, v in enumerate(p))] for p in counts}
    total = sum(counts.values()) or 1
    for _ in range(rounds):
        slope: dict[str, float] = {}
        for p, ks in keys.items():
            s = sum(weights.get(k, 0.0) for k in ks)
            error = counts[p] * (soft[p] - 1 / (1 + math.exp(-max(-30.0, min(30.0, s)))))
            for k in ks:
                slope[k] = slope.get(k, 0.0) + error / total
        for k, g in slope.items():
            weights[k] = weights.get(k, 0.0) * (1 - 1e-4) + rate * g
    return weights


def classifier(rows: DataFrame) -> dict[str, dict[str, float]]:
    """Weights by kind, from candidates (array<struct<kind, ..., votes>>)."""
    got = rows.select(F.explode("candidates").alias("x")).groupBy(F.col("x.kind").alias("kind"), F.col("x.votes").alias("votes")).count().collect()
    out = {}
    for kind in KINDS:
        full = {r["votes"]: r["count"] for r in got if r["kind"] == kind}
        prior, tables = expectation_maximisation(full)
        out[kind] = train(full, {p: posterior(p, prior, tables) for p in full})
    return out


def _probability(x: Column, weights: dict[str, dict[str, float]]) -> Column:
    cases = []
    for kind in KINDS:
        s = F.lit(weights[kind]["bias"])
        for i in range(len(LABELERS) + 1):
            sign = F.substring(x["votes"], i + 1, 1)
            own = {k[1:]: w for k, w in weights[kind].items() if k != "bias" and int(k[0]) == i}
            s = s + F.coalesce(*[F.when(sign == v, F.lit(w)) for v, w in own.items()], F.lit(0.0))
        cases.append(F.when(x["kind"] == kind, 1 / (1 + F.exp(-s))))
    return F.coalesce(*cases)


_PLACE = "array<struct<kind:string,s:int,e:int>>"


def _apart(spans: Column, others: Column) -> Column:
    """The spans that touch none of the others. Both in order of start."""
    mark = lambda xs, own: F.transform(xs, lambda x: F.struct(x["s"].alias("s"), F.lit(own).alias("own"), x["e"].alias("e"), x["kind"].alias("kind")))
    far = 2**31 - 1

    def among(xs: Column) -> Column:
        ends = running(F.transform(xs, lambda x: F.when(x["own"] == 1, 0).otherwise(x["e"])), lambda p, q: F.greatest(p, q))
        starts = F.reverse(running(F.reverse(F.transform(xs, lambda x: F.when(x["own"] == 1, far).otherwise(x["s"]))), lambda p, q: F.least(p, q), far))
        kept = F.filter(F.arrays_zip(xs.alias("x"), ends.alias("before"), starts.alias("after")), lambda y: (y["x"]["own"] == 1) & (y["before"] <= y["x"]["s"]) & (y["after"] >= y["x"]["e"]))
        return F.transform(kept, lambda y: F.struct(y["x"]["kind"].alias("kind"), y["x"]["s"].alias("s"), y["x"]["e"].alias("e")))

    return F.when(F.size(spans) > 0, _let(F.array_sort(F.concat(mark(spans, 1), mark(others, 0))), among)).otherwise(F.array().cast(_PLACE))


def _leading(spans: Column) -> Column:
    """In order of start: spans that begin at or behind the end (`at`) of all earlier ones."""

    def among(xs: Column) -> Column:
        ends = running(F.transform(xs, lambda x: x["e"]), lambda p, q: F.greatest(p, q))
        before = F.concat(F.array(F.lit(0)), ends)
        return F.filter(F.zip_with(xs, F.slice(before, 1, F.size(xs)), lambda x, at: F.struct(x["kind"].alias("kind"), x["s"].alias("s"), x["e"].alias("e"), at.alias("at"))), lambda y: y["s"] >= y["at"])

    ordered = F.array_sort(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["kind"].alias("kind"), x["e"].alias("e"))))
    return F.when(F.size(spans) > 0, _let(ordered, among)).otherwise(F.array().cast("array<struct<kind:string,s:int,e:int,at:int>>"))


def find_spans(docs: DataFrame, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """(row, base, added): a struct of the carried columns (all but the text, by default), and array<struct<kind, s, e>>s.

    Base spans are in order of kind and start, added ones in order of start.
    """
    plain = F.coalesce(F.col(text), F.lit(""))
    carry = [c for c in docs.columns if c != text] if carry is None else carry
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.concat(base_spans(plain), _loose_spans(plain)).alias("found"))
    candidates = F.transform("found", lambda x: F.struct(x["kind"].alias("kind"), x["base"].alias("base"), x["s"].alias("s"), x["e"].alias("e"), _votes(x).alias("votes")))
    rows = materialize(rows.select("row", candidates.alias("candidates")), "pii-spans")
    weights = classifier(rows)
    places = lambda xs: F.transform(xs, lambda x: F.struct(x["kind"].alias("kind"), x["s"].alias("s"), x["e"].alias("e")))
    likely = F.filter("candidates", lambda x: ~x["base"] & (_probability(x, weights) >= THRESHOLD))
    base = F.filter("candidates", lambda x: x["base"])
    added = _let(F.struct(places(likely).alias("likely"), places(base).alias("base")), lambda z: places(_leading(_apart(z["likely"], z["base"]))))
    return rows.select("row", places(base).alias("base"), added.alias("added"))


def mask(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with every span, or group of spans that touch, replaced by its first one's kind in angle brackets."""
    plain = F.col(f"row.`{text}`")
    joined = lambda chars, a, b: F.array_join(F.slice(chars, a + 1, b - a), "")

    def cut(z: Column) -> Column:
        pieces = F.transform(z["spans"], lambda x: F.concat(joined(z["chars"], x["at"], x["s"]), F.lit("<"), x["kind"], F.lit(">")))
        return F.concat(F.array_join(pieces, ""), joined(z["chars"], z["end"], F.size(z["chars"])))

    both = F.concat("base", "added")
    masked = _let(F.struct(_leading(both).alias("spans"), F.split(plain, "").alias("chars"), F.array_max(F.transform(both, lambda x: x["e"])).alias("end")), cut)
    return find_spans(docs, text, docs.columns).select(*[(F.when(F.size(both) > 0, masked).otherwise(plain) if c == text else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def digest(docs: DataFrame) -> DataFrame:
    found = find_spans(docs.select("doc_id", "text"))
    order = lambda x: F.element_at(F.create_map(*[F.lit(v) for i, k in enumerate(KINDS) for v in (k, i)]), x["kind"])
    listed = lambda c: F.array_join(F.transform(F.array_sort(F.transform(c, lambda x: F.struct(order(x).alias("o"), x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind")))), lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")
    is_kind = {k: (lambda kind: lambda x: x["kind"] == kind)(k) for k in KINDS}
    counts = [F.size(F.filter("base", is_kind[k])).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("row.doc_id", *counts, F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"), listed(F.concat("base", "added")).alias("spans"))
