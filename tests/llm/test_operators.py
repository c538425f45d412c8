"""Each operator against a brute-force version, on small tables with nulls, blanks, repeats and clashing column names."""

import hashlib
import math
import re
import time
import tracemalloc
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from millrace.llm import ann, bpe, decontaminate, line_dedup, lm, mixing, near_dup, pack, pii, quality, token_count
from millrace.llm.queries import QUERIES, tokenizer_file

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, source string, bands string, key long, h long, id long"
NASTY = [None, "", " ", "\n\n", "a", "A b c d", "the quick brown fox jumps over the lazy dog and runs away", "x " * 3000, "word" * 4000, "é ü ß\t\x0b中文 ñ", "9" * 5000, "1.2.3.4 " * 50]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def small_docs(spark, more=()):
    texts = [*NASTY, *more]
    rows = [(i, t, None if i % 5 == 0 else f"s{i % 3}", "x", 1, 2, 3) for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[6], rows[6], rows[7]], DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# ---- line dedup


def test_line_dedup(spark):
    rows = documents(spark).select("doc_id", "text", "source").collect()
    sites = defaultdict(set)
    for r in rows:
        for line in (r.text or "").split("\n"):
            if line.strip(" "):
                sites[line.strip(" ")].add(r.source)
    bad = {k for k, v in sites.items() if len(v) >= 3}
    assert bad
    got = {r.doc_id: r for r in line_dedup.remove_lines(documents(spark), min_sites=3).collect()}
    for r in rows:
        lines = (r.text or "").split("\n")
        kept = [x for x in lines if x.strip(" ") not in bad]
        assert got[r.doc_id].text == "\n".join(kept)
        assert got[r.doc_id].n_removed == len(lines) - len(kept)


def test_line_dedup_edges(spark):
    out = line_dedup.remove_lines(small_docs(spark), min_sites=2).collect()
    assert len(out) == len(NASTY) + 3
    assert [r.text for r in out if r.doc_id == 0] == [None]
    assert line_dedup.digest(empty(spark)).count() == 0


# ---- quality


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op2_quality"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").toPandas()
    assert (got.predicted == got.quality).mean() > 0.97
    assert got[got.quality == 1].predicted.mean() > 0.98


def test_quality_edges(spark):
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 0), (6, 1), (None, 1)], "doc_id long, quality int")
    out = quality.digest(small_docs(spark), labels).collect()
    assert len(out) == len(NASTY) + 3
    assert all(0 <= r.score <= 1 for r in out)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    assert quality.digest(empty(spark), labels.limit(0)).count() == 0


def test_prior_estimate():
    rng = np.random.default_rng(0)
    positive, mixed = rng.normal(2, 1, 5000), np.concatenate((rng.normal(2, 1, 3500), rng.normal(-2, 1, 1500)))
    assert abs(quality.estimate_prior(positive, mixed) - 0.7) < 0.06


# ---- decontamination


def brute_hits(text, items):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    hit, names = set(), set()
    for name, body in items:
        ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(body))
        n = min(10, len(ws))
        if not n:
            continue
        windows = {tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)}
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                names.add(str(name))
    return len(words), len(hit), sorted(names)


def check_hits(docs, bench, shard_words=200_000):
    items = [(r.item_id, r.text) for r in bench.collect()]
    texts = {(r.doc_id, r.text) for r in docs.collect()}
    found = decontaminate.find_hits(docs.select("doc_id", "text"), bench, shard_words=shard_words).collect()
    for r in found:
        n, hits, names = brute_hits(r.text, items)
        s = r.hit_spans
        assert (r.hit_words, sum(b - a for a, b in zip(s[::2], s[1::2])), list(r.hit_items)) == (n, hits, names)
        assert (r.doc_id, r.text) in texts
    return found


def test_decontaminate_brute(spark):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    found = check_hits(documents(spark), bench)
    assert sum(bool(r.hit_spans) for r in found) > 2


def test_decontaminate_edges(spark):
    more = ["one two three four five six seven eight nine ten eleven", "a b c a b c a b c a b c a b c", "ONE, two; three four-five six seven eight nine TEN eleven", "x y"]
    bench = spark.createDataFrame([(1, more[0]), (2, "a b c"), (3, None), (4, ""), (5, "b c a b"), (6, "one two three four five six seven eight nine ten"), (1, "y")], "item_id long, text string")
    for shard in (200_000, 4):
        check_hits(small_docs(spark, more), bench, shard)
    digest = {r.doc_id: r for r in decontaminate.digest(small_docs(spark, more), bench).collect()}
    k = len(NASTY)
    assert digest[k].items_sha256 == hashlib.sha256(b"1,6").hexdigest() and digest[k].n_hit == 11
    assert digest[0].items_sha256 == hashlib.sha256(b"").hexdigest() and not digest[0].contaminated
    cleaned = []
    for shard in (200_000, 4):
        clean = decontaminate.remove_spans(small_docs(spark, more), bench, max_coverage=1.0, shard_words=shard)
        assert clean.columns == small_docs(spark).columns
        assert not [r for r in decontaminate.find_hits(clean, bench).collect() if r.hit_spans]
        cleaned.append(clean)
    assert sorted(map(str, cleaned[0].select("doc_id").collect())) == sorted(map(str, cleaned[1].select("doc_id").collect()))
    assert decontaminate.digest(empty(spark), bench).count() == 0
    assert decontaminate.digest(small_docs(spark), bench.limit(0)).filter("contaminated").count() == 0


# ---- near-dedup


def sets_of(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))) if w else frozenset()


def brute_components(rows):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    sets = [(i, sets_of(t)) for i, t in rows if i is not None]
    by_size = sorted((s for s in sets if s[1]), key=lambda s: len(s[1]))
    for k, (i, s) in enumerate(by_size):
        for j, t in by_size[k:]:
            if 75 * len(t) > 100 * len(s):
                break
            n = len(s & t)
            if 100 * n >= 75 * (len(s) + len(t) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i, _ in sets}


def check_near(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute_components(rows)
    got = near_dup.digest(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.component_id == (None if r.doc_id is None else want[r.doc_id]), r
        assert r.kept == (r.component_id == r.doc_id)
    assert Counter((r.doc_id, r.n_shingles) for r in got) == Counter((i, len(sets_of(t))) for i, t in rows)


def test_near_dup_brute(spark):
    check_near(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_near_dup_edges(spark):
    rng = np.random.default_rng(3)
    base = [f"w{x}" for x in rng.integers(0, 500, 120)]
    chain = [" ".join(base[k : k + 60]) for k in range(0, 60, 4)]  # neighbours link, ends don't
    near = []
    for _ in range(40):
        w = list(base)
        for at in rng.integers(0, len(w), rng.integers(0, 8)):
            w[at] = f"v{rng.integers(0, 9999)}"
        near.append(" ".join(w))
    check_near(small_docs(spark, [*chain, *near, "a", "A B  c\td"]))
    assert near_dup.digest(empty(spark)).count() == 0
    kept = near_dup.dedup(small_docs(spark, near))
    assert kept.columns == small_docs(spark).columns


def test_bit_estimate(spark):
    rng = np.random.default_rng(5)
    a = rng.integers(0, 2**64, 4000, dtype=np.uint64)
    rows = []
    for share in (0.3, 0.6, 0.9):
        n = int(4000 * share)
        b = np.concatenate((a[:n], rng.integers(0, 2**64, 4000 - n, dtype=np.uint64)))
        rows.append((n / (8000 - n), near_dup.signature(a)[1].tolist(), near_dup.signature(b)[1].tolist()))
    df = spark.createDataFrame(rows, "j double, a array<long>, b array<long>")
    for r in df.select("j", near_dup.estimate(F.col("a"), F.col("b")).alias("e")).collect():
        assert abs(r.j - r.e) < 0.12


# ---- token counts and packing


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file())


SIGNS = ["", " ", "  x", "a  b   c \n\n d", "don't we'll I'M", "<|endoftext|>", "a<|endoftext|> b<|endoftext|>", "\x1c\x1f\x85\xa0 z", "aaaa" * 500, "x\n y\n  z \t", "ñ 中文😀 ١٢٣ ½", "foo \nbar", "a\n \nb ", "(a) [b] {c}!!! --- "]


def test_tokens_equal_the_library(spark):
    lib = library()
    texts = [*SIGNS, *(t for t in NASTY if t), *(r.text for r in documents(spark).collect() if r.text)]
    ids, sizes = bpe.RankMerger(tokenizer_file()).encode(texts)
    want = [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]
    assert sizes.tolist() == [len(w) for w in want]
    assert ids.tolist() == [x for w in want for x in w]
    got = token_count.digest(small_docs(spark, SIGNS), tokenizer_file()).collect()
    texts = [*NASTY, *SIGNS]
    for r in got:
        t = texts[r.doc_id] or ""
        assert (r.n_bytes, r.n_tokens) == (len(t.encode()), len(lib.encode(t, add_special_tokens=False).ids))
    assert len(got) == len(texts) + 3
    assert token_count.digest(empty(spark), tokenizer_file()).count() == 0


def test_store_starts_anew(monkeypatch):
    monkeypatch.setattr(bpe, "STORE", 3)
    m, lib = bpe.RankMerger(tokenizer_file()), library()
    for t in ["one two three four five", "six seven", "one eight nine ten"]:
        assert m.encode([t])[0].tolist() == lib.encode(t, add_special_tokens=False).ids


def test_pack_round_trip(spark):
    lib = library()
    docs = documents(spark).limit(60).unionByName(small_docs(spark, SIGNS), allowMissingColumns=True)
    rows = pack.pack(docs, tokenizer_file(), length=128, group_tokens=20_000).cache()
    for r in rows.collect():
        assert len(r.ids) == 2 * r.n_tokens <= 256
        assert r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens and list(r.position_resets) == list(r.cu_seqlens[:-1])
    got = Counter((r.doc_id, tuple(r.ids)) for r in pack.unpack(rows).collect())
    want = Counter((r.doc_id, (*lib.encode(r.text or "", add_special_tokens=False).ids, 50_256)) for r in docs.collect())
    assert got == want
    assert pack.pack(empty(spark), tokenizer_file()).count() == 0


def test_best_fit():
    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 101, 500)
    bins = pack.best_fit(sizes, 100)
    assert sorted(i for b in bins for i in b) == list(range(500))
    assert all(sizes[b].sum() <= 100 for b in bins)
    plain: list[int] = []
    for s in sorted(sizes.tolist(), reverse=True):
        fits = [i for i, left in enumerate(plain) if left >= s]
        if fits:
            plain[min(fits, key=lambda i: plain[i])] -= s
        else:
            plain.append(100 - s)
    assert len(plain) == len(bins)


# ---- nearest neighbours


def brute_nearest(rows, k=20):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float))]
    for q, x in good:
        if q % 20 == 0:
            yield q, sorted(((-float(sum(a * b for a, b in zip(x.tolist(), y.tolist()))), i) for i, y in good if i != q))[:k]


def test_ann_recall(spark):
    v = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    ids, x = zip(*[(r.vec_id, r.embedding) for r in v.collect()])
    x = np.array(x, np.float64)
    found = defaultdict(set)
    for r in ann.nearest(v, F.pmod("vec_id", F.lit(20)) == 0, list_rows=40, least_lists=12).collect():
        found[r.query_id].add(r.vec_id)
    hits = total = 0
    for i, q in enumerate(ids):
        if q % 20 == 0:
            s = x @ x[i]
            s[i] = -9
            best = {ids[j] for j in np.argsort(-s)[:20]}
            hits, total = hits + len(best & found[q]), total + 20
    assert hits / total >= 0.9


def test_ann_visits_all_lists_within_the_ratio():
    rng = np.random.default_rng(3)
    centroids, x = rng.normal(size=(300, 64)), rng.normal(size=(50, 64))
    run = ann._lists(SimpleNamespace(value=("test", np.column_stack((centroids, np.zeros(300))))), 1.0, 1.2, 16, None, True)
    rows = pa.RecordBatch.from_arrays([pa.array(range(50)), pa.array(x.tolist())], names=["id", "vec"])
    got = defaultdict(set)
    for batch in run(iter([rows])):
        for at, i in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            got[i].add(at)
    dist = np.linalg.norm(x[:, None] - centroids[None], axis=2)
    assert max(len(g) for g in got.values()) > 64
    for i, d in enumerate(dist):
        assert set(np.flatnonzero(d <= 1.2 * d.min())) | set(np.argsort(d)[:16]) == got[i]


def test_ann_edges(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=4).tolist() if i % 3 else [1.0, 2.0, 0.5, 0.0]) for i in range(90)]
    rows += [(100, None), (120, [0.0] * 4), (140, [1.0, None, 0.0, 0.0]), (160, [float("nan"), 1.0, 0.0, 0.0]), (180, [float("inf"), 1.0, 0.0, 0.0]), (None, [1.0] * 4), rows[5]]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, list int, block string")
    got = defaultdict(list)
    for r in ann.digest(df).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score, r["rank"]))
    want = dict(brute_nearest(list(dict.fromkeys((i, tuple(v) if v else v) for i, v in rows))))
    assert set(got) == set(want)
    for q, best in want.items():
        assert [(i, n + 1) for n, (_, i) in enumerate(best)] == [(i, n) for i, _, n in got[q]]
        assert all(s == pytest.approx(-t) for (_, s, _), (t, _) in zip(got[q], best))
    assert ann.digest(df.limit(0)).count() == 0


# ---- personal data


def luhn(d):
    t = 0
    for i, c in enumerate(reversed(d)):
        n = int(c) * (1 + i % 2)
        t += n - 9 * (n > 9)
    return t % 10 == 0


def brute_base(text):
    text = text or ""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p[:400]) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 13 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


PRIVATE = ["mail a.b@c.de, x@y", "a@b.c.d%x@y.zz a@@b.c q@-.-", "ip 1.2.3.4.5.6.7.8 999.1.1.1 0001.02.3.255 1.2.3.256", "4111 1111 1111 1111 and 4111-1111-1111-1112 4111  1111", "+1 (974) 555-3436. +12 +1234567 +1 2 3 4 5 6 7 8 9) +(1)", "ñ@b.cc é+49 30 1234567-8 😀 5.6.7.8", "contact: joe [at] mail [dot] com or tel: (030) 123-4567 99", "@" * 300 + "." * 300, "a." * 3000 + "@x.yy", "1 " * 4000, "+" + "1-" * 3000, "1." * 3000 + "7"]


def test_pii_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").unionByName(small_docs(spark, PRIVATE).select((F.col("doc_id") + 1_000_000).alias("doc_id"), "text"))
    texts = dict(docs.collect())
    n = 0
    for r in pii.digest(docs).collect():
        want = brute_base(texts[r.doc_id])
        n += len(want)
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest(), (r.doc_id, line, r.spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x[0] == k for x in want) for k in pii.KINDS]
        spans = r.spans.split(",") if r.spans else []
        assert set(line.split(",") if line else []) <= set(spans)
    assert n > 50


def test_pii_added_and_mask(spark):
    texts = [f"Contact: anna{i} [at] mail [dot] com now, or tel: (030) 123-45{i:02d} today" for i in range(30)] + ["look at the dot com boom", "from 10 to 12 at 14.30"] * 10
    docs = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, base string")
    got = pii.mask(docs.drop("base").withColumn("extra", F.lit(1))).collect()
    assert all("<email>" in r.text and "<phone>" in r.text for r in got if r.doc_id < 30)
    assert all("<" not in r.text for r in got if r.doc_id >= 30)
    assert pii.digest(empty(spark)).count() == 0


def test_pii_loose_addresses_need_no_brackets(spark):
    texts = ["write anna at mail.com now", "anna [AT] mail (DOT) com", "anna AT mail dot com", "anna (at) mail.com", "nothing here"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: [x.t for x in r.spans] for r in docs.select("doc_id", pii._loose_spans(F.col("text")).alias("spans")).collect()}
    assert [len(got[i]) for i in range(5)] == [1, 1, 1, 1, 0]
    assert "anna at mail.com" in got[0][0]


def test_pii_dense_text_in_linear_time(spark):
    """A megabyte of matches in one row."""
    texts = ["12 x " * 200_000, "a@b.cc, " * 130_000, "(030) 123-45678, " * 60_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    pii.digest(docs.filter("doc_id > 5")).collect()
    began = time.time()
    got = {r.doc_id: r for r in pii.digest(docs).collect()}
    assert time.time() - began < 60
    assert got[1].n_email == 130_000 and got[0].spans == ""
    assert len(pii.mask(docs.filter("doc_id = 1")).first().text) == 9 * 130_000


def test_pii_running(spark):
    rng = np.random.default_rng(2)
    rows = [([int(x) for x in rng.integers(0, 50, n)],) for n in (0, 1, 2, 7, 100, 1000)]
    df = spark.createDataFrame(rows, "v array<int>")
    for r in df.select("v", pii.running(F.col("v"), lambda a, b: a + b).alias("sums"), pii.running(F.col("v"), F.greatest).alias("most")).collect():
        assert r.sums == np.cumsum(r.v).tolist() and r.most == np.maximum.accumulate(r.v).tolist() if r.v else r.sums == r.most == []


def test_pii_reliabilities_are_recovered():
    """Votes drawn from known reliabilities: the estimate finds them, and the classifier follows the posterior."""
    rng = np.random.default_rng(4)
    truth = rng.random(40_000) < 0.4
    tables = [{"1": (0.9, 0.1), "0": (0.05, 0.8), "-": (0.05, 0.1)}, {"1": (0.7, 0.05), "0": (0.1, 0.55), "-": (0.2, 0.4)}, {"1": (0.6, 0.1), "0": (0.0, 0.0), "-": (0.4, 0.9)}, {"1": (0.8, 0.3), "0": (0.2, 0.7), "-": (0.0, 0.0)}]
    signs = [np.where(truth, rng.choice(list(t), len(truth), p=[v[0] for v in t.values()]), rng.choice(list(t), len(truth), p=[v[1] for v in t.values()])) for t in tables]
    patterns = ["".join(v) + "m" for v in zip(*signs)]
    counts = Counter(patterns)
    prior, got = pii.expectation_maximisation(counts)
    assert abs(prior - 0.4) < 0.03
    for want, have in zip(tables, got):
        assert all(abs(want[v][k] - have[v][k]) < 0.05 for v in want for k in (0, 1))
    soft = {p: pii.posterior(p, prior, got) for p in counts}
    weights = pii.train(counts, soft)
    chance = {p: 1 / (1 + math.exp(-sum(weights.get(k, 0.0) for k in ["bias", *(f"{i}{v}" for i, v in enumerate(p))]))) for p in counts}
    assert all(abs(chance[p] - soft[p]) < 0.12 for p, n in counts.items() if n > 100)


def test_pii_clashing_names(spark):
    docs = spark.createDataFrame([("x", "mail a@b.cc and 1.2.3.4", 1, 2, 3)], "row string, text string, base int, found int, candidates int")
    assert pii.mask(docs).first() == ("x", "mail <email> and <ip>", 1, 2, 3)


# ---- mixing


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    free, target, left = set(names), {}, 1.5 * sum(sizes.values())
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > 2 * sizes[s]}
        if not over:
            return target | {s: left * weight[s] / total for s in free}
        for s in over:
            target[s] = 2.0 * sizes[s]
        left -= sum(target[s] for s in over)
        free -= over
    return target


def check_mix(docs):
    rows = docs.collect()
    sizes = Counter()
    for r in rows:
        sizes[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    want, taken = brute_targets(sizes), Counter()
    got = mixing.digest(docs.select("doc_id", "source", "text")).collect()
    assert len(got) == len(rows)
    source = {r.doc_id: r.source for r in rows}
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s]) and 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.5 + 1e-6
    assert sorted(got) == sorted(mixing.digest(docs.select("doc_id", "source", "text")).collect())


def test_mix(spark):
    check_mix(documents(spark))
    check_mix(small_docs(spark))
    assert mixing.digest(empty(spark)).count() == 0
    out = mixing.mix(small_docs(spark))
    assert out.columns == small_docs(spark).columns
    # Equal rows, equal ids with other texts, a null source: the mix has each source's budget to the word, in prefixes of its texts.
    docs = spark.createDataFrame([(1, "a b c", "x"), (1, "a b c", "x"), (1, " d\n e f", "x"), (None, "g h", None), (2, "", "x"), (3, None, "y"), (4, "i  j k l m ", "y")], "doc_id long, text string, source string")
    out, digest = mixing.mix(docs).collect(), mixing.digest(docs).collect()
    assert sum(len(r.text.split()) for r in out) == sum(r.taken for r in digest)
    assert {s: sum(len(r.text.split()) for r in out if r.source == s) for s in ("x", "y", None)} == {s: round(t) for s, t in brute_targets({"x": 9, "y": 5, None: 2}).items()}
    assert all(any((d.text or "").startswith(r.text) for d in docs.collect() if d.source == r.source) for r in out)


def test_mix_many_buckets(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 4)).alias("source"), (F.col("id") % 17).alias("size"))
    a = {r.doc_id: (r.epochs, r.cut) for r in mixing.plan(docs, bucket_rows=50).collect()}
    b = {r.doc_id: (r.epochs, r.cut) for r in mixing.plan(docs).collect()}
    assert a == b


# ---- LM scoring


def brute_lm(rows, train, depth=3, probability=False):
    """Scores by plain dictionaries: (n_tokens, n_known, base, score) per row."""
    tokens = [[*re.findall(r"[^\x20\x09-\x0D]+", lower(t)), None] for t in rows]
    count = Counter(w for ts, is_in in zip(tokens, train) if is_in for w in ts)
    n, v = sum(count.values()), len(count)
    base = lambda w: (count[w] + 1) / (n + v + 1)
    grams = [defaultdict(Counter) for _ in range(depth + 1)]
    for ts, is_in in zip(tokens, train):
        for i in range(len(ts) if is_in else 0):
            for k in range(1, min(i, depth) + 1):
                grams[k][tuple(ts[i - k : i])][ts[i]] += 1
    kept = {}

    def p(ctx, w):
        if not ctx:
            return base(w)
        shorter = p(ctx[1:], w)
        if ctx not in kept:
            return shorter
        size, rest = kept[ctx]
        c = grams[len(ctx)][ctx][w]
        return (c - 0.5) / size * (c >= 2) + rest * shorter

    for k in range(1, depth + 1):
        new = {}
        for ctx, after in grams[k].items():
            size = sum(after.values())
            often = {w: c for w, c in after.items() if c >= 2}
            shorter = {w: p(ctx[1:], w) for w in often}
            left = size - sum(often.values())
            gain = sum(c * math.log(c / size / shorter[w]) for w, c in often.items())
            gain += left * (math.log(max(left / size, 1e-12)) - math.log(max(1 - sum(shorter.values()), 1e-12)))
            if often and gain > 2 * len(often):
                new[ctx] = (size, 1 - sum(c - 0.5 for c in often.values()) / size)
        kept |= new
    if probability:
        return p
    out = []
    for ts in tokens:
        whole = [p(tuple(ts[max(0, i - depth) : i]), w) for i, w in enumerate(ts)]
        out.append((len(ts), sum(count[w] > 0 for w in ts), sum(math.log10(base(w)) for w in ts), sum(map(math.log10, whole))))
    return out, n


def lm_train(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2


def check_lm(got, rows):
    want, n = brute_lm([t for _, t in rows], [lm_train(i) for i, _ in rows])
    want = {(i, t): w for (i, t), w in zip(rows, want)}
    by_id = {i: want[(i, t)] for i, t in rows}
    assert len(got) == len(rows)
    for r in got:
        size, known, base, score = by_id[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (not lm_train(r.doc_id), size, known, n)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, abs=1e-6)


@pytest.mark.parametrize("knobs", [{}, {"HEAD": 60}, {"LIMIT": 50, "BUCKET": 2000, "STEP": 9000}, {"HEAD": 200, "LIMIT": 15, "BUCKET": 500, "STEP": 3000, "SLOTS": 3}])
def test_lm_brute(spark, monkeypatch, knobs):
    """All words in the head or few; no hot contexts, or hot ones of up to three words; one bucket or many."""
    for k, v in knobs.items():
        monkeypatch.setattr(lm, k, v)
    phrase = "the same five words again "
    docs = documents(spark).select("doc_id", "text").limit(80).unionByName(spark.range(5000, 5040).selectExpr("id as doc_id", f"repeat('{phrase}', cast(id % 5 as int)) as text"))
    check_lm(lm.digest(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()])


def test_lm_held_out_gain(spark):
    got = [r for r in lm.digest(documents(spark)).collect() if r.held_out]
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_lm_keeps_what_a_larger_corpus_hides(spark):
    """What sequences add depends on their counts, not on the size of the rest."""
    rows = [(i, "alpha beta gamma delta " * 4) for i in range(4)] + [(9, "alpha beta gamma delta")]
    small = spark.createDataFrame(rows, "doc_id long, text string")
    filler = spark.range(100, 108).select(F.col("id").alias("doc_id"), F.expr("repeat('x y z w ', 100000)").alias("text"))
    for docs in (small, small.union(filler)):
        r = lm.score(docs, F.col("doc_id") != 9).filter("doc_id = 9").first()
        assert r.score > r.base_score + 2


def test_lm_sums_to_one():
    """In the brute-force version that the operator equals: over all words, the end and one unseen word, after every context."""
    texts = ["a b c a b d", "a b c", "b c a", "c c a b"] * 6
    p = brute_lm(texts, [True] * len(texts), probability=True)
    for context in ("a", "a b", "c", "b c", "zz", "b c a"):
        assert sum(p(tuple(context.split()), w) for w in ["a", "b", "c", "d", "zz", None]) == pytest.approx(1.0, abs=1e-9)


def test_lm_edges(spark):
    docs = small_docs(spark).unionByName(spark.createDataFrame([(None, "a b", None, "", 1, 1, 1)], DOCS))
    check_lm(lm.digest(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()])
    assert lm.digest(empty(spark)).count() == 0
    named = docs.select(F.col("doc_id").cast("string").alias("row"), F.col("text").alias("step"))
    assert dict(lm.score(named, F.lit(True), "row", "step").dtypes)["doc_id"] == "string"
    none = lm.score(docs, F.lit(False)).collect()
    assert all(r.base_score == r.score == 0 and r.train_tokens == 0 for r in none)


def lm_bucket(n, words=3000):
    """A bucket whose windows mostly follow one word, and a model whose counts are the bucket's."""
    rng = np.random.default_rng(5)
    word, *before = [np.minimum((rng.pareto(0.9, n) * 2).astype(np.int32) + 1, words) for _ in range(4)]
    before[0] = np.where(np.arange(n) % 5 < 4, np.int32(1), before[0])
    train = rng.random(n) < 0.85
    count = np.bincount(word, train, words + 1).astype(np.int64)
    head = lm.Head(np.arange(1, words + 1), np.arange(1, words + 1, dtype=np.int32), count, count)
    none = np.broadcast_to(np.int64(0), n)
    w = lm.Windows(np.zeros(n, np.int32), train, word, before, [none] * 3, none, count[word].astype(np.int32))
    return w, lm.Model(head, 30 * n, words, 3, 1 << 40, 1, [])


def test_lm_bucket_in_parts(monkeypatch):
    """A context's windows are counted whole whatever the parts, and memory beside the windows is bounded."""
    w, model = lm_bucket(30_000)
    want = lm.subtree(w, model)
    assert np.abs(want).max() > 0.5
    for chunk in (1, 700, 20_000):
        monkeypatch.setattr(lm, "CHUNK", chunk, raising=False)
        np.testing.assert_allclose(lm.subtree(w, model), want, atol=1e-12)
    w, model = lm_bucket(600_000)
    monkeypatch.setattr(lm, "CHUNK", 50_000)
    tracemalloc.start()
    lm.subtree(w, model)
    peak = tracemalloc.get_traced_memory()[1] / 600_000
    tracemalloc.stop()
    assert peak < 70, f"{peak:.0f} bytes a window"


def lm_steps(texts, monkeypatch, parts=1):
    """Steps of as many partitions, each of all texts, and a model that knows all their words; without Spark."""
    texts, train = pa.array(texts), pa.array([i % 7 != 2 for i in range(len(texts))])
    counted = pa.Table.from_batches(lm._count_words(iter([pa.RecordBatch.from_arrays([texts, train], names=["text", "train"])]))).group_by("w").aggregate([("t", "sum"), ("a", "sum")])
    w, t, a = (np.asarray(counted.column(c).combine_chunks()) * (1 if c == "w" else parts) for c in ("w", "t_sum", "a_sum"))
    order = np.lexsort((w, -a))
    w, t, a = w[order], t[order], a[order]
    by_hash, zero = np.argsort(w), np.zeros(1, np.int64)
    head = lm.Head(w[by_hash], (by_hash + 1).astype(np.int32), np.concatenate((zero, t)), np.concatenate((zero, a)))
    steps = []
    for k in range(parts):
        monkeypatch.setattr(lm, "TaskContext", SimpleNamespace(get=lambda k=k: SimpleNamespace(partitionId=lambda: k)))
        batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), texts, train], names=["id", "text", "train"])
        for step in lm._write_steps(SimpleNamespace(value=(head, True)), "step id size train codes other other_t other_a".split())(iter([batch])):
            for level in (1, 2, 3):
                step = step.append_column(f"told{level}", pa.nulls(1))
            steps.append(step)
    return steps, lm.Model(head, int(t.sum()), int((t > 0).sum()), 3, 1 << 40, 1, [])


def lm_sent(steps, model):
    return [row for batch in lm._send(SimpleNamespace(value=model))(iter(steps)) for row in batch.to_pylist()]


def test_lm_many_buckets(spark, monkeypatch):
    """On a larger table a step's windows go to more buckets, a few to each: neither bytes nor time may grow much with it."""
    texts = [r.text for r in documents(spark).select("text").collect()]
    steps, model = lm_steps(texts, monkeypatch)
    (before,) = (lm.Step(model, s.to_pylist()[0]).windows.before[0] for s in steps)
    windows, cost = np.count_nonzero(before), {}
    for buckets in (8, 900):
        sent = []
        began = time.process_time()
        for _ in range(3):
            sent = lm_sent(steps, model._replace(buckets=buckets))
        cost[buckets] = sum(len(r["blob"]) for r in sent), time.process_time() - began
        opened, _, sizes = lm._opened([(r["step"], r["blob"]) for r in sent], model)
        assert len(sent) > buckets * 0.7 and sizes.sum() == len(opened.word) == windows
    assert cost[900][0] < 1.7 * cost[8][0], cost
    assert cost[900][1] < 2.5 * cost[8][1], cost


def test_lm_sums_spread(monkeypatch):
    """Sums of the steps of all partitions are added in many groups, not in as many as a partition has steps."""
    steps, model = lm_steps(["a b c a b d", "a b c", "b c a", "c c a b"] * 6, monkeypatch, parts=60)
    blobs = pa.RecordBatch.from_pylist(lm_sent(steps, model))
    summed = [r for b in lm._score_buckets(SimpleNamespace(value=model))(iter([blobs])) for r in b.to_pylist()]
    assert len({r["bucket"] for r in summed}) >= 6
    monkeypatch.setattr(lm, "SUMS", 50, raising=False)
    rows = {}
    for group in sorted({r["bucket"] for r in summed}):
        own = pa.RecordBatch.from_pylist([r for r in summed if r["bucket"] == group])
        for b in lm._sum_rows(iter([own, own])):
            rows |= {r["row"]: r["gain"] for r in b.to_pylist()}
    assert {r >> 41 for r in rows} == set(range(60))
    gains = [{r & (1 << 21) - 1: g for r, g in rows.items() if r >> 41 == k} for k in range(60)]
    assert gains[0] and all(g == gains[0] for g in gains)


def test_lm_other_words_without_long_contexts(spark, monkeypatch):
    monkeypatch.setattr(lm, "HEAD", 1)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["p q", "p r", "p q", None, "", "r"] * 5)], "doc_id long, text string")
    check_lm(lm.digest(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()])


def test_clashing_names(spark):
    """Columns of the operators' own names stay, or are replaced where they are the result's."""
    names = "n_lines n_removed _id _bad bad salt score row hit_words hit_items hit_spans base loose found key own gone kept node component_id id n_shingles size target epochs mix_key".split()
    docs = small_docs(spark, ["a b c d e f g h i j k", "a b c d e f g h i j k"] * 3).select("doc_id", "text", "source", *[F.lit(i).alias(n) for i, n in enumerate(names)])
    bench = spark.createDataFrame([(1, "a b c"), (2, "d e f g h i j k l m n")], "item_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 0)], "doc_id long, quality int")
    lines = line_dedup.remove_lines(docs, min_sites=2)
    assert lines.columns == docs.columns and lines.filter("n_lines > 0").count() and {r.score for r in lines.collect()} == {names.index("score")}
    assert quality.keep_good(docs, labels).columns == docs.columns
    assert quality.score(docs, quality.fit(docs, labels)).columns == docs.columns
    one, many = (decontaminate.remove_spans(docs, bench, max_coverage=0.9, shard_words=n) for n in (200_000, 3))
    assert one.columns == docs.columns and Counter(map(str, one.collect())) == Counter(map(str, many.collect()))
    hits = [decontaminate.find_hits(docs, bench, shard_words=n) for n in (200_000, 3)]
    assert hits[0].columns == docs.columns and Counter(map(str, hits[0].collect())) == Counter(map(str, hits[1].collect()))
    kept = near_dup.dedup(docs)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    assert pii.mask(docs).columns == mixing.mix(docs).columns == docs.columns


def test_text_ids(spark):
    docs = documents(spark).select(F.concat(F.lit("d"), F.lpad(F.col("doc_id").cast("string"), 6, "0")).alias("doc_id"), "text")
    got = near_dup.digest(docs).collect()
    want = {r.doc_id: r.component_id for r in near_dup.digest(documents(spark)).collect()}
    assert {r.doc_id: r.component_id for r in got} == {f"d{i:06d}": f"d{c:06d}" for i, c in want.items()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").select(F.concat(F.lit("d"), F.lpad(F.col("doc_id").cast("string"), 6, "0")).alias("doc_id"), "quality")
    assert quality.digest(docs, labels).count() == len(got)


def test_near_dup_hot_copies(spark):
    """A third of all rows is one text, another third one family of near copies."""
    rng = np.random.default_rng(8)
    base = [f"w{x}" for x in rng.integers(0, 300, 80)]
    texts = ["one text that very many rows have in common"] * 300
    for _ in range(300):
        w = list(base)
        w[int(rng.integers(0, 80))] = f"v{rng.integers(0, 9999)}"
        texts.append(" ".join(w))
    texts += [" ".join(f"u{x}" for x in rng.integers(0, 5000, 30)) for _ in range(300)]
    check_near(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_pipeline_empty(spark, tmp_path):
    """No document at all, and only null and empty ones."""
    import corpus_pipeline as p

    few = documents(spark).filter("doc_id < 0").unionByName(documents(spark).limit(2).withColumn("text", F.when(F.col("doc_id") % 2 == 0, F.lit(""))))
    for docs in (documents(spark).limit(0), few):
        for name, stage in p.STAGES:
            docs = stage(spark, docs, SF)
            assert docs.count() >= 0


def test_pipeline_brute(spark):
    """Every stage against plain code on its own input, but for the classifier, whose decisions are taken as given."""
    import corpus_pipeline as p

    lib, docs, seen = library(), documents(spark), {}
    for name, stage in p.STAGES:
        out = stage(spark, docs, SF).cache()
        seen[name] = (docs.collect(), out.collect())
        assert name == "pack" or out.columns == docs.columns
        docs = out
    given, kept = seen["quality"]
    assert {r.doc_id for r in kept} <= {r.doc_id for r in given} and len(kept) > len(given) / 2
    given, kept = seen["near_dup"]
    want = brute_components([(r.doc_id, r.text) for r in given])
    assert sorted(r.doc_id for r in kept) == sorted({r.doc_id for r in given if want[r.doc_id] == r.doc_id})
    given, kept = seen["decontaminate"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before = {r.doc_id: (brute_hits(r.text, items), r) for r in given}
    assert {r.doc_id for r in kept} == {i for i, (h, _) in before.items() if h[1] <= 0.5 * h[0]}
    for r in kept:
        assert brute_hits(r.text, items)[1] == 0 and r.n_chars == len(r.text)
        assert before[r.doc_id][0][1] or r == before[r.doc_id][1]
    given, kept = seen["mix"]
    parts = [r for r in kept if r not in set(given)]
    assert max(Counter(r.doc_id for r in kept).values()) <= 2 and len(parts) == len({r.source for r in parts})
    texts = {r.doc_id: r.text for r in given}
    assert all(texts[r.doc_id].startswith(r.text) and r.n_chars == len(r.text) for r in parts)
    given, _ = seen["pack"]
    got = Counter((r.doc_id, tuple(r.ids)) for r in pack.unpack(docs).collect())
    assert got == Counter((r.doc_id, (*lib.encode(r.text, add_special_tokens=False).ids, 50_256)) for r in given)


def test_fixture_is_there():
    assert pq.read_metadata(f"{SF}/documents.parquet").num_rows == 200
