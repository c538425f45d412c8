"""MinHash near-dedup with b-bit signatures.

1. One pass over the texts gives every document its set of word shingles, reduced to the set's size and 128-bit hash, the band
   hashes of its MinHash minima, and the low BITS bits of every minimum packed in longs.
2. Documents of equal sets are one node, named by their smallest doc_id.
3. In every band bucket each node is paired with the bucket's smallest node; a bucket of n nodes gives n - 1 pairs. The packed
   signatures estimate the pair's similarity by counting equal fields, corrected for the chance 2^-BITS that different minima
   agree; pairs further than SLACK standard errors below the threshold go.
4. The others are confirmed on the full sets. Links give components.
5. Buckets that still span several components are compared in blocks inside a task, which returns links that join components, not pairs.

So the only links that can be lost are pairs no band brings together: (1 - s^ROWS)^BANDS, 2e-5 at s = 0.75 and less above.

Words: ASCII-lower-cased runs of `[^\\x20\\x09-\\x0D]`. A text with fewer than `width` words is one shingle; one without words, or
null, has an empty set and is linked with nothing. Rows that share a doc_id count as one document. Rows whose id is null are
linked with nothing and kept. Equal rows are each answered. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import byte_texts, carried, give_back, materialize
from millrace.llm.components import components

BANDS, ROWS, BITS, SLACK = 40, 5, 4, 5.0
HASHES = BANDS * ROWS
#: Shingles of a block; bits of the bitmap that thins out texts, at most.
BLOCK, BITMAP = 1 << 16, 1 << 27
#: Groups that copies of one text are dealt to before they meet.
SALT = 64
#: Words whose hashes a worker remembers; beyond it, it starts anew.
CACHE = 500_000
_rng = np.random.default_rng(20_240_501)
_MUL = (_rng.integers(0, 2**32, HASHES, dtype=np.uint32) | np.uint32(1))[:, None]
_ADD = _rng.integers(0, 2**32, HASHES, dtype=np.uint32)[:, None]
_BAND_MUL = _rng.integers(0, 2**64, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)
_PRIMES = _rng.integers(0, 2**64, 64, dtype=np.uint64) | np.uint64(1)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(raw: bytes | None, words: dict, width: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    found = (raw or b"").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    w = np.array([words[x] for x in found], np.uint64)
    n = max(len(w) - width + 1, 1)
    total = np.full(n, min(len(w), width), np.uint64)
    for i in range(min(width, len(w))):
        total = _mix(total + w[i : i + n] * _PRIMES[i % 64])
    return np.unique(total)


def signature(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Band hashes and packed low bits of a non-empty set."""
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, 2**32 - 1, np.uint32)
    for i in range(0, len(x), 2048):
        part = x[None, i : i + 2048] * _MUL
        part += _ADD
        np.minimum(least, part.min(axis=1), out=least)
    bands = _mix((least.reshape(BANDS, ROWS).astype(np.uint64) * _BAND_MUL).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))
    fields = np.zeros(-(-HASHES // 16) * 16, np.uint64)
    fields[:HASHES] = least & np.uint32((1 << BITS) - 1)
    packed = (fields.reshape(-1, 16) << (np.arange(16, dtype=np.uint64) * np.uint64(BITS))).sum(axis=1, dtype=np.uint64)
    return bands.view(np.int64), packed.view(np.int64)


def _small(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in _small(batches):
            sizes, keys, bands, packed = [], [], [], []
            for raw in byte_texts(batch.column(1)):
                s = shingles(raw, words, width)
                sizes.append(len(s))
                if len(s):
                    keys.append(xxhash.xxh3_128_digest(s.tobytes()))
                    b, p = signature(s)
                    bands.append(b)
                    packed.append(p)
                else:
                    keys.append(None)
                    bands.append(None)
                    packed.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(packed, pa.list_(pa.int64()))], names=["id", "n_shingles", "key", "bands", "packed"])
        words.clear()
        give_back()

    return run


def estimate(a: Column, b: Column) -> Column:
    """Similarity from two packed signatures, corrected for chance agreement."""
    ones = int("1" * 16, 16)

    def differ(x: Column, y: Column) -> Column:
        z = x.bitwiseXOR(y)
        z = z.bitwiseOR(F.shiftrightunsigned(z, 2))
        z = z.bitwiseOR(F.shiftrightunsigned(z, 1))
        return F.bit_count(z.bitwiseAND(F.lit(ones)))

    different = F.aggregate(F.zip_with(a, b, differ), F.lit(0), lambda t, x: t + x)
    chance = 2.0**-BITS
    return ((1 - different / HASHES) - chance) / (1 - chance)


def _hashes(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in _small(batches):
            got = [shingles(raw, words, width).tobytes() for raw in byte_texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.binary())], names=["id", "hashes"])
        words.clear()
        give_back()

    return run


def _full_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(id, hashes) of the wanted ids' texts.

    A bitmap of the wanted ids' hashes, of BITMAP bits at most, first thins out the texts; then a join keeps exactly the wanted.
    """
    spark = docs.sparkSession
    n = max(1 << 12, min(BITMAP, 1 << (32 * max(wanted.count(), 1)).bit_length()))
    at = F.pmod(F.xxhash64("id"), F.lit(n))
    words = wanted.select(at.alias("h")).groupBy(F.shiftright("h", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(h & 63 as int))")).alias("bits")).toArrow()
    bits = np.zeros(n // 64, np.int64)
    bits[np.asarray(words.column("word"))] = np.asarray(words.column("bits"))
    held = spark.createDataFrame(pa.table({"bits": pa.array([bits], pa.list_(pa.int64()))}))
    word = F.get(held.scalar(), F.shiftright(at, 6).cast("int"))
    some = docs.filter(F.getbit(word, (at % 64).cast("int")) == 1)
    return materialize(some.join(wanted, "id", "left_semi").distinct().mapInArrow(_hashes(width), f"id {_kind(docs)}, hashes binary"), "full-sets")


def _confirmer(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            linked = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                s, t = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(s, t, assume_unique=True))
                linked.append(100 * both >= percent * (len(s) + len(t) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return run


def _stars(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b): the pairs that are linked."""
    sig = nodes.select("id", "packed")
    est = pairs.join(sig.withColumnsRenamed({"id": "x", "packed": "px"}), "x").join(sig.withColumnsRenamed({"id": "y", "packed": "py"}), "y")
    likely = materialize(est.filter(estimate(F.col("px"), F.col("py")) >= percent / 100 - _slack(percent)).select("x", "y").distinct(), "pairs")
    sets = _full_sets(docs, likely.select(F.col("x").alias("id")).unionByName(likely.select(F.col("y").alias("id"))).distinct(), width)
    full = likely.join(sets.select(F.col("id").alias("x"), F.col("hashes").alias("sx")), "x").join(sets.select(F.col("id").alias("y"), F.col("hashes").alias("sy")), "y")
    return materialize(full.select("x", "y", "sx", "sy").mapInArrow(_confirmer(percent), f"a {_kind(docs)}, b {_kind(docs)}").distinct(), "links")


def _slack(percent: int) -> float:
    p, chance = percent / 100, 2.0**-BITS
    agree = p + (1 - p) * chance
    return SLACK * (agree * (1 - agree) / HASHES) ** 0.5 / (1 - chance)


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 75) -> DataFrame:
    """(id, n_shingles, component_id, kept), one row per row of docs."""
    return _classes(docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")), width, percent)


def _classes(docs: DataFrame, width: int, percent: int) -> DataFrame:
    kind = _kind(docs)
    sets = materialize(docs.mapInArrow(_sets(width), f"id {kind}, n_shingles long, key binary, bands array<long>, packed array<long>"), "sets")
    named = sets.filter("key is not null and id is not null")
    # Copies of one text may be a large share of all rows: they meet in SALT groups first, and these then.
    named = named.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALT)))
    part = materialize(named.groupBy("key", "salt").agg(F.min("id").alias("least")), "copies")
    member = part.join(part.groupBy("key").agg(F.min("least").alias("node")), "key").select("key", "salt", "node")
    # Rows of one id with different sets: their links count for the id, so the id links the sets' nodes too.
    ids = materialize(named.select("key", "id", "salt").join(member, ["key", "salt"]).select("key", "id", "node").distinct(), "members")
    first = ids.filter("id = node").select("key", "id")
    nodes = materialize(named.join(first, ["key", "id"]).select("key", "id", "n_shingles", "bands", "packed").dropDuplicates(["key", "id"]), "nodes")
    banded = nodes.select("id", F.explode("bands").alias("band"))
    leaders = banded.groupBy("band").agg(F.min("id").alias("y"), F.max("id").alias("last")).filter("y < last").drop("last")
    # No distinct here: it would keep the join from being split where a bucket is large.
    shared = materialize(banded.join(leaders, "band").select("band", F.col("id").alias("x"), "y"), "buckets")
    links = _stars(shared.filter("x <> y").select("x", "y").distinct(), nodes, docs, width, percent)
    same = ids.filter("id <> node").select(F.col("id").alias("a"), F.col("node").alias("b"))
    found = materialize(components(links.unionByName(same)), "components")
    more = _rest(shared, nodes, docs, found, width, percent)
    if not more.isEmpty():
        found = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))
    out = sets.select("id", "n_shingles").join(found, F.col("id") == F.col("node"), "left")
    component = F.coalesce("component", "id")
    return out.select("id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))


def _rest(shared: DataFrame, nodes: DataFrame, docs: DataFrame, found: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b): links between components that meet in a bucket, enough of them to join all components that are linked there.

    A bucket's leader has been tried with all others.
    A bucket's nodes are dealt to blocks of about BLOCK shingles. A task compares two blocks at a time, signatures first and then, by
    one matrix product, the sizes of all intersections; a pair of blocks yields fewer links than it has components.
    """
    rows = shared.filter("x <> y").select("band", F.col("x").alias("id")).join(found.select(F.col("node").alias("id"), "component"), "id", "left").select("band", "id", F.coalesce("component", "id").alias("c"))
    spans = rows.groupBy("band").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo < hi").select("band")
    rows = materialize(rows.join(spans, "band"), "open-buckets")
    sets = _full_sets(docs, rows.select("id").distinct(), width)
    full = rows.join(nodes.select("id", "n_shingles", "packed"), "id")
    blocks = full.groupBy("band").agg(F.ceil(F.sum("n_shingles") / BLOCK).alias("blocks"))
    full = full.join(sets, "id").join(blocks, "band").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    held = materialize(full.groupBy("band", "block").agg(F.collect_list(F.struct("id", "c", "packed", "hashes")).alias("held")), "blocks")
    a, b = held.alias("a"), held.alias("b")
    pairs = a.join(b, (F.col("a.band") == F.col("b.band")) & (F.col("a.block") <= F.col("b.block"))).select(F.col("a.held").alias("p"), F.col("b.held").alias("q"))
    return materialize(pairs.mapInArrow(_compare(percent), f"a {_kind(docs)}, b {_kind(docs)}").distinct(), "more-links")


def _kind(docs: DataFrame) -> str:
    return docs.schema["id"].dataType.simpleString()


def _compare(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least, chance = percent / 100 - _slack(percent), 2.0**-BITS
        for batch in _small(batches, 4):
            a: list = []
            b: list = []
            for r in range(batch.num_rows):
                p, q = ({k: batch.column(i)[r].values.field(k) for k in ("id", "c", "packed", "hashes")} for i in (0, 1))
                pc, qc = _codes(p["c"], q["c"])
                ps, qs = (np.asarray(x["packed"].flatten()).view(np.uint64).reshape(len(x["id"]), -1) for x in (p, q))
                likely = pc[:, None] != qc[None]
                for k in range(0, len(pc), 128):
                    different = np.zeros(likely[k : k + 128].shape, np.uint8)
                    for field in range(ps.shape[1]):
                        z = ps[k : k + 128, field, None] ^ qs[None, :, field]
                        z |= z >> np.uint64(2)
                        z |= z >> np.uint64(1)
                        different += np.bitwise_count(z & np.uint64(0x1111111111111111))
                    likely[k : k + 128] &= ((1 - different / HASHES) - chance) / (1 - chance) >= least
                i, j = np.flatnonzero(likely.any(1)), np.flatnonzero(likely.any(0))
                if not len(i):
                    continue
                sets = [np.frombuffer(x["hashes"][int(n)].as_py(), np.uint64) for x, at in ((p, i), (q, j)) for n in at]
                both = _intersections(sets[: len(i)], sets[len(i) :])
                sizes = np.array([len(s) for s in sets])
                union = sizes[: len(i), None] + sizes[None, len(i) :] - both
                x, y = np.nonzero((100 * both >= percent * union) & likely[np.ix_(i, j)])
                joined: dict[int, int] = {}
                for u, v in zip(i[x].tolist(), j[y].tolist(), strict=True):
                    s, t = _root(joined, int(pc[u])), _root(joined, int(qc[v]))
                    if s != t:
                        joined[s] = t
                        a.append(p["id"][u].as_py())
                        b.append(q["id"][v].as_py())
            kind = batch.schema.field(0).type.value_type.field("id").type
            yield pa.RecordBatch.from_arrays([pa.array(a, kind), pa.array(b, kind)], names=["a", "b"])
        give_back()

    return run


def _codes(p: pa.Array, q: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Numbers for names of any type."""
    codes = np.asarray(pa.concat_arrays([p, q]).dictionary_encode().indices)
    return codes[: len(p)], codes[len(p) :]


def _root(joined: dict[int, int], x: int) -> int:
    while x in joined:
        x = joined[x]
    return x


def _intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by products of 0/1 matrices over the hashes that both sides have."""
    out = np.zeros((len(left), len(right)), np.int64)
    one, two = np.concatenate(left), np.concatenate(right)
    shared = np.intersect1d(one, two)
    rows = [(np.repeat(np.arange(len(x)), [len(s) for s in x]), np.searchsorted(shared, flat), flat) for x, flat in ((left, one), (right, two))]
    places = []
    for row, at, flat in rows:
        ok = at < len(shared)
        ok[ok] = shared[at[ok]] == flat[ok]
        places.append((row[ok], at[ok]))
    for k in range(0, len(shared), 4096):
        m = []
        for (row, at), n in zip(places, out.shape, strict=True):
            here = (at >= k) & (at < k + 4096)
            x = np.zeros((n, min(4096, len(shared) - k)), np.float32)
            x[row[here], at[here] - k] = 1
            m.append(x)
        out += (m[0] @ m[1].T).astype(np.int64)
    return out


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 75) -> DataFrame:
    """The rows of docs that their class keeps: those of the smallest id."""
    gone = classes(docs, doc_id, text, width, percent).filter("not kept").select("id").distinct()
    rows = carried(docs, own=F.col(doc_id))
    return rows.join(gone, F.col("own") == F.col("id"), "left_anti").select("row.*")


def digest(docs: DataFrame) -> DataFrame:
    return classes(docs).select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")
