"""Near-duplicate groups by a word n-gram Jaccard self-join with adaptive multi-match prefixes.

Texts become sets of hashed word shingles.  Shingles have one global order, by their count in a sketch over all
distinct sets and then by hash, so common ones come last.  A set of ``n`` that must share ``T = ceil(t * n)``
shingles with any partner keeps its first ``n - T + l`` shingles: two similar sets then share at least ``l`` of them.
Each document chooses its own ``l``: a longer prefix has more postings to meet but needs more of them shared, and the
``l`` of least estimated cost (postings met, plus verifications, which ``l`` divides) is taken.  A pair is a candidate
when it shares at least the smaller ``l`` of the two; of the prefixes only the part counts that the sizes of both
leave room for, which keeps sets with many shingles of their own from meeting over common ones.

Groups need connectivity, not all pairs.  Equal sets are one node from the start.  Then every posting list links
its neighbours in size and the set that reaches it first, a number of candidates linear in the postings; those verified exactly are
merged, and only sets that are still in different components go through the multi-match count.  Any link between
different texts joins its two ends, directly or through others, so the components are those of the whole graph.

Before whole sets travel, candidates meet over parity bitmaps of one to two bits a shingle: two sets differ in at least as many
shingles as their bitmaps in bits, so a pair whose bitmaps differ too much is no link.  Sets of 64 bits a shingle
travel for the other pairs only, and each of those is compared exactly.

Sets are compared by 64-bit shingle hashes, sets as wholes by a 64-bit digest of them.  Defined cases: null, empty
and blank texts have no shingles and are linked with nothing; fewer words than ``k`` are one shingle; a null
``doc_id`` is a document whose id sorts after all others and is the component's id only if all are null; rows that
repeat an id are documents each; other columns are ignored by ``near_duplicates`` and pass through ``keep_first``.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import GOLDEN, every, free_name, mix64, stored
from tessera.llm.graph import components

CELLS = 1 << 20
CHUNKS = 16
MOST_SHARED = 8
VERIFY_COST = 2.0  # of a candidate, in postings met
FILTER_BITS = 1 << 25
SEGMENT = 1 << 20
BASE = 0x5851F42D4C957F2D
_SPACE = re.compile(rb"[ \t-\r]")
_bytes = np.arange(256)
_INSIDE = ~((_bytes == 32) | ((_bytes >= 9) & (_bytes <= 13)))
_VALUE = mix64(np.where((_bytes >= 65) & (_bytes <= 90), _bytes + 32, _bytes).astype(np.uint64))  # by lower case
_ZERO = np.zeros(1, dtype=np.uint64)
_POWERS = [np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.uint64)]


def word_hashes(raw: bytes) -> np.ndarray:
    """A 64-bit hash of each word, in order: polynomial sums over the bytes between white space, all words at once.

    Long texts go by segments cut at white space.
    """
    out, start = [], 0
    while start < len(raw):
        stop = len(raw)
        if stop - start > SEGMENT:
            cut = _SPACE.search(raw, start + SEGMENT)
            stop = cut.start() if cut else stop
        seg = np.frombuffer(raw, dtype=np.uint8, count=stop - start, offset=start)
        power, back = _powers(len(seg))
        inside = np.concatenate(([False], _INSIDE[seg], [False]))
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        first, end = edge[::2], edge[1::2]
        total = np.concatenate((_ZERO, np.cumsum(_VALUE[seg] * power[:len(seg)])))
        out.append(mix64((total[end] - total[first]) * back[first] + (end - first).astype(np.uint64) * GOLDEN))
        start = stop
    return np.concatenate(out) if out else np.empty(0, dtype=np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64, at least ``n`` of each."""
    if len(_POWERS[0]) < n:
        m = max(n, 1 << 16)
        for i, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            _POWERS[i] = np.concatenate((np.ones(1, dtype=np.uint64), np.cumprod(np.full(m, base, dtype=np.uint64))))
    return _POWERS[0], _POWERS[1]


def shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's ``k``-word shingles (ASCII lower case, ASCII white space)."""
    ids = word_hashes((text or "").encode("utf-8", "replace"))
    if not len(ids):
        return ids
    k = min(k, len(ids))
    n = len(ids) - k + 1
    odd = mix64(np.arange(1, k + 1, dtype=np.uint64)) | np.uint64(1)
    h = np.full(n, k, dtype=np.uint64)
    for j in range(k):
        h += ids[j:n + j] * odd[j]
    h = mix64(h)
    h.sort()
    return h[np.concatenate(([True], h[1:] != h[:-1]))]


def node_of(found: np.ndarray) -> int:
    """A signed 64-bit digest of a set."""
    return xxhash.xxh3_64_intdigest(found.tobytes()) - (1 << 63)


def parity(found: np.ndarray) -> bytes:
    """A bitmap of a power of two of bits, as many as shingles or more: of each bit, whether an odd number of shingles fall on it."""
    width = max(64, 1 << (len(found) - 1).bit_length()) if len(found) else 64
    odd = np.bincount((found & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def may_be_similar(x: np.ndarray, y: np.ndarray, total: int, percent: int) -> bool:
    """False only if sets with the bitmaps ``x`` and ``y`` (bytes), of ``total`` shingles together, cannot be similar."""
    if len(x) < len(y):
        x, y = y, x
    while len(x) > len(y):  # the bitmap of half the bits
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    apart = int(np.bitwise_count(x ^ y).sum())  # in at least so many shingles the sets differ
    return (100 - percent) * (total + apart) >= 200 * apart


def least_shared(n, percent: int):
    """The fewest shingles that a set of ``n`` shares with a similar one."""
    return (percent * n + 99) // 100


def _cells(found: np.ndarray) -> np.ndarray:
    return (found >> np.uint64(20)).astype(np.int64) & (CELLS - 1)


def prefix(found: np.ndarray, sketch: np.ndarray, noise: float, percent: int) -> tuple[np.ndarray, int]:
    """The prefix of a set, and how many of its shingles a candidate must share."""
    n = len(found)
    counts = sketch[_cells(found)]
    order = np.lexsort((found, counts))
    least = least_shared(n, percent)
    l_max = min(MOST_SHARED, least)
    met = np.maximum(counts[order[:n - least + l_max]] - 1.0 - 2.0 * noise, 0.0)
    total = np.cumsum(met)[n - least:n - least + l_max]  # postings met by prefixes of l = 1, 2, ..
    # of those, at most total / l sets are met l times, and as many as the longest list holds if its sets share them all
    candidates = np.sqrt(met[n - least] * total / np.arange(1, l_max + 1))
    l = 1 + int(np.argmin(total + VERIFY_COST * candidates))
    return found[order[:n - least + l]], l


def _texts(batches) -> Iterator[tuple]:
    for batch in batches:
        yield batch, batch.column(batch.schema.get_field_index("text")).to_pylist()


def _sized(docs: DataFrame, k: int) -> DataFrame:
    """A row (doc_id, text_hash, n, node, bits) a document, and the chunks of the sketch of each task's distinct sets."""
    schema = "doc_id long, text_hash long, n long, node long, bits binary, chunk int, counts binary"
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        counts, seen = np.zeros(CELLS, dtype=np.uint32), set()
        for batch, texts in _texts(batches):
            sizes, nodes, bits = [], [], []
            for t in texts:
                found = shingles(t, k)
                sizes.append(len(found))
                bits.append(parity(found))
                nodes.append(node := node_of(found))
                if node not in seen:
                    seen.add(node)
                    np.add.at(counts, _cells(found), 1)
            m = len(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(bits, pa.binary()),
                 pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())],
                names=names)
        if seen:
            parts = [zlib.compress(p.tobytes(), 1) for p in np.split(counts, CHUNKS)]
            yield pa.RecordBatch.from_arrays(
                [*[pa.nulls(CHUNKS, pa.int64())] * 4, pa.nulls(CHUNKS, pa.binary()), pa.array(range(CHUNKS), pa.int32()), pa.array(parts, pa.binary())],
                names=names)

    return docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text")).mapInArrow(run, schema)


def _sketch(rows: DataFrame) -> np.ndarray:
    """The counts of all tasks together: ``CELLS`` numbers, whatever the corpus."""

    def add(frame):
        total = np.zeros(CELLS // CHUNKS, dtype=np.uint64)
        for c in frame["counts"]:
            total += np.frombuffer(zlib.decompress(c), dtype=np.uint32)
        return frame.iloc[:1].assign(counts=[zlib.compress(total.astype(np.uint32).tobytes(), 1)])

    parts = rows.where(F.col("chunk").isNotNull()).select("chunk", "counts").groupBy("chunk").applyInPandas(add, "chunk int, counts binary")
    out = np.zeros((CHUNKS, CELLS // CHUNKS), dtype=np.float32)
    for r in parts.collect():
        out[r["chunk"]] = np.frombuffer(zlib.decompress(r["counts"]), dtype=np.uint32)
    return out.reshape(-1)


def _postings(docs: DataFrame, sketch: np.ndarray, k: int, percent: int) -> DataFrame:
    """``token, node, n, l, pos`` (place in the prefix, from 1) of every prefix, once a task for equal sets."""
    shared = docs.sparkSession.sparkContext.broadcast(sketch)
    noise = float(sketch.mean())

    def run(batches):
        seen = set()
        for _, texts in _texts(batches):
            tokens, nodes, sizes, ls = [], [], [], []
            for t in texts:
                found = shingles(t, k)
                if not len(found) or (node := node_of(found)) in seen:
                    continue
                seen.add(node)
                part, l = prefix(found, shared.value, noise, percent)
                tokens.append(part)
                nodes.append(node)
                sizes.append(len(found))
                ls.append(l)
            if tokens:
                each = list(map(len, tokens))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.repeat(np.array(nodes, dtype=np.int64), each)),
                     pa.array(np.repeat(np.array(sizes, dtype=np.int32), each)), pa.array(np.repeat(np.array(ls, dtype=np.int32), each)),
                     pa.array(np.concatenate([np.arange(1, m + 1, dtype=np.int32) for m in each]))],
                    names=["token", "node", "n", "l", "pos"])

    return docs.select("text").mapInArrow(run, "token long, node long, n int, l int, pos int")


def _filter(hashes: DataFrame) -> np.ndarray:
    """A bitmap of ``FILTER_BITS`` bits from a column of hashes ``h``; others may match too, none of these is missed."""
    bit = F.pmod("h", F.lit(FILTER_BITS))
    rows = (hashes.select(F.expr(f"pmod(h, {FILTER_BITS}) div 32").alias("word"), F.expr("shiftleft(1L, cast(pmod(h, 32) as int))").alias("bits"))
            .groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas())
    out = np.zeros(FILTER_BITS // 32, dtype=np.uint32)
    out[rows["word"].to_numpy(dtype=np.int64)] = rows["bits"].to_numpy(dtype=np.int64).astype(np.uint32)
    return out


def _sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """``node, found`` (the hashes as bytes) of the documents ``wanted`` (doc_id); a few others may come along."""
    bits = docs.sparkSession.sparkContext.broadcast(_filter(wanted.select(F.xxhash64("doc_id").alias("h"))))

    def run(batches):
        for batch in batches:
            h = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64) % FILTER_BITS
            hit = np.flatnonzero((bits.value[h // 32] >> (h % 32).astype(np.uint32)) & 1)
            nodes, found = [], []
            for t in batch.column(0).take(pa.array(hit)).to_pylist():
                f = shingles(t, k)
                nodes.append(node_of(f))
                found.append(f.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(found, pa.binary())], names=["node", "found"])

    return docs.select("text", F.xxhash64(F.col("doc_id").cast("long")).alias("h")).mapInArrow(run, "node long, found binary")


def _compared(pairs: DataFrame, rows: DataFrame, test) -> DataFrame:
    """The pairs (a, b) of nodes for which ``test`` holds on the two values (buffers) of ``rows`` (node, n, value) and their ``n`` together."""
    mine = lambda c: rows.select(F.col("node").alias(c), F.col("n").alias("n_" + c), F.col("value").alias("value_" + c))
    both = pairs.join(mine("a"), "a").join(mine("b"), "b")

    def run(batches):
        for batch in batches:
            keep = [test(x.as_buffer(), y.as_buffer(), n) for x, y, n in zip(batch.column(2), batch.column(3), batch.column(4).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "value_a", "value_b", (F.col("n_a") + F.col("n_b")).alias("n")).mapInArrow(run, "a long, b long").distinct()


def _close(pairs: DataFrame, sized: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes that their bitmaps do not rule out."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    rows = stored(sized.where("n > 0").join(nodes, "node").select("node", "n", F.col("bits").alias("value")).dropDuplicates(["node"]), "bits")
    return _compared(pairs, rows, lambda x, y, n: may_be_similar(np.frombuffer(x, dtype=np.uint8), np.frombuffer(y, dtype=np.uint8), n, percent))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose sets are similar."""

    def similar(x, y, n):
        both = len(np.intersect1d(np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64), assume_unique=True))
        return 100 * both >= percent * (n - both)

    return _compared(pairs, sets.select("node", (F.octet_length("found") / 8).cast("long").alias("n"), F.col("found").alias("value")), similar)


def _grouped(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """``doc_id, text_hash, n, grp, component_id`` of every document; ``grp`` is a node of its component."""
    rows = stored(_sized(docs, k), "sized")
    sketch = _sketch(rows)
    sized = rows.where(F.col("chunk").isNull()).select("doc_id", "text_hash", "n", "node", "bits")
    first = sized.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("first_id"))

    # postings that meet another set; one exchange by token serves the test and what follows it
    by_token = W.partitionBy("token")
    postings = _postings(docs, sketch, k, percent).repartition("token")
    met = postings.withColumn("lo", F.min("node").over(by_token)).withColumn("hi", F.max("node").over(by_token))
    met = stored(met.where("lo <> hi").select("token", "node", "n", "l", "pos").dropDuplicates(["token", "node"]), "met")

    # Two similar sets share ``need`` shingles or more, so of the first n - need + l of each they share l or more.
    need = f"(({percent} * (n + n2) + {99 + percent}) div {100 + percent})"
    within = (f"100 * least(n, n2) >= {percent} * greatest(n, n2) and node <> node2 "
              f"and pos <= n - {need} + least(l, l2) and pos2 <= n2 - {need} + least(l, l2)")
    mine = ("node", "n", "l", "pos")
    in_size = by_token.orderBy("n", "node")
    before = F.struct(*[F.lag(c).over(in_size).alias(c + "2") for c in mine])
    first_in = F.min(F.struct("pos", "n", "node", "l")).over(by_token)
    top = F.struct(*[first_in[c].alias(c + "2") for c in mine])  # the set of the list with the fewest rarer shingles
    near = met.select(*mine, F.array(before, top).alias("o")).select(*mine, F.inline("o"))
    linear = stored(near.where(within).select(F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b")).distinct(), "linear")

    def verified(pairs: DataFrame) -> DataFrame:
        pairs = stored(_close(pairs, sized, percent), "close")
        nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        sets = stored(_sets(docs, nodes.join(first, "node").select(F.col("first_id").alias("doc_id")), k), "sets")
        return stored(_verified(pairs, sets, percent), "links")

    links = verified(linear)
    merged = components(links)

    # what still lies in different components: count the shared prefix shingles of each pair
    labelled = met.join(merged, "node", "left").withColumn("c", F.coalesce("component", "node")).drop("component")
    labelled = labelled.repartition("token").withColumn("lo", F.min("c").over(by_token)).withColumn("hi", F.max("c").over(by_token))
    apart = stored(labelled.where("lo <> hi").drop("lo", "hi"), "apart")
    other = apart.select("token", *[F.col(c).alias(c + "2") for c in (*mine, "c")])
    pairs = (apart.join(other, "token").where("node < node2 and c <> c2").where(within)
             .groupBy(F.col("node").alias("a"), F.col("node2").alias("b")).agg(F.count(F.lit(1)).alias("shared"), F.first(F.least("l", "l2")).alias("l"))
             .where("shared >= l").select("a", "b"))
    final = components(links.unionByName(verified(stored(pairs, "pairs"))))

    # the component's id is its smallest document
    named = final.join(first, "node")
    ids = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = named.join(ids, "component").select("node", "component", "component_id")
    whole = first.join(named, "node", "left").select("node", F.coalesce("component", "node").alias("grp"), F.coalesce("component_id", "first_id").alias("component_id"))
    return (sized.join(whole, "node", "left")
            .select("doc_id", "text_hash", "n", "grp", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document; similar: 100 * intersection >= percent * union."""
    return _grouped(docs, k, percent).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def keep_first(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group: that of smallest id, null last, and of its texts the one of smallest hash.

    A document is its id and its text, so rows that share an id are judged each, and of rows equal in both, ids null or
    not, one stays (any, where other columns differ).  Documents without words all stay.  Other columns pass through, whatever
    their names.  Only the (id, hash) pairs of rows that go or repeat meet the documents.
    """
    found = stored(_grouped(docs.select("doc_id", "text"), k, percent).where("n > 0"), "grouped")
    named = found.where("doc_id <=> component_id").select("grp", "doc_id", "text_hash").distinct()
    heads = named.groupBy("grp").agg(F.min("text_hash").alias("head"))
    others = named.join(heads, "grp").where("text_hash <> head")
    gone = found.where("not (doc_id <=> component_id)").select("doc_id", "text_hash").unionByName(others.select("doc_id", "text_hash"))
    repeated = found.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    marks = (gone.withColumn("again", F.lit(False)).unionByName(repeated.select("doc_id", "text_hash", F.lit(True).alias("again")))
             .groupBy("doc_id", "text_hash").agg(F.min("again").alias("again")))  # what goes, goes with all its rows
    own, id_, hash_, again = (free_name(docs, c) for c in ("own_hash", "mark_id", "mark_hash", "mark_again"))
    marks = stored(marks.select(F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_), F.col("again").alias(again)), "marks")
    rows = docs.withColumn(own, F.xxhash64("text"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(id_)) & (F.col(own) == F.col(hash_))
    once = rows.join(marks.where(F.col(again)), same).dropDuplicates([id_, hash_])
    return rows.join(marks, same, "left_anti").select(*every(docs)).unionByName(once.select(*every(docs)))


def op2_adaptive_jaccard(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), 4, 85)


ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS g FROM w),
e AS (SELECT doc_id, unnest(g) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b WHERE 100 * c >= 85 * (len(x.g) + len(y.g) - c)),
u AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, o) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, u.b FROM r JOIN u ON u.a = r.o)
SELECT s.doc_id, CAST(len(s.g) AS BIGINT) AS n_shingles, min(r.o) AS component_id FROM s JOIN r USING (doc_id) GROUP BY s.doc_id, len(s.g)
"""
