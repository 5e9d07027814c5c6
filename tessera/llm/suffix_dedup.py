"""Exact substring deduplication over documents by a sampled, range-partitioned suffix order.

Wanted: every byte covered by a string of ``LENGTH`` bytes that also starts in a document of smaller id.  Sorting the
suffixes at every byte would move the corpus many times over, so suffixes are sampled by content: each string of
``LENGTH`` bytes holds the anchor that a hash picks among its leading ``GRAM``-byte tokens (the leftmost least), and
equal strings have their anchors at the same place.  Only suffixes at anchors enter the order.

1. Strings that share an anchor share its token and, as they start near it or farther before it, 15 bytes behind the token
   or 16 before it as well: a gram of 35 or 36 bytes (:func:`grams`), which repeats by chance far less often than
   the token.  Each task lists the hashes of its grams (called tokens from here on); those met in two documents or
   more are marked in a bitmap (others may be marked by chance; none is missed).  Tokens met in very many batches are marked as hot
   in a second one, and a sample of the suffixes' leading bytes gives the splitters.
2. Suffixes at anchors with marked grams, each with the bytes that a string through the anchor can hold, are pre-aggregated in each
   batch of a task: equal contexts become one row with their least document and a list of members.  Rows of hot tokens
   go to ``SALTS`` places, each with a share of the members, so no passage gathers all its members in one task.
3. The rows are range-partitioned by leading bytes between the splitters; whole leading tokens of a range are sorted
   locally by multikey quicksort, on eight bytes at a time, once for each place of the anchor in the string, and runs
   of equal strings take their least document.  A range holds all contexts of its tokens, so no string crosses a
   boundary between ranges.
4. Members with a larger id than the least of their string get its bytes as removed; documents gather their spans, and
   only texts that may have some (by a bitmap) meet them in a join.

Documents equal to one of smaller id are settled by digests of their texts and take no part in the order.  A bitmap
tells most others from them without moving a text; the few it cannot tell are looked up in a join.

Defined cases: a null text is empty; texts under ``LENGTH`` bytes lose nothing; a null ``doc_id`` is smaller than none
and loses nothing; rows of one id never match each other; other columns are ignored by ``spans`` and ``report``
and pass through ``clean``.
"""

from __future__ import annotations

import hashlib
import zlib
from array import array

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import mix64, stored

LENGTH = 50
GRAM = 20
REACH = LENGTH - GRAM  # an anchor lies 0 to REACH bytes after the start of its string
SIDE = REACH // 2  # strings that start up to so many bytes before their anchor have a gram behind it, the others one before it
FILTER_BITS = 1 << 27  # at least; for large corpora up to MOST_BITS
MOST_BITS = 1 << 30
HOT_BITS = 1 << 22
TASK_ROWS = 1_000_000
TOKENS_HELD = 1_000_000  # by a task that lists them
BUCKET_TOKENS = 250_000  # of a group that merges lists, were no token repeated
SETTLE_ROWS = 60_000
BATCH_BYTES = 16_000_000
SEGMENT = 1 << 22
SAMPLED = 1024  # one suffix in so many is sampled for the splitters
SPLIT_SAMPLE = 1_000_000
HOT_BATCHES = 4000  # a token of so many batches is hot
SALTS = 16
_TABLE = mix64(np.arange(256, dtype=np.uint64))
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                               0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)]


def _gram_hashes(raw: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``GRAM`` (20) bytes from each place, by doubling: 2, 4, 8, 16, and 4 more."""
    h1 = _TABLE[raw]
    h2 = h1[:-1] * _ODD[0] + h1[1:]
    h4 = h2[:-2] * _ODD[1] + h2[2:]
    h8 = h4[:-4] * _ODD[2] + h4[4:]
    h16 = h8[:-8] * _ODD[3] + h8[8:]
    return mix64(h16[:-4] * _ODD[4] + h4[16:])


def _anchored(raw: bytes):
    """For each segment: its first place, the token hashes at its places, and, counted from there, its anchors and the first and last string start that each serves."""
    n = len(raw)
    if n < LENGTH:
        return
    bytes_ = np.frombuffer(raw, dtype=np.uint8)
    for lo in range(0, n - LENGTH + 1, SEGMENT):  # string starts lo .. hi-1
        hi = min(lo + SEGMENT, n - LENGTH + 1)
        h = _gram_hashes(bytes_[lo:hi - 1 + LENGTH])
        # the place breaks ties, so the least key is the leftmost of the least hashes
        key = (h & ~np.uint64(0xFFFFFF)) | np.arange(len(h), dtype=np.uint64)
        m = key
        for d in (1, 2, 4, 8):
            m = np.minimum(m[:-d], m[d:])
        m = np.minimum(m[:-(REACH + 1 - 16)], m[REACH + 1 - 16:])  # over REACH + 1 = 31 places
        at = (m & np.uint64(0xFFFFFF)).astype(np.int64)
        change = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        yield lo, h, at[change], change, np.concatenate((change[1:], [len(at)])) - 1


def _columns(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    none = (np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64))
    return tuple(map(np.concatenate, zip(*parts))) if parts else none


def anchors(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor places, their token hashes, and the first and last string start that each serves."""
    return _columns([(at + lo, h[at], first + lo, last + lo) for lo, h, at, first, last in _anchored(raw)])


def grams(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor places, the hash of a gram, and the first and last string start, for each side of each anchor that serves strings.

    Strings that start up to ``SIDE`` (15) bytes before their anchor share the ``SIDE + GRAM`` (35) bytes from it on; those that start
    farther before it share the ``SIDE + 1 + GRAM`` (36) up to the end of its token.
    """
    parts = []
    for lo, h, at, first, last in _anchored(raw):
        near, far = np.flatnonzero(at - last <= SIDE), np.flatnonzero(at - first > SIDE)
        a = at[near]
        parts.append((a + lo, mix64(h[a] * _ODD[5] + h[a + SIDE]), np.maximum(first[near], a - SIDE) + lo, last[near] + lo))
        a = at[far]
        parts.append((a + lo, mix64(h[a] * _ODD[6] + h[a - SIDE - 1]), first[far] + lo, np.minimum(last[far], a - SIDE - 1) + lo))
    return _columns(parts)


# ------------------------------------------------------------------ 1: tokens of two documents
def _raw(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "replace")


def _leads(raw: bytes, places: np.ndarray) -> np.ndarray:
    """The first 8 bytes at each place as a signed number in byte order."""
    at = places[:, None] + np.arange(8)
    return (np.frombuffer(raw, dtype=np.uint8)[at].copy().view(">u8").astype(np.uint64).reshape(-1) ^ np.uint64(1 << 63)).view(np.int64)


def _packed(tokens: np.ndarray) -> bytes:
    """The six leading bytes of each token hash; equal ones may differ behind, which marks too much, never too little.

    All first bytes come first, then all second ones: of sorted tokens these are long runs, which a shuffle compresses.
    """
    return tokens.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :6].T.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), dtype=np.uint8)
    out[:, :6] = np.frombuffer(data, dtype=np.uint8).reshape(6, -1).T
    return out.view(">u8").reshape(-1).astype(np.uint64)


def _place(tokens: np.ndarray, bits: int) -> np.ndarray:
    """A token's place in a bitmap of ``bits`` bits: its leading bits."""
    return (tokens >> np.uint64(64 - (bits - 1).bit_length())).astype(np.int64)


def _marked(bitmap: np.ndarray, tokens: np.ndarray, bits: int) -> np.ndarray:
    at = _place(tokens, bits)
    return ((bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool)


class _Originals:
    """Batches of ``doc_id, th, h, text`` without the rows whose ``h`` is marked in a bitmap."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def __call__(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        h = batch.column(2).to_numpy(zero_copy_only=False) % (len(self.bits) * 64)
        return batch.filter(pa.array(((self.bits[h // 64] >> (h % 64)) & 1) == 0))


def _with_bits(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "th", F.xxhash64("doc_id", "th").alias("h"), "text")


def _repeated_tokens(docs: DataFrame, copied: np.ndarray, buckets: int) -> DataFrame:
    """``bucket, tokens, twice``: the distinct tokens of each batch of texts and which two of its texts hold; bucket -1: sampled leading bytes."""
    shared = docs.sparkSession.sparkContext.broadcast(copied)

    def local(batches):
        originals = _Originals(shared.value)
        held, picked, size = [], [], 0

        def flush():
            every = np.sort(np.concatenate(held))
            one = np.concatenate(([True], every[1:] != every[:-1]))
            tokens = every[one]
            twice = np.diff(np.concatenate((np.flatnonzero(one), [len(every)]))) > 1
            # by leading bits, which are evenly spread: the tokens of a bucket have their places in one part of the bitmap
            bucket = (tokens >> np.uint64(32)).astype(np.int64) * buckets >> 32
            cuts = np.searchsorted(bucket, np.arange(buckets + 1))
            rows = [(b, _packed(tokens[x:y]), np.packbits(twice[x:y]).tobytes()) for b, (x, y) in enumerate(zip(cuts[:-1], cuts[1:])) if y > x]
            rows.append((-1, np.concatenate(picked).tobytes(), b""))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary()))], names=["bucket", "tokens", "twice"])

        for batch in batches:
            for t in originals(batch).column(3).to_pylist():
                raw = _raw(t)
                place, token, _, _ = grams(raw)
                if len(place):
                    pick = np.flatnonzero(token % np.uint64(SAMPLED) == 0)
                    picked.append(_leads(raw, place[pick]))
                    found = np.unique(token)
                    held.append(found)
                    size += len(found)
                if size > TOKENS_HELD:
                    yield flush()
                    held, picked, size = [], [], 0
        if held:
            yield flush()

    return _with_bits(docs).mapInArrow(local, "bucket int, tokens binary, twice binary")


def _merged_tokens(lists: DataFrame, filter_bits: int = FILTER_BITS) -> DataFrame:
    """``kind, bits``: bitmap places of the tokens that two documents hold (0) and many batches hold (1); sampled leading bytes (2)."""

    def merge(frame):
        if frame["bucket"].iloc[0] < 0:
            return pd.DataFrame({"kind": [2], "bits": [b"".join(frame["tokens"])]})
        tokens = [_unpacked(t) for t in frame["tokens"]]
        flags = [np.unpackbits(np.frombuffer(f, dtype=np.uint8))[:len(t)] for f, t in zip(frame["twice"], tokens)]
        every, flag = np.concatenate(tokens), np.concatenate(flags).astype(bool)
        order = np.argsort(every, kind="stable")
        every, flag = every[order], flag[order]
        first = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1])))
        count = np.diff(np.concatenate((first, [len(every)])))
        shared = (count > 1) | np.logical_or.reduceat(flag, first)
        marks = [np.unique(_place(every[first][which], bits)).astype(np.int32).tobytes()
                 for which, bits in ((shared, filter_bits), (count >= HOT_BATCHES, HOT_BITS))]
        return pd.DataFrame({"kind": [0, 1], "bits": marks})

    return lists.groupBy("bucket").applyInPandas(merge, "kind int, bits binary")


def _bitmap(marked: DataFrame, bits: int) -> bytes:
    """The marks as one bitmap of ``bits`` bits, whatever the corpus, compressed: block by block in Spark, then one array."""

    def words(batches):
        for batch in batches:
            for b in batch.column(0):
                bit = np.frombuffer(b.as_buffer(), dtype=np.int32)
                block = bit >> 18  # 512 blocks of 32 KB
                cuts = np.searchsorted(block, np.arange((bits >> 18) + 1))
                for k in np.unique(block):
                    part = np.zeros(1 << 18, dtype=np.uint8)
                    part[bit[cuts[k]:cuts[k + 1]] & 0x3FFFF] = 1
                    yield pa.RecordBatch.from_arrays([pa.array([int(k)], pa.int32()), pa.array([np.packbits(part, bitorder="little").tobytes()], pa.binary())], names=["block", "part"])

    def join(frame):
        total = np.zeros(1 << 15, dtype=np.uint8)
        for p in frame["part"]:
            total |= np.frombuffer(p, dtype=np.uint8)
        return frame.iloc[:1].assign(part=[total.tobytes()])

    rows = marked.select("bits").mapInArrow(words, "block int, part binary").groupBy("block").applyInPandas(join, "block int, part binary")
    out = np.zeros((bits >> 18, 1 << 15), dtype=np.uint8)
    for r in rows.toLocalIterator():
        out[r["block"]] = np.frombuffer(r["part"], dtype=np.uint8)
    return zlib.compress(out.tobytes(), 1)


def _splitters(marked: DataFrame, ranges: int) -> np.ndarray:
    """``ranges - 1`` leading numbers that part the sampled suffixes evenly; from at most ``SPLIT_SAMPLE`` of them."""
    per = F.expr(f"substring(bits, 1, {8 * SPLIT_SAMPLE})")
    sample = np.sort(np.concatenate([np.empty(0, dtype=np.int64)] + [np.frombuffer(r[0], dtype=np.int64) for r in marked.where("kind = 2").select(per).collect()]))
    return np.unique(sample[np.arange(1, ranges) * len(sample) // ranges]) if len(sample) else sample


# ------------------------------------------------------------------ 2: contexts of marked anchors
def _contexts(docs: DataFrame, copied: np.ndarray, bitmap: bytes, hot: bytes, splitters: np.ndarray) -> DataFrame:
    """``part, token, context, lo, hi, least, members``: one row for equal contexts of a task's batch.

    ``lo..hi`` are the distances from string start to anchor that all members use; a context is the ``hi`` bytes before
    the anchor and ``LENGTH - lo`` from it; members are (doc_id, half of th and place) as bytes; ``part`` is the range
    (and, for a hot token, the salt); ``least`` is the least document of a hot token's row, whose members are split.
    """
    shared = docs.sparkSession.sparkContext.broadcast((bitmap, hot, splitters, copied))

    def run(batches):
        bits, hot_bits = (np.frombuffer(zlib.decompress(b), dtype=np.uint8) for b in shared.value[:2])
        limits, originals = shared.value[2], _Originals(shared.value[3])
        held: dict[tuple, list] = {}
        size = 0

        def flush():
            lead = _leads(b"".join(k[0][k[2]:k[2] + 8] for k in held), np.arange(len(held)) * 8)
            part = (np.searchsorted(limits, lead, side="right") * SALTS).tolist()
            rows = []
            for at, (k, v) in zip(part, held.items()):
                if not v[0]:
                    rows.append((at, v[1], k[0], k[1], k[2], None, array("q", v[2:]).tobytes()))
                    continue
                m = np.array(v[2:], dtype=np.int64).reshape(-1, 2)
                rows += [(at + salt, v[1], k[0], k[1], k[2], int(m[:, 0].min()), m[salt::SALTS].tobytes()) for salt in range(SALTS)]
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["part", "token", "context", "lo", "hi", "least", "members"])

        for batch in batches:
            batch = originals(batch)
            for doc_id, th, text in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                if doc_id is None:
                    continue
                raw = _raw(text)
                place, token, first, last = grams(raw)
                hit = np.flatnonzero(_marked(bits, token, 8 * len(bits)))
                if not len(hit):
                    continue
                hot_here = _marked(hot_bits, token[hit], HOT_BITS).tolist()
                for p, a, b, h, t in zip(place[hit].tolist(), first[hit].tolist(), last[hit].tolist(), hot_here, token[hit].view(np.int64).tolist()):
                    key = (raw[a:b + LENGTH], p - b, p - a)
                    got = held.get(key)
                    if got is None:
                        held[key] = [h, t, doc_id, th + p]
                        size += LENGTH + 80
                    else:
                        got += (doc_id, th + p)
                    size += 16
                if size > BATCH_BYTES:
                    yield flush()
                    held, size = {}, 0
        if held:
            yield flush()

    return _with_bits(docs).mapInArrow(
        run, "part long, token long, context binary, lo int, hi int, least long, members binary")


def _half(text: str) -> Column:
    """32 bits of a text's hash in the upper half of a long; the lower half takes a place in the text."""
    return F.shiftleft(F.xxhash64(text), 32)


# ------------------------------------------------------------------ 3: one range of the suffix order
def multikey_order(keys: np.ndarray, starts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of ``keys`` (n x m big-endian words), and True where a row differs from the one before it.

    ``starts``: True where a run of rows begins that are already in order among runs.

    Multikey quicksort on words: a column splits every run that is still equal into runs by its value, and only runs of
    two and more go on to the next column.
    """
    n, m = keys.shape
    order = np.arange(n)
    if starts is None:
        starts = np.zeros(n, dtype=bool)
        starts[:1] = True
    for c in range(m):
        run = np.cumsum(starts) - 1
        size = np.bincount(run, minlength=run[-1] + 1 if n else 0)
        open_ = np.flatnonzero(size[run] > 1)
        if not len(open_):
            break
        value = keys[order[open_], c]
        by = np.lexsort((value, run[open_]))
        order[open_] = order[open_][by]
        value, where = value[by], run[open_][by]
        starts[open_[1:]] |= (value[1:] != value[:-1]) | (where[1:] != where[:-1])
    return order, starts


def least_documents(token: np.ndarray, contexts: np.ndarray, lo: np.ndarray, hi: np.ndarray, least: np.ndarray) -> np.ndarray:
    """For each row and distance r, the least document of the string that starts r before the anchor; its own where the row has no such string.

    Rows come in order of their leading tokens; contexts are n x (REACH + LENGTH) bytes.
    """
    out = np.repeat(least[:, None], REACH + 1, axis=1)
    change = np.concatenate(([True], token[1:] != token[:-1], [True]))
    shared = np.flatnonzero(~(change[:-1] & change[1:]))  # tokens of two rows and more
    for r in range(REACH + 1):
        mine = shared[(lo[shared] <= r) & (r <= hi[shared])]
        if len(mine) < 2:
            continue
        # behind the token, then before it: all of the string but the token itself, which leads the order already
        string = np.zeros((len(mine), 32), dtype=np.uint8)
        string[:, :REACH - r] = contexts[mine, REACH + GRAM:REACH + LENGTH - r]
        string[:, REACH - r:REACH] = contexts[mine, REACH - r:REACH]
        starts = np.concatenate(([True], token[mine[1:]] != token[mine[:-1]]))
        order, starts = multikey_order(string.view(">u8"), starts)
        low = np.minimum.reduceat(least[mine[order]], np.flatnonzero(starts))
        out[mine[order], r] = low[np.cumsum(starts) - 1]
    return out


def _laid_out(context: pa.Array, hi: np.ndarray) -> np.ndarray:
    """Contexts as rows of REACH + LENGTH bytes with their anchors in one column, zero-filled."""
    n, width = len(context), REACH + LENGTH
    raw = b"".join(context.to_pylist())
    size = np.diff(np.frombuffer(context.buffers()[1], dtype=np.int32)[context.offset:context.offset + n + 1]).astype(np.int64)
    begin = np.cumsum(size) - size
    out = np.zeros(n * width, dtype=np.uint8)
    out[np.repeat(np.arange(n) * width + REACH - hi - begin, size) + np.arange(len(raw))] = np.frombuffer(raw, dtype=np.uint8)
    return out.reshape(n, width)


def _removed(rows: DataFrame, parts: int) -> DataFrame:
    """``doc_id, th, start, stop`` of removed bytes, merged within a member."""

    def settle(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        token, lo, hi = (table.column(c).to_numpy() for c in ("token", "lo", "hi"))
        blobs = table.column("members").to_pylist()
        member = np.frombuffer(b"".join(blobs), dtype=np.int64).reshape(-1, 2)
        count = np.array([len(b) // 16 for b in blobs], dtype=np.int64)
        row = np.repeat(np.arange(len(count)), count)
        ids = np.full(len(count), np.iinfo(np.int64).max)
        np.minimum.at(ids, row, member[:, 0])
        told = table.column("least")
        ids = np.where(told.is_valid().to_numpy(), told.fill_null(0).to_numpy(), ids)
        low = least_documents(token, _laid_out(table.column("context").chunk(0), hi.astype(np.int64)), lo, hi, ids)
        hurt = np.flatnonzero(low.min(axis=1)[row] < member[:, 0])
        member, row, r = member[hurt], row[hurt], np.arange(REACH + 1)[None, :]
        hit = (low[row] < member[:, :1]) & (r >= lo[row][:, None]) & (r <= hi[row][:, None])
        some = hit.any(axis=1)
        member, hit = member[some], hit[some]
        # the strings of one member overlap, for they start within REACH bytes of its anchor
        place = member[:, 1] & 0xFFFFFFFF
        start = place - (REACH - hit[:, ::-1].argmax(axis=1))
        stop = place - hit.argmax(axis=1) + LENGTH
        columns = (member[:, 0], member[:, 1] - place, start, stop)
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names=["doc_id", "th", "start", "stop"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < SETTLE_ROWS:
                continue
            table = pa.Table.from_batches(held)
            token = table.column("token").to_numpy()
            before = np.flatnonzero(token != token[-1])
            cut = int(before[-1]) + 1 if len(before) else 0
            if cut:  # whole leading tokens only; the last one may go on
                yield settle(table.slice(0, cut))
                held, size = table.slice(cut).combine_chunks().to_batches(), size - cut
        if size:
            yield settle(pa.Table.from_batches(held))

    return (rows.repartition(parts, "part").sortWithinPartitions("token")
            .mapInArrow(run, "doc_id long, th long, start long, stop long"))


# ------------------------------------------------------------------ 4: spans of documents
def spans(docs: DataFrame) -> DataFrame:
    """``doc_id, th, spans``: the maximal removed runs (array of start, stop) of each document that loses bytes.

    ``th`` (see :func:`_half`) tells rows of one id with different texts apart.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _half("text").alias("th"), "text")
    sized = stored(docs.select("doc_id", "th", F.octet_length(F.coalesce("text", F.lit(""))).alias("n"), F.xxhash64("text").alias("h1"),
                               F.xxhash64("text", F.lit(1)).alias("h2")), "sized")
    total = sized.agg(F.sum("n")).first()[0] or 0
    groups = (sized.where(f"n >= {LENGTH}").groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most"))
    whole = stored(sized.join(groups, ["h1", "h2", "n"]).where("doc_id > least").select("doc_id", "th", F.col("n").cast("long").alias("n")).distinct(), "whole")
    copied = _marks(whole)
    unsure = _split_by(docs, copied).where("_maybe").join(whole, ["doc_id", "th"], "left_anti").select("doc_id", "th", "text")
    unsure = stored(unsure, "unsure")  # marked by chance: few
    both = lambda f, *more: f(docs, copied, *more).unionByName(f(unsure, np.zeros(1, dtype=np.int64), *more))
    suffixes = int(total // (REACH // 2 + 1)) + 1
    filter_bits = max(FILTER_BITS, min(MOST_BITS, 1 << (2 * suffixes).bit_length()))
    marked = stored(_merged_tokens(both(_repeated_tokens, 2 * suffixes // BUCKET_TOKENS + 1), filter_bits), "tokens")
    ranges = suffixes // (TASK_ROWS // 2) + 1
    rows = both(_contexts, _bitmap(marked.where("kind = 0"), filter_bits), _bitmap(marked.where("kind = 1"), HOT_BITS), _splitters(marked, ranges * 4))
    equal = whole.select("doc_id", "th", F.lit(0).cast("long").alias("start"), F.col("n").alias("stop"))
    gathered = _removed(rows, ranges * 2).unionByName(equal).groupBy("doc_id", "th").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("parts"))
    empty = F.expr("cast(array() as array<struct<start:bigint,stop:bigint>>)")
    merged = F.aggregate("parts", F.struct(empty.alias("done"), F.col("parts")[0].alias("open")), lambda s, x: F.when(
        x["start"] <= s["open"]["stop"], F.struct(s["done"].alias("done"), F.struct(
            s["open"]["start"].alias("start"), F.greatest(s["open"]["stop"], x["stop"]).alias("stop")).alias("open"))).otherwise(
        F.struct(F.array_append(s["done"], s["open"]).alias("done"), x.alias("open"))),
        lambda s: F.array_append(s["done"], s["open"]))
    return gathered.select("doc_id", "th", merged.alias("spans"))


def kept(raw: bytes, removed) -> bytes:
    """The bytes outside the spans, joined."""
    out, at = [], 0
    for a, b in removed:
        out.append(raw[at:a])
        at = b
    out.append(raw[at:])
    return b"".join(out)


def report(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every document.

    Texts that may lose bytes (their hash is in a bitmap of those that do) meet their spans; the others are never moved.
    """
    found = stored(spans(docs), "spans")
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _half("text").alias("th"))
    marked = _split_by(ids, _marks(found))
    n = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    still = marked.where("not _maybe").select("doc_id", n.alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
                                              F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"

    def run(batches):
        for batch in batches:
            rows = []
            for doc_id, text, removed in zip(*(batch.column(i) for i in range(3))):
                raw, cuts = _raw(text.as_py()), [(s["start"], s["stop"]) for s in removed.as_py() or ()]
                rows.append((doc_id.as_py(), len(raw), sum(b - a for a, b in cuts), len(cuts), hashlib.sha256(kept(raw, cuts)).hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 5, [pa.int64()] * 4 + [pa.string()])],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    moved = marked.where("_maybe").join(found, ["doc_id", "th"], "left").select("doc_id", "text", "spans").mapInArrow(run, schema)
    return still.unionByName(moved)


def _marks(found: DataFrame, bits: int = 1 << 25) -> np.ndarray:
    """A bitmap of ``bits`` bits, as longs, of the rows (doc_id, th) of ``found``."""
    marks = (found.select(F.expr(f"pmod(xxhash64(doc_id, th), {bits})").alias("b")).select(F.expr("b div 64").alias("w"), F.expr("shiftleft(1L, cast(b % 64 as int))").alias("v"))
             .groupBy("w").agg(F.bit_or("v").alias("v")).toPandas())
    words = np.zeros(bits // 64, dtype=np.int64)
    words[marks["w"].to_numpy(dtype=np.int64)] = marks["v"].to_numpy(dtype=np.int64)
    return words


def _split_by(docs: DataFrame, words: np.ndarray) -> DataFrame:
    """``docs`` with ``_maybe``: False only for rows without a mark."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    @F.pandas_udf("boolean")
    def maybe(s):
        b = s.to_numpy(dtype=np.int64) % (len(shared.value) * 64)
        return pd.Series(((shared.value[b // 64] >> (b % 64)) & 1).astype(bool))

    return docs.withColumn("_maybe", maybe.asNondeterministic()(F.xxhash64("doc_id", "th")))


def clean(docs: DataFrame) -> DataFrame:
    """``docs`` with the removed bytes cut from their texts (bytes of a character cut in two are dropped with it)."""
    found = spans(docs)
    keyed = docs.withColumn("__id", F.col("doc_id").cast("long")).withColumn("__th", _half("text"))

    @F.pandas_udf("string")
    def cut(text, removed):
        return pd.Series([None if t is None else kept(_raw(t), [(s["start"], s["stop"]) for s in (r if r is not None else ())]).decode("utf-8", "ignore") for t, r in zip(text, removed)])

    return (keyed.join(found.select(F.col("doc_id").alias("__id"), F.col("th").alias("__th"), F.col("spans").alias("__spans")), ["__id", "__th"], "left")
            .withColumn("text", cut("text", "__spans")).select(*docs.columns))


def op4_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return report(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


ORACLE = """
WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
k AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS i FROM t)),
m AS (SELECT s, min(doc_id) AS lo FROM k GROUP BY s),
c AS (SELECT k.doc_id, i FROM k JOIN m USING (s) WHERE lo < k.doc_id),
g AS (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 50 THEN 0 ELSE 1 END AS f FROM c),
b AS (SELECT doc_id, i, sum(f) OVER (PARTITION BY doc_id ORDER BY i) AS n FROM g),
z AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS z FROM b GROUP BY doc_id, n),
y AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS p FROM z),
x AS (SELECT doc_id, string_agg(substr(h, 2 * p + 1, 2 * (a - p)), '' ORDER BY a) AS pre, max(z) AS z, count(*) AS n, sum(z - a) AS r
  FROM y JOIN t USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(r, 0) AS BIGINT) AS n_removed, CAST(coalesce(n, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(pre, '') || substr(h, 2 * coalesce(z, 0) + 1))) AS kept_sha256 FROM t LEFT JOIN x USING (doc_id)
"""
