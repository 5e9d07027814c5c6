"""Best-fit packing of tokenised documents into sequences, by a grouping genetic algorithm on islands.

Texts become ids on the executors; a document ends with ``END_ID`` and only one longer than a sequence is cut.
Whole-sequence pieces are sequences of their own.  The others are dealt at random into blocks of about
``BLOCK_ITEMS`` pieces; for each block several islands, one task row each, evolve packings whose genes are bins:
crossover injects well-filled bins of one parent whole, drops the bins of the other that hold any of their pieces,
lets bins that are not full trade a piece for a longer displaced one that fits, and best-fits what is left over.  Between epochs each island sends its elite to the next.  Pieces in bins
that stay too empty go on to the next level, dealt anew with those of other blocks, until one block is left or a level
has settled less than ``PROGRESS`` of its pieces; the last level keeps its bins as they are.

Defined cases: null and empty texts are one ``END_ID``; a null ``doc_id`` packs like any other; repeated rows
are each packed; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import random
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import stored

CAPACITY = 2048
END_ID = 0
END = END_ID.to_bytes(4, "little")
BLOCK_ITEMS = 2000
ISLANDS = 2
POPULATION = 8
GENERATIONS = 8
STALLED = 3
EPOCHS = 2
PROGRESS = 0.15
SETTLED = 0.995
CACHE_WORDS = 2_000_000
SEGMENT = 1 << 22
TOGETHER = 1 << 20
CLOSING = b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~"  # ASCII punctuation but quote marks and what special tokens hold
PIECES = "array<struct<piece:int,start:long,length:long,ids_crc32:long>>"
_SPACE = re.compile(rb"[ \t-\r]")
_encoders: dict[str, "Encoder"] = {}


class Encoder:
    """Ids of whole texts, word by word: the tokenizer never joins across white space, so words can be remembered.

    New words are encoded many at a time.  A word of letters alone is one piece for the tokenizer, whose last id closes a
    word, so the ids of a line of such words can be told apart.  A word that ends in ASCII punctuation after a letter
    or digit is that word and the punctuation.  Other words, and lines whose ids do not add up, are encoded alone.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer, self.known = Tokenizer.from_file(path), {}
        vocab = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.closes[[i for t, i in vocab.items() if t.endswith("</w>")]] = True

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _alone(self, words: list[bytes]) -> None:
        for w, ids in zip(words, self._ids([w.decode("utf-8", "replace") for w in words])):
            self.known[w] = np.array(ids, dtype="<u4").tobytes()

    def _meet(self, words: set[bytes]) -> None:
        known, parts = self.known, []
        simple, alone = set(), set()
        for w in words:
            base = w.rstrip(CLOSING)
            if base is not w and len(base) < len(w) and base and base[-1:].isalnum():
                parts.append((w, base, w[len(base):]))
                todo = (base, w[len(base):])
            else:
                todo = (w,)
            for x in todo:
                if x not in known:
                    (simple if x.isalpha() or x.decode("utf-8", "replace").isalpha() else alone).add(x)
        lines = list(simple)
        groups = [lines[i:i + 256] for i in range(0, len(lines), 256)]
        for g, ids in zip(groups, self._ids([b" ".join(g).decode("utf-8", "replace") for g in groups]) if groups else []):
            ids = np.array(ids, dtype="<u4")
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) != len(g) or ends[-1] != len(ids):
                alone.update(g)
                continue
            raw, at = ids.tobytes(), 0
            for w, end in zip(g, (4 * ends).tolist()):
                known[w] = raw[at:end]
                at = end
        if alone:
            self._alone(sorted(alone))
        for w, base, tail in parts:
            known[w] = known[base] + known[tail]

    def _words(self, raw: bytes) -> list[bytes]:
        if b"<|" not in raw and b"\xcc" not in raw and b"\xcd" not in raw:
            # as the tokenizer would, with fewer words to remember; not before a combining mark (which starts with one
            # of these bytes), because the tokenizer composes letter and mark first
            raw = raw.lower()
        return raw.split()

    def _ids_of(self, pieces: list[list[bytes]]) -> Iterator[bytes]:
        """The ids of each list of words; new words of all lists are met together."""
        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
        new = set().union(*pieces).difference(known)
        if new:
            self._meet(new)
        for words in pieces:
            yield b"".join(map(known.__getitem__, words))

    def encode(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers, the end id included; long texts go by segments."""
        raw, out, start = (text or "").encode("utf-8", "replace"), [], 0
        while start < len(raw):
            stop = len(raw)
            if stop - start > SEGMENT:
                cut = _SPACE.search(raw, start + SEGMENT)
                stop = cut.start() if cut else stop
            out += self._ids_of([self._words(raw[start:stop])])
            start = stop
        return b"".join(out) + END

    def encode_all(self, texts) -> Iterator[bytes]:
        """:meth:`encode` of each text, about ``TOGETHER`` bytes at a time."""
        held, size = [], 0
        for text in texts:
            raw = (text or "").encode("utf-8", "replace")
            if len(raw) > SEGMENT:
                yield from (ids + END for ids in self._ids_of(held))
                held, size = [], 0
                yield self.encode(text)
                continue
            held.append(self._words(raw))
            size += len(raw)
            if size > TOGETHER:
                yield from (ids + END for ids in self._ids_of(held))
                held, size = [], 0
        yield from (ids + END for ids in self._ids_of(held))


def cut(ids: bytes, capacity: int = CAPACITY) -> list[dict]:
    size = 4 * capacity
    return [dict(piece=k, start=k * capacity, length=len(part) // 4, ids_crc32=zlib.crc32(part))
            for k, part in enumerate(ids[i:i + size] for i in range(0, len(ids), size))]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """A row for each piece of each document, with a number ``uid`` of its own."""

    @F.pandas_udf(PIECES)
    def pieces_of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if tokenizer_path not in _encoders:  # a Python worker keeps its words from task to task
            _encoders[tokenizer_path] = Encoder(tokenizer_path)
        encoder = _encoders[tokenizer_path]
        for s in texts:
            yield pd.Series([cut(ids, capacity) for ids in encoder.encode_all(s)])

    rows = docs.select("doc_id", F.explode(pieces_of.asNondeterministic()("text")).alias("p")).select("doc_id", "p.*")
    return rows.withColumn("uid", F.monotonically_increasing_id())


# ------------------------------------------------------------------ one block
def best_fit(order: list[int], lengths: list[int], bins: list[list], capacity: int) -> list[list]:
    """Put the pieces of ``order`` into ``bins`` (lists of [fill, pieces]), each where it leaves the least room."""
    room = sorted((capacity - b[0], i) for i, b in enumerate(bins))
    for item in order:
        size = lengths[item]
        k = bisect_left(room, (size, -1))
        if k == len(room):
            bins.append([size, [item]])
            insort(room, (capacity - size, len(bins) - 1))
        else:
            free, i = room.pop(k)
            bins[i][0] += size
            bins[i][1].append(item)
            insort(room, (free - size, i))
    return bins


def bins_of(packing: list[int], lengths: list[int]) -> list[list]:
    bins: dict[int, list] = {}
    for item, b in enumerate(packing):
        got = bins.setdefault(b, [0, []])
        got[0] += lengths[item]
        got[1].append(item)
    return list(bins.values())


def packing_of(bins: list[list], n: int) -> list[int]:
    out = [0] * n
    for b, (_, items) in enumerate(bins):
        for item in items:
            out[item] = b
    return out


def cost(bins: list[list]) -> tuple[int, int]:
    """Fewer bins first, then fuller ones."""
    return len(bins), -sum(b[0] * b[0] for b in bins)


def trade(bins: list[list], displaced: list[int], lengths: list[int], capacity: int) -> list[int]:
    """Each bin that is not full gives one piece for the displaced one that leaves it the least room; the pieces now displaced."""
    free = sorted((lengths[i], i) for i in displaced)
    for b in bins:
        room, best = capacity - b[0], (0, 0, 0)
        for at, item in enumerate(b[1]) if room else ():
            k = bisect_left(free, (lengths[item] + room + 1, -1)) - 1
            if k >= 0:
                best = max(best, (free[k][0] - lengths[item], at, k))
            if best[0] == room:
                break
        gain, at, k = best
        if gain:
            _, new = free.pop(k)
            old, b[1][at] = b[1][at], new
            b[0] += gain
            insort(free, (lengths[old], old))
    return [i for _, i in free]


def crossover(a: list[list], b: list[list], lengths: list[int], capacity: int, rng: random.Random) -> list[list]:
    """Inject a run of ``b``'s well-filled bins into ``a`` whole; trade and best-fit what that displaces."""
    full = [x for x in b if x[0] >= 0.98 * capacity] or b
    lo = rng.randrange(len(full))
    run = full[lo:lo + 1 + rng.randrange(max(1, len(full) // 2))]
    taken = {i for x in run for i in x[1]}
    kept, displaced = [], []
    for x in a:
        if taken.isdisjoint(x[1]):
            kept.append([x[0], list(x[1])])
        else:
            displaced += [i for i in x[1] if i not in taken]
    # the emptiest bins left are dissolved too, so that their pieces can fill the gaps
    kept.sort(key=lambda x: -x[0])
    for x in kept[-max(1, len(kept) // 20):]:
        displaced += x[1]
    kept = kept[:len(kept) - max(1, len(kept) // 20)] if kept else kept
    displaced = trade(kept, displaced, lengths, capacity)
    child = kept + [[x[0], list(x[1])] for x in run]
    displaced.sort(key=lambda i: -lengths[i])
    return best_fit(displaced, lengths, child, capacity)


def evolve(lengths: list[int], population: list[list[int]], capacity: int, seed: int,
           size: int = POPULATION, generations: int = GENERATIONS) -> list[list[int]]:
    """The next population of one island, best first; an empty one starts from best-fit packings of several orders."""
    rng, n = random.Random(seed), len(lengths)
    least = -(-sum(lengths) // capacity)
    alive = [bins_of(p, lengths) for p in population]
    if not alive:
        alive = [best_fit(sorted(range(n), key=lambda i: (-lengths[i], i)), lengths, [], capacity)]
        while len(alive) < size and len(alive[0]) > least:
            jitter = [x * rng.uniform(0.9, 1.1) for x in lengths]
            alive.append(best_fit(sorted(range(n), key=lambda i: -jitter[i]), lengths, [], capacity))
    alive.sort(key=cost)
    since = 0  # generations since the fewest bins last fell
    for _ in range(generations):
        if len(alive[0]) <= least or len(alive) < 2 or since == STALLED:
            break
        young, fewest = [], len(alive[0])
        for _ in range(size):
            a, b = rng.sample(range(len(alive)), 2)
            young.append(crossover(alive[min(a, b)], alive[max(a, b)], lengths, capacity, rng))
        alive = sorted(alive + young, key=cost)[:size]
        since = since + 1 if len(alive[0]) == fewest else 0
    return [packing_of(x, n) for x in alive]


# ------------------------------------------------------------------ all blocks
def _pack_level(items: DataFrame, blocks: int, capacity: int, seed: int) -> DataFrame:
    """(uid, length, block, bin, fill) of pieces (uid, length) packed within ``blocks`` random blocks."""
    rows = items.withColumn("block", F.pmod(F.xxhash64("uid", F.lit(seed)), F.lit(blocks)))
    state = (rows.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("length", "uid")), asc=False).alias("i"))
             .select("block", F.col("i.uid").alias("uids"), F.col("i.length").alias("lengths"),
                     F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"),
                     F.expr("cast(array() as array<array<int>>)").alias("population")))
    schema = state.schema

    def epoch(number: int):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in batches:
                frame["population"] = [
                    evolve(list(map(int, l)), [list(map(int, p)) for p in pop], capacity, seed + 7919 * int(b) + 104729 * int(i) + number)
                    for b, i, l, pop in zip(frame["block"], frame["island"], frame["lengths"], frame["population"])]
                yield frame
        return run

    for number in range(EPOCHS):
        if number:  # each island's worst gives way to the elite of the one before it in the ring
            ring = W.partitionBy("block").orderBy("island")
            elite = F.col("population")[0]
            last = F.last(elite).over(ring.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
            state = state.withColumn("population", F.concat(
                F.array(F.coalesce(F.lag(elite).over(ring), last)), F.slice("population", 1, POPULATION - 1)))
        state = state.repartition("block", "island").mapInPandas(epoch(number), schema)
    best = state.withColumn("packing", F.col("population")[0]).groupBy("block").agg(
        F.min_by(F.struct("uids", "lengths", "packing"), F.struct(F.array_max("packing"), "island")).alias("s"))
    flat = best.select("block", F.explode(F.arrays_zip(F.col("s.uids").alias("uid"), F.col("s.lengths").alias("length"),
                                                       F.col("s.packing").alias("bin"))).alias("z")).select("block", "z.*")
    in_bin = W.partitionBy("block", "bin")
    return flat.select("uid", "length", "block", "bin", F.sum("length").over(in_bin).alias("fill"),
                       (F.sum("length").over(in_bin.orderBy(F.desc("length"), "uid").rowsBetween(W.unboundedPreceding, 0)) - F.col("length")).alias("offset"))


def pack(piece_rows: DataFrame, capacity: int = CAPACITY, block_items: int = BLOCK_ITEMS, seed: int = 11) -> DataFrame:
    """``piece_rows`` (stored, with ``uid`` and ``length``) with ``sequence_id`` and ``offset``."""
    short = piece_rows.where(F.col("length") < capacity).select("uid", "length")
    places, level = None, 0
    left = short.count()
    while left:
        blocks = -(-left // block_items)
        packed = stored(_pack_level(short, blocks, capacity, seed + level), f"packed{level}")
        open_bins = packed.where(F.col("fill") < SETTLED * capacity)
        was, left = left, open_bins.count()
        final = blocks == 1 or left > (1 - PROGRESS) * was
        done = packed if final else packed.where(F.col("fill") >= SETTLED * capacity)
        # each level lowers the pieces by PROGRESS at least: 2^7 levels, 2^36 blocks and 2^20 bins a block do not meet
        number = F.lit(level << 56).cast("long") + F.col("block").cast("long") * (1 << 20) + F.col("bin")
        done = done.select("uid", number.alias("sequence_id"), "offset")
        places = done if places is None else places.unionByName(done)
        if final:
            break
        short, level = open_bins.select("uid", "length"), level + 1
    whole = piece_rows.where(F.col("length") >= capacity).withColumn("sequence_id", -F.col("uid") - 1).withColumn("offset", F.lit(0).cast("long"))
    if places is None:
        return whole
    return piece_rows.where(F.col("length") < capacity).join(places, "uid").unionByName(whole)


def pack_documents(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Tokenise, cut and pack whole documents; one row a piece."""
    rows = stored(pieces(docs, tokenizer_path), "pieces")
    return pack(rows).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op5_grouping_genetic_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_tokenizer())
