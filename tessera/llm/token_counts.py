"""Token counts of whole texts through compiled finite-state transducers.

A byte-level BPE tokenizer file is compiled into two deterministic transducers, whose transitions carry what they emit:

* ``Splitter`` reads characters as classes (letter, number, blank, ..., with a look-ahead of two characters folded into
  the class) in nine states; a transition emits 1 where a pre-token starts.  A text is cut into chunks of fixed
  length, wherever that falls.  Every chunk yields its state map, from each of the nine entry states to the exit state,
  all chunks at once; a parallel prefix scan composes the maps, which gives each chunk its entry state, and a second
  sweep emits the starts.
* ``Merger`` reads the bytes of one pre-token.  Its state holds, for each place from which a longer token may still be
  spelt, the node of the vocabulary's trie, the last token before that place and the tokens emitted since; a
  transition is annotated with the change of the token count (a merge takes tokens back).  Exactly one token can end
  at each place, the one whose pair with the token before it survives its own merging.  States are made when first
  reached (the automaton of all of them is finite but far larger than any text needs) and the count of a whole
  pre-token is remembered.  Beyond ``MAX_STATES`` or ``MAX_WORDS`` the tables start anew, which changes no count.

Characters get their class from the tokenizer library itself, one probe for each distinct character.  Texts are cut
at special tokens first, as the library does.  Nothing is shuffled or kept; a task's memory is bounded by its Arrow batch, the
tables and about 20 bytes a character of its longest text.

Defined cases: a null text counts as empty (0 bytes, 0 tokens); repeated rows are each counted; a null ``doc_id``
is as good as any; an empty table gives an empty result; very long texts are read whole; other columns pass through, but
columns named like the outputs are replaced.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 1024
CHUNK = 256
GROUP = 1 << 20
SLAB = 1 << 19
MAX_STATES = 200_000
MAX_WORDS = 500_000
ZERO = 1 << 19  # of the signed number in a place's low 20 bits
REMEMBERED = 64  # bytes of a pre-token whose count is remembered

# Character classes.  "Then" classes look at what follows: a blank before a non-blank, an apostrophe before
# a contraction of one or two letters.
LETTER, NUMBER, OTHER, SPACE_THEN, SPACE, BLANK_THEN, BLANK, QUOTE, QUOTE_1, QUOTE_2, NONE = range(11)
# States: a pre-token has just ended; in letters, numbers, others, blanks; after a leading space; one or two characters to go.
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_BLANKS, LED, ONE_TO_GO, TWO_TO_GO, LAST_TO_GO = range(9)
STATES = 9


def _splitter_tables() -> tuple[np.ndarray, np.ndarray]:
    """``next[class, state]`` and ``emits[class, state]``; classes from ``NONE + 1`` on first begin a new text."""
    after = np.zeros((NONE, STATES), dtype=np.uint8)
    starts = np.ones((NONE, STATES), dtype=bool)
    after[LETTER], after[NUMBER] = IN_LETTERS, IN_NUMBERS
    after[[OTHER, QUOTE]] = IN_OTHERS
    after[QUOTE_1], after[QUOTE_2] = ONE_TO_GO, TWO_TO_GO
    after[SPACE_THEN], after[BLANK_THEN] = LED, FRESH
    after[[SPACE, BLANK]] = IN_BLANKS
    quotes = [OTHER, QUOTE, QUOTE_1, QUOTE_2]
    after[quotes, IN_OTHERS] = after[quotes, LED] = IN_OTHERS
    starts[quotes, IN_OTHERS] = starts[quotes, LED] = False
    starts[LETTER, [IN_LETTERS, LED, ONE_TO_GO, TWO_TO_GO, LAST_TO_GO]] = False
    after[LETTER, [ONE_TO_GO, LAST_TO_GO]], after[LETTER, TWO_TO_GO] = FRESH, LAST_TO_GO
    starts[NUMBER, [IN_NUMBERS, LED]] = False
    starts[[SPACE, BLANK], IN_BLANKS] = False
    # a pad keeps every state; a text's first character is read from FRESH whatever the state before
    after = np.vstack([after, np.arange(STATES, dtype=np.uint8)[None], np.repeat(after[:, [FRESH]], STATES, axis=1)])
    starts = np.vstack([starts, np.zeros((1, STATES), dtype=bool), np.repeat(starts[:, [FRESH]], STATES, axis=1)])
    return after, starts


AFTER, STARTS = _splitter_tables()
FIRST = NONE + 1


def compose_scan(maps: np.ndarray) -> np.ndarray:
    """Inclusive prefix compositions of state maps ``(chunks, states)`` by doubling: row i is map 0, then 1, ... then i."""
    out, step = maps.copy(), 1
    while step < len(out):
        out[step:] = np.take_along_axis(out[step:], out[:-step].astype(np.intp), axis=1)
        step *= 2
    return out


class Splitter:
    """Where the pre-tokens of texts start."""

    def __init__(self, tokenizer):
        self.pre = tokenizer.pre_tokenizer
        self.kind = np.full(0x110000, NONE, dtype=np.uint8)

    def _probe(self, code: int) -> int:
        c = chr(code)
        if c in " '":
            return SPACE if c == " " else QUOTE
        for lead, found in (("a", LETTER), ("1", NUMBER), ("!", OTHER)):
            if len(self.pre.pre_tokenize_str(lead + c)) == 1:
                return found
        return BLANK

    def _classes(self, codes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Classes of characters; ``first`` marks those that begin a text (one more entry than characters, the end)."""
        kind = self.kind[codes]
        new = np.unique(codes[kind == NONE])
        if len(new):
            self.kind[new] = [self._probe(int(c)) for c in new]
            kind = self.kind[codes]
        n = len(kind)
        follows = np.full(n + 2, NONE, dtype=np.uint8)  # class of the next character in the same text
        follows[:n - 1] = kind[1:]
        follows[:n][first[1:]] = NONE
        ahead = (follows[:n] != NONE) & (follows[:n] != SPACE) & (follows[:n] != BLANK)
        out = kind.copy()
        out[(kind == SPACE) & ahead] = SPACE_THEN
        out[(kind == BLANK) & ahead] = BLANK_THEN
        for i in np.flatnonzero(kind == QUOTE):
            if follows[i] == LETTER:
                one = chr(codes[i + 1])
                if one in "stmd":
                    out[i] = QUOTE_1
                elif follows[i + 1] == LETTER and one + chr(codes[i + 2]) in ("re", "ve", "ll"):
                    out[i] = QUOTE_2
        return np.where(first[:-1], out + FIRST, out)

    def starts(self, codes: np.ndarray, first: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
        """Positions at which pre-tokens start."""
        n = len(codes)
        chunks = -(-n // chunk)
        cls = np.full(chunks * chunk, NONE, dtype=np.uint8)
        cls[:n] = self._classes(codes, first)
        cls = np.ascontiguousarray(cls.reshape(chunks, chunk).T)
        maps = np.repeat(np.arange(STATES, dtype=np.uint8)[None], chunks, axis=0)
        flat = AFTER.ravel()
        for row in cls:
            maps = flat[row[:, None].astype(np.int32) * STATES + maps]
        state = np.zeros(chunks, dtype=np.uint8)
        state[1:] = compose_scan(maps)[:-1, FRESH]
        emitted = np.empty((chunk, chunks), dtype=bool)
        flat_starts = STARTS.ravel()
        for j, row in enumerate(cls):
            at = row.astype(np.int32) * STATES + state
            emitted[j], state = flat_starts[at], flat[at]
        return np.flatnonzero(emitted.T.ravel()[:n])


def byte_letters() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 stands for itself, other bytes for the letters from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merger:
    """Token counts of pre-tokens."""

    def __init__(self, vocab: dict[str, int], merges: list):
        letter = byte_letters()
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.rank = {(vocab[a], vocab[b]): (i, vocab[a + b]) for i, (a, b) in enumerate(pairs)}
        self.parts = {whole: (i, a, b) for (a, b), (i, whole) in self.rank.items()}  # when a token is merged, and of what
        self.spelt = {i: bytes(letter[c] for c in t) for t, i in vocab.items() if all(c in letter for c in t)}
        self.byte_id = {b[0]: i for i, b in self.spelt.items() if len(b) == 1}
        self.trie, self.token = {}, [-1]
        for i, b in self.spelt.items():
            node = 0
            for x in b:
                key = node << 8 | x
                node = self.trie.get(key)
                if node is None:
                    node = self.trie[key] = len(self.token)
                    self.token.append(-1)
            self.token[node] = i
        self.inner = {k >> 8 for k in self.trie}
        self.survives: dict[tuple[int, int], bool] = {}
        self.words: dict[bytes, int] = {}
        self._anew()

    def _anew(self) -> None:
        # a state is, longest first, the live places: trie node << 40 | last token before the place + 1 << 20 | tokens emitted since + ZERO
        self.states: list[tuple[int, ...]] = [(ZERO,)]
        self.number = {self.states[0]: 0}
        self.moves: dict[int, tuple[int, int]] = {}  # state << 8 | byte: state after, tokens emitted
        self.shared: dict[tuple[int, int], tuple[int, int]] = {}

    def merged(self, spelling: bytes) -> list[int]:
        """Ids by merging the pair of lowest rank again and again."""
        ids = [self.byte_id[x] for x in spelling]
        while len(ids) > 1:
            best = min((self.rank[p][0], k) for k, p in enumerate(zip(ids, ids[1:])) if p in self.rank) if any(
                p in self.rank for p in zip(ids, ids[1:])) else None
            if best is None:
                break
            k = best[1]
            ids[k:k + 2] = [self.rank[ids[k], ids[k + 1]][1]]
        return ids

    def _fits(self, before: int, token: int) -> bool:
        """Whether ``token`` stays as it is at a pre-token's start (``before`` -1) or after the token ``before``."""
        known = self.survives.get((before, token))
        if known is None:
            known = self.merged(self.spelt[token]) == [token] if before < 0 else self._fits(-1, token) and self._apart(before, token)
            self.survives[before, token] = known
        return known

    def _apart(self, left: int, right: int) -> bool:
        """Whether two tokens that survive alone do so side by side.

        Their merges are undone, the latest first (of equal ones the right one, as merging goes from the left); no pair
        that meets at the border meanwhile may have been due before the merge that parted it.
        """
        due = len(self.rank)
        while True:
            pair = self.rank.get((left, right))
            if pair is not None and pair[0] < due:
                return False
            a, b = self.parts.get(left), self.parts.get(right)
            if a is None and b is None:
                return True
            if b is None or (a is not None and a[0] > b[0]):
                due, left = a[0], a[2]
            else:
                due, right = b[0] + 1, b[1]

    def _move(self, state: int, byte: int) -> tuple[int, int]:
        live, last, emitted = [], -1, 0
        for place in self.states[state]:
            to = self.trie.get((place >> 40) << 8 | byte)
            if to is None:
                continue
            before, since = place >> 20 & 0xFFFFF, (place & 0xFFFFF) - ZERO
            if last < 0 and self.token[to] >= 0 and self._fits(before - 1, self.token[to]):
                last, emitted = self.token[to], 1 - since
            if to in self.inner:
                live.append(to << 40 | before << 20 | since + ZERO)
        key = (*[place + emitted for place in live], last + 1 << 20 | ZERO)
        after = self.number.get(key)
        if after is None:
            after = self.number[key] = len(self.states)
            self.states.append(key)
        move = (after, emitted)
        self.moves[state << 8 | byte] = move = self.shared.setdefault(move, move)
        return move

    def count(self, word: bytes) -> int:
        if len(self.states) > MAX_STATES:
            self._anew()
        if len(self.survives) > MAX_WORDS:
            self.survives.clear()
        state, n, moves = 0, 0, self.moves
        for byte in word:
            state, emitted = moves.get(state << 8 | byte) or self._move(state, byte)
            n += emitted
        if len(self.words) >= MAX_WORDS:
            self.words.clear()
        if len(word) <= REMEMBERED:
            self.words[word] = n
        return n


class Counter:
    """A compiled tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        plain = (model["type"] == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
                 and not spec["normalizer"] and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
                 and all(not (t["single_word"] or t["lstrip"] or t["rstrip"]) for t in spec["added_tokens"]))
        if not plain:
            raise ValueError(f"{path}: only byte-level BPE files without normalizer, prefix space or word ends can be compiled")
        self.splitter = Splitter(Tokenizer.from_file(path))
        self.merger = Merger(model["vocab"], model["merges"])
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None

    def _pieces(self, text: str) -> list[str]:
        return self.special.split(text) if self.special and self.special.search(text) else [text]

    def _group(self, pieces: list[str]) -> np.ndarray:
        """Tokens of each piece."""
        whole = "".join(pieces)
        sizes = np.array([len(p) for p in pieces], dtype=np.int64)
        out = np.zeros(len(pieces), dtype=np.int64)
        if not whole:
            return out
        codes = np.frombuffer(whole.encode("utf-32-le"), dtype=np.uint32)
        ends = np.cumsum(sizes)
        first = np.zeros(len(codes) + 1, dtype=bool)
        first[ends], first[0] = True, True
        starts = self.splitter.starts(codes, first)
        raw = whole.encode()
        if len(raw) == len(codes):
            at = np.append(starts, len(codes))
        else:
            width = np.ones(len(codes) + 1, dtype=np.int64)
            for least in (0x80, 0x800, 0x10000):
                width[:-1] += codes >= least
            at = (np.cumsum(width) - width)[np.append(starts, len(codes))]
        known, count = self.merger.words, self.merger.count
        piece_of = np.searchsorted(ends, starts, side="right")
        for a in range(0, len(starts), SLAB):
            cut = at[a:a + SLAB + 1].tolist()
            words = [raw[x:y] for x, y in zip(cut, cut[1:])]
            n = [known.get(w) or count(w) for w in words]
            out += np.bincount(piece_of[a:a + SLAB], weights=n, minlength=len(pieces)).astype(np.int64)
        return out

    def counts(self, texts: list[str | None]) -> np.ndarray:
        """Tokens of each text."""
        total = np.zeros(len(texts), dtype=np.int64)
        group: list[str] = []
        owner: list[int] = []
        size = 0

        def close():
            if group:
                np.add.at(total, owner, self._group(group))
                group.clear()
                owner.clear()

        for i, t in enumerate(texts):
            pieces = self._pieces(t or "")
            total[i] += len(pieces) - 1
            if size and size + len(t or "") > GROUP:
                close()
                size = 0
            group.extend(pieces)
            owner.extend([i] * len(pieces))
            size += len(t or "")
        close()
        return total


_counters: dict[str, Counter] = {}


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` of the column ``text``; no shuffle."""

    @F.pandas_udf("long")
    def counted(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = _counters.get(tokenizer_path)
        if counter is None:
            counter = _counters[tokenizer_path] = Counter(tokenizer_path)
        for s in texts:
            yield pd.Series(counter.counts([t if isinstance(t, str) else None for t in s]))

    return (docs.withColumn("n_bytes", F.octet_length(F.coalesce("text", F.lit(""))).cast("long"))
            .withColumn("n_tokens", counted.asNondeterministic()("text")).withColumn("over_limit", F.col("n_tokens") > limit))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op11_transducer_token_counts(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return token_counts(docs, default_tokenizer()).select("doc_id", "n_bytes", "n_tokens", "over_limit")
