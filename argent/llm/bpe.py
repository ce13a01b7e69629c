"""Byte-level BPE encoding and decoding with a pair occurrence index.

Each task cuts its texts into pretokens, keeps every distinct pretoken once
and encodes the new ones together: an index maps each mergeable pair (its
rank) to all the places where it occurs in the partition's distinct pretokens;
the active ranks are taken in ascending order, a rank is applied at all its
places at once, and the lists of the pairs that this creates are extended.
Within one pretoken this is the lowest-rank-first, leftmost-first rule of
byte-level BPE, because pretokens never merge with each other. A document's
ids are then looked up pretoken by pretoken, and decoded again from the ids.

The vocabulary file is a parameter (its path); it ships to each task as a
broadcast of its text, about 1.4 MB whatever the input size. Special tokens
in a text are found first and become their own id.

Defined results: a NULL text counts as empty (no ids, empty decoded text);
texts of any length are encoded whole; equal texts get equal results; every
row keeps its own output row; an empty table gives an empty result. Only the
text and the columns named as ``keep`` are read.
"""

from __future__ import annotations

import heapq
import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from argent.llm.common import ship, table, tidy

#: Distinct pretokens a task remembers before it starts anew.
REMEMBERED = 200_000
#: Characters of text cut into pretokens before the new ones are encoded.
CHUNK_CHARS = 12_000_000


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in the vocabulary:
    printable bytes for themselves, the others from U+0100 upwards."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}


class Vocabulary:
    """Ids, merge ranks and special tokens of a byte-level BPE file."""

    def __init__(self, text: str, pattern: str):
        data = json.loads(text)
        letters = byte_letters()
        byte_of = {c: b for b, c in letters.items()}
        ids = data["model"]["vocab"]
        self.bytes_of = {i: bytes(byte_of[c] for c in t) for t, i in ids.items()}
        self.special = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        for t, i in self.special.items():
            self.bytes_of[i] = t.encode()
        self.first = np.zeros(256, np.int64)
        for b, c in letters.items():
            self.first[b] = ids[c]
        left, right, made = [], [], []
        for merge in data["model"]["merges"]:
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            left.append(ids[a]), right.append(ids[b]), made.append(ids[a + b])
        self.left, self.right, self.made = left, right, made
        keys = (np.array(left, np.int64) << 32) | np.array(right, np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank_at = keys[order], order
        self.pattern = regex.compile(pattern)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where the pair never merges."""
        want = (a << 32) | b
        at = np.searchsorted(self.keys, want)
        at[at == len(self.keys)] = 0
        return np.where((self.keys[at] == want) & (a >= 0) & (b >= 0), self.rank_at[at], -1)

    def encode(self, words: list[str]) -> list[list[int]]:
        """Ids of each pretoken, all merged together over one pair index."""
        raw = [w.encode() for w in words]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        if not sizes.sum():
            return [[] for _ in words]
        # one slot per byte and a wall (-1) after each word; merged slots are unlinked
        ends = np.cumsum(sizes + 1)
        joined = np.frombuffer(b"\0".join(raw) + b"\0", np.uint8)
        token = self.first[joined]
        token[ends - 1] = -1
        n = len(token)
        after = np.arange(1, n + 1)
        after[-1] = n - 1
        before = np.arange(-1, n - 1)
        before[0] = n - 1  # the last slot is a wall
        places: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def index(at: np.ndarray) -> None:
            """Add the pairs that begin at ``at`` to the index."""
            rank = self.ranks(token[at], token[after[at]])
            keep = rank >= 0
            if not keep.any():
                return
            rank, at = rank[keep], at[keep]
            order = np.argsort(rank, kind="stable")
            rank, at = rank[order], at[order]
            starts = [0, *(np.flatnonzero(rank[1:] != rank[:-1]) + 1).tolist(), len(at)]
            for k, r in enumerate(rank[starts[:-1]].tolist()):
                part = at[starts[k]:starts[k + 1]]
                if r in places:
                    places[r].append(part)
                else:
                    places[r] = [part]
                    heapq.heappush(active, r)

        index(np.arange(n - 1))
        while active:
            r = heapq.heappop(active)
            lists = places.pop(r)
            at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            a, b = self.left[r], self.right[r]
            right = after[at]
            at = at[(token[at] == a) & (token[right] == b)]
            if not len(at):
                continue
            if a == b and len(at) > 1:
                at = _leftmost(np.sort(at), after)
            right = after[at]
            token[at] = self.made[r]
            token[right] = -2
            beyond = after[right]
            after[at] = beyond
            before[beyond] = at
            prior = before[at]
            index(np.unique(np.concatenate((at, prior[token[prior] >= 0]))))
        alive = token >= 0
        counts = np.add.reduceat(alive, np.concatenate(([0], ends[:-1])))
        flat = token[alive].tolist()
        out, at = [], 0
        for c in counts.tolist():
            out.append(flat[at:at + c])
            at += c
        return out

    def decode(self, ids: list[int]) -> str:
        """Text of the ids; bytes that are no UTF-8 become U+FFFD."""
        return b"".join([self.bytes_of[i] for i in ids]).decode("utf-8", "replace")


def _leftmost(at: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of places whose pairs overlap (x x x), those that merge from the left."""
    keep, taken = [], -1
    for p, q in zip(at.tolist(), after[at].tolist()):
        if p != taken:
            keep.append(p)
            taken = q
    return np.array(keep, np.int64)


class Encoder(dict):
    """Pretoken -> number; its ids (as text) and decoded text are kept by number."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary, self.new, self.ids, self.text = vocabulary, [], [], []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number

    def cut(self, text: str) -> array:
        v = self.vocabulary
        if v.cut and v.cut.search(text):
            numbers = array("i")
            for piece in v.cut.split(text):
                if piece in v.special:
                    numbers.append(self.__getitem__((piece,)))  # a tuple: never equal to a pretoken
                else:
                    numbers.extend([self[w] for w in v.pattern.findall(piece)])
            return numbers
        return array("i", [self[w] for w in v.pattern.findall(text)])

    def settle(self) -> None:
        """Encode the pretokens that are new since the last call."""
        v = self.vocabulary
        plain = v.encode([w for w in self.new if isinstance(w, str)])
        following = iter(plain)
        for w in self.new:
            ids = next(following) if isinstance(w, str) else [v.special[w[0]]]
            self.ids.append(",".join(map(str, ids)))
            text = v.decode(ids)
            self.text.append(w if text == w else text)
        self.new = []


_VOCABULARIES: dict[int, Vocabulary] = {}


def _vocabulary(text: str, pattern: str) -> Vocabulary:
    """The parsed vocabulary, kept by the worker: its size is fixed."""
    key = hash((text, pattern))
    if key not in _VOCABULARIES:
        _VOCABULARIES[key] = Vocabulary(text, pattern)
    return _VOCABULARIES[key]


def _chunks(texts: list[str | None]) -> Iterator[list[str]]:
    """Consecutive texts, about ``CHUNK_CHARS`` together."""
    part, size = [], 0
    for t in texts:
        part.append(t or "")
        size += len(part[-1])
        if size >= CHUNK_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


def tokenized(df: DataFrame, text: str, keep: list[str], vocabulary_json: str, pattern: str) -> DataFrame:
    """Columns ``keep`` of every row with ``ids`` (comma-separated decimal
    ids), ``n_tokens`` and ``decoded`` (the text decoded from the ids)."""
    ship(df.sparkSession)
    schema = df.select(*keep).schema
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    shared = df.sparkSession.sparkContext.broadcast(vocabulary_json)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # what a task has met goes with it: a worker runs tasks of many stages
        encoder = Encoder(_vocabulary(shared.value, pattern))
        for batch in batches:
            row = 0
            for texts in _chunks(batch.column(0).to_pylist()):
                if len(encoder) > REMEMBERED:
                    encoder = Encoder(encoder.vocabulary)
                cuts = [encoder.cut(t) for t in texts]
                encoder.settle()
                ids = [",".join([encoder.ids[k] for k in c]) for c in cuts]
                decoded = ["".join([encoder.text[k] for k in c]) for c in cuts]
                kept = batch.slice(row, len(texts)).select(range(1, batch.num_columns))
                row += len(texts)
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns, pa.array([i.count(",") + 1 if i else 0 for i in ids], pa.int64()),
                     pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                    names=[*kept.schema.names, "n_tokens", "ids", "decoded"])

    return df.select(F.col(text).alias("_text"), *keep).mapInArrow(
        run, f"{fields}, n_tokens long, ids string, decoded string")


def load_vocabulary(path: str) -> str:
    """Text of the vocabulary file, read on the driver (a file of fixed size)."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def digests(df: DataFrame, text: str, keep: list[str], path: str, pattern: str) -> DataFrame:
    out = tokenized(df, text, keep, load_vocabulary(path), pattern)
    return out.select(*keep, "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(table(spark, sf_dir, "documents"), "text", ["doc_id"],
                   public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
