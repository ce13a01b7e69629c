"""Language identification by unigrams marginalised over all segmentations.

A text is the sequence of its words: runs of letters (with their combining
marks), in lower case, each with the vocabulary's word mark in front. The pieces are those of a fixed
public vocabulary; a letter that is no piece stands as its UTF-8 bytes, which
are. In a language every piece has a probability, and a word's probability is
the sum over all its segmentations of the product of its pieces' probabilities,
which a forward pass over the word's lattice adds up. A text's score per
language is the log share of its training documents plus the words' log probabilities.

Training is expectation maximisation from equal piece probabilities: words are
counted per language over all training documents (counted in the tasks, summed
by Spark), and every round adds up each piece's expected count by a forward and a backward pass
over the distinct words. Only these sums go to the driver: vocabulary size x
languages, whatever the corpus size. A piece's probability is mixed
with an equal share (``FLOOR``), so no word is impossible. The table
of probabilities takes 0.26 MB a language in each worker.

A run of letters is cut every ``SYMBOLS`` symbols, so no product underflows.
Tasks remember up to ``REMEMBERED`` different tokens and their scores.

Defined results: ``und`` and score 0 if the text is NULL or has no letter, or
if nothing was learned; texts of any length count whole; equal texts get equal
results; every row keeps its own row; ties go to the first language in order;
a NULL id counts as empty text in the split; an empty table gives an empty
result. The score is the posterior probability of the predicted language. Only the id, text and language
are read, so other columns may have any name.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from argent.llm.common import landed, ship, table

#: A letter and what belongs to its run.
LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
#: Word mark of the vocabulary.
MARK = "▁"
#: Symbols after which a run of letters is cut.
SYMBOLS = 32
#: Share of each language's probability that all pieces have equally.
FLOOR = 1e-4
#: Rounds of expectation maximisation.
ROUNDS = 3
#: Different tokens that a task remembers before it starts anew.
REMEMBERED = 300_000
#: Words of a language that go through the passes together.
TOGETHER = 50_000
#: Expected counts are added up as whole multiples of 1 / UNIT, so that sums don't depend on their order.
UNIT = 1024
UNDEFINED = "und"
_U = np.uint64
_STEP, _SPREAD = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9)
_BYTE = 0x110000  # symbols of bytes follow the code points


def load_pieces(path: str) -> list[str | int]:
    """The vocabulary's pieces by id: text, or the value of a byte piece.
    Control pieces never match, so they are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    out = []
    for i in range(model.get_piece_size()):
        if model.is_byte(i):
            out.append(int(model.id_to_piece(i)[1:-1], 16))
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            out.append(model.id_to_piece(i))
    return out


class Lattice:
    """Finds the pieces of words and runs the passes over their segmentations."""

    def __init__(self, pieces: list[str | int]):
        pieces = list(pieces)
        have = {p for p in pieces if isinstance(p, int)}
        pieces += [b for b in range(256) if b not in have]  # any letter can be written
        self.size = len(pieces)
        self.known = np.zeros(_BYTE, bool)  # code points that are pieces
        self.known[[ord(p) for p in pieces if isinstance(p, str) and len(p) == 1]] = True
        if MARK not in pieces:
            pieces.append(MARK)
            self.size += 1
        symbols = [[_BYTE + p] if isinstance(p, int) else [ord(c) for c in p] for p in pieces]
        self.longest = max(map(len, symbols))
        keys = np.zeros(self.size, _U)
        for k in range(self.longest):
            at = np.array([i for i, s in enumerate(symbols) if len(s) > k])
            keys[at] = (keys[at] + np.array([symbols[i][k] for i in at], _U) + _U(1)) * _STEP
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self._slot(keys)] = True

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return ((keys * _SPREAD) >> _U(44)).astype(np.int64)

    def symbols(self, word: str) -> list[list[int]]:
        """The word's symbols, cut into runs of at most SYMBOLS."""
        out = [ord(MARK)]
        for c in word:
            out.extend([ord(c)] if self.known[ord(c)] else [_BYTE + b for b in c.encode("utf-8", "replace")])
        return [out[k:k + SYMBOLS] for k in range(0, len(out), SYMBOLS)]

    def edges(self, codes: np.ndarray) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        """(begin, end, rows, pieces) of the pieces in words of one length (rows of symbols)."""
        n, out = codes.shape[1], []
        for i in range(n):
            h = np.zeros(len(codes), _U)
            for j in range(i + 1, min(n, i + self.longest) + 1):
                h = (h + codes[:, j - 1] + _U(1)) * _STEP
                rows = np.flatnonzero(self.maybe[self._slot(h)])
                if not len(rows):
                    continue
                at = np.searchsorted(self.keys, h[rows])
                at[at == self.size] = 0
                hit = self.keys[at] == h[rows]
                if hit.any():
                    out.append((i, j, rows[hit], self.order[at[hit]]))
        return out

    def grouped(self, words: list[str], languages: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(words, symbols) of words of one length, some thousands at a time; a
        word that is cut comes once per run, never twice in one group."""
        most = max(64, 2_000_000 // ((SYMBOLS + 1) * max(1, languages)))
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        rest = np.flatnonzero(lengths >= SYMBOLS).tolist()
        for n in np.unique(lengths[lengths < SYMBOLS]).tolist():
            places = np.flatnonzero(lengths == n)
            for k in range(0, len(places), most):
                some = places[k:k + most]
                text = "".join([words[i] for i in some.tolist()])
                codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(some), n)
                plain = self.known[codes].all(axis=1)
                rest += some[~plain].tolist()
                if plain.any():
                    marked = np.full((int(plain.sum()), n + 1), ord(MARK), _U)
                    marked[:, 1:] = codes[plain]
                    yield some[plain], marked
        cut: dict[tuple[int, int], list[tuple[int, list[int]]]] = {}
        for i in rest:
            for k, run in enumerate(self.symbols(words[i])):
                cut.setdefault((k, len(run)), []).append((i, run))
        for runs in cut.values():
            for k in range(0, len(runs), most):
                some = runs[k:k + most]
                yield np.array([i for i, _ in some]), np.array([run for _, run in some], _U)

    def log_probability(self, words: list[str], p: np.ndarray) -> np.ndarray:
        """Log of each word's probability (rows) per language (columns of ``p``, pieces x languages)."""
        out = np.zeros((len(words), p.shape[1]))
        for places, codes in self.grouped(words, p.shape[1]):
            forward = np.zeros((codes.shape[1] + 1, len(codes), p.shape[1]))
            forward[0] = 1
            for i, j, rows, pieces in self.edges(codes):  # by ascending begin: forward[i] is complete
                forward[j, rows] += forward[i, rows] * p[pieces]
            out[places] += np.log(forward[-1])
        return out

    def expected(self, words: list[str], counts: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Expected count of every piece in ``words``, taken ``counts`` times each."""
        out = np.zeros(self.size)
        for places, codes in self.grouped(words, 1):
            n = codes.shape[1]
            edges = self.edges(codes)
            forward, backward = np.zeros((n + 1, len(codes))), np.zeros((n + 1, len(codes)))
            forward[0] = backward[n] = 1
            for i, j, rows, pieces in edges:
                forward[j, rows] += forward[i, rows] * p[pieces]
            for i, j, rows, pieces in reversed(edges):
                backward[i, rows] += backward[j, rows] * p[pieces]
            share = counts[places] / forward[n]
            weights = [forward[i, rows] * p[pieces] * backward[j, rows] * share[rows] for i, j, rows, pieces in edges]
            out += np.bincount(np.concatenate([e[3] for e in edges]), np.concatenate(weights), self.size)
        return out


_LATTICES: dict[int, Lattice] = {}


def _lattice(pieces: list[str | int]) -> Lattice:
    """The vocabulary's lattice, kept by the worker: its size is fixed."""
    key = hash(tuple(pieces))
    if key not in _LATTICES:
        _LATTICES[key] = Lattice(pieces)
    return _LATTICES[key]


def words_of(token: str) -> list[str]:
    low = token.lower()
    return [low] if low.isalpha() else LETTERS.findall(low)


# ------------------------------------------------------------- training

def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, n) of a task's texts, and each language's documents as the word ''."""
    tokens: dict[str, Counter] = {}

    def settled() -> Iterator[pa.RecordBatch]:
        for lang, counter in tokens.items():
            words = Counter()
            for token, n in counter.items():
                for word in words_of(token) if token else ("",):
                    words[word] += n
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(words), pa.string()), pa.array(list(words), pa.string()),
                 pa.array(list(words.values()), pa.int64())], names=["lang", "word", "n"])
        tokens.clear()

    for batch in batches:
        for text, lang in zip(batch.column(0), batch.column(1).to_pylist()):
            counter = tokens.setdefault(lang, Counter())
            counter.update(text.as_py().split())
            counter[""] += 1
            if sum(map(len, tokens.values())) > REMEMBERED:
                yield from settled()
    yield from settled()


def word_counts(df: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, word, n) over all rows with a text and a language, landed; the
    number of a language's documents stands at the word ''."""
    ship(df.sparkSession)
    rows = df.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(text).cast("string").alias("t"), F.col(lang).cast("string").alias("l"))
    return landed(rows.mapInArrow(_count, "lang string, word string, n long")
                  .groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")


class Model:
    """Languages (sorted), log prior per language, and piece probabilities (pieces x languages)."""

    def __init__(self, languages: list[str], prior: np.ndarray, p: np.ndarray):
        self.languages, self.prior, self.p = languages, prior, p


def train(df: DataFrame, text: str, lang: str, pieces: list[str | int], rounds: int = ROUNDS) -> Model:
    """Piece probabilities per language from all rows of ``df`` that have both columns."""
    spark = df.sparkSession
    counts = word_counts(df, text, lang)
    documents = {r["lang"]: r["n"] for r in counts.where(F.col("word") == "").select("lang", "n").collect()}
    languages = sorted(documents)
    size = Lattice(pieces).size
    p = np.full((size, len(languages)), 1 / size)
    shared_pieces = spark.sparkContext.broadcast(pieces)
    for _ in range(rounds if languages else 0):
        shared = spark.sparkContext.broadcast((languages, p.astype(np.float32)))

        def expect(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            lattice = _lattice(shared_pieces.value)
            names, now = shared.value
            sums: dict[int, np.ndarray] = {}
            column = {name: k for k, name in enumerate(names)}
            waiting: dict[int, list[tuple[str, int]]] = {}

            def settle(k: int) -> None:
                words, n = zip(*waiting.pop(k))
                got = lattice.expected(list(words), np.array(n, np.float64), now[:, k].astype(np.float64))
                sums[k] = sums[k] + got if k in sums else got

            for batch in batches:
                for lang, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                    waiting.setdefault(column[lang], []).append((word, n))
                for k in [k for k, some in waiting.items() if len(some) >= TOGETHER]:
                    settle(k)
            for k in list(waiting):
                settle(k)
            for k, total in sums.items():
                units = np.rint(total * UNIT).astype(np.int64)
                at = np.flatnonzero(units)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), k), pa.int32()), pa.array(at, pa.int32()), pa.array(units[at], pa.int64())],
                    names=["k", "piece", "units"])

        sums = counts.where(F.col("word") != "").mapInArrow(expect, "k int, piece int, units long").groupBy("k", "piece").agg(
            F.sum("units").alias("units")).toArrow()  # at most pieces x languages rows
        expected = np.zeros_like(p)
        expected[sums.column("piece").to_numpy(), sums.column("k").to_numpy()] = sums.column("units").to_numpy()
        p = (1 - FLOOR) * expected / np.maximum(expected.sum(axis=0), 1) + FLOOR / size
        p /= p.sum(axis=0)
    total = sum(documents.values())
    return Model(languages, np.log(np.array([documents[x] for x in languages]) / max(1, total)), p.astype(np.float32))


# -------------------------------------------------------------- scoring

class _Tokens(dict):
    """Token -> number; their scores per language and letters are kept by
    number, and so are the scores of the words that tokens are made of."""

    def __init__(self, lattice: Lattice, p: np.ndarray):
        super().__init__()
        self.lattice, self.p, self.new = lattice, p, []
        self.words: dict[str, int] = {}
        self.of_word = np.zeros((0, p.shape[1]))
        self.score = np.zeros((0, p.shape[1]))
        self.spelled = np.zeros(0, bool)

    def __missing__(self, token: str) -> int:
        self.new.append(token)
        self[token] = number = len(self)
        return number

    def settle(self) -> None:
        """Score the tokens that are new since the last call, and the new words in them."""
        number, known = self.words, len(self.words)
        words = [[number.setdefault(w, len(number)) for w in words_of(t)] for t in self.new]
        of_word = self.of_word = np.concatenate(
            (self.of_word, self.lattice.log_probability(list(islice(number, known, None)), self.p)))
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        spelled = sizes > 0
        fresh = np.zeros((len(words), self.p.shape[1]))
        if spelled.any():
            starts = (np.cumsum(sizes) - sizes)[spelled]
            fresh[spelled] = np.add.reduceat(of_word[[w for ws in words for w in ws]], starts)
        self.score = np.concatenate((self.score, fresh))
        self.spelled = np.concatenate((self.spelled, spelled))
        self.new = []


def identified(df: DataFrame, text: str, keep: list[str], model: Model, pieces: list[str | int]) -> DataFrame:
    """Columns ``keep`` of every row with ``lang_pred`` and ``score``."""
    ship(df.sparkSession)
    context = df.sparkSession.sparkContext
    shared = context.broadcast((pieces, model.languages, model.prior, model.p))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, languages, prior, p = shared.value
        lattice, p = _lattice(pieces), p.astype(np.float64)
        tokens = _Tokens(lattice, p)
        for batch in batches:
            if len(tokens) > REMEMBERED:
                tokens = _Tokens(lattice, p)
            cuts = [np.fromiter(map(tokens.__getitem__, (x.as_py() or "").split()), np.int64) for x in batch.column(0)]
            tokens.settle()
            best, scores = [], []
            for numbers in cuts:
                if not languages or not tokens.spelled[numbers].any():
                    best.append(UNDEFINED), scores.append(0.0)
                    continue
                total = prior + tokens.score[numbers].sum(axis=0)
                k = int(np.argmax(total))
                best.append(languages[k]), scores.append(float(1 / np.exp(total - total[k]).sum()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(best, pa.string()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names[1:], "lang_pred", "score"])

    return df.select(F.col(text).cast("string").alias("_text"), *keep).mapInArrow(
        run, f"{fields}, lang_pred string, score double")


def held_out(doc_id: Column) -> Column:
    """The documents that nothing is learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


def op12_language_id(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    pieces = load_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    model = train(docs.where(~held_out(F.col("doc_id"))), "text", "lang", pieces)
    out = identified(docs.select("doc_id", "text"), "text", ["doc_id"], model, pieces)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
