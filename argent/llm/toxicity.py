"""Toxicity by weak supervision.

1. A bounded sample of labelled rows (``SAMPLE_ROWS``, ``SAMPLE_BYTES``) is
   drawn by hash from the rows outside the held-out fold.
2. Voters: a stated lexicon, words and word beginnings and endings mined from
   the sample by how much more toxic the texts are that have them, some shape
   patterns, and the sample's own label as one more voter that may err.
3. A generative label model (expectation maximisation) estimates how often
   each voter fires given the true label, so its accuracy; from the
   posterior it estimates the correlation of each pair of voters given the
   label, and discounts the evidence of voters that say the same thing twice.
   A voter that sees nothing abstains.
4. A linear classifier (logistic regression on the same lexicon and pattern
   features, counted over a text's distinct words) is trained on the posterior
   labels and scores every whole text.

Only the model, a few thousand weights, is broadcast. Language, source, id and
label are never inputs of a score.

Defined results: NULL and empty texts get the score of a text without any
feature; equal texts get equal scores; without any labelled row the stated
lexicon alone decides; an empty table gives an empty result; other columns are
carried along unread where rows are filtered.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from argent.llm.common import ship, table, tidy

#: Bounds of the labelled sample that the model is fitted on.
SAMPLE_ROWS = 6000
SAMPLE_BYTES = 24 * 1024 * 1024
#: Bounds of the mined features and of the voters taken from them.
FEATURES = 3000
VOTERS = 400
#: How often the label itself says toxic of a clean and of a toxic text.
LABEL_RATES = (0.002, 0.98)
#: Least share of toxic texts among those that a mined voter fires on.
PRECISION = 0.75
#: Ridge penalty of the classifier.
RIDGE = 1e-4
#: A feature is mined from at least so many texts.
LEAST_TEXTS = 5
#: Share of the rows held out, as crc32 of the id modulo this being 0.
FOLDS = 5

# Words of abuse, one voter each.
LEXICON = ("bastard", "clown", "coward", "creep", "cretin", "disgusting", "dumb", "fool", "freak",
           "garbage", "idiot", "imbecile", "jerk", "liar", "loser", "moron", "nasty", "parasite", "pathetic",
           "pig", "scum", "shame", "stupid", "trash", "ugly", "vermin", "vile", "worthless")

_WORD = re.compile(r"\w+")
_SHOUT = re.compile(r"\b[A-Z]{4,}\b[^.?\n]*!")
_ADDRESS = re.compile(r"\byou(?:'re| are)?\s+(?:an?\s+)?(?:" + "|".join(LEXICON) + r")\b", re.I)
#: Words whose score a task remembers before it starts anew.
REMEMBERED = 200_000


def features(word: str) -> list[str]:
    """The word, its beginnings and its endings of three to six letters."""
    n = len(word)
    return ["=" + word, *("^" + word[:k] for k in range(3, 7) if n > k), *("$" + word[-k:] for k in range(3, 7) if n > k)]


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


class _Known(dict):
    """Word -> its features among the wanted ones."""

    def __init__(self, wanted):
        super().__init__()
        self.wanted = wanted

    def __missing__(self, word: str) -> tuple:
        if len(self) > 200_000:
            self.clear()
        self[word] = found = tuple(f for f in features(word) if f in self.wanted)
        return found


@dataclass(frozen=True)
class Model:
    """Weights of the features, the intercept and what was learned on the way."""

    weights: dict[str, float]
    bias: float
    accuracies: dict[str, float]
    correlated: int = 0


STATED = Model({"=" + w: 4.0 for w in LEXICON}, -3.0, {})


def label_model(votes: np.ndarray, labels: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior P(toxic) per text, firing rates [label, voter] and the weight
    of each voter after the discount for correlation.

    ``votes``: texts x voters, 1 where a voter says toxic, 0 where it abstains
    (a voter that sees nothing says nothing); the last voter fires if any
    other does, so its silence is a vote for clean. ``labels``: the noisy
    label, which votes either way with the stated rates, so that the voters
    cannot drift away from what the labels mean.
    Correlations are those that the estimated label doesn't explain, taken
    once the accuracies have settled."""
    given = np.column_stack((votes, labels)).astype(np.float64)
    m = given.shape[1]
    post = 0.05 + 0.9 * labels
    weight = np.ones(m)
    for step in range(rounds):
        prior = np.clip(post.mean(), 0.01, 0.99)
        mass = np.array([(1 - post).sum(), post.sum()])
        rates = np.vstack(((1 - post) @ given, post @ given))
        # each voter may err: a share of one text on either side
        rates = np.clip((rates + np.array([[0.1], [0.2]])) / (mass[:, None] + 1), 1e-5, 1 - 1e-5)
        rates[:, -1] = LABEL_RATES
        if step == rounds // 2:
            centred = given[:, :-2] - ((1 - post)[:, None] * rates[0, :-2] + post[:, None] * rates[1, :-2])
            scale = np.sqrt((centred ** 2).sum(axis=0)) + 1e-9
            rho = np.abs((centred.T @ centred) / np.outer(scale, scale))
            rho[rho < 0.2] = 0  # what chance alone gives
            weight[:-2] = 1 / np.maximum(rho.sum(axis=1), 1)
        fired = np.log(rates[1] / rates[0])
        silent = np.log((1 - rates[1]) / (1 - rates[0]))
        silent[:-2] = 0
        odds = np.log(prior / (1 - prior)) + given @ (weight * fired) + (1 - given) @ (weight * silent)
        post = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return post, rates, weight


def fit(texts: list[str], labels: list[int]) -> Model:
    """Mine the voters, fit the label model, train the classifier."""
    seen_texts = dict(zip(texts, labels))  # equal texts count once
    texts, labels = list(seen_texts), list(seen_texts.values())
    y = np.array(labels, np.float64)
    if not len(y) or y.min() == y.max():
        return STATED
    # texts are cut anew in each pass: their words together would fill the driver
    toxic = Counter()
    for t, label in zip(texts, labels):
        if label:
            toxic.update({f for w in words_of(t) for f in features(w)})
    toxic = Counter({f: k for f, k in toxic.items() if k >= LEAST_TEXTS or f[1:] in LEXICON})
    known = _Known(toxic.keys() | {"=" + w for w in LEXICON})
    seen = Counter()
    for t in texts:
        seen.update({f for w in words_of(t) for f in known[w]})
    p, n = y.sum(), len(y) - y.sum()
    scored = []
    for f, k in seen.items():
        t = toxic[f]
        if t >= LEAST_TEXTS:
            lift = np.log((t + 0.5) / (p + 1)) - np.log((k - t + 0.5) / (n + 1))
            if lift > 1.5:
                scored.append((lift * np.sqrt(t), f))
    stated = {"=" + w for w in LEXICON}
    mined = [f for _, f in sorted(scored, reverse=True)[:FEATURES]]
    names = sorted(stated.union(mined))
    index = {f: i for i, f in enumerate(names)}
    known = _Known(index.keys())
    rows, cols = [], []
    for r, t in enumerate(texts):
        for w in sorted(words_of(t)):
            for f in known[w]:
                rows.append(r), cols.append(index[f])
    rows, cols = np.array(rows, np.int64), np.array(cols, np.int64)
    precise = [f for f in mined if toxic[f] >= PRECISION * seen[f]]
    # a stated word that the sample often has in clean texts doesn't vote
    agreed = [f for f in sorted(stated) if seen[f] and (seen[f] < LEAST_TEXTS or toxic[f] >= PRECISION * seen[f])]
    voting = [index[f] for f in precise[:VOTERS] + agreed]
    voting = list(dict.fromkeys(voting))
    fires = np.zeros((len(texts), len(names)), bool)
    fires[rows, cols] = True
    patterns = np.array([[bool(_SHOUT.search(t)), bool(_ADDRESS.search(t))] for t in texts])
    any_hit = fires[:, voting].any(axis=1, keepdims=True)
    post, rates, weight = label_model(np.column_stack((fires[:, voting], patterns, any_hit)), y)
    # logistic regression on soft labels, both classes of equal weight; the
    # features are counts of distinct words that have them
    value, bias = np.zeros(len(names)), -1.0
    m1, m2 = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    share = np.clip(post.mean(), 0.01, 0.99)
    matter = (post * 0.5 / share + (1 - post) * 0.5 / (1 - share)) / len(texts)
    for step in range(1, 601):
        z = bias + np.bincount(rows, value[cols], len(texts))
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - post) * matter
        g = np.append(np.bincount(cols, error[rows], len(names)) + RIDGE * value, error.sum())
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        move = 0.05 * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.999 ** step)) + 1e-7)
        value, bias = value - move[:-1], bias - move[-1]
    weights = {f: float(v) for f, v in zip(names, value) if abs(v) > 1e-3}
    voters = [names[i] for i in voting] + ["shouting", "address", "any"]
    agree = [float((post * r1 + (1 - post) * (1 - r0)).mean()) for r0, r1 in zip(*rates[:, :-1])]
    return Model(weights, float(bias), dict(zip(voters, agree)), int((weight < 0.99).sum()))


def held_out(id_col: str):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == 0


def sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[list, list]:
    """Texts and labels of the bounded sample. Labelled rows are drawn in hash
    order; a text that does not fit is left out and the draw goes on, until the
    rows are enough or nothing that fits is left (or less than 1/64 of the
    bytes). Only the chosen texts leave the documents."""
    spark = docs.sparkSession
    marked = labels.filter(F.col(id_col).isNotNull() & F.col("toxic").isNotNull() & ~held_out(id_col)) \
        .groupBy(F.col(id_col).alias("_id")).agg(F.max("toxic").alias("_toxic"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    have = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_d"), text.alias("_text"))
    place = F.struct(F.xxhash64("_id").alias("_h"), "_id", "_d")
    sized = have.select("_id", "_d", F.octet_length("_text").alias("_b")).join(marked, "_id").withColumn("_at", place)
    chosen, spent, after = [], 0, None
    while len(chosen) < SAMPLE_ROWS and SAMPLE_BYTES - spent >= SAMPLE_BYTES // 64:
        left = sized.filter(F.col("_b") <= SAMPLE_BYTES - spent)
        if after is not None:
            left = left.filter(F.col("_at") > F.struct(*[F.lit(x) for x in after]))
        want = SAMPLE_ROWS - len(chosen)
        drawn = left.orderBy("_at").limit(want).collect()
        for r in drawn:
            if spent + r["_b"] <= SAMPLE_BYTES:
                chosen.append((r["_id"], r["_d"], r["_toxic"]))
                spent += r["_b"]
        if len(drawn) < want:
            break
        after = tuple(drawn[-1]["_at"])
    if not chosen:
        return [], []
    picked = spark.createDataFrame(sorted(set(chosen)), sized.select("_id", "_d", "_toxic").schema)
    got = have.join(F.broadcast(picked), ["_id", "_d"]).dropDuplicates(["_id", "_d"]) \
        .select(place.alias("_at"), "_text", "_toxic").collect()
    got.sort(key=lambda r: tuple(r["_at"]))
    return [r["_text"] for r in got], [int(r["_toxic"]) for r in got]


class _Scores(dict):
    """Word -> its share of the score."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        if len(self) > REMEMBERED:
            self.clear()
        self[word] = s = sum(self.weights.get(f, 0.0) for f in features(word))
        return s


def _score(text: str | None, model: Model, words: _Scores) -> float:
    z = model.bias + (sum([words[w] for w in sorted(words_of(text)) if words[w]]) if text else 0.0)
    return 1 / (1 + np.exp(-min(30.0, max(-30.0, z))))


def scored(docs: DataFrame, model: Model, text_col: str, keep: list[str], only_clean: bool = False) -> DataFrame:
    """Columns ``keep`` with ``score``, or with ``only_clean`` just the rows
    that score below 0.5, with all columns of ``docs``."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        words = _Scores(m.weights)  # goes with the task: a worker runs tasks of many stages
        for batch in batches:
            rest = batch.select(range(1, batch.num_columns))
            scores = pa.array([_score(t.as_py(), m, words) for t in batch.column(0)], pa.float64())
            if only_clean:
                yield rest.filter(pa.compute.less(scores, 0.5))
            else:
                yield pa.RecordBatch.from_arrays([*rest.columns, scores], names=[*rest.schema.names, "score"])

    cols = docs.columns if only_clean else keep
    # positions, not names: columns may clash with ours
    inner = docs.select(F.col(text_col).alias("_argent_text"), *cols)
    schema = docs.select(*cols).schema
    return inner.mapInArrow(run, schema if only_clean else schema.add("score", "double"))


def trained(spark, docs: DataFrame, sf_dir: str) -> Model:
    return fit(*sample(docs, table(spark, sf_dir, "labels")))


def without_toxic(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier doesn't reject."""
    return scored(docs, trained(spark, docs, sf_dir), "text", [], only_clean=True)


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = scored(docs, trained(spark, docs, sf_dir), "text", ["doc_id"])
    return out.select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))
