"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over hashed words is trained in numpy from confirmed toxic
texts and unlabelled ones. The risk is the class-prior-corrected one: positives
count with the prior as toxic, and their share of the risk as clean is taken off
the unlabelled texts' risk as clean; where that difference is negative (the
model fits the sample better than the prior allows) a step goes against its
gradient. A proximal step keeps the weights sparse, so that a text's length by
itself moves no score.

The model is fitted on a bounded sample (``MOST_POSITIVE`` confirmed texts and
``MOST_UNLABELLED`` others, the ones with the smallest id hashes) and scores all
texts whole. Its inputs are the words alone: no id, label, language or source.

Null and empty texts have no words and get the score of the bias. Labels that
are null or missing confirm nothing; an id with several labels is confirmed by
any of them. Without a confirmed text every score is 0. Repeated rows are scored alike;
where several texts share an id, the one with the smallest digest is learnt from. A score
of exactly the threshold predicts 1. Very long texts are scored whole; an empty table gives
no rows. Only the named columns are read; ``drop_toxic`` passes all others as they are.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import keep_texts, map_columns, stored, table, texts

#: Share of toxic texts where labels name no other class to estimate it from.
PRIOR = 0.1
THRESHOLD = 0.7
MOST_POSITIVE = 4_000
MOST_UNLABELLED = 8_000
#: Hashed word features.
BITS = 20
#: A feature needs so many confirmed texts, and so clear an excess in them.
LEAST_TEXTS = 3
LEAST_SCORE = 1.0
LEAST_LIFT = 3.0
#: Over the square root of the number of confirmed texts, the weight of the sparsity penalty.
PENALTY = 2e-3
STEPS = 300
#: Distinct words whose weights a worker keeps.
CACHE = 100_000
_STRIP = b".,;:!?\"'()[]{}|"


def words(text: str) -> list[bytes]:
    """Lower-cased (ASCII) words without punctuation around them."""
    return [w.strip(_STRIP) for w in text.encode().lower().split()]


def word_features(word: bytes) -> list[int]:
    """Hashes of the word and of its beginnings of 3 to 7 bytes, which stand for its inflections and compounds."""
    if not word:
        return []
    parts = [word + b"$", *(word[:n] for n in range(3, 8) if len(word) >= n)]
    return [zlib.crc32(x) & ((1 << BITS) - 1) for x in parts]


def features(text: str) -> np.ndarray:
    """Sorted distinct features of a text."""
    return np.array(sorted({f for w in set(words(text)) for f in word_features(w)}), np.int64)


def held_out(doc_id: Column) -> Column:
    """Ids whose labels are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


@dataclass
class Model:
    weights: dict[int, float]
    bias: float

    def score(self, logit: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(logit, -500, 500)))) if logit > -np.inf else 0.0


def telling(positive: list[np.ndarray], unlabelled: list[np.ndarray]) -> list[int]:
    """Features clearly more frequent in confirmed than in unlabelled texts: by ``LEAST_SCORE`` deviations and ``LEAST_LIFT`` times."""
    have_p = np.bincount(np.concatenate(positive), minlength=1 << BITS)
    have_u = np.bincount(np.concatenate(unlabelled), minlength=1 << BITS) if unlabelled else np.zeros(1 << BITS)
    share = (have_p + have_u) / (len(positive) + len(unlabelled))
    score = (have_p - len(positive) * share) / np.sqrt(len(positive) * share * (1 - share) + 1e-9)
    lift = (have_p / len(positive)) / np.maximum(have_u / max(1, len(unlabelled)), 1e-9)
    return np.flatnonzero((have_p >= LEAST_TEXTS) & (score >= LEAST_SCORE) & (lift >= LEAST_LIFT)).tolist()


def _rows(sets: list[np.ndarray], index: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of the features in ``index``."""
    got = [[index[f] for f in s.tolist() if f in index] for s in sets]
    return np.repeat(np.arange(len(sets)), [len(x) for x in got]), np.array([c for x in got for c in x], np.int64)


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float = PRIOR, penalty: float = PENALTY, steps: int = STEPS) -> Model:
    """Minimise the non-negative risk with logistic loss; the arrays are the texts' distinct features."""
    if not positive:
        return Model({}, -np.inf)
    index = {f: i for i, f in enumerate(telling(positive, unlabelled))}
    (pr, pc), (ur, uc) = _rows(positive, index), _rows(unlabelled, index)
    penalty /= np.sqrt(len(positive))
    n_p, n_u, d = len(positive), max(1, len(unlabelled)), len(index)
    w, b = np.zeros(d), float(np.log(prior / (1 - prior)))
    m, v, mb, vb = np.zeros(d), np.zeros(d), 0.0, 0.0
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -60, 60)))
    for t in range(1, steps + 1):
        zp = np.bincount(pr, w[pc], n_p) + b
        zu = np.bincount(ur, w[uc], len(unlabelled)) + b
        p_clean, u_clean = np.logaddexp(0, zp).mean(), np.logaddexp(0, zu).sum() / n_u
        sp, su = sigmoid(zp), sigmoid(zu)
        below = u_clean - prior * p_clean
        clean_p, clean_u = -prior * sp / n_p, su / n_u  # gradients of the corrected risk as clean
        if below >= 0:
            gp, gu = prior * (sp - 1) / n_p + clean_p, clean_u
        else:
            gp, gu = -clean_p, -clean_u
        g = np.bincount(pc, gp[pr], d) + np.bincount(uc, gu[ur], d)
        gb = gp.sum() + gu.sum()
        rate = 0.1 / np.sqrt(1 + t / 50)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        scale = rate / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w = w - scale * m / (1 - 0.9**t)
        w = np.sign(w) * np.maximum(np.abs(w) - scale * penalty, 0)
        b -= rate * mb / (1 - 0.9**t) / (np.sqrt(vb / (1 - 0.999**t)) + 1e-8)
    return Model({f: float(w[i]) for f, i in index.items() if w[i]}, b)


def _frequent(sample: DataFrame, n_p: int, n_u: int) -> np.ndarray:
    """Sorted features of ``sample(positive, features)`` with the texts and the lift that ``telling`` asks for, counted in Spark."""

    def make():
        def call(kind, packed):
            sets = [np.frombuffer(x, np.int32) for x in packed]
            f, at = np.unique(np.concatenate(sets), return_inverse=True)
            p = np.bincount(at, np.repeat(kind, [len(x) for x in sets]), len(f)).astype(np.int64)
            return [f, p, np.bincount(at, minlength=len(f)) - p]

        return call

    have = map_columns(sample, make, "feature int, p bigint, u bigint").groupBy("feature").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    # A hair below the limit: telling() settles the last digit.
    lift = F.col("p") / max(1, n_p) >= (LEAST_LIFT - 1e-6) * F.greatest(F.col("u") / max(1, n_u), F.lit(1e-9))
    found = have.where((F.col("p") >= LEAST_TEXTS) & lift).select("feature").toArrow()
    return np.sort(found.column("feature").to_numpy().astype(np.int32))


def train(
    docs: DataFrame,
    labels: DataFrame,
    prior: float | None = None,
    most_positive: int = MOST_POSITIVE,
    most_unlabelled: int = MOST_UNLABELLED,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Model:
    """Fit on the texts confirmed by ``labels`` (never by held-out ids) and a sample of all others.

    Without a given ``prior`` the share of toxic labels is taken.
    """
    usable = labels.where(~held_out(F.col("doc_id")))
    if prior is None:
        share = usable.where("toxic IN (0, 1)").agg(F.avg("toxic")).first()[0]
        prior = share if share is not None and 0 < share < 1 else PRIOR

    def make():
        return lambda kind, bodies: [kind, [features(t).astype(np.int32).tobytes() for t in bodies]]

    confirmed = usable.where(F.col("toxic") == 1).select(F.col("doc_id").cast("string").alias("_id")).distinct()
    order = F.xxhash64("_id", F.lit(17))  # a fixed pseudo-random order
    ids = docs.select(F.col(id_col).cast("string").alias("_id")).where("_id IS NOT NULL")
    # Ids first, so that only the sample's texts are moved.
    positive = ids.join(confirmed, "_id", "left_semi").distinct().orderBy(order, "_id").limit(most_positive)
    # The prior is the one of all texts, so the unlabelled sample leaves out no confirmed ones.
    other = ids.where(~held_out(F.col("_id"))).distinct().orderBy(order, "_id").limit(most_unlabelled)
    sample = [(r._id, 1) for r in positive.collect()] + [(r._id, 0) for r in other.collect()]
    chosen = docs.sparkSession.createDataFrame(sample, "_id string, positive int")
    own = docs.select(F.col(id_col).cast("string").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # One text of each chosen id, however many rows repeat it: at most the two sample bounds.
    one = F.min_by("text", F.sha2("text", 256)).alias("text")
    rows = own.join(F.broadcast(chosen), "_id").groupBy("_id", "positive").agg(one).select("positive", "text")
    own = stored(map_columns(rows, make, "positive int, features binary", 64), "toxicity-sample")
    # Only features that may be telling leave the workers; fit() decides on the same counts.
    telling_ones = _frequent(own, sum(k for _, k in sample), sum(1 - k for _, k in sample))

    def narrow():
        return lambda kind, packed: [kind, [np.intersect1d(np.frombuffer(x, np.int32), telling_ones, assume_unique=True).tobytes() for x in packed]]

    got = map_columns(own, narrow, "positive int, features binary").collect()
    sets = {k: [np.frombuffer(x, np.int32) for x in sorted(bytes(r.features) for r in got if r.positive == k)] for k in (0, 1)}
    return fit(sets[1], sets[0], prior=prior)


def scorer(model: Model) -> Callable[[str], float]:
    """Scores texts; remembers which weighted features each word has, few words having any."""
    known: dict[bytes, tuple[int, ...]] = {}

    def score(text: str) -> float:
        if len(known) > CACHE:
            known.clear()
        found: set[int] = set()
        for w in set(text.encode().lower().split()):
            own = known.get(w)
            if own is None:
                own = known[w] = tuple(f for f in word_features(w.strip(_STRIP)) if f in model.weights)
            if own:
                found.update(own)
        return model.score(model.bias + sum(model.weights[f] for f in sorted(found)))

    return score


def score_texts(docs: DataFrame, model: Model, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, predicted`` of each whole text."""

    def make():
        score = scorer(model)

        def call(ids, bodies):
            out = [score(t) for t in bodies]
            return [ids, out, [int(s >= threshold) for s in out]]

        return call

    kind = docs.schema[id_col].dataType.simpleString()
    return map_columns(texts(docs, id_col, text_col), make, f"doc_id {kind}, score double, predicted int")


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose texts are not predicted toxic."""

    def make():
        score = scorer(model)
        return lambda bodies: [score(t or "") < threshold for t in bodies]

    return keep_texts(docs, text_col, make)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score_texts(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
