"""Text quality by positive-unlabelled learning.

Trusted positives and unlabelled web text train a linear model on the
non-negative risk: the unlabelled risk less the share of it that the positives
explain must not fall below zero; where it would, the step goes the other way.
The share of positives among the unlabelled text, the class prior, is estimated
by the best bin: the score above which the unlabelled text is rarest compared
with held-back positives.

The features are rates of bytes, words, lines and byte trigrams of the whole
text.  Features of a bounded, documented sample, one text for each id, come to
the driver for the fit.  The class prior counts all documents that labels may be
learned from, but for those that the first model has seen: each task counts its
documents between the scores of the held-back positives, and only these counts
come to the driver.  Every document is scored.

Defined results: a null or empty text has the features of an empty one and is
scored by them; repeated rows score alike; of an id with several texts, the fit
may see the smallest one; columns other than ``doc_id`` and
``text`` are never inputs; an empty table gives no rows.  A document of the
labels counts as positive if any of its labels is 1.  Without any positives, or
without other text, every score is the prior of one half.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from texlode.llm.batches import Polynomial, Words, column_bytes, mix, text_chunks

# Largest numbers of documents that the fit sees: trusted positives, unlabelled.
MAX_POSITIVES = 6000
MAX_UNLABELLED = 12000
TRIGRAMS = 256
FOLDS = 5
THRESHOLD = 0.3
# Bytes whose rates are features of their own.
MARKS = b"!|#*$%&<>.,;:?()[]{}/\\\"'-_=+@~^`"


def _rates(amount: np.ndarray, of: np.ndarray) -> np.ndarray:
    return amount / np.maximum(of, 1)


def features(texts: list[bytes], polynomial: Polynomial) -> np.ndarray:
    """One row of features per text."""
    words = Words(texts, polynomial)
    data = np.frombuffer(words.joined, dtype=np.uint8)
    n_texts, n = len(texts), len(words)
    sizes = words.text_end - words.text_start - 1
    of_byte = np.repeat(np.arange(n_texts), sizes + 1)
    n_words = np.diff(words.first)
    document = words.document()

    def bytes_per_text(flags: np.ndarray) -> np.ndarray:
        return np.bincount(of_byte[flags], minlength=n_texts)

    def words_per_text(flags: np.ndarray) -> np.ndarray:
        return np.bincount(document[flags], minlength=n_texts)

    length = words.end - words.start
    same_text = np.zeros(n, dtype=bool)
    same_text[1:] = document[1:] == document[:-1]
    again = np.zeros(n, dtype=bool)
    again[1:] = same_text[1:] & (words.hash[1:] == words.hash[:-1])
    order = np.lexsort((words.hash, document))
    fresh = np.ones(n, dtype=bool)
    fresh[1:] = (words.hash[order][1:] != words.hash[order][:-1]) | (document[order][1:] != document[order][:-1])
    distinct = words_per_text_of(document[order][fresh], n_texts)
    grams = np.zeros(0, dtype=np.uint64)
    if n >= 4:
        grams = mix(words.hash[:-3] + np.uint64(3) * words.hash[1:-2] + np.uint64(5) * words.hash[2:-1] + np.uint64(7) * words.hash[3:])
        at = np.flatnonzero(document[:-3] == document[3:])
        by = np.lexsort((grams[at], document[at]))
        g, d = grams[at][by], document[at][by]
        repeat = np.zeros(len(g), dtype=bool)
        repeat[1:] = (g[1:] == g[:-1]) & (d[1:] == d[:-1])
        repeated = words_per_text_of(d[repeat], n_texts)
    else:
        repeated = np.zeros(n_texts)
    upper = (data >= 65) & (data <= 90)
    lower = (data >= 97) & (data <= 122)
    heads = data[words.start] if n else np.zeros(0, np.uint8)
    lines = bytes_per_text(data == 10) + 1
    dup_lines = []
    for text in texts:
        parts = [line for line in text.split(b"\n") if line.strip()]
        dup_lines.append((len(parts) - len(set(parts))) / max(1, len(parts)))
    letters = bytes_per_text(upper | lower | (data >= 128))
    columns = [
        np.log1p(n_words),
        _rates(np.bincount(document, weights=length, minlength=n_texts), n_words),
        np.sqrt(_rates(np.bincount(document, weights=length**2, minlength=n_texts), n_words)),
        _rates(bytes_per_text(upper), letters),
        _rates(letters, sizes),
        _rates(bytes_per_text((data >= 48) & (data <= 57)), sizes),
        _rates(bytes_per_text(data >= 128), sizes),
        _rates(distinct, n_words),
        _rates(words_per_text(again), n_words),
        _rates(repeated, n_words),
        np.asarray(dup_lines),
        _rates(lines, n_words),
        _rates(words_per_text((heads >= 65) & (heads <= 90)), n_words),
        _rates(words_per_text(length == 1), n_words),
        _rates(words_per_text(length > 15), n_words),
    ]
    columns += [_rates(bytes_per_text(data == mark), n_words) for mark in MARKS]
    # What is rare counts by its order of magnitude, too.
    columns += [np.log(np.asarray(c, dtype=np.float64) + 1e-3) for c in columns[3:]]
    codes = data[:-2].astype(np.uint64) | data[1:-1].astype(np.uint64) << np.uint64(8) | data[2:].astype(np.uint64) << np.uint64(16)
    slot = (mix(codes) % np.uint64(TRIGRAMS)).astype(np.int64)
    inside = of_byte[2:] == of_byte[:-2]
    counts = np.bincount(of_byte[:-2][inside] * TRIGRAMS + slot[inside], minlength=n_texts * TRIGRAMS)
    trigrams = np.sqrt(counts.reshape(n_texts, TRIGRAMS) / np.maximum(sizes, 1)[:, None])
    return np.concatenate((np.column_stack(columns), trigrams), axis=1).astype(np.float32)


def words_per_text_of(documents: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(documents, minlength=n)


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    polynomial = Polynomial(41)
    for batch in batches:
        texts = column_bytes(batch.column("text"))
        for i, j in text_chunks(texts):
            rows = features(texts[i:j], polynomial)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(i, j - i),
                    batch.column("positive").slice(i, j - i),
                    pa.array([r.tobytes() for r in rows], pa.binary()),
                ],
                names=["doc_id", "positive", "x"],
            )


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights + self.bias

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def bins(margins: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """How many margins have 0, 1, ... of the ascending cuts at or below them."""
    return np.bincount(np.searchsorted(cuts, margins, side="right"), minlength=len(cuts) + 1)


def class_prior(positive: np.ndarray, cuts: np.ndarray, unlabelled: np.ndarray) -> float:
    """Best-bin estimate: the smallest ratio of the shares of both at or above a cut.

    ``positive`` has margins; of the unlabelled text, the counts of ``bins`` are enough.
    """
    n = int(unlabelled.sum())
    if not n:
        return 0.5
    above_p = 1 - np.searchsorted(np.sort(positive), cuts) / len(positive)
    above_u = 1 - np.cumsum(unlabelled[:-1]) / n
    slack = np.sqrt(1 / len(positive)) + np.sqrt(1 / n)
    best = np.argmin((above_u + slack) / above_p)
    return float(np.clip(above_u[best] / above_p[best], 0.02, 0.98))


def _descend(p: np.ndarray, u: np.ndarray, prior: float | None, rounds: int, ridge: float = 1e-3):
    """Adam on the logistic loss: non-negative risk, or positives against the rest without a prior."""
    weights, bias = np.zeros(p.shape[1], dtype=p.dtype), p.dtype.type(0)
    m, v = np.zeros(p.shape[1] + 1), np.zeros(p.shape[1] + 1)

    def margins(x):
        return np.clip(x @ weights + bias, -30, 30)

    def sides(z):
        return 1 / (1 + np.exp(-z))

    def gradient(x, slope):
        return np.append(slope @ x, slope.sum()) / len(x)

    for t in range(1, rounds + 1):
        zp, zu = margins(p), margins(u)
        sp, su = sides(zp), sides(zu)
        if prior is None:
            step = gradient(p, sp - 1) + gradient(u, su)
        else:
            # Losses of calling text negative: log(1 + exp(f)).
            loss_u, loss_p = np.logaddexp(0, zu).mean(), np.logaddexp(0, zp).mean()
            rest = gradient(u, su) - prior * gradient(p, sp)
            if loss_u - prior * loss_p >= 0:
                step = prior * gradient(p, sp - 1) + rest
            else:
                step = -rest
        step[:-1] += ridge * weights
        m, v = 0.9 * m + 0.1 * step, 0.999 * v + 0.001 * step**2
        move = 0.02 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        weights, bias = (weights - move[:-1]).astype(p.dtype), p.dtype.type(bias - move[-1])
    return weights, bias


def fit(
    positive: np.ndarray,
    unlabelled: np.ndarray,
    rounds: int = 400,
    count: Callable[[Model, np.ndarray], np.ndarray] | None = None,
    least: int = 30,
) -> Model:
    """Model of trusted positives and unlabelled text, given as rows of features.

    ``count`` gives the counts of ``bins`` of unlabelled text that a first model has
    not seen; without it, the odd rows are counted.  The first model sees the even
    rows.  Every cut has more than ``least`` positives above it, if there are as many.
    """
    width = (positive if len(positive) else unlabelled).shape[1]
    if not len(positive) or not len(unlabelled):
        return Model(np.zeros(width), np.ones(width), np.zeros(width), 0.0, 0.5)
    mean, scale = unlabelled.mean(axis=0), unlabelled.std(axis=0) + 1e-3
    p, u = (np.clip((x - mean) / scale, -8, 8) for x in (positive, unlabelled))
    prior = 0.5
    # Positives that the first model does not see estimate the prior.
    if len(p) > 1:
        weights, bias = _descend(p[::2], u[::2], None, rounds // 2)
        first = Model(mean, scale, weights, float(bias), prior)
        held_back = first.margin(positive[1::2])
        cuts = np.sort(held_back)[: max(1, len(held_back) - least)]
        counts = bins(first.margin(unlabelled[1::2]), cuts) if count is None else count(first, cuts)
        prior = class_prior(held_back, cuts, counts)
    weights, bias = _descend(p, u, prior, rounds)
    return Model(mean, scale, weights, float(bias), prior)


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


def _count_bins(texts: DataFrame, model: Model, cuts: np.ndarray) -> np.ndarray:
    """Counts of ``bins`` over a frame of texts; a task gives no more rows than there are cuts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        polynomial = Polynomial(41)
        total = np.zeros(len(cuts) + 1, dtype=np.int64)
        for batch in batches:
            rows = column_bytes(batch.column("text"))
            for i, j in text_chunks(rows):
                total += bins(model.margin(features(rows[i:j], polynomial)), cuts)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held])], names=["bin", "n"])

    counted = texts.select("text").mapInArrow(run, "bin int, n bigint").groupBy("bin").agg(F.sum("n").alias("n"))
    totals = np.zeros(len(cuts) + 1, dtype=np.int64)
    for row in counted.collect():
        totals[row["bin"]] = row["n"]
    return totals


def train(
    docs: DataFrame, labels: DataFrame, positives: int = MAX_POSITIVES, unlabelled: int = MAX_UNLABELLED
) -> Model:
    """Fits on the documents whose fold is not 0: at most so many of each kind, by order of a digest.

    The class prior counts all of these documents, beyond the sample, too.
    """
    spark = docs.sparkSession
    rows_of = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    learnable = rows_of.filter(fold(F.col("doc_id")) != 0)
    trusted = (
        labels.filter((F.col("quality") == 1) & (fold(F.col("doc_id")) != 0))
        .select(F.col("doc_id").cast("bigint").alias("doc_id"))
        .distinct()
    )
    order = F.xxhash64(F.col("doc_id"), F.lit("fit"))
    # Ids first, so that only the texts of the sample are sorted and sent.
    p_ids = trusted.join(rows_of.select("doc_id").distinct(), "doc_id", "left_semi").orderBy(order, "doc_id").limit(positives)
    u_ids = learnable.select("doc_id").distinct().orderBy(order.desc(), "doc_id").limit(unlabelled)
    wanted = p_ids.withColumn("positive", F.lit(True)).unionByName(u_ids.withColumn("positive", F.lit(False)))
    sample = learnable.join(F.broadcast(wanted), "doc_id").groupBy("doc_id", "positive").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    rows = sample.mapInArrow(_feature_rows, "doc_id bigint, positive boolean, x binary").toArrow()
    x = np.frombuffer(b"".join(rows.column("x").to_pylist()), dtype=np.float32)
    x = x.reshape(rows.num_rows, -1) if rows.num_rows else np.zeros((0, 1), dtype=np.float32)
    ids = np.asarray(rows.column("doc_id").to_pylist(), dtype=np.int64)
    is_positive = np.asarray(rows.column("positive").to_pylist(), dtype=bool)
    # One order, whatever the order of arrival; a digest, so that halves of the sample are alike.
    by = np.lexsort((ids, mix(ids.view(np.uint64))))
    x, ids, is_positive = x[by], ids[by], is_positive[by]
    seen = np.unique(np.concatenate((ids[is_positive][::2], ids[~is_positive][::2])))

    def count(first: Model, cuts: np.ndarray) -> np.ndarray:
        known = spark.createDataFrame([(int(i),) for i in seen], "doc_id bigint")
        return _count_bins(learnable.join(F.broadcast(known), "doc_id", "left_anti"), first, cuts)

    return fit(x[is_positive], x[~is_positive], count=count)


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score)`` for every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        polynomial = Polynomial(41)
        for batch in batches:
            texts = column_bytes(batch.column("text"))
            for i, j in text_chunks(texts):
                x = features(texts[i:j], polynomial)
                scores = model.score(x) if len(model.weights) == x.shape[1] else np.full(len(x), 0.5)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), pa.array(scores, pa.float64())], names=["doc_id", "score"]
                )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, score double")


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = THRESHOLD,
    positives: int = MAX_POSITIVES,
    unlabelled: int = MAX_UNLABELLED,
) -> DataFrame:
    """``held_out``, ``score`` and ``predicted`` of every document."""
    scored = score_documents(docs, train(docs, labels, positives, unlabelled))
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
