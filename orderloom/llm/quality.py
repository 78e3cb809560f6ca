"""Text quality by positive-unlabelled learning.

Trusted positives are documents labelled 1; all else it learns from is unlabelled web text, a
sample of any documents. With the class prior, the share of good text among the unlabelled, the
risk of a classifier on unseen negatives follows from those two samples, and its non-negative
form keeps a flexible model from driving it below zero. The prior is estimated as the share of
ones among the labels that may be learnt from.

The classifier is additive: each of a few surface measures of a text (character classes, repeated
words, lines and phrases, word lengths) is cut at quantiles of the unlabelled sample, and every
bin has a weight. Both samples are bounded; all documents are scored over their whole texts.

Defined cases: null text counts as empty and is scored like any text; null ids are scored, not
learnt from, and count as held out; documents with contradicting labels are not learnt from; if no
positive may be learnt from, every score is the prior 0.5; repeated rows are rows of their own;
other columns are kept by `keep_good` and not read otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.sampling import sample_ids, sample_texts
from orderloom.llm.shared import (
    blocks,
    crc_fold,
    fresh,
    hashed_words,
    mix,
    runs,
    text_of,
    word_bounds,
)

POSITIVES, UNLABELLED = 4000, 8000
THRESHOLD = 0.3
BINS = 12
STEPS, RATE, DECAY = 1200, 0.1, 1e-4

#: Character classes counted in a text.
CLASSES = (
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"0123456789",
    b".,;:?'\"-()",
    b"!",
    b"#$%&*@~^+=_",
    b"|<>/\\{}[]",
    b"\n",
    bytes(range(0x80, 0x100)),
)
_class = np.zeros(256, dtype=np.int64)
for _number, _members in enumerate(CLASSES, start=1):
    _class[list(_members)] = _number


def measures(texts: list[bytes]) -> np.ndarray:
    """A row of numbers for each text."""
    count = len(texts)
    # A line feed ends each text, the last one, too: no text's numbers depend on its neighbours.
    data, starts, ends = word_bounds(b"\n".join([*texts, b""]))
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    owner = np.repeat(np.arange(count), sizes + 1)
    kinds = len(CLASSES) + 1
    shares = np.bincount(owner * kinds + _class[data], minlength=count * kinds)
    shares = shares.reshape(count, kinds)[:, 1:] / np.maximum(1, sizes)[:, None]

    words, begin = hashed_words(texts)
    total = np.diff(begin)
    doc = np.repeat(np.arange(count), total)
    several = np.maximum(1, total)

    def share(mask: np.ndarray, of: np.ndarray = doc) -> np.ndarray:
        return np.bincount(of, mask, count) / several

    def repeated(values: np.ndarray, of: np.ndarray) -> np.ndarray:
        """The share of a text's values that it has seen before."""
        held = np.bincount(of, minlength=count)
        # Far from the small numbers that short words hash from: keys of two texts stay apart.
        salt = mix(of.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        distinct = np.unique(mix(values ^ salt), return_index=True)[1]
        return 1 - np.bincount(of[distinct], minlength=count) / np.maximum(1, held)

    width = 4
    places = np.arange(max(0, len(words) - width + 1))
    places = places[doc[places] == doc[places + width - 1]] if len(places) else places
    phrases = runs(words, places, places + width, 0x9E3779B97F4A7C15)
    twin = np.zeros(len(words), dtype=bool)
    twin[1:] = (words[1:] == words[:-1]) & (doc[1:] == doc[:-1])
    length = ends - starts
    final = _class[data[ends - 1]] if len(ends) else np.zeros(0, dtype=np.int64)
    initial = _class[data[starts]] if len(starts) else final
    # Words whose second byte is a capital as well: shouting.
    second = data[np.minimum(starts + 1, ends - 1)] if len(starts) else final
    shout = (initial == 1) & (length > 1) & (_class[second] == 1) if len(starts) else twin
    lines = np.bincount(owner, data == 0x0A, count) if len(data) else np.zeros(count)
    columns = [
        np.log1p(total),
        share(length) / 10,
        share(twin),
        repeated(words, doc) / np.log(several + 2),
        repeated(phrases, doc[places]),
        share(shout),
        share(final == 4),
        share(final == 5),
        share((length == 1) & (initial == 6)),
        several / (lines + 1),
        share(length > 20),
    ]
    return np.nan_to_num(np.column_stack([shares, *columns])).astype(np.float32)


class Model:
    """Weights per bin of each measure; the score is the logistic of their sum."""

    def __init__(self, edges: np.ndarray, weights: np.ndarray, bias: float):
        self.edges, self.weights, self.bias = edges, weights, bias

    def bins(self, rows: np.ndarray) -> np.ndarray:
        return np.column_stack(
            [np.searchsorted(e, column, side="right") for e, column in zip(self.edges, rows.T, strict=True)]
        )

    def logits(self, bins: np.ndarray) -> np.ndarray:
        return self.bias + self.weights[np.arange(bins.shape[1]), bins].sum(axis=1)

    def score(self, texts: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(self.bins(measures(texts))), -30, 30)))


def train(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> Model:
    """Minimise the non-negative risk with logistic loss, by full gradients and Adam."""
    quantiles = np.linspace(0, 1, BINS + 1)[1:-1]
    edges = np.quantile(np.concatenate([unlabelled, positive]), quantiles, axis=0).T
    # The far tails hold the clearest junk: cut them more finely.
    tails = np.quantile(unlabelled, [0.01, 0.03, 0.93, 0.95, 0.96, 0.97, 0.98, 0.99], axis=0).T
    edges = np.sort(np.column_stack([edges, tails]), axis=1)
    model = Model(edges, np.zeros((positive.shape[1], edges.shape[1] + 1)), 0.0)
    good, any_ = model.bins(positive), model.bins(unlabelled)
    columns = np.arange(good.shape[1])
    size = model.weights.size
    width = model.weights.shape[1]

    def gradient(bins: np.ndarray, slope: np.ndarray) -> np.ndarray:
        """Of the mean loss, with the bias last."""
        flat = np.bincount(
            (columns * width + bins).ravel(), np.repeat(slope, bins.shape[1]), size
        )
        return np.append(flat, slope.sum()) / len(bins)

    moment, square = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, STEPS + 1):
        of_good = 1 / (1 + np.exp(-model.logits(good)))
        of_any = 1 / (1 + np.exp(-model.logits(any_)))
        # Mean loss of calling them negative, with slopes; of_* is the slope of that loss.
        as_negative = -np.log1p(-np.minimum(of_any, 1 - 1e-9)).mean() + prior * np.log1p(
            -np.minimum(of_good, 1 - 1e-9)
        ).mean()
        negative = gradient(any_, of_any) - prior * gradient(good, of_good)
        if as_negative < 0:
            slope = -negative
        else:
            slope = prior * gradient(good, of_good - 1) + negative
        slope[:-1] += DECAY * model.weights.ravel()
        moment = 0.9 * moment + 0.1 * slope
        square = 0.999 * square + 0.001 * slope**2
        move = RATE * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        model.weights -= move[:-1].reshape(model.weights.shape)
        model.bias -= move[-1]
    return model


def _measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = list(batch["text"])
        for i, j in blocks(texts):
            yield pd.DataFrame(
                {"positive": batch["positive"].to_numpy()[i:j], "row": list(measures(texts[i:j]))}
            )


def fit(docs: DataFrame, labels: DataFrame, modulus: int = 5, held: int = 0) -> Model | None:
    """Fit on rows whose crc32(doc_id) mod `modulus` is not `held`; None without positives."""
    learnable = (
        labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["quality"].alias("quality"))
        .where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .where(crc_fold(F.col("doc_id"), modulus) != held)
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
        .where("quality = other")
    )
    counted = {r.quality: r["count"] for r in learnable.groupBy("quality").count().collect()}
    if not counted.get(1):
        return None
    prior = min(0.99, counted[1] / sum(counted.values()))
    texts = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).cast("binary").alias("text")
    ).where("doc_id IS NOT NULL")
    trusted = sample_ids(learnable.where("quality = 1"), "quality", POSITIVES)
    web = texts.where(crc_fold(F.col("doc_id"), modulus) != held).withColumn("web", F.lit(0))
    unlabelled = sample_ids(web, "web", UNLABELLED)
    rows = (
        sample_texts(texts, trusted)
        .select("text", F.lit(True).alias("positive"))
        .union(sample_texts(texts, unlabelled).select("text", F.lit(False)))
        .mapInPandas(_measured, "positive boolean, row array<float>")
        .toPandas()  # bounded by the samples
    )
    if not rows["positive"].any() or rows["positive"].all():
        return None
    table = np.stack(rows["row"].to_list()).astype(float)
    mask = rows["positive"].to_numpy()
    return train(table[mask], table[~mask], prior)


def score_of(model: Model | None):
    """A column function: text to score."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            texts = list(texts)
            parts = [
                model.score(texts[i:j]) if model else np.full(j - i, 0.5) for i, j in blocks(texts)
            ]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    def apply(text: Column) -> Column:
        return score(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))

    return apply


def score_quality(docs: DataFrame, labels: DataFrame, modulus: int = 5, held: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs."""
    model = fit(docs, labels, modulus, held)
    doc_id = docs["doc_id"].cast("long")
    fold = crc_fold(doc_id, modulus) == held
    scored = docs.select(
        doc_id.alias("doc_id"),
        F.coalesce(fold, F.lit(True)).alias("held_out"),
        score_of(model)(docs["text"]).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs, with all columns, that score at least THRESHOLD."""
    score = fresh(docs, "score")
    scored = docs.withColumn(score, score_of(fit(docs, labels))(docs["text"]))
    return scored.where(F.col(score) >= THRESHOLD).select(*docs.columns)
