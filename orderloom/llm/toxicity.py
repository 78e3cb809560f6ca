"""Toxicity by a bag of subword embeddings and a linear softmax, trained together in numpy.

A text's subwords are the byte n-grams of three to five within its words, blanks around a word
included; each is hashed to one of `BUCKETS` embeddings. The mean
embedding of a passage goes through a linear softmax. Misspelt or inflected words share most of
their n-grams with the words seen in training, so they land near them.

A document is scored by its worst passage: passages are `PASSAGE` words, starting at every
`STRIDE`-th word, so a few toxic words are not lost in a long text. Training does the same: each
document of a bounded sample is represented by its worst passage, found at first by the ratio of
its subwords' frequencies in toxic and other documents, then by the model of the round before.
Passages of documents that are not toxic stay in the training set once found, so that each round
learns from the last one's errors.

Since the softmax is linear, a passage's log-odds are the mean of one number per bucket, so whole
texts are scored by table look-ups.

Defined cases: null text, and text without words, is scored by the bias alone; null ids are scored,
not learnt from, and count as held out; documents with contradicting labels are not learnt from;
without labels of both kinds every score is 0; repeated rows are rows of their own; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.sampling import sample_ids, sample_texts
from orderloom.llm.shared import blocks, crc_fold, handover, mix, text_of, word_bounds

THRESHOLD = 0.7
SAMPLE_DOCS = 2500
BUCKET_BITS = 17
BUCKETS = 1 << BUCKET_BITS
DIMENSIONS = 8
SHORTEST, LONGEST = 3, 5
PASSAGE, STRIDE = 16, 4
ROUNDS, EPOCHS, BATCH, RATE, DECAY = 4, 5, 128, 0.02, 1e-5
#: Sample documents a bucket must occur in to have an embedding.
LEAST_DOCS = 3

#: ASCII letters in lower case, digits and all bytes beyond ASCII; anything else is a blank.
_letter = np.full(256, 0x20, dtype=np.uint8)
_letter[ord("0") : ord("9") + 1] = np.arange(ord("0"), ord("9") + 1)
for _start in (ord("A"), ord("a")):
    _letter[_start : _start + 26] = np.arange(ord("a"), ord("z") + 1)
_letter[0x80:] = np.arange(0x80, 0x100)


class Subwords:
    """Buckets of all subwords of some texts, in order of the word each belongs to."""

    def __init__(self, texts: list[bytes]):
        plain = [_letter[np.frombuffer(t, dtype=np.uint8)].tobytes() for t in texts]
        raw = b" " + b" ".join(plain) + b" "
        data, starts, ends = word_bounds(raw)
        self.words = len(starts)
        sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
        edges = 1 + np.concatenate(([0], np.cumsum(sizes)))
        self.begin = np.searchsorted(starts, edges)
        if not self.words:
            self.bucket = self.word = np.zeros(0, dtype=np.int64)
            return
        # The word of each byte; the blank before a word belongs to it.
        owner = np.zeros(len(data), dtype=np.int64)
        owner[starts - 1] = 1
        owner = np.cumsum(owner) - 1
        solid = data != 0x20
        wide = np.concatenate([data, np.zeros(LONGEST, dtype=np.uint8)]).astype(np.uint64)
        buckets, words = [], []
        value = np.zeros(len(data), dtype=np.uint64)
        for n in range(1, LONGEST + 1):
            value = (value << np.uint64(8)) | wide[n - 1 : n - 1 + len(data)]
            if n < SHORTEST:
                continue
            # Blanks only at the ends: all n - 2 bytes between are letters of one word.
            inner = np.ones(len(data) - n + 1, dtype=bool)
            for k in range(1, n - 1):
                inner &= solid[k : k + len(inner)]
            at = np.flatnonzero(inner)
            buckets.append(mix(value[at] ^ (np.uint64(n) << np.uint64(56))) >> np.uint64(64 - BUCKET_BITS))
            words.append(owner[at + 1])
        buckets = np.concatenate(buckets).astype(np.int64)
        words = np.concatenate(words)
        order = np.argsort(words, kind="stable")
        self.bucket, self.word = buckets[order], words[order]

    def worst(self, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each text its highest mean value over a passage, and that passage's first word.

        A text without words has mean zero.
        """
        held = np.bincount(self.word, minlength=self.words + 1)
        summed = np.bincount(self.word, value[self.bucket], self.words + 1)
        held = np.concatenate(([0], np.cumsum(held[: self.words])))
        summed = np.concatenate(([0.0], np.cumsum(summed[: self.words])))
        text = np.repeat(np.arange(len(self.begin) - 1), np.diff(self.begin))
        offset = np.arange(self.words) - self.begin[text]
        first = np.flatnonzero(offset % STRIDE == 0)
        last = np.minimum(first + PASSAGE, self.begin[1:][text[first]])
        mean = (summed[last] - summed[first]) / np.maximum(1, held[last] - held[first])
        best, place = np.zeros(len(self.begin) - 1), self.begin[:-1].copy()
        # Rising order, so that the highest mean is written last.
        order = np.argsort(mean, kind="stable")
        best[text[first[order]]] = mean[order]
        place[text[first[order]]] = first[order]
        return best, place

    def passage(self, text: int, first: int) -> np.ndarray:
        last = min(first + PASSAGE, self.begin[text + 1])
        a, b = np.searchsorted(self.word, [first, last])
        return self.bucket[a:b]


def _train(
    bags: list[np.ndarray], labels: np.ndarray, start: np.ndarray, seed: int = 7
) -> tuple[np.ndarray, float]:
    """Value of each bucket and bias of the log-odds.

    The first dimension starts as the given log ratios, the others as noise; buckets with ratio 0
    are too rare to say anything and stay without an embedding.
    """
    random = np.random.default_rng(seed)
    embedding = (random.random((BUCKETS, DIMENSIONS)) - 0.5) / DIMENSIONS
    embedding[:, 0] = start
    common = start != 0
    embedding[~common] = 0
    squares = np.full(BUCKETS, 1e-8)
    softmax = (random.random((DIMENSIONS, 2)) - 0.5) / DIMENSIONS
    softmax[0] = (-0.5, 0.5)
    bias, softmax_squares, bias_squares = np.zeros(2), np.full((DIMENSIONS, 2), 1e-8), np.full(2, 1e-8)
    weight = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    bags = [b if len(b) else np.zeros(1, dtype=np.int64) for b in bags]
    for _ in range(EPOCHS):
        order = random.permutation(len(bags))
        for i in range(0, len(order), BATCH):
            chosen = order[i : i + BATCH]
            sizes = np.array([len(bags[j]) for j in chosen])
            flat = np.concatenate([bags[j] for j in chosen])
            begin = np.cumsum(sizes) - sizes
            mean = np.add.reduceat(embedding[flat], begin, axis=0) / sizes[:, None]
            logits = mean @ softmax + bias
            logits -= logits.max(axis=1, keepdims=True)
            share = np.exp(logits)
            share /= share.sum(axis=1, keepdims=True)
            share[np.arange(len(chosen)), labels[chosen]] -= 1
            share *= weight[chosen][:, None] / len(chosen)
            slope = mean.T @ share + DECAY * softmax
            back = (share @ softmax.T) / sizes[:, None]
            softmax_squares += slope**2
            softmax -= RATE * 5 * slope / np.sqrt(softmax_squares)
            bias_squares += share.sum(axis=0) ** 2
            bias -= RATE * 5 * share.sum(axis=0) / np.sqrt(bias_squares)
            # Sum the slopes of a bucket over all its places, then one Adagrad step for each.
            touched, row = np.unique(flat, return_inverse=True)
            owner = np.repeat(np.arange(len(chosen)), sizes)
            moved = np.column_stack(
                [np.bincount(row, back[owner, d], len(touched)) for d in range(DIMENSIONS)]
            )
            squares[touched] += (moved**2).mean(axis=1)
            moved *= common[touched][:, None]
            embedding[touched] -= RATE * moved / np.sqrt(squares[touched])[:, None]
    side = softmax[:, 1] - softmax[:, 0]
    return (embedding @ side).astype(np.float32), float(bias[1] - bias[0])


class Model:
    def __init__(self, value: np.ndarray, bias: float):
        self.value, self.bias = value, bias

    def score(self, texts: list[bytes]) -> np.ndarray:
        mean, _ = Subwords(texts).worst(self.value)
        return 1 / (1 + np.exp(-np.clip(mean + self.bias, -30, 30)))


def _worst_passages(value: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, toxic = list(batch["text"]), batch["toxic"].to_numpy()
            for i, j in blocks(texts):
                subwords = Subwords(texts[i:j])
                _, place = subwords.worst(value)
                bags = [
                    subwords.passage(n, int(p)).astype(np.int32).tobytes()
                    for n, p in enumerate(place)
                ]
                yield pd.DataFrame({"toxic": toxic[i:j], "bag": bags})

    return run


def _held(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """In how many documents of either kind each bucket occurs."""
    counts = np.zeros((2, BUCKETS), dtype=np.int64)
    for batch in batches:
        texts, toxic = list(batch["text"]), batch["toxic"].to_numpy()
        for i, j in blocks(texts):
            subwords = Subwords(texts[i:j])
            text = np.searchsorted(subwords.begin, subwords.word, side="right") - 1
            pairs = np.unique(text * BUCKETS + subwords.bucket)
            np.add.at(counts, (toxic[i:j][pairs // BUCKETS], pairs % BUCKETS), 1)
    kind, bucket = np.nonzero(counts)
    yield pd.DataFrame({"toxic": kind, "bucket": bucket, "n": counts[kind, bucket]})


def fit(docs: DataFrame, labels: DataFrame, modulus: int = 3, held: int = 1) -> Model | None:
    """Fit on rows whose crc32(doc_id) mod `modulus` is not `held`; None without both labels."""
    learnable = (
        labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["toxic"].cast("int").alias("toxic"))
        .where("doc_id IS NOT NULL AND toxic IN (0, 1)")
        .where(crc_fold(F.col("doc_id"), modulus) != held)
        .groupBy("doc_id")
        .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("other"))
        .where("toxic = other")
        .drop("other")
    )
    chosen = sample_ids(learnable, "toxic", SAMPLE_DOCS)
    texts = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).cast("binary").alias("text")
    )
    sample = handover(sample_texts(texts, chosen).select("toxic", "text"), "labelled-texts")
    docs_of = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(docs_of) < 2:
        return None
    counts = (
        sample.mapInPandas(_held, "toxic int, bucket int, n long")
        .groupBy("toxic", "bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()  # at most two numbers for each bucket
    )
    held_by = np.zeros((2, BUCKETS))
    np.add.at(
        held_by, (counts["toxic"].to_numpy(), counts["bucket"].to_numpy()), counts["n"].to_numpy()
    )
    rate = (held_by + 0.5) / np.array([[docs_of[0] + 1], [docs_of[1] + 1]])
    start = np.log(rate[1] / rate[0]).astype(np.float32)
    start[held_by.sum(axis=0) < LEAST_DOCS] = 0
    value, bias, harmless = start, 0.0, []
    for _ in range(ROUNDS):
        rows = sample.mapInPandas(_worst_passages(value), "toxic int, bag binary").toPandas()
        # In a fixed order, whatever the order of tasks.
        rows = rows.sort_values(["toxic", "bag"], ignore_index=True)
        bags = [np.frombuffer(b, dtype=np.int32).astype(np.int64) for b in rows["bag"]]
        toxic = [b for b, label in zip(bags, rows["toxic"], strict=True) if label]
        harmless += [b for b, label in zip(bags, rows["toxic"], strict=True) if not label]
        labels_of = np.repeat([1, 0], [len(toxic), len(harmless)])
        value, bias = _train(toxic + harmless, labels_of, start)
    return Model(value, bias)


def score_of(model: Model | None):
    """A column function: text to score."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            texts = list(texts)
            parts = [model.score(texts[i:j]) if model else np.zeros(j - i) for i, j in blocks(texts)]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    def apply(text: Column) -> Column:
        return score(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))

    return apply


def score_toxicity(docs: DataFrame, labels: DataFrame, modulus: int = 3, held: int = 1) -> DataFrame:
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
