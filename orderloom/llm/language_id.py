"""Language identification by rank-order profiles of character n-grams.

A language's profile lists its most frequent n-grams of one to three letters, counted within words
and with the blanks around them. A document's most frequent n-grams, as far as any profile knows
them, are compared with each profile by out-of-place distance: the difference in rank, or the
profile's length for an n-gram it lacks. The nearest profile wins; the score is the share of the
second smallest distance in the two smallest, so 0.5 is a tie. N-grams that no profile knows would
add the same distance for every language and are left out.

Profiles are fitted on about `SAMPLE_DOCS` whole documents of each language. All documents are scored
over their whole texts. All letters and n-grams of all profiles count: an n-gram's code holds the
code points of its letters, 21 bits each.

Defined cases: null text, and text without letters, is `und` with score 0; so is everything if no
language was learnt; a text none of whose n-grams any profile knows gets the most frequent
language with score 0; null lang is not learnt from; null ids are scored but not learnt from and
count as held out; repeated rows are rows of their own; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.shared import crc_fold, for_python, from_python, text_of

PROFILE = 300
LONGEST = 3
SAMPLE_DOCS = 1500
UNKNOWN = "und"
#: Characters handled at once; longer texts are cut at blanks, which no n-gram spans.
BLOCK_CHARS = 1 << 19
#: Distances (texts by languages) held at once.
BLOCK_DISTANCES = 1 << 22

_LETTERS = re.compile(r"[^\W\d_]+")


def _grams(text: str) -> Counter:
    grams: Counter = Counter()
    for word, count in Counter(_LETTERS.findall(text.lower())).items():
        padded = f" {word} "
        for n in range(1, LONGEST + 1):
            for i in range(len(padded) - n + 1):
                grams[padded[i : i + n]] += count
    grams.pop(" ", None)
    return grams


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        by_language: dict[str, Counter] = {}
        for lang, text in zip(batch["lang"], batch["text"], strict=True):
            by_language.setdefault(lang, Counter()).update(_grams(text))
        rows = [(lang, g, n) for lang, grams in by_language.items() for g, n in grams.items()]
        yield pd.DataFrame(rows, columns=["lang", "gram", "n"])


def fit(docs: DataFrame, learnable: Column, sample: int = SAMPLE_DOCS) -> dict[str, list[str]]:
    """Profile of each language, the most frequent language first."""
    known = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        docs["lang"].cast("string").alias("lang"),
        text_of(docs).alias("text"),
        learnable.alias("learn"),
    ).where("learn AND lang IS NOT NULL AND doc_id IS NOT NULL")
    sizes = known.groupBy("lang").agg(F.count("*").alias("size"))
    frequent = [r.lang for r in sizes.orderBy(F.desc("size"), "lang").collect()]
    # The documents of each language with the least hashes, each id once.
    draw = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 30))
    share = (F.lit(float((1 << 30) * sample)) / F.greatest("size", F.lit(sample))).cast("long")
    some = (
        known.join(F.broadcast(sizes), "lang")
        .where(draw < share)
        .groupBy("doc_id", "lang")
        .agg(F.min("text").alias("text"))
    )
    counts = (
        some.select("lang", "text")
        .mapInPandas(_counted, "lang string, gram string, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= PROFILE)
    profiles: dict[str, dict[int, str]] = {lang: {} for lang in frequent}
    for r in top.collect():  # at most PROFILE rows for each language
        profiles[r.lang][r.rank] = r.gram
    return {lang: [grams[r] for r in sorted(grams)] for lang, grams in profiles.items() if grams}


@cache
def _is_letter() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)], dtype=bool)


#: Bits of a code point within an n-gram's code.
_POINT_BITS = 21


class Counts:
    """How often texts have n-grams: text times vocabulary plus n-gram, in order, and a number."""

    def __init__(self, place: np.ndarray, number: np.ndarray):
        self.place, self.number = place, number

    def __add__(self, other: Counts) -> Counts:
        place, where = np.unique(np.concatenate([self.place, other.place]), return_inverse=True)
        number = np.zeros(len(place), dtype=np.int64)
        np.add.at(number, where, np.concatenate([self.number, other.number]))
        return Counts(place, number)

    def __radd__(self, zero: int) -> Counts:
        return self

    def __eq__(self, other: Counts) -> np.bool_:
        same = np.array_equal(self.place, other.place) and np.array_equal(self.number, other.number)
        return np.bool_(same)


def _packed(gram: str) -> int:
    place = 0
    for c in gram:
        place = place << _POINT_BITS | ord(c)
    return place


class Scorer:
    """Distances of texts to profiles."""

    def __init__(self, profiles: dict[str, list[str]]):
        self.languages = list(profiles)
        known = sorted({g for grams in profiles.values() for g in grams})
        self.vocabulary = len(known)
        number = {g: i for i, g in enumerate(known)}
        # A letter's code is its code point; all that is not part of a word is a blank.
        self.code = np.where(_is_letter(), np.arange(0x110000), ord(" "))
        for c in {c for g in known for c in g}:
            self.code[ord(c)] = ord(c)
        self.tables = []
        for n in range(1, LONGEST + 1):
            coded = sorted((_packed(g), i) for g, i in number.items() if len(g) == n)
            self.tables.append(tuple(np.array(coded, dtype=np.int64).reshape(-1, 2).T.copy()))
        # For each n-gram the languages whose profile has it, and its rank there.
        held = sorted(
            (number[g], row, r) for row, grams in enumerate(profiles.values()) for r, g in enumerate(grams)
        )
        gram, self.holder, self.rank = np.array(held, dtype=np.int64).reshape(-1, 3).T.copy()
        self.first = np.searchsorted(gram, np.arange(self.vocabulary + 1))

    def counts(self, texts: list[str]) -> tuple[Counts, np.ndarray]:
        """How often each text has each known n-gram, and whether it has a letter."""
        # A blank of its own ends each text, so that its last n-grams are its own, too.
        lowered = [f"\n{t.lower()}\n" for t in texts]
        lengths = np.array([len(t) for t in lowered])
        points = np.frombuffer("".join(lowered).encode("utf-32-le", "replace"), dtype=np.uint32)
        codes = self.code[points]
        text = np.repeat(np.arange(len(texts)), lengths)
        letter = codes != ord(" ")
        lettered = np.bincount(text[letter], minlength=len(texts)) > 0
        # One blank between words, and one at each end of a text.
        stay = letter.copy()
        stay[0] = True
        stay[1:] |= letter[:-1]
        wide, text = codes[stay], text[stay]
        found = []
        place = np.zeros(len(wide), dtype=np.int64)
        for n in range(1, LONGEST + 1):
            place = (place[: len(wide) - n + 1] << _POINT_BITS) | wide[n - 1 :]
            coded, number = self.tables[n - 1]
            if not len(coded):
                continue
            at = np.minimum(np.searchsorted(coded, place), len(coded) - 1)
            hit = coded[at] == place
            owner = text[n - 1 :][hit] if n == 1 else text[1 : len(place) + 1][hit]
            found.append(owner * self.vocabulary + number[at[hit]])
        found = np.concatenate([np.zeros(0, dtype=np.int64), *found])
        if len(texts) * self.vocabulary <= 4 * len(found):  # counting is cheaper than sorting
            number = np.bincount(found)
            place = np.flatnonzero(number)
            return Counts(place, number[place]), lettered
        return Counts(*np.unique(found, return_counts=True)), lettered

    def judge(self, counts: Counts, lettered: np.ndarray) -> tuple[list[str], np.ndarray]:
        names, scores = [], []
        step = max(1, BLOCK_DISTANCES // max(1, len(self.languages)))
        for a in range(0, len(lettered), step):
            some = lettered[a : a + step]
            begin, end = np.searchsorted(
                counts.place, np.array([a, a + len(some)]) * self.vocabulary
            )
            place = counts.place[begin:end] - a * self.vocabulary
            name, score = self._judge(Counts(place, counts.number[begin:end]), some)
            names += name
            scores.append(score)
        return names, np.concatenate([np.zeros(0), *scores])

    def _judge(self, counts: Counts, lettered: np.ndarray) -> tuple[list[str], np.ndarray]:
        texts, languages = len(lettered), len(self.languages)
        if not self.vocabulary:
            return [UNKNOWN] * texts, np.zeros(texts)
        # The most frequent n-grams of each text first, equal ones by their numbers.
        row, gram = np.divmod(counts.place, self.vocabulary)
        order = np.lexsort((gram, -counts.number, row))
        row, gram = row[order], gram[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        top = rank < PROFILE
        row, gram, rank = row[top], gram[top], rank[top]
        known = np.bincount(row, minlength=texts)
        # What each language that has the n-gram is nearer than one that lacks it.
        nearer = np.zeros(texts * languages)
        times = self.first[gram + 1] - self.first[gram]
        total = np.cumsum(times)
        begin = 0
        while begin < len(row):
            # As many n-grams as have about BLOCK_DISTANCES holders together.
            before = total[begin] - times[begin]
            end = max(begin + 1, int(np.searchsorted(total, before + BLOCK_DISTANCES, side="right")))
            own = times[begin:end]
            pair = np.repeat(np.arange(begin, end), own)
            at = np.arange(len(pair)) - np.repeat(np.cumsum(own) - own, own) + self.first[gram[pair]]
            apart = np.minimum(np.abs(self.rank[at] - rank[pair]), PROFILE)
            place = row[pair] * languages + self.holder[at]
            nearer += np.bincount(place, PROFILE - apart, len(nearer))
            begin = end
        distances = (known[:, None] * float(PROFILE) - nearer.reshape(texts, languages)).T
        best = distances.argmin(axis=0)
        if len(distances) > 1:
            first, second = np.partition(distances, 1, axis=0)[:2]
        else:
            first, second = distances[0], known * float(PROFILE)
        score = np.divide(second, first + second, out=np.zeros(texts), where=second > 0)
        names = [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered, strict=True)]
        return names, np.where(lettered, score, 0.0)


_GAP = re.compile(r"[\W\d_]")


def _parts(text: str) -> Iterator[str]:
    """A text in lower case, cut between its words into parts of about BLOCK_CHARS; a longer word
    stays whole."""
    text, at = text.lower(), 0
    while len(text) - at > BLOCK_CHARS:
        gap = _GAP.search(text, at + BLOCK_CHARS)
        end = gap.start() if gap else len(text)
        yield text[at:end]
        at = end
    yield text[at:]


def _groups(texts: list[str]) -> Iterator[tuple[int, int]]:
    begin = size = 0
    for i, text in enumerate(texts):
        if i > begin and size + len(text) > BLOCK_CHARS:
            yield begin, i
            begin, size = i, 0
        size += len(text) + 1
    if begin < len(texts):
        yield begin, len(texts)


def predict(docs: DataFrame, profiles: dict[str, list[str]]) -> DataFrame:
    """doc_id, lang_pred, score for every row of docs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(profiles)
        for batch in batches:
            texts = list(batch["text"])
            names, scores = [], []
            for i, j in _groups(texts):
                if j - i > 1 or len(texts[i]) <= BLOCK_CHARS:
                    counts, lettered = scorer.counts(texts[i:j])
                else:
                    parts = [scorer.counts([part]) for part in _parts(texts[i])]
                    counts = sum(c for c, _ in parts)
                    lettered = np.any([ok for _, ok in parts], axis=0)
                some, score = scorer.judge(counts, lettered)
                names += some
                scores += score.tolist()
            yield pd.DataFrame({"doc_id": batch["doc_id"], "lang_pred": names, "score": scores})

    texts = docs.select(for_python(docs["doc_id"]), text_of(docs).alias("text"))
    found = texts.mapInPandas(run, "doc_id long, lang_pred string, score double")
    return found.withColumn("doc_id", from_python("doc_id"))


def identify(docs: DataFrame, modulus: int = 4, held: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score; rows whose crc32(doc_id) mod `modulus` is `held` are
    held out and not learnt from."""
    profiles = fit(docs, crc_fold(docs["doc_id"].cast("long"), modulus) != held)
    fold = crc_fold(F.col("doc_id"), modulus)
    return predict(docs, profiles).select(
        "doc_id", F.coalesce(fold == held, F.lit(True)).alias("held_out"), "lang_pred", "score"
    )
