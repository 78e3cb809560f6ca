"""Repeated lines, exact or within one edit, through a deletion-neighbourhood join.

A line is its words; the edit distance counts inserted, deleted or substituted words. A line goes
if an equal line, or one within one edit, stands earlier (smaller doc_id, or further up in the same
document). Lines are judged on the input, so a chain of small edits leaves only its first line.
Lines of fewer than `min_words` words only go if equal; lines without words always stay.

Equal lines are those with the same 128-bit hash of their words. Each line stands under the hash of
its words and under the hash of each variant with one word deleted, together with that word's position. Under one hash, an undeleted line and a variant are
one insertion apart, and two variants with the same position one substitution. Each line learns
the earliest such partner, an aggregate of the group and never its pairs. The two lines' words are
then compared to verify the distance.

Variants are emitted only for lines that can have a partner: one edit leaves the first or the last
half of both lines equal, so a line whose halves no other line has is left out. Equal lines are
reduced to their first before that. The words of the lines that are left come from a second pass
over the texts: their numbers are broadcast up to BROADCAST_ROWS of them, else joined by shuffle.

Defined cases: null text counts as empty and comes back as null; null ids come after all others;
rows with equal ids are ordered by a hash of id and text, rows equal in both are one document;
lines of any number and length are taken whole; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.shared import (
    BROADCAST_ROWS,
    WORD_BASE,
    Sequences,
    blocks,
    fresh,
    frugal,
    handover,
    keyed,
    word_hashes,
)

MIN_WORDS = 8
LAST = (1 << 63) - 1
PLACE = "place struct<doc:long,row_key:long,line:int>"


def _lines(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """All lines of some texts, with the text and the number of each."""
    split = [t.split(b"\n") for t in texts]
    counts = np.array([len(s) for s in split], dtype=np.int64)
    text = np.repeat(np.arange(len(texts)), counts)
    number = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    return [line for s in split for line in s], text, number


def _halves(words: list[bytes]) -> tuple[int, ...]:
    """Hashes of the first and the last half, of either size that a partner may share; what kind
    of half it is, and of how many words, is the seed."""
    size, found = len(words), []
    for half in (size // 2, (size - 1) // 2):
        if found and 2 * half + 1 == size:  # of an odd number of words both sizes are the same
            return (*found, *found)
        found.append(xxhash.xxh3_64_intdigest(b" ".join(words[:half]), 2 * half))
        found.append(xxhash.xxh3_64_intdigest(b" ".join(words[size - half :]), 2 * half + 1))
    return tuple(found)


def _described(min_words: int):
    """Per line with words: its hash, and the hashes of the halves a partner may share."""

    @frugal
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = list(batch["text"])
            doc, row_key = batch["doc"].to_numpy(), batch["row_key"].to_numpy()
            for i, j in blocks(texts):
                lines, text, number = _lines(texts[i:j])
                split = [line.split() for line in lines]
                full = np.array([bool(words) for words in split], dtype=bool)
                split, text, number = [words for words in split if words], text[full], number[full]
                long = np.array([len(words) >= min_words for words in split], dtype=bool)
                halves = np.zeros((len(split), 4), dtype=np.uint64)
                if long.any():
                    halves[long] = np.array([_halves(w) for w in split if len(w) >= min_words], dtype=np.uint64)
                head_a, tail_a, head_b, tail_b = halves.view(np.int64).T
                yield pd.DataFrame(
                    {
                        "line_key": [xxhash.xxh3_128_digest(b" ".join(words)) for words in split],
                        "doc": doc[i:j][text],
                        "row_key": row_key[i:j][text],
                        "line": number.astype(np.int32),
                        "long": long,
                        "head_a": head_a,
                        "tail_a": tail_a,
                        "head_b": head_b,
                        "tail_b": tail_b,
                    }
                )

    return run


@frugal
def _words_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The word hashes of the listed lines."""
    for batch in batches:
        texts, listed = list(batch["text"]), list(batch["listed"])
        row_key = batch["row_key"].to_numpy()
        for i, j in blocks(texts):
            rows = [
                (key, int(n), line)
                for key, text, numbers in zip(row_key[i:j], texts[i:j], listed[i:j], strict=True)
                for lines in (text.split(b"\n"),)
                for n in numbers
                for line in (lines[n],)
            ]
            words, _, begin = word_hashes([line for *_, line in rows])
            words = words.view(np.int64)
            yield pd.DataFrame(
                {
                    "row_key": [key for key, *_ in rows],
                    "line": np.array([n for _, n, _ in rows], dtype=np.int32),
                    "words": [words[a:b] for a, b in zip(begin, begin[1:], strict=False)],
                }
            )


def _variants(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and position of each variant with one word deleted, and of the line itself (-1)."""
    size = len(words)
    sequence = Sequences(words, WORD_BASE)
    whole = sequence.runs(np.zeros(1, dtype=np.int64), np.array([size]))
    return np.append(sequence.without_one(), whole), np.append(np.arange(size), -1)


@frugal
def _all_variants(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    keys, variants, positions, rows = [], [], [], 0

    def frame() -> pd.DataFrame:
        return pd.DataFrame(
            {
                "variant": np.concatenate(variants).view(np.int64),
                "position": np.concatenate(positions).astype(np.int32),
                "line_key": [k for k, own in zip(keys, variants, strict=True) for _ in range(len(own))],
            }
        )

    for batch in batches:
        for words, line_key in zip(batch["words"], batch["line_key"], strict=True):
            variant, position = _variants(np.asarray(words, dtype=np.int64).view(np.uint64))
            keys.append(line_key)
            variants.append(variant)
            positions.append(position)
            rows += len(variant)
            if rows >= 50_000:
                yield frame()
                keys, variants, positions, rows = [], [], [], 0
    if keys:
        yield frame()


def within_one(a, b) -> bool:
    """Whether one inserted, deleted or substituted item, or none, turns a into b."""
    if abs(len(a) - len(b)) > 1:
        return False
    short = min(len(a), len(b))
    i = 0
    while i < short and a[i] == b[i]:
        i += 1
    j = 0
    while j < short - i and a[-1 - j] == b[-1 - j]:
        j += 1
    return max(len(a), len(b)) - i - j <= 1


def _verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        good = [
            within_one(list(a), list(b))
            for a, b in zip(batch["words"], batch["partner_words"], strict=True)
        ]
        yield batch.loc[good, ["row_key", "line"]]


def _masks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        masks = []
        for lines in batch["lines"]:
            mask = np.zeros(max(lines) + 1, dtype=bool)
            mask[lines] = True
            masks.append(mask)
        yield pd.DataFrame({"row_key": batch["row_key"], "mask": masks})


def _near(firsts: DataFrame, texts: DataFrame) -> DataFrame:
    """(row_key, line) of first lines that have an earlier line within one edit."""
    halves = firsts.where("long").select(
        F.explode(F.array_distinct(F.array("head_a", "tail_a", "head_b", "tail_b"))).alias("half"),
        "line_key",
    )
    shared = halves.groupBy("half").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("half")
    hopeful = halves.join(shared, "half", "left_semi").select("line_key").distinct()
    hopeful = firsts.join(hopeful, "line_key", "left_semi")
    hopeful = handover(hopeful.select("line_key", "doc", "row_key", "line"), "hopeful-lines")

    wanted = hopeful.groupBy("row_key").agg(F.collect_list("line").alias("listed"))
    if hopeful.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    words = (
        texts.select("row_key", "text")
        .join(wanted, "row_key")
        .mapInPandas(_words_of, "row_key long, line int, words array<long>")
        .dropDuplicates(["row_key", "line"])
    )
    place = F.struct("doc", "row_key", "line").alias("place")
    lines = handover(
        hopeful.join(words, ["row_key", "line"]).select("line_key", place, "words"), "line-words"
    )
    variants = lines.select("line_key", "words").mapInPandas(
        _all_variants, "variant long, position int, line_key binary"
    )
    variants = variants.join(lines.select("line_key", "place"), "line_key")
    group, same = Window.partitionBy("variant"), Window.partitionBy("variant", "position")
    whole = F.col("position") == -1

    def least(column: Column, window) -> Column:
        return F.min(column).over(window)

    partner = F.when(whole, least(F.col("place"), group)).otherwise(
        F.least(least(F.when(whole, F.col("place")), group), least(F.col("place"), same))
    )
    pairs = (
        variants.select("line_key", "place", partner.alias("partner"))
        .where("partner < place")
        .groupBy("line_key")
        .agg(F.min("partner").alias("partner"))
    )
    partners = lines.select(F.col("place").alias("partner"), F.col("words").alias("partner_words"))
    return (
        pairs.join(lines, "line_key")
        .join(partners, "partner")
        .select("place.row_key", "place.line", "words", "partner_words")
        .mapInPandas(_verified, "row_key long, line int")
    )


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(row_key, mask): for each document that keeps a line with words, an array that is true at
    the numbers of those lines."""
    texts = keyed(docs).select(
        "row_key",
        F.coalesce("doc_id", F.lit(LAST)).alias("doc"),
        F.col("text").cast("binary").alias("text"),
    )
    halves = ["head_a", "tail_a", "head_b", "tail_b"]
    described = texts.mapInPandas(
        _described(min_words),
        "line_key binary, doc long, row_key long, line int, long boolean, "
        + ", ".join(f"{h} long" for h in halves),
    )
    firsts = handover(
        described.groupBy("line_key")
        .agg(F.min(F.struct("doc", "row_key", "line", "long", *halves)).alias("first"))
        .select("line_key", "first.*"),
        "first-lines",
    )
    near = _near(firsts, texts)
    return (
        firsts.select("row_key", "line")
        .join(near, ["row_key", "line"], "left_anti")
        .groupBy("row_key")
        .agg(F.collect_list("line").alias("lines"))
        .mapInPandas(_masks, "row_key long, mask array<boolean>")
    )


def drop_repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """All rows and columns of docs, text without its repeated lines."""
    masks = handover(repeated_lines(docs, min_words), "line-masks")
    key, mask = fresh(docs, "row_key"), fresh(docs, "line_mask")
    text = docs["text"].cast("string")
    rows = docs.withColumn(
        key, F.xxhash64(docs["doc_id"].cast("long"), F.coalesce(text, F.lit("")))
    ).join(masks.select(F.col("row_key").alias(key), F.col("mask").alias(mask)), key, "left")

    def stays(line: Column, number: Column) -> Column:
        listed = F.get(F.col(mask), number)
        return F.coalesce(listed, F.lit(False)) | line.rlike(r"^[\x20\x09-\x0D]*$")

    # Line feeds are the only separator; a final one closes the last line.
    kept = F.array_join(F.filter(F.split(F.col("text"), "\n", -1), stays), "\n")
    return rows.withColumn("text", kept).select(*docs.columns)


def brute_force(rows: list[tuple], min_words: int = MIN_WORDS) -> dict:
    """(doc_id, text) rows, ids distinct and not null -> {doc_id: text}; for tests."""
    earlier, result = [], {}
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        kept = []
        for line in (text or "").split("\n"):
            words = line.encode().split()
            if not words or not any(
                words == other
                or (min(len(words), len(other)) >= min_words and within_one(words, other))
                for other in earlier
            ):
                kept.append(line)
            if words:
                earlier.append(words)
        result[doc_id] = None if text is None else "\n".join(kept)
    return result
