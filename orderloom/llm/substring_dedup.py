"""Repeated passages, cut out by hashes of word windows, grouped by minimizers.

This stands in for prefix-partitioned suffix trees: no suffixes are sorted, and no maximal repeats
derived; the words of suffix trees below only say what a group of windows corresponds to.

A window is `width` consecutive words of one document. A window that also starts earlier (smaller
doc_id, or the same document and an earlier start) is a repeat, and every word a repeat covers is
removed. Windows are judged on the input.

Equal windows are suffixes that share a node of depth `width` or more, so the suffix tree is never
built whole:

1. Suffixes are taken at anchors only: of the `prefix`-word grams of a window the one with the
   least hash. Equal windows have equal anchors, and about one position in eight is an anchor.
   Grouping by that first prefix leaves the anchors that occur more than once; the subtree of any
   other holds no repeat. A text counts its own occurrences and sends each of its grams once.
2. The windows of those anchors form the subtrees, one per prefix. Where a prefix has more
   suffixes than fit in memory, it is lengthened to the whole window, so that its subtree is a
   single deep node. Tasks stream over their subtrees in order of place; the first to reach a
   deep node keeps its words, all others lose them. Repeats within a block of documents are
   settled before the shuffle, so a passage that a third of all rows share sends one suffix per
   block.
3. Equal texts are compared once: only the first of them takes part, the others are repeats as
   far as they have windows.

Windows are compared by two hashes, each over another 64 bits of the words' 128-bit hashes and with
a base of its own modulo a prime; equal texts by SHA-256.

Defined cases: null text counts as empty; texts of fewer than `width` words lose nothing; null ids
come after all others; rows with equal ids are ordered by a hash of id and text, and rows equal in
both are one document, each given its result; no rows give no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pandas as pd
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.shared import (
    TWIN_BASE,
    WORD_BASE,
    Sequences,
    blocks,
    for_python,
    from_python,
    frugal,
    handover,
    keyed,
    mix,
    word_hashes,
)

#: Suffixes of one prefix that a task may hold in memory; a longer prefix splits larger groups.
GROUP_SUFFIXES = 20_000

LAST = (1 << 63) - 1


class Block:
    """The windows of some texts: start, anchor and hash of each, all counted over the block."""

    def __init__(self, texts: list[bytes], width: int, prefix: int):
        words, self.checks, self.begin = word_hashes(texts)
        count = max(0, len(words) - width + 1)
        self.text = np.repeat(np.arange(len(texts)), np.diff(self.begin))
        starts = np.arange(count)
        self.start = starts[starts + width <= self.begin[1:][self.text[:count]]]
        self.sequences = Sequences(words, WORD_BASE)
        self.grams = self.sequences.windows(prefix)
        self.anchor = self.start
        if len(self.start):
            spans = sliding_window_view(self.grams, width - prefix + 1)
            self.anchor = self.start + spans[self.start].argmin(axis=1)
        self.width = width

    def key(self, places: np.ndarray) -> np.ndarray:
        """One number for each gram within its text."""
        return mix(self.grams[places] ^ mix(self.text[places].astype(np.uint64)))

    def listed(self, grams: list) -> np.ndarray:
        """Which windows have an anchor that is listed for their text."""
        sizes = [len(g) for g in grams]
        flat = np.concatenate([np.asarray(g, dtype=np.int64) for g in grams]).view(np.uint64)
        owner = np.repeat(np.arange(len(grams)), sizes).astype(np.uint64)
        return np.isin(self.key(self.anchor), mix(flat ^ mix(owner)))

    def hashes(self) -> np.ndarray:
        """Two hashes of each window."""
        other = Sequences(self.checks, TWIN_BASE).windows(self.width)
        return np.column_stack([self.sequences.windows(self.width)[self.start], other[self.start]])


def _anchors(width: int, prefix: int):
    @frugal
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch.drop_duplicates("digest")
            texts, digests = list(batch["text"]), batch["digest"].to_numpy()
            for i, j in blocks(texts):
                block = Block(texts[i:j], width, prefix)
                places = np.unique(block.anchor)
                text = block.text[places]
                _, first, times = np.unique(
                    block.key(places), return_index=True, return_counts=True
                )
                yield pd.DataFrame(
                    {
                        "anchor": block.grams[places[first]].view(np.int64),
                        "digest": digests[i:j][text[first]],
                        "times": times.astype(np.int32),
                    }
                )

    return run


def _suffixes(width: int, prefix: int):
    """The windows of repeated anchors, one row per anchor or, for long prefixes, per window."""

    def rows(block: Block, grams: list, lengthened: list, order, row_key) -> pd.DataFrame:
        alone = block.listed(lengthened)
        chosen = alone | block.listed(grams)
        alone = alone[chosen]
        start, anchor, digest = block.start[chosen], block.anchor[chosen], block.hashes()[chosen]
        text = block.text[start]
        local = start - block.begin[text]
        # Of equal windows in this block only the earliest is still open; same place, same window.
        _, rank = np.unique(np.rec.fromarrays([order, row_key]), return_inverse=True)
        rank = rank.reshape(-1)[text]
        by = np.lexsort((local, rank, digest[:, 1], digest[:, 0]))
        new = np.ones(len(by), dtype=bool)
        new[1:] = (digest[by][1:] != digest[by][:-1]).any(axis=1)
        leader = np.empty(len(by), dtype=np.int64)
        leader[by] = by[np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))]
        open_ = leader == np.arange(len(by))
        gone = ~open_ & ((rank != rank[leader]) | (local != local[leader]))
        # Rows: windows of one anchor stand side by side; those of a long prefix stand alone.
        head = np.ones(len(start), dtype=bool)
        head[1:] = (anchor[1:] != anchor[:-1]) | alone[1:]
        first = np.flatnonzero(head)
        row = np.cumsum(head) - 1
        bit = np.left_shift(1, start - start[first][row]) if len(first) else start
        open_bits = np.bincount(row, bit * open_, len(first)).astype(np.int32)
        gone_bits = np.bincount(row, bit * gone, len(first)).astype(np.int32)
        prefix_key = block.grams[anchor[first]]
        key = np.where(alone[first], mix(prefix_key ^ digest[first, 0]), prefix_key).view(np.int64)
        ends = np.cumsum(np.bincount(row, open_, len(first)).astype(np.int64)) * 16
        packed = digest[open_].tobytes()
        own = row_key[text[first]]
        return pd.DataFrame(
            {
                "key": np.where(open_bits != 0, key, own),
                "place": order[text[first]],
                "row_key": own,
                "at": local[first].astype(np.int32),
                "gone": gone_bits,
                "open": open_bits,
                "hashes": [packed[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=False)],
            }
        )

    @frugal
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, grams, lengthened = (list(batch[c]) for c in ("text", "grams", "lengthened"))
            order, row_key = batch["place"].to_numpy(), batch["row_key"].to_numpy()
            for i, j in blocks(texts):
                block = Block(texts[i:j], width, prefix)
                if len(block.start):
                    yield rows(block, grams[i:j], lengthened[i:j], order[i:j], row_key[i:j])

    return run


def _judged(depth: int):
    """Stream over sorted subtrees: who is not the first to reach a deep node loses the window."""

    @frugal
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last_key, seen = None, {}
        for batch in batches:
            key, own = batch["key"].to_numpy(), batch["row_key"].to_numpy()
            at = batch["at"].to_numpy().astype(np.int64)
            gone = batch["gone"].to_numpy().astype(np.int64)
            bits = (batch["open"].to_numpy()[:, None] >> np.arange(depth)) & 1
            row, bit = np.nonzero(bits)
            digest = np.frombuffer(b"".join(batch["hashes"]), dtype=np.uint64).reshape(-1, 2)
            start = at[row] + bit
            by = np.lexsort((np.arange(len(row)), digest[:, 1], digest[:, 0], key[row]))
            new = np.ones(len(by), dtype=bool)
            new[1:] = (digest[by][1:] != digest[by][:-1]).any(axis=1)
            new[1:] |= key[row][by][1:] != key[row][by][:-1]
            leader = np.empty(len(by), dtype=np.int64)
            leader[by] = by[np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))]
            repeat = (own[row] != own[row][leader]) | (start != start[leader])
            for i in np.flatnonzero(key[row] == last_key) if last_key is not None else ():
                if (first := seen.get(digest[i].tobytes())) is not None:
                    repeat[i] = first != (own[row[i]], start[i])
            if len(key):
                if key[-1] != last_key:
                    last_key, seen = key[-1], {}
                for i in np.flatnonzero(key[row] == last_key):
                    seen.setdefault(digest[i].tobytes(), (own[row[i]], start[i]))
            gone |= np.bincount(row, np.left_shift(1, bit) * repeat, len(key)).astype(np.int64)
            hit = gone != 0
            yield pd.DataFrame({"row_key": own[hit], "cut": at[hit] << 16 | gone[hit]})

    return run


def _cut(width: int, depth: int):
    @frugal
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            total, removed, kept = [], [], []
            for text, is_first, cuts in zip(batch["text"], batch["first"], batch["cuts"], strict=True):
                words = text.split()
                lost = 0
                if is_first is not True and len(words) >= width:
                    lost, words_left = len(words), []
                elif cuts is not None and len(cuts):
                    cuts = np.asarray(cuts, dtype=np.int64)
                    row, bit = np.nonzero((cuts[:, None] >> np.arange(depth)) & 1)
                    edge = np.zeros(len(words) + 1, dtype=np.int64)
                    np.add.at(edge, (cuts >> 16)[row] + bit, 1)
                    np.add.at(edge, (cuts >> 16)[row] + bit + width, -1)
                    stay = np.cumsum(edge)[:-1] == 0
                    words_left = list(compress(words, stay))
                    lost = len(words) - len(words_left)
                else:
                    words_left = words
                total.append(len(words))
                removed.append(lost)
                kept.append(b" ".join(words_left))
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"], "n_words": total, "n_removed": removed, "kept": kept}
            )

    return run


def remove_repeats(docs: DataFrame, width: int = 20, prefix: int = 6) -> DataFrame:
    """doc_id, n_words, n_removed and kept_text (the words left, joined by one space) per row."""
    depth = width - prefix + 1
    base = keyed(docs).withColumn("text", F.col("text").cast("binary"))
    # Read with the same columns in both joins below, so that one shuffle of it serves both.
    texts = base.select("row_key", "doc_id", "text")

    place = F.coalesce("doc_id", F.lit(LAST)).alias("place")
    digest = F.xxhash64("text")
    anchors = base.select(digest.alias("digest"), "text").mapInPandas(
        _anchors(width, prefix), "anchor long, digest long, times int"
    )
    subtree = Window.partitionBy("anchor")
    shared = F.min("digest").over(subtree) != F.max("digest").over(subtree)
    repeated = (
        anchors.select(
            "digest",
            "anchor",
            (shared | (F.max("times").over(subtree) > 1)).alias("repeated"),
            (F.sum("times").over(subtree) > GROUP_SUFFIXES).alias("lengthen"),
        )
        .where("repeated")
        .groupBy("digest")
        .agg(
            F.collect_set(F.expr("if(lengthen, null, anchor)")).alias("grams"),
            F.collect_set(F.expr("if(lengthen, anchor, null)")).alias("lengthened"),
        )
    )
    first = (
        base.groupBy(digest.alias("digest"), F.sha2("text", 256))
        .agg(F.min(F.struct(place, "row_key")).alias("f"))
        .select("digest", "f.row_key")
    )
    firsts = handover(
        first.join(repeated, "digest", "left").select("row_key", "grams", "lengthened"),
        "first-texts",
    )

    cuts = (
        texts.join(firsts.where("grams IS NOT NULL"), "row_key")
        .select("row_key", "text", place, "grams", "lengthened")
        .mapInPandas(
            _suffixes(width, prefix),
            "key long, place long, row_key long, at int, gone int, open int, hashes binary",
        )
        .repartition("key")
        .sortWithinPartitions("key", "place", "row_key", "at")
        .mapInPandas(_judged(depth), "row_key long, cut long")
        .groupBy("row_key")
        .agg(F.collect_list("cut").alias("cuts"))
    )
    known = firsts.select("row_key", F.lit(True).alias("first")).join(cuts, "row_key", "left")
    return (
        texts.join(known, "row_key", "left")
        .select(for_python(F.col("doc_id")), "text", "first", "cuts")
        .mapInPandas(_cut(width, depth), "doc_id long, n_words long, n_removed long, kept binary")
        .select(from_python("doc_id"), "n_words", "n_removed", F.col("kept").cast("string").alias("kept_text"))
    )


def brute_force(rows: list[tuple], width: int = 20) -> dict:
    """(doc_id, text) rows, ids distinct and not null -> {doc_id: (n_words, n_removed, SHA-256 of
    the words left)}; for tests."""
    seen, result = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - width + 1):
            window = tuple(words[i : i + width])
            if window in seen:
                gone[i : i + width] = [True] * width
            seen.add(window)
        left = [w for w, g in zip(words, gone, strict=True) if not g]
        result[doc_id] = (len(words), sum(gone), hashlib.sha256(b" ".join(left)).hexdigest())
    return result
