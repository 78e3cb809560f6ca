"""Documents that quote benchmark items, found by SimHash over item-sized windows.

For an item of n words, a document's windows of n words are compared with it. Each window and each
item has a SimHash over its weighted word shingles. The items' fingerprints stand in a multi-index:
eight blocks of eight bits, so that within `RADIUS` differing bits some block differs in at most
RADIUS // 8. Items in reach of a window by any block are compared in full, and those within the
radius are verified by the exact weighted Jaccard similarity of the two bags of shingles.

A shingle weighs one divided by the number of items that hold it, so what many items share counts
little. An item that shares shingles with others is also compared with all weights one, by
fingerprints of their own: a window is a quote if either similarity reaches the threshold, so
repeats and variants of an item in the benchmark never hide a copy of it. The weighted similarity is
reported where it reaches the threshold, the unweighted one elsewhere.

A window that shares no shingle with an item has similarity zero; sliding a window until a
shared shingle stands at its start or its end loses none. So only windows that begin or end with a
shingle of some item are fingerprinted, which skips no window that could be verified.

The benchmark is taken in blocks of about `BLOCK_BYTES`, each sent to the tasks as a whole; every
block meets all documents. With more than one block, Spark counts the items that hold each shingle over
the whole benchmark, and each block carries all shingles that several items hold with their weights
(16 bytes each). An item is compared with windows of its own size that begin or end with one of its own
shingles, or stand at an end of the document; so results do not depend on the blocks.

Defined cases: null text counts as empty; items without words match nothing; an item of fewer words
than a shingle is one shingle of all its words; a document shorter than the item is one window, and
without a shingle quotes nothing; items may repeat; an item without an id is
found like any other, but not listed; rows equal in id and text share a result; no documents or no items
give no leaks; other columns are kept by `drop_contaminated` and not read otherwise.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.shared import (
    NULL_ID,
    blocks,
    for_python,
    frugal,
    handover,
    keyed,
    text_of,
    windows,
    without,
    word_hashes,
)

SHINGLE = 5
SIMILARITY = 0.8
#: Differing bits at which windows are still verified: similarity 0.8 lies near 10 bits, and
#: beyond 23 with a chance of about one in 100,000.
RADIUS = 23
#: Item text sent to the tasks at once.
BLOCK_BYTES = 8 << 20

_TABLE_BITS = 20


def _simhash(shingles: np.ndarray, weights: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """A fingerprint for each run of shingles; runs begin at the given places and are not empty."""
    bits = np.unpackbits(shingles.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    votes = (bits.astype(np.float32) * 2 - 1) * weights[:, None].astype(np.float32)
    sums = np.add.reduceat(votes, begin, axis=0)
    packed = np.packbits(sums > 0, axis=1, bitorder="little")
    return np.ascontiguousarray(packed).view(np.uint64).ravel()


def _distinct(bag: Counter) -> np.ndarray:
    return np.fromiter(bag, dtype=np.uint64, count=len(bag))


def _table(values: np.ndarray) -> np.ndarray:
    """Which leading bits the values have."""
    table = np.zeros(1 << _TABLE_BITS, dtype=bool)
    table[values >> np.uint64(64 - _TABLE_BITS)] = True
    return table


def _found(
    shingles: np.ndarray, distinct: np.ndarray, table: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Places of the shingles that are among the distinct ones, and their numbers there."""
    at = np.flatnonzero(table[shingles >> np.uint64(64 - _TABLE_BITS)])
    number = np.minimum(np.searchsorted(distinct, shingles[at]), len(distinct) - 1)
    good = distinct[number] == shingles[at]
    return at[good], number[good]


class _Prints:
    """Fingerprints of some items and their block tables."""

    def __init__(self, items: np.ndarray, prints: np.ndarray):
        self.items, self.prints = items, prints
        # reach[b][v]: items whose block b is within RADIUS // 8 bits of v.
        values = np.arange(256, dtype=np.uint8)
        own = prints.view(np.uint8).reshape(-1, 8)
        self.reach = [
            np.bitwise_count(values[:, None] ^ own[None, :, b]) <= RADIUS // 8 for b in range(8)
        ]

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (fingerprint, item) within the radius."""
        own = prints.view(np.uint8).reshape(-1, 8)
        maybe = np.zeros((len(prints), len(self.items)), dtype=bool)
        for b in range(8):
            maybe |= self.reach[b][own[:, b]]
        row, item = np.nonzero(maybe)
        close = np.bitwise_count(prints[row] ^ self.prints[item]) <= RADIUS
        return row[close], self.items[item[close]]


class ItemIndex:
    """Shingles, fingerprints and block tables of some benchmark items.

    `shared` has the shingles that several items of the whole benchmark hold, in order, and the
    numbers of those items; without it the given items are the whole benchmark.
    """

    def __init__(
        self,
        items: list[tuple[int, bytes]],
        shingle: int = SHINGLE,
        shared: tuple[np.ndarray, np.ndarray] | None = None,
    ):
        words, _, begin = word_hashes([text.lower() for _, text in items])
        self.ids, self.size, self.width, bags = [], [], [], []
        for i, (item_id, _) in enumerate(items):
            own = words[begin[i] : begin[i + 1]]
            if len(own):
                self.ids.append(item_id)
                self.size.append(len(own))
                self.width.append(min(shingle, len(own)))
                bags.append(windows(own, self.width[-1]))
        self.bags = [Counter(bag.tolist()) for bag in bags]
        if shared is None:
            held = Counter(s for bag in self.bags for s in bag)
            several = sorted((s, n) for s, n in held.items() if n > 1)
            shared = (
                np.array([s for s, _ in several], dtype=np.uint64),
                np.array([n for _, n in several], dtype=np.int64),
            )
        self.shared, self.light = shared[0], 1 / shared[1]
        self.shared_table = _table(self.shared)
        self.total = [
            sum(n * w for n, w in zip(bag.values(), self.weights(_distinct(bag)), strict=True))
            for bag in self.bags
        ]
        self.size = np.array(self.size, dtype=np.int64)
        self.width = np.array(self.width, dtype=np.int64)
        if not bags:
            return
        counts = np.array([len(bag) for bag in bags])
        flat = np.concatenate(bags)
        weights = self.weights(flat)
        begin = np.cumsum(counts) - counts
        self.prints = _Prints(np.arange(len(bags)), _simhash(flat, weights, begin))
        # Items that share a shingle are looked up by unweighted fingerprints, too.
        common = np.flatnonzero(np.minimum.reduceat(weights, begin) < 1)
        plain = _simhash(flat, np.ones(len(flat)), begin)[common]
        self.plain = _Prints(common, plain) if len(common) else None
        # For each width, the distinct shingles and the items that hold each.
        self.known = {}
        for width in sorted(set(self.width.tolist())):
            pairs = sorted(
                (s, i) for i, bag in enumerate(self.bags) if self.width[i] == width for s in bag
            )
            value = np.array([s for s, _ in pairs], dtype=np.uint64)
            distinct, first = np.unique(value, return_index=True)
            holder = np.array([i for _, i in pairs], dtype=np.int64)
            self.known[width] = distinct, np.append(first, len(pairs)), holder, _table(distinct)

    def hits(self, shingles: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of shingles that some item holds, and their numbers."""
        distinct, _, _, table = self.known[width]
        return _found(shingles, distinct, table)

    def weights(self, shingles: np.ndarray) -> np.ndarray:
        """One divided by the number of items of the whole benchmark that hold each shingle; one
        where none does."""
        weights = np.ones(len(shingles))
        at, number = _found(shingles, self.shared, self.shared_table)
        weights[at] = self.light[number]
        return weights

    def similarity(self, window: np.ndarray, item: int, plain: bool = False) -> float:
        bag = Counter(window.tolist())
        own = self.bags[item]
        if plain:
            both = sum(min(n, own[s]) for s, n in bag.items() if s in own)
            return both / (len(window) + own.total() - both)
        weighted = list(zip(bag.items(), self.weights(_distinct(bag)).tolist(), strict=True))
        total = sum(n * w for (_, n), w in weighted)
        both = sum(min(n, own[s]) * w for (s, n), w in weighted if s in own)
        return both / (total + self.total[item] - both)

    def leaks(self, texts: list[bytes], threshold: float) -> Iterator[tuple[int, int, int, float]]:
        """(text, item, start, similarity): the best window of each text for each item it quotes."""
        if not self.ids:
            return
        words, _, begin = word_hashes([t.lower() for t in texts])
        text_of_word = np.repeat(np.arange(len(texts)), np.diff(begin))
        # (text, item): weighted or not, similarity, start; the weighted one goes first.
        best: dict[tuple[int, int], tuple[bool, float, int]] = {}
        for width, (_, first, holder, _) in self.known.items():
            shingles = windows(words, width)
            inside = np.arange(len(shingles)) + width <= begin[1:][text_of_word[: len(shingles)]]
            at, number = self.hits(shingles, width)
            at, number = at[inside[at]], number[inside[at]]
            if not len(at):
                continue
            # A window for each hit and each size of item that holds the shingle.
            times = first[number + 1] - first[number]
            hit = np.repeat(np.arange(len(at)), times)
            nth = np.arange(len(hit)) - np.repeat(np.cumsum(times) - times, times)
            size = self.size[holder[first[number][hit] + nth]]
            place = at[hit]
            text = text_of_word[place]
            lowest = begin[:-1][text]
            highest = np.maximum(lowest, begin[1:][text] - size)
            for start in (place, place + width - size):
                start = np.clip(start, lowest, highest)
                count = np.minimum(size, begin[1:][text] - start) - width + 1
                self._compare(shingles, start, count, text, width, threshold, begin, best)
        for (text, item), (_, similarity, start) in sorted(best.items()):
            yield text, item, -start, similarity

    def _compare(self, shingles, start, count, text, width, threshold, begin, best):
        _, chosen = np.unique(np.column_stack([start, count]), axis=0, return_index=True)
        start, count, text = start[chosen], count[chosen], text[chosen]
        lowest, highest = begin[:-1][text], begin[1:][text]
        step = 4096
        for a in range(0, len(start), step):
            size = count[a : a + step]
            total = np.cumsum(size)
            flat = np.arange(total[-1]) - np.repeat(total - size, size)
            window = shingles[np.repeat(start[a : a + step], size) + flat]
            for near in (self.prints, self.plain):
                if near is None:
                    continue
                weights = np.ones(len(window)) if near is self.plain else self.weights(window)
                row, item = near.near(_simhash(window, weights, total - size))
                row += a
                # Windows of the item's size, or whole texts that are shorter.
                words = np.minimum(self.size[item], (highest - lowest)[row])
                fits = (self.width[item] == width) & (count[row] == words - width + 1)
                for i, item, words in zip(row[fits], item[fits], words[fits], strict=True):
                    own = shingles[start[i] : start[i] + count[i]]
                    edge = start[i] == lowest[i] or start[i] + words == highest[i]
                    bag = self.bags[item]
                    if not (edge or int(own[0]) in bag or int(own[-1]) in bag):
                        continue
                    similarity = self.similarity(own, item, near is self.plain)
                    if similarity >= threshold:
                        key = (int(text[i]), int(item))
                        place = -int(start[i] - begin[text[i]])
                        found = (near is self.prints, similarity, place)
                        best[key] = max(best.get(key, (False, 0.0, 0)), found)


def _shared(items: DataFrame, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """The shingles that several items hold, in order, and the numbers of those items."""

    @frugal
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t.lower() for t in batch["text"]]
            for i, j in blocks(texts):
                words, _, begin = word_hashes(texts[i:j])
                bags = [
                    np.unique(windows(words[a:b], min(shingle, b - a)))
                    for a, b in zip(begin[:-1], begin[1:], strict=True)
                    if b > a
                ]
                if bags:
                    yield pd.DataFrame({"shingle": np.concatenate(bags).view(np.int64)})

    held = items.select("text").mapInPandas(run, "shingle long").groupBy("shingle").count()
    several = held.where("count > 1").toArrow()
    shingles = several["shingle"].to_numpy().view(np.uint64)
    order = np.argsort(shingles)
    return shingles[order], several["count"].to_numpy()[order]


def leaks(
    docs: DataFrame, benchmark: DataFrame, threshold: float = SIMILARITY, shingle: int = SHINGLE
) -> DataFrame:
    """(row_key, item_id, start, similarity): each item a document quotes, at its best window."""
    items = benchmark.select(
        for_python(benchmark["item_id"]).alias("item_id"),
        text_of(benchmark).cast("binary").alias("text"),
    )
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = 1 + size // BLOCK_BYTES
    texts = keyed(docs).select("row_key", F.col("text").cast("binary").alias("text"))
    schema = "row_key long, item_id long, start int, similarity double"
    shared = _shared(items, shingle) if parts > 1 else None
    found = None
    for part in range(parts):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        index = ItemIndex([(r.item_id, bytes(r.text)) for r in block.collect()], shingle, shared)

        @frugal
        def run(batches: Iterator[pd.DataFrame], index=index) -> Iterator[pd.DataFrame]:
            for batch in batches:
                texts, row_key = list(batch["text"]), batch["row_key"].to_numpy()
                for i, j in blocks(texts):
                    rows = [
                        (row_key[i + text], index.ids[item], start, similarity)
                        for text, item, start, similarity in index.leaks(texts[i:j], threshold)
                    ]
                    yield pd.DataFrame(rows, columns=["row_key", "item_id", "start", "similarity"])

        more = texts.mapInPandas(run, schema)
        found = more if found is None else found.union(more)
    return found.withColumn("item_id", F.nullif(F.col("item_id"), F.lit(NULL_ID)))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, contaminated, items (sorted item ids) and similarity (the best) per row of docs."""
    found = (
        leaks(docs, benchmark)
        .groupBy("row_key")
        .agg(
            F.array_sort(F.collect_set("item_id")).alias("items"),
            F.max("similarity").alias("similarity"),
        )
    )
    rows = keyed(docs).select("row_key", "doc_id")
    return rows.join(handover(found, "leaks"), "row_key", "left").select(
        "doc_id",
        F.col("items").isNotNull().alias("contaminated"),
        F.coalesce("items", F.array().cast("array<long>")).alias("items"),
        F.coalesce("similarity", F.lit(0.0)).alias("similarity"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, with all columns, that quote no item."""
    return without(docs, leaks(docs, benchmark))
