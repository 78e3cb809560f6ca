"""Best-fit packing of token sequences by patterns fitted to the length histogram.

1. Texts are tokenised; each document is its ids and one end id, cut into pieces of at most
   `capacity` ids.
2. Only the histogram of piece lengths (at most `capacity` numbers) reaches the driver. There,
   patterns of two to four lengths that fill a sequence exactly, or nearly, are enumerated; non-negative least
   squares says how often to repeat each so that together they use up the histogram; the repeat
   counts are rounded down, and what is left is packed best fit, longest first, a length at a
   time.
3. The plan is a table of (length, first rank, first sequence, offset) blocks; its size depends on
   `capacity`, not on the number of documents. The task that cuts texts numbers its pieces of each
   length; what the tasks before it hold of that length makes it the piece's rank, and the rank
   tells its place. So pieces are written once and placed where they are read.

Defined cases: null text counts as empty and is the end id alone; repeated rows are rows of their
own; null ids are kept; texts of any length are cut into pieces; no rows give no rows; other
columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import cache
from itertools import islice

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orderloom.llm.shared import (
    BROADCAST_ROWS,
    for_python,
    from_python,
    frugal,
    handover,
    text_of,
)

CAPACITY = 2048
END_ID = 0
VOCABULARY = "word_bpe_49k.json"

#: Words remembered within a task, at most about 100 MB, and from one task to the next.
MAX_WORDS, KEPT_WORDS = 400_000, 150_000
#: Tokens a pattern may leave unused.
SLACK = 4
#: Lengths, the most frequent ones, that patterns of three and four are made of.
TRIPLE_LENGTHS, QUAD_LENGTHS = 160, 48
FIT_STEPS = 300

#: One word of lower-case Latin letters and at most one sentence mark: the tokenizer's own rules
#: split it into just these two parts, so its model can be asked directly.
_PLAIN = re.compile(rb"((?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+)([.,]?)")


@cache
def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordTokenizer:
    """The tokenizer's ids, remembered by blank-separated word.

    The vocabulary drops white space and never merges across it, so a text's ids are those of its
    words one after another.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.words: dict[bytes, bytes] = {}

    def _ids(self, word: bytes) -> bytes:
        plain = _PLAIN.fullmatch(word)
        if plain is None:
            text = word.decode("utf-8", "replace")
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            letters = _byte_letters()
            ids = [
                token.id
                for part in plain.groups()
                if part
                for token in self.model.tokenize(part.decode("latin-1").translate(letters))
            ]
        return np.array(ids, dtype="<u4").tobytes()

    def encode(self, text: bytes) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        # Special tokens are recognised by their exact spelling.
        words = (text if b"<|" in text else text.lower()).split()
        known = self.words
        for word in set(words).difference(known):
            known[word] = self._ids(word)
        ids = b"".join([known[w] for w in words])
        if len(known) > MAX_WORDS:
            self.forget()
        return ids

    def forget(self) -> None:
        """Keep the words that came first, which are the common ones."""
        if len(self.words) > KEPT_WORDS:
            self.words = dict(islice(self.words.items(), KEPT_WORDS))


@cache
def _tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def tokenized(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids, part, number); ids are little-endian unsigned
    32-bit numbers, and number counts the pieces of a length within the task, part."""
    path = path or public_tokenizers.path(VOCABULARY)
    end = np.array([END_ID], dtype="<u4").tobytes()

    @frugal
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = _tokenizer(path)
        part, numbers = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = tokenizer.encode(text) + end
                count = len(ids) // 4
                rows += [
                    (doc_id, i, at, min(capacity, count - at), ids[4 * at : 4 * (at + capacity)])
                    for i, at in enumerate(range(0, count, capacity))
                ]
            pieces = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids"])
            lengths = pieces["length"].to_numpy(dtype=np.int64)
            pieces["part"] = part
            pieces["number"] = numbers[lengths] + pieces.groupby("length").cumcount().to_numpy()
            numbers += np.bincount(lengths, minlength=capacity + 1)
            yield pieces
        tokenizer.forget()

    texts = docs.select(for_python(docs["doc_id"]), text_of(docs).cast("binary").alias("text"))
    pieces = texts.mapInPandas(
        run, "doc_id long, piece int, start long, length long, ids binary, part int, number long"
    )
    return pieces.withColumn("doc_id", from_python("doc_id"))


def _patterns(counts: np.ndarray, capacity: int) -> np.ndarray:
    """Rows of up to four lengths, zero-padded, that fill a sequence but for SLACK at most."""
    present = np.flatnonzero(counts)
    found = []

    def close(parts: np.ndarray, rest: np.ndarray) -> None:
        """Add the longest present length that still fits, if it leaves little."""
        at = np.searchsorted(present, rest, side="right") - 1
        last = present[np.maximum(at, 0)]
        # Lengths in falling order, so each set of lengths appears once.
        good = (at >= 0) & (rest - last <= SLACK) & (last <= parts[:, -1])
        rows = np.column_stack([parts[good], last[good]])
        found.append(np.pad(rows, ((0, 0), (0, 4 - rows.shape[1]))))

    close(present[:, None], capacity - present)
    frequent = np.argsort(-counts[present], kind="stable")
    for most, size in ((TRIPLE_LENGTHS, 2), (QUAD_LENGTHS, 3)):
        some = np.sort(present[frequent[:most]])[::-1]
        grid = np.meshgrid(*[some] * size, indexing="ij")
        parts = np.column_stack([g.ravel() for g in grid])
        falling = (np.diff(parts, axis=1) <= 0).all(axis=1)
        rest = capacity - parts.sum(axis=1)
        keep = falling & (rest > 0)
        close(parts[keep], rest[keep])
    return np.concatenate(found)


def _fitted(patterns: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Repeat counts x >= 0 that minimise the squared difference between use and histogram."""
    target = counts.astype(float)
    size = len(counts)

    def used(x: np.ndarray) -> np.ndarray:
        total = np.zeros(size)
        for column in patterns.T:
            total += np.bincount(column, x, size)
        total[0] = 0
        return total

    # A bound on the largest eigenvalue: row sums of the product of absolute values.
    share = used(np.ones(len(patterns)))
    step = 1 / max(1.0, share[patterns].sum(axis=1).max(initial=0))
    x = np.zeros(len(patterns))
    ahead, momentum = x, 1.0
    target[0] = 0
    for _ in range(FIT_STEPS):
        error = used(ahead) - target
        error[0] = 0
        new = np.maximum(0, ahead - step * error[patterns].sum(axis=1))
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead = new + (momentum - 1) / following * (new - x)
        x, momentum = new, following
    return x


class Plan:
    """Blocks of pieces of one length laid at one offset of consecutive sequences."""

    def __init__(self, histogram: dict[int, int], capacity: int = CAPACITY):
        self.capacity = capacity
        self.left = np.zeros(capacity + 1, dtype=np.int64)
        for length, count in histogram.items():
            self.left[length] = count
        self.rank = np.zeros(capacity + 1, dtype=np.int64)
        self.sequences = 0
        self.blocks: list[tuple[int, int, int, int]] = []
        self._whole()
        self._repeat_patterns()
        self._best_fit()
        table = np.array(sorted(self.blocks), dtype=np.int64).reshape(-1, 4)
        self.key = table[:, 0] << 48 | table[:, 1]
        self.first_rank, self.first_sequence, self.offset = table[:, 1], table[:, 2], table[:, 3]

    def _lay(self, length: int, count: int, sequence: int, offset: int) -> None:
        self.blocks.append((int(length), int(self.rank[length]), int(sequence), int(offset)))
        self.rank[length] += count
        self.left[length] -= count

    def _whole(self) -> None:
        if count := int(self.left[self.capacity]):
            self._lay(self.capacity, count, 0, 0)
            self.sequences += count

    def _repeat_patterns(self) -> None:
        if not self.left.any():
            return
        patterns = _patterns(self.left, self.capacity)
        repeats = np.floor(_fitted(patterns, self.left)).astype(np.int64)
        for i in np.argsort(-repeats, kind="stable"):
            if not repeats[i]:
                break
            lengths, times = np.unique(patterns[i][patterns[i] > 0], return_counts=True)
            count = min(int(repeats[i]), int((self.left[lengths] // times).min()))
            if not count:
                continue
            offset = 0
            for length in patterns[i][patterns[i] > 0]:
                self._lay(length, count, self.sequences, offset)
                offset += length
            self.sequences += count

    def _best_fit(self) -> None:
        """Longest first, each into the fullest open sequence that takes it; sequences with equal
        room are handled together."""
        rooms: list[int] = []  # sorted, the rooms that have open sequences
        open_: dict[int, list[tuple[int, int]]] = {}

        def add(room: int, sequence: int, count: int) -> None:
            if room:
                if room not in open_:
                    insort(rooms, room)
                    open_[room] = []
                open_[room].append((sequence, count))

        for length in range(self.capacity - 1, 0, -1):
            while self.left[length]:
                at = bisect_left(rooms, length)
                if at < len(rooms):
                    room = rooms[at]
                    sequence, count = open_[room].pop()
                    if not open_[room]:
                        del open_[room]
                        rooms.pop(at)
                    used = min(count, int(self.left[length]))
                    if used < count:
                        add(room, sequence + used, count - used)
                    self._lay(length, used, sequence, self.capacity - room)
                    add(room - length, sequence, used)
                    continue
                each = self.capacity // length
                count = max(1, int(self.left[length]) // each)
                for i in range(min(each, int(self.left[length]))):
                    self._lay(length, count, self.sequences, i * length)
                add(self.capacity - min(each, i + 1) * length, self.sequences, count)
                self.sequences += count

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the pieces with these lengths and ranks."""
        block = np.searchsorted(self.key, length << 48 | rank, side="right") - 1
        return self.first_sequence[block] + rank - self.first_rank[block], self.offset[block]


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to numbered pieces; the column length must be 1 to capacity.

    Numbers are those of `tokenized`: from 0 in each part and length, without gaps. They are written
    with the pieces, so a task that runs again reads them as they were.
    """
    written = handover(pieces, "pieces")
    counts = handover(written.groupBy("length", "part").agg(F.count(F.lit(1)).alias("held")), "counts")
    histogram = {
        r["length"]: r["held"]
        for r in counts.groupBy("length").agg(F.sum("held").alias("held")).collect()  # `capacity` rows
    }
    plan = Plan(histogram, capacity)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("base"))
    if counts.count() <= BROADCAST_ROWS:
        bases = F.broadcast(bases)

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = plan.place(length.to_numpy(), rank.to_numpy())
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    kept = [c for c in written.columns if c not in ("part", "number")]
    ranked = written.join(bases, ["length", "part"]).withColumn("number", F.col("number") + F.col("base"))
    placed = ranked.select(*kept, place("length", "number").alias("place"))
    return placed.select(*kept, "place.sequence_id", "place.offset")


def packed(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their ids, sequence_id and offset."""
    return pack(tokenized(docs, path, capacity), capacity)
