"""Phrase collocations from a weighted de Bruijn graph of word sequences.

Nodes are sequences of `longest - 1` words, and an edge is the `longest`-gram that leads from its
first to its last words; its weight is how often it occurs within a piece of text.

1. Each word of a piece begins one gram of up to `longest` words. Those of full length are the
   edges; the shorter ones, at the end of a piece, are what flows out of a node without an edge.
   A task counts the grams of some megabytes of text and sends them in compressed lists, one for
   each bucket of first word pairs, with the words of a list beside it; so a passage that a third of
   all rows hold is an entry per list.
2. Shorter counts are never read from texts again: a node's count is its flow, the weights of the
   edges that leave it plus the piece ends at it; the same sum over first words gives the counts of
   pairs and words, and over everything the number of words. A bucket holds all grams of its
   pairs, so it adds up the edges, nodes and pairs at once and passes on what reaches `least`. A pair
   with more than SPREAD grams in a list is spread over buckets by its first three words, and what
   other lists hold of it passes through its own bucket as it is: such grams are summed afterwards.
3. The graph of the edges that reach `least` is compacted: a node with one edge in and one out joins
   the two, and pointers that double each round give every edge the head of its unary path and its
   place there. Paths are cut into stretches of STRETCH edges. A stretch tells each shorter phrase
   in it the largest weight among the edges around it at once, which is what decides whether the
   phrase is dropped for a longer one.

Counts are keyed by the words themselves, so no two phrases are mistaken for each other.

Defined cases: null text counts as empty, null language as `und`; documents are rows, whatever
their ids; texts and pieces of any length are taken whole; no rows give no rows; other columns are
not read.
"""

from __future__ import annotations

import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.shared import frugal, handover, mix, text_of

#: Fixed values of the report.
LONGEST = 4
LEAST = 30
COVERED_PERCENT = 80
TOP = 2000
SCALE = 2_000_000

#: Lower-case A-Z, every piece end as a line feed, a tab as a blank.
_FOLD = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" "
)

#: Words counted together by a task, and bytes of text for each bucket.
LIST_WORDS = 2_500_000
BUCKET_BYTES = 16 << 20

#: Grams of one word pair in a list beyond which the pair is spread over buckets.
SPREAD = 4096

#: Edges of a compacted path that stand in one row.
STRETCH = 256

EXACT = "decimal(38,0)"


class _Words(dict):
    """Numbers for words, from 1 in the order they are met; 0 is the end of a piece."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self) + 1
        return number


def _pack(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def _unpack(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


def _summed(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in order, with the sums of their counts."""
    if not len(grams):
        return grams, counts
    wide = grams.astype(np.int64)
    if wide.shape[1] % 2:
        wide = np.column_stack([wide, np.zeros(len(wide), dtype=np.int64)])
    codes = wide[:, 0::2] << 32 | wide[:, 1::2]
    order = np.lexsort(codes.T[::-1])
    codes = codes[order]
    first = np.flatnonzero(np.concatenate(([True], (codes[1:] != codes[:-1]).any(axis=1))))
    return grams[order[first]], np.add.reduceat(counts[order], first)


def _prefixes(grams: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The first place of each different run of `size` words in sorted rows, and its sum."""
    if not len(grams):
        return np.zeros(0, dtype=np.int64), counts
    new = (grams[1:, :size] != grams[:-1, :size]).any(axis=1)
    first = np.flatnonzero(np.concatenate(([True], new)))
    return first, np.add.reduceat(counts, first)


def _lists(longest: int, buckets: int, spread: int, list_words: int):
    """(bucket, lang, kind, words, grams): compressed lists. Kinds: p grams by first pair, s grams of
    spread pairs, m pairs that are spread somewhere. Grams are numbers of the list's own words, 0
    where a piece has ended, and a count each."""

    def rows(lang: str, words: _Words, ids: array) -> Iterator[tuple]:
        flat = np.concatenate([np.frombuffer(ids, dtype=np.int32), np.zeros(longest, dtype=np.int32)])
        begins = np.flatnonzero(flat > 0)
        flat = np.abs(flat)
        grams = np.column_stack([flat[begins + k] for k in range(longest)])
        for k in range(1, longest):
            grams[grams[:, k - 1] == 0, k] = 0
        grams, counts = _summed(grams, np.ones(len(grams), dtype=np.int64))
        names, salt = [b"", *words], zlib.crc32(lang.encode())
        hashes = np.array([zlib.crc32(w, salt) for w in names], dtype=np.uint64)
        own = hashes[grams[:, 0]] * np.uint64(0x9E3779B97F4A7C15) + hashes[grams[:, 1]]
        third = hashes[grams[:, min(2, longest - 1)]] * np.uint64(0xC2B2AE3D27D4EB4F)
        first, _ = _prefixes(grams, counts, 2)
        sizes = np.diff(np.append(first, len(grams)))
        crowded = np.repeat(sizes > spread, sizes)

        def listed(kind: str, chosen: np.ndarray, place: np.ndarray, width: int) -> Iterator[tuple]:
            place = (mix(place) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(place, kind="stable")
            place, chosen = place[order], chosen[order]
            edges = np.flatnonzero(np.diff(place, prepend=-1))
            for i, j in zip(edges, [*edges[1:], len(place)], strict=False):
                at = chosen[i:j]
                used, numbers = np.unique(grams[at, :width], return_inverse=True)
                text = b"\n".join([names[n] for n in used])
                table = np.column_stack([numbers.reshape(len(at), width), counts[at]])
                yield int(place[i]), lang, kind, _pack(text), _pack(table.T.astype("<i4").tobytes())

        yield from listed("p", np.flatnonzero(~crowded), own[~crowded], longest)
        yield from listed("s", np.flatnonzero(crowded), mix(own[crowded]) ^ third[crowded], longest)
        marks = first[sizes > spread]
        yield from listed("m", marks, own[marks], 2)

    def packed(held) -> Iterator[pd.DataFrame]:
        for lang, (words, ids) in held.items():
            found = list(rows(lang, words, ids))
            yield pd.DataFrame(found, columns=["bucket", "lang", "kind", "words", "grams"])

    def fresh():
        return defaultdict(lambda: (_Words(), array("i")))

    @frugal
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = fresh(), 0
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                for piece in text.translate(_FOLD).split(b"\n"):
                    own = piece.split()
                    for at in range(0, len(own), list_words):
                        words, ids = held[lang]
                        some = own[at : at + list_words]
                        ids.extend(map(words.__getitem__, some))
                        # Words of the next part end this part's grams and begin none: negative.
                        more = own[at + list_words : at + list_words + longest - 1]
                        ids.extend([-words[w] for w in more])
                        ids.append(0)
                        size += len(some)
                        if size >= list_words:
                            yield from packed(held)
                            held, size = fresh(), 0
        yield from packed(held)

    return run


class _Bucket:
    """The grams of one bucket and language, list by list, under common numbers."""

    def __init__(self, longest: int):
        self.words = _Words()
        self.longest = longest
        self.parts: dict[str, list[np.ndarray]] = {"p": [], "s": [], "m": []}

    def add(self, kind: str, words: bytes, grams: bytes) -> None:
        names = _unpack(words).split(b"\n")
        number = np.array([self.words[n] if n else 0 for n in names], dtype=np.int32)
        width = 2 if kind == "m" else self.longest
        table = np.frombuffer(_unpack(grams), dtype="<i4").reshape(width + 1, -1).T
        self.parts[kind].append(np.column_stack([number[table[:, :-1]], table[:, -1]]))

    def summed(self, kind: str) -> tuple[np.ndarray, np.ndarray]:
        width = 2 if kind == "m" else self.longest
        table = np.concatenate([np.zeros((0, width + 1), dtype=np.int32), *self.parts[kind]])
        return _summed(np.ascontiguousarray(table[:, :-1]), table[:, -1].astype(np.int64))

    def flows(self, lang: str, least: int) -> Iterator[tuple]:
        names = ["", *(w.decode("utf-8", "replace") for w in self.words)]

        def shown(gram: np.ndarray) -> tuple[int, str]:
            own = [names[n] for n in gram if n]
            return len(own), " ".join(own)

        grams, counts = self.summed("p")
        loose, times = self.summed("s")
        words = np.zeros(len(names), dtype=np.int64)
        np.add.at(words, grams[:, 0], counts)
        np.add.at(words, loose[:, 0], times)
        marked, _ = self.summed("m")
        if len(marked):
            code = grams[:, 0].astype(np.int64) << 32 | grams[:, 1]
            held = np.isin(code, marked[:, 0].astype(np.int64) << 32 | marked[:, 1])
            loose, times = np.concatenate([loose, grams[held]]), np.concatenate([times, counts[held]])
            grams, counts = grams[~held], counts[~held]
        for size in range(2, self.longest + 1):
            first, total = _prefixes(grams, counts, size)
            good = (total >= least) & (grams[first, size - 1] > 0)
            for at, n in zip(first[good], total[good], strict=True):
                yield lang, *shown(grams[at, :size]), int(n), False
        for gram, n in zip(loose, times, strict=True):
            yield lang, *shown(gram), int(n), True
        for word in np.flatnonzero(words):
            yield lang, 1, names[word], int(words[word]), False
        yield lang, 0, "", int(words.sum()), False


def _flows(longest: int, least: int):
    """What buckets pass on: (lang, size, phrase, f, raw). Rows of size 0 and 1 are parts of sums;
    raw rows are grams of spread pairs, not yet summed over all buckets."""

    def framed(rows: Iterator[tuple]) -> Iterator[pd.DataFrame]:
        while some := list(islice(rows, 50_000)):
            yield pd.DataFrame(some, columns=["lang", "size", "phrase", "f", "raw"])

    @frugal
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, held = None, None
        for batch in batches:
            for bucket, lang, kind, words, grams in batch.itertuples(index=False):
                if at != (bucket, lang):
                    if held is not None:
                        yield from framed(held.flows(at[1], least))
                    at, held = (bucket, lang), _Bucket(longest)
                held.add(kind, words, grams)
        if held is not None:
            yield from framed(held.flows(at[1], least))

    return run


def frequent(
    docs: DataFrame,
    longest: int = LONGEST,
    least: int = LEAST,
    spread: int = SPREAD,
    list_words: int = LIST_WORDS,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """(lang, phrase, size, f) of all phrases of 1 to `longest` words that reach `least`; and, as
    the phrase of size 0, all words of a language."""
    texts = docs.select(
        F.coalesce(docs["lang"].cast("string"), F.lit("und")).alias("lang"),
        text_of(docs).cast("binary").alias("text"),
    )
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    lists = texts.mapInPandas(
        _lists(longest, max(1, -(-size // bucket_bytes)), spread, list_words),
        "bucket int, lang string, kind string, words binary, grams binary",
    )
    flows = (
        lists.repartition("bucket", "lang")
        .sortWithinPartitions("bucket", "lang")
        .mapInPandas(_flows(longest, least), "lang string, size int, phrase string, f long, raw boolean")
    )
    flows = handover(flows, "flows")
    # Grams of spread pairs: the edges first, then what flows through their nodes and pairs.
    loose = flows.where("raw AND size >= 2").groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f"))
    nodes = F.transform(
        F.sequence(F.lit(2), F.greatest("size", F.lit(2))),
        lambda k: F.struct(
            k.alias("size"), F.call_function("substring_index", F.col("phrase"), F.lit(" "), k).alias("phrase")
        ),
    )
    loose = loose.select("lang", "f", F.explode(nodes).alias("node")).select(
        "lang", "node.size", "node.phrase", "f"
    )
    counts = (
        flows.where("NOT raw").select("lang", "size", "phrase", "f").unionByName(loose)
        .groupBy("lang", "size", "phrase")
        .agg(F.sum("f").alias("f"))
    )
    return handover(counts.where((F.col("f") >= least) | (F.col("size") == 0)), "phrases")


def _links(edges: DataFrame, longest: int) -> DataFrame:
    """(lang, edge, head, place): every edge with the one before it on its unary path, or itself."""
    first = F.substring_index("phrase", " ", longest - 1)
    last = F.substring_index("phrase", " ", 1 - longest)
    arriving = edges.groupBy("lang", last.alias("node")).agg(
        F.count(F.lit(1)).alias("n_in"), F.min("phrase").alias("before")
    )
    leaving = edges.groupBy("lang", first.alias("node")).agg(
        F.count(F.lit(1)).alias("n_out"), F.min("phrase").alias("edge")
    )
    joints = (
        arriving.join(leaving, ["lang", "node"])
        .where("n_in = 1 AND n_out = 1 AND before <> edge")
        .select("lang", "edge", "before")
    )
    return (
        edges.select("lang", F.col("phrase").alias("edge"))
        .join(joints, ["lang", "edge"], "left")
        .select(
            "lang",
            "edge",
            F.coalesce("before", "edge").alias("head"),
            F.col("before").isNotNull().cast("long").alias("place"),
        )
    )


def paths(edges: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(lang, head, part, words, weights): unary paths of the graph, STRETCH edges a row.

    Pointer doubling: each round replaces an edge's pointer by its target's, so a path of n edges
    takes log2(n) rounds. An edge on a closed ring never meets a head and stays a path of its own.
    """
    linked = handover(_links(edges, longest), "path-links")
    moved, rounds = linked.where("place > 0").count(), 0
    most = max(1, moved).bit_length()
    while moved and rounds <= most:
        target = linked.select(
            "lang",
            F.col("edge").alias("head"),
            F.col("head").alias("further"),
            F.col("place").alias("more"),
        )
        linked = handover(
            linked.join(target, ["lang", "head"]).select(
                "lang",
                "edge",
                F.col("further").alias("head"),
                (F.col("place") + F.col("more")).alias("place"),
                (F.col("more") > 0).alias("moved"),
            ),
            "path-links",
        )
        moved = linked.where("moved").count()
        linked = linked.drop("moved")
        rounds += 1
    if moved:  # rings: no head among them
        heads = linked.where("place = 0").select("lang", F.col("edge").alias("head"))
        on_path = linked.join(heads, ["lang", "head"], "left_semi")
        rings = linked.join(heads, ["lang", "head"], "left_anti")
        alone = rings.select("lang", "edge", F.col("edge").alias("head"), F.lit(0).cast("long").alias("place"))
        linked = on_path.unionByName(alone)
    step = F.struct("place", "edge", F.col("f").alias("weight"))
    stretches = (
        linked.join(edges.select("lang", F.col("phrase").alias("edge"), "f"), ["lang", "edge"])
        .groupBy("lang", "head", F.expr(f"place div {STRETCH}").alias("part"))
        .agg(F.array_sort(F.collect_list(step)).alias("steps"))
    )
    ends = F.transform(
        F.slice("steps", 2, F.size("steps")), lambda s: F.substring_index(s["edge"], " ", -1)
    )
    return stretches.select(
        "lang",
        "head",
        "part",
        F.concat(F.split(F.get("steps", F.lit(0))["edge"], " ", -1), ends).alias("words"),
        F.col("steps.weight").alias("weights"),
    )


def covers(phrases: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(lang, phrase, cover): the largest count among the candidates that a phrase lies inside."""
    stretches = paths(phrases.where(F.col("size") == longest), longest)

    def in_stretch(size: int):
        def at(i: Column) -> Column:
            # The edges around word i of a stretch begin at most longest - size words before it.
            around = F.array(*(F.get("weights", i - b) for b in range(longest - size + 1)))
            phrase = F.array_join(F.slice("words", i + 1, size), " ")
            return F.struct(phrase.alias("phrase"), F.array_max(around).alias("cover"))

        return F.explode(F.transform(F.sequence(F.lit(0), F.size("words") - size), at))

    def in_phrase(size: int, longer: int):
        words = F.split("phrase", " ", -1)
        starts = F.sequence(F.lit(1), F.lit(longer - size + 1))
        return F.explode(F.transform(starts, lambda i: F.array_join(F.slice(words, i, size), " ")))

    frames = []
    for size in range(2, longest):
        frames.append(stretches.select("lang", in_stretch(size).alias("c")).select("lang", "c.*"))
        for longer in range(size + 1, longest):
            held = phrases.where(F.col("size") == longer)
            frames.append(
                held.select("lang", in_phrase(size, longer).alias("phrase"), F.col("f").alias("cover"))
            )
    union = frames[0]
    for frame in frames[1:]:
        union = union.unionByName(frame)
    return union.groupBy("lang", "phrase").agg(F.max("cover").alias("cover"))


def scored(candidates: DataFrame, phrases: DataFrame) -> DataFrame:
    """Candidates with l, r and score of their lowest-scoring cut."""
    words = F.split("phrase", " ", -1)

    def side(cut: Column, left: bool) -> Column:
        part = F.slice(words, 1, cut) if left else F.slice(words, cut + 1, F.col("size") - cut)
        return F.struct(cut.alias("cut"), F.lit(left).alias("left"), F.array_join(part, " ").alias("part"))

    cuts = F.sequence(F.lit(1), F.col("size") - 1)
    sides = F.concat(F.transform(cuts, lambda c: side(c, True)), F.transform(cuts, lambda c: side(c, False)))
    parts = candidates.select("lang", "phrase", "size", "f", F.explode(sides).alias("s")).select(
        "lang", "phrase", "f", "s.*"
    )
    known = phrases.select("lang", F.col("phrase").alias("part"), F.col("f").alias("count"))
    found = (
        parts.join(known, ["lang", "part"])
        .groupBy("lang", "phrase", "f", "cut")
        .agg(
            F.max(F.when(F.col("left"), F.col("count"))).alias("l"),
            F.max(F.when(~F.col("left"), F.col("count"))).alias("r"),
        )
    )
    score = F.expr(
        f"cast(f as {EXACT}) * {SCALE} div (cast(l as {EXACT}) + cast(r as {EXACT}))"
    ).cast("long")
    return (
        found.select("lang", "phrase", "f", F.struct(score.alias("score"), "cut", "l", "r").alias("c"))
        .groupBy("lang", "phrase", "f")
        .agg(F.min("c").alias("c"))
        .select("lang", "phrase", F.col("f").alias("a"), "c.l", "c.r", "c.score")
    )


def collocations(
    docs: DataFrame,
    longest: int = LONGEST,
    least: int = LEAST,
    covered_percent: int = COVERED_PERCENT,
    top: int = TOP,
) -> DataFrame:
    """The `top` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    phrases = frequent(docs, longest, least)
    cover = covers(phrases, longest)
    dropped = F.col("cover").cast(EXACT) * 100 >= F.col("f").cast(EXACT) * covered_percent
    candidates = (
        phrases.where("size >= 2")
        .join(cover, ["lang", "phrase"], "left")
        .where(~F.coalesce(dropped, F.lit(False)))
        .drop("cover")
    )
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    totals = phrases.where("size = 0").select("lang", F.col("f").alias("n"))
    return (
        scored(handover(candidates, "candidates"), phrases)
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= top)
        .join(totals, "lang")
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )
