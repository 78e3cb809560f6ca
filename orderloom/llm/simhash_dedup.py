"""Near duplicates by SimHash: equal blocks find the candidates, distances to pivots filter them.

A fingerprint's coordinates are its Hamming distances to reference fingerprints (pivots). By the
triangle inequality two fingerprints within `MAX_BITS` of each other differ by at most that much
in every coordinate, so pairs with a larger difference are discarded; survivors are verified by
their true distance.

Pairs to compare come from equal blocks, not from the coordinates: 64 bits are cut into blocks, and of `MAX_BITS + 2`
blocks at least two are equal in any pair within `MAX_BITS`. For each choice of two blocks, the
distances to pivots restricted to those blocks are a signature; equal blocks give equal
signatures. Only distinct fingerprints enter, and only fingerprints that share a signature meet.

A signature shared by more than `CROWD` fingerprints would make pairs with the square of its
size. Fingerprints under such a signature take an exact way without pairs: each stands under
itself and under each fingerprint at distance one. Two fingerprints are within two bits exactly
if they share such a place, and all that share one are linked to the least of them.

Defined cases: null text counts as empty; texts without words have fingerprint zero and are linked
like any other; null ids are never the id of a component unless it has no other; repeated rows
are rows of their own; no rows give no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.graph import components
from orderloom.llm.shared import (
    for_python,
    fresh,
    from_python,
    frugal,
    handover,
    keyed,
    mix,
    text_of,
    without,
)

LAST = (1 << 63) - 1

#: Differing bits of a link; the way around crowded signatures is exact for this bound.
MAX_BITS = 2
#: Fingerprints under one signature that are compared pair by pair.
CROWD = 32
PIVOTS = 32
CHUNK = 255 * 256

#: Reference fingerprints: fixed pseudo-random 64-bit numbers.
_pivots = mix(np.arange(1, PIVOTS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Bit b is one if it is set in over half of the shingles' XXH64 values (seed 42)."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate((len(w) + 1 for w in words), initial=-1))
    width = min(shingle, len(words))
    starts = (e + 1 for e in ends)
    hashes = np.fromiter(
        (
            xxhash.xxh64_intdigest(joined[a:b], 42)
            for a, b in zip(starts, ends[width:], strict=False)
        ),
        dtype=np.uint64,
        count=len(words) - width + 1,
    )
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), CHUNK):
        bits = np.unpackbits(
            hashes[i : i + CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
        )
        even = len(bits) // 255 * 255
        # 255 bits add up within a byte.
        groups = bits[:even].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8)
        counts += groups.sum(axis=0, dtype=np.int64) + bits[even:].sum(axis=0, dtype=np.int64)
    majority = (counts * 2 > len(hashes)).astype(np.uint8)
    return int(np.packbits(majority, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, row_key, fingerprint), the fingerprint as a signed 64-bit number."""

    @frugal
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            prints = np.array([fingerprint(t, shingle) for t in batch["text"]], dtype=np.uint64)
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "row_key": batch["row_key"],
                    "fingerprint": prints.view(np.int64),
                }
            )

    texts = keyed(docs).select(
        for_python(F.col("doc_id")), "row_key", F.col("text").cast("binary").alias("text")
    )
    found = texts.mapInPandas(run, "doc_id long, row_key long, fingerprint long")
    return found.withColumn("doc_id", from_python("doc_id"))


def _distances(prints: np.ndarray, mask: int) -> np.ndarray:
    """Hamming distance to each pivot over the bits of the mask."""
    return np.bitwise_count((prints[:, None] ^ _pivots) & np.uint64(mask)).astype(np.uint8)


def _signatures():
    count = MAX_BITS + 2
    edges = [64 * i // count for i in range(count + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    chosen = [a | b for a, b in combinations(masks, 2)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            prints = batch["fingerprint"].to_numpy().view(np.uint64)
            coordinates = _distances(prints, (1 << 64) - 1)
            packed = [row.tobytes() for row in coordinates]
            for number, mask in enumerate(chosen):
                words = _distances(prints, mask).view(np.uint64)
                signature = np.full(len(prints), number, dtype=np.uint64)
                for column in words.T:
                    signature = mix(signature * np.uint64(31) + column)
                yield pd.DataFrame(
                    {
                        "signature": signature.view(np.int64),
                        "fingerprint": batch["fingerprint"],
                        "coordinates": packed,
                    }
                )

    return run


def _links():
    """Pairs within a signature that survive the pivot test and their true distance."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tail = None
        for batch in batches:
            if tail is not None:
                batch = pd.concat([tail, batch], ignore_index=True)
            tail = batch.iloc[-CROWD:]
            signature = batch["signature"].to_numpy()
            prints = batch["fingerprint"].to_numpy().view(np.uint64)
            table = np.frombuffer(b"".join(batch["coordinates"]), dtype=np.uint8)
            table = table.reshape(-1, PIVOTS).astype(np.int8)
            for step in range(1, min(CROWD, len(batch))):
                near = np.flatnonzero(signature[step:] == signature[:-step])
                far = np.abs(table[near + step] - table[near]).max(axis=1, initial=0) > MAX_BITS
                near = near[~far]
                near = near[np.bitwise_count(prints[near] ^ prints[near + step]) <= MAX_BITS]
                if len(near):
                    yield pd.DataFrame(
                        {
                            "a": prints[near].view(np.int64),
                            "b": prints[near + step].view(np.int64),
                        }
                    )

    return run


def near_links(distinct: DataFrame) -> DataFrame:
    """Edges (a, b) that connect whatever distinct fingerprints lie within MAX_BITS."""
    shared = Window.partitionBy("signature")
    signed = (
        distinct.select("fingerprint")
        .mapInPandas(_signatures(), "signature long, fingerprint long, coordinates binary")
        .withColumn("sharing", F.count(F.lit(1)).over(shared))
        .where("sharing > 1")
    )
    signed = handover(signed, "signatures")
    pairs = (
        signed.where(F.col("sharing") <= CROWD)
        .drop("sharing")
        .repartition("signature")
        .sortWithinPartitions("signature", "fingerprint")
        .mapInPandas(_links(), "a long, b long")
    )
    own = F.array(F.col("fingerprint"))
    at_one = F.transform(
        F.sequence(F.lit(0), F.lit(63)),
        lambda bit: F.col("fingerprint").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit)),
    )
    place = Window.partitionBy("place")
    hubs = (
        signed.where(F.col("sharing") > CROWD)
        .select("fingerprint")
        .distinct()
        .select("fingerprint", F.explode(F.concat(own, at_one)).alias("place"))
        .withColumn("hub", F.min("fingerprint").over(place))
        .where("fingerprint <> hub")
        .select(F.col("fingerprint").alias("a"), F.col("hub").alias("b"))
    )
    return pairs.union(hubs)


def near_duplicates(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id, row_key, fingerprint (long), component and component_id for every row of docs.

    component is the least fingerprint that chains of links reach, component_id the smallest
    doc_id of all documents they reach.
    """
    rows = handover(fingerprints(docs, shingle), "fingerprints")
    distinct = rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    grouped = components(near_links(distinct)).withColumnRenamed("node", "fingerprint")
    labelled = distinct.join(grouped, "fingerprint", "left").withColumn(
        "component", F.coalesce("component", "fingerprint")
    )
    named = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    known = labelled.join(named, "component").select("fingerprint", "component", "component_id")
    return rows.join(known, "fingerprint")


def keep_one_each(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """One row of each component, with all columns: that of the smallest doc_id.

    Null ids come last; among rows with the same id the least key stays, and among rows equal in
    id and text any one.
    """
    rows = handover(near_duplicates(docs, shingle).select("row_key", "doc_id", "component"), "rows")
    place = F.struct(F.coalesce("doc_id", F.lit(LAST)), "row_key")
    chosen = rows.groupBy("component").agg(F.min(place)["row_key"].alias("row_key"))
    kept = without(docs, rows.join(chosen, "row_key", "left_anti"))
    several = rows.groupBy("row_key").count().where("count > 1")
    several = handover(several.join(chosen, "row_key", "left_semi").select("row_key"), "repeats")
    if several.isEmpty():
        return kept
    key = fresh(docs, "row_key")
    repeats = kept.withColumn(key, F.xxhash64(kept["doc_id"].cast("long"), text_of(kept))).join(
        several.withColumnRenamed("row_key", key), key, "left_semi"
    )
    return without(kept, several).union(repeats.dropDuplicates([key]).select(*docs.columns))
