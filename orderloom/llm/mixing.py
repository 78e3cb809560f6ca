"""Mixing sources to target weights by a low-discrepancy schedule.

1. Each source has a size, the words of its documents, and a weight. Targets share the sum of all
   sizes by weight; a target stops at `most` times its source's size, and the excess is shared
   again by weight until none is above. Sources in order of limit by weight are capped from the
   front, so one pass of running totals finds the level at which the sharing ends; all of it is
   integer arithmetic.
2. The targets lie one after another on an axis of words, cut into 2**m equal slots. Slot c is the
   point c / 2**m of the cumulative weights, and its turn is c with its m bits reversed: the turns
   0, 1, 2, … visit the slots as the van der Corput sequence visits the unit interval, so each
   stretch of the schedule holds every source close to its weight. The bits are reversed from the
   slots' side, so a source's slots are a range of numbers and no point is searched for. A slot
   on a border between sources is split, so that even the smallest source gets its words.
3. The slots of a source are ranked by turn. Its documents, in the order of a hash, form a stream
   that is repeated as often as needed and cut into blocks of a slot's words. The slot of rank k
   takes the next words of that stream, by a join on source and block.

Ranks, and places in a stream, come from running totals over ranges, so a source with a third of
all words is ranked and joined by many tasks. A block meets at most a handful of slots.

Native: DataFrame functions only.

Defined cases: null text has size 0; null is a source of its own, behind all others; null ids and
repeated ids are rows of their own, rows equal in id, source and size may be exchanged; sources
without words get target 0; no rows give no rows; other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.shared import BROADCAST_ROWS, handover
from orderloom.operators.ranking import running_totals

#: Weights of the sources in code point order, repeating; the limit on repetition.
WEIGHTS = (5, 2, 1)
MOST = 3

#: Words of a block: at most so many, and over half of it.
BLOCK_WORDS = 4096

#: Slots listed by one row at a time.
CHUNK_SLOTS = 1 << 16

WORD = r"[^\x20\x09-\x0D]+"
WIDE = "decimal(19,0)"


def _written(label: str):
    return lambda df: handover(df, label)


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, a source key that sorts null last, and a number for the row; written."""
    source = docs["source"].cast("string")
    size = F.coalesce(F.regexp_count(docs["text"].cast("string"), F.lit(WORD)), F.lit(0))
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("0"), source), F.lit("1")).alias("source_key"),
        size.cast("long").alias("size"),
        F.monotonically_increasing_id().alias("serial"),
    )
    return handover(rows, "measured")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """sizes(source_key, source_size) with weight, target (double), share (whole words of it) and
    base, the words of all earlier sources."""
    unit = math.lcm(*weights)
    listed = F.array(*map(F.lit, weights))
    ranked = running_totals(
        sizes,
        ["source_key"],
        {"rank": F.lit(1).cast("long"), "base": F.col("source_size")},
        _written("ranked-sources"),
    ).withColumn("weight", F.get(listed, (F.col("rank") % len(weights)).cast("int")).cast("long"))
    limit = F.col("source_size") * most
    # A source is capped if limit / weight is below the level that is left for it and all later.
    ranked = ranked.withColumn("level", limit * (F.lit(unit) / F.col("weight")).cast("long"))
    filled = running_totals(
        ranked,
        ["level", "source_key"],
        {"limits": limit, "weights": F.col("weight")},
        _written("filled-sources"),
    )
    whole = filled.agg(F.sum("source_size"), F.sum("weight")).first()
    words, weight = (v or 0 for v in whole)

    def wide(column: Column) -> Column:
        return column.cast(WIDE)

    capped = wide(F.col("level")) * wide(F.lit(weight) - F.col("weights")) <= wide(F.lit(unit)) * wide(
        F.lit(words) - F.col("limits")
    )
    filled = filled.withColumn("capped", capped)
    gone = filled.where("capped").agg(F.sum(limit), F.sum("weight")).first()
    left, parts = words - (gone[0] or 0), max(1, weight - (gone[1] or 0))
    part = wide(F.col("weight")) * wide(F.lit(left))
    shared = part.cast("double") / F.lit(parts).cast("double")
    return filled.select(
        "source_key",
        "source_size",
        "weight",
        "base",
        F.when(F.col("capped"), limit.cast("double")).otherwise(shared).alias("target"),
        F.when(F.col("capped"), limit)
        .otherwise(F.floor(part / F.lit(parts).cast(WIDE)).cast("long"))
        .alias("share"),
    )


@dataclass(frozen=True)
class Mix:
    """documents: measured rows. sources: one row each, with target and share. schedule: one row
    per stretch of a document in a slot (turn, source_key, start, serial, doc_id, first_word,
    words); reading it by turn, source and start gives the mix."""

    documents: DataFrame
    sources: DataFrame
    schedule: DataFrame
    source_rows: int


def _slots(sources: DataFrame, bits: int, block: int) -> DataFrame:
    """(source_key, source_size, low, turn, words): each source's slots or parts of slots."""
    first, last = (F.expr(f"({at}) div {block}") for at in ("low", "low + share - 1"))
    chunks = F.explode(F.sequence(F.expr(f"first div {CHUNK_SLOTS}"), F.expr(f"last div {CHUNK_SLOTS}")))
    cells = F.explode(
        F.sequence(
            F.greatest("first", F.col("chunk") * CHUNK_SLOTS),
            F.least("last", F.col("chunk") * CHUNK_SLOTS + (CHUNK_SLOTS - 1)),
        )
    )
    turn = F.lit(0).cast("long")
    if bits:
        turn = F.conv(F.reverse(F.lpad(F.bin("cell"), bits, "0")), 2, 10).cast("long")
    end = F.least(F.col("low") + F.col("share"), (F.col("cell") + 1) * block)
    return (
        sources.where("share > 0")
        .select("source_key", "source_size", "low", "share", first.alias("first"), last.alias("last"))
        .withColumn("chunk", chunks)
        .repartition("source_key", "chunk")
        .withColumn("cell", cells)
        .select(
            "source_key",
            "source_size",
            "low",
            turn.alias("turn"),
            (end - F.greatest(F.col("low"), F.col("cell") * block)).alias("words"),
        )
    )


def _in_blocks(rows: DataFrame, start: str, end: str, block: int) -> DataFrame:
    """Cut [start, end) at multiples of a block's words; adds block."""
    cut = rows.withColumn(
        "block", F.explode(F.sequence(F.expr(f"{start} div {block}"), F.expr(f"({end} - 1) div {block}")))
    )
    return cut.withColumns(
        {
            start: F.greatest(F.col(start), F.col("block") * block),
            end: F.least(F.col(end), (F.col("block") + 1) * block),
        }
    )


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
    block_words: int = BLOCK_WORDS,
) -> Mix:
    """Targets and schedule of docs(doc_id, source, text)."""
    rows = measured(docs)
    sizes = rows.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    sources = handover(targets(handover(sizes, "sizes"), weights, most), "targets")
    source_rows, words = sources.agg(F.count(F.lit(1)), F.sum("share")).first()
    bits = max(0, math.ceil(math.log2((words or 1) / block_words)))
    block = max(1, -(-(words or 0) // (1 << bits)))
    sources = handover(
        running_totals(sources, ["source_key"], {"low": F.col("share")}, _written("placed-sources")),
        "sources",
    )

    ranked = running_totals(
        _slots(sources, bits, block),
        ["source_key", "turn"],
        {"start": F.col("words")},
        _written("slots"),
    )
    # Earlier sources take just the words before this one's stretch of the axis.
    start, size = F.col("start"), F.col("source_size")
    passes = F.sequence(
        F.expr("start div source_size"), F.expr("(start + words - 1) div source_size")
    )
    taken = (
        ranked.withColumn("start", start - F.col("low"))
        .withColumn("pass", F.explode(passes))
        .select(
            "turn",
            "source_key",
            "start",
            (F.greatest(start, F.col("pass") * size) - F.col("pass") * size).alias("from"),
            (F.least(start + F.col("words"), (F.col("pass") + 1) * size) - F.col("pass") * size).alias("to"),
        )
    )
    taken = _in_blocks(taken, "from", "to", block)

    shuffled = [F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))]
    placed = running_totals(
        rows.where("size > 0"),
        ["source_key", *shuffled, "doc_id", "size", "serial"],
        {"at": F.col("size")},
        _written("stream"),
    )
    bases = _small(sources.select("source_key", "base"), source_rows)
    stream = placed.join(bases, "source_key").select(
        "source_key",
        "serial",
        "doc_id",
        (F.col("at") - F.col("base")).alias("doc_from"),
        (F.col("at") - F.col("base") + F.col("size")).alias("doc_to"),
        (F.col("at") - F.col("base")).alias("doc_start"),
    )
    stream = _in_blocks(stream, "doc_from", "doc_to", block)
    begin, end = F.greatest("from", "doc_from"), F.least("to", "doc_to")
    schedule = (
        taken.join(stream, ["source_key", "block"])
        .where(begin < end)
        .select(
            "turn",
            "source_key",
            "start",
            "serial",
            "doc_id",
            (begin - F.col("doc_start")).alias("first_word"),
            (end - begin).alias("words"),
        )
    )
    return Mix(rows, sources, schedule, source_rows)


def mixture(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """doc_id, size, source_size, target and taken, the words the schedule takes, for every row."""
    made = mix(docs, weights, most, block_words)
    taken = made.schedule.groupBy("serial").agg(F.sum("words").alias("taken"))
    sources = _small(made.sources.select("source_key", "source_size", "target"), made.source_rows)
    return (
        made.documents.join(taken, "serial", "left")
        .join(sources, "source_key")
        .select(
            "doc_id",
            "size",
            "source_size",
            "target",
            F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        )
    )
