"""Exact duplicates by a tree merge of sorted digest runs.

Documents are dealt onto runs by a hash of their id. A run holds one entry per distinct text in
it: digest, the check that verifies it, the identifier that stays and the number of rows. Runs
are then merged `fan_in` at a time (that is, log2(fan_in) binomial rounds in one multiway merge)
until one run is left, which is spread over all tasks by digest. Decisions travel down the same
tree: every entry learns its parent's decision, every document its entry's. So a text that a
third of all rows share meets as one entry per run, never as its rows, and a row is joined only
within its run.

Native: DataFrame functions only.

Defined cases: null text counts as empty; among equal texts null ids are smaller than any id,
and where all are null the id that stays is null; rows equal in id and text are one document and
share its decision, but count as rows in group_size; no rows give no rows; other columns are
not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.shared import handover, text_of

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def fold_ascii(text: Column) -> Column:
    """Lower-case A-Z only; pure ASCII takes the cheaper function with the same result."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def _merged(entries: DataFrame, keep: str) -> DataFrame:
    """One entry for each text of a run; equal digests with unequal checks stay apart."""
    choose = {"largest": F.max, "smallest": F.min}[keep]
    return (
        entries.groupBy("run", "digest", "verified")
        .agg(choose("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
        .sortWithinPartitions("run", "digest")
    )


def exact_duplicates(
    docs: DataFrame, keep: str = "largest", rounds: int = 2, fan_in: int = 8
) -> DataFrame:
    """doc_id, text_sha256, keep_id, group_size, kept for every row of docs(doc_id, text).

    fan_in ** rounds runs; more of them split a hot text further.
    """
    doc_id = docs["doc_id"].cast("long")
    rows = docs.select(
        doc_id.alias("doc_id"),
        F.pmod(F.xxhash64(doc_id), F.lit(fan_in**rounds)).alias("run"),
        fold_ascii(text_of(docs)).alias("folded"),
    ).select(
        "doc_id",
        "run",
        F.xxhash64("folded").alias("digest"),
        F.unhex(F.sha2("folded", 256)).alias("verified"),
    )
    rows = handover(rows, "digests")
    start = rows.select(
        "run",
        "digest",
        "verified",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
    )
    levels = [handover(_merged(start, keep), "run-0")]
    for number in range(1, rounds + 1):
        parents = levels[-1].withColumn("run", F.expr(f"run div {fan_in}"))
        levels.append(handover(_merged(parents, keep), f"run-{number}"))

    decided = levels.pop()
    while levels:
        entries = levels.pop().select("run", "digest", "verified")
        decided = (
            entries.withColumn("parent", F.expr(f"run div {fan_in}"))
            .join(decided.withColumnRenamed("run", "parent"), ["parent", "digest", "verified"])
            .drop("parent")
        )
    return rows.join(decided, ["run", "digest", "verified"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("verified")).alias("text_sha256"),
    )
