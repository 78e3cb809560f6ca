"""Bounded, repeatable samples of labelled documents for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a sample that may exceed its bound by chance.
_SPREAD = 1.1


def sample_ids(rows: DataFrame, group: str, most: int) -> DataFrame:
    """About `most` rows of each group of rows(doc_id, group), chosen by a hash of doc_id.

    The hash threshold comes from the group's size, so no group is sorted or gathered; equal rows
    count once. The groups must be few: one count of each reaches the driver. The result has at
    most 1.1 times the rows asked for, and may be broadcast.
    """
    rows = rows.select("doc_id", group)
    counts = {r[0]: r[1] for r in rows.groupBy(group).count().collect()}
    draw: Column = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 30))
    chosen = F.lit(False)
    for value, count in counts.items():
        share = int((1 << 30) * most / max(count, most))
        chosen = chosen | ((F.col(group) == F.lit(value)) & (draw < share))
    total = int(most * max(1, len(counts)) * _SPREAD) + 1
    return rows.where(chosen).distinct().limit(total)


def sample_texts(texts: DataFrame, chosen: DataFrame) -> DataFrame:
    """The chosen rows with their text: of several texts under one id the least, so that repeated
    ids cannot swell a sample."""
    keys = chosen.columns
    shared = [c for c in keys if c in texts.columns]
    return texts.join(F.broadcast(chosen), shared).groupBy(*keys).agg(F.min("text").alias("text"))
