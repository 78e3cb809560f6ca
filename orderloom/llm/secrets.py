"""Secrets in texts, found through a trigram inverted index.

Each rule's regular expression yields a Boolean trigram query: every literal stretch that a match
must contain becomes a clause, each spelling of it an alternative, each trigram of a spelling a
term. The index holds postings (trigram, document) for the trigrams that some rule asks for.
Intersecting them gives each rule's candidates, and only those are matched against its expression.
A rule without mandatory trigrams is matched against every text.

Native: DataFrame functions only; the expressions are analysed once on the driver.

Defined cases: null text counts as empty and has no spans; matching is over whole texts however
long; rows equal in id and text each get the same result; no rows give no rows; other columns
are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.shared import handover, keyed

#: Candidate lists up to this many rows are broadcast (about 30 bytes each); longer ones are
#: joined by shuffle.
BROADCAST_ROWS = 500_000

SPAN = "struct<start:int,rank:int,end:int,kind:string>"

#: Spellings of a literal stretch that are told apart before a clause is closed.
MAX_SPELLINGS = 64


@dataclass(frozen=True)
class Rule:
    """A match counts if the given group has at least min_length characters."""

    kind: str
    pattern: str
    group: int = 0
    min_length: int = 0


#: The rules, in the order in which kinds are listed. A run of hex digits, or of
#: capitals and digits after AKIA, is maximal, so its least length may stand in the pattern.
RULES = (
    Rule(
        "assign",
        r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        group=2,
        min_length=12,
    ),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)


def _stretches(pattern: str) -> list[set[str]]:
    """Sets of literals, one of each of which every match contains, in lower case.

    Anything but literals, small sets, alternations, groups and optional parts ends a stretch.
    """
    done: list[set[str]] = []

    def literals(parsed) -> set[str] | None:
        """All strings the expression can match, or None if there are too many."""
        found = {""}
        for op, value in parsed:
            part = spelled(str(op), value)
            if part is None or len(found) * len(part) > MAX_SPELLINGS:
                return None
            found = {a + b for a, b in product(found, part)}
        return found

    def spelled(op: str, value) -> set[str] | None:
        if op == "LITERAL":
            return {chr(value).lower()}
        if op == "IN" and all(str(o) == "LITERAL" for o, _ in value):
            return {chr(v).lower() for _, v in value}
        if op == "SUBPATTERN":
            return literals(value[-1])
        if op == "BRANCH":
            parts = [literals(branch) for branch in value[1]]
            return None if None in parts else set().union(*parts)
        if op == "MAX_REPEAT" and value[1] == 1:
            inner = literals(value[2])
            return inner if inner is None or value[0] else inner | {""}
        return None

    current = {""}
    for op, value in re._parser.parse(pattern):
        part = spelled(str(op), value)
        if part is not None and len(current) * len(part) <= MAX_SPELLINGS:
            current = {a + b for a, b in product(current, part)}
        else:
            done.append(current)
            current = part if part is not None else {""}
    return [*done, current]


def trigram_query(pattern: str) -> list[list[frozenset[str]]]:
    """Clauses that all must hold; a clause holds if all trigrams of one alternative occur.

    An empty list: the expression has no mandatory trigrams.
    """
    clauses = []
    for spellings in _stretches(pattern):
        terms = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in spellings}
        if all(terms):
            least = [t for t in terms if not any(o < t for o in terms)]
            clauses.append(sorted(least, key=sorted))
    return clauses


def postings(texts: DataFrame, trigrams: list[str]) -> DataFrame:
    """(trigram, row_key) for each of the trigrams that a text contains in either case."""
    folded = texts.select("row_key", F.lower("text").alias("folded"))
    held = F.array_compact(
        F.array(*(F.when(F.col("folded").contains(t), F.lit(t)) for t in trigrams))
    )
    return folded.select(F.explode(held).alias("trigram"), "row_key").distinct()


def candidates(index: DataFrame, queries: dict[str, list[list[frozenset[str]]]]) -> DataFrame:
    """(row_key, kinds): the rules whose whole query a text satisfies."""
    terms = [
        (kind, clause, alternative, trigram, len(trigrams), len(clauses))
        for kind, clauses in queries.items()
        for clause, alternatives in enumerate(clauses)
        for alternative, trigrams in enumerate(alternatives)
        for trigram in sorted(trigrams)
    ]
    asked = index.sparkSession.createDataFrame(
        terms, "kind string, clause int, alternative int, trigram string, terms int, clauses int"
    )
    return (
        index.join(F.broadcast(asked), "trigram")
        .groupBy("row_key", "kind", "clause", "alternative", "terms", "clauses")
        .agg(F.count(F.lit(1)).alias("met"))
        .where("met = terms")
        .groupBy("row_key", "kind", "clauses")
        .agg(F.count_distinct("clause").alias("met"))
        .where("met = clauses")
        .groupBy("row_key")
        .agg(F.collect_set("kind").alias("kinds"))
    )


def spans_of(text: Column, rule: Rule, rank: int) -> Column:
    """All spans of a rule, leftmost first and not overlapping, as (start, rank, end, kind).

    Starts come from the lengths of the matches and of what lies between them, in code points.
    """
    pattern = F.lit(rule.pattern)
    between = F.split(text, rule.pattern, -1)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    value = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    sizes = F.transform(
        F.arrays_zip(between.alias("gap"), whole.alias("whole"), value.alias("value")),
        lambda m: F.struct(
            F.char_length(m["gap"]).alias("gap"),
            F.char_length(m["whole"]).alias("size"),
            F.char_length(m["value"]).alias("value"),
        ),
    )

    def step(state: Column, m: Column) -> Column:
        start = state["at"] + m["gap"]
        end = start + F.coalesce(m["size"], F.lit(0))
        found = F.struct(
            start.alias("start"),
            F.lit(rank).alias("rank"),
            end.alias("end"),
            F.lit(rule.kind).alias("kind"),
        )
        good = m["value"] >= rule.min_length
        return F.struct(
            end.alias("at"),
            F.when(good, F.concat(state["spans"], F.array(found)))
            .otherwise(state["spans"])
            .cast(f"array<{SPAN}>")
            .alias("spans"),
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("spans"))
    return F.aggregate(sizes, start, step, lambda state: state["spans"])


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id and found, the sorted array of (start, rank, end, kind), for every row of docs."""
    texts = keyed(docs)
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern))}
    trigrams = sorted({t for q in queries.values() for c in q for a in c for t in a})
    if trigrams:
        index = handover(postings(texts, trigrams), "postings")
        listed = handover(candidates(index, queries), "candidates")
        if listed.count() <= BROADCAST_ROWS:
            listed = F.broadcast(listed)
        texts = texts.join(listed, "row_key", "left")
    else:
        texts = texts.withColumn("kinds", F.lit(None).cast("array<string>"))

    def parts() -> Iterator[Column]:
        for rank, rule in enumerate(rules):
            spans = spans_of(F.col("text"), rule, rank)
            if rule.kind in queries:
                spans = F.when(F.array_contains("kinds", rule.kind), spans)
                spans = F.coalesce(spans, F.array().cast(f"array<{SPAN}>"))
            yield spans

    return texts.select("doc_id", F.array_sort(F.concat(*parts())).alias("found"))


def counted(found: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, n_<kind> per rule, all spans as text, and its SHA-256."""

    def written(span: Column) -> Column:
        ends = (span[c].cast("string") for c in ("start", "end"))
        return F.concat_ws(":", span["kind"], *ends)

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda span: span["kind"] == kind)).cast("long")

    spans = F.array_join(F.transform("found", written), ",")
    counts = [count(r.kind).alias(f"n_{r.kind}") for r in rules]
    return found.select("doc_id", *counts, spans.alias("spans")).withColumn(
        "base_sha256", F.sha2("spans", 256)
    )
