"""How filters interact: every order of them, counted over the lattice of their subsets.

Documents are reduced to their part, the set of filters they fail and their labels, so what is
counted is at most 2**n sets for each part. A state of the lattice is the set of filters applied
so far; an edge applies one more. An edge removes the documents that fail its filter and none of
its state. Counting the ways into each state from the start (forward) and out of it to the end
(backward) tells on how many orders an edge lies: the removals of a filter summed over all orders
are its edges' removals weighted by those counts, its Shapley value times n!. The steps of a single
order are read off the same edges.

What reaches the driver is the lattice itself, which depends on the number of filters only.

Defined cases: null text counts as empty, null part as the empty string; a document without labels,
or with null ones, is neither good nor toxic, one with several is what any of them says; null ids
fail no comparison of ids; rows equal in id and text do not repeat each other; an empty table has no
parts and gives no rows; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.shared import text_of

#: The filters, in the order of their letters.
FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITAL_PERCENT = 2
MARKS = r"[#$%&*|]"

WORD = r"[^\x20\x09-\x0D]+"
REPEATED = "E"


@dataclass(frozen=True)
class Edge:
    """Applying `letter` when the filters in `state` have been applied; `paths` orders do so."""

    state: int
    letter: str
    paths: int


class Lattice:
    """The subsets of some filters, the ways into and out of each, and the edges between them."""

    def __init__(self, letters: str = FILTERS):
        self.letters = letters
        self.bit = {letter: 1 << i for i, letter in enumerate(letters)}
        full = (1 << len(letters)) - 1
        into = [0] * (full + 1)
        out = [0] * (full + 1)
        into[0] = out[full] = 1
        steps = [(s, f) for s in range(full + 1) for f in letters if not s & self.bit[f]]
        for state, letter in steps:
            into[state | self.bit[letter]] += into[state]
        for state, letter in reversed(steps):
            out[state] += out[state | self.bit[letter]]
        self.edges = [Edge(s, f, into[s] * out[s | self.bit[f]]) for s, f in steps]

    def orders(self) -> list[tuple[str, int, int, str]]:
        """(order, step, state before it, letter) for all steps of all orders."""
        found = []
        for order in permutations(self.letters):
            state = 0
            for number, letter in enumerate(order, 1):
                found.append(("".join(order), number, state, letter))
                state |= self.bit[letter]
        return found


def text_failures(text: Column) -> dict[str, Column]:
    """The filters that one text decides."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    capitals = F.char_length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": F.size(words) < MIN_WORDS,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * MIN_DISTINCT_PERCENT,
        "C": capitals.cast("long") * 100 > F.char_length(text).cast("long") * MAX_CAPITAL_PERCENT,
        "D": text.rlike(MARKS),
    }


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, failed, good, toxic, documents): documents by the set of filters they fail, a bit each.

    A text that a third of all rows share meets as one row for each task, part and label: the
    smallest id and how many rows have it. All rows but those are repeats.
    """
    bit = Lattice().bit
    text = text_of(docs)
    own = sum(
        (F.when(test, bit[letter]).otherwise(0) for letter, test in text_failures(text).items()),
        F.lit(0),
    )
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(docs["source"].cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        own.alias("own"),
    )
    known = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
    )
    marks = [F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")]
    rows = rows.join(known, "doc_id", "left").select("doc_id", "part", "digest", "own", *marks)
    keys = ["digest", "part", "own", "good", "toxic"]
    # Rows of one id and text do not repeat each other, so they are counted before the least is taken.
    held = (
        rows.groupBy(*keys, "doc_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(*keys)
        .agg(
            F.sum("n").alias("n"),
            F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("unnumbered"),
            F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("least"),
        )
    )
    firsts = held.groupBy("digest").agg(F.min("least.doc_id").alias("first"))
    held = held.join(firsts, "digest").select(
        "part",
        "own",
        "good",
        "toxic",
        "n",
        (
            F.col("unnumbered")
            + F.when(F.col("least.doc_id") == F.col("first"), F.col("least.n")).otherwise(0)
        ).alias("kept"),
    )
    split = F.explode(
        F.array(
            F.struct(F.col("own").alias("failed"), F.col("kept").alias("documents")),
            F.struct(
                F.col("own").bitwiseOR(F.lit(bit[REPEATED])).alias("failed"),
                (F.col("n") - F.col("kept")).alias("documents"),
            ),
        )
    )
    return (
        held.select("part", "good", "toxic", split.alias("s"))
        .groupBy("part", "s.failed", "good", "toxic")
        .agg(F.coalesce(F.sum("s.documents"), F.lit(0)).cast("long").alias("documents"))
    )


def edge_counts(failed: DataFrame, lattice: Lattice) -> DataFrame:
    """One row for each part and edge, with its counts and the number of orders that use it."""
    spark = failed.sparkSession
    outcomes = []
    for edge in lattice.edges:
        bit = lattice.bit[edge.letter]
        for mask in range(1 << len(lattice.letters)):
            outcomes.append(
                (
                    mask,
                    edge.state,
                    edge.letter,
                    edge.paths,
                    int(not mask & (edge.state | bit)),
                    int(bool(mask & bit) and not mask & edge.state),
                    int(bool(mask & bit) and bool(mask & edge.state)),
                    int(mask == bit),
                )
            )
    names = ["kept", "removed", "redundant", "unique_fails"]
    table = spark.createDataFrame(
        outcomes,
        "failed int, state int, letter string, paths long, " + ", ".join(f"{n} int" for n in names),
    )
    joined = failed.join(F.broadcast(table), "failed")
    n = F.col("documents")
    return joined.groupBy("part", "state", "letter", "paths").agg(
        *(F.sum(n * F.col(c)).alias(c) for c in names),
        F.sum(n * F.col("removed") * F.col("good")).alias("good_lost"),
        F.sum(n * F.col("removed") * F.col("toxic")).alias("toxic_lost"),
    )


def complete(failed: DataFrame, lattice: Lattice) -> DataFrame:
    """Every part with every set of failures, so that no edge is missing; zeros where none."""
    sets = F.explode(F.sequence(F.lit(0), F.lit((1 << len(lattice.letters)) - 1))).alias("failed")
    zeros = failed.select("part").distinct().select(
        "part",
        sets,
        F.lit(0).alias("good"),
        F.lit(0).alias("toxic"),
        F.lit(0).cast("long").alias("documents"),
    )
    return failed.unionByName(zeros)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, filter order and step."""
    lattice = Lattice()
    edges = edge_counts(complete(failures(docs, labels), lattice), lattice)
    shapley = edges.groupBy("part", "letter").agg(
        F.sum(F.col("removed") * F.col("paths")).alias("shapley")
    )
    steps = docs.sparkSession.createDataFrame(
        lattice.orders(), "filter_order string, step int, state int, letter string"
    )
    counts = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return (
        edges.join(shapley, ["part", "letter"])
        .join(F.broadcast(steps), ["state", "letter"])
        .select("part", "filter_order", "step", *(F.col(c).cast("long").alias(c) for c in counts))
    )
