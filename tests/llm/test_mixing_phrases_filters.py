"""Source mixing, collocations and the filter audit against plain Python, and their edge cases."""

import re
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderloom.llm import collocations, filter_audit, mixing

LONG = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor " * 4000


@pytest.fixture
def sourced(spark, make_docs):
    """Documents from (doc_id, text, source) rows."""

    def make(rows):
        docs = make_docs([(i, t, f"{n}") for n, (i, t, _) in enumerate(rows)], parts=1)
        names = F.array(*(F.lit(s) for *_, s in rows)) if rows else F.array().cast("array<string>")
        return docs.withColumn("source", F.get(names, F.col("lang").cast("int"))).repartition(3)

    return make


# --- mixing -----------------------------------------------------------------------------------


def plain_targets(sizes):
    """{source: size} -> {source: exact target}, by sharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), Fraction(sum(sizes.values()))
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > 3 * sizes[s]}
        if not over:
            return target | {s: weight[s] * level for s in free}
        target |= {s: Fraction(3 * sizes[s]) for s in over}
        free -= over
        left -= sum(target[s] for s in over)
    return target


MIXES = {
    "many": [(i, "w " * (i % 17), f"s{i % 7}") for i in range(120)],
    "hot": [(i, "w " * 9, "hot" if i % 3 else f"s{i}") for i in range(90)],
    "awkward": [
        (None, None, None), (None, "a b", None), (1, "", ""), (1, "x y z", ""), (1, "x y z", ""),
        (2, LONG, "é"), (3, None, "z"), (3, "\u0000 \t\n𝒳", "𝒳"), (4, "one", "ﬁ"), (5, "x" * 300_000, "a"),
    ],
    "no words": [(1, "", "a"), (2, None, None)],
    "one": [(1, "a b c", "a")],
    "none": [],
}


@pytest.mark.parametrize("block_words", [1, 7, 4096])
@pytest.mark.parametrize("name", list(MIXES))
def test_mixture(sourced, name, block_words):
    rows = MIXES[name]
    if name == "awkward" and block_words == 1:
        block_words = 50
    found = mixing.mixture(sourced(rows), block_words=block_words).collect()
    words = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    sizes = defaultdict(int)
    for (*_, source), n in zip(rows, words, strict=True):
        sizes[source] += n
    targets = plain_targets(sizes)
    assert Counter((r.doc_id, r.size, r.source_size) for r in found) == Counter(
        (i, n, sizes[s]) for (i, _, s), n in zip(rows, words, strict=True)
    )
    for source, target in targets.items():
        own = Counter(i for i, _, s in rows if s == source)
        if len({s for i, _, s in rows if i in own}) > 1:
            continue  # ids that several sources share
        mine = [r for r in found if r.doc_id in own]
        assert all(r.target == pytest.approx(float(target)) for r in mine)
        assert sum(r.taken for r in mine) == int(target)
    assert all(0 <= r.taken <= 3 * r.size for r in found)
    assert sum(r.taken for r in found) <= sum(words)


def test_mixes_agree_and_ignore_the_layout(sourced):
    docs = sourced(MIXES["many"])
    one, two = (sorted(mixing.mixture(d).collect()) for d in (docs, docs.repartition(7)))
    assert one == two


def test_every_stretch_of_the_schedule_is_near_the_weights(sourced):
    made = mixing.mix(sourced(MIXES["many"]), block_words=1)
    slots = made.schedule.groupBy("turn", "source_key").agg(F.sum("words").alias("n")).collect()
    shares = {r.source_key: r.share for r in made.sources.collect()}
    total = sum(shares.values())
    turns = max(r.turn for r in slots) + 1
    for upto in (turns // 4, turns // 2, turns):
        held = Counter()
        for r in slots:
            held[r.source_key] += r.n * (r.turn < upto)
        for source, share in shares.items():
            want = share * upto / turns
            assert abs(held[source] - want) <= 2 + 0.02 * total
    # A source's stream is read word by word: no gap, nothing twice.
    reads = defaultdict(list)
    for r in made.schedule.collect():
        reads[r.doc_id].append((r.first_word, r.first_word + r.words))
    taken = {r.doc_id: (r.size, r.taken) for r in mixing.mixture(sourced(MIXES["many"])).collect()}
    for doc_id, spans in reads.items():
        size, n = taken[doc_id]
        times = np.zeros(size + 1, dtype=int)
        for a, b in spans:
            times[a:b] += 1
        assert times[:-1].sum() == n and times[:-1].max() - times[:-1].min() <= 1


# --- collocations -----------------------------------------------------------------------------


def plain_collocations(rows, least, top):
    """(text, lang) rows -> {(lang, rank, phrase, a, l, r, n, score)}."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, 5):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    found = set()
    for lang, f in counts.items():
        candidates = {p: n for p, n in f.items() if len(p) > 1 and n >= least}
        rest = []
        for p, a in candidates.items():
            if any(
                len(q) > len(p) and 100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q)))
                for q, b in candidates.items()
            ):
                continue
            cut = min(
                ((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p))),
            )
            rest.append((-cut[0], -a, " ".join(p).encode(), f[p[: cut[1]]], f[p[cut[1] :]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rest)[:top], 1):
            found.add((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return found


def random_texts(seed, words, rows):
    random = np.random.default_rng(seed)
    vocabulary = [f"w{i}" if i % 3 else f"É{i}" for i in range(words)]
    passage = " ".join(random.choice(vocabulary, 30))
    texts = []
    for i in range(rows):
        own = [str(w) for w in random.choice(vocabulary, int(random.integers(0, 60)))]
        for at in random.integers(0, len(own) + 1, 4):
            own.insert(int(at), str(random.choice([".", ",", "A B\tc", "x x x x x x", "\n", "!?", passage])))
        texts.append((" ".join(own), [None, "en", "de", "en"][i % 4]))
    return texts


@pytest.mark.parametrize(
    ("spread", "list_words", "bucket_bytes"), [(4096, 2_500_000, 8 << 20), (0, 50, 500), (3, 200, 2000)]
)
@pytest.mark.parametrize("words", [6, 40])
def test_collocations(make_docs, monkeypatch, words, spread, list_words, bucket_bytes):
    monkeypatch.setattr(collocations, "STRETCH", 5)
    defaults = (*collocations.frequent.__defaults__[:2], spread, list_words, bucket_bytes)
    monkeypatch.setattr(collocations.frequent, "__defaults__", defaults)
    texts = random_texts(words, words, 60)
    docs = make_docs([(i, t, lang) for i, (t, lang) in enumerate(texts)])
    found = collocations.collocations(docs, least=4, top=50)
    assert {tuple(r) for r in found.collect()} == plain_collocations(texts, 4, 50)


def test_collocations_of_awkward_rows(make_docs):
    rows = [
        (None, None, None), (1, "", "en"), (2, " \t\n", None), (3, LONG, "en"), (3, LONG, "en"),
        (4, "a", "de"), (5, "x" * 300_000, "en"), (6, "\u0000 𝒳. " * 40, ""), (7, "A b " * 40, "de"),
    ]
    found = collocations.collocations(make_docs(rows)).collect()
    assert {tuple(r) for r in found} == plain_collocations([(t, lang) for _, t, lang in rows], 30, 2000)
    assert collocations.collocations(make_docs([])).collect() == []


def test_unary_paths_are_compacted(make_docs):
    """A passage is one path, cut into stretches; a ring stays edges."""
    passage = " ".join(f"p{i}" for i in range(23))
    docs = make_docs([(i, f"{passage}. r s t r s t r s t", "en") for i in range(3)])
    phrases = collocations.frequent(docs, least=3)
    rows = collocations.paths(phrases.where("size = 4")).collect()
    (path,) = [r for r in rows if "p0" in r.words]
    assert " ".join(path.words) == passage and list(path.weights) == [3] * 20
    assert sorted(len(r.weights) for r in rows if "r" in r.words) == [1, 1, 1]


# --- filter audit -----------------------------------------------------------------------------


def plain_audit(rows, labels):
    """(doc_id, text, source) rows, {doc_id: (good, toxic)} -> {(part, order, step): counts}."""
    judged = []
    for doc_id, text, source in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": re.search("[#$%&*|]", text) is not None,
            "E": doc_id is not None
            and any((t or "") == text and i is not None and i < doc_id for i, t, _ in rows),
        }
        judged.append((source or "", {f for f, x in fails.items() if x}, *labels.get(doc_id, (0, 0))))
    found, shapley = {}, Counter()
    for part in {p for p, *_ in judged}:
        own = [j for j in judged if j[0] == part]
        for order in permutations("ABCDE"):
            for step, letter in enumerate(order, 1):
                before = set(order[: step - 1])
                here = [j for j in own if letter in j[1] and not j[1] & before]
                shapley[part, letter] += len(here)
                found[part, "".join(order), step] = (
                    sum(not j[1] & {*before, letter} for j in own),
                    len(here),
                    sum(letter in j[1] and bool(j[1] & before) for j in own),
                    sum(j[1] == {letter} for j in own),
                    sum(j[2] for j in here),
                    sum(j[3] for j in here),
                )
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in found.items()}


FIELDS = "kept removed redundant unique_fails good_lost toxic_lost shapley".split()


def test_filter_audit(sourced, make_labels):
    random = np.random.default_rng(8)
    vocabulary = [*"abcdefgh", "Upper", "CAPS", "#", "$5", "x|y", *(f"w{i}" for i in range(300))]
    rows = [
        (int(i), " ".join(random.choice(vocabulary, int(random.integers(0, 400)))), f"s{i % 3}")
        for i in range(40)
    ]
    rows += [(100 + i, rows[i % 5][1], "s1") for i in range(15)]
    rows += [
        (None, None, None), (None, "", ""), (1, rows[1][1], "s2"), (1, rows[1][1], "s2"), (-3, rows[2][1], "é"),
        (200, LONG, None), (201, LONG, "s0"), (202, "x" * 300_000, "s0"), (203, "\u0000É𝒳 A", "s0"),
    ]
    marks = [(i, i % 2, i % 3 == 0) for i in range(0, 45)] + [(None, 1, 1), (2, 1, None), (200, None, 1)]
    labels = defaultdict(lambda: (0, 0))
    for i, good, toxic in marks:
        if i is not None:
            labels[i] = (max(labels[i][0], int(good == 1)), max(labels[i][1], int(toxic == 1)))
    table = make_labels([(i, g, None if t is None else int(t)) for i, g, t in marks])
    found = filter_audit.audit(sourced(rows), table.withColumn("part", F.lit("x"))).collect()
    got = {(r.part, r.filter_order, r.step): tuple(r[f] for f in FIELDS) for r in found}
    assert len(found) == len(got) and got == plain_audit(rows, labels)


def test_filter_audit_without_rows(sourced, make_labels):
    assert filter_audit.audit(sourced([]), make_labels([])).collect() == []
    found = filter_audit.audit(sourced([(1, "a", "s")]), make_labels([])).collect()
    assert len(found) == 600 and {r.removed for r in found if r.filter_order[r.step - 1] == "A"} == {1}


def test_paths_of_the_lattice():
    lattice = filter_audit.Lattice()
    orders = lattice.orders()
    assert len(lattice.edges) == 80 and len(orders) == 600
    used = Counter((state, letter) for _, _, state, letter in orders)
    assert {(e.state, e.letter): e.paths for e in lattice.edges} == used
