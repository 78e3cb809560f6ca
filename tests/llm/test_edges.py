"""Nulls, empty and very long texts, repeated rows, empty tables and clashing columns."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from orderloom.llm import (
    decontamination,
    exact_dedup,
    language_id,
    line_dedup,
    packing,
    quality,
    secrets,
    simhash_dedup,
    substring_dedup,
    toxicity,
)

LONG = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor " * 4000
ROWS = [
    (None, None),
    (None, ""),
    (None, "a null id"),
    (1, None),
    (2, ""),
    (3, " \n\t\r "),
    (4, "same text here"),
    (4, "same text here"),
    (5, "SAME text here"),
    (6, "one"),
    (6, "another text under the id six"),
    (7, LONG),
    (8, "x" * 300_000),
    (9, "é" * 50 + "\u0000" + "𝒳 " * 30),
    (1 << 60, "a large id"),
]


@pytest.fixture
def benchmark(spark):
    rows = [(1, "five words are in here"), (1, "two"), (None, "a null id"), (2, None), (3, ""), (4, LONG[:400])]
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.fixture
def labels(make_labels):
    return make_labels([(None, 1, 1), (4, 1, 0), (5, 0, 1), (5, 1, 0), (7, 1, 1), (8, 0, 0), (9, None, None)])


def ids(rows):
    return sorted((r.doc_id is not None, r.doc_id or 0) for r in rows)


WANTED = sorted((i is not None, i or 0) for i, _ in ROWS)


def per_row(name, benchmark, labels):
    """The operators that return a row for each row."""
    return {
        "toxicity": lambda d: toxicity.score_toxicity(d, labels),
        "decontamination": lambda d: decontamination.contamination(d, benchmark),
        "quality": lambda d: quality.score_quality(d, labels),
        "simhash": simhash_dedup.near_duplicates,
        "exact": exact_dedup.exact_duplicates,
        "language": language_id.identify,
        "secrets": lambda d: secrets.counted(secrets.find_secrets(d)),
        "lines": line_dedup.drop_repeated_lines,
        "substrings": substring_dedup.remove_repeats,
    }[name]


NAMES = "toxicity decontamination quality simhash exact language secrets lines substrings".split()


@pytest.mark.parametrize("name", NAMES)
def test_a_row_for_every_awkward_row(make_docs, benchmark, labels, name):
    assert ids(per_row(name, benchmark, labels)(make_docs(ROWS)).collect()) == WANTED


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables(make_docs, benchmark, labels, make_labels, spark, name):
    assert per_row(name, benchmark, labels)(make_docs([])).collect() == []
    none = spark.createDataFrame([], benchmark.schema)
    operator = per_row(name, none, make_labels([]))
    assert ids(operator(make_docs(ROWS)).collect()) == WANTED


def test_exact_duplicates(make_docs):
    found = exact_dedup.exact_duplicates(make_docs(ROWS)).collect()
    same = [r for r in found if r.text_sha256 == hashlib.sha256(b"same text here").hexdigest()]
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in same) == [
        (4, 5, 3, False),
        (4, 5, 3, False),
        (5, 5, 3, True),
    ]
    empty = [r for r in found if r.text_sha256 == hashlib.sha256(b"").hexdigest()]
    assert {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in empty} == {
        (None, 2, 4, False),
        (1, 2, 4, False),
        (2, 2, 4, True),
    }


def test_simhash(make_docs):
    found = simhash_dedup.near_duplicates(make_docs(ROWS)).collect()
    assert {r.component_id for r in found if r.fingerprint == 0} == {1}
    assert {r.component_id for r in found if r.doc_id in (4, 5)} == {4}
    only_null = simhash_dedup.near_duplicates(make_docs([(None, "a b c d")])).first()
    assert only_null.component_id is None


def test_one_of_each_group_stays(make_docs):
    docs = make_docs(ROWS)
    kept = simhash_dedup.keep_one_each(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert sorted(r.doc_id for r in rows if r.text and r.text.lower() == "same text here") == [4]
    assert [r.doc_id for r in rows if not (r.text or "").split()] == [1]
    assert simhash_dedup.keep_one_each(make_docs([])).collect() == []


def test_lines(make_docs):
    rows = [(2, "a b\n\nc\na b"), (1, "c\r\nc"), (3, None), (None, "a b"), (4, "a  b ")]
    found = {r.doc_id: r.text for r in line_dedup.drop_repeated_lines(make_docs(rows)).collect()}
    assert found == {1: "c\r", 2: "a b\n", 3: None, None: "", 4: ""}


def test_substrings(make_docs):
    passage = " ".join(f"w{i}" for i in range(25))
    rows = [(2, passage), (1, f"x {passage}"), (None, passage), (3, passage[:20]), (4, None), (2, passage)]
    found = substring_dedup.remove_repeats(make_docs(rows)).collect()
    assert sorted((r.doc_id or 99, r.n_words, r.n_removed) for r in found) == [
        (1, 26, 0),
        (2, 25, 25),
        (2, 25, 25),
        (3, 7, 0),
        (4, 0, 0),
        (99, 25, 25),
    ]


def test_packing(make_docs):
    found = packing.packed(make_docs(ROWS)).collect()
    assert sorted(str(r.doc_id) for r in found if r.piece == 0) == sorted(str(i) for i, _ in ROWS)
    assert {r.length for r in found if r.doc_id in (1, 2, 3)} == {1}
    assert all(len(r.ids) == 4 * r.length for r in found)
    assert packing.packed(make_docs([])).collect() == []


def test_language(make_docs):
    words = {"en": "the cat and the dog went home with her", "de": "der hund und die katze gehen nach hause"}
    rows = [(i, words[lang] + f" {i}", lang) for i in range(60) for lang in words]
    rows += [(200, None, "en"), (201, "123 !?", "en"), (202, "the dog went", None), (None, "der hund", "en")]
    found = {(r.doc_id, r.lang_pred) for r in language_id.identify(make_docs(rows)).collect()}
    assert {(200, "und"), (201, "und"), (202, "en"), (None, "de")} <= found
    scores = language_id.identify(make_docs(rows)).collect()
    assert all(0 <= r.score <= 1 for r in scores)


def test_language_of_a_text_of_many_blocks(monkeypatch):
    profiles = {"a": ["a", "ab", " a"], "b": ["b", "ba", " b"]}
    scorer = language_id.Scorer(profiles)
    text = "ab ab ba ccc " * 500
    whole, lettered = scorer.counts([text])
    monkeypatch.setattr(language_id, "BLOCK_CHARS", 100)
    parts = [scorer.counts([p])[0] for p in language_id._parts(text)]
    assert lettered.all() and (sum(parts) == whole).all()


@pytest.mark.parametrize("gap", ["", "\t", "\u3000", "。", "1", "_"])
def test_language_of_a_long_text_without_blanks(monkeypatch, gap):
    """Words are not cut, whatever stands between them; a text of one word stays one part."""
    monkeypatch.setattr(language_id, "BLOCK_CHARS", 64)
    text = gap.join(["ΑΣ'Α", "中文字", "İab", "ba"] * 60)
    parts = list(language_id._parts(text))
    assert "".join(parts) == text.lower() and (len(parts) > 3 or not gap)
    whole, split = language_id._grams(text), sum((language_id._grams(p) for p in parts), Counter())
    assert whole == split


def test_language_of_many_scripts(make_docs):
    """More than 254 letters and 500 languages; each language has letters of its own."""
    words = {f"l{i:03}": "".join(chr(0x4E00 + 3 * i + k) for k in range(3)) for i in range(620)}
    rows = [(7 * i + k, f"{w} {w[::-1]} {w}", lang) for i, (lang, w) in enumerate(words.items()) for k in range(7)]
    found = language_id.identify(make_docs(rows)).collect()
    learnt = {rows[r.doc_id][2] for r in found if not r.held_out}
    assert len(learnt) > 600
    assert [r for r in found if rows[r.doc_id][2] in learnt and r.lang_pred != rows[r.doc_id][2]] == []
    assert all(r.score > 0.5 for r in found if rows[r.doc_id][2] in learnt)


@pytest.mark.parametrize("block", [1, 1 << 22])
def test_language_scores_by_plain_python(monkeypatch, block):
    monkeypatch.setattr(language_id, "BLOCK_DISTANCES", block)
    random = np.random.default_rng(3)

    def text(low, size):
        letters = [chr(low + int(c)) for c in random.integers(0, 200, size)]
        return "".join(c + " " * (random.random() < 0.4) for c in letters)

    scripts = {"han": 0x4E00, "hangul": 0xAC00, "kana": 0x3041, "latin": 0x100, "rare": 0x20000}
    profiles = {}
    for lang, low in scripts.items():
        grams = sorted(language_id._grams(text(low, 3000)).items(), key=lambda g: (-g[1], g[0]))
        profiles[lang] = [g for g, _ in grams[:300]]
    assert len({c for grams in profiles.values() for g in grams for c in g}) > 500
    texts = [text(low, n) for low in scripts.values() for n in (1, 5, 80, 900)] + ["", "1 2", "ж"]
    texts += [f"{text(0x4E00, 60)} {text(0xAC00, 50)}"]
    scorer = language_id.Scorer(profiles)
    known = {g for grams in profiles.values() for g in grams}
    names, scores = scorer.judge(*scorer.counts(texts))
    for name, score, own in zip(names, scores, texts, strict=True):
        counts = [(-n, g) for g, n in language_id._grams(own).items() if g in known]
        ranks = {g: r for r, (_, g) in enumerate(sorted(counts)[:300])}
        distances = {
            lang: sum(min(abs(p.index(g) - r), 300) if g in p else 300 for g, r in ranks.items())
            for lang, p in profiles.items()
        }
        first, second = sorted(distances.values())[:2]
        if not any(c.isalpha() for c in own):
            assert (name, score) == ("und", 0)
        else:
            assert name == min(distances, key=distances.get)
            assert score == (second / (first + second) if second else 0)


def test_pipeline_stages(make_docs, spark, tmp_path, benchmark, labels):
    for name, frame in (("benchmark", benchmark), ("labels", labels), ("documents", make_docs(ROWS))):
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, docs, str(tmp_path))
        assert left.columns == docs.columns and dict(left.dtypes) == dict(docs.dtypes)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0


def thue_morse(length):
    return [bin(i).count("1") % 2 for i in range(length)]


def test_lines_that_cancel_out_modulo_a_power_of_two(make_docs):
    """Two words in Thue-Morse order, and the same with the words exchanged, are different lines."""
    order = thue_morse(512)
    rows = [(1, " ".join("ab"[b] for b in order)), (2, " ".join("ba"[b] for b in order))]
    rows += [(3, rows[1][1] + " c"), (4, rows[0][1].replace("a", "b", 1))]
    found = {r.doc_id: r.text for r in line_dedup.drop_repeated_lines(make_docs(rows)).collect()}
    assert found == line_dedup.brute_force(rows)
    assert found[2] == rows[1][1] and found[4] == ""


def test_words_that_cancel_out_modulo_a_power_of_two(make_docs):
    order = thue_morse(1024)
    rest = " ".join(f"w{i}" for i in range(19))
    first = ["".join(pair[b] for b in order) for pair in ("ab", "ba")]
    rows = [(i, f"{word} {rest}") for i, word in enumerate([*first, first[0]])]
    found = substring_dedup.remove_repeats(make_docs(rows)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed) for r in found} == {0: (20, 0), 1: (20, 0), 2: (20, 20)}
    rows = [(1, " ".join("ab"[b] for b in order)), (2, " ".join("ba"[b] for b in order))]
    found = substring_dedup.remove_repeats(make_docs(rows)).collect()
    want = substring_dedup.brute_force(rows)
    assert {r.doc_id: (r.n_words, r.n_removed) for r in found} == {i: w[:2] for i, w in want.items()}


def test_items_without_an_id_are_found(make_docs, spark):
    items = spark.createDataFrame([(None, "one two three four five six seven"), (3, "a b c d e f g")], "item_id long, text string")
    items = items.withColumns({"row_key": F.lit("x"), "start": F.lit("x"), "doc_id": F.lit("x")})
    rows = [(1, "zero one two three four five six seven eight"), (2, "a b c d e f g"), (3, "nothing at all")]
    found = {r.doc_id: r for r in decontamination.contamination(make_docs(rows), items).collect()}
    assert {i: (r.contaminated, list(r["items"])) for i, r in found.items()} == {
        1: (True, []), 2: (True, [3]), 3: (False, []),
    }
    assert [r.doc_id for r in decontamination.drop_contaminated(make_docs(rows), items).collect()] == [3]
