"""Toxicity, quality, language and the pipeline, text by text in plain Python."""

import math
import re
import zlib
from bisect import bisect_right
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from orderloom.llm import language_id, line_dedup, quality, simhash_dedup, toxicity
from orderloom.llm.queries import QUERIES, table
from tests.llm.test_against_plain_python import check_places, plain_components, quotes

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    return table(spark, FOLDER, "documents").collect()


def sigmoid(x):
    return 1 / (1 + math.exp(-max(-30, min(30, x))))


def fold(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus


def plain_mix(x):
    top = (1 << 64) - 1
    x ^= x >> 31
    x = x * 0x7FB5D329728EA185 & top
    x ^= x >> 27
    x = x * 0x81DADEF4BC2DD44D & top
    return x ^ (x >> 33)


def plain_toxicity(model, text):
    def letter(b):
        c = chr(b).lower() if b < 0x80 else ""
        return b if b >= 0x80 else ord(c) if c.isalnum() else 0x20

    words = bytes(map(letter, text)).split()
    values = []
    for word in words:
        padded = b" " + word + b" "
        own = []
        for n in (3, 4, 5):
            for i in range(len(padded) - n + 1):
                bucket = plain_mix(int.from_bytes(padded[i : i + n], "big") ^ (n << 56))
                own.append(float(model.value[bucket >> (64 - toxicity.BUCKET_BITS)]))
        values.append(own)
    means = []
    for first in range(0, len(words), 4):
        held = [v for own in values[first : first + 16] for v in own]
        means.append(sum(held) / max(1, len(held)))
    return sigmoid(max(means, default=0.0) + model.bias)


def test_toxicity_text_by_text(spark, rows):
    model = toxicity.fit(*(table(spark, FOLDER, t) for t in ("documents", "labels")))
    found = {r.doc_id: r for r in QUERIES["op1_toxicity"](spark, FOLDER).collect()}
    assert len(found) == len(rows)
    for r in rows:
        score = plain_toxicity(model, (r.text or "").encode())
        assert found[r.doc_id].score == pytest.approx(score, abs=1e-5)
        assert found[r.doc_id].held_out == (fold(r.doc_id, 3) == 1)
        assert found[r.doc_id].predicted == (found[r.doc_id].score >= 0.7)


CLASSES = [
    r"[A-Z]", r"[0-9]", r"[.,;:?'\"()-]", r"!", r"[#$%&*@~^+=_]", r"[|<>/\\{}\[\]]", r"\n", r"[\x80-\xff]",
]


def plain_measures(text):
    size, words = len(text), text.split()
    shown = text.decode("latin-1") + "\n"
    shares = [len(re.findall(c, shown)) / max(1, size) for c in CLASSES]
    several = max(1, len(words))
    phrases = [tuple(words[i : i + 4]) for i in range(len(words) - 3)]

    def repeated(values):
        return 1 - len(set(values)) / max(1, len(values))

    def share(test):
        return sum(map(test, words)) / several

    return [
        *shares,
        math.log1p(len(words)),
        sum(map(len, words)) / several / 10,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / several,
        repeated(words) / math.log(several + 2),
        repeated(phrases),
        share(lambda w: re.match(rb"[A-Z]{2}", w) is not None),
        share(lambda w: w.endswith(b"!")),
        share(lambda w: re.search(rb"[#$%&*@~^+=_]$", w) is not None),
        share(lambda w: re.fullmatch(rb"[|<>/\\{}\[\]]", w) is not None),
        several / (shown.count("\n") + 1),
        share(lambda w: len(w) > 20),
    ]


def plain_quality(model, text):
    measures = np.float32(plain_measures(text))
    total = model.bias
    for column, value in enumerate(measures):
        total += model.weights[column, bisect_right(model.edges[column], value)]
    return sigmoid(total)


def test_measures_of_one_text_do_not_depend_on_others(rows):
    texts = [(r.text or "").encode() for r in rows] + [b"", b"\n", b"A!! B 1 | x#", "É ß".encode()]
    together = quality.measures(texts)
    for text, measured in zip(texts, together, strict=True):
        assert measured == pytest.approx(quality.measures([text])[0])
        assert measured == pytest.approx(plain_measures(text), rel=1e-5, abs=1e-6)


def test_quality_text_by_text(spark, rows):
    model = quality.fit(*(table(spark, FOLDER, t) for t in ("documents", "labels")))
    found = {r.doc_id: r for r in QUERIES["op4_quality"](spark, FOLDER).collect()}
    assert len(found) == len(rows)
    near = 0
    for r in rows:
        score = plain_quality(model, (r.text or "").encode())
        # A measure on the edge of a bin may fall on either side of it.
        near += abs(found[r.doc_id].score - score) > 1e-6
        assert found[r.doc_id].held_out == (fold(r.doc_id, 5) == 0)
        assert found[r.doc_id].predicted == (found[r.doc_id].score >= 0.3)
    assert near <= 2


def plain_grams(text):
    grams = Counter()
    for word in re.findall(r"[^\W\d_]+", text.lower()):
        for n in range(1, language_id.LONGEST + 1):
            grams.update(f" {word} "[i : i + n] for i in range(len(word) + 3 - n))
    grams.pop(" ", None)
    return grams


def test_language_by_plain_profiles(spark, rows):
    counts = {}
    for r in rows:
        if r.lang is not None and fold(r.doc_id, 4) != 2:
            counts.setdefault(r.lang, Counter()).update(plain_grams(r.text or ""))
    profiles = {
        lang: {g: i for i, (g, _) in enumerate(sorted(c.items(), key=lambda x: (-x[1], x[0]))[:300])}
        for lang, c in counts.items()
    }
    known = {g for p in profiles.values() for g in p}
    for r in QUERIES["op7_language_id"](spark, FOLDER).collect():
        text = next(x.text for x in rows if x.doc_id == r.doc_id) or ""
        ranked = sorted((-n, g) for g, n in plain_grams(text).items() if g in known)[:300]
        apart = {
            lang: sum(min(abs(p[g] - i), 300) if g in p else 300 for i, (_, g) in enumerate(ranked))
            for lang, p in profiles.items()
        }
        first, second = sorted(apart.values())[:2]
        if not re.search(r"[^\W\d_]", text):
            assert (r.lang_pred, r.score) == ("und", 0)
        elif first < second:
            assert r.lang_pred == min(apart, key=apart.get)
            assert r.score == pytest.approx(second / (first + second))


def test_pipeline_stage_by_stage(spark, rows):
    model = quality.fit(*(table(spark, FOLDER, t) for t in ("documents", "labels")))
    kept = [(r.doc_id, r.text) for r in rows if model.score([(r.text or "").encode()])[0] >= 0.3]
    assert 0 < len(kept) < len(rows)
    kept = sorted(line_dedup.brute_force(kept).items())
    prints = {i: simhash_dedup.fingerprint((t or "").encode()) for i, t in kept}
    group = plain_components(prints)
    kept = [(i, t) for i, t in kept if group[i] == i]
    items = [(r.item_id, r.text) for r in table(spark, FOLDER, "benchmark").collect()]
    leaks = quotes(kept, items)
    kept = [(i, t) for i, t in kept if not leaks[i]]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {}
    for doc_id, text in kept:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for at in range(0, len(ids), 2048):
            part = np.array(ids[at : at + 2048], dtype="<u4").tobytes()
            want[doc_id, at // 2048] = (at, len(part) // 4, zlib.crc32(part), part)
    found = corpus_pipeline.run(spark, FOLDER).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in found} == want
    check_places([(r.sequence_id, r.offset, r.length) for r in found], 2048)
