"""Token counts, pieces, quality rules and licences against the libraries and row-by-row versions."""

from __future__ import annotations

import random
import re
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from compare import SMALL as FOLDER
from tokenizers import Tokenizer

from tradeloom.llm import boosted_trees, license_scan, quality_rules, sentence_pieces, token_counts
from tradeloom.llm.queries import queries

WORDS = re.compile("[^\x20\x09-\x0D]+").findall
BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def given():
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall())


@pytest.fixture
def soup():
    """White space and marks in every order."""
    random.seed(5)
    parts = [" ", "  ", "\n", "\t", " ", " ", "\x1c", "\x85", "a", "B", "é", "9", "²", "'s", "'", "!", "▁", "<s>", "<|endoftext|>", "\r\n", "东"]
    return [(i, "".join(random.choices(parts, k=random.randint(1, 12)))) for i in range(400)]


def test_token_counts(llm, odd, texts, soup):
    library = Tokenizer.from_file(BPE)
    rows = texts + soup
    found = token_counts.count_tokens(odd(rows), BPE)
    assert found.columns[-2:] == ["n_bytes", "n_tokens"] and "kept" in found.columns
    expected = Counter((i, t, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    assert Counter((r.doc_id, r.text, r.n_bytes, r.n_tokens) for r in found.collect()) == expected
    assert token_counts.count_tokens(odd([]), BPE).collect() == []


def test_small_caches_do_not_change_counts(llm, odd, soup, monkeypatch):
    monkeypatch.setattr(token_counts, "FREQUENT", 3)
    monkeypatch.setattr(token_counts, "CACHED", 4)
    library = Tokenizer.from_file(BPE)
    found = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(odd(soup), BPE).collect()}
    assert found == {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in soup}


def test_pieces(llm, odd, texts, soup):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = texts + soup
    encoded = sentence_pieces.encode(odd(rows), PIECES)
    both = sentence_pieces.encode_and_decode(odd(rows), PIECES)
    expected = Counter((i, t, tuple(library.encode(t or ""))) for i, t in rows)
    assert Counter((r.doc_id, r.text, tuple(r.ids)) for r in encoded.collect()) == expected
    found = sentence_pieces.decode(encoded, PIECES).collect()
    assert all(r.decoded == (library.decode(list(r.ids)) if r.ids else "") for r in found)
    assert Counter((r.doc_id, r.text, tuple(r.ids), r.decoded) for r in both.collect()) == Counter((r.doc_id, r.text, tuple(r.ids), r.decoded) for r in found)
    assert sentence_pieces.encode_and_decode(odd([]), PIECES).collect() == []


def counted(text):
    text = text or ""
    words = WORDS(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORDS(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = {k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in (i, i + 1, i + 2)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside)


def test_quality_counts(llm, odd, texts):
    rows = texts + [(20, "a b\n\na b\n a b\nx|y #1\n"), (21, "\n\nq q q q"), (22, "z\nz"), (23, "z\n")] + list(given().items())
    none = llm.createDataFrame([], "doc_id long, quality int")
    found = quality_rules.judge(odd(rows), none)
    expected = Counter((i, t, *counted(t)) for i, t in rows)
    assert Counter((r.doc_id, r.text, *(r[c] for c in quality_rules.COUNTS)) for r in found.collect()) == expected
    for r in found.collect():
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        # Without labels the trees reject nothing.
        assert r.base_failed == failed and r.kept == (not failed)
    assert quality_rules.judge(odd([]), none).collect() == []


def test_quality_on_held_out_labels(llm):
    folder = FOLDER.replace("0.001", "0.01")
    found = {r.doc_id: r.kept for r in queries()["op8_quality_rules"](llm, folder).collect() if not r.base_failed}
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{folder}/labels.parquet'").fetchall())
    good = [kept for i, kept in found.items() if labels.get(i) == 1]
    bad = [kept for i, kept in found.items() if labels.get(i) == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.1


def test_trees_are_monotonic():
    random = np.random.default_rng(3)
    values = random.normal(size=(2000, 3))
    labels = (values[:, 0] - values[:, 1] + random.normal(size=2000) > 0).astype(float)
    forest = boosted_trees.train(values, labels, np.array([0, -1, 1]))
    line = np.linspace(-4, 4, 60)
    for _ in range(30):
        base = np.tile(random.normal(size=3), (60, 1))
        base[:, 1] = line
        assert (np.diff(forest.margins(base)) <= 1e-12).all()
        base[:, 1], base[:, 2] = 0, line
        assert (np.diff(forest.margins(base)) >= -1e-12).all()
    assert ((forest.margins(values) > 0) == labels).mean() > 0.7
    only = boosted_trees.train(values, np.ones(2000), np.zeros(3))
    assert len(only.leaf) == 0 and (only.probabilities(values) > 0.99).all()


def test_licences(llm, odd, texts):
    words_of = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+").findall
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    rows = texts + [(30, "cc cc by by all rights reserved all rights\nreserved"), (31, "GENERAL public-license É"), (32, "by cc"), (1033, "Released under the MIT License"), (34, "reserved rights all")]
    rows += list(given().items())
    found = license_scan.scan(odd(rows))
    for r in found.collect():
        words = words_of((r.text or "").translate(lower))
        places = [(i, label) for phrase, label in license_scan.BASE.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
        assert (r.n_words, r.n_base) == (len(words), len(places))
        assert (r.first_word, r.last_word) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert r.base_labels == ",".join(sorted({label for _, label in places}))
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) or not places
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)
    assert {r.doc_id: r.labels for r in found.where("doc_id = 1033").collect()} == {1033: "mit"}
    assert license_scan.scan(odd([])).collect() == []
