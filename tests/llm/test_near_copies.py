"""Near copies of the pipeline against brute force, at the threshold itself."""

from __future__ import annotations

import random
from fractions import Fraction

import corpus_pipeline as pipeline
import numpy as np
import pytest

from tradeloom.llm import near_copies, simhash
from tradeloom.llm.texts import mix

T = Fraction(4, 5)


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def similarity(a, b):
    a, b = shingles(a), shingles(b)
    return Fraction(len(a & b), len(a | b))


def pair(rng, size, shared):
    """Two sets of ``size`` random hashes with ``shared`` in common."""
    values = np.array([rng.getrandbits(64) for _ in range(2 * size - shared)], np.uint64)
    return np.sort(values[:size]), np.sort(values[size - shared :])


@pytest.mark.parametrize("size", [9, 63, 198, 801])
def test_pairs_at_the_threshold_meet(size):
    """Of pairs of similarity 0.8, whatever their size, at least 0.995 share a key."""
    rng, pairs = random.Random(size), 400
    sets = [s for _ in range(pairs) for s in pair(rng, size, size * 8 // 9)]
    keys = near_copies.band_keys(np.concatenate(sets), np.concatenate([[0], np.cumsum([len(s) for s in sets])]))
    met = (keys[::2] == keys[1::2]).any(1)
    assert met.mean() >= 0.995


def test_bits_are_majorities():
    """Each bit of a set's SimHash is the majority of one bit of its remixed hashes, ties being 0."""
    rng = random.Random(3)
    sets = [sorted(rng.getrandbits(64) for _ in range(n)) for n in (1, 2, 3, 4, 254, 255, 256, 700)]
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    bits = near_copies.set_bits(np.array(sum(sets, []), np.uint64), offsets)
    for values, found in zip(sets, bits, strict=True):
        parts = [mix(np.array(values, np.uint64) + np.uint64(part)).tolist() for part in range(14)]
        # Bit ``lane + 8 * byte`` stands at the place ``8 * lane + byte``.
        expected = [2 * sum(h >> (lane + 8 * byte) & 1 for h in part) > len(values) for part in parts for lane in range(8) for byte in range(8)]
        assert found.tolist() == [int(b) for b in expected]


def test_candidates_come_from_fingerprints(spark, monkeypatch):
    """Without the links between fingerprints only sets of one fingerprint are compared."""
    rng = random.Random(4)
    words = [f"w{rng.randrange(10**9)}" for _ in range(200)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:-5] + ["x"] * 5)), (3, " ".join(words).upper())]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = lambda: sorted(r.doc_id for r in pipeline.near_copies(spark, docs, "").collect())
    assert kept() == [1]
    found = simhash.links_within
    monkeypatch.setattr(simhash, "links_within", lambda placed, radius: found(placed, radius).limit(0))
    assert kept() == [1, 2]


@pytest.mark.parametrize("size", [9, 63, 198, 801])
def test_candidates_at_the_threshold(size):
    """Of pairs of similarity 0.8 at least 0.995 share a key and are within the radius."""
    rng, pairs = random.Random(size), 400
    sets = [s for _ in range(pairs) for s in pair(rng, size, size * 8 // 9)]
    keys, compared = near_copies._marked(np.concatenate(sets), np.concatenate([[0], np.cumsum([len(s) for s in sets])]))
    differ = np.unpackbits(compared[::2] ^ compared[1::2], axis=1).sum(1)
    assert ((keys[::2] == keys[1::2]).any(1) & (differ <= near_copies.RADIUS)).mean() >= 0.995


def test_verified_links_are_all_links():
    rng = random.Random(1)
    base = [rng.getrandbits(64) for _ in range(60)]
    sets = []
    for _ in range(150):
        changed = rng.choice([0, 2, 5, 6, 7, 8, 15, 30])
        sets.append(sorted({*rng.sample(base, 60 - changed), *(rng.getrandbits(64) for _ in range(changed // 2))}))
    hashes, offsets = np.array(sum(sets, []), np.uint64), np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    found = near_copies.verified(hashes, offsets, T)

    def parts(pairs):
        label = list(range(len(sets)))
        for a, b in pairs:
            label = [label[a] if x == label[b] else x for x in label]
        return {frozenset(i for i, x in enumerate(label) if x == y) for y in set(label)}

    close = lambda a, b: Fraction(len({*sets[a]} & {*sets[b]}), len({*sets[a]} | {*sets[b]})) >= T
    assert all(close(a, b) for a, b in found.tolist())
    assert parts(found.tolist()) == parts([(a, b) for a in range(len(sets)) for b in range(a) if close(a, b)])


def corpus():
    """Groups of texts with shared passages: pairs at, just below and far below 0.8, and chains of them."""
    rng, texts = random.Random(5), []
    word = lambda: f"w{rng.randrange(10**9)}"
    for size in (13, 67, 202, 805):
        for _ in range(15):
            words = [word() for _ in range(size)]
            total = size - 4
            # The last words replaced: shared / (2 * total - shared) at 0.8, just below, at about 0.72 and 0.6.
            for lost in (total // 9, total // 9 + 1, int(total * 0.16) + 1, total // 4 + 1):
                texts.append(" ".join(words[: size - lost] + [word() for _ in range(lost)]))
            texts.append(" ".join(words))
    # One passage again and again with another end: similar only if repeats are counted.
    passage = [word() for _ in range(12)]
    texts += [" ".join(passage * 20 + [word() for _ in range(30)]) for _ in range(6)]
    return texts


def expected(rows):
    """(doc_id, text) that stay, by brute force."""
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if label[a] != label[b] and similarity(rows[a][1], rows[b][1]) >= T:
                label = [label[a] if x == label[b] else x for x in label]
    return label


@pytest.mark.parametrize("chunk", [1024, 2])
def test_stage_removes_exactly_near_copies(spark, monkeypatch, chunk):
    monkeypatch.setattr(near_copies, "CHUNK", chunk)
    rows = list(enumerate(corpus()))
    label = expected(rows)
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    found = [r.doc_id for r in pipeline.near_copies(spark, docs, "").collect()]
    least = {}
    for (i, _), group in zip(rows, label, strict=True):
        least.setdefault(group, i)
    assert sorted(found) == sorted(least.values())
    assert 100 < len(found) < len(rows)


def test_repeated_ids_lose_no_text(spark):
    """Rows that share an id stay unless they are equal or near copies."""
    first, other, third = (" ".join(f"{c}{i}" for i in range(40)) for c in "abc")
    rows = [(7, first), (7, other), (7, first), (8, third), (9, f"{other} end")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    found = sorted((r.doc_id, r.text) for r in pipeline.near_copies(spark, docs, "").collect())
    assert found == sorted([(7, first), (7, other), (8, third)])


def test_rows_without_an_id_are_compared(spark):
    """A row without an id goes when it is a copy of another row, with an id or without one; null texts stay."""
    first, other, third = (" ".join(f"{c}{i}" for i in range(40)) for c in "abc")
    rows = [(None, first), (7, first), (None, f"{first} end"), (None, other), (None, f"{other} end"), (None, other), (8, third), (None, None), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    found = pipeline.near_copies(spark, docs, "").collect()
    of = lambda word: [(r.doc_id, r.text) for r in found if r.text and r.text.startswith(word)]
    assert of("a0 ") == [(7, first)] and of("c0 ") == [(8, third)]
    assert [i for i, _ in of("b0 ")] == [None]
    assert len(found) == 5 and sum(r.text is None for r in found) == 2
