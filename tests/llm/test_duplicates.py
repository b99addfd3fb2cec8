"""Word windows, byte strings, fingerprints and benchmark items against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from compare import SMALL as FOLDER

from tradeloom.llm import decontamination, simhash, suffix_dedup, word_windows
from tradeloom.llm.components import components
from tradeloom.llm.suffix_arrays import common_prefixes, suffix_array

WORDS = re.compile("[^\x20\x09-\x0D]+").findall


def given():
    return duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall()


@pytest.mark.parametrize("period", word_windows.COVERS)
def test_difference_covers(period):
    cover = word_windows.COVERS[period]
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


@pytest.mark.parametrize("window", [1, 3, 10, 35])
def test_word_windows(llm, odd, texts, window):
    rows = texts + (given() if window == 35 else [])
    count = Counter(tuple(w[i : i + window]) for _, t in rows for w in [WORDS(t or "")] for i in range(len(w) - window + 1))
    expected = Counter()
    for i, text in rows:
        words = WORDS(text or "")
        gone = {k for s in range(len(words) - window + 1) if count[tuple(words[s : s + window])] > 1 for k in range(s, s + window)}
        expected[i, len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)] += 1
    found = word_windows.remove_repeats(odd(rows), window)
    assert found.columns == ["doc_id", "n_words", "n_removed", "kept"]
    assert Counter(map(tuple, found.collect())) == expected


def test_word_windows_keep_white_space(llm, odd):
    rows = [(1, " a  b\nc d\t"), (2, "x c d\ny"), (3, None), (4, "c d"), (5, "plain  text\n")]
    found = word_windows.remove_repeats(odd(rows), 2, spaces=True)
    assert {r.doc_id: r.kept for r in found.collect()} == {1: " a  b\n", 2: "x y", 3: "", 4: "", 5: "plain  text\n"}
    assert "labels" in found.columns and word_windows.remove_repeats(odd([]), 2).collect() == []


def test_suffix_arrays():
    random_ = np.random.default_rng(1)
    for n in (1, 2, 50, 700):
        for letters in (1, 2, 4):
            data = random_.integers(97, 97 + letters, n).astype(np.uint8)
            text = bytes(data)
            order, known = suffix_array(data, 100)
            assert [text[i : i + 100] for i in order] == sorted(text[i : i + 100] for i in range(n))
            shared = common_prefixes(data, order, known, 100)
            for k in range(1, n):
                a, b = text[order[k - 1] :][:100], text[order[k] :][:100]
                same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
                assert shared[k] == same >= known[k]
            enough = common_prefixes(data, order, known, 100, 60)
            assert ((enough >= 60) == (shared >= 60)).all()


def removed_bytes(rows, length):
    """Row equal in full count as one; order by id, a null id first. Ids with two texts are left to the caller."""
    seen, result = set(), {}
    for i, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, int)
        for s in range(len(data) - length + 1):
            if data[s : s + length] in seen:
                gone[s] += 1
                gone[s + length] -= 1
            else:
                seen.add(data[s : s + length])
        gone = np.cumsum(gone[:-1]) > 0
        spans = int((gone & ~np.append(False, gone[:-1])).sum())
        result[i, text] = (len(data), int(gone.sum()), spans, bytes(b for b, g in zip(data, gone) if not g))
    return result


@pytest.mark.parametrize(("length", "gram", "stretches"), [(100, 32, 4096), (100, 32, 2), (12, 5, 2), (9, 8, 1)])
def test_suffix_dedup(llm, odd, texts, monkeypatch, length, gram, stretches):
    monkeypatch.setattr(suffix_dedup, "STRETCHES", stretches)
    one_each = [r for r in texts if r[0] not in (None, 6) or r[1] == "no id here"] + [(6, texts[7][1])] * 2
    rows = one_each + given() if length == 100 else [r for r in one_each if len(r[1] or "") < 2000] + given()[:12]
    shifted = [(i if k < len(one_each) else i + 1000, t) for k, (i, t) in enumerate(rows)]
    expected = removed_bytes(shifted, length)
    found = suffix_dedup.remove_repeats(odd(shifted), length, gram)
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found.collect()) == Counter((i, *expected[i, t]) for i, t in shifted)
    assert suffix_dedup.remove_repeats(odd([]), length, gram).collect() == []


def fingerprint(text, size=3):
    words = WORDS((text or "").translate({c: c + 32 for c in range(65, 91)}))
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(values, radius):
    label = list(range(len(values)))

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for a in range(len(values)):
        for b in range(a):
            if (values[a] ^ values[b]).bit_count() <= radius:
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return [root(k) for k in range(len(values))]


@pytest.mark.parametrize("chunk", [1024, 3])
def test_simhash(llm, odd, texts, monkeypatch, chunk):
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    rows = [r for r in texts if len(r[1] or "") < 5000] + given()[:120]
    rows = [(None if i is None else i if k < 16 else i + 1000, t) for k, (i, t) in enumerate(rows)]
    values = [fingerprint(t) for _, t in rows]
    roots = linked(values, 3)
    least = {}
    for (i, _), r in zip(rows, roots):
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    found = simhash.near_duplicates(odd(rows))
    expected = Counter((i, f"{v:016x}", least[r]) for (i, _), v, r in zip(rows, values, roots))
    assert Counter((r.doc_id, bytes(r.fingerprint).hex(), r.component_id) for r in found.collect()) == expected
    assert simhash.near_duplicates(odd([])).collect() == []


@pytest.mark.parametrize(("bits", "radius"), [(64, 3), (64, 9), (256, 45)])
def test_bit_sliced_comparison(bits, radius):
    random_ = np.random.default_rng(bits + radius)
    near = random_.integers(0, 2, (4, bits))
    rows = np.concatenate([near[random_.integers(0, 4, 150)] ^ (random_.random((150, bits)) < radius / bits / 1.5), random_.integers(0, 2, (60, bits))]).astype(np.uint8)
    rows = rows[random_.permutation(210)]
    ends = np.repeat([130, 131, 210], [130, 1, 79])
    found = simhash.compare(rows, ends, radius)
    numbers = [int("".join(map(str, r)), 2) for r in rows.tolist()]
    expected = linked(numbers[:130], radius) + [130] + [131 + k for k in linked(numbers[131:], radius)]
    assert found.tolist() == expected


def test_components(llm):
    random.seed(2)
    pairs = [(random.randrange(400), random.randrange(400)) for _ in range(230)] + [(500 + i, 501 + i) for i in range(60)] + [(7, 7)]
    found = {r.node: r.component for r in components(llm.createDataFrame(pairs, "a long, b long")).collect()}
    label = {n: n for p in pairs for n in p}
    for _ in range(len(label)):
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    linked_ = {n for a, b in pairs if a != b for n in (a, b)}
    assert found == {n: label[n] for n in linked_}
    assert components(llm.createDataFrame([], "a long, b long")).collect() == []


def test_decontamination(llm, odd, texts):
    random.seed(4)
    word = lambda: "".join(random.choices("abcdefgh", k=random.randint(2, 8)))
    items = [(i, " ".join(word() for _ in range(random.randint(12, 60)))) for i in range(30)] + [(90, None), (91, ""), (92, "short"), (3, "again " * 9)]
    rows, planted = list(texts), set()
    for i in range(60):
        before, after = (" ".join(word() for _ in range(random.randint(0, 80))) for _ in range(2))
        if i % 3 == 0:
            rows.append((100 + i, f"{before} {after}"))
            continue
        number, item = items[i // 2]
        letters = list(item.upper() if i % 2 else item.replace(" ", " - "))
        if i % 3 == 2:
            for _ in range(int(decontamination.EDITS * len(item)) // 2):
                letters[random.randrange(len(letters))] = "z"
        rows.append((100 + i, f"{before} {''.join(letters)} {after}"))
        planted.add((100 + i, number))
    benchmark = llm.createDataFrame(items, "item_id long, text string")
    found = decontamination.matches(odd(rows), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == planted
    by_id = dict(rows)
    for r in found:
        assert r.edits <= decontamination.EDITS * decontamination.PIECE and decontamination.LEAST <= r.covered <= 1 and 0 <= r.first_byte < r.end_byte <= len(by_id[r.doc_id].encode())
    assert decontamination.matches(odd([]), benchmark).collect() == []
    assert decontamination.matches(odd(rows), benchmark.limit(0)).collect() == []


def fewest_edits(a, b, low=None, high=None):
    """Between ``a`` and any part of ``b``, on all diagonals or on those from ``low`` to ``high``."""
    far = 10**6
    row = [0 if low is None or low <= j <= high else far for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        new = []
        for j in range(len(b) + 1):
            best = min(row[j] + 1, row[j - 1] + (x != b[j - 1]) if j else far, new[-1] + 1 if j else far)
            new.append(best if low is None or low <= j - i <= high else far)
        row = new
    return min(row)


@pytest.mark.parametrize("edits", [0, 1, 4])
def test_alignment(edits):
    random.seed(edits)
    for _ in range(150):
        item = bytes(random.choices(b"abc", k=random.randint(3, 12)))
        text = bytes(random.choices(b"abc", k=random.randint(1, 30)))
        best = fewest_edits(item, text)
        found = decontamination.align(item, text, -len(item), len(text), edits)
        assert (found[0] if found else None) == (best if best <= edits else None)
        low = random.randint(-6, 10)
        high = low + random.randint(0, 8)
        banded = fewest_edits(item, text, low, high)
        found = decontamination.align(item, text, low, high, edits)
        if found and found[0]:
            assert found[0] == banded
        assert bool(found) == (banded <= edits) or found == (0, text.find(item, max(low, 0)) + len(item))


def normal(text):
    return " ".join(re.findall(r"[0-9a-z\u0080-\U0010FFFF]+", (text or "").translate({c: c + 32 for c in range(65, 91)})))


def brute_matches(rows, items, q=decontamination.Q, share=decontamination.EDITS):
    """Every piece of every item against every text."""
    found, size, step = set(), decontamination.PIECE, decontamination.STEP
    for doc_id, text in rows:
        plain = normal(text).encode()
        for item_id, item in items:
            item = normal(item).encode()
            last = max(len(item) - size, 0)
            hits = {}
            for start in {*range(0, last, step), last} if item else ():
                piece = item[start : start + size]
                if len(piece) < 2 * q:
                    if f" {piece.decode()} " in f" {plain.decode()} ":
                        hits[start] = 0
                    continue
                allowed = min(int(share * len(piece)), (len(piece) - q) // q)
                best = 0 if piece in plain else fewest_edits(piece, plain)
                if best <= allowed:
                    hits[start] = best
            covered = len({k for start in hits for k in range(start, min(start + size, len(item)))})
            if hits and covered >= decontamination.LEAST * len(item):
                found.add((doc_id, item_id, round(covered / len(item), 6), min(hits.values())))
    return found


def test_decontamination_equals_brute_force(llm, odd):
    """Few letters, so that texts and items share many q-grams by chance; changed, cut, short and odd items."""
    random.seed(8)
    words = ["".join(random.choices("abcé", k=random.randint(1, 6))) for _ in range(25)]
    text = lambda n: " ".join(random.choices(words, k=n))
    items = [(i, text(random.randint(4, 30))) for i in range(14)] + [(50, "one short"), (51, "x9"), (52, "A-b"), (53, ""), (54, None), (1, text(20))]
    rows = [(99, None), (98, ""), (97, "one short"), (97, "One, SHORT x9a b"), (96, "none shorter x9 ab")]
    for i in range(24):
        item = list((items[i % 14][1]))
        for _ in range(i % 5):
            item[random.randrange(len(item))] = random.choice("abc ")
        cut = random.randrange(len(item)) if i % 3 == 0 else 0
        rows.append((i, f"{text(random.randint(0, 12))} {''.join(item[cut:])}. {text(random.randint(0, 12))}"))
    found = decontamination.matches(odd(rows), llm.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id, round(r.covered, 6), r.edits) for r in found} == brute_matches(rows, items)


@pytest.mark.parametrize("change", ["1 word", "2 words", "3 words", "0.75", "0.5"])
def test_changed_and_cut_items_are_found(llm, change):
    """The items of the benchmark among other texts, with changed words or as excerpts."""
    random.seed(6)
    folder = FOLDER.replace("0.001", "0.01")
    items = [(r.item_id, r.text) for r in llm.read.parquet(f"{folder}/benchmark.parquet").collect()]
    texts = [r.text for r in llm.read.parquet(f"{folder}/documents.parquet").where("lang = 'de' and length(text) < 3000").collect()]
    words = [w for t in texts for w in t.split()]
    rows = []
    for n, (_, item) in enumerate(items):
        if "word" in change:
            changed = item.split()
            for at in random.sample(range(len(changed)), min(int(change[0]), len(changed))):
                changed[at] = random.choice(words)
            item = " ".join(changed)
        else:
            size = int(float(change) * len(item))
            start = random.randrange(len(item) - size + 1)
            item = item[start : start + size]
        rows.append((n, f"{texts[n][:500]} {item} {texts[n][500:]}"))
    docs = llm.createDataFrame(rows, "doc_id long, text string")
    found = decontamination.matches(docs, llm.createDataFrame(items, "item_id long, text string")).collect()
    pairs = {(r.doc_id, r.item_id) for r in found}
    assert sum((n, i) in pairs for n, (i, _) in enumerate(items)) >= 0.9 * len(items)
