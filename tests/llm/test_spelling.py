from __future__ import annotations

import re
import zlib
from collections import Counter

import pytest
from compare import SMALL as FOLDER

from tradeloom.llm import queries, spelling_variants

RUNS = re.compile("[a-zÀ-ÿ]+").findall


def brute_counts(rows, spoil=31):
    counts = Counter()
    for doc_id, text in rows:
        for word in RUNS((text or "").encode().lower().decode()):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if spoil and h % spoil == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def is_near(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[same + (len(a) == len(b)) :] == b[same + 1 :]


def brute_variants(counts):
    """Every word against every other."""
    near = {w: [v for v in counts if abs(len(v) - len(w)) < 2 and is_near(v, w)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None
    found = set()
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        found.add((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return found


def rows_of(df):
    return {tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect()}


def test_query_equals_brute_force(llm):
    found = queries.queries()["op11_spelling_variants"](llm, FOLDER)
    texts = [tuple(r) for r in llm.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    assert dict(found.dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}
    expected = brute_variants(brute_counts(texts))
    assert rows_of(found) == expected and found.count() == len(expected)


@pytest.mark.parametrize("limit", [2, 5, 1024])
def test_dense_words_at_every_size_of_group(llm, limit):
    """All groups but the largest are split at ``limit``; ties, repeated letters and edits at both ends included."""
    seeds = ["anana", "banana", "bananas", "aaaaaaa", "aaaaaa", "größer", "x", "xy", "yx", "東京都", "🤖🤖a"]
    words = dict.fromkeys(seeds)
    for word in seeds:
        for i in range(len(word) + 1):
            words |= dict.fromkeys([word[:i] + c + word[i:] for c in "ab京"] + [word[:i] + word[i + 1 :], word[:i] + "a" + word[i + 1 :]])
    counts = {w: 1 + (zlib.crc32(w.encode()) % 6) ** 4 for w in words if w}
    found = spelling_variants.variants(llm.createDataFrame(list(counts.items()), "word string, n long"), limit=limit)
    assert rows_of(found) == brute_variants(counts)


def test_one_prefix_in_a_third_of_all_words(llm):
    counts = {f"verein{i:05d}".translate(str.maketrans("0123456789", "abcdefghij")): 1 + i % 40 for i in range(600)}
    counts |= {f"{i:07d}".translate(str.maketrans("0123456789", "klmnopqrst")): 2 for i in range(0, 3_000_000, 2500)}
    found = spelling_variants.variants(llm.createDataFrame(list(counts.items()), "word string, n long"), limit=100)
    assert rows_of(found) == brute_variants(counts)


def test_forms_are_followed_to_the_last(llm):
    counts = {"aaaaaaa": 2, "aaaaaab": 20, "aaaaabb": 200, "aaaabbb": 2000, "aaabbbb": 20_000, "aabbbbb": 200_000, "other": 1}
    found = spelling_variants.variants(llm.createDataFrame(list(counts.items()), "word string, n long"))
    assert {r.word: r.root for r in found.collect()} == {w: "aabbbbb" if w != "other" else "other" for w in counts}


def test_odd_texts(llm, odd, texts):
    long = ("y" * 300_000 + " ") * 2 + ("y" * 299_999 + "x ") * 20
    rows = [*texts, (20, long), (21, "Überfluß überfluß ÜBERFLUß straßen Straßen STRAßEN " * 9)]
    found = spelling_variants.variants(spelling_variants.count_words(odd(rows)))
    assert rows_of(found) == brute_variants(brute_counts(rows))


def test_empty_table(llm, odd):
    found = spelling_variants.variants(spelling_variants.count_words(odd([])))
    assert found.collect() == []
