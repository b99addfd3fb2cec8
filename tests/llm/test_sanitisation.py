from __future__ import annotations

import hashlib
import math
import random
import re
from collections import defaultdict

import pytest
from compare import SMALL as FOLDER

from tradeloom.llm import queries, sanitisation

# The forms as they are asked for.
FORMS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]
NAMES = [*sanitisation.KINDS, sanitisation.REMOVED, sanitisation.GENERALISED]


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        n = int(digit) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def brute_personal(text: str):
    found = []
    for kind, form in enumerate(FORMS):
        for m in re.finditer(form, text):
            digits = re.sub("[^0-9]", "", m.group())
            fits = [
                True,
                kind == 1 and all(int(part) <= 255 for part in m.group().split(".")),
                14 <= len(digits) <= 19 and luhn(digits),
                10 <= len(digits) <= 15,
            ]
            if fits[kind]:
                found.append((m.start(), kind, m.end()))
    return sorted(found)


def brute_spans(texts, generalise=sanitisation.GENERALISE, remove=sanitisation.REMOVE, everywhere=False):
    """All spans of each text, with passages, entities and terms as strings."""
    word = re.compile(r"[0-9A-Za-z\u0080-\U0010FFFF]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    passages = []
    for text in texts:
        words = [(m.start(), m.end(), m.group().translate(lower)) for m in word.finditer(text or "")]
        cut = [(words[i : i + sanitisation.PASSAGE], set()) for i in range(0, len(words), sanitisation.PASSAGE)]
        for start, kind, end in brute_personal(text or ""):
            value = text[start:end]
            entity = (kind, value.lower() if kind == 0 else value if kind == 1 else re.sub("[^0-9]", "", value))
            cut[next(i for i, w in enumerate(words) if w[1] > start) // sanitisation.PASSAGE][1].add(entity)
        passages += [(tuple(w[2] for w in ws), frozenset(es)) for ws, es in cut]
    n_term, n_entity, n_both, support, different = defaultdict(int), defaultdict(int), defaultdict(int), defaultdict(set), defaultdict(set)
    for words, entities in passages:
        for term in set(words):
            n_term[term] += 1
        for entity in entities:
            n_entity[entity] += 1
            different[entity].add((words, entities))
            for term in set(words):
                n_both[entity, term] += 1
                support[entity, term].add((words, entities))
    told = defaultdict(float)
    for (entity, term), n in n_both.items():
        if len(support[entity, term]) >= sanitisation.SUPPORT and n_entity[entity] < len(passages):
            share = 1 - math.log(n_term[term] / n) / math.log(len(passages) / n_entity[entity])
            told[term] = max(told[term], share)
    result = []
    for text in texts:
        base = brute_personal(text or "")
        spans = list(base)
        for m in word.finditer(text or "") if base or everywhere else ():
            share = told.get(m.group().translate(lower), 0)
            if share >= generalise and not any(m.start() < e and s < m.end() for s, _, e in base):
                spans.append((m.start(), 4 if share >= remove else 5, m.end()))
        result.append((base, sorted(spans)))
    return result


def written(spans):
    return ",".join(f"{NAMES[kind]}:{start}:{end}" for start, kind, end in spans)


def found_by_id(df):
    rows = df.select("doc_id", sanitisation.span_text().alias("base"), sanitisation.span_text(terms="terms").alias("spans"), "text").collect()
    return {r.doc_id: (r.base, r.spans, r.text) for r in rows}


def people(n_clean=60):
    """Names that mostly stand with their owner's address, among common words; one address in a third of all texts."""
    draw = random.Random(5)
    common = [f"word{i}" for i in range(120)]
    texts = []
    for person in range(6):
        for n in range(5):
            words = draw.sample(common, 30)
            words[draw.randrange(30)] = f"Straße{'abcdef'[person]} O{'abcdef'[person]}brien {4400 + person} x{person}z"
            words[draw.randrange(30)] = f"Person.{person}@Mail{person}.example.com" if n % 2 else f"person.{person}@mail{person}.example.com"
            words[draw.randrange(30)] = f"+49 (30) 555-01{person}{person}" if person < 3 else "plain"
            texts.append(" ".join(words))
    # A name that is also known elsewhere, and a copy of a text with an address, which proves nothing.
    texts += [f"Straßea {' '.join(draw.sample(common, 20))}" for _ in range(2)]
    texts += ["one of a kind: only.once@example.org with Zanzibar nearby"] * 7
    texts += [f"{' '.join(draw.sample(common, 40))} info@example.com" for _ in range(n_clean)]
    return texts + [" ".join(draw.choices(common, k=200)) for _ in range(n_clean)]


def test_forms_equal_the_expressions():
    draw = random.Random(2)
    for _ in range(20_000):
        letters = draw.choice(["a@.b-_c", "0123.5 ", "+0123456789 ()-.", "0 -4", "a1@.+ é2", "é@a.0+"])
        text = "".join(draw.choice(letters) for _ in range(draw.randrange(40)))
        assert sanitisation.personal(text) == brute_personal(text), text


def test_forms_take_time_in_proportion_to_the_text():
    for text in ("a" * 300_000, "@" * 300_000, "1" * 300_000, "1." * 150_000, "+1" * 150_000, "1 " * 150_000, "a@b." * 80_000):
        sanitisation.personal(text)


def test_query_equals_brute_force(llm):
    rows = queries.queries()["op12_sanitisation"](llm, FOLDER).collect()
    texts = {r.doc_id: r.text for r in llm.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    expected = dict(zip(texts, brute_spans(list(texts.values()))))
    assert len(rows) == len(texts)
    for row in rows:
        base, spans = expected[row.doc_id]
        counts = [sum(kind == k for _, kind, _ in base) for k in range(4)]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == counts
        assert row.base_sha256 == hashlib.sha256(written(base).encode()).hexdigest()
        assert row.spans == written(spans)


def test_terms_that_give_a_person_away(llm):
    texts = people()
    found = found_by_id(sanitisation.sanitise(llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), generalise=0.7))
    expected = brute_spans(texts, generalise=0.7)
    for i, (base, spans) in enumerate(expected):
        assert found[i][:2] == (written(base), written(spans))
    kinds = {kind for _, spans in expected for _, kind, _ in spans}
    assert kinds == {0, 3, 4, 5}
    # The first person's street is known elsewhere, so it is generalised; the name is not.
    assert "Straßea" not in found[0][2] and "[word]" in found[0][2] and "Oabrien" not in found[0][2] and "[email]" in found[0][2]
    # Texts without personal data, and what stands near a single mention, are left alone.
    assert found[30][2] == texts[30] and "Zanzibar" in found[33][2]


@pytest.mark.parametrize("bits", [1 << 24, 1 << 15])
def test_terms_are_found_in_texts_without_personal_data(llm, monkeypatch, bits):
    monkeypatch.setattr(sanitisation, "FILTER", bits)
    texts = [*people(), None, "", "Oabrien lives in STRASSE or Straßea, Straßeb"]
    rows = [*enumerate(texts), (None, texts[30]), (30, texts[30])]
    found = sanitisation.sanitise(llm.createDataFrame(rows, "doc_id long, text string"), generalise=0.7, everywhere=True)
    expected = brute_spans([t for _, t in rows], generalise=0.7, everywhere=True)
    got = found.select("doc_id", sanitisation.span_text(terms="terms").alias("spans")).collect()
    assert sorted((str(r.doc_id), r.spans) for r in got) == sorted((str(i), written(s)) for (i, _), (_, s) in zip(rows, expected))
    assert not expected[30][0] and expected[30][1]
    texts_of = {r.doc_id: r.text for r in found.where("doc_id is not null").collect()}
    assert "Straßea" not in texts_of[30] and texts_of[len(texts) - 3] is None


def test_the_query_looks_at_texts_without_personal_data(llm, tmp_path):
    """The given tables have no such text, so one is made."""
    draw = random.Random(1)
    texts = [f"{' '.join(draw.sample([f'w{i}' for i in range(90)], 30))} Zanzibarit{n % 2} a{n % 2}@example.org" for n in range(12)]
    texts += [" ".join(draw.sample([f"w{i}" for i in range(90)], 60)) for _ in range(40)]
    rows = list(enumerate([*texts, "the house of Zanzibarit1"]))
    columns = "doc_id long, text string"
    # With the term in a text of its own it tells less than all.
    llm.createDataFrame(rows, columns).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r.spans for r in queries.queries()["op12_sanitisation"](llm, str(tmp_path)).collect()}
    expected = brute_spans([t for _, t in rows], everywhere=True)
    assert {i: written(s) for (i, _), (_, s) in zip(rows, expected)} == found
    assert found[len(rows) - 1] == "general:13:24"


def test_a_long_text_is_read_in_pieces(llm, monkeypatch):
    texts = people(20)
    one = " ".join(texts)
    monkeypatch.setattr(sanitisation, "PIECE", 700)
    raw = one.encode()
    pieces = list(sanitisation._pieces(raw))
    assert b"".join(p for _, p in pieces) == raw and len(pieces) > 5
    assert all(len(sanitisation._terms(p)[1]) % sanitisation.PASSAGE == 0 for _, p in pieces[:-1])
    base = [dict(start=s, kind=k, end=e) for s, k, e in sanitisation.personal(one)]
    in_pieces = list(sanitisation._shared_passages(one, base))
    monkeypatch.setattr(sanitisation, "PIECE", 1 << 30)
    whole = list(sanitisation._shared_passages(one, base))
    assert [(h, e) for h, e, _ in in_pieces] == [(h, e) for h, e, _ in whole]


@pytest.mark.parametrize("rows", ["odd", "empty"])
def test_odd_documents(llm, odd, texts, rows):
    mail = "write to a.b@c.org or +1 (132) 555-1352, card 4736962573099581, host 10.0.0.255 and 10.0.0.256 "
    rows = [*texts, (30, mail), (30, mail), (30, "other " + mail), (None, mail), (31, "é" * 5 + mail * 3), (32, mail * 300)] if rows == "odd" else []
    found = sanitisation.sanitise(odd(rows))
    got = sorted((str(r.doc_id), r.base, r.spans) for r in found.select("doc_id", sanitisation.span_text().alias("base"), sanitisation.span_text(terms="terms").alias("spans")).collect())
    assert got == sorted((str(i), written(b), written(s)) for (i, _), (b, s) in zip(rows, brute_spans([t for _, t in rows])))
