"""Personal data by form, and the terms that give it away by the company they keep.

Emails, IP addresses, card and phone numbers are found by form in every text. Each distinct value is an entity to
protect. Texts are cut into passages of PASSAGE words; with N passages, n_c that mention an entity, n_t that hold a term
and n_ct with both, the term tells

    log(N n_ct / (n_c n_t)) / log(N / n_c) = 1 - log(n_t / n_ct) / log(N / n_c)

of the entity's information (pointwise mutual information by information content): 1 for a term that never stands
without it. Terms that tell ``remove`` or more of some entity are taken out, those that tell ``generalise`` or more are
replaced by their kind (word, number or code). With ``everywhere`` that is done in all texts, as a term gives its entity
away in any of them; else only in those that mention personal data.
A single mention proves nothing: n_ct must stand on SUPPORT different passages, copies counting as one.

Only passages with mentions are shuffled, equal ones once; counts of terms are combined first and are taken for the
whole corpus; an entity in very many passages is a sum like any other. Terms, entities and passages are compared by 64-bit
hashes. Long texts are read in pieces of whole passages. Texts without a mention are looked through by a table of
FILTER bits, so that only the places of likely terms are shuffled, to be compared with the terms themselves.

A null or empty text has no spans; rows that repeat an id are documents by their texts; spans that overlap are all
reported, and replaced together by the first; an empty table gives an empty result; extra columns are dropped.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.texts import Texts, slices, span_hashes, to_long, words
from tradeloom.sources.shared import stored

#: Words of a passage, and different passages that a term and an entity must share.
PASSAGE, SUPPORT = 64, 3
#: Shares of an entity's information from which a term is generalised or removed.
GENERALISE, REMOVE = 0.9, 1.0
#: Bytes of a text that are looked at together.
PIECE = 1 << 20
#: Terms of slices that a task adds up before it passes them on.
COUNTED = 1 << 20
#: Bits of the table of disclosing terms, a power of 2. Where it is full, more places are shuffled, but none is missed.
FILTER = 1 << 24

KINDS = ["email", "ip", "card", "phone"]
#: Kinds of the method's spans: a term that is removed, and one that is generalised.
REMOVED, GENERALISED = "term", "general"

# The forms. Possessive repeats change no match, as what follows them is no part of them.
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
#: A term is a run of ASCII letters and digits and of bytes beyond ASCII.
_BREAKS = np.ones(256, bool)
_BREAKS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_SOME_PASSAGE = re.compile(rb"[^0-9A-Za-z\x80-\xff]*+(?:[0-9A-Za-z\x80-\xff]++[^0-9A-Za-z\x80-\xff]*+){1,%d}" % PASSAGE)


def emails(text: str) -> list[tuple[int, int]]:
    """Each @ takes the longest run before it that no earlier match has, and labels joined by single dots after it."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = free + len(text[free:at].rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, domain.end()))
        free = domain.end() if domain else at + 1
        at = text.find("@", free)
    return found


def _is_byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def _passes_luhn(digits: str) -> bool:
    doubled = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (doubled + sum(int(d) for d in digits[::-2])) % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def personal(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all personal data, sorted; kinds are places in KINDS, places are code points."""
    found = [(start, 0, end) for start, end in emails(text)]
    if _DIGIT.search(text):
        found += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(map(_is_byte, m.groups()))]
        for m in _CARD.finditer(text):
            # Separators at most double a number's length.
            if 14 <= m.end() - m.start() <= 37 and 14 <= len(digits := _digits(m.group())) <= 19 and _passes_luhn(digits):
                found.append((m.start(), 2, m.end()))
        found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m.group())) <= 15]
    return sorted(found)


def _entity(kind: int, value: str) -> int:
    """The hash of an entity: an email in lower case, the digits of numbers."""
    plain = value.lower() if kind == 0 else value if kind == 1 else _digits(value)
    return xxhash.xxh64_intdigest(f"{kind}:{plain}")


_SPAN = "array<struct<start:int,kind:int,end:int>>"
_SPAN_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))


def _versions(documents: DataFrame) -> DataFrame:
    """(doc_id, version, text): ``version`` tells rows of one id apart."""
    return documents.select("doc_id", F.xxhash64("text").alias("version"), F.col("text").cast("string").alias("text"))


def _without_personal(batch: pa.RecordBatch) -> pa.RecordBatch:
    return batch.filter(pa.array([not personal(text.as_py() or "") for text in batch.column("text")], pa.bool_()))


def with_personal(documents: DataFrame) -> DataFrame:
    """(doc_id, version, text, base): ``base`` lists the personal data."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[dict(zip(("start", "kind", "end"), s)) for s in personal(text.as_py() or "")] for text in batch.column("text")]
            yield batch.append_column("base", pa.array(spans, _SPAN_TYPE))

    rows = _versions(documents)
    kind = documents.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(find, f"doc_id {kind}, version long, text string, base {_SPAN}")


def _pieces(raw: bytes) -> Iterator[tuple[int, bytes]]:
    """(place, bytes) of stretches of whole passages, about PIECE bytes at most where passages allow it."""
    start = end = 0
    while end < len(raw):
        if len(raw) - start <= PIECE:
            end = len(raw)
        else:
            while end < len(raw) and end - start < PIECE:
                passage = _SOME_PASSAGE.match(raw, end)
                end = passage.end() if passage else len(raw)
        yield start, raw[start:end]
        start = end


def _terms(piece: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of a piece, and start, end and hash of its terms."""
    data = np.frombuffer(piece, np.uint8)
    found = words(Texts(None, data, np.array([0, len(data)])), _BREAKS)
    return data, found.starts, found.ends, span_hashes(_LOWER[data], found.starts, found.ends)


def _byte_places(text: str, spans: list[dict]) -> list[tuple[int, int, int]]:
    """(start, end, entity) of spans in bytes."""
    places, at, place = [], 0, 0
    for span in spans:
        place += len(text[at : span["start"]].encode())
        at = span["start"]
        value = text[at : span["end"]]
        places.append((place, place + len(value.encode()), _entity(span["kind"], value)))
    return places


def _shared_passages(text: str, spans: list[dict]) -> Iterator[tuple[int, list[int], np.ndarray]]:
    """(hash, entities, terms) of each passage with a mention: one that is about to start in the passage's words."""
    mentions = _byte_places(text, spans)
    done = 0
    for offset, piece in _pieces(text.encode()):
        _, starts, ends, hashes = _terms(piece)
        by_passage: dict[int, set[int]] = {}
        while done < len(mentions) and mentions[done][0] < offset + len(piece):
            # The first word that ends after the mention's start; it may stand in the next piece.
            word = int(np.searchsorted(ends, mentions[done][0] - offset, "right"))
            if word == len(ends):
                break
            by_passage.setdefault(word // PASSAGE, set()).add(mentions[done][2])
            done += 1
        for passage, entities in by_passage.items():
            here = hashes[passage * PASSAGE : (passage + 1) * PASSAGE]
            known = sorted(entities)
            yield xxhash.xxh64_intdigest(here.tobytes() + np.array(known, np.uint64).tobytes()), known, np.unique(here)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def shared_passages(found: DataFrame) -> DataFrame:
    """(entities, terms, n): different passages that mention personal data, and how many copies each has."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, base in zip(batch.column("text"), batch.column("base").to_pylist()):
                rows = list(_shared_passages(text.as_py() or "", base))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([_signed(h) for h, _, _ in rows], pa.int64()),
                            pa.array([list(map(_signed, e)) for _, e, _ in rows], pa.list_(pa.int64())),
                            pa.array([to_long(t) for _, _, t in rows], pa.list_(pa.int64())),
                        ],
                        names=["passage", "entities", "terms"],
                    )

    rows = found.select("text", "base").mapInArrow(cut, "passage long, entities array<long>, terms array<long>")
    return rows.groupBy("passage").agg(F.first("entities").alias("entities"), F.first("terms").alias("terms"), F.count("*").alias("n")).drop("passage")


def term_counts(documents: DataFrame) -> DataFrame:
    """(term, n): passages of the whole corpus that hold each term; the row with a null term counts all passages."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n_held, passages = 0, 0

        def summed() -> pa.RecordBatch:
            terms, place = np.unique(np.concatenate([t for t, _ in held]), return_inverse=True)
            n = np.bincount(place, np.concatenate([n for _, n in held])).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(to_long(terms)), pa.array(n)], names=["term", "n"])

        for texts in slices(_without_long(batches)):
            found = words(texts, _BREAKS)
            of = found.text_of()
            in_text = np.arange(len(of)) - found.offsets[of]
            per_text = -(-found.counts() // PASSAGE)
            passage = np.concatenate([[0], np.cumsum(per_text)])[of] + in_text // PASSAGE
            passages += int(per_text.sum())
            held.append(_in_passages(span_hashes(_LOWER[texts.data], found.starts, found.ends), passage))
            n_held += len(held[-1][0])
            if n_held > COUNTED:
                yield summed()
                held, n_held = [], 0
        if held:
            yield summed()
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.array([passages], pa.int64())], names=["term", "n"])

    counted = documents.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "term long, n long")
    return counted.groupBy("term").agg(F.sum("n").alias("n"))


def _in_passages(hashes: np.ndarray, passage: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes, and in how many passages each stands."""
    # Equal hashes keep the order of their passages.
    order = np.argsort(hashes, kind="stable")
    hashes, passage = hashes[order], passage[order]
    new = np.ones(len(hashes), bool)
    new[1:] = hashes[1:] != hashes[:-1]
    first = np.flatnonzero(new)
    new[1:] |= passage[1:] != passage[:-1]
    return hashes[first], np.add.reduceat(new, first, dtype=np.int64) if len(first) else np.zeros(0, np.int64)


def _without_long(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of texts, with the pieces of each long text in place of it."""
    for batch in batches:
        long = pc.fill_null(pc.greater(pc.binary_length(batch.column("text")), PIECE), False)
        yield batch.filter(pc.invert(long))
        for text in batch.column("text").filter(long):
            for _, piece in _pieces(text.as_buffer().to_pybytes()):
                yield pa.RecordBatch.from_arrays([pa.array([piece], pa.binary()).cast(pa.string())], names=["text"])


def disclosing_terms(documents: DataFrame, found: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """(term, removed) of the terms that tell ``generalise`` or more of an entity's information."""
    spark = documents.sparkSession
    passages = stored(shared_passages(found), "passages")
    mentioned = passages.select(F.explode("entities").alias("entity"), "n").groupBy("entity")
    entities = stored(mentioned.agg(F.sum("n").alias("n_entity"), F.count("*").alias("different")).where(F.col("different") >= SUPPORT).drop("different"), "entities")
    none = spark.createDataFrame([], "term long, removed boolean")
    if entities.isEmpty():
        return none
    pairs = passages.select(F.explode("entities").alias("entity"), "terms", "n").join(entities.select("entity"), "entity", "left_semi")
    together = pairs.select("entity", F.explode("terms").alias("term"), "n").groupBy("entity", "term")
    likely = stored(together.agg(F.sum("n").alias("n_both"), F.count("*").alias("different")).where(F.col("different") >= SUPPORT).drop("different"), "pairs")
    counts = stored(term_counts(documents), "term-counts")
    total = counts.where("term is null").first()
    if not total or not total.n:
        return none
    share = 1 - F.log(F.col("n_term") / F.col("n_both")) / F.log(F.lit(float(total.n)) / F.col("n_entity"))
    told = likely.join(entities, "entity").join(counts.withColumnRenamed("n", "n_term"), "term").where(F.col("n_entity") < total.n)
    return told.groupBy("term").agg(F.max(share).alias("share")).where(F.col("share") >= generalise).select("term", (F.col("share") >= remove).alias("removed"))


def term_filter(terms: DataFrame) -> np.ndarray:
    """FILTER bits, of which those of the terms' hashes are set; made on the executors, of a size that never grows."""
    place = F.col("term").bitwiseAND(F.lit(FILTER - 1)) + 1
    placed = terms.select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("bit"))
    bits = np.zeros(FILTER // 8, np.uint8)
    # At most FILTER / 32,768 rows of 4,096 bytes.
    for row in placed.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).toLocalIterator():
        start = (row.bucket - 1) * 4096
        part = np.frombuffer(row.bits, np.uint8)[: len(bits) - start]
        bits[start : start + len(part)] = part
    return bits


def _likely(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes may be of a term in the filter."""
    place = (hashes & np.uint64(8 * len(bits) - 1)).astype(np.int64)
    return (bits[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)


def _likely_texts(batches: Iterator[pa.RecordBatch], bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows without personal data whose text is long or may hold a term in the filter, with an empty ``base``."""
    for batch in _long_or_likely(batches, bits):
        clean = _without_personal(batch)
        yield clean.append_column("base", pa.array([[]] * len(clean), _SPAN_TYPE))


def _long_or_likely(batches: Iterator[pa.RecordBatch], bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        long = pc.fill_null(pc.greater(pc.binary_length(batch.column("text")), PIECE), False)
        yield batch.filter(long)
        for texts in slices(iter([batch.filter(pc.invert(long))])):
            found = words(texts, _BREAKS)
            hits = _likely(bits, span_hashes(_LOWER[texts.data], found.starts, found.ends))
            rows = np.unique(found.text_of()[hits])
            if len(rows):
                yield texts.rows.take(pa.array(rows))


def _term_places(found: DataFrame, likely: Broadcast | None = None) -> DataFrame:
    """(doc_id, version, term, start, end, kind) of all terms outside the personal data of ``found``, in code points.

    With ``likely``, a broadcast ``term_filter``, ``found`` has no ``base`` yet: only texts without personal data count, and
    only terms in the filter.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches if likely is None else _likely_texts(batches, likely.value):
            for row, (text, base) in enumerate(zip(batch.column("text"), batch.column("base").to_pylist())):
                text = text.as_py() or ""
                places = _byte_places(text, base)
                before = 0
                for offset, piece in _pieces(text.encode()):
                    data, starts, ends, hashes = _terms(piece)
                    covered = np.zeros(len(data) + 1, np.int32)
                    for start, end, _ in places:
                        if start < offset + len(piece) and end > offset:
                            covered[max(start - offset, 0)] += 1
                            covered[min(end - offset, len(piece))] -= 1
                    inside = np.concatenate([[0], np.cumsum(np.cumsum(covered[:-1]) > 0)])
                    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)]) + before
                    before = int(points[-1])
                    free = inside[starts] == inside[ends]
                    if likely is not None:
                        free &= _likely(likely.value, hashes)
                    starts, ends, hashes = starts[free], ends[free], hashes[free]
                    owner = pa.array(np.full(len(starts), row))
                    code = (data >= 0x30) & (data <= 0x39)
                    n_digits = np.concatenate([[0], np.cumsum(code)])
                    digits = n_digits[ends] - n_digits[starts]
                    form = np.where(digits == 0, 0, np.where(digits == ends - starts, 1, 2))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(owner), batch.column("version").take(owner), pa.array(to_long(hashes)), *(pa.array(a.astype(np.int32)) for a in (points[starts], points[ends], form))],
                        names=["doc_id", "version", "term", "start", "end", "form"],
                    )

    kind = found.schema["doc_id"].dataType.simpleString()
    return found.mapInArrow(cut, f"doc_id {kind}, version long, term long, start int, end int, form int")


#: What stands for a generalised term, by its form.
FORMS = ["[word]", "[number]", "[code]"]


def _replaced(text: str, base: list[dict], terms: list[dict]) -> str:
    marks = [(s["start"], s["end"], f"[{KINDS[s['kind']]}]") for s in base]
    marks += [(t["start"], t["end"], "" if t["removed"] else FORMS[t["form"]]) for t in terms]
    parts, at = [], 0
    for start, end, mark in sorted(marks):
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def sanitise(documents: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE, *, everywhere: bool = False) -> DataFrame:
    """(doc_id, text, base, terms): ``text`` without personal data and the terms that disclose it.

    ``base`` has (start, kind, end) of personal data, ``terms`` (start, end, removed, form) of the terms, both sorted.
    ``everywhere`` looks for the terms in texts without personal data too.
    """
    found = with_personal(documents)
    # Few documents have any; the rest is read once more, as it is, for the result.
    some = stored(found.where(F.size("base") > 0), "personal")
    shape = "array<struct<start:int,end:int,removed:boolean,form:int>>"
    terms = stored(disclosing_terms(documents, some, generalise, remove), "disclosing-terms")

    def with_terms(rows: DataFrame, places: DataFrame) -> DataFrame:
        """``rows`` with the list of their terms; the lists are few, and their stored size decides the join."""
        told = places.join(terms, "term").groupBy("doc_id", "version")
        lists = stored(told.agg(F.array_sort(F.collect_set(F.struct("start", "end", "removed", "form"))).alias("terms")), "disclosing")
        mine = rows["doc_id"].eqNullSafe(lists["doc_id"]) & (rows["version"] == lists["version"])
        kept = [rows[c] for c in rows.columns if c != "version"]
        return rows.join(lists, mine, "left").select(*kept, F.coalesce("terms", F.array().cast(shape)).alias("terms"))

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [_replaced(t or "", b, m) for t, b, m in zip(*(batch.column(c).to_pylist() for c in ("text", "base", "terms")))]
            yield batch.set_column(1, "text", pa.array(texts, pa.string()))

    def replace_clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in map(_without_personal, batches):
            # A text without terms stays as it is, null included.
            texts = [_replaced(t.as_py(), [], m) if m else t.as_py() for t, m in zip(batch.column("text"), batch.column("terms").to_pylist())]
            base = pa.array([[]] * len(batch), _SPAN_TYPE)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string()), base, batch.column("terms")], names=["doc_id", "text", "base", "terms"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    result = f"doc_id {kind}, text string, base {_SPAN}, terms {shape}"
    changed = with_terms(some, _term_places(some)).mapInArrow(replace, result)
    if not everywhere or terms.isEmpty():
        return changed.unionByName(found.where(F.size("base") == 0).select("doc_id", "text", "base", F.array().cast(shape).alias("terms")))
    likely = documents.sparkSession.sparkContext.broadcast(term_filter(terms))
    rows = _versions(documents)
    return changed.unionByName(with_terms(rows, _term_places(rows, likely)).mapInArrow(replace_clean, result))


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["name"], s["start"], s["end"])), ",")


def span_text(base: str = "base", terms: str | None = None) -> Column:
    """``kind:start:end`` of all spans by start, then kind; the method's kinds come last."""
    names = F.array(*map(F.lit, [*KINDS, REMOVED, GENERALISED]))

    def named(order: Column, start: Column, end: Column) -> Column:
        return F.struct(start.alias("start"), order.alias("order"), end.alias("end"), F.element_at(names, order + 1).alias("name"))

    spans = F.transform(base, lambda s: named(s["kind"], s["start"], s["end"]))
    if terms:
        more = F.transform(terms, lambda t: named(F.when(t["removed"], len(KINDS)).otherwise(len(KINDS) + 1), t["start"], t["end"]))
        spans = F.concat(spans, more)
    return _written(F.array_sort(spans))


def count_of(kind: str, base: str = "base") -> Column:
    return F.size(F.filter(base, lambda s: s["kind"] == KINDS.index(kind))).cast("long")
