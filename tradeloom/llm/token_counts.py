"""Token counts of a byte-level BPE without shuffling pre-tokens.

Tier one is a broadcast table from frequent pre-tokens to their token counts. Tier two is a cache in each Python worker,
filled by the tokenizer itself. A text is cut into pre-tokens, each is looked up, and the counts are added up, so only
unknown pre-tokens are ever encoded.

Null and empty texts have 0 bytes and 0 tokens; repeated rows stay repeated; an empty table gives an empty result; extra
columns stay as they are, one called like a result column is replaced.
"""

from __future__ import annotations

import json
import os
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Entries of the broadcast table and the longest pre-token in it: at most FREQUENT * (LONGEST * 4 + 60) bytes.
FREQUENT = 1 << 15
LONGEST = 24
#: Candidates that one task names for the table.
PER_TASK = 1 << 13
#: Distinct words that a task counts before it drops the rarer half, and entries of a worker's cache.
COUNTED = 1 << 18
CACHED = 1 << 19

# How byte-level BPE cuts a text before merging. White space is the Unicode property.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"

_pre_tokens = regex.compile(PRE_TOKEN).findall
_loaded: dict[str, tuple] = {}
#: By tokenizer; a worker keeps it from task to task.
_caches: dict[str, dict[str, int]] = {}


def _tokenizer(path: str) -> tuple:
    """The tokenizer, and a pattern of its special strings (None if it has none); read once per worker."""
    if path not in _loaded:
        # A task has one core; threads of its own would only wait for each other.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            added = json.load(file)["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
            raise ValueError("special strings that reach beyond themselves are not supported")
        names = sorted((t["content"] for t in added), key=len, reverse=True)
        pattern = regex.compile("|".join(map(regex.escape, names))) if names else None
        _loaded[path] = (Tokenizer.from_file(path), pattern)
    return _loaded[path]


def frequent_pre_tokens(texts: DataFrame, text: str = "text") -> list[str]:
    """The most frequent pre-tokens over all rows, FREQUENT at most. Each task names at most PER_TASK of them.

    A task counts what stands between single spaces and cuts only distinct words into pre-tokens; which pre-tokens are in
    the table changes the time that counting takes, never a count.
    """

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for value in batch.column(0):
                if (value := value.as_py()) is not None:
                    seen.update(value.split(" "))
                    if len(seen) > COUNTED:
                        seen = Counter(dict(seen.most_common(COUNTED // 2)))
        tokens: Counter[str] = Counter()
        for word, n in seen.items():
            for token in _pre_tokens(f" {word}"):
                tokens[token] += n
        best = [(t, n) for t, n in tokens.most_common(PER_TASK) if n > 1 and len(t) <= LONGEST]
        yield pa.RecordBatch.from_pydict({"pre_token": [t for t, _ in best], "n": pa.array([n for _, n in best], pa.int64())}, schema)

    schema = pa.schema([("pre_token", pa.string()), ("n", pa.int64())])
    found = texts.select(F.col(text).alias("text")).mapInArrow(top, "pre_token string, n long")
    best = found.groupBy("pre_token").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "pre_token").limit(FREQUENT)
    return [r.pre_token for r in best.collect()]


def count_tokens(texts: DataFrame, tokenizer_path: str, text: str = "text") -> DataFrame:
    """Adds ``n_bytes`` and ``n_tokens``. The path must name the tokenizer's file on every machine."""
    spark = texts.sparkSession
    tokenizer, _ = _tokenizer(tokenizer_path)
    frequent = frequent_pre_tokens(texts, text)
    lengths = [len(e.ids) for e in tokenizer.encode_batch(frequent, add_special_tokens=False)]
    shared = spark.sparkContext.broadcast(dict(zip(frequent, lengths, strict=True)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, special = _tokenizer(tokenizer_path)
        known = _caches.setdefault(tokenizer_path, {})
        known.update(shared.value)
        for batch in batches:
            column = batch.column(text)
            numbers = []
            for value in column:
                value = value.as_py() or ""
                parts, total = [value], 0
                if special is not None and special.search(value):
                    parts = special.split(value)
                    total = len(parts) - 1
                for part in parts:
                    found = _pre_tokens(part)
                    try:
                        total += sum(map(known.__getitem__, found))
                    except KeyError:
                        if len(known) > CACHED:
                            known.clear()
                            known.update(shared.value)
                        missing = list(set(found).difference(known))
                        encoded = encoder.encode_batch_fast(missing, add_special_tokens=False)
                        known.update((t, len(e.ids)) for t, e in zip(missing, encoded, strict=True))
                        total += sum(map(known.__getitem__, found))
                numbers.append(total)
            n_bytes = pc.fill_null(pc.binary_length(column), 0).cast(pa.int64())
            kept = [n for n in batch.schema.names if n not in ("n_bytes", "n_tokens")]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), n_bytes, pa.array(numbers, pa.int64())], names=[*kept, "n_bytes", "n_tokens"])

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema if f.name not in ("n_bytes", "n_tokens")]
    return texts.mapInArrow(count, ", ".join([*kept, "n_bytes long", "n_tokens long"]))
