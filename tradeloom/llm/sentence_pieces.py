"""SentencePiece encoding and decoding through a table of distinct chunks.

No piece of the vocabulary has a white-space marker after another character (checked when the model is read), so no
merge crosses from a word into the next marker. A text is therefore cut before every run of markers, each distinct chunk
is segmented once per worker, and the ids of all chunks are joined back by position with one numpy gather.

A null text is empty and has no ids; null ids decode to an empty text; repeated rows stay repeated; an empty table gives
an empty result; extra columns stay as they are, one called like the result is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

MARK = "▁"
#: Distinct chunks that a worker keeps before it starts its table anew.
TABLE = 1 << 16
#: Bytes of text whose ids are put together at once.
PIECE_BYTES = 1 << 20

_chunks = re.compile(f"{MARK}+[^{MARK}]*").findall
_loaded: dict[str, object] = {}


def _model(path: str):
    if path not in _loaded:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = (model.id_to_piece(i) for i in range(model.vocab_size()))
        if any(MARK in p.lstrip(MARK) for p in pieces) or model.encode_as_pieces("a  b ") != [f"{MARK}a", MARK, f"{MARK}b", MARK]:
            raise ValueError("pieces of this model can cross white-space markers")
        _loaded[path] = model
    return _loaded[path]


class ChunkTable:
    """Distinct chunks of a worker with their ids, flat and growing."""

    def __init__(self, model) -> None:
        self.model = model
        self.mark = model.piece_to_id(MARK)
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.ids = np.zeros(1 << 20, np.int32)
        self.ends = [0]

    def add(self, chunks: list[str]) -> None:
        # The library puts one marker before what it encodes.
        encoded = self.model.encode([c[1:].replace(MARK, " ") for c in chunks], num_threads=1)
        for chunk, ids in zip(chunks, encoded, strict=True):
            self.number[chunk] = len(self.number)
            if chunk == MARK:
                ids = [self.mark]
            end = self.ends[-1] + len(ids)
            if end > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), len(ids)), np.int32)])
            self.ids[self.ends[-1] : end] = ids
            self.ends.append(end)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each has."""
        cut = [_chunks(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        if len(self.number) > TABLE:
            self.clear()
        new = set().union(*cut).difference(self.number)
        if new:
            self.add(list(new))
        look = self.number.__getitem__
        at = np.fromiter((look(c) for chunks in cut for c in chunks), np.int64, sum(map(len, cut)))
        ends = np.asarray(self.ends, np.int64)
        counts = ends[at + 1] - ends[at]
        upto = np.concatenate([[0], np.cumsum(counts)])
        ids = self.ids[np.arange(upto[-1]) - np.repeat(upto[:-1] - ends[at], counts)]
        per_text = np.diff(upto[np.concatenate([[0], np.cumsum(list(map(len, cut)))]).astype(np.int64)])
        return ids, per_text


def _groups(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Texts of consecutive rows and the first of these rows."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    first = size = 0
    for row, more in enumerate(sizes.tolist()):
        if row > first and size + more > PIECE_BYTES:
            yield first, [v or "" for v in column.slice(first, row - first).to_pylist()]
            first, size = row, 0
        size += more
    if first < len(sizes):
        yield first, [v or "" for v in column.slice(first).to_pylist()]


def _map(df: DataFrame, added: dict[str, str], model_path: str, of_rows) -> DataFrame:
    """``df`` with columns that ``of_rows(table, rows)`` yields for pieces of each batch."""
    kept = [f.name for f in df.schema if f.name not in added]
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name not in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ChunkTable(_model(model_path))
        for batch in batches:
            for rows, columns in of_rows(table, batch):
                yield pa.RecordBatch.from_arrays([*(rows.column(n) for n in kept), *columns], names=[*kept, *added])

    return df.mapInArrow(run, ", ".join([*schema, *(f"{name} {kind}" for name, kind in added.items())]))


def _encoded(text: str):
    def of_rows(table: ChunkTable, batch: pa.RecordBatch):
        for first, group in _groups(batch.column(text)):
            ids, counts = table.encode(group)
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            yield batch.slice(first, len(group)), [pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))]

    return of_rows


def _decoded(table: ChunkTable, ids: pa.ListArray) -> pa.Array:
    decode = table.model.decode
    return pa.array([decode(v.values.to_numpy(zero_copy_only=False).tolist()) if v.is_valid and len(v.values) else "" for v in ids], pa.string())


def encode(texts: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """Adds ``ids``, the library's ids without begin or end."""
    return _map(texts, {"ids": "array<int>"}, model_path, _encoded(text))


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """Adds ``decoded``, the text that the library makes of ``ids``."""
    return _map(encoded, {"decoded": "string"}, model_path, lambda table, batch: [(batch, [_decoded(table, batch.column("ids"))])])


def encode_and_decode(texts: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """``decode(encode(texts))`` with one Python worker for both steps."""

    def of_rows(table: ChunkTable, batch: pa.RecordBatch):
        for rows, (ids,) in _encoded(text)(table, batch):
            yield rows, [ids, _decoded(table, ids)]

    return _map(texts, {"ids": "array<int>", "decoded": "string"}, model_path, of_rows)
