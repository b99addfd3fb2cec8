"""Records of CSV files whose quoted values may hold line breaks, read by many tasks.

Whether a line break ends a record depends on all quotes before it in the file. A byte range of a file is a function of
that: it leaves the state as it was or turns it round, as it has an even or an odd number of quotes. One pass finds this
function for each range, with the file's header; composing the functions of the ranges before it tells whether a range
starts inside quotes. With that, each range is cut into records by itself, and only what stands at its two ends is put
together with its neighbours.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import discard, stored

#: A record that lies in one range, and the parts of one that does not, in the order in which they stand in a range.
WHOLE, LAST, MIDDLE, FIRST = 0, 1, 2, 3


@dataclass(frozen=True)
class CsvFile:
    path: str
    #: As file metadata name it.
    file_path: str
    header: str
    #: Whether some line has an odd number of quotes, so that a record may go on in the next line.
    quoted_breaks: bool


@dataclass(frozen=True)
class CsvFiles:
    #: What was read; a range of a file is the same only where the same files are read together.
    paths: str | list[str]
    files: list[CsvFile]
    #: Ranges that start inside quotes, as (file_path, place of the first byte): one entry per range at most.
    inside: frozenset[tuple[str, int]]

    def headers(self) -> list[str]:
        """The different headers."""
        return sorted({file.header for file in self.files})


def _lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines in the order of their range. Both passes read this, so that their ranges are the same."""
    return (
        spark.read.option("lineSep", "\n")
        .text(paths)
        .select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("start"), "value")
    )


def _stretches():
    """A function that goes with its code to executors, which need not have this package.

    It gives the stretches of a batch's lines that lie in one range: the range, the first line and the end.
    """

    def stretches(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], int, int]]:
        files, starts, n = batch.column("file_path"), batch.column("start"), len(batch)
        other_file = pc.not_equal(files.slice(1), files.slice(0, max(n - 1, 0))).to_numpy(zero_copy_only=False)
        other_start = pc.not_equal(starts.slice(1), starts.slice(0, max(n - 1, 0))).to_numpy(zero_copy_only=False)
        changes = [0, *((other_file | other_start).nonzero()[0] + 1).tolist()] if n else []
        for at, end in zip(changes, [*changes[1:], n]):
            yield (files[at].as_py(), starts[at].as_py()), at, end

    return stretches


def examine(spark: SparkSession, paths: str | list[str]) -> CsvFiles:
    """Header and quotes of each file, from one pass over all lines; empty files are left out."""

    stretches = _stretches()

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, odd_lines, header, in_header = None, 0, [], False

        def row() -> pa.RecordBatch:
            text = "\n".join(header) if header else None
            values = (known[0], known[1], odd_lines, text)
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=names)

        for batch in batches:
            lines = batch.column("value")
            odd = pc.bit_wise_and(pc.count_substring(lines, '"'), 1).to_numpy(zero_copy_only=False)
            for here, at, end in stretches(batch):
                if here != known:
                    if known:
                        yield row()
                    known, odd_lines, header, in_header = here, 0, [], here[1] == 0
                line = at
                while in_header and line < end:
                    header.append(lines[line].as_py())
                    in_header = sum(h.count('"') for h in header) % 2 == 1
                    line += 1
                odd_lines += int(odd[at:end].sum())
        if known:
            yield row()

    names = ["file_path", "start", "odd_lines", "header"]
    blocks = stored(_lines(spark, paths).mapInArrow(ranges, "file_path string, start long, odd_lines long, header string"), "csv-ranges")
    # One row per range of a file.
    earlier = Window.partitionBy("file_path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    turned = blocks.withColumn("turns", F.sum("odd_lines").over(earlier) % 2)
    inside = frozenset((r["file_path"], r["start"]) for r in turned.where("turns = 1").select("file_path", "start").collect())
    per_file = blocks.groupBy("file_path").agg(F.max("header").alias("header"), (F.sum("odd_lines") > 0).alias("breaks"))
    listed = spark.read.format("binaryFile").load(paths).select("path", F.col("_metadata.file_path").alias("file_path"))
    rows = listed.join(per_file, "file_path").orderBy("path").collect()
    discard(blocks)
    return CsvFiles(paths, [CsvFile(r["path"], r["file_path"], r["header"], r["breaks"]) for r in rows], inside)


def records(spark: SparkSession, found: CsvFiles) -> DataFrame:
    """(header, record) of all files without their headers, which are numbered as ``found.headers()`` lists them.

    Line ends inside quotes are kept.
    """
    starts_inside = spark.sparkContext.broadcast(found.inside)
    numbers = {header: n for n, header in enumerate(found.headers())}
    # One entry per file, as in the list of files.
    header_of = spark.sparkContext.broadcast({file.file_path: numbers[file.header] for file in found.files})

    stretches = _stretches()

    def cutter(ends: bool):
        """Cuts ranges into records: what stands at their ends, with its place, or all that lies inside."""

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, held, quoted, first, header = None, [], False, True, False
            out: list[list] = [[] for _ in kinds[ends]]

            def emit(part: int, texts: list[str]) -> None:
                nonlocal header
                found = texts[header and bool(texts) :]
                header = header and not texts
                if (part != WHOLE) == ends:
                    place = (*known, part) if ends else ()
                    for column, value in zip(out, (header_of.value[known[0]], *place)):
                        column.extend([value] * len(found))
                    out[-1].extend(found)

            def close() -> None:
                # What is held goes on in the next range: the start of a record, or a whole range inside of one.
                if held:
                    emit(MIDDLE if first and known in starts_inside.value else FIRST, ["\n".join(held)])

            def rows() -> pa.RecordBatch:
                arrays = [pa.array(c, k) for c, k in zip(out, kinds[ends].values())]
                return pa.RecordBatch.from_arrays(arrays, names=list(kinds[ends]))

            for batch in batches:
                column = batch.column("value")
                lines = column.to_pylist()
                odd = pc.bit_wise_and(pc.count_substring(column, '"'), 1).to_numpy(zero_copy_only=False)
                # Lines that turn the state round.
                turning, number = odd.nonzero()[0].tolist(), 0
                for here, at, stop in stretches(batch):
                    if here != known:
                        close()
                        known, held, first = here, [], True
                        quoted, header = known in starts_inside.value, known[1] == 0
                    while at < stop:
                        turns = number < len(turning) and turning[number] < stop
                        end = turning[number] if turns else stop
                        if not quoted:
                            emit(WHOLE, lines[at:end])
                            first = first and end == at
                            held = [lines[end]] if turns else []
                        else:
                            held += lines[at : end + turns]
                            if turns:
                                emit(LAST if first and known in starts_inside.value else WHOLE, ["\n".join(held)])
                                held, first = [], False
                        quoted = quoted != turns
                        at, number = end + turns, number + turns
                yield rows()
                for values in out:
                    values.clear()
            if known:
                close()
            yield rows()

        return cut

    place = {"file_path": pa.string(), "start": pa.int64(), "part": pa.int32()}
    kinds = {
        ends: {"header": pa.int32(), **(place if ends else {}), "record": pa.string()} for ends in (False, True)
    }
    lines = _lines(spark, found.paths)
    # At most two parts per range.
    parts = lines.mapInArrow(cutter(True), "header int, file_path string, start long, part int, record string")
    in_file = Window.partitionBy("file_path").orderBy("start", "part")
    numbered = parts.withColumn("number", F.sum((F.col("part") == FIRST).cast("int")).over(in_file))
    listed = F.array_sort(F.collect_list(F.struct("start", "part", "record")))
    texts = F.transform(listed, lambda p: p["record"])
    joined = numbered.groupBy("file_path", "number", "header").agg(F.array_join(texts, "\n").alias("record"))
    whole = lines.mapInArrow(cutter(False), "header int, record string")
    return whole.unionByName(joined.select("header", "record"))
