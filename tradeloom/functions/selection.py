"""Exact positions and ranks in an order that is never sorted as a whole.

A mergeable quantile sketch per group names splitters of the first column of the order. One counting pass gives the weight
of every bin: a bin is one splitter's value or the open interval between two. A position sought lies in one known bin. An
interval holds a small part of its group, since any value more frequent than that is a splitter; its rows are sorted, or
split again while they are many. In a bin of one value the next column of the order decides in the same way. So a hot
value is never sorted, and what reaches the driver is the bins' weights: groups must be few, such as years.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Splitters of a group are its quantiles at so many equal steps.
PIECES = 64
#: Rows of an interval that are sorted in one task; a larger one is split again.
SORTED_ROWS = 100_000

#: Positions sought in a group, from its key and its total weight; positions start at 1.
Positions = Callable[[tuple, int], Iterable[int]]


@dataclass(frozen=True)
class Located:
    """The row that covers a position: its key in the order, and the weight of all rows before it."""

    group: tuple
    position: int
    key: tuple
    before: int


@dataclass(frozen=True)
class _Bracket:
    """Rows of a group with given values in the first columns of the order and the next one between two values."""

    group: tuple
    equal: tuple = ()
    low: object = None
    high: object = None
    #: Whether the next column may have any value, NULL included.
    whole: bool = True


@dataclass(frozen=True)
class _Target:
    group: tuple
    position: int
    #: Weight of all rows before the bracket.
    before: int
    bracket: _Bracket


def _splitters(value: str) -> Column:
    """Distinct quantiles in ascending order; NULL where all values are."""
    return F.array_distinct(F.percentile_approx(value, [n / PIECES for n in range(1, PIECES)]))


def _with_bin(df: DataFrame, name: str, value: str, splitters: str, most: int = PIECES - 1) -> DataFrame:
    """Adds the bin of ``value``: odd for a splitter's value, even for the interval below the next one; -1 for NULL.

    The column ``splitters`` holds at most ``most`` values in ascending order. Each step of the binary search is a
    projection of its own, so that the generated code stays short.
    """
    v, below = F.col(value), F.col("_below")
    found = df.withColumn("_below", F.lit(0))
    for step in (1 << n for n in reversed(range(most.bit_length()))):
        smaller = F.get(splitters, below + (step - 1)) < v
        found = found.withColumn("_below", F.when(smaller, below + step).otherwise(below))
    equal = F.when(F.get(splitters, below) == v, 1).otherwise(0)
    return found.withColumn(name, F.when(v.isNull(), -1).otherwise(2 * below + equal)).drop("_below")


def _local(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A few rows as a relation of the plan, without a job of their own."""
    columns = [pa.array([r[n] for r in rows], f.type) for n, f in enumerate(to_arrow_schema(schema))]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=to_arrow_schema(schema)), schema)


@dataclass(frozen=True)
class Bins:
    """What one group has in each bin of some columns."""

    total: int
    splitters: dict[str, list]
    #: (bin, weight, rows) in the order of bins, by column.
    counts: dict[str, list[tuple[int, int, int]]]


def bins_of(
    df: DataFrame, group: Sequence[str], columns: Sequence[str], weight: str | None = None
) -> dict[tuple, Bins]:
    """Bins of several columns by group, from one pass for the sketches and one for the counts."""
    w = (F.col(weight) if weight else F.lit(1)).cast("long")
    sketch = [_splitters(c).alias(f"_s{n}") for n, c in enumerate(columns)]
    rows = df.groupBy(*group).agg(F.sum(w).alias("_total"), *sketch).collect()
    kinds = {f.name: f.dataType for f in df.schema.fields}
    schema = T.StructType(
        [T.StructField(f"_{g}", kinds[g]) for g in group]
        + [T.StructField(f"_s{n}", T.ArrayType(kinds[c])) for n, c in enumerate(columns)]
    )
    n_keys = len(group)
    listed = [(*r[:n_keys], *(r[f"_s{n}"] or [] for n in range(len(columns)))) for r in rows]
    table = _local(df.sparkSession, listed, schema)
    # One row per group.
    joined = df.join(F.broadcast(table), _same((df[g], table[f"_{g}"]) for g in group))
    for n, c in enumerate(columns):
        joined = _with_bin(joined, f"_b{n}", c, f"_s{n}")
    each = [F.struct(F.lit(n).alias("_column"), F.col(f"_b{n}").alias("_bin")) for n in range(len(columns))]
    binned = joined.select(*group, w.alias("_w"), F.inline(F.array(*each)))
    counted = binned.groupBy(*group, "_column", "_bin").agg(F.sum("_w").alias("w"), F.count("*").alias("n"))
    found = {key[:n_keys]: Bins(r["_total"], {}, {c: [] for c in columns}) for r, key in zip(rows, listed)}
    for key in listed:
        found[key[:n_keys]].splitters.update(zip(columns, key[n_keys:]))
    for r in counted.collect():
        bins = found[tuple(r[:n_keys])].counts[columns[r["_column"]]]
        bins.append((r["_bin"], r["w"], r["n"]))
    for bins in found.values():
        for counts in bins.counts.values():
            counts.sort()
    return found


def _same(pairs: Iterable[tuple[Column, Column]]) -> Column:
    result = F.lit(True)
    for a, b in pairs:
        result = result & a.eqNullSafe(b)
    return result


class _Order:
    """A table with its groups, order and weights; positions are sought in it by a few small jobs."""

    def __init__(self, df: DataFrame, group: Sequence[str], order: Sequence[str], weight: str | None) -> None:
        self.group, self.order = list(group), list(order)
        w = F.col(weight) if weight else F.lit(1)
        self.rows = df.select(*group, *order, w.cast("long").alias("_w"))
        self.spark = df.sparkSession

    def _in(self, brackets: list[_Bracket], level: int, splitters: list[list] | None = None) -> DataFrame:
        """Rows of brackets of one level, with the bracket's number ``_id`` and its ``_splitters``."""
        kinds = {f.name: f.dataType for f in self.rows.schema.fields}
        names = [*self.group, *self.order[:level]]
        schema = T.StructType(
            [
                T.StructField("_id", T.IntegerType()),
                *[T.StructField(f"_{n}", kinds[n]) for n in names],
                T.StructField("_low", kinds[self.order[level]]),
                T.StructField("_high", kinds[self.order[level]]),
                T.StructField("_whole", T.BooleanType()),
                T.StructField("_splitters", T.ArrayType(kinds[self.order[level]])),
            ]
        )
        listed = [
            (n, *b.group, *b.equal, b.low, b.high, b.whole, splitters[n] if splitters else None)
            for n, b in enumerate(brackets)
        ]
        table = _local(self.spark, listed, schema)
        value = F.col(self.order[level])
        above = F.col("_low").isNull() | (value > F.col("_low"))
        below = F.col("_high").isNull() | (value < F.col("_high"))
        inside = F.col("_whole") | (value.isNotNull() & above & below)
        same = _same((self.rows[n], table[f"_{n}"]) for n in names)
        # A few brackets per group.
        joined = self.rows.join(F.broadcast(table), same).where(inside)
        return joined.select("_id", "_splitters", *self.order, "_w")

    def _counted(self, brackets: list[_Bracket], level: int, splitters: list[list]) -> dict[int, list]:
        """(bin, weight, rows) of each bracket's bins in their order."""
        inside = self._in(brackets, level, splitters)
        found = _with_bin(inside, "bin", self.order[level], "_splitters").groupBy("_id", "bin")
        bins: dict[int, list] = {}
        for row in found.agg(F.sum("_w").alias("weight"), F.count(F.lit(1)).alias("n")).collect():
            bins.setdefault(row["_id"], []).append((row["bin"], row["weight"], row["n"]))
        return {n: sorted(found) for n, found in bins.items()}

    def _sketched(self, brackets: list[_Bracket], level: int) -> list[list]:
        found = self._in(brackets, level).groupBy("_id").agg(_splitters(self.order[level]).alias("s"))
        by_id = {row["_id"]: row["s"] or [] for row in found.collect()}
        return [by_id[n] for n in range(len(brackets))]

    def locate(self, sought: dict[tuple, list[int]], bins: dict[tuple, Bins]) -> list[Located]:
        found: list[Located] = []
        small: dict[int, list[_Target]] = {}
        # Whole groups have been sketched and counted.
        known = {_Bracket(g): b.splitters[self.order[0]] for g, b in bins.items()}
        counts = {_Bracket(g): b.counts[self.order[0]] for g, b in bins.items()}
        wanted = [_Target(g, p, 0, _Bracket(g)) for g, positions in sought.items() for p in positions]
        for level in range(len(self.order)):
            following: list[_Target] = []
            while wanted:
                new = [b for b in dict.fromkeys(t.bracket for t in wanted) if b not in counts]
                if new:
                    lists = self._sketched(new, level)
                    known |= dict(zip(new, lists))
                    counted = self._counted(new, level, lists)
                    counts |= {b: counted[n] for n, b in enumerate(new)}
                again: list[_Target] = []
                for target in wanted:
                    before = target.before
                    for bin_, weight, rows in counts[target.bracket]:
                        if target.position <= before + weight:
                            break
                        before += weight
                    inner = self._inside(target.bracket, bin_, known[target.bracket])
                    narrowed = _Target(target.group, target.position, before, inner)
                    if len(inner.equal) > level:
                        if level + 1 < len(self.order):
                            following.append(narrowed)
                        else:
                            found.append(Located(target.group, target.position, inner.equal, before))
                    elif rows <= SORTED_ROWS or inner == target.bracket:
                        small.setdefault(level, []).append(narrowed)
                    else:
                        again.append(narrowed)
                wanted = again
            wanted = following
        for level, targets in small.items():
            found += self._sorted(targets, level)
        return found

    @staticmethod
    def _inside( bracket: _Bracket, bin_: int, splitters: list) -> _Bracket:
        """The bracket that a bin is: one value of this column, or an interval."""
        if bin_ % 2:
            value = None if bin_ < 0 else splitters[bin_ // 2]
            return _Bracket(bracket.group, (*bracket.equal, value))
        at = bin_ // 2
        low = splitters[at - 1] if at else bracket.low
        high = splitters[at] if at < len(splitters) else bracket.high
        return _Bracket(bracket.group, bracket.equal, low, high, whole=False)

    def _sorted(self, targets: list[_Target], level: int) -> list[Located]:
        brackets = list(dict.fromkeys(t.bracket for t in targets))
        by_order = Window.partitionBy("_id").orderBy(*[F.col(c).asc_nulls_first() for c in self.order])
        upto = by_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        rows = self._in(brackets, level).withColumn("_upto", F.sum("_w").over(upto))
        numbered = [(n, brackets.index(t.bracket), t.position - t.before) for n, t in enumerate(targets)]
        schema = T.StructType([T.StructField(c, T.LongType()) for c in ("_target", "_of", "_position")])
        wanted = _local(self.spark, numbered, schema)
        covers = (F.col("_position") <= F.col("_upto")) & (F.col("_position") > F.col("_upto") - F.col("_w"))
        hits = rows.join(F.broadcast(wanted), (F.col("_id") == F.col("_of")) & covers)
        found = []
        for row in hits.select("_target", (F.col("_upto") - F.col("_w")).alias("_before"), *self.order).collect():
            target = targets[row["_target"]]
            found.append(Located(target.group, target.position, tuple(row[2:]), target.before + row["_before"]))
        return found


def between_positions(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    positions: Positions,
    weight: str | None = None,
    bins: dict[tuple, Bins] | None = None,
) -> DataFrame:
    """Add ``total`` (weight of the group) and ``before``, which places a row among the positions sought.

    ``order`` are numeric columns, ascending with NULL first, that tell rows of a group apart. ``before`` is the weight of
    all earlier rows for a row that covers a position or starts right after it; for any other row it is a position that the
    row lies beyond, with none sought between that and the row's end. ``df`` is read several times, so it should be a
    stored table. The result is a scan of it, joined with one broadcast row per group. ``bins`` may give the bins of the
    first column of the order, with the same weights.
    """
    if bins is None:
        bins = bins_of(df, group, order[:1], weight)
    wanted = {g: sorted({p for p in positions(g, b.total) if 0 < p < b.total}) for g, b in bins.items()}
    located = _Order(df, group, order, weight).locate(wanted, bins)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    key_type = T.StructType([T.StructField(c, kinds[c]) for c in order])
    bound = T.StructType(
        [T.StructField("end", T.LongType()), T.StructField("key", key_type), T.StructField("before", T.LongType())]
    )
    schema = T.StructType(
        [
            *[T.StructField(f"_{g}", kinds[g]) for g in group],
            T.StructField("total", T.LongType()),
            T.StructField("_bounds", T.ArrayType(bound)),
        ]
    )
    by_group: dict[tuple, list] = {}
    for hit in located:
        by_group.setdefault(hit.group, []).append((hit.position, hit.key, hit.before))
    # In the order of positions, which is that of keys.
    listed = [(*g, b.total, [_named(bound, hit) for hit in sorted(by_group.get(g, []), key=itemgetter(0))]) for g, b in bins.items()]
    table = _local(df.sparkSession, listed, schema)
    joined = df.join(F.broadcast(table), _same((df[g], table[f"_{g}"]) for g in group))
    keyed = joined.withColumn("_key", F.struct(*order)).withColumn("_ends", F.col("_bounds")["key"])
    binned = _with_bin(keyed, "_bin", "_key", "_ends", max((len(hits) for hits in by_group.values()), default=0))
    # The bound in the row itself, else the last one that it lies beyond.
    at = F.floor(F.col("_bin") / 2).cast("int")
    covering, passed = F.get("_bounds", at)["before"], F.get("_bounds", at - 1)["end"]
    before = F.coalesce(F.when(F.col("_bin") % 2 == 1, covering), passed, F.lit(0).cast("long"))
    return binned.withColumn("before", before).drop("_bounds", "_key", "_ends", "_bin", *[f"_{g}" for g in group])


def _named(kind: T.StructType, values: tuple) -> dict:
    return {f.name: _named(f.dataType, v) if isinstance(f.dataType, T.StructType) else v for f, v in zip(kind.fields, values)}


def with_rank(
    df: DataFrame, group: Sequence[str], value: str, name: str, bins: dict[tuple, Bins] | None = None
) -> DataFrame:
    """Add the RANK of ``value`` within its group, largest first and NULL last, as a bigint column ``name``.

    The rank of a splitter's value follows from the bins' counts alone, and its rows, however many, are dealt over many
    tasks. The others are ranked within their interval, which is a small part of its group. ``df`` should be a stored
    table. ``bins`` may give the bins of ``value``, one per row.
    """
    if bins is None:
        bins = bins_of(df, group, [value])
    kinds = {f.name: f.dataType for f in df.schema.fields}
    schema = T.StructType(
        [T.StructField(f"_{g}", kinds[g]) for g in group]
        + [
            T.StructField("_splitters", T.ArrayType(kinds[value])),
            T.StructField("_larger", T.ArrayType(T.LongType())),
        ]
    )
    listed = []
    for key, b in bins.items():
        # Rows above each bin from -1 on.
        larger = [0] * (2 * len(b.splitters[value]) + 2)
        for bin_, _, n in b.counts[value]:
            for lower in range(bin_ + 1):
                larger[lower] += n
        listed.append((*key, b.splitters[value], larger))
    table = _local(df.sparkSession, listed, schema)
    # One row per group.
    joined = df.join(F.broadcast(table), _same((df[g], table[f"_{g}"]) for g in group))
    binned = _with_bin(joined, "_bin", value, "_splitters")
    one_value = F.col("_bin") % 2 != 0
    dealt = F.when(one_value, F.pmod(F.xxhash64(*df.columns), F.lit(PIECES)))
    inside = Window.partitionBy(*group, "_bin", "_dealt").orderBy(F.col(value).desc())
    above = F.get("_larger", F.col("_bin") + 1)
    placed = binned.select(*df.columns, "_bin", dealt.alias("_dealt"), above.alias("_above"))
    rank = F.when(F.col("_dealt").isNotNull(), F.lit(1)).otherwise(F.rank().over(inside))
    return placed.withColumn(name, F.col("_above") + rank).drop("_bin", "_dealt", "_above")
