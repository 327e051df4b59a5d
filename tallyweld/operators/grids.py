"""All pairs beneath an equal key, with functions of two strings that are computed once for each two distinct strings.

Pairs grow with the square of the rows; distinct strings often don't. Where all combinations of a
column's distinct strings are few beside the pairs, they are computed as a table, a row for each string
of one side, which is sent to the tasks, and a pair reads its cell by two numbers. Elsewhere each pair
is compared as it comes. Either way pairs are made by one join and none is kept: rows of one side meet
bundles of the other's, so a row's cells are sought once for a bundle, and pairs come from running through it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..sources.tables import materialize

#: A table has at most so many cells, and a side of it at most so many strings; more are compared pair by pair.
MOST_CELLS, MOST_STRINGS = 1 << 24, 50_000
#: Rows of a key that travel together, and pairs of a task: tasks are dealt by what they make, not by what they read.
BUNDLE, PAIRS_A_TASK = 1024, 8_000_000
#: A table pays where there are so many pairs for each cell.
PAIRS_A_CELL = 4


@dataclass(frozen=True)
class Compared:
    """make(a, b) of a column of either side. Scaled values have six decimals, so a table holds them as whole millionths."""

    a: str
    b: str
    make: Callable[[Column, Column], Column]
    scaled: bool = False

    def cell(self, a: Column, b: Column) -> Column:
        return F.round(self.make(a, b) * 1_000_000).cast("int") if self.scaled else self.make(a, b)

    def read(self, cell: Column) -> Column:
        return cell / F.lit(1_000_000.0) if self.scaled else cell


def pair_count(asked: DataFrame, there: DataFrame, on: str) -> int:
    own, other = asked.groupBy(on).agg(F.count("*").alias("x")), there.groupBy(on).agg(F.count("*").alias("y"))
    return int(own.join(other, on).agg(F.coalesce(F.sum((F.col("x") * F.col("y")).cast("decimal(38,0)")), F.lit(0))).first()[0])


def _numbered(strings: DataFrame, text: str, number: str) -> DataFrame:
    """At most MOST_STRINGS strings, from 0 on."""
    return strings.select((F.row_number().over(W.orderBy(text)) - 1).cast("long").alias(number), text)


def _table(own: DataFrame, known: DataFrame, of: Compared, i: str, j: str, cells: str) -> DataFrame:
    """A row for each of own's numbers: its cells in the order of known's numbers."""
    tasks = own.sparkSession.sparkContext.defaultParallelism
    both = own.repartition(4 * tasks).crossJoin(F.broadcast(known))
    made = both.select(i, F.col(j).alias("at"), of.cell(F.col(of.a), F.col(of.b)).alias("cell"))
    rows = made.groupBy(i).agg(F.sort_array(F.collect_list(F.struct("at", "cell"))).alias("all"))
    return materialize(rows.select(i, F.col("all.cell").alias(cells)), "cells")


def _bundles(there: DataFrame, on: str) -> DataFrame:
    """(on, bundle): the rows of a key as arrays of about BUNDLE rows at most."""
    crowds = materialize(there.groupBy(on).agg(F.count("*").alias("__n")).filter(F.col("__n") > BUNDLE), "crowds")
    many = F.coalesce(F.ceil(F.col("__n") / BUNDLE), F.lit(1))
    dealt = there.withColumn("__row", F.xxhash64(F.monotonically_increasing_id())).join(crowds, on, "left").withColumn("__part", F.pmod("__row", many))
    one = F.struct(*(c for c in there.columns if c != on))
    return dealt.groupBy(on, "__part").agg(F.collect_list(one).alias("__bundle")).drop("__part")


def meet(asked: DataFrame, there: DataFrame, on: str, made: dict[str, Compared], where: bool = False) -> DataFrame:
    """asked and there joined on a column, with the columns of `made` (or filtered by them) and without what these compare."""
    asked, there = materialize(asked, "asked"), materialize(there, "there")
    kept = [c for x in (asked, there) for c in x.columns if c != on and c not in {n for of in made.values() for n in (of.a, of.b)}]
    pairs = pair_count(asked, there, on)
    tables: dict[str, DataFrame] = {}
    numbers = lambda name: (f"__{name}_i", f"__{name}_j", f"__{name}_cells")
    left, right = asked, there
    for name, of in made.items():
        own, known = (materialize(df.select(c).distinct(), "strings") for df, c in ((asked, of.a), (there, of.b)))
        n, k = own.count(), known.count()
        if not 0 < n * k <= MOST_CELLS or max(n, k) > MOST_STRINGS or PAIRS_A_CELL * n * k > pairs:
            continue
        i, j, cells = numbers(name)
        own, known = _numbered(own, of.a, i), _numbered(known, of.b, j)
        tables[name] = _table(own, known, of, i, j, cells)
        same = lambda df, strings, c: df.join(F.broadcast(strings.withColumnRenamed(c, "__same")), F.col(c).eqNullSafe(F.col("__same"))).drop("__same")
        left, right = same(left, own, of.a), same(right, known.withColumn(j, F.col(j).cast("int")), of.b)
    compared = {c for name, of in made.items() if name not in tables for c in (of.a, of.b)}
    without = lambda df: df.select(*(c for c in df.columns if c in (on, *kept, *compared) or c.startswith("__")))
    tasks = max(int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-pairs // PAIRS_A_TASK))
    both = without(left).repartition(tasks, on).join(_bundles(without(right), on).repartition(tasks, on), on)
    for name, table in tables.items():
        both = both.join(F.broadcast(table), numbers(name)[0])
    both = both.select(*(c for c in both.columns if c not in (on, "__bundle")), F.inline("__bundle"))
    values = {name: of.read(F.get(numbers(name)[2], F.col(numbers(name)[1]))) if name in tables else of.make(F.col(of.a), F.col(of.b)) for name, of in made.items()}
    if not where:
        return both.withColumns(values).select(*kept, *made)
    for name in sorted(values, key=lambda name: name not in tables):  # what is only looked up goes first
        both = both.filter(values[name])
    return both.select(*kept)
