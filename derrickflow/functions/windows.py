"""Ordered computations within a key of any size, none of which puts a whole key into one task.

A key's rows are cut into blocks of its order (by time). What blocks before a row contribute comes
from one small row per block; only the rest needs the order within the block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from derrickflow.functions.times import HOUR, floor_to


def numbered(df: DataFrame, key: list[str], at: str, ties: list[str], width: int = HOUR, name: str = "rn") -> DataFrame:
    """df with the row number (from 1) within the key in order of `at` (microseconds, not null) and ties."""
    d = df.withColumn("_block", floor_to(F.col(at), width))
    before = Window.partitionBy(*key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    counts = d.groupBy(*key, "_block").agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = Window.partitionBy(*key, "_block").orderBy(at, *ties)
    d = d.withColumn("_in", F.row_number().over(inside))
    return d.join(counts, [*key, "_block"]).withColumn(name, (F.col("_before") + F.col("_in")).cast("long")).drop("_block", "_in", "_before")


def rolling(df: DataFrame, key: list[str], rn: str, before: int, made: dict[str, Column], chunk: int = 4096) -> DataFrame:
    """df with columns over the rows rn - before .. rn of the key. made: name to an aggregate of columns of df (without a window).

    Rows are cut into chunks of `chunk` row numbers; the last `before` rows of each are repeated in the next one.
    """
    own = F.floor((F.col(rn) - 1) / chunk)
    far = F.floor((F.col(rn) - 1 + before) / chunk)
    d = df.withColumn("_own", own).withColumn("_chunk", F.explode(F.sequence(own, far)))
    w = Window.partitionBy(*key, "_chunk").orderBy(rn).rowsBetween(-before, 0)
    return d.withColumns({n: c.over(w) for n, c in made.items()}).where("_chunk = _own").drop("_own", "_chunk")


def running_max(df: DataFrame, key: list[str], at: str, ties: list[str], value: str, name: str, width: int = HOUR) -> DataFrame:
    """df with the greatest `value` of the rows before this one in order of `at` and ties (null for the first)."""
    d = df.withColumn("_block", floor_to(F.col(at), width))
    before = Window.partitionBy(*key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    tops = d.groupBy(*key, "_block").agg(F.max(value).alias("_top")).withColumn("_before", F.max("_top").over(before)).drop("_top")
    inside = Window.partitionBy(*key, "_block").orderBy(at, *ties).rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("_in", F.max(value).over(inside))
    return d.join(tops, [*key, "_block"]).withColumn(name, F.greatest("_before", "_in")).drop("_block", "_in", "_before")


def previous(df: DataFrame, key: list[str], at: str, ties: list[str], columns: list[str], width: int = HOUR) -> DataFrame:
    """df with `prev_<column>` of the row before in order of `at` and ties (null for a key's first row)."""
    d = df.withColumn("_block", floor_to(F.col(at), width))
    last = F.max(F.struct(at, *ties, *[c for c in columns if c not in (at, *ties)])).alias("_last")
    order = Window.partitionBy(*key).orderBy("_block")
    ends = d.groupBy(*key, "_block").agg(last).withColumn("_prior", F.lag("_last").over(order)).drop("_last")
    inside = Window.partitionBy(*key, "_block").orderBy(at, *ties)
    d = d.withColumn("_here", F.lag(F.struct(*columns)).over(inside))
    j = d.join(ends, [*key, "_block"])
    made = {f"prev_{c}": F.when(F.col("_here").isNotNull(), F.col(f"_here.{c}")).otherwise(F.col(f"_prior.{c}")) for c in columns}
    return j.withColumns(made).drop("_block", "_here", "_prior")
