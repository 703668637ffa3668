"""Irregular readings onto a regular grid.

A rate is the slope of a cumulative counter, so both kinds go one way: readings that follow each other
give an increment (a counter's difference, from zero after a reset; a rate's trapezoid), which is
spread over the grid's cells in proportion to overlap. A cell's rate is its increments over the time
they cover. A cell without readings is filled if an increment was spread to it, else marked as uncovered:
that is so between readings further apart than max_gap.

Readings are first reduced per cell; only cells, at most span / width per source whatever the number
of readings, are put in order within a source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from derrickflow.functions.times import DAY, SLOT, floor_to

#: Cells of a stretch, one day of five-minute cells.
CELLS = 288


def increments(kind: str, before: F.Column, after: F.Column, seconds: F.Column) -> F.Column:
    """What went by between two readings (null without one before). A counter that falls has been reset to zero in between."""
    if kind == "counter":
        return F.when(after < before, after).otherwise(after - before)
    if kind == "rate":
        return (before + after) / 2 * seconds
    raise ValueError(f"kind is 'rate' or 'counter', not {kind!r}")


def regular(readings: DataFrame, source: str = "esp_id", value: str = "flow_rate", kind: str = "rate", width: int = SLOT, max_gap: int = DAY) -> DataFrame:
    """A row per source and cell from its first reading to its last.

    readings has source, ts (microseconds, UTC) and value. Rows where one of these is null or value is NaN are
    ignored. Readings of one instant count as their mean. Columns: source, slot (start, microseconds),
    status (reading: has readings; filled: covered by readings less than max_gap apart; uncovered),
    n, increment, covered (seconds), rate (increment per second; for kind rate the mean value).
    A cell with one reading and nothing before or after has its value as rate (null for a counter).
    Other columns are ignored. No readings give no rows.
    """
    cell = floor_to(F.col("ts"), width)
    one = (
        readings.where(F.col(source).isNotNull() & F.col("ts").isNotNull() & F.col(value).isNotNull() & ~F.isnan(value))
        .groupBy(F.col(source).alias("src"), cell.alias("slot"), "ts")
        .agg(F.avg(value).alias("v"), F.count("*").alias("n"))
    )
    inside = Window.partitionBy("src", "slot").orderBy("ts")
    step = one.withColumns({"ts0": F.lag("ts").over(inside), "v0": F.lag("v").over(inside)})
    secs = (F.col("ts") - F.col("ts0")) / 1e6
    cells = step.groupBy("src", "slot").agg(
        F.sum("n").alias("n"),
        F.avg("v").alias("mean"),
        F.coalesce(F.sum(increments(kind, F.col("v0"), F.col("v"), secs)), F.lit(0.0)).alias("own"),
        F.min("ts").alias("ts_a"),
        F.max("ts").alias("ts_b"),
        F.min_by("v", "ts").alias("v_a"),
        F.max_by("v", "ts").alias("v_b"),
    )
    order = Window.partitionBy("src").orderBy("slot")
    linked = cells.withColumns({c + "0": F.lag(c).over(order) for c in ("slot", "ts_b", "v_b")})
    gap = F.col("ts_a") - F.col("ts_b0")
    linked = linked.withColumns(
        {
            "near": gap < max_gap,
            "per_us": F.when(gap < max_gap, increments(kind, F.col("v_b0"), F.col("v_a"), gap / 1e6) / gap),
            "from": F.coalesce("slot0", "slot"),
        }
    )
    # a silence is cut into stretches of CELLS cells: no array is longer, however far apart two readings are
    stretch = CELLS * width
    part = linked.withColumn("stretch", F.explode(F.sequence(floor_to(F.col("from"), stretch), floor_to(F.col("slot"), stretch), F.lit(stretch))))
    part = part.withColumn("cell", F.explode(F.sequence(F.greatest("from", "stretch"), F.least(F.col("slot"), F.col("stretch") + (stretch - width)), F.lit(width))))
    overlap = F.least(F.col("ts_a"), F.col("cell") + width) - F.greatest(F.col("ts_b0"), F.col("cell"))
    overlap = F.when(F.col("near"), F.greatest(F.lit(0), overlap)).otherwise(0)
    home = F.col("cell") == F.col("slot")
    spread = part.select(
        "src",
        F.col("cell").alias("slot"),
        F.when(home, F.col("n")).otherwise(0).alias("n"),
        F.when(home, F.col("mean")).alias("mean"),
        # null where nothing is spread to a cell: that is what tells covered cells from uncovered ones
        F.when(home, F.col("own") + F.coalesce(F.col("per_us") * overlap, F.lit(0.0))).otherwise(F.col("per_us") * overlap).alias("inc"),
        (F.when(home, F.col("ts_b") - F.col("ts_a")).otherwise(0) + overlap).alias("us"),
    )
    out = spread.groupBy("src", "slot").agg(
        F.sum("n").alias("n"), F.max("mean").alias("mean"), F.sum("inc").alias("increment"), (F.sum("us") / 1e6).alias("covered")
    )
    alone = F.col("mean") if kind == "rate" else F.lit(None).cast("double")
    return out.select(
        F.col("src").alias(source),
        "slot",
        F.when(F.col("n") > 0, "reading").when(F.col("increment").isNotNull(), "filled").otherwise("uncovered").alias("status"),
        "n",
        F.coalesce("increment", F.lit(0.0)).alias("increment"),
        "covered",
        F.when(F.col("covered") > 0, F.col("increment") / F.col("covered")).otherwise(alone).alias("rate"),
    )
