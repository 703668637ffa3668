"""Late and out-of-order events: hourly aggregates from conflict-free versioned counters.

A period's aggregate is the sum over sources of that source's counter. A source here is a shard of
the event identities: all copies of one event belong to one shard, so a shard counts each event once,
and a pump that holds most rows is spread over all shards. A shard's counter for a period carries a
version, the number of the arrival interval up to which it has counted: 0 up to the period's end
plus `grace`, then one version per `grace` until the cut-off. Counters are cumulative. Merging keeps,
per period and source, the counter of the greatest version; that is commutative, associative and
idempotent, so retried and reordered deliveries of counters change nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from derrickflow.functions.times import HOUR, floor_to

SHARDS = 16
GRACE = 300_000_000
CUT_OFF = 6 * HOUR
KEY = ("esp_id", "period")


def arrivals(readings: DataFrame, value: str = "flow_rate") -> DataFrame:
    """One row per event: its pump, period, first arrival and the value it then had.

    Rows with a null `arrived` are ignored. Copies that arrive at the same time count with the lesser
    value. An id that is reported for two pumps or hours counts once in each. A NaN value is a null.
    """
    period = floor_to(F.col("ts"), HOUR)
    v = F.when(~F.isnan(value), F.col(value))
    first = F.min(F.struct("arrived", v.alias("v"))).alias("first")
    return (
        readings.where("arrived is not null")
        .groupBy("id", "esp_id", period.alias("period"))
        .agg(first)
        .select("id", *KEY, F.col("first.arrived").alias("arrived"), F.col("first.v").alias("v"))
    )


def counters(events: DataFrame, shards: int = SHARDS, grace: int = GRACE, cut_off: int = CUT_OFF) -> DataFrame:
    """Every version of every counter: esp_id, period, shard, version, n, n_values, total, low, high.

    Events that arrive later than cut_off after the end of their period get no version: they are
    counted by dropped() and move nothing. Empty input gives no counters.
    """
    late = F.col("arrived") - (F.col("period") + HOUR)
    steps = events.where(late <= cut_off).select(
        *KEY,
        F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"),
        F.when(late <= grace, 0).otherwise(F.ceil((late - grace) / grace)).cast("int").alias("version"),
        "v",
    )
    delta = steps.groupBy(*KEY, "shard", "version").agg(
        F.count("*").alias("n"), F.count("v").alias("n_values"), F.sum("v").alias("total"), F.min("v").alias("low"), F.max("v").alias("high")
    )
    so_far = Window.partitionBy(*KEY, "shard").orderBy("version").rowsBetween(Window.unboundedPreceding, 0)
    how = {"n": F.sum, "n_values": F.sum, "total": F.sum, "low": F.min, "high": F.max}
    return delta.select(*KEY, "shard", "version", *(f(c).over(so_far).alias(c) for c, f in how.items()))


def merge(*states: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """The merged state: per period and source the counter of the greatest version, from any number of states.

    by: further columns that tell states apart which are held in one table.
    """
    both = states[0]
    for other in states[1:]:
        both = both.unionByName(other)
    key = [*by, *KEY, "shard"]
    rest = [c for c in both.columns if c not in (*key, "version")]
    top = both.groupBy(*key).agg(F.max(F.struct("version", *rest)).alias("top"))
    return top.select(*key, "top.*")


def read(state: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Aggregates per pump and period: the sum over the sources of a merged state."""
    return state.groupBy(*by, *KEY).agg(
        F.sum("n").alias("n"), F.sum("n_values").alias("n_values"), F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high"), F.max("version").alias("version")
    )


def published(deliveries: DataFrame) -> DataFrame:
    """Per pump and hour the first publication (at grace) beside the final one (at the cut-off), from delivered counters.

    deliveries: counters (see counters()) in any order, each any number of times. The first publication is the merge of
    the counters of version 0, the final one that of all. Columns: esp_id, period, n_first, n, total, mean_first, mean, low,
    high, corrections (events that moved it).
    """
    # both states are held in one table, so that one pass over the deliveries merges both
    sent = deliveries.withColumn("final", F.explode(F.when(F.col("version") == 0, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(True)))))
    both = read(merge(sent, by=("final",)), by=("final",))
    pick = lambda c, final: F.max(F.when(F.col("final") == final, F.col(c)))
    out = both.groupBy(*KEY).agg(
        F.coalesce(pick("n", False), F.lit(0)).alias("n_first"),
        pick("n", True).alias("n"),
        pick("total", True).alias("total"),
        F.try_divide(pick("total", False), pick("n_values", False)).alias("mean_first"),
        F.try_divide(pick("total", True), pick("n_values", True)).alias("mean"),
        pick("low", True).alias("low"),
        pick("high", True).alias("high"),
    )
    return out.withColumn("corrections", F.col("n") - F.col("n_first"))


def hourly(events: DataFrame, **how) -> DataFrame:
    """The publications (see published()) of a table of events."""
    return published(counters(events, **how))


def dropped(events: DataFrame, cut_off: int = CUT_OFF) -> DataFrame:
    """Per pump and hour the events that came after the cut-off."""
    return events.where(F.col("arrived") - F.col("period") - HOUR > cut_off).groupBy(*KEY).agg(F.count("*").alias("n_dropped"))
