import math
import random

import pytest
from pyspark.sql import functions as F

from derrickflow.functions.times import HOUR, SLOT
from derrickflow.operators import late_events as L
from derrickflow.operators.regular_grid import regular

M = 60_000_000


def readings(spark, rows):
    return spark.createDataFrame([(bytes([i]), e, ts, a, v) for i, e, ts, a, v in rows], "id binary, esp_id string, ts long, arrived long, flow_rate double")


def test_bounds_of_corrections(spark):
    h = HOUR
    rows = [
        (1, "A", 10, h + 5 * M, 1.0),  # at the grace: still first
        (2, "A", 10, h + 5 * M + 1, 2.0),  # a correction
        (3, "A", 10, 7 * h, 3.0),  # at the cut-off: a correction
        (4, "A", 10, 7 * h + 1, 4.0),  # after it: nothing
        (1, "A", 10, 9 * h, 1.0),  # a copy
        (5, "B", 10, None, 1.0),
        (6, "C", h - 1, h, float("nan")),
        (7, "D", 10, 8 * h, 1.0),  # only after the cut-off
    ]
    e = L.arrivals(readings(spark, rows))
    got = {r.esp_id: (r.n_first, r.n, r.corrections, r.total) for r in L.hourly(e).collect()}
    assert got == {"A": (1, 3, 2, 6.0), "C": (1, 1, 0, None)}
    assert {(r.esp_id, r.n_dropped) for r in L.dropped(e).collect()} == {("A", 1), ("D", 1)}


def test_merge_is_idempotent_and_order_free(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice("AB"), rng.randrange(2 * HOUR), rng.randrange(8 * HOUR), float(i)) for i in range(120)]
    every = L.counters(L.arrivals(readings(spark, rows)))
    read = lambda s: sorted(map(tuple, L.read(s).collect()))
    some = every.where("version < 9")
    once = read(L.merge(every))
    assert once == read(L.merge(every, some, every)) == read(L.merge(L.merge(some), L.merge(every))) == read(L.merge(some.orderBy(F.rand(1)), every))


def test_no_readings(spark):
    e = readings(spark, [])
    assert L.hourly(L.arrivals(e)).count() == 0 and regular(e).count() == 0


def grid(spark, rows, **how):
    df = spark.createDataFrame(rows, "esp_id string, ts long, flow_rate double, slot string")
    return {(r.esp_id, r.slot // SLOT): r for r in regular(df, **how).collect()}


def test_rate_is_spread_by_overlap(spark):
    s = SLOT
    g = grid(spark, [("A", s // 2, 10.0, ""), ("A", 3 * s + s // 2, 20.0, ""), ("A", 3 * s + s // 2, 20.0, ""), ("A", 0, None, ""), ("A", 5, float("nan"), ""), (None, 5, 1.0, "")])
    assert [g["A", k].status for k in range(4)] == ["reading", "filled", "filled", "reading"]
    assert [g["A", k].covered for k in range(4)] == [150.0, 300.0, 300.0, 150.0]
    assert math.isclose(sum(r.increment for r in g.values()), 15.0 * 900) and g["A", 3].n == 2 and math.isclose(g["A", 1].rate, 15.0)


def test_counter_resets(spark):
    s = SLOT
    g = grid(spark, [("A", 0, 100.0, ""), ("A", s, 160.0, ""), ("A", s + s // 2, 30.0, ""), ("A", 2 * s, 40.0, "")], kind="counter")
    assert [g["A", k].increment for k in range(3)] == [60.0, 40.0, 0.0] and g["A", 2].rate is None


def test_gaps_of_a_day_are_marked(spark):
    day = 288
    g = grid(spark, [("A", 0, 1.0, ""), ("A", day * SLOT, 1.0, ""), ("B", 0, 1.0, ""), ("B", day * SLOT - 1, 1.0, "")])
    assert g["A", 5].status == "uncovered" and g["A", 5].covered == 0 and g["B", 5].status == "filled"
    assert g["A", 0].rate == 1.0


def test_unknown_kind(spark):
    with pytest.raises(ValueError):
        grid(spark, [("A", 0, 1.0, "")], kind="other")


def test_publications_come_from_the_merge(spark):
    """Deliveries of counters in any order and number give the same hours; without the versions' maximum they don't."""
    rng = random.Random(5)
    rows = [(i, rng.choice("AB"), rng.randrange(2 * HOUR), HOUR + rng.randrange(6 * HOUR), float(i % 7)) for i in range(200)]
    e = L.arrivals(readings(spark, rows))
    every = L.counters(e)
    take = lambda df: sorted(map(tuple, df.collect()))
    want = take(L.hourly(e))
    again = every.unionByName(every.where("version % 2 = 0")).orderBy(F.rand(2)).unionByName(every.orderBy(F.rand(3)))
    assert take(L.published(again)) == want
    # deliveries that got lost on the way count from the next one that arrives; the last of each source must come
    assert take(L.published(every.where("version = 0"))) != want


def test_found_slots_need_the_increments(spark):
    """The plan of the filled slots keeps the differences of readings: the status is that of the spread increments."""
    df = spark.createDataFrame([("A", 0, 1.0), ("A", 5 * SLOT, 3.0)], "esp_id string, ts long, flow_rate double")
    plan = regular(df).where("status = 'filled'").select("esp_id", "slot")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lag(") >= 3 and "v_b0" in plan and "per_us" in plan


def test_a_silence_of_decades_has_no_long_array(spark):
    df = spark.createDataFrame([("A", 0, 1.0), ("A", 80 * 365 * 288 * SLOT + 7, 3.0)], "esp_id string, ts long, flow_rate double")
    g = regular(df)
    assert g.count() == 80 * 365 * 288 + 1 and g.where("status <> 'uncovered'").count() == 2
