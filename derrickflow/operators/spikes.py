"""Implausible measurements, judged against each source's own behaviour.

1. Readings are written once, in order, in files that hold whole source days, by range partitioning
   on (source, day): a source with most of the rows is spread over its days.
2. A pass over the files gives per source day and field the ordinary scatter, the daily profile (288
   five-minute medians) and, per file, the first and last readings, which the files beside it need.
3. The profiles of a source and field form a matrix of days by slots, in blocks of `days` calendar
   days. Robust principal components (principal component pursuit) split it into the low-rank normal
   course and the sparse rest; what of the rest lasts over many slots is a change of operation and goes back to the course.
4. A reading is sparse if it is off its slot's normal course by more than `first` times the scatter. Spikes are
   stretches of at most `longest` successive sparse readings off the level of the normal readings around them; an
   exact check follows: more than `times` the scatter off the median of all neighbours too.
   Constant runs and impossible values are tested separately.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from derrickflow.functions.times import DAY, SLOT
from derrickflow.session import materialise, scratch
from derrickflow.sources.files import resolve

#: Possible values per field: below the first or above the second no such sensor can read.
POSSIBLE = {"motor_temperature": (-40.0, 400.0), "vibration": (0.0, np.inf), "flow_rate": (0.0, np.inf), "motor_current": (0.0, np.inf)}
SLOTS = DAY // SLOT
OUT = "id binary, field string, kind string, value double, level double, scatter double"
EDGE = "array<struct<ts: long, x: double>>"
MEASURED = f"unit int, esp_id string, field string, day long, n long, scatter double, step double, profile binary, head {EDGE}, tail {EDGE}"
COURSE = "esp_id string, field string, day long, course binary"


@dataclass(frozen=True)
class Limits:
    """times: of the scatter; longest: readings of a spike; run: readings of a constant run; window: readings of a level; first: times of the scatter that make a reading sparse; days: of a matrix of profiles."""

    times: float = 10.0
    longest: int = 3
    run: int = 12
    window: int = 15
    first: float = 4.0
    days: int = 28
    possible: dict = field(default_factory=lambda: dict(POSSIBLE))

    @property
    def context(self) -> int:
        """Readings of a field that a file needs of those beside it; several times what a level or run takes, as impossible ones don't count."""
        return 4 * max(self.run, self.window + 2 * self.longest + 2)


def low_rank(m: np.ndarray, rounds: int = 60, close: float = 1e-5) -> tuple[np.ndarray, np.ndarray]:
    """Principal component pursuit of each matrix of a stack (n, rows, columns): low-rank part and sparse part.

    Minimises nuclear norm + 1/sqrt(rows) * absolute sum by the inexact augmented Lagrangian method.
    """
    if m.shape[1] > m.shape[2]:
        low, s = low_rank(m.transpose(0, 2, 1), rounds, close)
        return low.transpose(0, 2, 1), s.transpose(0, 2, 1)
    lam = 1 / np.sqrt(m.shape[2])
    norm = np.linalg.norm(m, 2, axis=(1, 2)) + 1e-12
    y = m / np.maximum(norm, np.abs(m).max((1, 2)) / lam + 1e-12)[:, None, None]
    s, mu = np.zeros_like(m), (1.25 / norm)[:, None, None]
    size = np.linalg.norm(m, axis=(1, 2)) + 1e-12
    low = m
    for _ in range(rounds):
        a = m - s + y / mu
        # singular values by way of the small product of the matrix with itself: there are far fewer days than slots
        d2, u = np.linalg.eigh(a @ a.transpose(0, 2, 1))
        d = np.sqrt(np.maximum(d2, 0))
        kept = np.maximum(d - 1 / mu[:, :, 0], 0) / np.maximum(d, 1e-300)
        low = ((u * kept[:, None, :]) @ u.transpose(0, 2, 1)) @ a
        rest = m - low + y / mu
        s = np.sign(rest) * np.maximum(np.abs(rest) - lam / mu, 0)
        gap = m - low - s
        y = y + mu * gap
        mu = mu * 1.5
        if (np.linalg.norm(gap, axis=(1, 2)) < close * size).all():
            break
    return low, s


def run_lengths(x: np.ndarray) -> np.ndarray:
    """For each value the number of successive equal values that it stands in."""
    if not len(x):
        return np.empty(0, np.int64)
    n = np.diff(np.r_[np.flatnonzero(np.r_[True, x[1:] != x[:-1]]), len(x)])
    return np.repeat(n, n)


def level(x: np.ndarray, skip: np.ndarray, window: int) -> np.ndarray:
    """Running median of the readings around, without those to skip; NaN where there are fewer than three."""
    return pd.Series(np.where(skip, np.nan, x)).rolling(window, center=True, min_periods=3).median().to_numpy()


def _groups(key: np.ndarray) -> list[tuple[int, int]]:
    """Start and end of each stretch of equal keys."""
    if not len(key):
        return []
    at = np.r_[np.flatnonzero(np.r_[True, key[1:] != key[:-1]]), len(key)]
    return list(zip(at[:-1].tolist(), at[1:].tolist()))


def _load(table: pa.Table) -> dict[str, np.ndarray]:
    out = {}
    for c in table.column_names:
        x = table.column(c).combine_chunks()
        x = x.chunk(0) if isinstance(x, pa.ChunkedArray) and x.num_chunks else x
        if pa.types.is_floating(x.type):
            out[c] = np.asarray(x.fill_null(np.nan).to_numpy(zero_copy_only=False), float)
        else:
            out[c] = np.asarray(x.to_pylist(), object) if not pa.types.is_integer(x.type) else x.to_numpy(zero_copy_only=False)
    return out


def _scatter(x: np.ndarray, limits: Limits, bounds: tuple[float, float]) -> tuple[int, float, float]:
    """Readings counted, their scatter about the running median (the 90 % quantile of deviations, as a standard deviation), the smallest step between values."""
    x = x[~np.isnan(x)]
    skip = (x < bounds[0]) | (x > bounds[1]) | np.isinf(x) | (run_lengths(x) >= limits.run)
    off = np.abs(x - level(x, skip, limits.window))[~skip]
    off = off[~np.isnan(off)]
    if not len(off):
        return 0, np.nan, np.nan
    values = np.unique(x[~skip])
    return len(off), float(np.quantile(off, 0.9) / 1.645), float(np.diff(values).min()) if len(values) > 1 else 0.0


def profile(slot: np.ndarray, x: np.ndarray) -> np.ndarray | None:
    """Medians of a day's readings per slot; slots without readings have the smoothed value of the neighbours. None without readings."""
    if not len(x):
        return None
    order = np.lexsort((x, slot))
    cells = _groups(slot[order])
    known = np.array([slot[order[i]] for i, _ in cells])
    value = np.array([(x[order[(i + j - 1) // 2]] + x[order[(i + j) // 2]]) / 2 for i, j in cells])
    smooth = pd.Series(value).rolling(5, center=True, min_periods=1).median().to_numpy()
    full = np.interp(np.arange(SLOTS), known, smooth)
    full[known] = value
    return full


def normal_courses(profiles: np.ndarray, longest: int) -> np.ndarray:
    """The normal course of each day (row): the low-rank part of the profiles and what of the sparse part lasts.

    A spike is at most `longest` successive readings and touches as many slots; what most of the 2 * longest + 3 slots around have in
    common is no spike.
    """
    middle = np.median(profiles)
    low, sparse = low_rank((profiles - middle)[None])
    lasting = pd.DataFrame(sparse[0].T).rolling(2 * longest + 3, center=True, min_periods=1).median().to_numpy().T
    return low[0] + lasting + middle


def _flag(ids, ts, x, own, sigma: float, courses: dict[int, np.ndarray], limits: Limits, name: str) -> list[dict]:
    """Flags of one source and field in order of time, of readings without null and NaN; own: which readings are the unit's, not context."""
    bounds = limits.possible[name]
    impossible = (x < bounds[0]) | (x > bounds[1]) | np.isinf(x)
    stuck = run_lengths(x) >= limits.run
    out = [("range", i, np.nan) for i in np.flatnonzero(impossible & own)] + [("stuck", i, x[i]) for i in np.flatnonzero(stuck & own)]
    keep = np.flatnonzero(~impossible)
    y, still = x[keep], stuck[keep]
    day, slot = ts[keep] // DAY, ts[keep] % DAY // SLOT
    course = np.full(len(y), np.nan)
    for a, b in _groups(day):
        if day[a] in courses:
            course[a:b] = courses[day[a]][slot[a:b]]
    sparse = np.abs(y - course) > limits.first * sigma
    base = level(y, still | sparse, limits.window)
    far = sparse & ~still & (np.abs(y - base) > limits.times * sigma)
    # the exact check
    far &= np.abs(y - level(y, still, limits.window)) > limits.times * sigma
    spans = [s for s in _groups(far) if far[s[0]] and s[1] - s[0] <= limits.longest]
    out += [("spike", keep[i], base[i]) for a, b in spans for i in range(a, b) if own[keep[i]]]
    return [{"id": ids[i], "field": name, "kind": kind, "value": float(x[i]), "level": float(lv), "scatter": sigma} for kind, i, lv in out]


def _ends(ts: np.ndarray, x: np.ndarray) -> list[dict]:
    return [{"ts": t, "x": v} for t, v in zip(ts.tolist(), x.tolist())]


def implausible(readings: DataFrame, fields: tuple[str, ...] = tuple(POSSIBLE), limits: Limits = Limits(), partitions: int | None = None) -> DataFrame:
    """Flags: id, field, kind (range, stuck, spike), value, level around, scatter; a row per reading, field and kind.

    readings: esp_id, ts (microseconds), id and fields, one row per reading; other columns are ignored. Null and NaN are
    skipped per field; infinite values are impossible. Readings of one instant are in order of id. A
    source with too few readings for a level gets no spikes. No readings give no flags.
    """
    spark, fields = readings.sparkSession, list(fields)
    n = partitions or 2 * spark.sparkContext.defaultParallelism
    folder = scratch(spark, "readings")
    (
        readings.where("esp_id is not null and ts is not null")
        .select("esp_id", "ts", "id", *fields)
        .repartitionByRange(n, "esp_id", F.floor(F.col("ts") / DAY))
        .sortWithinPartitions("esp_id", "ts", "id")
        .write.option("parquet.block.size", str(4 << 20))
        .parquet(folder)
    )
    # files by name only: their numbers are in the order of (source, day)
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    units = listed.select(F.regexp_extract("path", r"part-(\d+)", 1).cast("int").alias("unit"), "path")
    tail = limits.context

    def measure(batches):
        for b in batches:
            for unit, path in zip(b.column("unit").to_pylist(), b.column("path").to_pylist()):
                fs, at = resolve(path)
                with fs.open_input_file(at) as f:
                    d = _load(pq.read_table(f, columns=["esp_id", "ts", *fields]))
                rows = []
                for a, z in _groups(d["esp_id"]):
                    for c in fields:
                        valid = np.flatnonzero(~np.isnan(d[c][a:z])) + a
                        ts, x = d["ts"][valid], d[c][valid]
                        low, high = limits.possible[c]
                        ok = (x >= low) & (x <= high) & ~np.isinf(x)
                        ends = _ends(ts[:tail], x[:tail]), _ends(ts[-tail:], x[-tail:])
                        for i, j in _groups(ts // DAY):
                            k, s, step = _scatter(x[i:j], limits, (low, high))
                            use = ok[i:j] & (run_lengths(x[i:j]) < limits.run)
                            p = profile((ts[i:j] % DAY // SLOT)[use], x[i:j][use])
                            row = (unit, d["esp_id"][a], c, int(ts[i] // DAY), k, s, step, None if p is None else p.tobytes(), *ends)
                            rows.append(dict(zip(schema.names, row)))
                            ends = None, None
                yield pa.RecordBatch.from_pylist(rows, schema)

    edge = pa.list_(pa.struct([("ts", pa.int64()), ("x", pa.float64())]))
    types = (pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), edge, edge)
    schema = pa.schema(list(zip(("unit", "esp_id", "field", "day", "n", "scatter", "step", "profile", "head", "tail"), types)))
    days = materialise(units.repartition(n).mapInArrow(measure, MEASURED), "days")
    of = ["esp_id", "field"]

    # a source's scatter: the median over its days, each with the weight of its readings. A coarse sensor scatters by its step at least
    step = F.min(F.when(F.col("step") > 0, F.col("step"))) / 12**0.5
    sigma = days.groupBy(*of).agg(F.greatest(F.percentile(F.when(F.col("n") > 0, F.col("scatter")), 0.5, F.col("n")), step).alias("sigma"))

    def decompose(table: pa.Table) -> pa.Table:
        table = table.sort_by("day")
        m = np.array([np.frombuffer(p) for p in table.column("profile").to_pylist()])
        courses = [c.tobytes() for c in normal_courses(m, limits.longest)]
        return table.select([*of, "day"]).append_column("course", pa.array(courses, pa.binary()))

    # a block of profiles is small and its work isn't: a fixed number of partitions, which AQE doesn't coalesce
    block = F.floor(F.col("day") / limits.days).alias("block")
    courses = days.where("profile is not null").select(*of, "day", "profile", block).repartition(n, *of, "block").groupBy(*of, "block").applyInArrow(decompose, COURSE)

    # what a file needs of those beside it: each has a reading at least, so that `tail` files always have enough
    order = Window.partitionBy(*of).orderBy("unit")
    ends = days.where("tail is not null").select(
        "unit", *of, F.flatten(F.collect_list("tail").over(order.rowsBetween(-tail, -1))).alias("before"), F.flatten(F.collect_list("head").over(order.rowsBetween(1, tail))).alias("after")
    )
    last = F.when(F.size("before") > tail, F.slice("before", -tail, tail)).otherwise(F.col("before"))
    ends = ends.withColumns({"before": last, "after": F.slice("after", 1, tail)})
    beside = ends.select("unit", *of, F.explode(F.array_distinct(F.transform(F.concat("before", "after"), lambda e: F.floor(e["ts"] / DAY)))).alias("day"))
    at = days.select("unit", *of, "day").unionByName(beside).distinct().join(courses, [*of, "day"], "left")
    at = at.groupBy("unit", *of).agg(F.collect_list(F.when(F.col("course").isNotNull(), F.struct("day", "course"))).alias("courses"))
    wanted = ends.join(sigma, of).join(at, ["unit", *of]).join(units, "unit")

    def judge(table: pa.Table) -> pa.Table:
        known = {(r["esp_id"], r["field"]): r for r in table.drop_columns(["unit", "path"]).to_pylist()}
        fs, path = resolve(table.column("path")[0].as_py())
        with fs.open_input_file(path) as f:
            d, out = _load(pq.read_table(f)), []
        for a, z in _groups(d["esp_id"]):
            for c in fields:
                if r := known.get((d["esp_id"][a], c)):
                    valid = np.flatnonzero(~np.isnan(d[c][a:z])) + a
                    before, after = ((np.array([e["ts"] for e in r[k]], np.int64), np.array([e["x"] for e in r[k]], float)) for k in ("before", "after"))
                    ts, x = np.r_[before[0], d["ts"][valid], after[0]], np.r_[before[1], d[c][valid], after[1]]
                    ids, own = np.full(len(ts), None, object), np.zeros(len(ts), bool)
                    mine = slice(len(before[0]), len(before[0]) + len(valid))
                    ids[mine], own[mine] = d["id"][valid], True
                    courses = {e["day"]: np.frombuffer(e["course"]) for e in r["courses"]}
                    out += _flag(ids, ts, x, own, np.inf if r["sigma"] is None else r["sigma"], courses, limits, c)
        kinds = [("id", pa.binary()), ("field", pa.string()), ("kind", pa.string()), ("value", pa.float64()), ("level", pa.float64()), ("scatter", pa.float64())]
        return pa.Table.from_pylist(out, pa.schema(kinds))

    return wanted.repartition(2 * n, "unit").groupBy("unit").applyInArrow(judge, OUT)
