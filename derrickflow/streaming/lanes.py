"""Structured Streaming: routing, exactly-once events, hourly counters, latest state and alerts."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from derrickflow.functions import contract, rules
from derrickflow.functions.ids import identity, spelled
from derrickflow.functions.times import HOUR, micros_ntz
from derrickflow.operators import alerts as alert_rows
from derrickflow.operators import late_events, parse, state
from derrickflow.session import materialise
from derrickflow.sources import archive
from derrickflow.sources.files import remove, resolve


def read_stream(spark: SparkSession, path: str, schema, per_trigger: int = 64) -> DataFrame:
    """Parquet files as a stream: those of a folder, or the file itself."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    is_file = fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(fs_path).isFile()
    r = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger)
    if is_file:
        folder, _, name = path.rpartition("/")
        return r.option("pathGlobFilter", name).parquet(folder)
    return r.parquet(path)


def run(stream: DataFrame, each, checkpoint: str) -> None:
    """Process all there is, batch by batch, with each(batch, number)."""
    q = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def staged(df: DataFrame, to: str, arrived: str = "ingested_at", parts: int = 4, files: int = 8) -> int:
    """Write df as a folder to be streamed in order of arrival: `parts` stretches of arrival time one after the other, unknown arrivals last, `files` files each.

    Returns the number of files of a stretch, for maxFilesPerTrigger. A source takes files by the time they were written, so batches come in order.
    """
    us = F.unix_micros(F.col(arrived).cast("timestamp"))
    cuts = df.select(us.alias("a")).approxQuantile("a", [i / parts for i in range(1, parts)], 0.001)
    number = F.lit(0)
    for c in sorted(set(cuts)):
        number = number + F.when(us.isNull() | (us > c), 1).otherwise(0)
    kept = materialise(df.withColumn("_part", number), "staged")
    for k in range(parts):
        kept.where(F.col("_part") == k).drop("_part").repartition(files).write.mode("append").parquet(to)
    return files


class Router:
    """Routes raw records: each gets exactly one outcome, processed, superseded or quarantined, batch by batch.

    A record that can't be parsed or breaks the contract goes, as an envelope that keeps its bytes, to quarantine. A valid one is kept
    in the raw archive under its path and updates its pump's latest state, if it is newer. Everything a
    batch writes carries its number: a retried batch replaces its own, and reads the state from before it.
    """

    OUTCOMES = "source_uri string, line_no int, event_id string, esp_id string, rule_id string, outcome string"

    def __init__(self, spark: SparkSession, pumps: DataFrame, folder: str, kind: str = "realtime_json"):
        self.spark, self.pumps, self.folder, self.kind = spark, pumps, folder, kind

    def states(self) -> dict[int, str]:
        """The folders of states by the number of the batch that wrote them."""
        fs, path = resolve(self.folder)
        found = fs.get_file_info(pafs.FileSelector(path, allow_not_found=True))
        return {int(f.base_name[6:]): f"{self.folder}/{f.base_name}" for f in found if f.base_name.startswith("state-")}

    def each(self, batch: DataFrame, number: int) -> None:
        """Route a batch of lines: source_uri, line_no, payload, ingested_at."""
        lines = batch.select("source_uri", F.lit(self.kind).alias("source_kind"), "line_no", "payload", "ingested_at")
        known = self.pumps.select(F.col("esp_id").alias("_known")).distinct()
        # a record's own place finds its bytes again; both are of this batch only
        typed = parse.typed_lines(lines.withColumn("line_no", F.coalesce("line_no", F.lit(0))), ("payload",))
        judged = contract.judge(typed.join(known, F.col("esp_id") == F.col("_known"), "left"), F.col("_known").isNotNull(), F.col("ts"), F.col("malformed"), F.col("version_text"))
        v = materialise(judged.drop("_known").withColumns({"id": identity(F.col("event_id")), "arrived": F.coalesce(micros_ntz(F.col("ingested_at")), F.lit((1 << 63) - 1))}), "routed")
        ok = F.col("rule_id") == contract.OK

        bad = archive.envelopes(v.where(~ok), F.col("payload"), F.col("ingested_at"), ("source_uri", "line_no"))
        bad.write.mode("overwrite").parquet(f"{self.folder}/quarantine/batch={number}")
        raw = v.where(ok).select(archive.archive_path(F.col("esp_id"), F.col("ts"), spelled(F.col("id"))).alias("path"), "payload", "arrived")
        raw.write.mode("overwrite").parquet(f"{self.folder}/raw/batch={number}")

        cols, before = ["esp_id", "ts", "arrived", "source_uri", "line_no", "id", "status", "flow_rate"], {k: u for k, u in self.states().items() if k < number}
        seed = self.spark.read.parquet(before[max(before)]) if before else v.select(*cols).limit(0)
        new = v.where(ok).select(*cols, F.lit(False).alias("old")).unionByName(seed.select(*cols).withColumns({"old": F.lit(True), "arrived": F.lit(-1).cast("long")}))
        judged = state.outcomes(new, "arrived", ["source_uri", "line_no", "id"]).where(~F.col("old"))
        shown = judged.select("source_uri", "line_no", spelled(F.col("id")).alias("event_id"), "esp_id", F.lit(contract.OK).alias("rule_id"), "outcome")
        held = v.where(~ok).select("source_uri", "line_no", spelled(F.col("id")).alias("event_id"), "esp_id", "rule_id", F.lit("quarantined").alias("outcome"))
        shown.unionByName(held).write.mode("overwrite").parquet(f"{self.folder}/outcomes/batch={number}")
        now = state.latest(new, F.col("arrived"), cols[2:]).select(*cols)
        now.write.mode("overwrite").parquet(f"{self.folder}/state-{number}")
        for k in sorted(before)[:-1]:  # the one before stays, for a retry of this batch
            remove(before[k])

    def _all(self, what: str, ddl: str) -> DataFrame:
        return self.spark.read.schema(ddl).option("recursiveFileLookup", "true").parquet(f"{self.folder}/{what}")

    def outcomes(self) -> DataFrame:
        return self._all("outcomes", self.OUTCOMES)

    def archived(self) -> DataFrame:
        """The raw archive: path and payload. A path that came again has the payload that arrived last."""
        rows = self._all("raw", "path string, payload string, arrived long")
        return rows.groupBy("path").agg(F.max_by("payload", "arrived").alias("payload"))

    def quarantined(self) -> DataFrame:
        return self._all("quarantine", "source_uri string, line_no int, rule_id string, json string")

    def state(self) -> DataFrame:
        now = self.states()
        return self.spark.read.parquet(now[max(now)])


def routed(spark: SparkSession, lines: DataFrame, pumps: DataFrame, folder: str) -> Router:
    """Route a stream of lines to its end; see Router."""
    r = Router(spark, pumps, folder)
    run(lines, r.each, f"{folder}/checkpoint")
    return r


#: Sequence numbers of a stretch.
STRETCH = 1024


def failed_range(log: DataFrame, failures: DataFrame) -> DataFrame:
    """The records of a log (shard, sequence, and more) that failure notices name (shard, first, last): each once, however many notices name it."""
    stretch = lambda c: F.floor(F.col(c) / STRETCH)
    # notices and records meet by stretches of sequence numbers, so that a shard's many notices don't each meet all its records
    named = failures.select("shard", "first", "last").distinct().withColumn("_stretch", F.explode(F.sequence(stretch("first"), stretch("last"))))
    found = log.withColumn("_stretch", stretch("sequence")).join(named, ["shard", "_stretch"]).where(F.col("sequence").between(F.col("first"), F.col("last")))
    return found.select(*log.columns).dropDuplicates(["shard", "sequence"])


def hourly(spark: SparkSession, readings: DataFrame, folder: str) -> DataFrame:
    """Hourly counts of a stream of usable readings by conflict-free counters: esp_id, period, n, total.

    Every batch writes the first arrivals of its own events; a retry replaces them. An event counts by the earliest
    of its copies in all batches, in time for the cut-off or not, so neither the order of files and rows
    nor their split into batches matters, and there is no watermark to fall behind.
    """

    def each(batch: DataFrame, number: int) -> None:
        a = late_events.arrivals(batch)
        # a copy after the cut-off counts nothing, whatever other copies there are
        a.where(F.col("arrived") - F.col("period") - HOUR <= late_events.CUT_OFF).write.mode("overwrite").parquet(f"{folder}/arrivals/batch={number}")

    run(readings.select("id", "esp_id", "ts", "arrived", "flow_rate"), each, f"{folder}/checkpoint")
    some = spark.read.option("recursiveFileLookup", "true").parquet(f"{folder}/arrivals")
    first = late_events.arrivals(some.select("id", "esp_id", F.col("period").alias("ts"), "arrived", F.col("v").alias("flow_rate")))
    return late_events.read(late_events.merge(late_events.counters(first))).select("esp_id", "period", "n", "total")


def latest_state(spark: SparkSession, readings: DataFrame, columns: list[str], folder: str) -> DataFrame:
    """Latest state per pump of a stream: every batch is merged with the state before; a retried batch changes nothing."""

    def states() -> dict[int, str]:
        fs, path = resolve(folder)
        found = fs.get_file_info(pafs.FileSelector(path, allow_not_found=True))
        return {int(f.base_name[6:]): f"{folder}/{f.base_name}" for f in found if f.base_name.startswith("state-")}

    def each(batch: DataFrame, number: int) -> None:
        b, before = batch.select("esp_id", "ts", "arrived", "id", *columns), {k: v for k, v in states().items() if k < number}
        if before:
            b = b.unionByName(spark.read.parquet(before[max(before)]))
        state.latest(b, F.col("arrived"), ["arrived", "id", *columns]).write.mode("overwrite").parquet(f"{folder}/state-{number}")
        for k in sorted(before)[:-1]:  # the one before stays, for a retry of this batch
            remove(before[k])

    run(readings, each, f"{folder}/checkpoint")
    now = states()
    return spark.read.parquet(now[max(now)])


DECISION = "esp_id string, rule_id string, event_id string, ts long, kind string, severity string, episode_start string"


def _decide(key: tuple, batches: Iterator[pd.DataFrame], held: GroupState, cooldown: int) -> Iterator[pd.DataFrame]:
    """Decisions of a pump's events; the state has, per rule with an open episode, its first event, the end of the cooldown and the event sent last."""
    mine = json.loads(held.get[0]) if held.exists else {}
    rows = pd.concat(list(batches)).sort_values(["ts", "event_id"], kind="stable")
    on = rows[list(rules.RULES)].to_numpy(bool)
    ts, event, severity = rows["ts"].tolist(), rows["event_id"].tolist(), rows["severity"].tolist()
    out = []
    for k, rule in enumerate(rules.RULES):
        s = mine.pop(rule, None)
        # without an open episode nothing happens before the next event for which the rule holds
        at = np.flatnonzero(on[:, k] | np.r_[s is not None, on[:-1, k]])
        for i in at.tolist():
            if on[i, k]:
                s = s or [event[i], 0, ""]
                if ts[i] < s[1] or s[2] == event[i]:
                    kind = "suppressed"
                else:
                    kind, s[1], s[2] = "trigger", ts[i] + cooldown, event[i]
                out.append((key[0], rule, event[i], ts[i], kind, severity[i], s[0]))
            elif s is not None:
                out.append((key[0], rule, event[i], ts[i], "recovery", "info", s[0]))
                s = None
        if s is not None:
            mine[rule] = s
    held.update((json.dumps(mine),))
    yield pd.DataFrame(out, columns=["esp_id", "rule_id", "event_id", "ts", "kind", "severity", "episode_start"])


def alerts(readings: DataFrame, cooldown: int = rules.COOLDOWN) -> DataFrame:
    """Alert decisions of a stream with one state per pump; events of a batch in order of time, batches as they come."""
    severity = rules.severity(rules.triggered())
    some = readings.select("esp_id", "ts", "event_id", severity.alias("severity"), *[rules.holds(r).alias(r) for r in rules.RULES])

    def decide(key, batches, held):
        yield from _decide(key, batches, held, cooldown)

    return some.groupBy("esp_id").applyInPandasWithState(decide, DECISION, "state string", "append", GroupStateTimeout.NoTimeout)


def send_alerts(spark: SparkSession, readings: DataFrame, folder: str, cooldown: int = rules.COOLDOWN) -> DataFrame:
    """Alert rows of a stream of readings, as alerts.alerts makes them; and, in {folder}/decisions, all decisions.

    A retried batch replaces its rows. Identifiers are derived from episode and event, so an alert that is decided again for a
    delivery that came again has the identifier it had, and stands once.
    """

    def each(batch: DataFrame, number: int) -> None:
        b = materialise(batch, "decided")
        b.write.mode("overwrite").parquet(f"{folder}/decisions/batch={number}")
        alert_rows.alerts(b).write.mode("overwrite").parquet(f"{folder}/alerts/batch={number}")

    run(alerts(readings, cooldown), each, f"{folder}/checkpoint")
    sent = spark.read.option("recursiveFileLookup", "true").parquet(f"{folder}/alerts")
    first = F.min(F.struct("ts", *[c for c in sent.columns if c not in ("alert_id", "ts")])).alias("a")
    return sent.groupBy("alert_id").agg(first).select("alert_id", "a.*")


def alert_lines(lines: DataFrame, skipped_to: str):
    """For a foreachBatch of raw lines: the readings that the alert lane takes; how many lines it had to skip is written per batch.

    Quarantine is not this lane's matter: a line that can't be parsed, or has no pump or time, is counted and passed over.
    """
    typed = parse.typed_lines(lines)
    usable_ = F.col("malformed").isNull() & F.col("esp_id").isNotNull() & F.col("ts").isNotNull()
    typed.agg(F.count("*").alias("n_lines"), F.count_if(~usable_).alias("n_skipped")).write.mode("overwrite").parquet(skipped_to)
    return typed.where(usable_)


def windows(events: DataFrame, ts: str = "event_ts", lateness: str = "6 hours") -> DataFrame:
    """Five-minute tumbling counts per pump with a watermark, for append output."""
    w = events.withWatermark(ts, lateness).groupBy(F.window(ts, "5 minutes"), "esp_id").agg(F.count("*").alias("n"))
    return w.select("esp_id", F.col("window.start").alias("start"), "n")

