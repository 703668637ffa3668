"""Alert episodes with cooldown.

An episode of a pump and rule is a stretch of successive events for which the rule holds; the event
after it recovers it. Within an episode an alert is sent first, and again whenever the cooldown since
the last one sent has passed. That recursion needs the order only where successive events are closer
than the cooldown: an event further from its predecessor is always sent. So chains are cut at such
events, and each chain is folded by itself, in a stream of constant memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from derrickflow.functions import rules, windows
from derrickflow.functions.uuids import ALERTS, uuid5
from derrickflow.session import materialise

KEY = ["esp_id", "rule_id"]


def rule_hits(events: DataFrame) -> DataFrame:
    """Per rule the events and those for which it holds: one aggregation, whose only row is then turned into one per rule. No events give no rows."""
    hits = events.agg(F.count("*").alias("n_events"), *[F.count_if(rules.holds(r)).alias(r) for r in rules.RULES]).where("n_events > 0")
    each = F.array(*[F.struct(F.lit(r).alias("rule_id"), F.col(r).alias("hits")) for r in rules.RULES])
    return hits.select("n_events", F.explode(each).alias("r")).select("r.rule_id", "n_events", "r.hits")


def decisions(events: DataFrame, cooldown: int = rules.COOLDOWN, width: int = windows.HOUR) -> DataFrame:
    """Events with a decision per rule: trigger, suppressed or recovery (others have none): esp_id, rule_id, event_id, ts, kind, severity, episode_start.

    events: esp_id, ts (microseconds), event_id and the rules' columns; in order of ts, event_id within a pump. Rows with null
    esp_id or ts are ignored. episode_start is the event that began the episode.
    """
    few = events.where("esp_id is not null and ts is not null").withColumn("_rules", rules.triggered())
    few = few.withColumn("severity", rules.severity(F.col("_rules"))).select("esp_id", "ts", "event_id", "severity", *[rules.holds(r).alias(r) for r in rules.RULES])
    # each ordered step reads its input twice, so inputs are written once
    prev = windows.previous(materialise(few, "alerts"), ["esp_id"], "ts", ["event_id"], ["ts", *rules.RULES], width)
    each = F.array(*[F.struct(F.lit(r).alias("rule_id"), F.col(r).alias("on"), F.coalesce(F.col(f"prev_{r}"), F.lit(False)).alias("was")) for r in rules.RULES])
    long = prev.withColumn("_r", F.explode(each)).select("esp_id", "ts", "event_id", "severity", "prev_ts", "_r.*").where("on or was")
    long = materialise(long, "alerts")
    # an event starts a chain if it starts an episode or lies at least the cooldown after its predecessor
    head = F.col("on") & (~F.col("was") | (F.col("ts") - F.col("prev_ts") >= cooldown))
    long = long.withColumn("head", head).withColumn("start", F.col("on") & ~F.col("was"))
    chained = _carry(materialise(_carry(long, "head", "chain", width), "alerts"), "start", "episode", width).withColumn("episode_start", F.col("episode.event_id"))
    folded = _fold(chained, cooldown)
    kind = F.when(~F.col("on"), "recovery").when(F.col("sent"), "trigger").otherwise("suppressed")
    return folded.select(*KEY, "event_id", "ts", kind.alias("kind"), "severity", "episode_start")


def _carry(df: DataFrame, flag: str, name: str, width: int) -> DataFrame:
    """df with (ts, event_id) of the last flagged row up to this one."""
    d = df.withColumn("_m", F.when(F.col(flag), F.struct("ts", "event_id")))
    out = windows.running_max(d, KEY, "ts", ["event_id"], "_m", "_b", width)
    return out.withColumn(name, F.coalesce("_m", "_b")).drop("_m", "_b")


def _fold(chained: DataFrame, cooldown: int) -> DataFrame:
    schema = StructType(list(chained.select(*KEY, "ts", "event_id", "severity", "on", "episode_start").schema.fields)).add("sent", "boolean")

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, until = None, 0
        for b in batches:
            sent = np.zeros(len(b), bool)
            chain = list(zip(b["esp_id"], b["rule_id"], b["chain_ts"], b["chain_id"]))
            for i, (c, ts, on) in enumerate(zip(chain, b["ts"].tolist(), b["on"].tolist())):
                if on:
                    if c != at or ts >= until:
                        sent[i], at, until = True, c, ts + cooldown
            yield b.drop(columns=["chain_ts", "chain_id"]).assign(sent=sent)

    d = chained.select(*KEY, "ts", "event_id", "severity", "on", "episode_start", F.col("chain.ts").alias("chain_ts"), F.col("chain.event_id").alias("chain_id"))
    ordered = d.repartition(*KEY, "chain_ts", "chain_id").sortWithinPartitions(*KEY, "chain_ts", "chain_id", "ts", "event_id")
    return ordered.mapInPandas(fold, schema)


def alerts(decided: DataFrame) -> DataFrame:
    """What is sent: triggers and recoveries, with deterministic identifiers, label and severity (info for a recovery)."""
    episode = uuid5(ALERTS, F.concat_ws("|", "esp_id", "rule_id", "episode_start"))
    label = F.create_map(*[F.lit(x) for kv in rules.LABELS.items() for x in kv])
    d = decided.where("kind <> 'suppressed'").withColumn("episode_id", episode)
    return d.select(
        "kind",
        uuid5(ALERTS, F.concat_ws("|", "episode_id", "event_id", "kind")).alias("alert_id"),
        "episode_id",
        *KEY,
        label[F.col("rule_id")].alias("finding"),
        F.when(F.col("kind") == "recovery", "info").otherwise(F.col("severity")).alias("severity"),
        "ts",
        "event_id",
    )
