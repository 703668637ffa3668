import csv
import json
import math
import random
from datetime import datetime

from conftest import DATA
from hypothesis import given, settings
from hypothesis import strategies as st

from derrickflow.functions import contract as C
from derrickflow.operators import automaton as A
from derrickflow.operators import parse as P
from derrickflow.sources.telemetry import registered, table


def one_by_one(machine, data):
    state, out = 0, []
    for b in data:
        out.append(state)
        state = machine.table[state, machine.classes[b]]
    return out


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet='",\\u0aé{}[]: \n', max_size=300), min_size=1, max_size=12))
def test_composed_states_equal_sequential_ones(texts):
    data, _, _ = A.join_records([t.encode() for t in texts])
    for machine in (A.CSV, A.JSON):
        assert machine.states(data).tolist() == one_by_one(machine, data)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.text(alphabet='",ab \té', max_size=6), min_size=1, max_size=5), min_size=1, max_size=6))
def test_csv_fields_round_trip(rows):
    class Out:
        def __init__(self):
            self.s = []

        def write(self, x):
            self.s.append(x)

    out = Out()
    csv.writer(out, lineterminator="", quoting=csv.QUOTE_ALL).writerows(rows)
    assert [f for f, _, _ in P.csv_records(out.s)] == rows


def test_broken_quotes_have_offsets():
    got = P.csv_records(['a,"b', 'a,"b"c', 'a,b"c', '"a""b",', "", 'x,"y,z"'])
    assert [g[2] for g in got] == [4, 5, 3, None, None, None] and got[3][0] == ['a"b', ""] and got[4][0] == [""] and got[5][0] == ["x", "y,z"]


def test_json_lines():
    good = ['{"a": 1}', ' {"a": {"b": [1, "x]}"]}} ', '{"a": "\\u00e9\\n\\b\\f"}', "{}"]
    bad = ["", "1", "true", "[{}]", '{"a": 1', '{"a": "x', "{} {}", '{"a": NaN}', '{"a": 1,}', '{"a": "\t"}', '{"a": "\\x"}', '{"a": "\\u12g4"}', "﻿{}", "{]}", '"a": 1}']
    assert all(e is not None for e, _, _ in P.json_events(good)) and all(e is None and w for e, w, _ in P.json_events(bad))


def plain(kind, payload, header, pumps):
    """The contract, written once more and one line at a time."""
    if kind == P.CSV_KIND:
        try:
            fields = next(csv.reader([payload], strict=True))
        except (csv.Error, StopIteration):
            return C.MALFORMED
        names = [x.strip(P.STRAY) for x in header.split(",")]
        if len(fields) != len(names):
            return C.MALFORMED
        e = {k: v for k, v in zip(names, fields) if v != ""}
        for k in ("schema_version", *P.NUMBERS):
            if k in e:
                try:
                    e[k] = float(e[k])
                except ValueError:
                    pass
    else:
        try:
            e = json.loads(payload, parse_constant=P._refuse)
        except ValueError:
            return C.MALFORMED
        if not isinstance(e, dict):
            return C.MALFORMED
    number = lambda v: isinstance(v, (int, float)) and not isinstance(v, bool) and math.isfinite(v)
    if e.get("schema_version") != 1:
        return C.VERSION
    if any(e.get(f) in (None, "") for f in C.REQUIRED):
        return C.MISSING
    for f, among, rule in (("esp_id", pumps, C.PUMP), ("source", C.SOURCES, C.SOURCE), ("status", C.STATUSES, C.STATUS)):
        if e[f] not in among:
            return rule
    try:
        if datetime.fromisoformat(e["timestamp"]).tzinfo is None:
            return C.TIME
    except (ValueError, TypeError):
        return C.TIME
    if not all(number(e.get(f)) for f in C.REQUIRED_NUMBERS):
        return C.FINITE
    if not 0 <= e["water_cut"] <= 1 or min(e["flow_rate"], e["motor_current"], e["vibration"]) < 0:
        return C.RANGE
    return C.FINITE if any(e.get(f) is not None and not number(e[f]) for f in C.OPTIONAL_NUMBERS) else C.OK


def test_all_lines_against_a_plain_version(spark):
    for folder in (DATA, DATA.replace("0.001", "0.01")):
        lines = table(spark, folder, "raw_lines")
        rows = lines.collect()
        heads = {r.source_uri: r.payload for r in rows if r.source_kind == P.CSV_KIND and r.line_no == 1}
        pumps = {r.esp_id for r in registered(spark, folder).collect()}
        want = {(r.source_uri, r.line_no): plain(r.source_kind, r.payload, heads.get(r.source_uri), pumps) for r in rows if not (r.source_kind == P.CSV_KIND and r.line_no == 1)}
        got = {(r.source_uri, r.line_no): r.rule_id for r in P.parse_lines(lines, registered(spark, folder)).collect()}
        assert got == want and len(set(want.values())) > 5


EVENT = {
    "schema_version": 1, "event_id": "e", "timestamp": "2024-01-01T00:00:00Z", "esp_id": "ESP-1", "source": "realtime", "run_id": "r", "status": "RUNNING",
    "flow_rate": 1.0, "water_cut": 0.5, "motor_temperature": 3, "motor_current": 1, "vibration": 1,
}
BAD = [
    ({"schema_version": 2}, C.VERSION), ({"schema_version": "1"}, C.VERSION), ({"event_id": ""}, C.MISSING), ({"run_id": None}, C.MISSING), ({"esp_id": "ESP-9"}, C.PUMP), ({"esp_id": ["ESP-1"]}, C.PUMP),
    ({"source": "x"}, C.SOURCE), ({"status": "running"}, C.STATUS), ({"timestamp": "2024-01-01T00:00:00"}, C.TIME), ({"timestamp": 5}, C.TIME), ({"flow_rate": True}, C.FINITE), ({"vibration": "3"}, C.FINITE),
    ({"water_cut": 1.5}, C.RANGE), ({"motor_current": -1}, C.RANGE), ({"pump_frequency": "x"}, C.FINITE),
]


def test_order_of_rules(spark):
    pumps = spark.createDataFrame([("ESP-1",)], "esp_id string")
    cases = [(EVENT, C.OK), (EVENT | {"extra": {"a": [1]}}, C.OK), (EVENT | {"schema_version": True, "pump_frequency": None}, C.OK), (EVENT | {"flow_rate": 10**400}, C.FINITE)]
    cases += [(EVENT | b, rule) for b, rule in BAD]
    cases += [(EVENT | b | a, r1) for i, (a, r1) in enumerate(BAD) for b, _ in BAD[i + 1 :] if a.keys() != b.keys()]
    lines = [("u", "realtime_json", i, json.dumps(e), None, "") for i, (e, _) in enumerate(cases)]
    lines += [("v", P.CSV_KIND, 2, "a", None, ""), ("w", None, 1, None, None, ""), ("w", "x", 2, "", None, "")]
    random.Random(1).shuffle(lines)
    df = spark.createDataFrame(lines, "source_uri string, source_kind string, line_no long, payload string, ingested_at timestamp, header string")
    got = {(r.source_uri, r.line_no): r for r in P.parse_lines(df, pumps).collect()}
    assert [got["u", i].rule_id for i in range(len(cases))] == [r for _, r in cases]
    assert {got[k].rule_id for k in (("v", 2), ("w", 1), ("w", 2))} == {C.MALFORMED}
    rejected = P.rejected(P.parse_lines(df, pumps))
    assert rejected.count() == len(lines) - 3 and rejected.where("reason is null").count() == 0
    assert P.accepted(P.parse_lines(df, pumps)).select("timestamp").distinct().first()[0] == "2024-01-01T00:00:00.000000Z"
    assert P.parse_lines(df.where("false"), pumps).count() == 0


def test_long_line(spark):
    pumps = spark.createDataFrame([("ESP-1",)], "esp_id string")
    df = spark.createDataFrame([("u", "realtime_json", 1, json.dumps(EVENT | {"x": "y" * 3_000_000}), None)], "source_uri string, source_kind string, line_no int, payload string, ingested_at timestamp")
    assert P.parse_lines(df, pumps).first().rule_id == C.OK
