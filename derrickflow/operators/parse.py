"""Rows that fail to parse: raw lines into typed events, or rejected events with rule, reason and offset.

A batch of lines is tokenized at once by finite automata (operators.automaton): quote-aware fields
of CSV records, strings and nesting of JSON. What is sound there becomes a typed row, on which the
contract's column expression decides.
"""

from __future__ import annotations

import json
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from derrickflow.functions import contract
from derrickflow.functions.times import iso_micros, micros
from derrickflow.operators import automaton as A

TEXTS = ("event_id", "timestamp", "esp_id", "source", "run_id", "status", "scenario")
NUMBERS = contract.REQUIRED_NUMBERS + contract.OPTIONAL_NUMBERS
CSV_KIND = "historical_csv"
TYPED = (
    "source_uri string, source_kind string, line_no int, ingested_at timestamp_ntz, malformed string, offset int, schema_version double, version_text string, "
    + ", ".join(f"{c} string" for c in TEXTS) + ", " + ", ".join(f"{c} double" for c in NUMBERS)
)
#: Marks that may stand before or after a header's names and count for nothing.
STRAY = "﻿​‌‍⁠  \t\r\n\"'"


def _number(value):
    """A JSON number as float; NaN for any other value but null."""
    if value is None:
        return None
    if isinstance(value, bool) or not isinstance(value, (int, float)):
        return math.nan
    try:
        return float(value) if math.isfinite(value) else math.nan
    except OverflowError:
        return math.nan


def _text(value):
    """A JSON string as it is; another value marked, so that it equals no string."""
    return value if value is None or isinstance(value, str) else "\0" + json.dumps(value)


def _csv_number(value: str | None):
    """A CSV value as a number: absent if empty, NaN if it is none."""
    if value is None or value == "":
        return None
    try:
        x = float(value) if "_" not in value else math.nan
    except ValueError:
        return math.nan
    return x if math.isfinite(x) else math.nan


#: What is wrong with a line, by number; sound ones have 0.
WRONG = ("", "line cannot be decoded", "string is not closed", "brackets are not balanced", "event is not a JSON object", "line cannot be decoded")


def _next(marks: np.ndarray, at: np.ndarray, none: int) -> np.ndarray:
    """The first of the ascending marks at or after each position; none where there is none."""
    return np.append(marks, none)[np.searchsorted(marks, at)]


def json_events(texts: list[str]) -> list[tuple[dict | None, str | None, int | None]]:
    """(event, reason, offset) of each line: exactly one strict JSON object, or why and where (byte) it isn't.

    All lines are examined at once, by their automaton states and bracket depths; what is sound is decoded.
    """
    data, starts, ends = A.join_records([t.encode("utf-8", "surrogatepass") for t in texts])
    state = A.JSON.states(data)
    outside = state == A.OUTSIDE
    full = ~((data == 32) | (data == 9) | (data == 10) | (data == 13)) & (data != A.END)
    step = np.where(outside & ((data == ord("{")) | (data == ord("["))), 1, 0) - np.where(outside & ((data == ord("}")) | (data == ord("]"))), 1, 0)
    depth = np.cumsum(step)
    base = np.where(starts > 0, depth[np.maximum(starts - 1, 0)], 0)
    end, size = state[ends], len(data)
    broke = _next(np.flatnonzero((state == A.JSON_BROKEN) & (np.r_[np.uint8(0), state[:-1]] != A.JSON_BROKEN)), starts, size)
    first = _next(np.flatnonzero(full), starts, size)
    shut = _next(np.flatnonzero(full & (depth == np.repeat(base, ends - starts + 1))), starts, size)
    last = np.flatnonzero(full)
    last = np.append(last, -1)[np.searchsorted(last, ends) - 1]
    no_object = (shut >= ends) | (data[np.minimum(first, size - 1)] != ord("{"))
    wrong = np.select([end == A.JSON_BROKEN, end != A.OUTSIDE, depth[ends] != base, no_object, shut != last], [1, 2, 3, 4, 5], 0)
    offset = np.choose(wrong, [np.zeros_like(starts), broke - 1 - starts, ends - starts, ends - starts, np.zeros_like(starts), shut + 1 - starts])
    out = []
    for text, w, at in zip(texts, wrong.tolist(), offset.tolist()):
        if w:
            out.append((None, WRONG[w], at))
            continue
        try:
            out.append((json.loads(text, parse_constant=_refuse), None, None))
        except (ValueError, RecursionError) as e:
            out.append((None, WRONG[1], getattr(e, "pos", 0)))
    return out


def _refuse(name: str):
    raise ValueError(f"{name} is no JSON value")


def csv_records(texts: list[str]) -> list[tuple[list[str] | None, str | None, int | None]]:
    """(fields, reason, offset) of each line as one CSV record."""
    data, starts, ends = A.join_records([t.encode("utf-8", "surrogatepass") for t in texts])
    state = A.CSV.states(data)
    cut = np.flatnonzero((data == A.COMMA) & ((state == A.FIELD) | (state == A.PLAIN) | (state == A.CLOSED)))
    lo, hi = np.searchsorted(cut, starts), np.searchsorted(cut, ends)
    broken = np.flatnonzero((state == A.BROKEN) & (np.r_[np.uint8(0), state[:-1]] != A.BROKEN))
    quotes = np.add.reduceat((data == A.QUOTE).astype(np.int64), starts) if len(starts) else []
    raw, out = data.tobytes(), []
    for i, text in enumerate(texts):
        a, b = int(starts[i]), int(ends[i])
        if state[b] == A.BROKEN:
            out.append((None, "text before or after quotes", int(broken[np.searchsorted(broken, a)] - 1 - a)))
        elif state[b] == A.QUOTED:
            out.append((None, "quotes are not closed", b - a))
        elif not quotes[i]:
            out.append((text.split(","), None, None))
        else:
            at = [a - 1, *cut[lo[i] : hi[i]].tolist(), b]
            parts = (raw[p + 1 : q].decode("utf-8", "surrogatepass") for p, q in zip(at, at[1:]))
            out.append(([p[1:-1].replace('""', '"') if p[:1] == '"' else p for p in parts], None, None))
    return out


def header_names(text: str | None) -> list[str] | None:
    """A header's column names without stray marks; None if there is no header or it can't be read."""
    if text is None:
        return None
    fields = csv_records([text.strip("﻿​\r\n")])[0][0]
    return None if fields is None else [f.strip(STRAY) for f in fields]


def _version(value):
    return _number(float(value) if isinstance(value, bool) else value)


def _columns(batch: pa.RecordBatch) -> tuple[list[int], dict[str, list]]:
    """Positions in the batch, and the columns of what was read there: null lines, JSON lines and, header by header, CSV lines."""
    texts, csv = batch.column("payload").to_pylist(), pc.fill_null(pc.equal(batch.column("source_kind"), CSV_KIND), False).to_pylist()
    at: list[int] = []
    out: dict[str, list] = {c: [] for c in ("malformed", "offset", "schema_version", "version_text", *TEXTS, *NUMBERS)}

    def add(where: list[int], **columns) -> None:
        at.extend(where)
        for c, values in out.items():
            values.extend(columns.get(c) or [None] * len(where))

    def bad(found: list[tuple[int, str, int]]) -> None:
        if found:
            where, why, offset = map(list, zip(*found))
            add(where, malformed=why, offset=offset)

    bad([(i, "line is null", 0) for i, t in enumerate(texts) if t is None])
    some = [i for i, t in enumerate(texts) if t is not None and not csv[i]]
    read = list(zip(some, json_events([texts[i] for i in some]))) if some else []
    bad([(i, why, offset) for i, (event, why, offset) in read if event is None])
    good = [(i, event) for i, (event, _, _) in read if event is not None]
    events = [e for _, e in good]
    version = [e.get("schema_version") for e in events]
    fields = {c: [_text(e.get(c)) for e in events] for c in TEXTS} | {c: [_number(e.get(c)) for e in events] for c in NUMBERS}
    add([i for i, _ in good], schema_version=[_version(v) for v in version], version_text=[repr(v) for v in version], **fields)

    some = [i for i, t in enumerate(texts) if t is not None and csv[i]]
    records = csv_records([texts[i].rstrip("\r\n") for i in some]) if some else []
    heads = batch.column("header").to_pylist()
    by_head: dict = {}
    for i, record in zip(some, records):
        by_head.setdefault(heads[i], []).append((i, record))
    for head, mine in by_head.items():
        names = header_names(head)
        if names is None:
            bad([(i, "object has no readable header", 0) for i, _ in mine])
            continue
        bad([(i, why, offset) for i, (cells, why, offset) in mine if cells is None])
        bad([(i, f"record has {len(cells)} columns, its header {len(names)}", 0) for i, (cells, _, _) in mine if cells is not None and len(cells) != len(names)])
        good = [(i, cells) for i, (cells, _, _) in mine if cells is not None and len(cells) == len(names)]
        place = {name: k for k, name in enumerate(names)}
        cell = lambda c: [cells[place[c]] or None for _, cells in good] if c in place else [None] * len(good)  # noqa: B023, E731
        version = cell("schema_version")
        fields = {c: cell(c) for c in TEXTS} | {c: [_csv_number(v) for v in cell(c)] for c in NUMBERS}
        add([i for i, _ in good], schema_version=[_csv_number(v) for v in version], version_text=[repr(v) for v in version], **fields)
    return at, out


def _array(values: list, kind: pa.DataType) -> pa.Array:
    try:
        return pa.array(values, kind, from_pandas=False)
    except UnicodeEncodeError:
        # JSON can spell half a surrogate pair, which is no text
        return pa.array([v.encode("utf-8", "replace").decode() if isinstance(v, str) else v for v in values], kind)


def _typed(batch: pa.RecordBatch, keep: tuple[str, ...]) -> pa.RecordBatch:
    at, columns = _columns(batch)
    back = np.empty(len(at), np.int64)
    back[np.asarray(at, np.int64)] = np.arange(len(at))
    kinds = {"offset": pa.int32()} | dict.fromkeys(("schema_version", *NUMBERS), pa.float64())
    # an absent value is null, a present one that is no number NaN
    made = {c: _array(v, kinds.get(c, pa.string())).take(pa.array(back)) for c, v in columns.items()}
    own = {c: batch.column(c) for c in ("source_uri", "source_kind", "line_no", "ingested_at", *keep)}
    names = [x.split()[0] for x in TYPED.split(", ")] + list(keep)
    return pa.RecordBatch.from_arrays([made[c] if c in made else own[c] for c in names], names=names)


def typed_lines(lines: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every line that is no CSV header, typed: TYPED's columns, and ts (microseconds, null for no zoned ISO-8601 time); and the line itself, if keep has "payload".

    lines: source_uri, source_kind, line_no, payload, ingested_at, other columns are ignored. A line of
    historical_csv numbered 1 is its object's header (the least payload, if delivered more than once);
    every other kind is read as JSON. A null or empty line, or a CSV line whose object has no header, is
    malformed, with the reason. In number columns an absent value is null, NaN one that is no finite number.
    """
    use = lines.select("source_uri", "source_kind", F.col("line_no").cast("int").alias("line_no"), "payload", F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at"))
    head = F.coalesce((F.col("source_kind") == CSV_KIND) & (F.col("line_no") == 1), F.lit(False))
    headers = use.where(head).groupBy("source_uri").agg(F.min("payload").alias("header"))
    body = use.where(~head).join(headers, "source_uri", "left").select(*use.columns, "header")

    def typed(batches):
        for b in batches:
            if b.num_rows:
                yield _typed(b, keep)

    return body.mapInArrow(typed, ", ".join([TYPED, *(f"{c} string" for c in keep)])).withColumn("ts", micros(F.col("timestamp")))


def parse_lines(lines: DataFrame, pumps: DataFrame) -> DataFrame:
    """typed_lines(), judged: with rule_id and reason.

    pumps: registered esp_id, each once. Repeated lines are each judged; an empty table gives an empty one.
    """
    known = pumps.select(F.col("esp_id").alias("known_id"))
    rows = typed_lines(lines).join(known, F.col("esp_id") == F.col("known_id"), "left")
    return contract.judge(rows, F.col("known_id").isNotNull(), F.col("ts"), F.col("malformed"), F.col("version_text")).drop("known_id")


def rejected(parsed: DataFrame) -> DataFrame:
    """Rejected events: where they came from, the rule, the reason (with the byte offset if the line can't be read)."""
    why = F.concat("reason", F.coalesce(F.concat(F.lit(" at byte "), F.col("offset").cast("string")), F.lit("")))
    return parsed.where(F.col("rule_id") != contract.OK).select("source_uri", "source_kind", "ingested_at", "line_no", "event_id", "rule_id", why.alias("reason"))


def accepted(parsed: DataFrame) -> DataFrame:
    """The valid events, typed, with their time in the contract's normal form."""
    cols = [iso_micros(F.col("ts")).alias(c) if c == "timestamp" else F.col(c).cast("int").alias(c) if c == "schema_version" else F.col(c) for c in contract.FIELDS]
    return parsed.where(F.col("rule_id") == contract.OK).select(*cols, "source_uri", "source_kind", "ingested_at", "line_no")
