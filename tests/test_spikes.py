import numpy as np

from derrickflow.operators import spikes as S

RNG = np.random.default_rng(4)


def series(n=1500, step=60_000_000, scale=0.5):
    ts = 1_704_067_200_000_000 + np.arange(n) * step
    x = 80 + 3 * np.sin(np.arange(n) / 300) + RNG.normal(0, scale, n)
    return ts, np.round(x, 2)


def frame(spark, many):
    rows = [(e, int(t), f"{e}{i:06}".encode(), *[None if v is None else float(v) for v in vs], "x") for e, ts, cols in many for i, (t, *vs) in enumerate(zip(ts, *cols))]
    return spark.createDataFrame(rows, "esp_id string, ts long, id binary, motor_temperature double, vibration double, flow_rate double, motor_current double, level string")


def flags(spark, many, **how):
    return {(bytes(r.id).decode(), r.field, r.kind) for r in S.implausible(frame(spark, many), **how).collect()}


def test_low_rank_separates_spikes():
    normal = np.outer(np.sin(np.arange(24)), np.cos(np.arange(12))) * 5
    m = normal.copy()
    m[3, 4] += 40
    m[10, 2] -= 30
    low, sparse = S.low_rank(m[None])
    assert np.abs(low[0] - normal).max() < 1 and abs(sparse[0, 3, 4]) > 35 and abs(sparse[0, 10, 2]) > 25


def make():
    ts, t = series()
    v, f, c = (series()[1] for _ in range(3))
    t[100] += 30  # a spike
    t[200:203] -= 25  # three readings
    t[300:306] += 25  # six: lasts
    t[700:] += 40  # a step
    f[400:412] = 81.5  # stuck
    f[600:611] = 82.5  # one too few
    v[50], c[60] = -1.0, -0.5
    t[900] = 400.01
    v[10] = np.nan
    return ts, t, v, f, c


def test_kinds_of_flags(spark):
    ts, t, v, f, c = make()
    want = {("A000100", "motor_temperature", "spike"), ("A000900", "motor_temperature", "range"), ("A000050", "vibration", "range"), ("A000060", "motor_current", "range")}
    want |= {(f"A{i:06}", "motor_temperature", "spike") for i in (200, 201, 202)} | {(f"A{i:06}", "flow_rate", "stuck") for i in range(400, 412)}
    for n in (1, 5):  # whatever the cuts
        assert flags(spark, [("A", ts, (t, v, f, c)), ("B", ts, tuple(series()[1] for _ in range(4)))], partitions=n) == want


def test_runs_and_spikes_across_files(spark):
    ts, x = series(4 * 1440)
    x = x.copy()
    x[1435:1447] = 80.0  # over midnight
    x[2880] += 30
    x[2879] += 30
    got = flags(spark, [("A", ts, (x, x, x, x))], partitions=9)
    assert {g[0] for g in got if g[2] == "stuck"} == {f"A{i:06}" for i in range(1435, 1447)}
    assert {g[0] for g in got if g[2] == "spike"} == {"A002879", "A002880"} and len(got) == 4 * 14


def test_few_null_and_no_readings(spark):
    none = [None] * 3
    assert flags(spark, [("A", [1, 2, 2], (none, [float("nan")] * 3, [1.0, 2.0, 3.0], [float("inf"), 1.0, 2.0]))]) == {("A000000", "motor_current", "range")}
    assert S.implausible(frame(spark, [])).count() == 0


def test_coarse_sensor(spark):
    ts, x = series(scale=0.05)
    coarse = np.round(x)
    coarse[500] += 3
    got = flags(spark, [("A", ts, (coarse, x, x, x))])
    assert not {g for g in got if g[1:] == ("motor_temperature", "spike") and g[0] != "A000500"}


def test_the_decomposition_decides(spark):
    ts, x = series(n=1000, step=200_000_000)
    x = x.copy()
    at = np.arange(50, 950, 90)
    x[at] += 20
    want = {(f"A{i:06}", f, "spike") for i in at for f in S.POSSIBLE}
    many = [("A", ts, (x,) * 4)]
    assert flags(spark, many) == want
    # with every reading sparse there is no level of normal readings, with none there is no spike
    assert flags(spark, many, limits=S.Limits(first=0.0)) == set() == flags(spark, many, limits=S.Limits(first=1e9))
    # without the decomposition a slot's median takes the spike for normal
    days = ts // S.DAY
    m = np.array([S.profile(ts[days == d] % S.DAY // S.SLOT, x[days == d]) for d in np.unique(days)])
    own = np.ones(len(ts), bool)
    found = [len(S._flag(ts, ts, x, own, 0.5, dict(zip(np.unique(days), c)), S.Limits(), "flow_rate")) for c in (S.normal_courses(m, 3), m)]
    assert found[0] == len(at) > found[1]


def test_days_take_part_together():
    course = 10 * np.sin(np.arange(288) / 20)
    m = np.array([course + k for k in range(10)])
    m[4, 100:103] += 30
    low = S.normal_courses(m, 3)
    assert abs(low - np.array([course + k for k in range(10)])).max() < 2.5


def test_null_field_and_many_files(spark):
    ts, x = series(n=5 * 1440)
    many = [("A", ts, ([None] * len(x), x, x, [None] * (len(x) - 1) + [-1.0]))]
    assert flags(spark, many, partitions=12) == {(f"A{len(x) - 1:06}", "motor_current", "range")}
