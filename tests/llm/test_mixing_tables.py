import math
import random

from derrickflow.llm import mixing


def test_shortfalls_come_from_the_mix(spark):
    rng = random.Random(3)
    rows = [(i, rng.randrange(1, 50), "abc"[i % 3], "x") for i in range(900)] + [(1000 + i, 20, "small", "x") for i in range(5)] + [(2000, 0, "blank", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, n_tokens long, source string, wanted string")
    targets = [("a", 0.5, 2), ("b", 0.2, 1), ("small", 0.1, 3), ("none", 0.1, 4), ("blank", 0.05, None), ("never", 0.05, 0)]
    plan = mixing.weights(docs, spark.createDataFrame(targets, "source string, target_share double, max_repeats int"))
    drawn = mixing.realise(docs, plan)
    found = lambda d: {r.source for r in mixing.shortfalls(d, docs, plan).collect()}
    size = {s: sum(n for _, n, x, _ in rows if x == s) for s in ("a", "b", "small", "none", "blank", "never")}
    total = sum(n for _, n, _, _ in rows)
    want = {s for s, t, m in targets if size[s] * (9e9 if m is None else m) < t * total}
    assert found(drawn) == want == {"small", "none", "blank", "never"}
    # another mix, other shortfalls: what was not drawn as often as allowed could have yielded more
    assert found(drawn.where("source <> 'small'")) == want - {"small"}
    assert found(drawn.limit(0)) == {"none", "blank", "never"}


def test_exponent_over_a_table(spark):
    rng = random.Random(8)
    shares = [rng.random() ** 3 for _ in range(500)] + [0.0]
    shares = [x / sum(shares) for x in shares]
    df = spark.createDataFrame([(str(i), x) for i, x in enumerate(shares)], "source string, share double")
    for wanted in (1.0, 4.0, 5.9, 9.0):
        assert math.isclose(mixing.exponent_over(df, wanted), mixing.exponent_for_entropy(shares, wanted), abs_tol=1e-5)
    docs = spark.createDataFrame([(i, 1 + i % 7, f"s{i % 50}") for i in range(3000)], "doc_id long, n_tokens long, source string")
    plan = mixing.weights(docs, wanted_entropy=3.9)
    w = [r.weight for r in plan.collect()]
    assert math.isclose(sum(w), 1) and math.isclose(mixing.entropy(w), 3.9, abs_tol=1e-4)
    got = mixing.report(mixing.realise(docs, plan), plan).collect()
    assert math.isclose(sum(r.actual_share for r in got), 1) and max(abs(r.actual_share - r.weight) for r in got) < 0.01
