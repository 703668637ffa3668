import random

from pyspark.sql import functions as F

from derrickflow.llm import mixing


def test_last_round_passes_over_texts_that_do_not_fit(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice([1, 2, 5, 30, 400, 3000]), "abc"[i % 3]) for i in range(900)] + [(5000, 90000, "d"), (5001, 7, "d"), (5002, 9, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, n_tokens long, source string")
    size = {s: sum(n for _, n, x in rows if x == s) for s in "abcd"}
    quota = {"a": size["a"] * 0.37, "b": size["b"] * 1.61, "c": 333.0, "d": 8.0}
    total = 1 << 40
    plan = spark.createDataFrame([(s, 3, size[s], quota[s] / total, total) for s in "abcd"], "source string, max_repeats int, size long, weight double, budget long")
    got = {r.doc_id: r.copies for r in mixing.realise(docs, plan, 5).collect()}
    order = F.xxhash64("doc_id", F.lit(5))
    want = {}
    rest = {s: q - q // size[s] * size[s] for s, q in quota.items()}
    for i, n, s in [tuple(r)[:3] for r in docs.orderBy(F.pmod(order, F.lit(mixing.BLOCKS)), order, "doc_id").collect()]:
        take = n <= rest[s] + 1e-6
        rest[s] -= n * take
        if copies := int(quota[s] // size[s]) + take:
            want[i] = copies
    assert got == want and all(r < 1 + 1e-6 for s, r in rest.items() if s != "d") and got.keys() & {5001, 5002}
