import random

from derrickflow.llm import packing


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, n_tokens long, source string, cluster long, duplicate_of long, asked string")


def test_chains_rings_and_trees(spark):
    rng = random.Random(6)
    links = [(i, i + 1) for i in range(100, 160)] + [(200, 201), (201, 202), (202, 200), (300, 300)] + [(i, rng.randrange(400, i)) for i in range(401, 440)]
    rows = [(i, 1, "a", None, j, "x") for i, j in links] + [(900, 1, "a", None, None, "x"), (901, 1, "a", None, 77777, "x")]
    parent = {}

    def root(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    for i, j in links + [(901, 77777)]:
        a, b = sorted((root(i), root(j)))
        parent[b] = a
    want = {x: root(x) for i, j in links + [(901, 77777)] if i != j for x in (i, j)}
    assert {r.doc_id: r.asked for r in packing.question_groups(docs(spark, rows)).collect()} == want
    assert packing.question_groups(docs(spark, [(1, 1, "a", None, None, "x")])).count() == 0


def test_a_copy_of_a_copy_conflicts(spark):
    rows = [(1, 10, "a", None, None, "x"), (2, 10, "a", None, 1, "x"), (3, 10, "a", None, 2, "x")] + [(i, 90, "a", None, None, "x") for i in range(10, 30)]
    df = docs(spark, rows)
    out = packing.pack(df, 100)
    at = {r.doc_id: r.sequence for r in out.collect()}
    assert len({at[i] for i in (1, 2, 3)}) == 3 and packing.conflicts(out, df).first().n_pairs == 0
    many = docs(spark, [(i, 10, "a", 5, None, "x") for i in range(30)])
    assert packing.conflicts(packing.pack(many, 100), many).first().n_pairs > 0
