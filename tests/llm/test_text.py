import math
import random
from collections import Counter

import numpy as np
import pytest
from conftest import DATA
from hypothesis import given, settings
from hypothesis import strategies as st

from derrickflow.llm import mixing, packing, quality, tokens
from derrickflow.llm import plans as P


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, n_tokens long, source string, cluster long, duplicate_of long, sequence string")


# sizes


def test_token_counts_of_whole_texts(spark):
    texts = ["", None, "a b  c", "é<|endoftext|>", "word " * 20000]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id int, text string, n_tokens int")
    got = {r.doc_id: r.n_tokens for r in tokens.sized(df).collect()}
    of = tokens.counter(tokens.default_path())
    assert got == {i: of([t])[0] if t else 0 for i, t in enumerate(texts)} and got[4] >= 20000


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_other_tokenizers(name):
    public = pytest.importorskip("public_tokenizers")
    of = tokens.counter(public.path(name))
    assert of(["", "two words"])[0] == 0 and of(["two words"])[0] >= 2


# packing


def check(rows, packed, capacity, apart=()):
    """What a packing must hold, from its rows alone."""
    size = {r[0]: r[1] or 0 for r in rows}
    by_doc, by_seq = {}, {}
    for p in packed:
        by_doc.setdefault(p.doc_id, []).append(p)
        if p.sequence is not None:
            by_seq.setdefault(p.sequence, []).append(p)
    assert set(by_doc) == set(size)
    for d, ps in by_doc.items():
        assert sum(p.n_tokens for p in ps) == size[d] and len(ps) == max(1, -(-size[d] // capacity))
        assert sorted(p.start for p in ps) == [i * capacity for i in range(len(ps))]
    source = {r[0]: r[2] for r in rows}
    for ps in by_seq.values():
        assert sum(p.n_tokens for p in ps) <= capacity
        some = {source[p.doc_id] for p in ps}
        assert len(some) == 1 or not some & set(apart)
    return by_seq


def test_packing_holds_its_rules(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice([0, 3, 10, 40, 99, 100, 101, 350]), rng.choice(["a", "b", None, "scraped_mirror"]), rng.randrange(200), None, "x") for i in range(600)]
    rows += [(1000, None, "a", None, 5, "x"), (1001, 7, None, None, 5, "x")]
    df = docs(spark, rows)
    for block in (1 << 21, 4000):
        out = packing.pack(df, 100, block).collect()
        seqs = check(rows, out, 100, packing.APART)
        cluster = {r[0]: r[3] for r in rows}
        for ps in seqs.values():
            seen = Counter(cluster[p.doc_id] for p in ps if cluster[p.doc_id] is not None)
            assert not seen or max(seen.values()) == 1
    assert sorted(map(tuple, out), key=str) == sorted(map(tuple, packing.pack(df.repartition(3), 100, 4000).collect()), key=str)
    assert packing.pack(docs(spark, [])).count() == 0


def test_many_copies_leave_no_bins_empty(spark):
    rows = [(i, 10, "a", 1 if i % 3 == 0 else i + 10, None, "x") for i in range(900)]
    seqs = check(rows, packing.pack(docs(spark, rows), 100).collect(), 100)
    assert len(seqs) <= 100


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 50), st.integers(0, 3)), min_size=1, max_size=40))
def test_tightest_compatible_bin(items):
    """Replays the packing: every item went into the compatible bin with the least sufficient residual, or none fitted."""
    sizes = np.array([s for s, _ in items])
    where, left = packing.best_fit(sizes, [c for _, c in items], [() for _ in items], 50, apart=1)
    order = sorted(range(len(items)), key=lambda i: (-sizes[i], i))
    space, inside = [], []
    for i in order:
        fits = [b for b in range(len(space)) if space[b] >= sizes[i] and all((items[i][1] == c) or (c != 0 and items[i][1] != 0) for c in inside[b])]
        if where[i] == len(space):
            assert not fits
            space.append(50)
            inside.append([])
        else:
            assert where[i] in fits and space[where[i]] == min(space[b] for b in fits)
        space[where[i]] -= sizes[i]
        inside[where[i]].append(items[i][1])
    assert space == left


# mixing


def test_exponents():
    shares = [0.7, 0.2, 0.1]
    for wanted in (0.3, 0.8018, 1.05):
        assert math.isclose(mixing.entropy(mixing.tempered(shares, mixing.exponent_for_entropy(shares, wanted))), wanted, abs_tol=1e-6)
    assert mixing.limited_weights([0.5, 0.5], [9, 9]) == ([0.5, 0.5], 1.0)
    w, e = mixing.limited_weights([0.5, 0.3, 0.2], [9, 0.1, 9])
    assert math.isclose(sum(w), 1) and math.isclose(w[1], 0.1, rel_tol=1e-6) and 0 < e < 1 and w[0] > w[2]
    assert mixing.limited_weights([0.5, 0.5], [0.2, 0.3]) == ([0.2, 0.3], 0.0)
    assert mixing.tempered([0.0, 0.0], 1) == [0.0, 0.0]


def test_realised_mix(spark):
    rng = random.Random(2)
    rows = [(i, rng.randrange(0, 60), rng.choice(["big"] * 8 + ["mid", None]), None, None, "x") for i in range(3000)] + [(9000 + i, 20, "small", None, None, "x") for i in range(5)]
    df = docs(spark, rows)
    targets = spark.createDataFrame([("big", 0.5, 3), ("mid", 0.3, 4), ("small", 0.1, 2), ("none", 0.1, None)], "source string, target_share double, max_repeats int")
    plan = mixing.weights(df, targets)
    p = {r.source: r for r in plan.collect()}
    assert {s for s, r in p.items() if r.short} == {"small", "none"} and p["small"].size == 100
    drawn = mixing.realise(df, plan)
    d = drawn.collect()
    assert all(r.copies <= p[r.source].max_repeats and r.n_tokens > 0 for r in d) and len({r.doc_id for r in d}) == len(d)
    for s in ("big", "mid"):
        copies = [r.copies for r in d if r.source == s]
        got = sum(r.n_tokens * r.copies for r in d if r.source == s)
        assert max(copies) - min(copies) <= 1 and 0 <= p[s].weight * p[s].budget - got < 60
    rep = {r.source: r for r in mixing.report(drawn, plan).collect()}
    assert set(rep) == set(p) and math.isclose(sum(r.actual_share for r in rep.values()), 1) and rep["none"].tokens == 0 and rep["small"].most_copies == 2
    assert sorted(map(tuple, d)) == sorted(map(tuple, mixing.realise(df.repartition(5), plan).collect()))


def test_mix_of_nothing_and_without_targets(spark):
    targets = spark.createDataFrame([("a", 1.0, 1)], "source string, target_share double, max_repeats int")
    plan = mixing.weights(docs(spark, []), targets)
    assert mixing.realise(docs(spark, []), plan).count() == 0 and mixing.report(mixing.realise(docs(spark, []), plan), plan).first().actual_share == 0
    df = docs(spark, [(1, 90, "a", None, None, ""), (2, 10, "b", None, None, "")])
    w = {r.source: r.weight for r in mixing.weights(df, wanted_entropy=math.log(2)).collect()}
    assert math.isclose(w["a"], 0.5, abs_tol=1e-3)


# quality

WORDS = {"en": frozenset("the of and to a in is it that for on with as was at be this have from not".split()), "de": frozenset("der die und in den von zu das mit sich".split())}
SHARES = [
    ("The pump was cold and it is not the cause of this.", 0),
    ("Same problem here since 32 days.", 0),
    ("- valve\n- old pump (3)\n- gauge\n- filter", 1),
    ("a;b;c\n1;2;3\n4;5;6", 1),
    ("| pump | 3.5 |\n| well | n/a |", 1),
    ("    at a.b.c(d.src:12)\n    at e.f(g.src:3)", 1),
    ("http://x.test/a?b=2\nhttp://y.test/c", 1),
    ("best cheap pump free valve buy now top gauge\nbuy cheap free", 1),
    ("dc 19 64 a7 1e fb\ne9 ec f8 e4 16 4a", 1),
    ("This is the code that I have:\n\n```\nxx yy zz\n```\n", 0),
    ("for f in a/*.csv; do wc -l \"$f\"; done\nexport A=3\nlet x = new Map(); x.set('a', 1);", 0),
]


@pytest.mark.parametrize("text,share", SHARES)
def test_share_of_other_lines(text, share):
    assert (quality.statistics(text, WORDS)[-1] > 0.5) == bool(share)


def test_statistics_of_odd_texts():
    assert quality.statistics("x" * 200000, WORDS)[1] == 1
    assert len(quality.statistics("。\n\n1", {})) == 3 + len(quality.STATS)


def test_distance_against_numpy(spark):
    rng = np.random.default_rng(0)
    prose = ["The pump was " + " ".join(rng.choice(["cold", "and", "it", "is", "the", "valve", "not", "of"], 30)) + "." for _ in range(300)]
    rows = [(i, t, 5, "x") for i, t in enumerate([*prose, "1;2;3\n4;5;6\n7;8;9", None, "", " "])]
    df = spark.createDataFrame(rows, "doc_id int, text string, n_words int, distance string")
    stats = quality.measured(df, WORDS)
    model = quality.fit_prose(stats)
    got = {r.doc_id: r for r in quality.judged(stats, model).collect()}
    assert got[300].outlier and got[300].other_share == 1 and sum(got[i].outlier for i in range(300)) < 60
    assert all(got[i].distance is None and not got[i].outlier for i in (301, 302, 303))
    mean, inverse = model["en"]
    for i in (3, 300):
        x = np.array([got[i][s] for s in quality.STATS]) - mean
        assert math.isclose(x @ inverse @ x, got[i].distance, rel_tol=1e-6)
        assert math.isclose(sum(got[i][f"c_{s}"] for s in quality.STATS), got[i].distance, rel_tol=1e-6)


def test_no_documents(spark):
    stats = quality.measured(spark.createDataFrame([], "doc_id int, text string"), WORDS)
    assert quality.judged(stats, quality.fit_prose(stats)).count() == 0


# queries


def test_queries(spark):
    for name, f in P.QUERIES.items():
        assert f(spark, DATA).count() >= 0, name
    full = {r.doc_id for r in tokens.sized(spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")).where("n_tokens > 4096").collect()}
    assert {r.doc_id for r in P.p7_found(spark, DATA).collect()} == full


def test_verdicts_agree_with_readers(spark):
    folder = DATA.replace("0.001", "0.1")
    n = Counter()
    for r in P.p9_labels(spark, folder).collect():
        n[r.found == (r.label != "prose")] += r.n
    assert n[True] / sum(n.values()) > 0.93  # some labels are wrong
