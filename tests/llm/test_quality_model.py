import numpy as np
import pyarrow as pa
import pytest

from derrickflow.llm import quality

WORDS = {"en": frozenset("the of and to a in is it that for on with as was at be this have from not".split()), "de": frozenset("der die und in den von zu das mit sich".split())}


def frame(spark, named):
    rows = [(k, 10, *map(float, x)) for k, m in named for x in m]
    return spark.createDataFrame(rows, "language string, n_words long, " + ", ".join(f"{n} double" for n in quality.STATS))


def test_few_documents_are_drawn_towards_all(spark):
    """The estimate of a language moves from that of all to its own as its documents grow in number: there is no switch."""
    rng = np.random.default_rng(1)
    k = len(quality.STATS)
    shift = np.full(k, 0.3)
    at = []
    for n in (0, 3, 50, 2000):
        en, de = rng.normal(0, 0.1, (4000, k)), rng.normal(0, 0.1, (n, k)) + shift
        en[:, -1], de[:, -1] = abs(en[:, -1]) / 50, abs(de[:, -1]) / 50
        model = quality.fit_prose(frame(spark, [("en", en), ("de", de)]))
        assert {"en", ""} <= set(model) and ("de" in model) == (n > 0)
        if n:
            at.append(model["de"][0][0] / 0.3)
    assert at[0] < 0.15 and 0.3 < at[1] < 0.7 and at[2] > 0.9


def test_the_distance_decides():
    """Neither of two texts of which three tenths are a table is an outlier, both of the ones with a longer table are; another model, another verdict."""
    prose = "The pump was cold and it is not the cause of this, as was said at the site.\n"
    table = "| pump | 3.5 | 88.1 |\n"
    rng = np.random.default_rng(2)
    some = [prose * int(n) + table * int(t) for n, t in zip(rng.integers(3, 12, 400), rng.integers(0, 2, 400))]
    _, _, _, x = quality.batch_statistics(pa.array([*some, prose * 7 + table * 4, prose * 2 + table * 30]), WORDS)
    mean, cov = x[:400].mean(0), np.cov(x[:400].T) + quality.FLOOR**2 * np.eye(x.shape[1])
    verdict = lambda inverse: [bool((r - mean) @ inverse @ (r - mean) > quality.cut_of(mean, inverse)) for r in x[400:]]
    assert verdict(np.linalg.inv(cov)) == [False, True]
    assert verdict(np.diag([1e9] * (x.shape[1] - 1) + [1.0])) == [True, True]


def test_batches_and_single_texts_agree(spark):
    texts = ["The pump is cold.\n\n- valve\n- gauge", "x;y;z\n1;2;3", "Das ist mit den Pumpen und das Ventil in der Halle.", "a", "…", " x", "l'eau – d'été"]
    language, n_words, n_lines, x = quality.batch_statistics(pa.array(texts), WORDS)
    for i, t in enumerate(texts):
        one = quality.statistics(t, WORDS)
        assert one[:3] == (language[i], n_words[i], n_lines[i]) and np.allclose(one[3:], x[i])
    assert language[2] == "de" and not np.isnan(x).any()
    rows = [(i, t) for i, t in enumerate([*texts, None, "", " \n "])]
    got = {r.doc_id: r for r in quality.measured(spark.createDataFrame(rows, "doc_id int, text string"), WORDS).collect()}
    assert all(np.isclose(got[i].other_share, x[i][-1]) for i in range(len(texts))) and all(got[i].language is None for i in range(len(texts), len(rows)))


def test_long_lines_take_linear_time():
    import time

    t = time.time()
    quality.statistics("a" + " " * 200_000 + "b\n" + "x = " * 100_000 + "\n" + "(" * 200_000, WORDS)
    assert time.time() - t < 5


def test_more_words_than_a_list_has(spark):
    words = spark.range(11).selectExpr("'en' as lang", "cast(id as string) as word", "1 as freq_rank")
    assert len(quality.frequent_words(words, 11)["en"]) == 11
    with pytest.raises(ValueError):
        quality.frequent_words(words, 10)
