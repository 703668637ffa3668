"""Per-document text statistics and robust distance from the prose of the document's language.

Statistics are taken over the whole text, for a whole batch of texts at once. For each language (told by its frequent
function words, not by the lang column) mean and covariance of prose are estimated robustly: from
medians and absolute deviations first, then from the documents near the current estimate, as
often as `rounds` says, by sums over all documents; languages with few documents are drawn towards the estimate of all.
The squared Mahalanobis distance is a sum of one contribution per statistic. A document is an outlier if its distance is greater than
that of a text which is average in all but one statistic: half of it lies in lines of no running text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

STATS = (
    "log_words", "mean_word_length", "symbol_ratio", "digit_ratio", "inner_capitals", "punctuated_lines", "common_words", "marked_lines", "log_line_length",
    "log_longest_token", "sign_ratio", "separator_ratio", "like_last_line", "mean_token_length", "sign_lines", "other_share",
)
#: Statistics are compared in units of at least this: very regular prose would make any difference an outlier.
FLOOR = 0.01
#: First cut, per statistic, about the medians.
FIRST = 3.0
#: As many documents of all languages stand behind every language's estimate.
SHRINK = 50
#: The share of other lines at which a text that is average otherwise becomes an outlier.
HALF = 0.5
TEXT_STATS = "language string, n_words long, n_lines long, " + ", ".join(f"{s} double" for s in STATS)
#: Bytes of text that are measured at once.
PIECE = 8 << 20

#: Patterns, all of which are matched in linear time.
LETTER, DIGIT, INNER, SIGN, SEPARATOR = r"\p{L}", r"\p{N}", r"\p{Ll}\p{Lu}", r"[{}=<>$_`\\]|;\s*(?:\n|$)", r"[|\t;,]"
MARK = r"^\s*(?:[-*•+]\s|\[[ xX]?\]\s|\(?(?:\d+|[A-Za-z])[.)]\s)"
STOP, SENTENCE_STOP = r"[.!?…:][\"')\]”»]*\s*$", r"[.!?…][\"')\]”»]*\s*$"
EDGES = ".,;:!?()[]{}\"«»¿¡…”“*_"


def _counts(texts: pa.Array, pattern: str) -> np.ndarray:
    return pc.count_substring_regex(texts, pattern).to_numpy(zero_copy_only=False).astype(float)


def _sums(x: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of the consecutive stretches of x that end at ends (0 for empty ones)."""
    total = np.r_[0.0, np.cumsum(x, dtype=float)]
    return total[ends] - total[np.r_[0, ends[:-1]]]


def batch_statistics(texts: pa.Array, frequent: dict[str, frozenset[str]]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """language, n_words, n_lines and a matrix of STATS of some texts, none of which is null or blank.

    A line is of running text if most of its tokens are plain words and enough of them are function words of the
    language, or if it ends like a sentence and has four plain words and more. Of the other lines those dense in the signs of programs
    count as sign_lines, the rest as other_share (in characters that are no blanks).
    """
    texts = texts.cast(pa.large_string())
    n = len(texts)
    split = pc.split_pattern(pc.replace_substring_regex(texts, "['’]", " "), "\n")
    lines, of = split.flatten(), pc.list_parent_indices(split).to_numpy()
    full = pc.not_equal(pc.utf8_trim_whitespace(lines), "")
    lines, of = lines.filter(full), of[full.to_numpy(zero_copy_only=False)]
    split = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(lines))
    tokens, line = split.flatten(), pc.list_parent_indices(split).to_numpy()
    m = len(lines)
    last_line, last_token = np.searchsorted(of, np.arange(n), "right"), np.searchsorted(line, np.arange(m), "right")
    token_end = np.r_[0, last_token][last_line]
    size = pc.utf8_length(tokens).to_numpy(zero_copy_only=False).astype(float)
    word = pc.utf8_lower(pc.utf8_trim(tokens, EDGES))
    plain = pc.utf8_is_alpha(pc.replace_substring(word, "-", "")).to_numpy(zero_copy_only=False)
    # each different word is looked up once
    coded = pc.dictionary_encode(word)
    code = coded.indices.to_numpy(zero_copy_only=False)
    languages = sorted(frequent, key=lambda k: (k != "en", k)) or ["en"]
    known = [pc.is_in(coded.dictionary, pa.array(sorted(frequent.get(k, ())), pa.large_string())).to_numpy(zero_copy_only=False)[code] if len(code) else np.zeros(0, bool) for k in languages]
    hits = np.array([_sums(k, token_end) for k in known])
    best = hits.argmax(0)
    common = np.choose(best[of][line], known) if len(line) else np.zeros(0, bool)

    chars, n_tokens, n_plain, n_common = (_sums(x, last_token) for x in (size, np.ones(len(line)), plain, common))
    at = lambda pattern: pc.match_substring_regex(lines, pattern).to_numpy(zero_copy_only=False)
    signs = _counts(lines, SIGN)
    running = (n_plain >= 0.6 * n_tokens) & (n_common >= 0.2 * n_tokens) & (n_common > 0)
    running |= at(SENTENCE_STOP) & (n_plain >= 4) & (n_plain >= 0.7 * n_tokens) & ~at(MARK)
    code_like = ~running & (signs >= 0.06 * chars)
    alike = np.r_[False, (n_tokens[1:] == n_tokens[:-1]) & (of[1:] == of[:-1])] if m else np.zeros(0, bool)

    by = lambda x: _sums(x, last_line)
    n_lines, total, words, spread = by(np.ones(m)), np.maximum(by(chars), 1), by(n_plain), by(n_tokens)
    letters, digits = _counts(texts, LETTER), _counts(texts, DIGIT)
    longest = np.zeros(n)
    np.maximum.at(longest, of[line], size)
    per = lambda x, d: x / np.maximum(d, 1)
    stats = (
        np.log1p(words), per(_sums(size * plain, token_end), words), np.maximum(total - letters - digits, 0) / total, digits / total, per(_counts(texts, INNER), words),
        per(by(at(STOP)), n_lines), per(hits.max(0), words), by(chars * at(MARK)) / total, np.log1p(per(total, n_lines)),
        np.log1p(longest), _counts(texts, SIGN) / total, _counts(texts, SEPARATOR) / total, by(chars * alike) / total, per(total, spread),
        by(chars * code_like) / total, by(chars * ~(running | code_like)) / total,
    )
    return [languages[k] for k in best], words.astype(np.int64), n_lines.astype(np.int64), np.column_stack(stats)


def statistics(text: str, frequent: dict[str, frozenset[str]]) -> tuple:
    """language, n_words, n_lines and STATS of one text that isn't blank."""
    language, n_words, n_lines, stats = batch_statistics(pa.array([text]), frequent)
    return (language[0], int(n_words[0]), int(n_lines[0]), *map(float, stats[0]))


def measured(docs: DataFrame, frequent: dict[str, frozenset[str]], text: str = "text") -> DataFrame:
    """docs without its text, with TEXT_STATS, which replace columns of these names. Null, empty and blank texts have null statistics."""
    names = [x.split()[0] for x in TEXT_STATS.split(", ")]
    rest = [c for c in docs.columns if c != text and c not in names]
    schema = StructType(list(docs.select(*rest).schema.fields))
    for x in TEXT_STATS.split(", "):
        schema = schema.add(*x.split())

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            rows = max(1, whole.num_rows * PIECE // max(1, whole.column(text).nbytes))
            for b in (whole.slice(i, rows) for i in range(0, whole.num_rows, rows)):
                texts = b.column(text).cast(pa.large_string())
                has = pc.fill_null(pc.not_equal(pc.utf8_trim_whitespace(texts), ""), False)
                at = np.flatnonzero(has.to_numpy(zero_copy_only=False))
                back = np.full(b.num_rows, -1)
                back[at] = np.arange(len(at))
                back = pa.array(np.where(back < 0, None, back), pa.int64())
                language, n_words, n_lines, stats = batch_statistics(texts.filter(has), frequent)
                made = [pa.array(language, pa.string()), pa.array(n_words, pa.int64()), pa.array(n_lines, pa.int64()), *map(pa.array, stats.T)]
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in rest), *(x.take(back) for x in made)], names=[*rest, *names])

    return docs.select(*rest, text).mapInArrow(measure, schema)


def frequent_words(words: DataFrame, most: int = 1 << 20) -> dict[str, frozenset[str]]:
    """Function words by language. A table of more than `most` words is refused: it is no list of function words, and would not fit the driver."""
    rows = words.where("lang is not null and word is not null").select("lang", "word").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} function words")
    langs = sorted({r.lang for r in rows})
    return {k: frozenset(r.word.lower() for r in rows if r.lang == k) for k in langs}


def cut_of(mean: np.ndarray, inverse: np.ndarray) -> float:
    """The squared distance of a text that is average in all statistics but other_share, which is HALF."""
    return float((HALF - mean[-1]) ** 2 * inverse[-1, -1])


def fit_prose(stats: DataFrame, rounds: int = 5) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Per language, and for all ("") the mean and inverse covariance of prose.

    Every round is one aggregation of sums over all documents; the driver gets one row per language of
    frequent_words. An estimate from n documents has the weight n beside SHRINK of that of all languages. The medians of the first round may be off by
    a rank of 1 in 10,000, which the rounds that follow make up for.
    """
    have = stats.where("n_words is not null")
    both = have.withColumn("of", F.explode(F.array(F.col("language"), F.lit(""))))
    middle = both.groupBy("of").agg(*[F.percentile_approx(s, 0.5, 10000).alias(s) for s in STATS]).collect()
    centre = {r.of: np.array([r[s] for s in STATS]) for r in middle}
    spread_of = lambda s: F.percentile_approx(F.abs(F.col(s) - _pick(centre, STATS.index(s))), 0.5, 10000).alias(s)
    spread = both.groupBy("of").agg(*[spread_of(s) for s in STATS]).collect()
    k, model, cuts = len(STATS), {}, {}
    for r in spread:
        scale = np.maximum([1.4826 * r[s] for s in STATS], FLOOR)
        model[r.of], cuts[r.of] = (centre[r.of], np.diag(1 / scale**2)), FIRST * k
    for _ in range(rounds):
        sums = {of: np.zeros(1 + k + k * k) for of in model}
        for r in _near(both.select("of", *STATS), model, cuts).groupBy("of", "k").agg(F.sum("value").alias("value")).collect():
            sums[r.of][r.k] = r.value
        if not sums or not sums[""][0]:
            break
        moments = lambda v: (v[0], v[1 : k + 1] / max(1, v[0]), v[k + 1 :].reshape(k, k) / max(1, v[0]))
        _, all_mean, all_square = moments(sums[""])
        all_cov = all_square - np.outer(all_mean, all_mean)
        for of, v in sums.items():
            n, mean, square = moments(v)
            own = n / (n + SHRINK) if of else 1.0
            cov = own * (square - np.outer(mean, mean)) + (1 - own) * all_cov
            mean = own * mean + (1 - own) * all_mean
            model[of] = mean, np.linalg.inv(cov + FLOOR**2 * np.eye(k))
            cuts[of] = cut_of(*model[of])
    return model


def _pick(centre: dict[str, np.ndarray], i: int):
    out = F.lit(float(centre[""][i])) if "" in centre else F.lit(0.0)
    for k, v in centre.items():
        if k:
            out = F.when(F.col("of") == k, float(v[i])).otherwise(out)
    return out


def _near(both: DataFrame, model: dict, cuts: dict[str, float]) -> DataFrame:
    """Count, sums and sums of products of the rows within the cut of their estimate: of, k, value, partial per batch."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x, of = b[list(STATS)].to_numpy(float), b["of"].to_numpy(object)
            for name in set(of) & set(model):
                mean, inverse = model[name]
                mine = x[of == name]
                d = mine - mean
                mine = mine[((d @ inverse) * d).sum(1) <= cuts[name]]
                v = np.concatenate([[len(mine)], mine.sum(0), (mine.T @ mine).ravel()])
                yield pd.DataFrame({"of": name, "k": np.arange(len(v), dtype=np.int32), "value": v})

    return both.mapInPandas(add, "of string, k int, value double")


def judged(stats: DataFrame, model: dict[str, tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """stats with distance (squared Mahalanobis), c_<statistic> (contributions, which sum to it), and outlier (distance over the language's cut).

    Documents without statistics have null distance and are no outliers. Columns of these names are replaced.
    """
    own = {"distance", "outlier", *[f"c_{s}" for s in STATS]}
    stats = stats.select(*[c for c in stats.columns if c not in own])
    schema = StructType(list(stats.schema.fields)).add("distance", "double")
    for s in STATS:
        schema = schema.add(f"c_{s}", "double")
    schema = schema.add("outlier", "boolean")

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x, out, cut = b[list(STATS)].to_numpy(float), np.full((len(b), len(STATS)), np.nan), np.full(len(b), np.inf)
            lang = b["language"].to_numpy(object)
            for k in set(x for x in lang if isinstance(x, str)):
                at = lang == k
                mean, inverse = model.get(k) or model[""]
                d = x[at] - mean
                out[at], cut[at] = d * (d @ inverse), cut_of(mean, inverse)
            total = out.sum(1)
            cols = pd.DataFrame(np.column_stack([total, out]), columns=["distance", *[f"c_{s}" for s in STATS]], index=b.index)
            yield pd.concat([b, cols, pd.Series(total > cut, b.index, name="outlier")], axis=1)

    scored = stats.mapInPandas(judge, schema)
    return scored.withColumn("distance", F.when(~F.isnan("distance"), F.col("distance")))
