"""Mixing sources to target weights: temperature mixing under repetition limits.

Shares are exponentiated and normalised. Without targets the exponent of the sources' own token
shares is bisected until the mixture has a wanted entropy. With targets, which no exponent of the own
shares can give, the exponent of the target
shares is bisected until the weights, each held to what its source yields at most (max_repeats times
its tokens), sum to 1; it is 1, and the weights are the targets, if no source falls short. The weights
are realised as a budget of tokens per source: whole rounds over all its documents, then texts in
order of a pseudo-random permutation, in blocks, that fit the rest of the budget.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from derrickflow.session import materialise

#: Blocks of a source's permutation: those before the budget's end are taken whole, only the one it falls in is put in order.
BLOCKS = 4096
#: Exponents tried at once, by one aggregation, when an exponent is searched over a table of sources.
GRID = 32


def entropy(p: list[float]) -> float:
    return -sum(x * math.log(x) for x in p if x > 0)


def tempered(shares: list[float], exponent: float) -> list[float]:
    """Shares to the power of exponent, normalised; zero shares stay zero."""
    w = [s**exponent if s > 0 else 0.0 for s in shares]
    total = sum(w)
    return [x / total for x in w] if total else w


def exponent_for_entropy(shares: list[float], wanted: float, rounds: int = 80) -> float:
    """The exponent in 0..64 at which tempered shares have the wanted entropy (the nearer end if none has)."""
    low, high = 0.0, 64.0
    for _ in range(rounds):
        mid = (low + high) / 2
        low, high = (mid, high) if entropy(tempered(shares, mid)) > wanted else (low, mid)
    return (low + high) / 2


def _shares(sizes: DataFrame) -> DataFrame:
    total = sizes.agg(F.sum("size")).first()[0] or 1
    return sizes.withColumn("share", F.coalesce(F.col("size"), F.lit(0)) / total)


def _power(e: float):
    return F.when(F.col("share") > 0, F.pow("share", F.lit(e))).otherwise(0.0)


def exponent_over(shares: DataFrame, wanted: float, rounds: int = 6) -> float:
    """exponent_for_entropy of a table of any number of shares: every round narrows the range to a GRID-th by one aggregation."""
    low, high = 0.0, 64.0
    for _ in range(rounds):
        tried = [low + (high - low) * i / GRID for i in range(GRID + 1)]
        sums = [F.sum(_power(e)) for e in tried] + [F.sum(F.when(F.col("share") > 0, _power(e) * F.log("share"))) for e in tried]
        row = shares.agg(*[c.alias(f"c{i}") for i, c in enumerate(sums)]).first()
        z, t = row[: GRID + 1], row[GRID + 1 :]
        # the entropy falls as the exponent grows
        above = [i for i, e in enumerate(tried) if z[i] and math.log(z[i]) - e * t[i] / z[i] > wanted]
        at = min(max(above, default=0), GRID - 1)
        low, high = tried[at], tried[at + 1]
    return (low + high) / 2


def limited_weights(targets: list[float], most: list[float], rounds: int = 100) -> tuple[list[float], float]:
    """Weights min(most, target**exponent) that sum to 1, and the exponent (at most 1).

    If all that the sources yield is less than 1, each has its most, and the exponent is 0.
    """
    held = lambda e: [min(m, t**e) if t > 0 else 0.0 for t, m in zip(targets, most)]
    if sum(held(1.0)) >= 1 - 1e-12:
        return held(1.0), 1.0
    if sum(held(0.0)) <= 1:
        return held(0.0), 0.0
    low, high = 0.0, 1.0
    for _ in range(rounds):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(held(mid)) > 1 else (low, mid)
    w = held((low + high) / 2)
    return [x / sum(w) for x in w], (low + high) / 2


def weights(docs: DataFrame, targets: DataFrame | None = None, wanted_entropy: float | None = None, budget: int | None = None) -> DataFrame:
    """A row per source: source, target_share, max_repeats, size (tokens taken once), most (share it can yield), short, weight, exponent, budget (tokens of the mix).

    docs: source, n_tokens. budget: tokens of the mix, by default the size of all documents taken once (those without
    target or source too). short: its documents, max_repeats times each, are smaller than its target. A target without documents has size 0; a null max_repeats is no limit.
    Without targets every source is mixed by temperature to wanted_entropy (default: that of its own shares), without limit;
    the sources then stay a table. With them one row per target source reaches the driver.
    """
    spark = docs.sparkSession
    sizes = docs.where("source is not null").groupBy("source").agg(F.sum("n_tokens").alias("size"))
    total = docs.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    budget = total if budget is None else budget
    schema = "source string, target_share double, max_repeats int, size long, most double, short boolean, weight double, exponent double, budget long"
    if targets is None:
        shares = _shares(materialise(sizes, "sources"))
        e = 1.0 if wanted_entropy is None else exponent_over(shares, wanted_entropy)
        z = shares.agg(F.sum(_power(e))).first()[0] or 1.0
        none = {"target_share": F.lit(None).cast("double"), "max_repeats": F.lit(None).cast("int"), "most": F.lit(None).cast("double"), "short": F.lit(False), "exponent": F.lit(e), "budget": F.lit(budget)}
        made = shares.withColumns(none | {"weight": _power(e) / z, "size": F.coalesce("size", F.lit(0))})
        return made.select(*[x.split()[0] for x in schema.split(", ")])
    wanted = targets.where("source is not null").groupBy("source").agg(F.max("target_share").alias("target_share"), F.min("max_repeats").alias("max_repeats"))
    rows = sorted(wanted.join(sizes, "source", "left").collect(), key=lambda r: r.source)
    target = [float(r.target_share or 0) for r in rows]
    most = [math.inf if r.max_repeats is None else r.max_repeats * (r["size"] or 0) / budget if budget else 0.0 for r in rows]
    most = [0.0 if not r["size"] else m for r, m in zip(rows, most)]
    w, e = limited_weights(target, most)
    made = [(r.source, t, r.max_repeats, int(r["size"] or 0), m if m < math.inf else None, m * budget < t * budget, x, e, budget) for r, t, m, x in zip(rows, target, most, w)]
    return spark.createDataFrame(made, schema)


def realise(docs: DataFrame, plan: DataFrame, seed: int = 5) -> DataFrame:
    """How often every document is drawn: doc_id, source, n_tokens, copies (documents drawn at least once).

    Of the last round over a source the documents are taken in order of a hash of their id as long as
    they fit the budget (those that don't are passed over), so no document has more than one copy more than another, nor
    more than max_repeats. Documents of no tokens, source or weight aren't drawn.
    """
    quota = plan.where("size > 0 and weight > 0").select(
        "source", F.col("max_repeats"), F.floor(F.col("weight") * F.col("budget") / F.col("size") + 1e-9).cast("long").alias("rounds"), (F.col("weight") * F.col("budget")).alias("quota"), "size"
    )
    quota = quota.withColumn("rest", F.greatest(F.lit(0.0), F.col("quota") - F.col("rounds") * F.col("size")))
    order = F.xxhash64("doc_id", F.lit(seed))
    # one row per source, bounded by the target table: read from the plan's own local rows
    item = docs.where("n_tokens > 0").select("doc_id", "source", "n_tokens").join(quota, "source")
    item = item.withColumn("place", F.struct(F.pmod(order, F.lit(BLOCKS)).alias("block"), order.alias("order"), "doc_id"))
    stretches = _stretches(item, quota.where(F.coalesce(F.col("max_repeats"), F.lit(1 << 30)) > F.col("rounds")))
    fits = lambda s: (s.after.isNull() | (F.col("place") > s.after)) & (s.until.isNull() | (F.col("place") < s.until)) & (F.col("n_tokens") <= s.rest)
    extra = F.when(F.exists("stretches", fits), 1).otherwise(0)
    drawn = item.join(stretches, "source", "left").withColumn("copies", (F.col("rounds") + extra).cast("long"))
    return drawn.where("copies > 0").select("doc_id", "source", "n_tokens", "copies")


def _stretches(item: DataFrame, quota: DataFrame) -> DataFrame:
    """Where the last round takes texts: source, stretches, of which each has two places (null: the ends) and the rest of the budget it began with.

    Between its places a stretch takes every text of at most its rest; it ends at the first of these that no longer fits in what it has left.
    Every round passes over one text of each source by one aggregation; the rest after it is less than that text, so rounds are few.
    """
    kind = item.schema["place"].dataType.simpleString()
    now = materialise(quota.where("rest >= 1").select("source", "rest", F.lit(None).cast(kind).alias("after")), "rest")
    made = []
    while True:
        left = item.drop("rest").join(now, "source").where("n_tokens <= rest and (after is null or place > after)")
        left = left.select("source", "n_tokens", "rest", "place", "place.block")
        sums = left.groupBy("source", "block").agg(F.sum("n_tokens").alias("t"))
        before = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("before", F.coalesce(F.sum("t").over(before), F.lit(0)))
        # blocks that end before the budget's rest go in whole, those that begin after it stay out; only one block of a source is put in order
        edge = left.join(sums, ["source", "block"]).where("before <= rest and before + t > rest")
        within = Window.partitionBy("source", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
        edge = edge.withColumn("upto", F.col("before") + F.sum("n_tokens").over(within))
        over = edge.where("upto > rest").groupBy("source").agg(F.min(F.struct("place", (F.col("upto") - F.col("n_tokens")).alias("used"))).alias("m"))
        over = over.select("source", F.col("m.place").alias("until"), F.col("m.used").alias("used"))
        made.append(materialise(now.join(over, "source", "left").select("source", "after", "until", "rest", (F.col("rest") - F.col("used")).alias("still")), "stretches"))
        now = made[-1].where("until is not null and still >= 1").select("source", F.col("still").alias("rest"), F.col("until").alias("after"))
        if now.isEmpty():
            break
    every = made[0]
    for m in made[1:]:
        every = every.unionByName(m)
    return every.groupBy("source").agg(F.collect_list(F.struct("after", "until", "rest")).alias("stretches"))


def report(drawn: DataFrame, plan: DataFrame) -> DataFrame:
    """Target, weight and actual share of the mix's tokens, per source of the plan (0 where nothing is drawn)."""
    got = drawn.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"), F.max("copies").alias("most_copies"))
    rows = plan.join(got, "source", "left").select("source", "target_share", "short", "weight", F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("most_copies", F.lit(0)).alias("most_copies"))
    every = F.sum("tokens").over(Window.partitionBy(F.lit(1)))  # one row per source of the target table
    return rows.withColumn("actual_share", F.coalesce(F.try_divide("tokens", every), F.lit(0.0)))


def shortfalls(drawn: DataFrame, docs: DataFrame, plan: DataFrame) -> DataFrame:
    """Sources of the plan whose part of the realised mix is smaller than their target of the budget, though it has all their documents max_repeats times.

    Columns: source, tokens (of the mix), wanted (tokens of the target). A target source without documents falls short of any target above 0.
    """
    full = F.count_if(F.col("copies") == F.col("max_repeats")).alias("n_full")
    got = drawn.join(plan.select("source", "max_repeats"), "source").groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"), full)
    there = docs.where("n_tokens > 0").groupBy("source").agg(F.count("*").alias("n_docs"))
    rows = plan.join(got, "source", "left").join(there, "source", "left").fillna(0, ["tokens", "n_full", "n_docs"])
    rows = rows.withColumn("wanted", F.col("target_share") * F.col("budget"))
    return rows.where("tokens < wanted and (n_full = n_docs or max_repeats <= 0)").select("source", "tokens", "wanted")
