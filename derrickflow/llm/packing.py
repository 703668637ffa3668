"""Filling sequences of fixed capacity with texts: conflict-constrained best fit.

Texts are dealt at random (by a hash of their id) to blocks of about block_tokens tokens (and no more than some BLOCK_DOCS texts), which are
packed independently and in parallel, texts with most copies first, then the longest. Within a block the open bins are kept in
order of residual capacity; each carries a bitmap of its sources and one of its duplicate clusters.
A text goes into the tightest bin that it fits and conflicts with in neither bitmap: the search
starts at the least sufficient residual and goes on to the next until a compatible bin is found.
"""

from __future__ import annotations

import bisect
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from derrickflow.session import materialise

CAPACITY, BLOCK_TOKENS, BLOCK_DOCS = 4096, 1 << 21, 1 << 17
#: Sources that share no sequence with another source: a mirror's texts are those of the other sources.
APART = ("scraped_mirror",)
PACKED = "doc_id long, piece int, sequence long, start long, n_tokens long"


def best_fit(sizes: np.ndarray, sources: list[int], clusters: list[tuple[int, ...]], capacity: int, apart: int = 0) -> tuple[list[int], list[int]]:
    """Bin of each item, and the residual of each bin. No item may exceed the capacity.

    sources: bit numbers; apart: bitmap of the sources that share a bin with no other source.
    clusters: the clusters of each item. Two items of a cluster share no bin, except where it has more
    members than the fewest bins that could hold all items: then each further such number of members is
    a cluster of its own, as otherwise the conflict alone would leave bins empty.
    """
    fewest = max(1, -(-int(sizes.sum()) // capacity))
    size_of = Counter(c for cs in clusters for c in cs)
    seen: Counter = Counter()
    bits: dict = {}
    # the more copies, the earlier: the smallest texts with conflicts would otherwise meet full bins only
    copies = [max((size_of[c] for c in cs), default=1) for cs in clusters]
    order = sorted(range(len(sizes)), key=lambda i: (-copies[i], -sizes[i], i))
    open_: list[tuple[int, int]] = []  # (residual, bin), ascending
    has_source: list[int] = []
    has_cluster: list[int] = []
    where, left = [0] * len(sizes), []
    for i in order:
        size, source, mine = int(sizes[i]), 1 << sources[i], 0
        for c in clusters[i]:
            if size_of[c] > 1:
                key = (c, seen[c] // fewest)
                seen[c] += 1
                mine |= 1 << bits.setdefault(key, len(bits))
        at = bisect.bisect_left(open_, (size, -1))
        while at < len(open_):
            b = open_[at][1]
            others = has_source[b] & ~source
            if not has_cluster[b] & mine and not (others and (source & apart or others & apart)):
                break
            at += 1
        if at < len(open_):
            residual, b = open_.pop(at)
        else:
            residual, b = capacity, len(left)
            left.append(capacity)
            has_source.append(0)
            has_cluster.append(0)
        has_source[b] |= source
        has_cluster[b] |= mine
        where[i], left[b] = b, residual - size
        if left[b]:
            bisect.insort(open_, (left[b], b))
    return where, left


def question_groups(docs: DataFrame) -> DataFrame:
    """doc_id, asked: the least document that a document is linked with by duplicate_of, over any number of links, for the linked ones.

    Connected components by alternating large and small stars: every round joins neighbours to the least of them, on a table of links
    that is no larger than that of the documents that name another; chains and rings of any length end after few rounds.
    """
    link = docs.where("duplicate_of is not null and duplicate_of <> doc_id").select(F.col("doc_id").cast("long").alias("a"), F.col("duplicate_of").cast("long").alias("b"))
    edges, before = materialise(link.distinct(), "links"), None
    while True:
        # large star: greater neighbours to the least of the neighbourhood; small star: the others too
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b")
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        least = down.groupBy("a").agg(F.min("b").alias("least"))
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b").unionByName(least.select("a", F.col("least").alias("b")))
        edges = materialise(small.distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("b").alias("doc_id"), F.col("b").alias("asked")).distinct()
    return edges.select(F.col("a").alias("doc_id"), F.col("b").alias("asked")).unionByName(roots)


def conflicts(packed: DataFrame, docs: DataFrame) -> DataFrame:
    """How many pairs of texts of one group share a sequence, as their group has more members than there are sequences: n_pairs (0 where none need to)."""
    group = F.explode(F.array(F.struct(F.lit("text").alias("kind"), F.col("cluster").cast("long").alias("c")), F.struct(F.lit("asked").alias("kind"), F.col("asked").alias("c"))))
    of = docs.select("doc_id", "cluster").join(question_groups(docs), "doc_id", "left").select("doc_id", group.alias("g")).where("g.c is not null")
    last = packed.where("sequence is not null").groupBy("doc_id").agg(F.max_by("sequence", "piece").alias("sequence"))
    n = of.join(last, "doc_id").groupBy("sequence", "g").agg(F.count("*").alias("n"))
    return n.agg(F.coalesce(F.sum(F.expr("n * (n - 1) div 2")), F.lit(0)).alias("n_pairs"))


def pack(docs: DataFrame, capacity: int = CAPACITY, block_tokens: int = BLOCK_TOKENS, apart: tuple[str, ...] = APART, seed: int = 11) -> DataFrame:
    """The sequence of every document: doc_id, piece, sequence, start (token), n_tokens; a row per piece.

    docs: doc_id (unique), n_tokens, source, cluster (a hash of the text, or null), duplicate_of (or null); other
    columns are ignored. A text stays whole unless it exceeds the capacity: it is then cut into full
    sequences and a rest, which is packed like a text. A text of 0 (or null) tokens has one piece of no sequence.
    Documents with equal cluster, or linked by duplicate_of over any number of documents, conflict; a null
    source is a source of its own. No documents give no rows.
    """
    spark = docs.sparkSession
    total, n = docs.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)), F.count("*")).first()
    blocks = max(1, -(-total // block_tokens), -(-n // BLOCK_DOCS))
    item = docs.select("doc_id", F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"), "source", F.col("cluster").cast("long").alias("cluster"), "duplicate_of")
    item = item.join(question_groups(docs), "doc_id", "left").drop("duplicate_of")

    def fill(key, b):
        b = b.sort_values("doc_id", kind="stable").reset_index(drop=True)
        n, block = b["n_tokens"].to_numpy(np.int64), int(key[0])
        whole, rest = n // capacity, n % capacity
        names, code = {}, []
        for s in b["source"]:
            code.append(names.setdefault(s if isinstance(s, str) else None, len(names)))
        lonely = sum(1 << k for s, k in names.items() if s in apart)
        groups = []
        for c, d in zip(b["cluster"], b["asked"]):
            groups.append(tuple(x for x in (None if pd.isna(c) else ("text", int(c)), None if pd.isna(d) else ("asked", int(d))) if x))
        some = np.flatnonzero(rest > 0)
        where, left = best_fit(rest[some], [code[i] for i in some], [groups[i] for i in some], capacity, lonely)
        base, rows, full = block << 32, [], len(left)
        at = dict(zip(some.tolist(), where))
        for i, doc in enumerate(b["doc_id"].tolist()):
            for k in range(int(whole[i])):
                rows.append((doc, k, base + full, k * capacity, capacity))
                full += 1
            if i in at:
                rows.append((doc, int(whole[i]), base + at[i], int(whole[i]) * capacity, int(rest[i])))
            elif not whole[i]:
                rows.append((doc, 0, None, 0, 0))
        out = pd.DataFrame(rows, columns=["doc_id", "piece", "sequence", "start", "n_tokens"])
        out["sequence"] = out["sequence"].astype("Int64")
        return out

    # a fixed number of partitions: the blocks are small for AQE, which would put them all into few tasks
    dealt = item.withColumn("block", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(blocks)))
    tasks = 2 * max(blocks, spark.sparkContext.defaultParallelism) if blocks > 1 else 1
    return dealt.repartition(tasks, "block").groupBy("block").applyInPandas(fill, PACKED)
