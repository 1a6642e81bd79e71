"""N-gram Jaccard join by token-combination prefixes.

A document is its set of word shingles, ordered by frequency, rare first. Two sets of similarity t
or more share at least k tokens among the first n - ceil(t n) + k of each. So rare tokens are indexed
alone, from the prefix for k = 1; and if the first token that two sets share is of the frequent
class, so is the second, and both lie in the prefixes for k = 2: pairs of frequent tokens are indexed.
What meets in the index is verified on the whole sets.

Only components are asked for, so first rounds compare every document with a few leaders of its index
entries, and the last round compares all pairs in the index that these left in different components.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyhouse.llm.components import components
from tallyhouse.llm.shingles import shingle_sets
from tallyhouse.llm.tables import column_or, small_batches, text_of, written

#: Cells in which shingles are counted, and how far a cell stands out if it holds a frequent one.
CELL_BITS = 18
FREQUENT = 64
#: Pairs sent to every task to pick the documents to verify; more are joined by shuffle.
BROADCAST_PAIRS = 500_000
#: Leaders of a document in the rounds before the last. They only save work: the last round is whole anyway.
LEADERS = (4, 32, 256)
#: Under a key of at most so many rows all pairs are looked at directly.
FEW = 16


def cell_counts(docs: DataFrame, width: int) -> np.ndarray:
    """Documents per cell of shingles, over all documents. The array has the same size for any input."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros(1 << CELL_BITS, np.int64)
        for pdf in batches:
            for s in shingle_sets(pdf["text"].tolist(), width):
                np.add.at(seen, s.view(np.uint64) >> np.uint64(64 - CELL_BITS), 1)
        at = np.flatnonzero(seen)
        yield pd.DataFrame({"cell": at, "n": seen[at]})

    found = docs.select("text").mapInPandas(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(1 << CELL_BITS, np.int64)
    counts[found["cell"]] = found["n"]
    return counts


def prefixes(docs: DataFrame, counts: np.ndarray, width: int, percent: int) -> DataFrame:
    """``docs`` (doc_id, mark, text) as ``row, doc_id, mark, n, digest, tokens, n_rare, n_first``.

    ``tokens`` is the prefix for k = 2 in order, of which the first ``n_rare`` are of the rare class and
    the first ``n_first`` the prefix for k = 1. ``digest`` tells equal sets. ``row`` tells rows apart.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(counts)
    mean = counts.mean()
    limit = mean + 6 * mean**0.5 + FREQUENT

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = shipped.value
        for pdf in batches:
            out = []
            for s in shingle_sets(pdf.pop("text").tolist(), width):
                n = len(s)
                first = n - -(-percent * n // 100) + 1 if n else 0
                frequency = counts[s.view(np.uint64) >> np.uint64(64 - CELL_BITS)]
                # Sets are sorted, so equal counts are in the order of their numbers.
                order = np.argsort(frequency, kind="stable")[:first + 1]
                out.append((n, hashlib.blake2b(s.tobytes(), digest_size=16).digest() if n else None, s[order],
                            int((frequency[order] <= limit).sum()), min(first, n)))
            yield pd.concat([pdf, pd.DataFrame(out, columns=["n", "digest", "tokens", "n_rare", "n_first"], index=pdf.index)],
                            axis=1)

    made = docs.mapInPandas(run, "doc_id long, mark long, n long, digest binary, tokens array<long>, n_rare int, n_first int")
    return made.withColumn("row", F.monotonically_increasing_id())


def _links(pairs: DataFrame, texts: DataFrame, every: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (u, v) whose whole sets are similar enough. The sets are made anew from the texts and meet once."""
    sides = pairs.select("u", "v", F.explode(F.array(F.struct(F.lit(True).alias("left"), F.col("u").alias("row")),
                                                     F.struct(F.lit(False).alias("left"), F.col("v").alias("row")))).alias("s"))
    # A row may lead any number of pairs; in lots, their lists stay short.
    asked = sides.select("s.row", F.struct("u", "v", "s.left").alias("p"), F.pmod(F.xxhash64("u", "v"), F.lit(64)).alias("lot"))
    asked = asked.groupBy("row", "lot").agg(F.collect_list("p").alias("p"))
    wanted = written(asked.join(every.select("row", "doc_id", "mark"), "row").select(
        F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), "p"), "wanted")
    at = F.broadcast(wanted) if pairs.count() <= BROADCAST_PAIRS else wanted
    held = texts.join(at, texts["doc_id"].eqNullSafe(F.col("_id")) & (texts["mark"] == F.col("_mark"))).select("p", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"p": pdf["p"], "tokens": list(shingle_sets(pdf["text"].tolist(), width))})

    made = held.mapInPandas(run, "p array<struct<u: long, v: long, left: boolean>>, tokens array<long>")
    both = made.select(F.explode("p").alias("p"), "tokens").groupBy("p.u", "p.v").agg(
        F.first(F.when(F.col("p.left"), F.col("tokens")), ignorenulls=True).alias("a"),
        F.first(F.when(~F.col("p.left"), F.col("tokens")), ignorenulls=True).alias("b"))
    both = both.withColumn("c", F.size(F.array_intersect("a", "b")))
    return both.filter(100 * F.col("c") >= percent * (F.size("a") + F.size("b") - F.col("c"))).select("u", "v")


def _sizes(percent: int, x: Callable[[str], Column], y: Callable[[str], Column]) -> tuple[Column, Column]:
    """What two sets (n) must share at least: of all tokens, and of those in both prefixes.

    Sets of n and m tokens need a share of percent / (100 + percent) of n + m in common. Of these, all that
    fit before percent of the larger set are in both prefixes.
    """
    n, m = x("n"), y("n")
    need = F.ceil(F.lit(percent) * (n + m) / F.lit(100 + percent))
    return need, need - F.ceil(F.lit(percent) * F.greatest(n, m) / F.lit(100)) + 1


def _may_start(percent: int, x: Callable[[str], Column], y: Callable[[str], Column]) -> Column:
    """Whether the token of two entries (n, at) can be the first shared one: enough tokens must follow it."""
    need, _ = _sizes(percent, x, y)
    return F.least(x("n") - x("at"), y("n") - y("at")) >= need


def _may_link(percent: int, x: Callable[[str], Column], y: Callable[[str], Column]) -> Column:
    """Whether two entries (n, at, met) can be of similar sets: each row must have met enough tokens of its prefix."""
    _, both = _sizes(percent, x, y)
    return _may_start(percent, x, y) & (F.least(x("met"), y("met")) >= both)


def _with(prefix: str) -> Callable[[str], Column]:
    return lambda name: F.col(f"{prefix}{name}")


def _among_few(entries: DataFrame, percent: int) -> DataFrame:
    """All pairs (u, v) of different roots under keys of at most ``FEW`` rows that can share enough of their prefixes.

    What they share there is counted; under keys of many rows they share no more than either has of these.
    """
    held = entries.groupBy("key").agg(F.collect_list(F.struct("row", "n", "at", "met", "lots", "root")).alias("l"))

    def pair(x: Column, y: Column) -> Column:
        first, second = (lambda c: x[c]), (lambda c: y[c])
        _, both = _sizes(percent, first, second)
        return F.struct(x["row"].alias("u"), y["row"].alias("v"), _may_start(percent, first, second).alias("starts"),
                        (both - F.least(x["lots"], y["lots"])).alias("least"))

    every = F.flatten(F.transform("l", lambda x: F.transform(
        F.filter("l", lambda y: (y["row"] > x["row"]) & (y["root"] != x["root"]) & (100 * F.least(x["n"], y["n"]) >= percent * F.greatest(x["n"], y["n"]))
                 & (F.least(x["met"], y["met"]) >= _sizes(percent, lambda c: x[c], lambda c: y[c])[1])),
        lambda y: pair(x, y))))
    return (held.select(F.explode(every).alias("p")).select("p.*").groupBy("u", "v")
            .agg(F.count("*").alias("c"), F.max("starts").alias("starts"), F.max("least").alias("least"))
            .filter("starts and c >= least").select("u", "v"))


def _met(entries: DataFrame, roots: DataFrame, turn: int, most: int, percent: int) -> DataFrame:
    """Pairs (u, v): rows and up to ``most`` leaders, of another component, that they meet under most of their keys.

    The rows of a key are dealt into ``most`` lots, new ones in each turn, and the row of least hash leads its
    lot. That needs a few rows per key and task, so a hot key stays split.
    """
    held = _rooted(entries, roots)
    mixed = held.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a < b").select("key")
    held = held.join(mixed, "key")
    lot = F.xxhash64("row", "key", F.lit(turn))
    lead = (held.groupBy("key", F.pmod(lot, F.lit(most)).alias("_lot"))
            .agg(F.min(F.struct(lot, "row", "n", "at", "met", "root")).alias("l")).select("key", "l"))
    met = (held.join(lead, "key").filter((F.col("root") != F.col("l.root")) & _may_link(percent, _with(""), _with("l.")))
           .groupBy("row", F.col("l.row").alias("leader")).count())
    return _most_met(met, most)


def _most_met(met: DataFrame, most: int) -> DataFrame:
    """Pairs (u, v) of rows and the ``most`` leaders that they meet most often, of (row, leader, count)."""
    # A row has at most so many leaders for each token of its prefix.
    order = Window.partitionBy("row").orderBy(F.col("count").desc(), F.xxhash64("leader", "row"))
    return (met.withColumn("_at", F.row_number().over(order)).filter(F.col("_at") <= most)
            .select(F.least("row", "leader").alias("u"), F.greatest("row", "leader").alias("v")).distinct())


def _met_among_few(entries: DataFrame, turn: int, most: int, percent: int) -> DataFrame:
    """As ``_met`` for rooted entries under keys of at most ``FEW`` rows, which are dealt out once."""
    lot = F.xxhash64("row", "key", F.lit(turn))
    # The window holds the few rows of one key at a time.
    leads = [F.min(F.when(F.pmod(lot, F.lit(most)) == i, F.struct(lot.alias("lot"), "row", "n", "at", "met", "root")))
             .over(Window.partitionBy("key")) for i in range(most)]
    led = entries.withColumn("_l", F.array(*leads)).select("row", "n", "at", "met", "root", F.explode("_l").alias("l"))
    met = (led.filter((F.col("root") != F.col("l.root")) & _may_link(percent, _with(""), _with("l.")))
           .groupBy("row", F.col("l.row").alias("leader")).count())
    return _most_met(met, most)


def _crossing(entries: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) that meet under a key (key, row, n, at, met, root) and have different roots."""
    least = entries.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most")).filter("least < most")
    held = entries.join(least.select("key", "least"), "key")
    kept = ["row", "n", "at", "met", "root"]
    x = held.filter("root <> least").select("key", *[F.col(c).alias(f"u{c}") for c in kept])
    y = held.select("key", "least", *[F.col(c).alias(f"v{c}") for c in kept])
    return (x.join(y, "key").filter((F.col("uroot") != F.col("vroot")) & _may_link(percent, _with("u"), _with("v"))
                                    & ((F.col("vroot") == F.col("least")) | (F.col("urow") < F.col("vrow"))))
            .select(F.least("urow", "vrow").alias("u"), F.greatest("urow", "vrow").alias("v")).distinct())


def _rooted(entries: DataFrame, roots: DataFrame) -> DataFrame:
    """Entries with the component of their row so far."""
    return entries.join(roots.withColumnRenamed("node", "row"), "row", "left").withColumn("root", F.coalesce("root", "row"))


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Components (node, root) with further links (u, v): those so far are stars, which need few steps."""
    if links.isEmpty():
        return roots
    stars = roots.select(F.col("node").alias("u"), F.col("root").alias("v"))
    return written(components(stars.unionByName(links)), "roots")


def groups(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, mark, n_shingles, component_id, first`` for every row of ``docs`` (doc_id, text).

    Rows link if 100 * shared shingles >= ``percent`` * shingles of both; ``component_id`` is the smallest doc_id
    reachable. ``first`` holds for one row of each component, the earliest of those with that id, and
    ``mark`` is a hash of the text, which tells rows of one doc_id apart. Null texts count as empty; a text
    without words has no shingle, links with nothing and is a component of its own. Equal rows are in one
    component. A null doc_id is never the smallest, unless there is no other. Other columns are left out.
    """
    small_batches(docs.sparkSession)
    texts = docs.select(column_or(docs, "doc_id", "long").alias("doc_id"), F.xxhash64(text_of(docs)).alias("mark"),
                        text_of(docs).alias("text"))
    every = written(prefixes(texts, cell_counts(texts, width), width, percent), "prefixes")

    # Equal sets are one node, the first of their rows.
    same = written(every.filter("n > 0").groupBy("digest").agg(F.min("row").alias("node")), "sets")
    nodes = every.join(same.select(F.col("node").alias("row")), "row", "left_semi")
    placed = nodes.select("row", "n", "n_rare", "n_first", F.posexplode("tokens").alias("at", "key"))
    rare = placed.filter((F.col("at") < F.col("n_rare")) & (F.col("at") < F.col("n_first"))).select("key", "row", "n", "at")
    # One exchange: the window holds rows of one rare key at a time. By size, a row of no comparable
    # neighbour has no comparable row at all.
    under = Window.partitionBy("key")
    by_size = under.orderBy("n", "row")
    near = (rare.withColumn("_a", F.lag("n").over(by_size)).withColumn("_b", F.lead("n").over(by_size))
            .withColumn("many", F.count("*").over(under) > FEW)
            .filter(f"100 * _a >= {percent} * n or 100 * n >= {percent} * _b"))
    rare_met = written(near.select("key", "row", "n", "at", F.lit(True).alias("first"), F.lit(False).alias("often"), "many"), "rare")
    counted = rare_met.unionByName(placed.filter(F.col("at") >= F.col("n_rare")).select(
        "key", "row", "n", "at", (F.col("at") < F.col("n_first")).alias("first"), F.lit(True).alias("often"),
        F.lit(True).alias("many")))
    # The window holds the prefix of one row at a time.
    own = Window.partitionBy("row")
    entries = written(counted.withColumn("met", F.sum(F.col("first").cast("long")).over(own))
                      .withColumn("lots", F.sum((F.col("first") & F.col("many")).cast("long")).over(own)), "entries")

    # First rounds: every row and a few leaders; then all pairs under keys of few rows that still lie apart.
    many, few = entries.filter("many"), entries.filter("not many")
    none = docs.sparkSession.createDataFrame([], "u long, v long")
    tried = none
    roots = none.select(F.col("u").alias("node"), F.col("v").alias("root"))
    if len(LEADERS) < 2:
        raise ValueError("pairs under keys of few rows take the second round")
    for turn, most in enumerate(LEADERS):
        pairs = _met(many.filter("first"), roots, turn, most, percent)
        if turn < 2:
            pairs = pairs.unionByName(_among_few(_rooted(few, roots), percent) if turn else _met_among_few(_rooted(few, roots), turn, 2, percent))
        pairs = written(pairs.distinct().join(tried, ["u", "v"], "left_anti"), "leaders")
        if pairs.isEmpty():
            continue
        tried = tried.unionByName(pairs)
        roots = _merged(roots, written(_links(pairs, texts, every, width, percent), "links"))

    # Last round: what still lies apart.
    apart = _crossing(_rooted(many.filter("not often"), roots), percent)
    kept = _rooted(many.filter("often"), roots)
    mixed = kept.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a < b").select("key")
    own = ["row", "n", "met", "root"]
    listed = kept.join(mixed, "key").groupBy(*own).agg(F.array_sort(F.collect_list(F.struct("at", "key", "first"))).alias("t"))
    couples = listed.select(*own, "t", F.explode(F.filter("t", lambda x: x["first"])).alias("x")).select(
        *own, "x", F.explode(F.filter("t", lambda y: y["at"] > F.col("x.at"))).alias("y")).select(
        F.xxhash64("x.key", "y.key").alias("key"), *own, F.col("x.at").alias("at"))
    pairs = written(apart.unionByName(_crossing(couples, percent)).distinct().join(tried, ["u", "v"], "left_anti"), "pairs")
    if not pairs.isEmpty():
        roots = _merged(roots, written(_links(pairs, texts, every, width, percent), "links"))

    named = (every.join(same.withColumnRenamed("node", "_set"), "digest", "left")
             .join(roots.select(F.col("node").alias("_set"), "root"), "_set", "left"))
    named = named.select("row", "doc_id", "mark", "n", F.coalesce("root", "_set", "row").alias("root"))
    least = named.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("least"))
    return named.join(least, "root").select(
        "doc_id", "mark", F.col("n").alias("n_shingles"), F.col("least.doc_id").alias("component_id"),
        (F.col("row") == F.col("least.row")).alias("first"))


def query(docs: DataFrame) -> DataFrame:
    """``op9``: the shingles and the component of every document."""
    return groups(docs).select("doc_id", "n_shingles", "component_id")
