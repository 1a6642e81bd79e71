"""Exact top-k search by inner product, as a three-phase uniform threshold over nodes that each hold some dimensions.

A node is a slice of the dimensions; its local score of a vector is the inner product over them, and
the whole score is the sum over the nodes. In phase 1 each node gives its best entries for every
query; their whole scores give a cutoff t that at least k vectors reach. A vector with a whole score
of t has a local score of t / nodes somewhere, so in phase 2 each node gives all entries from there on,
added up within the task and dropped there if their upper bound rules them out. Phase 3 resolves the scores
still missing of the others, in the same task, and keeps a batch's best k.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyhouse.llm.tables import ranked, small_batches, written

#: Queries handled at once: what is sent to every task is at most so many vectors.
QUERY_BLOCK = 4096
#: Vectors scored at once in a task.
VECTOR_BLOCK = 1024


def _prepared(vectors: DataFrame, key: str, vector: str, nodes: int) -> DataFrame:
    """``row, id, asked, size`` and the whole components of each node, ``part0`` and so on.

    Vectors that are null or hold a null or non-finite component leave.
    """
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = vectors.filter(F.col(vector).isNotNull() & F.coalesce(usable, F.lit(False))).select(
        F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("id"), F.col("_asked").alias("asked"),
        F.size(vector).alias("size"), F.transform(vector, lambda x: F.floor(x.cast("double") * 256)).alias("v"))
    return whole.select("row", "id", "asked", "size", *[_part("v", j, nodes).alias(f"part{j}") for j in range(nodes)])


def _part(v: str, node: int, nodes: int) -> Column:
    """The dimensions of one node."""
    first = F.floor(F.size(v) * node / nodes).cast("int")
    return F.slice(v, first + 1, F.floor(F.size(v) * (node + 1) / nodes).cast("int") - first)


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0).cast("long"), lambda s, x: s + x)


class _Block:
    """The queries of a block on one node, by number of dimensions of the whole vector."""

    def __init__(self, rows: np.ndarray, sizes: np.ndarray, parts: list[np.ndarray], cutoffs: np.ndarray):
        self.groups = {}
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            self.groups[int(size)] = rows[at], np.stack([parts[i] for i in at]), cutoffs[at]

    def scores(self, pdf: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Query rows, cutoffs, vector rows and their local scores; a query does not meet its own row."""
        for size, held in pdf.groupby("size"):
            if size not in self.groups:
                continue
            rows, queries, cutoffs = self.groups[size]
            vectors, ids = np.stack(held["part"].to_list()), held["row"].to_numpy()
            bound = float(np.abs(vectors).max(initial=0)) * float(np.abs(queries).max(initial=0)) * vectors.shape[1]
            if bound < 2**53:  # products and sums are exact in doubles
                found = (vectors.astype(float) @ queries.T.astype(float)).astype(np.int64)
            else:
                found = vectors @ queries.T
            yield rows, cutoffs, ids, found


def _block(queries: pd.DataFrame, node: int) -> _Block:
    return _Block(queries["row"].to_numpy(), queries["size"].to_numpy(),
                  [np.asarray(p, np.int64) for p in queries[f"part{node}"]], queries["cutoff"].to_numpy())


def _lists(vectors: DataFrame, queries: pd.DataFrame, node: int, k: int) -> DataFrame:
    """``query, row, node, score`` of one node: the best k of each task."""
    shipped = vectors.sparkSession.sparkContext.broadcast(_block(queries, node))

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: dict[bytes, tuple] = {}
        for pdf in batches:
            for rows, _, ids, scores in shipped.value.scores(pdf):
                score = np.where(ids[:, None] == rows[None, :], np.iinfo(np.int64).min, scores)
                row = np.broadcast_to(ids[:, None], score.shape)
                key = rows.tobytes()  # the queries of one size
                if key in kept:
                    _, s, r = kept[key]
                    score, row = np.concatenate([s, score]), np.concatenate([r, row])
                if len(score) > k:
                    at = np.argpartition(-score, k - 1, axis=0)[:k]
                    score, row = np.take_along_axis(score, at, 0), np.take_along_axis(row, at, 0)
                kept[key] = rows, score, row
        for rows, score, row in kept.values():
            out = pd.DataFrame({"query": np.broadcast_to(rows, score.shape).ravel(), "row": row.ravel(),
                                "score": score.ravel()})
            yield out[out["score"] > np.iinfo(np.int64).min]

    part = vectors.select("row", "size", F.col(f"part{node}").alias("part"))
    return part.mapInPandas(best, "query long, row long, score long").select("query", "row", F.lit(1 << node).alias("node"), "score")


def _entries(vectors: DataFrame, queries: pd.DataFrame, nodes: int, k: int) -> DataFrame:
    """``query, row, id, score``: of each batch of vectors the best k with a whole score of at least the query's ``least``.

    Every node gives its local scores from the query's cutoff on. Of what they add up to, a task drops what can't
    reach ``least``, since a score that a node doesn't give is below the cutoff. It holds a vector's slices of all
    nodes, so the scores still missing are resolved there.
    """
    held = [_block(queries, j) for j in range(nodes)], pd.Series(queries["least"].to_numpy(), index=queries["row"])
    shipped = vectors.sparkSession.sparkContext.broadcast(held)

    def reaching(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        blocks, least = shipped.value
        for pdf in batches:
            names = pdf.set_index("row")[["no_id", "id"]]
            parts = [b.scores(pdf[["row", "size"]].assign(part=pdf[f"part{j}"])) for j, b in enumerate(blocks)]
            for found in zip(*parts, strict=True):
                rows, cutoffs, ids, _ = found[0]
                bound = least.loc[rows].to_numpy()
                scores = np.stack([scores for *_, scores in found])
                given = scores >= cutoffs
                upper = np.where(given, scores, 0).sum(axis=0) + (nodes - given.sum(axis=0)) * cutoffs
                v, q = np.nonzero(given.any(axis=0) & (upper >= bound) & (ids[:, None] != rows[None, :]))
                whole = scores[:, v, q].sum(axis=0)
                v, q, whole = (x[whole >= bound[q]] for x in (v, q, whole))
                out = pd.DataFrame({"query": rows[q], "row": ids[v], "score": whole}).join(names, on="row")
                out = out.sort_values(["query", "score", "no_id", "id", "row"], ascending=[True, False, True, True, True])
                yield out.groupby("query").head(k)[["query", "row", "no_id", "id", "score"]]

    wanted = vectors.select("row", F.col("id").isNull().alias("no_id"), F.coalesce("id", F.lit(0).cast("long")).alias("id"), "size",
                            *[f"part{j}" for j in range(nodes)])
    return (wanted.mapInPandas(reaching, "query long, row long, no_id boolean, id long, score long")
            .select("query", "row", F.when(~F.col("no_id"), F.col("id")).alias("id"), "score"))


def _resolved(known: DataFrame, vectors: DataFrame, queries: DataFrame, nodes: int) -> DataFrame:
    """Add the local scores that are still missing to ``known`` (query, row, mask, sum): the whole score of each pair."""
    q = F.broadcast(queries.select(F.col("row").alias("query"), *[F.col(f"part{j}").alias(f"q{j}") for j in range(nodes)]))
    total = F.col("sum")
    for j in range(nodes):
        missing = F.col("mask").bitwiseAND(1 << j) == 0
        total = total + F.when(missing, _dot(F.col(f"part{j}"), F.col(f"q{j}"))).otherwise(F.lit(0).cast("long"))
    return known.join(vectors, "row").join(q, "query").select("query", "row", "id", total.alias("score"))


def _added(lists: DataFrame) -> DataFrame:
    return lists.groupBy("query", "row").agg(F.sum("score").alias("sum"),
                                             F.bit_or("node").alias("mask"))


def _leading(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "row")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(vectors: DataFrame, queries: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding",
           nodes: int = 2) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k rows of greatest inner product for each row with ``queries``.

    Candidates are all rows but the query's own, with as many components as the query. Ties go to the
    smaller id, null last. Rows that repeat are rows of their own: each is a candidate of the others. A
    query has fewer results if there are fewer candidates, none if it is alone. Scores have to fit 64 bits.
    Other columns are left out.
    """
    spark = small_batches(vectors.sparkSession, VECTOR_BLOCK)
    asked = vectors.withColumn("_asked", F.coalesce(queries, F.lit(False)))
    base = written(_prepared(asked, key, vector, nodes), "vectors")
    numbered = written(ranked(base.filter("asked").select("row"), "row"), "queries")
    total = numbered.count()
    results = []
    for first in range(0, total, QUERY_BLOCK):
        block = base.join(F.broadcast(numbered.filter(F.col("rank").between(first, first + QUERY_BLOCK - 1))
                                      .select("row")), "row")
        block = written(block, "block")
        held = block.toPandas().assign(cutoff=0)
        # Phase 1: best entries of every node, whole scores of those, and the k-th best of them.
        lists = [_lists(base, held, j, k) for j in range(nodes)]
        local = Window.partitionBy("query").orderBy(F.col("score").desc(), "row")
        lists = [x.withColumn("_n", F.row_number().over(local)).filter(F.col("_n") <= k).drop("_n") for x in lists]
        first_lists = lists[0]
        for x in lists[1:]:
            first_lists = first_lists.unionByName(x)
        scored = _leading(_resolved(_added(first_lists), base, block, nodes), k)
        reached = scored.groupBy("query").agg(F.min("score").alias("cutoff"), F.count("*").alias("n")).toPandas()
        cutoff = {r.query: r.cutoff for r in reached.itertuples() if r.n >= k}
        # Phase 2: all entries from the uniform cutoff on; with fewer than k candidates all of them.
        least = np.iinfo(np.int64).min
        whole = held["row"].map(lambda r: cutoff.get(r))
        held["least"] = np.array([least if pd.isna(t) else int(t) for t in whole], np.int64)
        held["cutoff"] = np.array([least if pd.isna(t) else -(-int(t) // nodes) for t in whole], np.int64)
        # Phase 3, in the same tasks: the scores still missing are resolved.
        left = _entries(base, held, nodes, k)
        results.append(written(_leading(left, k)
                               .join(F.broadcast(block.select(F.col("row").alias("query"), F.col("id").alias("query_id"))),
                                     "query")
                               .select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"),
                                       "score"), "results"))
    if not results:
        return base.filter("false").select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"),
                                           F.col("row").alias("score"))
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out


ORACLE = """
with whole as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
  where embedding is not null and list_aggregate(list_transform(embedding, lambda x: (x is null or not isfinite(x))::int), 'sum') = 0
), scored as (
  select q.vec_id as query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint as score
  from whole q join whole c on q.vec_id <> c.vec_id
  where q.vec_id % 50 = 0 and len(q.v) = len(c.v)
), placed as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as place from scored
)
select query_id, place::int as rank, vec_id, score from placed where place <= 5
"""
