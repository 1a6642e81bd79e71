"""Prefix trie of conversations from padded matrices of turn ids, a range of the sorted conversations at a time.

Conversations are sequences of turn ids. Spark deals them into ranges of their order (shards). A shard sorts
its rows with numpy's lexsort on padded matrices of ids; a row starts a node of a depth where it differs from
the row above in any column so far (change masks, OR-ed from depth to depth), and reduceat adds up every
depth. Only nodes on the path of a shard's first or last row can go on in another shard. These recombine by
a digest of their path: counts add up, and what both sides of a seam counted is taken off once per seam.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tallyhouse.llm.tables import column_or, small_batches, written

#: Turns a shard holds about, at 24 bytes each; shards are at least as many as the cluster has cores.
SHARD_TURNS = 500_000
#: Turns compared at once by the sort.
WIDTH = 8
#: Nodes shared by shards that are sent to every task, at some 60 bytes each; more are joined by shuffle.
BROADCAST_NODES = 100_000
#: What a shuffle join splits the children of one shared node into.
SALTS = 32

# Less than any id: what stands behind the end of a sequence.
_END = np.iinfo(np.int64).min
_NO_ENDS = hashlib.sha256(b"").hexdigest()

_SHARD = T.StructType([T.StructField(n, T.LongType()) for n in (
    "shard", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")] + [
        T.StructField("ends", T.StringType()), T.StructField("digest", T.BinaryType()),
        T.StructField("parent_digest", T.BinaryType())] + [
        T.StructField(n, T.ArrayType(T.LongType())) for n in ("first_ids", "first_bytes", "last_ids")])


def sequences(turns: DataFrame) -> DataFrame:
    """``conv_id, turns`` from rows ``conv_id, turn, role, text``: an array of (a, b, bytes), the turns in order.

    ``a`` and ``b`` are 128 bits of role and text, ``bytes`` the text's length in UTF-8. Turns go by turn, null first,
    ties by these numbers; equal rows are turns of their own. Null role or text is empty. Rows without a conv_id
    are left out, other columns too. The numbers of one conversation have to fit a row.
    """
    role, text = (F.coalesce(column_or(turns, c, "string"), F.lit("")) for c in ("role", "text"))
    number = lambda h: F.greatest(h, F.lit(int(_END) + 1))  # noqa: E731 - the least number marks the end
    turn = column_or(turns, "turn", "long")
    one = F.struct(turn.isNotNull().alias("known"), F.coalesce(turn, F.lit(0)).alias("turn"), number(F.xxhash64(role, text)).alias("a"),
                   number(F.xxhash64(F.lit(1), role, text)).alias("b"), F.octet_length(text).cast("long").alias("bytes"))
    return (turns.select(column_or(turns, "conv_id", "long").alias("conv_id"), one.alias("t")).filter("conv_id is not null")
            .groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list("t")), lambda t: F.struct(t["a"], t["b"], t["bytes"])).alias("turns")))


def _order(ids: np.ndarray, begin: np.ndarray, length: np.ndarray, conv: np.ndarray) -> np.ndarray:
    """Rows in order of their ids (two a turn), ends before what goes on, then of conv. A step compares ``WIDTH`` turns of those still tied."""
    rank, live = np.zeros(len(conv), np.int64), np.argsort(conv, kind="stable")
    step, at = 2 * WIDTH, 0
    while len(live):
        place = begin[live, None] + at + np.arange(step)
        there = at + np.arange(step) < 2 * length[live, None]
        padded = np.full(place.shape, _END)
        padded[there] = ids[place[there]]
        by = np.lexsort([*padded.T[::-1], rank[live]])
        live, padded = live[by], padded[by]
        group = np.r_[True, np.diff(rank[live]) != 0]
        starts = group | np.r_[True, (padded[1:] != padded[:-1]).any(axis=1)]
        first, own = np.flatnonzero(group), np.flatnonzero(starts)
        # A group keeps its places; its parts come one after the other.
        rank[live] += (own - first[np.searchsorted(first, own, "right") - 1])[np.cumsum(starts) - 1]
        at += step
        goes_on = np.logical_or.reduceat(2 * length[live] > at, own) & (np.diff(np.r_[own, len(live)]) > 1)
        live = live[np.repeat(goes_on, np.diff(np.r_[own, len(live)]))]
    return np.lexsort([conv, rank])


def _paths(ids: np.ndarray, length: int) -> list[bytes]:
    """A digest of the first d turns, for every d."""
    state = hashlib.blake2b(digest_size=16)
    found = [state.digest()]
    for d in range(length):
        state.update(ids[2 * d:2 * d + 2].tobytes())
        found.append(state.digest())
    return found


class _Level:
    """The nodes of one depth in a shard, in order."""

    def __init__(self, rows: np.ndarray, starts: np.ndarray, parent: np.ndarray, conv: np.ndarray, size: np.ndarray):
        self.parent, self.size = parent, size
        self.n_convs = np.diff(np.r_[starts, len(rows)])
        self.least = np.minimum.reduceat(conv[rows], starts)
        self.n_children = np.zeros(len(starts), np.int64)


def _nodes(conv: np.ndarray, ids: np.ndarray, size: np.ndarray, begin: np.ndarray, length: np.ndarray
           ) -> tuple[list[_Level], list[dict[int, str]]]:
    """The levels of the sorted rows, and per depth the members that end in a node, comma-joined."""
    rows, node = np.arange(len(conv)), np.zeros(len(conv), np.int64)
    levels = [_Level(rows, np.zeros(1, np.int64), np.zeros(1, np.int64), conv, np.zeros(1, np.int64))]
    ends = []
    while True:
        depth = len(levels)
        here = rows[length[rows] == depth - 1]
        cuts = [0, *(np.flatnonzero(np.diff(node[here])) + 1), len(here)] if len(here) else []
        ends.append({int(node[here[a]]): ",".join(map(str, conv[here[a:b]].tolist())) for a, b in zip(cuts, cuts[1:])})
        rows = rows[length[rows] >= depth]
        if not len(rows):
            break
        a, b = (ids[begin[rows] + 2 * depth - k] for k in (2, 1))
        # The node above differs where any column before did.
        starts = np.r_[True, (np.diff(node[rows]) != 0) | (np.diff(a) != 0) | (np.diff(b) != 0)]
        first, parent = np.flatnonzero(starts), node[rows][starts]
        levels.append(_Level(rows, first, parent, conv, size[begin[rows[first]] // 2 + depth - 1]))
        node[rows] = np.cumsum(starts) - 1
    for level in levels:
        level.n_leaves, level.saved = np.zeros(len(level.n_convs), np.int64), (level.n_convs - 1) * level.size
    for above, level in zip(levels[-2::-1], levels[:0:-1], strict=True):
        level.n_leaves += level.n_children == 0
        np.add.at(above.n_children, level.parent, 1)
        np.add.at(above.n_leaves, level.parent, level.n_leaves)
        np.add.at(above.saved, level.parent, level.saved)
    levels[0].n_leaves += levels[0].n_children == 0
    return levels, ends


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All nodes of a shard; those on the path of its first or last row with a digest, and these rows themselves."""
    held = pa.Table.from_batches([*batches]) if (batches := [b for b in batches if b.num_rows]) else None
    if held is None:
        return
    held = held.combine_chunks()
    lists = held["ids"].chunk(0)
    conv, shard = held["conv_id"].to_numpy(), held["shard"][0].as_py()
    ids, size = lists.flatten().to_numpy(), held["bytes"].chunk(0).flatten().to_numpy()
    length = np.diff(lists.offsets.to_numpy()) // 2
    begin = np.r_[0, np.cumsum(2 * length)[:-1]]
    by = _order(ids, begin, length, conv)
    conv, begin, length = conv[by], begin[by], length[by]
    levels, ends = _nodes(conv, ids, size, begin, length)
    edge = [ids[begin[r]:begin[r] + 2 * length[r]] for r in (0, -1)]
    paths = [_paths(e, len(e) // 2) for e in edge]
    above: dict[int, bytes] = {}
    for depth, (level, ended) in enumerate(zip(levels, ends, strict=True)):
        n = len(level.n_convs)
        opened = {at: path[depth] for at, path in zip((0, n - 1), paths, strict=True) if depth < len(path)}
        parent = level.parent.tolist()
        yield pa.RecordBatch.from_pydict({
            "shard": [shard] * n, "depth": [depth] * n, "conv_id": level.least,
            "parent_conv_id": levels[depth - 1].least[level.parent] if depth else [None], "n_convs": level.n_convs,
            "n_children": level.n_children, "n_leaves": level.n_leaves, "saved_tokens": level.saved,
            "ends": [ended.get(i, "") if i in opened else hashlib.sha256(ended[i].encode()).hexdigest() if i in ended else _NO_ENDS
                     for i in range(n)],
            "digest": [opened.get(i) for i in range(n)],
            "parent_digest": [above.get(p) if depth else None for p in parent],
            "first_ids": [None] * n, "first_bytes": [None] * n, "last_ids": [None] * n}, schema=_ARROW)
        above = opened
    first_bytes = size[begin[0] // 2:begin[0] // 2 + length[0]]
    yield pa.RecordBatch.from_pylist([{"shard": shard, "first_ids": edge[0].tolist(), "first_bytes": first_bytes.tolist(),
                                       "last_ids": edge[1].tolist()}], schema=_ARROW)


_ARROW = pa.schema([(f.name, pa.list_(pa.int64()) if isinstance(f.dataType, T.ArrayType) else {
    "bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}[f.dataType.simpleString()]) for f in _SHARD])


def _seams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What both shards of a seam counted, for each node that the last row of one shares with the first of the next."""
    for pdf in batches:
        out = []
        for last, first, size in zip(pdf["before"], pdf["first_ids"], pdf["first_bytes"], strict=True):
            n = min(len(last), len(first)) // 2
            differ = np.flatnonzero((np.asarray(last[:2 * n]) != np.asarray(first[:2 * n])).reshape(n, 2).any(axis=1))
            shared = int(differ[0]) if len(differ) else n
            # Texts below a node count once more than in the shards alone.
            saved = np.r_[np.cumsum(np.asarray(size[:shared], np.int64)[::-1])[::-1], 0]
            saved = np.r_[saved[:1], saved[:-1]] if shared else saved
            # The deepest shared node was childless before the seam if the row ended there.
            leaf = int(len(last) == 2 * shared)
            out += [(d, path, int(saved[d]), int(d < shared), leaf) for d, path in enumerate(_paths(np.asarray(first, np.int64), shared))]
        yield pd.DataFrame(out, columns=["depth", "digest", "saved", "children", "leaves"])


def _joined_ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of the members that end in a node, from the pieces of its shards in order; one state, no list."""
    now, state = None, None
    for pdf in batches:
        out = []
        for depth, digest, ends in zip(pdf["depth"], pdf["digest"], pdf["ends"], strict=True):
            if (depth, bytes(digest)) != now:
                if now:
                    out.append((*now, state.hexdigest()))
                now, state = (depth, bytes(digest)), hashlib.sha256()
            else:
                state.update(b",")
            state.update(ends.encode())
        yield pd.DataFrame(out, columns=["depth", "digest", "ends_sha256"])
    if now:
        yield pd.DataFrame([(*now, state.hexdigest())], columns=["depth", "digest", "ends_sha256"])


def _parents(nodes: DataFrame, shared: DataFrame) -> DataFrame:
    """``nodes`` with the least member of a parent that several shards hold."""
    names = shared.select(F.col("digest").alias("parent_digest"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("_least"))
    keys = ["parent_digest", "depth"]
    if names.count() <= BROADCAST_NODES:
        joined = nodes.join(F.broadcast(names), keys, "left")
    else:
        salted = nodes.withColumn("_salt", F.pmod(F.xxhash64("conv_id"), F.lit(SALTS)))
        dealt = names.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        joined = salted.join(dealt, [*keys, "_salt"], "left")
    return joined.withColumn("parent_conv_id", F.coalesce("_least", "parent_conv_id"))


def trie(convs: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The nodes of the trie over ``convs`` (conv_id, turns as ``sequences`` gives them).

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (the parent's smallest member, null for the root),
    ``n_convs``, ``n_children``, ``n_leaves`` (childless nodes in the subtree), ``saved_tokens`` (over the subtree, bytes of a
    node's last text times members less one) and ``ends_sha256`` (of the members that end there, comma-joined). Conversations
    without turns are members of the root and end there. Rows of equal conv_id are members of their own. No conversation, no node.
    """
    spark = small_batches(convs.sparkSession, 2000)
    flat = written(convs.select("conv_id", F.flatten(F.transform("turns", lambda t: F.array(t["a"], t["b"]))).alias("ids"),
                                F.transform("turns", lambda t: t["bytes"]).alias("bytes")), "sequences")
    turns = flat.agg(F.sum(F.size("bytes") + 1)).first()[0] or 0
    n = max(spark.sparkContext.defaultParallelism, -(-turns // shard_turns))
    dealt = flat.repartitionByRange(n, "ids", "conv_id").withColumn("shard", F.spark_partition_id().cast("long"))
    shards = written(dealt.mapInArrow(_shard, _SHARD), "shards")

    # A row for each shard.
    edges = shards.filter("first_ids is not null").select(
        "shard", "first_ids", "first_bytes", F.lag("last_ids").over(Window.orderBy("shard")).alias("before"))
    seams = written(edges.filter("before is not null").select("before", "first_ids", "first_bytes").mapInPandas(
        _seams, "depth long, digest binary, saved long, children long, leaves long"), "seams")
    opened, counts = shards.filter("digest is not null"), ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    none = F.lit(None)
    twice = seams.select("depth", "digest", none.cast("long").alias("conv_id"), none.cast("long").alias("parent_conv_id"),
                         none.cast("binary").alias("parent_digest"), F.lit(0).cast("long").alias("n_convs"), (-F.col("children")).alias("n_children"),
                         (-F.col("leaves")).alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    merged = opened.select(*twice.columns).unionByName(twice).groupBy("depth", "digest").agg(
        F.min("conv_id").alias("conv_id"), F.min("parent_conv_id").alias("parent_conv_id"), F.first("parent_digest", ignorenulls=True).alias("parent_digest"),
        *[F.sum(c).alias(c) for c in counts])
    pieces = opened.filter("ends <> ''").select("depth", "digest", "shard", "ends").repartition("digest").sortWithinPartitions(
        "digest", "depth", "shard")
    ends = pieces.select("depth", "digest", "ends").mapInPandas(_joined_ends, "depth long, digest binary, ends_sha256 string")
    merged = written(merged.join(ends, ["depth", "digest"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NO_ENDS))), "merged")
    closed = shards.filter("depth is not null and digest is null").withColumnRenamed("ends", "ends_sha256")
    kept = ["depth", "conv_id", "parent_conv_id", "parent_digest", *counts, "ends_sha256"]
    shared = merged.join(seams.select("depth", "digest").distinct(), ["depth", "digest"], "left_semi")
    return _parents(closed.select(*kept).unionByName(merged.select(*kept)), shared).select(
        "conv_id", "depth", "parent_conv_id", *counts, "ends_sha256")


def rebuilt(turns: DataFrame) -> DataFrame:
    """Sequences that share beginnings: the first h turns of conversation c - c % 5, then c's own behind its first h; h = crc32(c) % 9."""
    own = written(sequences(turns), "turns")
    c, h = F.col("conv_id"), (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int")
    heads = own.filter(c % 5 == 0).select(F.col("conv_id").alias("_head"), F.slice("turns", 1, 8).alias("_first"))
    # At most nine conversations look up one.
    joined = own.withColumn("_h", h).withColumn("_head", c - c % 5).join(heads, "_head", "left")
    behind = F.slice("turns", F.col("_h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    first = F.slice(F.coalesce("_first", F.slice("turns", 1, 0)), F.lit(1), F.col("_h"))
    return joined.select("conv_id", F.concat(first, behind).alias("turns"))


def query(conversations: DataFrame) -> DataFrame:
    """``op12``: the trie of all rebuilt conversations."""
    return trie(rebuilt(conversations))


ORACLE = """
WITH codes AS (
  SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i))),
own AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'said': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS ts
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
cut AS (
  SELECT conv_id, ts, xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
    lambda x: CAST(ascii(x) AS BIGINT))), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 9 AS h FROM own, codes),
rebuilt AS (
  SELECT a.conv_id, list_concat(coalesce(b.ts[1:a.h], []), a.ts[a.h + 1:]) AS ts
  FROM cut a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 5),
members AS (SELECT conv_id, ts, unnest(range(0, len(ts) + 1)) AS d FROM rebuilt),
nodes AS (
  SELECT d, ts[1:d] AS k, min(conv_id) AS conv_id, count(*) AS n_convs,
         string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(ts) = d) AS ends
  FROM members GROUP BY ALL),
named AS (
  SELECT a.*, (a.n_convs - 1) * coalesce(strlen(a.k[a.d].said), 0) AS saved, p.conv_id AS parent_conv_id,
         (SELECT count(*) FROM nodes c WHERE c.d = a.d + 1 AND c.k[1:a.d] = a.k) AS n_children
  FROM nodes a LEFT JOIN nodes p ON p.d = a.d - 1 AND p.k = a.k[1:a.d - 1]),
tops AS (SELECT k, saved, n_children, unnest(range(0, d + 1)) AS e FROM named),
sums AS (
  SELECT e AS d, k[1:e] AS k, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves FROM tops GROUP BY ALL)
SELECT n.conv_id, n.d AS depth, n.parent_conv_id, n.n_convs, n.n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves,
       CAST(s.saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM named n JOIN sums s ON s.d = n.d AND s.k = n.k
"""
