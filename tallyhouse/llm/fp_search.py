"""Ranked lexical search: an item's terms are looked for in FP-trees of documents, by branch and bound.

A document is its term vector, restricted to the terms that any item asks for. For one item and some thousand
documents, the vectors over the item's terms, frequent terms first, are paths of a tree: documents that begin
alike share nodes. A node knows the greatest tf of its term and the least m among the documents below, which
bound the term's part of the score there; what lies below it is bounded from the leaves up. The search goes
depth first into the child of the greatest bound and leaves out what can't reach the item's 10th score so far.
"""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyhouse.llm.tables import column_or, small_batches, text_of, written

# What a term is (UTF-8 bytes, so that all of 128 and above are inside), and what parts terms.
_TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_GAP = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
#: Documents taken together, and the most cells of a tree's matrix: an item of many terms has trees of fewer documents.
TREE = 4096
CELLS = 1 << 19
#: Items searched in one pass over the vectors, and their bytes: what is sent to a task is their terms.
ITEMS = 5000
ITEM_BYTES = 1 << 25
#: Bytes of a text taken apart at once.
PIECE = 1 << 20

_NO_ID = 1 << 63


def terms_of(text: str) -> Iterator[list[bytes]]:
    """The terms of a text in pieces, A-Z in lower case, so that no text is a list of words as a whole."""
    # bytes.lower() changes A-Z alone.
    data, at = text.encode().lower(), 0
    while at < len(data):
        cut = _GAP.search(data, at + PIECE)
        end = cut.end() if cut else len(data)
        yield _TERM.findall(data, at, end)
        at = end


def numbered(items: DataFrame, key: str, text: str) -> DataFrame:
    """``item, item_id, text``: items are numbered, so that rows of one id, or of none, are items of their own."""
    return written(items.select(F.monotonically_increasing_id().alias("item"), column_or(items, key, "long").alias("item_id"),
                                text_of(items, text).alias("text")), "items")


def vectors(docs: DataFrame, vocabulary: list[bytes], text: str = "text", key: str = "doc_id") -> DataFrame:
    """``no_id, doc_id, n, terms, tfs`` of every document: its number of terms, and those of the vocabulary as numbers with their counts."""
    shipped = docs.sparkSession.sparkContext.broadcast({w: i for i, w in enumerate(vocabulary)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = shipped.value.get
        for pdf in batches:
            out = []
            for said in pdf["text"]:
                n, found = 0, []
                for piece in terms_of(said):
                    n += len(piece)
                    found += [i for w in piece if (i := number(w)) is not None]
                terms, tfs = np.unique(np.array(found, np.int32), return_counts=True)
                out.append((n, terms, tfs.astype(np.int32)))
            yield pd.concat([pdf[["no_id", "doc_id"]], pd.DataFrame(out, columns=["n", "terms", "tfs"], index=pdf.index)], axis=1)

    small_batches(docs.sparkSession)
    doc_id = column_or(docs, key, "long")
    return docs.select(doc_id.isNull().alias("no_id"), F.coalesce(doc_id, F.lit(0)).alias("doc_id"), text_of(docs, text).alias("text")).mapInPandas(
        run, "no_id boolean, doc_id long, n long, terms array<int>, tfs array<int>")


def _part(weight: np.ndarray | np.int64, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """A term's part of a score. It grows with tf and falls with m."""
    return weight * (1_000_000_000 * tf // (1000 * tf + 8 * m))


class Tree:
    """The FP-tree of one item over some documents.

    Columns are the item's terms, frequent ones first. With the rows sorted by which terms they hold, a node is a
    term and a range of rows, and its children follow each other in that range.
    """

    def __init__(self, tf: np.ndarray, m: np.ndarray, ids: np.ndarray, weights: np.ndarray):
        held = tf > 0
        n, width = tf.shape
        bits = np.packbits(np.pad(~held, ((0, 0), (0, -width % 64))), axis=1).view(">u8")
        by = np.lexsort(bits.T[::-1])
        held, self.tf, self.m, self.ids, self.weights = held[by], tf[by], m[by], ids[by], weights
        # Where a row differs from the one above in this column or any before, a new prefix starts.
        new = np.ones((n, width), bool)
        new[1:] = np.logical_or.accumulate(held[1:] != held[:-1], axis=1)
        #: Per row and column of a term that it holds: the node's own part and the bound of its subtree, and its last row + 1.
        self.part, self.bound = np.zeros((n, width), np.int64), np.zeros((n, width), np.int64)
        self.end = np.zeros((n, width), np.int32)
        #: The next term that a row holds, from a column on.
        self.follow = np.full((n, width + 1), width, np.int32)
        below = np.zeros(n, np.int64)
        for j in range(width - 1, -1, -1):
            self.follow[:, j] = np.where(held[:, j], j, self.follow[:, j + 1])
            rows = np.flatnonzero(held[:, j])
            if not len(rows):
                continue
            # Rows between two that hold the term belong to another prefix, so a change marks the next start, too.
            starts = np.flatnonzero(np.r_[True, new[rows[1:], j] | (np.diff(rows) > 1)])
            size = np.diff(np.r_[starts, len(rows)])
            part = _part(weights[j], np.maximum.reduceat(self.tf[rows, j], starts), np.minimum.reduceat(self.m[rows], starts))
            self.part[rows, j] = np.repeat(part, size)
            below[rows] = self.bound[rows, j] = np.repeat(part + np.maximum.reduceat(below[rows], starts), size)
            self.end[rows, j] = np.repeat(rows[starts] + size, size)

    def search(self, best: list[tuple[int, int]], k: int) -> int:
        """Put the documents that belong to the k best into ``best``, a heap of (score, -id). Returns the nodes visited."""
        stack, width, visited = [(self.bound.max(initial=0), 0, len(self.ids), 0, 0)], len(self.weights), 0
        while stack:
            bound, at, end, column, path = stack.pop()
            if len(best) == k and bound < best[0][0]:
                continue
            visited += 1
            children = []
            while at < end:
                j = self.follow[at, column]
                if j == width:
                    self._read(at, end, best, k)
                    break
                stop, bound = int(self.end[at, j]), path + int(self.bound[at, j])
                if len(best) < k or bound >= best[0][0]:
                    children.append((bound, at, stop, int(j) + 1, path + int(self.part[at, j])))
                at = stop
            # The child of the greatest bound goes first.
            stack += sorted(children)
        return visited

    def _read(self, at: int, end: int, best: list[tuple[int, int]], k: int) -> None:
        """Documents that end in a node: their scores as they are."""
        scores = _part(self.weights, self.tf[at:end], self.m[at:end, None]).sum(axis=1)
        for score, i in zip(scores.tolist(), self.ids[at:end].tolist(), strict=True):
            if score > 0 and len(best) < k:
                heapq.heappush(best, (score, -i))
            elif score > 0 and (score, -i) > best[0]:
                heapq.heapreplace(best, (score, -i))


class _Lot:
    """Some thousand vectors, by term."""

    def __init__(self, pdf: pd.DataFrame, n_docs: int, n_terms: int):
        # No id is greater than all.
        self.ids = np.array([_NO_ID if no else int(i) for no, i in zip(pdf["no_id"], pdf["doc_id"], strict=True)], object)
        self.m = np.array([10 + 90 * int(n) * n_docs // max(n_terms, 1) for n in pdf["n"]], np.int64)
        terms = np.concatenate([*pdf["terms"], np.zeros(0, np.int32)])
        by = np.argsort(terms, kind="stable")
        self.terms = terms[by]
        self.tfs = np.concatenate([*pdf["tfs"], np.zeros(0, np.int32)]).astype(np.int64)[by]
        self.docs = np.repeat(np.arange(len(pdf)), [len(t) for t in pdf["terms"]])[by]

    def trees(self, asked: np.ndarray, weights: np.ndarray) -> Iterator[Tree]:
        """FP-trees of the documents that hold any of the terms."""
        a, b = np.searchsorted(self.terms, asked), np.searchsorted(self.terms, asked, "right")
        met = np.unique(np.concatenate([self.docs[i:j] for i, j in zip(a, b, strict=True)]))
        rows = max(1, CELLS // len(asked))
        for begin in range(0, len(met), rows):
            some = met[begin:begin + rows]
            tf = np.zeros((len(some), len(asked)), np.int64)
            for column, (i, j) in enumerate(zip(a, b, strict=True)):
                at = np.searchsorted(self.docs[i:j], [some[0], some[-1] + 1]) + i
                tf[np.searchsorted(some, self.docs[at[0]:at[1]]), column] = self.tfs[at[0]:at[1]]
            yield Tree(tf, self.m[some], self.ids[some], weights)


def _searched(held: DataFrame, asked: list[tuple[int, list[int]]], weights: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """``item, no_id, doc_id, score``: of each task's documents the k best for every item."""
    shipped = held.sparkSession.sparkContext.broadcast([(item, np.array(t, np.int32), weights[t]) for item, t in asked if t])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: dict[int, list[tuple[int, int]]] = {}

        def search(lot: list[pd.DataFrame]) -> None:
            docs = _Lot(pd.concat(lot), n_docs, n_terms)
            for item, terms, weight in shipped.value:
                for tree in docs.trees(terms, weight):
                    tree.search(best.setdefault(item, []), k)

        lot = []
        for pdf in batches:
            lot.append(pdf)
            if sum(map(len, lot)) >= TREE:
                search(lot)
                lot = []
        if lot:
            search(lot)
        found = [(item, -i == _NO_ID, 0 if -i == _NO_ID else -i, score) for item, heap in best.items() for score, i in heap]
        yield pd.DataFrame(found, columns=["item", "no_id", "doc_id", "score"])

    return held.mapInPandas(run, "item long, no_id boolean, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 10, item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """The ``k`` best documents for every item: ``item_id, rank, doc_id, score``.

    A term of an item counts once and weighs floor(1000 ln((2N+2)/(2df+1))); its part of a score is weight *
    (10^9 tf div (1000 tf + 8 m)), m = 10 + (90 n N div L). Ranks are from 1 by score, then doc_id (null last). Documents of
    score 0 are not named. Null texts have no term; rows without an id and repeated rows are documents, or items, of
    their own (repeated items repeat their ranks). Other columns are left out. All counts are over all documents.
    """
    asked = numbered(items, item_key, item_text)
    size = asked.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    blocks = max(1, -(-size["n"] // ITEMS), -(-(size["bytes"] or 0) // ITEM_BYTES))
    found = None
    for block in range(blocks):
        own = asked.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).select("item", "text").collect()
        terms = {r["item"]: {w for piece in terms_of(r["text"]) for w in piece} for r in own}
        vocabulary = sorted(set().union(*terms.values()))
        held = written(vectors(docs, vocabulary), "vectors")
        total = held.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.sum("n").alias("terms")).first()
        # One row for each term of the items.
        df = {r["t"]: r["count"] for r in held.select(F.explode("terms").alias("t")).groupBy("t").count().collect()}
        weights = np.array([math.floor(1000 * math.log((2 * total["docs"] + 2) / (2 * df.get(t, 0) + 1)))
                            for t in range(len(vocabulary))], np.int64)
        number = {w: t for t, w in enumerate(vocabulary)}
        vector = [(item, sorted((number[w] for w in said if number[w] in df), key=lambda t: (-df[t], t))) for item, said in terms.items()]
        part = _searched(held, vector, weights, total["docs"], total["terms"] or 0, k)
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), "no_id", "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.join(asked.select("item", "item_id"), "item").select(
        "item_id", "rank", F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), "score")


def query(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``op11``: the ten best documents for every benchmark item."""
    return search(docs, items)


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
total AS (SELECT count(*) FILTER (len(terms) > 0) AS n, CAST(sum(len(terms)) AS BIGINT) AS l FROM d),
tf AS (SELECT doc_id, t, count(*) AS tf FROM (SELECT doc_id, unnest(terms) AS t FROM d) GROUP BY ALL),
df AS (SELECT t, CAST(floor(1000 * ln((2 * any_value(n) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, total GROUP BY t),
m AS (SELECT doc_id, 10 + (90 * len(terms) * n) // l AS m FROM d, total),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
scores AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN tf USING (t) JOIN df USING (t) JOIN m USING (doc_id) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 10
"""
