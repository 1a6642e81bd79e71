"""Toxicity: a classifier whose scores must not move when a named group is swapped for another.

A logistic regression on words and word beginnings is fitted on labelled texts. Each text with an
identity term also has counterfactuals, where its terms are swapped for others of their set, and the
fit penalises the squared change of the score between them. So a term that happens to stand in more
toxic texts than its neighbours gets no weight of its own, and neutral mentions stay neutral.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.letters import Words, groups, lowered, mixed, powers, words_of
from tallyhouse.llm.tables import column_or, small_batches, table, text_of

# Sets of terms that name groups of people, exchangeable within a set.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("women", "men", "girls", "boys", "transgender", "nonbinary"),
    ("woman", "man", "girl", "boy"),
    ("female", "male"),
    ("gay", "lesbian", "straight", "bisexual", "queer", "heterosexual", "homosexual"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic", "sikh"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics", "sikhs"),
    ("black", "white", "asian", "african", "european", "latino", "hispanic", "arab", "indigenous"),
    ("american", "mexican", "chinese", "indian", "german", "french", "spanish", "russian", "turkish", "polish"),
    ("immigrant", "native", "refugee", "foreigner", "citizen"),
    ("immigrants", "natives", "refugees", "foreigners", "citizens"),
    ("disabled", "deaf", "blind", "autistic"),
    ("old", "young", "elderly", "teenage"),
    ("frauen", "männer"), ("femmes", "hommes"), ("mujeres", "hombres"),
)
CELL_BITS = 20
CELLS = 1 << CELL_BITS
#: Lengths of the word beginnings that are features, besides the whole word.
PREFIXES = (4, 5, 6)


def _cell(h: np.ndarray, length: int) -> np.ndarray:
    """Whole words have length 0."""
    return (mixed(h + np.uint64((length + 1) * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF)) >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def features(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(text number, cell) of every word and word beginning, with repeats."""
    if not len(w.starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    p = w.points.astype(np.uint64)
    lengths = w.ends - w.starts
    power = powers(max(int(lengths.max()), max(PREFIXES)))
    value = p[w.letter] * power[np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)]
    begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    docs, cells = [w.doc], [_cell(np.add.reduceat(value, begin), 0)]
    for n in PREFIXES:
        held = lengths > n
        h = np.zeros(int(held.sum()), np.uint64)
        for k in range(n):
            h += p[w.starts[held] + k] * power[k]
        docs.append(w.doc[held])
        cells.append(_cell(h, n))
    return np.concatenate(docs), np.concatenate(cells)


def term_cells(terms: Sequence[Sequence[str]]) -> np.ndarray:
    """Cells of the identity terms: they always are features, so that the penalty reaches them."""
    texts = [t for group in terms for t in group]
    return np.unique(features(words_of(texts))[1]) if texts else np.zeros(0, np.int64)


def swapped(text: str, terms: Sequence[Sequence[str]], shift: int) -> str | None:
    """The text with each identity term replaced by the one ``shift`` places on in its set; None if it has none.

    Only sentences that hold a term change; all else is the same by construction.
    """
    import regex

    place = {t: group[(i + shift) % len(group)] for group in terms for i, t in enumerate(group)}
    if not place:
        return None
    pattern = regex.compile(r"(?<!\p{L})(" + "|".join(sorted(place, key=len, reverse=True)) + r")(?!\p{L})")
    low = lowered(text)
    out, n = pattern.subn(lambda m: place[m[1]], low)
    return out if n else None


@dataclass
class Model:
    weights: np.ndarray  # by cell
    bias: float

    def scores(self, texts: list[str]) -> np.ndarray:
        out = np.full(len(texts), self.bias)
        for first, group in groups(texts):
            docs, cells = features(words_of(group))
            hit = self.weights[cells] != 0
            # A feature counts once in a text.
            pairs = np.unique(docs[hit] * CELLS + cells[hit])
            out[first:first + len(group)] += np.bincount(pairs // CELLS, self.weights[pairs % CELLS], len(group))
        return 1 / (1 + np.exp(-np.clip(out, -40, 40)))


def class_counts(rows: DataFrame) -> pd.DataFrame:
    """Texts per cell and label, of all rows ``text, label``; only cells of ``CELLS`` reach the driver.

    A cell must occur in at least two texts with label 1 to come back, so its count grows with neither
    the rows without the label nor the vocabulary.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros((2, CELLS), np.int64)
        for pdf in batches:
            labels = pdf["label"].to_numpy()
            for first, group in groups(pdf["text"].tolist()):
                docs, cells = features(words_of(group))
                pairs = np.unique(docs * CELLS + cells)
                positive = labels[first + pairs // CELLS] == 1
                for k in (0, 1):
                    seen[k] += np.bincount(pairs[positive == bool(k)] % CELLS, minlength=CELLS)
        at = np.flatnonzero(seen.sum(0))
        yield pd.DataFrame({"cell": at, "negative": seen[0, at], "positive": seen[1, at]})

    return (rows.mapInPandas(count, "cell int, negative long, positive long").groupBy("cell")
            .agg(F.sum("negative").alias("negative"), F.sum("positive").alias("positive"))
            .filter("positive >= 2").toPandas())


def chosen_cells(counts: pd.DataFrame, n_negative: int, n_positive: int, most: int) -> np.ndarray:
    """The cells whose presence tells most about the label (chi-squared), those of the positive label only."""
    a, b = counts["positive"].to_numpy(float), counts["negative"].to_numpy(float)
    c, d = n_positive - a, n_negative - b
    total = max(n_positive + n_negative, 1)
    chi = total * (a * d - b * c) ** 2 / np.maximum((a + b) * (c + d) * (a + c) * (b + d), 1)
    keep = (chi > 10.8) & (a * max(n_negative, 1) > b * max(n_positive, 1))
    order = np.lexsort((counts["cell"].to_numpy(), -chi))
    return np.sort(counts["cell"].to_numpy()[order[keep[order]][:most]])


def _descend(x: list[np.ndarray], y: np.ndarray, pairs: list[tuple[int, np.ndarray]], size: int, pairing: float,
             ridge: float, rounds: int) -> tuple[np.ndarray, float]:
    """Weights and bias for rows of feature numbers; ``pairs`` hold the row and the features of its counterfactual."""
    def flat(rows):
        lengths = np.array([len(r) for r in rows], np.int64)
        return (np.repeat(np.arange(len(rows)), lengths), np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64))

    rows, cols = flat(x)
    prow, pcol = flat([f for _, f in pairs])
    base = np.array([i for i, _ in pairs], np.int64)
    w, bias = np.zeros(size), float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    m, v, mb, vb = np.zeros(size), np.zeros(size), 0.0, 0.0
    for t in range(1, rounds + 1):
        z = bias + np.bincount(rows, w[cols], len(x))
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        slope = (p - y) / len(y)
        if len(pairs):
            # Penalty on (score - score of the counterfactual) squared, mean over the pairs.
            zc = bias + np.bincount(prow, w[pcol], len(pairs))
            gap = 2 * pairing * (z[base] - zc) / len(pairs)
            slope = slope + np.bincount(base, gap, len(x))
        g = np.bincount(cols, slope[rows], size) + ridge * w
        gb = ((p - y) / len(y)).sum()
        if len(pairs):
            g -= np.bincount(pcol, gap[prow], size)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        rate = 0.2 * (1 - t / rounds) + 0.005
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        bias -= rate * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.999**t)) + 1e-8)
    return w, bias


def fit(docs: DataFrame, labels: DataFrame, terms: Sequence[Sequence[str]] = IDENTITY_TERMS, sample: int = 20_000,
        most_features: int = 8_192, pairing: float = 5.0, ridge: float = 1e-5, rounds: int = 400,
        swaps: int = 2) -> Model:
    """Fit on ``docs`` (doc_id, text) joined with ``labels`` (doc_id, toxic).

    At most ``sample`` labelled rows are used, those of lowest hash of the id; they are the only rows that
    any step here sees, and bound what the driver holds. Labels other than 0 and 1 are left out; if a
    document has several, toxic counts. ``pairing`` weighs the penalty on swaps, ``swaps`` is the number of
    counterfactuals of a text with identity terms. Without labelled rows every score is one half.
    """
    spark = small_batches(docs.sparkSession)
    ids = (labels.filter(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    rows = docs.select("doc_id", text_of(docs).alias("text")).join(F.broadcast(ids), "doc_id").select("text", "label")
    sizes = {r["label"]: r["n"] for r in ids.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model(np.zeros(CELLS), 0.0)
    cells = chosen_cells(class_counts(rows), sizes.get(0, 0), sizes.get(1, 0), most_features)
    cells = np.union1d(cells, term_cells(terms))
    shipped = spark.sparkContext.broadcast(cells)

    def held(texts: list[str]) -> list[np.ndarray]:
        """Numbers of the chosen features in each text."""
        out = []
        for _, group in groups(texts):
            docs, found = features(words_of(group))
            at = np.searchsorted(shipped.value, found)
            at[at == len(shipped.value)] = 0
            hit = shipped.value[at] == found if len(shipped.value) else np.zeros(len(found), bool)
            pairs = np.unique(docs[hit] * CELLS + at[hit])
            out += np.split(pairs % CELLS, np.searchsorted(pairs // CELLS, np.arange(1, len(group))))
        return out

    def prepared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["text"].tolist()
            other = [[s for k in range(1, swaps + 1) if (s := swapped(t, terms, k))] for t in texts]
            moved = iter(held([s for group in other for s in group]))
            yield pd.DataFrame({"x": held(texts), "other": [[next(moved).tolist() for _ in group] for group in other],
                                "label": pdf["label"]})

    data = rows.mapInPandas(prepared, "x array<int>, other array<array<int>>, label int").toPandas()
    # Rows come back in any order; sums of floats should not depend on it.
    data["x"] = [np.asarray(r, np.int64) for r in data["x"]]
    order = sorted(range(len(data)), key=lambda i: (data["label"].iat[i], data["x"].iat[i].tolist(),
                                                    [list(o) for o in data["other"].iat[i]]))
    data = data.iloc[order].reset_index(drop=True)
    pairs = [(i, np.asarray(o, np.int64)) for i, group in enumerate(data["other"]) for o in group]
    w, bias = _descend(data["x"].tolist(), data["label"].to_numpy(float), pairs, len(cells), pairing, ridge, rounds)
    weights = np.zeros(CELLS)
    weights[cells] = w
    return Model(weights, bias)


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """Every row with ``score`` (0 to 1) and ``predicted`` (1 from a half on).

    Null texts count as empty and get the score of a text without any feature. Rows, repeated ones too,
    stay as they are; input columns named as a result are replaced.
    """
    spark = small_batches(docs.sparkSession)
    shipped = spark.sparkContext.broadcast(model)
    source = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("score", "predicted")],
                         text_of(docs).alias("_text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            scores = shipped.value.scores(pdf.pop("_text").tolist())
            yield pdf.assign(score=scores, predicted=(scores >= 0.5).astype(np.int32))

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name != "_text"]
    return source.mapInPandas(run, ", ".join([*fields, "score double, predicted int"]))


def held_out(rows: DataFrame):
    """Rows never learned from: the contract's fifth."""
    return F.coalesce(F.crc32(F.coalesce(column_or(rows, "doc_id", "string"), F.lit("")).cast("binary")) % 5 == 0, F.lit(False))


def query(spark, sf_dir: str) -> DataFrame:
    """``op1``: the score of every whole text, learned from the labelled rows that are not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit(docs, labels.filter(~held_out(labels)))
    return classify(docs.select("doc_id", "text", held_out(docs).alias("held_out")), model).select(
        "doc_id", "held_out", "score", "predicted")
