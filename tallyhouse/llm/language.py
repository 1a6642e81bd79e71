"""Language identification: scripts narrow the candidates of each word, Viterbi labels spans of mixed text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.letters import OTHER, Words, groups, mixed, words_of
from tallyhouse.llm.tables import column_or, small_batches, text_of

#: Trigrams are counted in so many cells.
CELL_BITS = 16
CELLS = 1 << CELL_BITS
UNDETERMINED = "und"


def trigram_cells(w: Words) -> np.ndarray:
    """For each letter: the cell of itself and its neighbours in its word (0 beyond the word)."""
    p = w.points.astype(np.uint64)
    at = np.flatnonzero(w.letter)
    first = np.zeros(len(p) + 1, bool)
    first[w.starts] = True
    last = np.zeros(len(p) + 1, bool)
    last[w.ends - 1] = True
    before = np.where(first[at], 0, p[at - 1])
    after = np.where(last[at], 0, p[np.minimum(at + 1, len(p) - 1)])
    return (mixed(before * np.uint64(1 << 42) + p[at] * np.uint64(1 << 21) + after) >> np.uint64(64 - CELL_BITS)).astype(np.int64)


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # cell x language: log probability, less the mean over the languages
    allowed: np.ndarray  # script x language: whether the language is written in it
    penalty: float

    def word_scores(self, w: Words) -> np.ndarray:
        """Word x language."""
        if not len(w.starts):
            return np.zeros((0, len(self.languages)))
        lengths = w.ends - w.starts
        begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        summed = np.add.reduceat(self.scores[trigram_cells(w)], begins, axis=0).astype(np.float64)
        allowed = self.allowed[w.script]
        # A script that no language is known to use says nothing.
        return np.where(allowed, summed, np.where(allowed.any(1, keepdims=True), -1e4, 0.0))

    def known(self, w: Words) -> np.ndarray:
        """Whether each word is in a script that some language is known to use."""
        return self.allowed.any(1)[w.script]


def fit(rows: DataFrame, penalty: float = 16.0, least_share: float = 0.001, floor: float = 1e-6) -> Model:
    """Count trigrams and scripts of rows ``text, lang`` per language, over all rows.

    A task adds up its rows and sends one row per cell and language at most. The model has
    ``CELLS`` rows per language, whatever the input. ``floor`` is the least probability of a trigram;
    a language is written in a script that has ``least_share`` of its letters.
    """
    rows = rows.select(text_of(rows).alias("text"), F.col("lang").cast("string").alias("lang")).filter("lang is not null")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, np.ndarray] = {}
        for pdf in batches:
            for lang, texts in pdf.groupby("lang")["text"]:
                cells = seen.setdefault(lang, np.zeros(CELLS + OTHER + 1, np.int64))
                for _, group in groups(texts.tolist()):
                    w = words_of(group)
                    cells[:CELLS] += np.bincount(trigram_cells(w), minlength=CELLS)
                    cells[CELLS:] += np.bincount(w.script, w.ends - w.starts, OTHER + 1).astype(np.int64)
        for lang, cells in seen.items():
            at = np.flatnonzero(cells)
            yield pd.DataFrame({"lang": lang, "cell": at, "n": cells[at]})

    counts = rows.mapInPandas(count, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    found = counts.toPandas()
    languages = sorted(found["lang"].unique())
    table = np.zeros((CELLS + OTHER + 1, len(languages)))
    table[found["cell"], found["lang"].map({x: i for i, x in enumerate(languages)}).astype(int)] = found["n"]
    grams, scripts = table[:CELLS], table[CELLS:]
    logs = np.log(grams / np.maximum(grams.sum(0), 1) + floor)
    share = scripts / np.maximum(scripts.sum(0), 1)
    return Model(languages, (logs - logs.mean(1, keepdims=True)).astype(np.float32) if languages else logs,
                 share >= least_share, penalty)


def viterbi(scores: np.ndarray, penalty: float) -> np.ndarray:
    """The labels of best total score, less ``penalty`` for each change; ties go to staying, then to the first."""
    n, k = scores.shape
    back, m = [], scores[0].tolist()
    for row in scores[1:].tolist():
        top = max(m)
        j = m.index(top)
        top -= penalty
        back.append([j if top > m[i] else i for i in range(k)])
        m = [(top if top > m[i] else m[i]) + row[i] for i in range(k)]
    at = m.index(max(m))
    path = [at]
    for step in reversed(back):
        at = step[at]
        path.append(at)
    return np.array(path[::-1])


def one_language(scores: np.ndarray, starts: np.ndarray, penalty: float) -> tuple[np.ndarray, np.ndarray]:
    """For each text (words from its start on): its best single language, and whether no mixture can beat it.

    A labelling with n spans changes n - 1 times, at least n / 2 times if n > 1. So if no run of words gains
    over half the penalty by another language, none pays.
    """
    best = np.add.reduceat(scores, starts, axis=0).argmax(1)
    doc = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(scores))))
    own = scores[np.arange(len(scores)), best[doc]]
    most = np.zeros(len(starts))
    for k in range(scores.shape[1]):
        total = np.cumsum(scores[:, k] - own)
        before = np.concatenate([[0.0], total[:-1]])
        # Lowest sum before a word, within its text: each text lies a step below those before it.
        step = (np.ptp(np.append(total, 0)) + 1) * doc
        low = np.minimum.accumulate(before - step) + step
        most = np.maximum(most, np.maximum.reduceat(total - low, starts))
    return best, most <= penalty / 2


def label(model: Model, texts: list[str]) -> Iterator[tuple[str, float, list[int], list[int], list[str]]]:
    """Language, its share of the letters, and the spans (begin, end, language) of each text.

    Words in a script that no language is known to use are of no language and in no span, but count as letters.
    """
    for _, group in groups(texts):
        w = words_of(group)
        lengths = w.ends - w.starts
        whole = np.bincount(w.doc, lengths, len(group))
        # Such words score 0 for all, so the best path over the others is that over all.
        at = np.flatnonzero(model.known(w))
        scores = model.word_scores(w)[at]
        held, starts = np.unique(w.doc[at], return_index=True)
        ends = np.append(starts[1:], len(scores))
        if len(held) and model.languages:
            best, sure = one_language(scores, starts, model.penalty)
        place = dict(zip(held.tolist(), range(len(held)), strict=True))
        for i in range(len(group)):
            if not whole[i] or not model.languages:
                yield UNDETERMINED, 0.0, [], [], []
                continue
            if i not in place:
                yield model.languages[0], 0.0, [], [], []
                continue
            k = place[i]
            words, base = at[starts[k]:ends[k]], w.offsets[i]
            path = np.full(len(words), best[k]) if sure[k] else viterbi(scores[starts[k]:ends[k]], model.penalty)
            own = model.allowed[w.script[words], path]
            letters = np.bincount(path, lengths[words] * own, len(model.languages))
            first = np.concatenate([[0], np.flatnonzero((np.diff(path) != 0) | (np.diff(words) > 1)) + 1])
            last = np.append(first[1:], len(words)) - 1
            yield (model.languages[letters.argmax()], float(letters.max() / whole[i]),
                   (w.starts[words[first]] - base).tolist(), (w.ends[words[last]] - base).tolist(),
                   [model.languages[p] for p in path[first]])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Every row with ``lang_pred, score`` and its spans ``span_begin, span_end, span_lang`` (code points).

    ``lang_pred`` has most of the letters and ``score`` their share of all letters; those of a script that no
    language is known to use are of none. A text with only such letters has score 0, no span, and a label without
    meaning, the first language. A text that is null or has no letter is ``und`` with score 0 and no span; so is
    every text if nothing was learned. Rows, repeated ones
    too, stay as they are; input columns named as a result are replaced.
    """
    spark = small_batches(docs.sparkSession)
    names = ["lang_pred", "score", "span_begin", "span_end", "span_lang"]
    shipped = spark.sparkContext.broadcast(model)
    source = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in names], text_of(docs).alias("_text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = list(label(shipped.value, pdf.pop("_text").tolist()))
            yield pd.concat([pdf, pd.DataFrame(rows, columns=names, index=pdf.index)], axis=1)

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name != "_text"]
    return source.mapInPandas(run, ", ".join([
        *fields, "lang_pred string, score double, span_begin array<int>, span_end array<int>, span_lang array<string>"]))


def held_out(docs: DataFrame):
    """Rows kept from learning: the contract's quarter."""
    return F.coalesce(F.crc32(F.coalesce(column_or(docs, "doc_id", "string"), F.lit("")).cast("binary")) % 4 == 2, F.lit(False))


def learned(docs: DataFrame) -> Model:
    return fit(docs.filter(~held_out(docs)))


def query(docs: DataFrame) -> DataFrame:
    """``op10``: the language of every whole text, learned from three quarters of the rows."""
    docs = docs.select("doc_id", "text", "lang")
    model = learned(docs)
    return identify(docs.select("doc_id", "text", held_out(docs).alias("held_out")), model).select(
        "doc_id", "held_out", "lang_pred", "score")
