"""Line dedup: equal to brute force over all earlier lines, copies in many documents, odd rows."""

import re

import numpy as np
import pytest

from tallyhouse.llm import lines
from tallyhouse.llm.tables import table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(line):
    return frozenset(w for w in re.split(r"[\x20\x09-\x0D]+", line.lower()) if w)


def brute(rows, least=1):
    """doc_id -> (lines, removed, text) for rows of different ids; null id last."""
    seen, out = [], {}
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        kept, parts = [], (text or "").split("\n")
        for line in parts:
            w = words(line)
            match = len(w) >= least and any(100 * len(w & o) >= 80 * len(w | o) for o in seen if 4 * len(o) <= 5 * len(w) and 4 * len(w) <= 5 * len(o))
            if len(w) >= least:
                seen.append(w)
            if not match:
                kept.append(line)
        out[i] = (len(parts), len(parts) - len(kept), None if text is None else "\n".join(kept))
    return out


def got(frame):
    return {r["doc_id"]: (r["n_lines"], r["n_removed"], r["text"]) for r in lines.query(frame).collect()}


def frame_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA)


def made(seed):
    rng = np.random.default_rng(seed)
    vocabulary = [f"W{i}" for i in range(400)]
    pool = [list(rng.choice(vocabulary, int(rng.integers(1, 40)), p=None)) for _ in range(60)]
    rows = []
    for i in range(80):
        text = []
        for _ in range(int(rng.integers(0, 8))):
            line = list(pool[int(rng.integers(len(pool)))])
            for _ in range(int(rng.integers(0, 5))):
                line[int(rng.integers(len(line)))] = str(rng.choice(vocabulary))
            if rng.random() < 0.3:
                line = line[:-1]
            text.append((" " if rng.random() < 0.9 else "\t \r").join(line).lower() if rng.random() < 0.5 else "  ".join(line))
        rows.append((i * 7 % 80, "\n".join(text)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_brute_force(spark, seed, monkeypatch):
    if seed == 2:
        monkeypatch.setattr(lines, "BROADCAST_LINES", 0)
    rows = made(seed)
    want = brute(rows)
    assert sum(r[1] for r in want.values()) > 40
    assert got(frame_of(spark, rows)) == want


def test_table(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    assert got(docs) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_odd_rows(spark):
    line = "one two three four five six"
    rows = [(3, f"{line}\n\n{line} \nshort line"), (1, None), (2, ""), (None, f"ONE two three four five six\nshort line\n{'x y z q r s ' * 50_000}"),
            (9, "\n\n"), (4, "Ünïcode wörds ARE lowered hére too"), (5, "ünïcode WÖRDS are lowered hére too")]
    assert got(frame_of(spark, rows)) == brute(rows)
    assert lines.query(frame_of(spark, []).limit(0)).count() == 0
    assert lines.query(frame_of(spark, [(1, None), (2, "")])).count() == 2
    twice = frame_of(spark, [(1, line), (1, line), (2, line)]).selectExpr("*", "1 as row", "2 as n", "3 as mark", "'k' as key", "4 as n_removed")
    found = sorted((r["doc_id"], r["text"], r["n_removed"]) for r in lines.deduplicate(twice).collect())
    assert found == [(1, line, 0), (1, line, 0), (2, "", 1)]


def test_hot_line(spark):
    line = "the same line in all of the many documents"
    rows = [(i, f"{line}\nown words of {i} a{i} b{i} c{i} d{i}") for i in range(3000)]
    found = got(frame_of(spark, rows))
    assert found[0][1] == 0 and all(found[i][1] == 1 for i in range(1, 3000))


def test_near_copies_under_one_id_or_none(spark):
    """Of different texts under one doc_id, one is before the other, whatever the order of the rows."""
    a, b = "one two three four five six seven eight nine ten", "one two three four five six seven eight nine eleven"
    for i in (5, None):
        for rows in ([(i, a), (i, b)], [(i, b), (i, a)]):
            found = sorted(r["n_removed"] for r in lines.query(frame_of(spark, rows)).collect())
            assert found == [0, 1]
    rows = [(1, f"{a}\nown line of this very text"), (None, b), (None, f"x y z\n{b}"), (1, b)]
    assert sorted((r["doc_id"] or -1, r["n_removed"]) for r in lines.query(frame_of(spark, rows)).collect()) in (
        [(-1, 1), (-1, 1), (1, 0), (1, 1)], [(-1, 1), (-1, 1), (1, 1), (1, 0)])
