"""Line dedup: lines of few words are held against all earlier lines like any other."""

import pytest
from test_lines import brute, frame_of, got, made

from tallyhouse.llm import lines
from tallyhouse.llm.tables import table

FOOTER = "All rights reserved"


def test_short_copies_leave(spark):
    rows = [(1, f"first text of its own here\n{FOOTER}\n\n日本語の文章"), (2, f"{FOOTER}\n\n日本語の文章\n日本語の別の文"),
            (3, f"ALL  rights RESERVED\n{'no ' * 500}"), (4, "no"), (None, f"reserved rights all\n{FOOTER} now"),
            (6, "a b c d e"), (7, "a b c d\nb c d"), (8, "d c b\nd c b a")]
    found = got(frame_of(spark, rows))
    assert found == brute(rows)
    assert found[2] == (4, 2, "\n日本語の別の文") and found[4] == (1, 1, "") and found[None] == (2, 1, f"{FOOTER} now")
    # Four words of five are 80 percent.
    assert found[7][2] == "b c d" and found[8][1] == 2


@pytest.mark.parametrize("seed", [3, 4])
def test_all_sizes(spark, seed, monkeypatch):
    if seed == 4:
        monkeypatch.setattr(lines, "BROADCAST_LINES", 0)
    rows = [(i, f"{t}\n{' '.join(t.split()[:i % 6])}\n \t") for i, t in made(seed)]
    want = brute(rows)
    assert want != brute(rows, least=5)
    assert got(frame_of(spark, rows)) == want


def test_table(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    assert got(docs) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])
