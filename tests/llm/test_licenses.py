import random
import re

import pytest

from tallyhouse.llm import licenses
from tallyhouse.llm.licenses import TEMPLATES, Template

GAP = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(docs, templates=TEMPLATES):
    out = []
    for i, text in docs:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = [w for w in GAP.split(low) if w]
        places, base, labels, score = [], set(), set(), 0.0
        for t in templates:
            if t.phrase:
                at = [p for p in range(len(words)) if tuple(words[p:p + len(t.words)]) == t.words]
                places += at
                if at:
                    base.add(t.label)
                    labels.add(t.label)
                    score = 1.0
                continue
            own = set(t.words)
            for a in range(0, len(words), t.span):
                k = len(own & set(words[a:a + 2 * t.span]))
                if 100 * k >= t.percent * len(own):
                    labels.add(t.label)
                    score = max(score, k / len(own))
        out.append((i, len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
                    ",".join(sorted(labels)), score))
    return sorted(out, key=str)


def got(spark, docs, templates=TEMPLATES):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, label string, row int")
    return sorted(map(tuple, licenses.scan(df, templates).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_brute_force(spark, seed):
    r = random.Random(seed)
    noise = ["license", "cc", "by", "mit", "the", "of", "Ünïcode", "software", "x", "y1"] + [f"n{i}" for i in range(30)]

    def text():
        parts = [[r.choice(noise) for _ in range(r.randrange(0, 150))] for _ in range(3)]
        for p in parts:
            t = r.choice(TEMPLATES)
            kept = [w.upper() if r.random() < 0.2 else w for w in t.words if r.random() > r.choice([0, 0, 0.1, 0.25])]
            at = r.randrange(len(p) + 1)
            p[at:at] = kept
        return r.choice([" ", "\n", ", ", "\x00"]).join(w for p in parts for w in p)

    docs = [(i, text()) for i in range(150)]
    docs += docs[:5] + [(None, docs[0][1]), (None, None), (1, ""), (2, " - "), (3, "CC BY"), (4, ".cc/by/cc\tby."), (5, "ccby")]
    docs += [(6, "K mit licenſe"), (7, "w " * 300_000 + "MIT License " * 3 + "the software " * 200_000)]
    assert got(spark, docs) == brute(docs)


def test_places_at_the_seams_of_blocks(spark):
    docs = [(i, "w " * i + "GNU General\nPublic  License, version 3" + " v" * (200 - i)) for i in range(120, 136)]
    found = got(spark, docs)
    assert found == brute(docs)
    assert all(r[2:6] == (1, r[0], r[0], "gpl") for r in found)


def test_own_templates_of_any_length(spark):
    r = random.Random(3)
    long = tuple(f"t{i % 230}" for i in range(300))
    templates = (Template("long", long, 80, False), Template("short", ("one",), 100, True), Template("none", (), 80, False),
                 Template("two", ("t1", "two"), 50, False))
    docs = []
    for i in range(40):
        words = ["f"] * r.randrange(0, 700) + [w for w in long if r.random() > 0.2] + ["g"] * r.randrange(0, 700)
        words[r.randrange(len(words))] = "one"
        docs.append((i, " ".join(words)))
    assert got(spark, docs, templates) == brute(docs, tuple(t for t in templates if t.words))


def test_clean_texts_and_empty_tables(spark):
    docs = [(1, "Driving license rules of the city. Public software by general request; mit Freude."), (2, "license")]
    assert [r[5:] for r in got(spark, docs)] == [("", "", 0.0)] * 2
    assert got(spark, []) == []
    assert got(spark, docs, ()) == [(1, 13, 0, None, None, "", "", 0.0), (2, 1, 0, None, None, "", "", 0.0)]
