"""Personal data: the base spans as written plainly, what the surroundings add, odd rows."""

import hashlib
import random
import re

from tallyhouse.llm import pii
from tallyhouse.llm.tables import table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# The contract's patterns, as written there.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                    "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def check(spark, rows):
    frame = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA)
    got = {r["doc_id"]: r for r in pii.query(frame).collect()}
    for i, text in rows:
        want = plain(text)
        r = got[i]
        assert [r[f"n_{k}"] for k in PLAIN] == [sum(s[0] == k for s in want) for k in PLAIN], text
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest(), (text, joined, r["spans"])
        assert not want or set(joined.split(",")) <= set(r["spans"].split(","))
    return got


def test_base(spark):
    texts = ["", None, "a@b.c_d@x.y z", "é a@b.c", "a@b", "x@y.z@q.r.s", "1.2.3.4.5.6.7.8", "1.2.3.256 256.1.1.1", "0001.2.3.000255",
             "4111 1111 1111 1111", "4111-1111-1111-1111.", "4111  1111 1111 1111", "12 4111111111111111", "+1 (555) 010-9999.", "+1 () 2",
             "++49 30 1234567", "🙂 +49 30 1234567 ip 10.0.0.1", "9" * 5000, "a" * 200_000 + "@b.c", "1." * 50_000, "1 " * 50_000,
             "a.b@" * 3000, "x@y" + ".z" * 20_000, "+1" + " 2" * 20_000]
    check(spark, list(enumerate(texts)))


def test_random_strings(spark):
    rng = random.Random(4)
    bits = ["a", "b1", "@", ".", "-", " ", "+", "(", ")", "1", "22", "333", "4111111111111111", "255", "256", "_", "%", "é", "\n", "5555 5555 5555 4444"]
    check(spark, [(i, "".join(rng.choice(bits) for _ in range(rng.randint(1, 40)))) for i in range(3000)])


def test_table(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text").collect()
    check(spark, [(r["doc_id"], r["text"]) for r in docs])


def planted():
    rows, i = [], 0
    for k in range(12):
        rows.append((i, f"Hello there. My phone number is +1 555 010 {1000 + k} so call."))
        rows.append((i + 1, f"please write email to user{k}@example.org for details"))
        rows.append((i + 2, f"Chapter {k} has 12345{k} words of plain text, in total."))
        i += 3
    rows.append((900, "Only for you: my phone number is 555-010-7777, thanks."))
    rows.append((901, "please write email to jane@localhost for details"))
    # Seen beside a known identifier's context only through the one found in 900.
    rows += [(910 + k, f"the office dials 555-010-7777 daily {k}") for k in range(2)]
    return rows


def test_unseen_identifiers(spark):
    got = check(spark, planted())
    text = dict(planted())

    def added(i):
        base = {f"{k}:{a}:{b}" for k, a, b in plain(text[i])}
        return [(s.split(":")[0], text[i][int(s.split(":")[1]):int(s.split(":")[2])]) for s in got[i]["spans"].split(",") if s and s not in base]

    assert added(900) == [("phone", "555-010-7777")]
    assert added(901) == [("email", "jane@localhost")]
    assert all(added(i) == [] for i in text if i < 900)
    assert got[900]["n_added"] == 1 and got[900]["n_phone"] == 0


def test_odd_tables(spark):
    assert pii.query(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, "a@b.c", "en", "s", 1), (1, "a@b.c", "en", "s", 1), (1, "no", "en", "s", 1), (None, "1.1.1.1", "en", "s", 1)]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as base", "2 as mark", "3 as candidates")
    got = sorted((str(r["doc_id"]), r["n_email"], r["n_ip"], r["spans"]) for r in pii.query(frame).collect())
    assert got == [("1", 0, 0, ""), ("1", 1, 0, "email:0:5"), ("1", 1, 0, "email:0:5"), ("None", 0, 1, "ip:0:7")]
