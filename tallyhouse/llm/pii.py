"""Personal data: fixed patterns and labelled secrets seed the search, and what surrounds the seeds finds identifiers they miss.

The words around seeds are lexical patterns. Patterns and identifiers form a graph: a pattern is as good as
the identifiers it surrounds, an identifier as good as the patterns around it. A few rounds of scoring
go back and forth, then patterns of high confidence mark the unseen identifiers in their place. Only
DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.tables import column_or, text_of, written

# The base patterns, in the order of the kinds. Possessive, and starting where a run of their first
# characters starts (or behind the last match), they find the same as written plainly, in linear time.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = r"[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a pattern to be tried.
_NEEDS = {"email": "@", "phone": "+"}
_PART = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
# What does not part tokens: all but white space, quotes, brackets and the signs between a label and its value.
_TOKEN = r"""[^\s"'`=:,;<>|(){}\[\]]"""
_BARE = r"""[^\s"'`=:,;<>|(){}\[\]0-9@]"""
_DIGITS = r"[0-9]++(?![\p{L}@_])"
#: Whatever may be an identifier: a token with an at sign or with a letter and a digit; a run as in phones; or
#: groups of digits with up to two separators between them.
CANDIDATE = (rf"(?<!{_TOKEN})(?={_BARE}*+[0-9@])(?=[^\s\p{{L}}@\"'`=:,;<>|(){{}}\[\]]*+[\p{{L}}@]){_TOKEN}++"
             rf"|{PATTERNS['phone']}|\(?{_DIGITS}(?:[\x20().-]{{0,2}}{_DIGITS})*+")
# Labels of secrets, and the public format of access key ids.
SECRET_LABELS = ("password", "passwd", "pwd", "secret", "token", "apikey", "key")
ACCESS_KEY = r"^A[KS]IA[0-9A-Z]{16}$"
#: A labelled secret has so many characters, one of them a digit.
LEAST_SECRET = 8
#: Kinds that spans can have: secrets are no base kind, so their spans are all among the added ones.
ALL_KINDS = (*KINDS, "secret")
#: An unseen identifier holds an at sign or so many digits.
LEAST_DIGITS = 5
#: Rounds of scoring; identifiers that must support a pattern; confidence from which a pattern or identifier
#: counts; what an identifier of no known kind weighs against a pattern.
ROUNDS, SUPPORT, CONFIDENCE, UNKNOWN = 3, 3, 0.9, 0.2


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value worked out once however often it is named."""
    return F.transform(F.array(value), use)[0]


def _running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """Every element joined with all before it, in as many passes as the length has binary digits.

    ``join`` has to be associative and to give its first argument where the second is null.
    """
    def passes(whole: Column) -> Column:
        steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(whole) + 1)).cast("int"))
        return F.aggregate(steps, whole, lambda done, k: F.transform(
            done, lambda x, i: join(x, F.get(done, i - F.pow(F.lit(2), k).cast("int")))))

    return _let(values, passes)


def _found(text: Column, pattern: str) -> Column:
    """All matches as ``start, stop, value``, and in ``gap`` the text between each and the match before it."""
    def spans(values: Column, gaps: Column) -> Column:
        parts = F.zip_with(F.slice(gaps, 1, F.size(values)), values, lambda g, v: F.struct(
            g.alias("gap"), v.alias("value"), F.length(v).alias("long"), (F.length(g) + F.length(v)).alias("step")))
        return _let(parts, lambda p: F.zip_with(p, _running(F.transform(p, lambda x: x["step"]), lambda x, y: x + F.coalesce(y, F.lit(0))),
                    lambda x, stop: F.struct((stop - x["long"]).alias("start"), stop.alias("stop"), x["value"].alias("value"), x["gap"].alias("gap"))))

    return _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda values: spans(values, F.split(text, pattern, -1)))


def _luhn(digits: Column) -> Column:
    def worth(i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda s, i: s + worth(i)) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """``kind, start, stop`` of the fixed patterns, by kind and start."""
    none = F.expr("cast(array() as array<struct<kind:string,start:int,stop:int>>)")

    def of(kind: str) -> Column:
        held = F.filter(_found(text, PATTERNS[kind]), lambda s: _valid(kind, s["value"]))
        spans = F.transform(held, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["stop"].alias("stop")))
        needed = text.contains(_NEEDS[kind]) if kind in _NEEDS else text.rlike("[0-9][ .-]?[0-9]")
        return F.when(needed, spans).otherwise(none)

    return F.concat(*[of(kind) for kind in KINDS])


def _met(spans: Column, base: Column) -> Column:
    """For each of ``spans`` (apart and in order) the kind of the base span it meets, of several the one that ends last; else null.

    A span meets a base span if, of those that start before its end, the one that ends last ends behind its
    start. So one pass over both in order tells it, instead of a comparison of every span with every other.
    """
    none = F.struct(F.lit(-1).alias("stop"), F.lit("").alias("kind"))
    own = F.transform(spans, lambda s: F.struct(s["stop"].alias("at"), F.lit(0).alias("base"), none.alias("reach"), s["start"].alias("start")))
    known = F.transform(base, lambda b: F.struct(b["start"].alias("at"), F.lit(1).alias("base"), F.struct(
        b["stop"].alias("stop"), b["kind"].alias("kind")).alias("reach"), b["start"].alias("start")))

    def kinds(events: Column) -> Column:
        reach = _running(F.transform(events, lambda e: e["reach"]), F.greatest)
        both = F.zip_with(events, reach, lambda e, r: F.struct(e["base"].alias("base"), e["start"].alias("start"), r.alias("reach")))
        return F.transform(F.filter(both, lambda e: e["base"] == 0),
                           lambda e: F.when(e["reach"]["stop"] > e["start"], e["reach"]["kind"]))

    return _let(F.array_sort(F.concat(own, known)), kinds)


def _edges(gap: Column) -> Column:
    """``first, one, two``: the first, last and last but one word of a gap, in lower case; ``label``: whether it ends with = or :."""
    words = F.filter(F.split(F.regexp_replace(F.lower(gap), r"[^\p{L}\p{N}]+", " "), " "), lambda w: w != "")
    return _let(words, lambda w: F.struct(
        F.get(w, F.lit(0)).alias("first"), F.try_element_at(w, F.lit(-1)).alias("one"), F.try_element_at(w, F.lit(-2)).alias("two"),
        gap.rlike(r"""[=:][\s"'`(\[{]*+$""").alias("label")))


def candidates(text: Column, base: Column) -> Column:
    """``start, stop, value, kind, contexts`` of what may be an identifier.

    The kind is that of a base span it meets, ``secret`` if its label or format says so, or null. Contexts are the
    two words before it, the word on either side, and the word before an equals sign or colon; another
    candidate counts as the word #, the ends of the text as ^ and $.
    """
    none = F.expr("cast(array() as array<struct<start:int,stop:int,value:string,kind:string,contexts:array<string>>>)")

    def trimmed(s: Column) -> Column:
        lead = F.length(F.regexp_extract(s["value"], r"^[^\p{L}\p{N}+]*", 0))
        tail = F.length(F.regexp_extract(s["value"], r"[^\p{L}\p{N}]*+$", 0))
        return F.struct((s["start"] + lead).alias("start"), (s["stop"] - tail).alias("stop"),
                        F.substring(s["value"], lead + 1, F.length(s["value"]) - lead - tail).alias("value"))

    def rows(found: Column) -> Column:
        tail = F.substring(text, F.coalesce(F.try_element_at(found, F.lit(-1))["stop"], F.lit(0)) + 1, F.length(text))
        gaps = F.transform(F.concat(F.transform(found, lambda s: s["gap"]), F.array(tail)), _edges)
        spans = F.transform(found, trimmed)
        return _let(F.struct(gaps.alias("gaps"), spans.alias("spans")), lambda x: F.zip_with(
            F.transform(x["spans"], lambda s, i: F.struct(s.alias("s"), i.alias("i"), x["gaps"][i].alias("g"),
                                                          F.get(x["gaps"], i - 1)["one"].alias("far"), x["gaps"][i + 1]["first"].alias("next"),
                                                          (i + 1 == F.size(x["spans"])).alias("end"))),
            _met(x["spans"], base), row))

    def row(x: Column, met: Column) -> Column:
        s, g = x["s"], x["g"]
        edge = F.when(x["i"] > 0, F.lit("#")).otherwise(F.lit("^"))
        one = F.coalesce(g["one"], edge)
        two = (F.when(g["one"].isNotNull(), F.coalesce(g["two"], edge))
               .when(x["i"] > 0, F.coalesce(x["far"], F.when(x["i"] > 1, F.lit("#")).otherwise(F.lit("^")))).otherwise(F.lit("^")))
        after = F.coalesce(x["next"], F.when(x["end"], F.lit("$")).otherwise(F.lit("#")))
        labelled = g["label"] & g["one"].isin(*SECRET_LABELS) & (F.length(s["value"]) >= LEAST_SECRET) & s["value"].rlike("[0-9]")
        kind = F.coalesce(met, F.when(labelled | s["value"].rlike(ACCESS_KEY), F.lit("secret")))
        contexts = F.array(F.concat_ws(" ", two, one, F.lit("_")), F.concat_ws(" ", one, F.lit("_"), after),
                           F.when(g["label"] & g["one"].isNotNull(), F.concat(one, F.lit("=_"))))
        return F.struct(s["start"].alias("start"), s["stop"].alias("stop"), F.lower(s["value"]).alias("value"),
                        kind.alias("kind"), F.array_compact(contexts).alias("contexts"))

    return F.when(text.rlike("[0-9@]"), F.filter(_let(_found(text, CANDIDATE), rows), lambda c: c["start"] < c["stop"])).otherwise(none)


def _identifier(value: Column) -> Column:
    return value.contains("@") | (F.length(F.regexp_replace(value, "[^0-9]", "")) >= LEAST_DIGITS)


def patterns(edges: DataFrame, known: DataFrame) -> DataFrame:
    """``context, kind, confidence`` of contexts (edges: context, value) that enough known identifiers (value, kind, score) support.

    The confidence is the score of the identifiers of the kind, by that plus those of other kinds plus a
    fraction of those of no known kind. Contexts are added up task by task first, so a frequent one is no
    hot key.
    """
    # An identifier known for two kinds counts for the better.
    best = known.groupBy("value").agg(F.max(F.struct("score", "kind")).alias("k")).select("value", "k.score", "k.kind")
    met = edges.join(best, "value", "left")
    sums = [F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("score"))), F.lit(0.0)).alias(k) for k in ALL_KINDS]
    counts = [F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in ALL_KINDS]
    totals = met.groupBy("context").agg(*sums, *counts, F.count(F.when(F.col("kind").isNull(), 1)).alias("unknown"))
    top = F.greatest(*[F.struct(F.col(k).alias("score"), F.col(f"n_{k}").alias("n"), F.lit(k).alias("kind")) for k in ALL_KINDS])
    whole = sum((F.col(f"n_{k}") for k in ALL_KINDS), F.lit(0)) + F.lit(UNKNOWN) * F.col("unknown")
    return (totals.withColumn("_top", top).filter(F.col("_top.n") >= SUPPORT)
            .select("context", F.col("_top.kind").alias("kind"), (F.col("_top.score") / whole).alias("confidence"))
            .filter(F.col("confidence") >= CONFIDENCE))


def bootstrapped(occurrences: DataFrame) -> DataFrame:
    """The patterns (context, kind, confidence) after some rounds over rows ``value, kind, contexts``."""
    edges = written(occurrences.select("value", "kind", F.explode("contexts").alias("context"))
                    .filter(F.col("kind").isNotNull() | _identifier(F.col("value")))
                    .groupBy("context", "value").agg(F.max("kind").alias("kind")), "edges")
    seeds = edges.filter("kind is not null").select("value", "kind", F.lit(1.0).alias("score")).distinct()
    edges, known = edges.select("context", "value"), seeds
    for _ in range(ROUNDS):
        good = written(patterns(edges, known), "patterns")
        # An identifier is wrong only if all patterns around it are.
        doubt = F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9))))
        found = (edges.join(good, "context").groupBy("value", "kind").agg((1 - F.exp(doubt)).alias("score"))
                 .filter(F.col("score") >= CONFIDENCE).join(seeds.select("value"), "value", "left_anti"))
        known = written(seeds.unionByName(found.select("value", "kind", "score")), "known")
    return patterns(edges, known)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def _in_order(spans: Column) -> Column:
    place = F.create_map(*[x for i, k in enumerate(ALL_KINDS) for x in (F.lit(k), F.lit(i))])
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(
        place[s["kind"]].alias("place"), s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"))))
    return F.transform(ordered, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop")))


def find(docs: DataFrame) -> DataFrame:
    """``doc_id, mark, base, added``: the spans (kind, start, stop in code points) of every row of ``docs`` (doc_id, text).

    ``base`` are those of the fixed patterns, ``added`` secrets (labelled, or in the format of access keys) and
    what only its surroundings give away; these meet no base span. Null texts count as empty. Rows of equal id and text have equal spans; ``mark`` is a
    hash of the text, which tells rows of one id apart. Other columns are left out. If nothing is found, or
    too few seeds share a context, nothing is added.
    """
    rows = docs.select(column_or(docs, "doc_id", "long").alias("doc_id"), F.xxhash64(text_of(docs)).alias("mark"),
                       text_of(docs).alias("text")).withColumn("base", base_spans(F.col("text")))
    held = written(rows.withColumn("candidates", candidates(F.col("text"), F.col("base"))).drop("text"), "spans")
    occurrences = held.select("doc_id", "mark", F.explode("candidates").alias("c")).select("doc_id", "mark", "c.*")
    good = written(bootstrapped(occurrences), "patterns")
    unseen = occurrences.filter(F.col("kind").isNull() & _identifier(F.col("value"))).drop("kind")
    told = (unseen.withColumn("context", F.explode("contexts")).join(good, "context")
            .select("doc_id", "mark", "start", "stop", "confidence", "kind"))
    secrets = occurrences.filter("kind = 'secret'").select("doc_id", "mark", "start", "stop", F.lit(1.0).alias("confidence"), "kind")
    added = (told.unionByName(secrets)
             .groupBy("doc_id", "mark", "start", "stop").agg(F.max(F.struct("confidence", "kind")).alias("k"))
             .groupBy("doc_id", "mark").agg(F.collect_list(F.struct(F.col("k.kind").alias("kind"), "start", "stop")).alias("added")))
    added = added.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), _in_order(F.col("added")).alias("added"))
    none = F.expr("cast(array() as array<struct<kind:string,start:int,stop:int>>)")
    return held.join(added, held["doc_id"].eqNullSafe(added["_id"]) & (held["mark"] == added["_mark"]), "left").select(
        "doc_id", "mark", "base", F.coalesce("added", none).alias("added"))


def query(docs: DataFrame) -> DataFrame:
    """``op8``: counts and digest of the base spans, and all spans, of every document."""
    found = find(docs)

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, KINDS), F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
                        _joined(_in_order(F.concat("base", "added"))).alias("spans"),
                        F.size("added").cast("long").alias("n_added"),
                        (F.size("base") + F.size("added")).cast("long").alias("n_spans"))
