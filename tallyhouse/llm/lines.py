"""Line deduplication by an exact set-similarity join: later lines that match an earlier one leave.

A line is the set of its words. With the words in order of rarity, two sets can only be similar enough
if a word is shared early in both (prefix filter), at places that leave enough words behind (positional
filter), and if their sizes are close (length filter). Signatures of 128 bits, or 256 for large sets, rule out most others.
What is left is verified word by word. Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyhouse.llm.tables import column_or, text_of, written

# Fixed value: what separates words (space and the controls 9 to 13).
_GAP = r"[\x20\x09-\x0D]+"
_SPACES = " \t\n\x0b\x0c\r"
# What any word has.
_SAID = r"[^\x20\x09-\x0D]"
#: Words are counted in so many cells to order them.
CELL_BITS = 16
#: Sets of so many words have longer signatures: 128 bits would nearly all be set.
WIDE = 64
#: Lines sent to every task to be verified; more are joined by shuffle.
BROADCAST_LINES = 1_000_000
#: Lists of kept lines sent to every task, one per document; more are joined by shuffle.
BROADCAST_DOCUMENTS = 500_000


def _words(text: Column) -> Column:
    """64-bit numbers of the words, in lower case."""
    # A gap at an end leaves an empty word.
    return F.array_remove(F.transform(F.split(F.lower(text), _GAP, -1), lambda w: F.xxhash64(w)), F.xxhash64(F.lit("")))


def _cell(word: Column) -> Column:
    return F.shiftrightunsigned(word, 64 - CELL_BITS).cast("int")


def rarity_classes(docs: DataFrame) -> Column:
    """An array with the class of every cell of words: four times the logarithm of the count over all texts.

    ``2**CELL_BITS`` numbers, whatever the input.
    """
    cells = docs.select(F.explode(F.split(F.lower("text"), _GAP, -1)).alias("w")).select(_cell(F.xxhash64("w")).alias("cell"))
    counts = {r["cell"]: r["count"] for r in cells.groupBy("cell").count().collect()}
    classes = [min(126, 4 * counts.get(c, 0).bit_length()) for c in range(1 << CELL_BITS)]
    return F.split(F.lit(",".join(map(str, classes))), ",").cast("array<tinyint>")


def _ordered(line: Column, classes: Column) -> Column:
    """The distinct words of a line as numbers in order of rarity: the class in the upper bits, 56 bits of the word below.

    No gap may stand at an end. Numbers that are never null are sorted as such, not as objects.
    """
    def number(w: Column) -> Column:
        word = F.xxhash64(w)
        kind = F.coalesce(F.get(classes, _cell(word)), F.lit(0)).cast("long")
        return F.shiftleft(kind, 56).bitwiseOR(word.bitwiseAND((1 << 56) - 1))

    return F.sort_array(F.array_distinct(F.transform(F.split(F.lower(line), _GAP, -1), number)))


def _need(percent: int, n: Column, m: Column) -> Column:
    """Words that sets of n and m words of the least similarity share."""
    return F.ceil(F.lit(percent) * (n + m) / F.lit(100 + percent))


def _prefix(percent: int, n: Column) -> Column:
    """Words of a set among which any similar set shares one."""
    return n - F.ceil(F.lit(percent) * n / F.lit(100)) + 1


def _signature(words: str, part: int, parts: int) -> Column:
    """A bit for each word, of 64; words with the bits above as in ``part`` only."""
    own = f"filter({words}, x -> x & {64 * (parts - 1)} = {64 * part})"
    return F.expr(f"aggregate({own}, 0L, (s, x) -> s | shiftleft(1L, cast(x & 63 as int)))")


def _signatures(words: str, n: Column) -> list[Column]:
    """``s0`` to ``s3``: 128 bits in the first two, and 256 in all of them for sets of ``WIDE`` words or more."""
    wide = n >= WIDE
    return [*[F.when(wide, _signature(words, i, 4)).otherwise(_signature(words, i, 2)).alias(f"s{i}") for i in (0, 1)],
            *[F.when(wide, _signature(words, i, 4)).otherwise(F.lit(0).cast("long")).alias(f"s{i}") for i in (2, 3)]]


def _exploded(docs: DataFrame) -> DataFrame:
    """``doc_id, mark, line, line_text`` of every line."""
    return docs.select("doc_id", "mark", F.posexplode(F.split("text", "\n", -1)).alias("line", "line_text"))


def distinct_lines(docs: DataFrame, classes: Column, percent: int) -> DataFrame:
    """One row for each set of words: ``first`` (its first line), ``n``, ``prefix``, and ``s0`` to ``s3``, the signature
    of all words.

    Copies meet in the tasks before they are shuffled, so a line that fills a third of a table is one row per task.
    """
    # Said of the trimmed text: a filter on the words would make them twice.
    said = _exploded(docs).withColumn("line_text", F.trim("line_text", F.lit(_SPACES))).filter(F.length("line_text") > 0)
    words = said.withColumn("w", _ordered(F.col("line_text"), classes))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "line", "mark")
    words = words.withColumn("p", F.slice("w", F.lit(1), _prefix(percent, F.size("w")).cast("int")))
    # Two seeds, 128 bits: equal sets, and only those, have equal digests.
    rows = words.select(F.struct(F.xxhash64("w"), F.xxhash64(F.lit(1), "w")).alias("digest"), place.alias("first"), F.struct(
        F.size("w").alias("n"), *_signatures("w", F.size("w")),
        F.transform("p", lambda x: x.bitwiseAND(0x7FFFFFFF).cast("int")).alias("prefix")).alias("set"))
    return rows.groupBy("digest").agg(F.min("first").alias("first"), F.first("set").alias("set")).select("first", "set.*")


def numbered(lines: DataFrame) -> DataFrame:
    """Lines with ``row``, numbers in their order: by doc_id (null last), line number, then the text's hash.

    Ranges of the order are sorted alone, and a partition's numbers are above those of the ones before.
    """
    order = [f"first.{c}" for c in ("no_id", "doc_id", "line", "mark")]
    return lines.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("row", F.monotonically_increasing_id())


def _entries(lines: DataFrame, percent: int) -> DataFrame:
    """The index: one row for each word of a line's prefix, with what the filters need. ``row`` orders lines.

    A set too small for one word more or less is similar to no other set; its copies met by their digest.
    """
    # None of the columns is ever null; saying so lets both sides of the join read one exchange.
    zero = F.lit(0)
    paired = lines.filter(100 * F.col("n") >= percent * (F.col("n") + 1))
    return paired.select(*[F.coalesce(c, zero.cast("int" if c == "n" else "long")).alias(c) for c in ("row", "n", *_BITS)],
                         F.posexplode("prefix").alias("at", "key"))


def _passes(percent: int, u: Callable[[str], Column], v: Callable[[str], Column]) -> Column:
    """Length, positional and signature filters for two entries (n, at, s0 to s3)."""
    n, m = u("n"), v("n")
    need = _need(percent, n, m)

    def absent(held: Column, other: Column) -> Column:
        return F.bit_count(held.bitwiseAND(F.bitwise_not(other)))

    def missing(a: Callable[[str], Column], b: Callable[[str], Column]) -> Column:
        """Words of a that b can't have, at least. A long signature and a short one are compared as short ones."""
        long = absent(a("s0"), b("s0")) + absent(a("s1"), b("s1")) + absent(a("s2"), b("s2")) + absent(a("s3"), b("s3"))
        short = (absent(a("s0").bitwiseOR(a("s2")), b("s0").bitwiseOR(b("s2")))
                 + absent(a("s1").bitwiseOR(a("s3")), b("s1").bitwiseOR(b("s3"))))
        return F.when((n >= WIDE) == (m >= WIDE), long).otherwise(short)

    return ((100 * F.least(n, m) >= percent * F.greatest(n, m)) & (u("at") <= n - need) & (v("at") <= m - need)
            & (missing(u, v) <= n - need) & (missing(v, u) <= m - need))


def _before(u: Callable[[str], Column], v: Callable[[str], Column]) -> Column:
    return u("row") < v("row")


def _with(prefix: str) -> Callable[[str], Column]:
    return lambda name: F.col(f"{prefix}{name}")


_BITS = ("s0", "s1", "s2", "s3")
_HELD = ("row", "n", "at", *_BITS)


def _led(entries: DataFrame, percent: int) -> DataFrame:
    """One pair (u, v) for each row v that passes the filters with the earliest line of a key: u is the earliest such."""
    # The window holds the rows of one key at a time.
    first = F.min(F.struct(*_HELD)).over(Window.partitionBy("key"))
    passes = _before(_with("l."), _with("")) & _passes(percent, _with("l."), _with(""))
    met = entries.withColumn("l", first).filter(passes)
    return met.groupBy(F.col("row").alias("v")).agg(F.min("l.row").alias("u")).select("u", "v")


def _pairs(lines: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) of rows that pass the filters, u the earlier line, for every line v that is ``asked``."""
    # Whether it is asked goes in the lowest bit of the row, and is read with both rows only: said of one
    # side, it would part the exchange that both sides read.
    flagged = _entries(lines.withColumn("row", 2 * F.col("row") + F.col("asked").cast("int")), percent).repartition("key")
    x, y = (flagged.select("key", *[F.col(c).alias(f"{side}_{c}") for c in _HELD]) for side in "uv")
    u, v = _with("u_"), _with("v_")
    asked = F.when(v("row") % 2 == 1, v("row")).otherwise(F.lit(-1)) > u("row")
    met = x.join(y, "key").filter(asked & _passes(percent, u, v))
    return met.select(*[F.shiftright(F.col(f"{side}_row"), 1).alias(side) for side in "uv"]).distinct()


def _verified(docs: DataFrame, lines: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The later rows of the pairs (u, v) that are similar enough: ``row``."""
    sides = written(pairs.select(F.explode(F.array(F.struct("u", "v", F.lit(True).alias("left"), F.col("u").alias("row")),
                                                   F.struct("u", "v", F.lit(False).alias("left"), F.col("v").alias("row")))).alias("s"))
                    .select("s.*").join(lines.select("row", "first"), "row")
                    .select("u", "v", "left", *[F.col(f"first.{c}").alias(f"_{c}") for c in ("doc_id", "mark", "line")]), "sides")
    at = F.broadcast(sides) if sides.count() <= BROADCAST_LINES else sides
    said = _exploded(docs)
    found = said.join(at, (F.col("mark") == F.col("_mark")) & (F.col("line") == F.col("_line")) & F.col("doc_id").eqNullSafe(F.col("_doc_id")))
    words = F.array_distinct(_words(F.col("line_text")))
    sets = found.select("u", "v", "left", words.alias("w")).groupBy("u", "v").agg(
        F.first(F.when(F.col("left"), F.col("w")), ignorenulls=True).alias("a"),
        F.first(F.when(~F.col("left"), F.col("w")), ignorenulls=True).alias("b"))
    both = F.size(F.array_intersect("a", "b"))
    return (sets.withColumn("_both", both).filter(100 * F.col("_both") >= percent * (F.size("a") + F.size("b") - F.col("_both")))
            .select(F.col("v").alias("row")).distinct())


def repeated(docs: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Distinct lines (row, first, ...) and those of them (row) that match an earlier line."""
    lines = written(numbered(distinct_lines(docs, rarity_classes(docs), percent)), "lines")
    # Most lines of a large group match the earliest line with one of their words, and ask no further. Similar
    # sets of one size share one of so many words; of other sizes all of the prefix may be needed.
    n = F.col("n")
    led = written(_led(_entries(lines, percent).filter(F.col("at") <= n - _need(percent, n, n)), percent), "led")
    gone = written(_verified(docs, lines, led, percent), "gone")
    left = gone.withColumn("_gone", F.lit(True))
    asked = lines.join(_small(left, gone.count()), "row", "left").withColumn("asked", F.col("_gone").isNull()).drop("_gone")
    pairs = written(_pairs(asked, percent).join(led, ["u", "v"], "left_anti"), "pairs")
    # The others meet all earlier lines that pass the filters, the earliest first.
    first = written(pairs.groupBy("v").agg(F.min("u").alias("u")).select("u", "v"), "firsts")
    gone = gone.unionByName(written(_verified(docs, lines, first, percent), "gone"))
    rest = written(pairs.join(gone.withColumnRenamed("row", "v"), "v", "left_anti").join(first, ["u", "v"], "left_anti")
                   .select("u", "v"), "pairs")
    if not rest.isEmpty():
        gone = gone.unionByName(written(_verified(docs, lines, rest, percent), "gone"))
    return lines, gone


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_LINES else df


def kept_lines(lines: DataFrame, gone: DataFrame) -> DataFrame:
    """``doc_id, mark, kept``: per document the lines that match no earlier line."""
    stay = lines.select("row", "first").join(gone, "row", "left_anti")
    return stay.groupBy(F.col("first.doc_id").alias("doc_id"), F.col("first.mark").alias("mark")).agg(
        F.collect_list("first.line").alias("kept"))


def deduplicate(docs: DataFrame, percent: int = 80, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Every row of ``docs`` with its text less the lines that match an earlier line, ``n_lines`` and ``n_removed``.

    Lines are parted by line feeds. Two match if their sets of words (in lower case) have a Jaccard similarity of
    ``percent`` or more. The earlier is that of the smaller doc_id (null last), then of the smaller line number, then, of
    different texts under one doc_id or none, of the smaller hash of the text;
    a line leaves if it matches any earlier line, whether that one stays or not. Lines without a word
    stay and match nothing. Null texts stay null. Rows of equal id and text are treated alike. Input columns named as a result are replaced.
    """
    base = docs.select(column_or(docs, key, "long").alias("doc_id"), F.xxhash64(text_of(docs, text)).alias("mark"),
                       text_of(docs, text).alias("text"))
    stay = written(kept_lines(*repeated(base, percent)).select(
        F.col("doc_id").alias("_line_id"), F.col("mark").alias("_line_mark"), F.col("kept").alias("_line_kept")), "kept")
    if stay.count() <= BROADCAST_DOCUMENTS:
        stay = F.broadcast(stay)
    said = text_of(docs, text)
    joined = docs.withColumn("_line_hash", F.xxhash64(said)).join(
        stay, column_or(docs, key, "long").eqNullSafe(F.col("_line_id")) & (F.col("_line_hash") == F.col("_line_mark")), "left")
    lines = F.split(F.coalesce(F.col(text).cast("string"), F.lit("")), "\n", -1)
    blank = F.filter(F.transform(lines, lambda x, i: F.when(~x.rlike(_SAID), i)), lambda i: i.isNotNull())
    held = F.sort_array(F.array_union(blank, F.coalesce("_line_kept", F.array().cast("array<int>"))))
    out = (joined.withColumn("_line_all", lines).withColumn("_line_held", held)
           .withColumn("n_lines", F.size("_line_all").cast("long"))
           .withColumn("n_removed", F.col("n_lines") - F.size("_line_held"))
           .withColumn(text, F.when(F.col(text).isNotNull(), F.array_join(
               F.transform("_line_held", lambda i: F.get("_line_all", i)), "\n"))))
    return out.drop(*[c for c in out.columns if c.startswith("_line_")])


def query(docs: DataFrame) -> DataFrame:
    """``op5``: every document without its repeated lines."""
    return deduplicate(docs.select("doc_id", "text")).select("doc_id", "n_lines", "n_removed", "text")
