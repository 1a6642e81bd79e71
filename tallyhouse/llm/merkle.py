"""Document fingerprints: a Merkle tree over sentences, paragraphs and sections.

Equal texts have equal roots. Where roots differ, the branches tell which sections, paragraphs and
sentences do, without the texts. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyhouse.llm.tables import column_or, text_of, written

#: A section ends behind a paragraph whose hash starts with this digit, one of sixteen: the cut depends on
#: the paragraph alone, so an edit moves no cut elsewhere.
SECTION_DIGIT = "0"
#: Documents in a range within which each finds the next (more, if there were more than so many ranges), and bins of
#: ids by which a row looks up its range.
RANGE_ROWS, MOST_RANGES, ID_BINS = 2_000, 65_536, 65_536


def _node(kind: str, children: Column) -> Column:
    """Nodes of different kinds never share a hash."""
    return F.sha2(F.concat(F.lit(f"{kind}:"), F.array_join(children, ",")), 256)


def with_tree(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add ``name``: a struct of ``root``, ``sections``, ``paragraphs`` and ``sentences`` of the text column.

    Paragraphs are parted by a line feed, sentences by a full stop and a space. A sentence is its SHA-256 and
    its length in code points; a paragraph hashes its sentences, a section its paragraphs, the root its
    sections. A null text counts as empty.
    """
    said = F.transform(F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1), lambda p: F.transform(
        F.split(p, r"\. ", -1), lambda s: F.concat(F.sha2(s, 256), F.lit(":"), F.length(s).cast("string"))))
    closing = F.transform(f"{name}_p", lambda h: F.concat(h, F.when(h.startswith(SECTION_DIGIT), F.lit("|")).otherwise(F.lit(","))))
    cut = F.filter(F.split(F.array_join(closing, ""), r"\|", -1), lambda s: s != "")
    return (df.withColumn(f"{name}_s", said)
            .withColumn(f"{name}_p", F.transform(f"{name}_s", lambda p: _node("paragraph", p)))
            .withColumn(f"{name}_c", F.transform(cut, lambda s: F.sha2(F.concat(F.lit("section:"), s), 256)))
            .withColumn(name, F.struct(_node("document", F.col(f"{name}_c")).alias("root"), F.col(f"{name}_c").alias("sections"),
                                       F.col(f"{name}_p").alias("paragraphs"), F.flatten(f"{name}_s").alias("sentences")))
            .drop(f"{name}_s", f"{name}_p", f"{name}_c"))


def _chars(sentences: Column) -> Column:
    return F.aggregate(sentences, F.lit(0).cast("long"), lambda n, s: n + F.substring_index(s, ":", -1).cast("long"))


def likeness(a: Column, b: Column) -> Column:
    """From 0 to 1: the characters of sentences in both trees, by those in either; each distinct sentence counts once."""
    shared = _chars(F.array_intersect(a["sentences"], b["sentences"]))
    either = _chars(F.array_union(a["sentences"], b["sentences"]))
    return (F.when(a["root"] == b["root"], F.lit(1.0)).when(either == 0, F.lit(0.0))
            .otherwise(shared.cast("double") / either.cast("double")))


def changed_paragraphs(a: Column, b: Column) -> Column:
    """Numbers (from 0) of the paragraphs of ``a`` that ``b`` does not hold; none if the roots agree."""
    gone = F.array_except(a["paragraphs"], b["paragraphs"])
    return F.when(a["root"] == b["root"], F.array().cast("array<int>")).otherwise(F.filter(
        F.transform(a["paragraphs"], lambda h, i: F.when(F.array_contains(gone, h), i)), lambda i: i.isNotNull()))


def beside_next(docs: DataFrame) -> DataFrame:
    """``doc_id, text, next_text`` of every row: the text of the next row by doc_id, after the last that of the first.

    Null texts count as empty. Rows of one doc_id follow each other by a hash of their texts; null ids come
    last. Ranges hold similar numbers of rows whatever the ids are, since Spark cuts them from a sample of
    the keys (id and hash); only rows of equal id and text are never parted. Each range also gets the first
    row of the one behind it. The texts are shuffled once.
    """
    rows = docs.select(column_or(docs, "doc_id", "long").alias("doc_id"), text_of(docs).alias("text"))
    key = [F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("b"), F.xxhash64("text").alias("c")]
    # A few outlying ids don't widen the bins: they fall into the outermost two.
    ends, n = rows.agg(F.percentile_approx("doc_id", [0.001, 0.999]), F.count("*")).first()
    low, high = map(float, ends or (0, 0))

    def binned(df: DataFrame, doc_id: str) -> DataFrame:
        place = (F.col(doc_id).cast("double") - F.lit(low)) / F.lit(max(high - low, 1.0))
        inside = F.greatest(F.lit(0.0), F.least(F.lit(1.0), place))
        return df.withColumn("_bin", F.when(F.col(doc_id).isNull(), F.lit(ID_BINS)).otherwise(F.floor(inside * (ID_BINS - 1)).cast("int")))

    ranges = min(max(-(-n // RANGE_ROWS), 1), MOST_RANGES)
    # At most MOST_RANGES rows, the first key of each range, and ID_BINS + 1 bins from here on.
    firsts = (rows.select(*key).repartitionByRange(ranges, "a", "b", "c").groupBy(F.spark_partition_id().alias("_part"))
              .agg(F.min(F.struct("a", "b", "c")).alias("first")))
    firsts = written(firsts.select("first"), "ranges")
    held = binned(firsts.select("first", F.col("first.b").alias("_id")), "_id").groupBy("_bin").agg(F.collect_list("first").alias("_firsts"))
    bins = docs.sparkSession.range(ID_BINS + 1).select(F.col("id").cast("int").alias("_bin")).join(held, "_bin", "left")
    size = F.coalesce(F.size("_firsts"), F.lit(0))
    bins = bins.select("_bin", F.coalesce("_firsts", F.array().cast("array<struct<a:boolean,b:bigint,c:bigint>>")).alias("_firsts"),
                       (F.sum(size).over(Window.orderBy("_bin")) - size - 1).alias("_before"),
                       (F.sum(size).over(Window.partitionBy()) - 1).alias("_last"))
    placed = binned(rows.withColumn("_key", F.struct(*key)), "doc_id").join(F.broadcast(bins), "_bin")
    placed = placed.withColumn("_range", F.col("_before") + F.size(F.filter("_firsts", lambda f: f <= F.col("_key")))).withColumn(
        "_leads", F.array_contains("_firsts", F.col("_key"))).drop("_firsts")
    before = F.when(F.col("_range") == 0, F.col("_last")).otherwise(F.col("_range") - 1)
    own = F.struct(F.col("_range").alias("range"), F.lit(False).alias("guest"))
    spread = F.when(F.col("_leads"), F.array(own, F.struct(before.alias("range"), F.lit(True).alias("guest")))).otherwise(F.array(own))
    dealt = placed.select("doc_id", "text", "_key", F.explode(spread).alias("_to")).select(
        "doc_id", "text", "_key", F.col("_to.range").alias("_range"), F.col("_to.guest").alias("_guest"))
    order = Window.partitionBy("_range").orderBy("_guest", "_key")
    return dealt.withColumn("next_text", F.lead("text").over(order)).filter(~F.col("_guest")).select("doc_id", "text", "next_text")


def query(docs: DataFrame) -> DataFrame:
    """``op6``: every whole text, and its last half replaced by the beginning of the next document."""
    pairs = beside_next(docs).withColumn("n_chars", F.length("text").cast("long"))
    pairs = pairs.withColumn("edited", F.concat(F.expr("substring(text, 1, cast(n_chars - floor(n_chars / 2) as int))"),
                                                F.expr("substring(next_text, 1, cast(floor(n_chars / 2) as int))")))
    trees = with_tree(with_tree(with_tree(pairs, "text", "a"), "edited", "b"), "next_text", "c")
    return trees.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                        F.col("a.root").alias("fingerprint"), F.col("b.root").alias("edited_fingerprint"),
                        likeness(F.col("a"), F.col("b")).alias("near_edited"),
                        likeness(F.col("a"), F.col("c")).alias("near_next"),
                        F.size(changed_paragraphs(F.col("a"), F.col("b"))).cast("long").alias("n_changed"))


def _tree_sql(text: str, name: str) -> str:
    return f"""
  list_transform(string_split({text}, chr(10)), lambda p: list_transform(string_split(p, '. '),
    lambda s: sha256(s) || ':' || length(s)::varchar)) as {name}_s,
  list_transform({name}_s, lambda p: sha256('paragraph:' || array_to_string(p, ','))) as {name}_p,
  list_transform(list_filter(string_split(array_to_string(list_transform({name}_p,
    lambda h: h || case when h[1] = '0' then '|' else ',' end), ''), '|'), lambda s: s <> ''),
    lambda s: sha256('section:' || s)) as {name}_c,
  sha256('document:' || array_to_string({name}_c, ',')) as {name}_root,
  list_distinct(flatten({name}_s)) as {name}_all"""


def _near_sql(a: str, b: str) -> str:
    def chars(leaves: str) -> str:
        return f"coalesce(list_sum(list_transform({leaves}, lambda s: split_part(s, ':', 2)::bigint)), 0)::double"

    either = chars(f"list_distinct(list_concat({a}_all, {b}_all))")
    return f"""case when {a}_root = {b}_root then 1.0::double when {either} = 0 then 0.0::double
    else {chars(f'list_intersect({a}_all, {b}_all)')} / {either} end"""


ORACLE = f"""
with ordered as (
  select doc_id, coalesce(text, '') as text, coalesce(lead(coalesce(text, '')) over (order by doc_id),
         first_value(coalesce(text, '')) over (order by doc_id)) as next_text
  from documents
), edited as (
  select *, length(text)::bigint as n_chars,
         substring(text, 1, length(text) - length(text) // 2) || substring(next_text, 1, length(text) // 2) as edited
  from ordered
), trees as (
  select *, {_tree_sql('text', 'a')}, {_tree_sql('edited', 'b')}, {_tree_sql('next_text', 'c')} from edited
)
select doc_id, n_chars, sha256(edited) as edited_sha256, a_root as fingerprint, b_root as edited_fingerprint,
       {_near_sql('a', 'b')} as near_edited, {_near_sql('a', 'c')} as near_next,
       case when a_root = b_root then 0 else len(list_filter(a_p, lambda h: not list_contains(b_p, h))) end::bigint as n_changed
from trees
"""
