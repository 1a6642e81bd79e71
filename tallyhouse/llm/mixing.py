"""Mixing sources to target weights: each document is taken floor(rate) times, plus once more by a seeded draw."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.tables import WORD, column_or, ranked, text_of, written

#: Sources up to this many are sent to every task; more are joined by shuffle, hot sources split by AQE.
BROADCAST_SOURCES = 10_000
_EXACT = "decimal(38,0)"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform_draw(key: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on ``key`` and ``seed`` only: 52 bits of their MD5."""
    label = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(label), 1, 13), 16, 10).cast("long") / F.lit(2.0**52)


def source_targets(sizes: DataFrame, weights: Sequence[int], max_rate: int) -> DataFrame:
    """``source, source_size, target`` from rows ``source, size``.

    The targets share the whole size by weight. One that is above ``max_rate`` times its source's
    size stops there, and its excess is shared by weight among the others, until none is above.
    The level (target per weight) is kept as a fraction of whole numbers, so the result is exact.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = written(
        ranked(totals, "source").select("source", "source_size", weight.alias("weight"),
                                        (F.col("source_size") * max_rate).alias("_stop")), "sources")
    whole = sources.agg(F.sum("source_size").cast(_EXACT).alias("w"), F.sum("weight").cast(_EXACT).alias("d")).first()
    share, among = whole["w"] or 0, whole["d"] or 0
    stopped = F.lit(False)
    while among:
        stopped = F.col("_stop").cast(_EXACT) * F.lit(among) <= F.col("weight").cast(_EXACT) * F.lit(share)
        now = sources.agg(F.sum(F.when(stopped, F.col("_stop")).otherwise(0)).cast(_EXACT).alias("s"),
                          F.sum(F.when(stopped, 0).otherwise(F.col("weight"))).cast(_EXACT).alias("d")).first()
        left = whole["w"] - now["s"]
        if (left, now["d"]) == (share, among):
            break
        share, among = left, now["d"]
    if not among:
        target = F.col("_stop").cast("double")
    else:
        level = (F.col("weight").cast(_EXACT) * F.lit(share)).cast("double") / F.lit(among).cast("double")
        target = F.when(stopped, F.col("_stop").cast("double")).otherwise(level)
    return sources.select("source", "source_size", target.alias("target"))


def plan_copies(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), max_rate: int = 3, seed: int = 0,
                text: str = "text", source: str = "source", key: str = "doc_id") -> DataFrame:
    """Every row of ``docs`` with ``size``, ``source_size``, ``target`` and ``copies``, the number of times to take it.

    Sources in code-point order, null last (a source of its own), have the weights in turn. A source's
    rate is its target by its size; a document is taken ``floor(rate)`` times, and once more if the
    draw of its key is below the fraction. Rows of equal key share the draw, so they are taken alike
    in every run. Null and empty texts have size 0 and follow the same rule. Input columns named as a
    result column are replaced. An empty table stays empty.
    """
    sized = docs.withColumn("size", word_count(text_of(docs, text)))
    sizes = sized.select(column_or(docs, source, "string").alias("source"), "size")
    targets = source_targets(sizes, weights, max_rate).select(
        F.col("source").alias("_mix_source"), F.col("source_size").alias("_mix_size"),
        F.col("target").alias("_mix_target"))
    if targets.count() <= BROADCAST_SOURCES:
        targets = F.broadcast(targets)
    joined = sized.join(targets, column_or(docs, source, "string").eqNullSafe(F.col("_mix_source")), "left")
    rate = F.when(F.col("_mix_size") > 0, F.col("_mix_target") / F.col("_mix_size")).otherwise(0.0)
    copies = F.floor(rate) + F.when(
        uniform_draw(column_or(docs, key, "string"), seed) < rate - F.floor(rate), 1).otherwise(0)
    return (joined.withColumn("source_size", F.col("_mix_size")).withColumn("target", F.col("_mix_target"))
            .withColumn("copies", copies.cast("int")).drop("_mix_source", "_mix_size", "_mix_target"))


def emit(planned: DataFrame) -> DataFrame:
    """One row for each copy; documents with no copy leave."""
    return planned.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))


def query(docs: DataFrame) -> DataFrame:
    """``op4``: the size, source, target and words taken of every document."""
    return plan_copies(docs).select("doc_id", "size", "source_size", "target",
                                    (F.col("size") * F.col("copies")).alias("taken"))


ORACLE = r"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size from documents
), per_source as (
  select source, sum(size)::hugeint as source_size from sized group by source
), weighted as (
  select source, source_size, 3 * source_size as stop,
         case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as weight
  from per_source
), steps as (
  select *, sum(source_size) over () as whole,
         coalesce(sum(stop) over (order by stop::double / weight, source rows between unbounded preceding and 1 preceding), 0) as before,
         sum(weight) over (order by stop::double / weight, source rows between current row and unbounded following) as still,
         row_number() over (order by stop::double / weight, source) as place
  from weighted
), first_free as (
  select * from steps where stop * still > weight * (whole - before) order by place limit 1
), targets as (
  select s.source, s.source_size,
         case when f.place is null or s.place < f.place then s.stop::double
              else (s.weight * (f.whole - f.before))::double / f.still::double end as target
  from steps s left join first_free f on true
), rated as (
  select d.doc_id, d.size, t.source_size::bigint as source_size, t.target,
         case when t.source_size > 0 then t.target / t.source_size::double else 0.0 end as rate
  from sized d join targets t on d.source is not distinct from t.source
)
select doc_id, size, source_size, target,
       (size * (floor(rate) + case when ('0x' || substr(md5('0:' || coalesce(doc_id::varchar, 'null')), 1, 13))::bigint
                                        / 4503599627370496.0::double < rate - floor(rate) then 1 else 0 end))::bigint as taken
from rated
"""
