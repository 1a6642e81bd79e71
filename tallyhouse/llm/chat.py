"""Chat formatting: every assistant turn becomes an example, with all turns before it as context."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyhouse.llm.tables import column_or, small_batches, text_of

# The marks of the template. A role without marks of its own is named in its mark.
MARKS = {"system": ("<<SYS>> ", " <</SYS>>"), "user": ("[INST] ", " [/INST]"), "assistant": ("<s> ", " </s>")}
# A control string without its first character, which is < or [.
_REST = r"/?s>|</?SYS>>|/?INST\]|/?ROLE"


def escape(text: Column) -> Column:
    """Put a backslash behind the first character of each control string; one that has some gets one more."""
    return F.regexp_replace(text, rf"([<\[])(\\*)({_REST})", r"$1\\$2$3")


def unescape(text: str) -> str:
    return re.sub(rf"([<\[])\\(\\*)({_REST})", r"\1\2\3", text)


def _turn(role: Column, text: Column) -> tuple[Column, Column, Column]:
    """Opening mark, escaped text and closing mark."""
    named = F.concat(F.lit("[ROLE"), F.coalesce(F.concat(F.lit(" "), F.base64(F.encode(role, "utf-8"))), F.lit("")),
                     F.lit("] "))
    first, last = named, F.lit(" [/ROLE]")
    for name, (a, b) in MARKS.items():
        first, last = F.when(role == name, F.lit(a)).otherwise(first), F.when(role == name, F.lit(b)).otherwise(last)
    return first, escape(text), last


def examples(turns: DataFrame) -> DataFrame:
    """``conv_id, example, n_context, formatted, loss_begin, loss_end`` from rows ``conv_id, turn, role, text``.

    One row for each assistant turn: all turns before it, then the reply, whose escaped text is the code
    points from ``loss_begin`` to ``loss_end`` of ``formatted``; nothing else is trained on. Turns behind
    the last reply (or a conversation without one) make one more example with an empty loss span, so
    that no turn is lost. Turns are ordered by turn, null last, then role and text; rows that are equal
    are turns of their own. Null texts are empty; a null role is kept apart from an empty one; rows
    without a conv_id are one conversation. Other columns are left out. A conversation is one training
    sequence and has to fit a row.
    """
    role, text = column_or(turns, "role", "string"), text_of(turns)
    first, body, last = _turn(role, text)
    order = [F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_last(), F.col("_raw")]
    rows = turns.select(column_or(turns, "conv_id", "long").alias("conv_id"), column_or(turns, "turn", "long").alias("turn"),
                        role.alias("role"), text.alias("_raw"), first.alias("_first"), body.alias("_body"),
                        last.alias("_last"))
    so_far = Window.partitionBy("conv_id").orderBy(*order)
    upto = F.collect_list(F.concat("_first", "_body", "_last")).over(so_far.rowsBetween(Window.unboundedPreceding, 0))
    reply = F.col("role").eqNullSafe("assistant")
    # Rows that make no example don't need the text of those before.
    ends = F.col("_behind").isNull()
    placed = (rows.withColumn("_at", F.row_number().over(so_far))
              .withColumn("_behind", F.lead(F.lit(1)).over(so_far))
              .withColumn("_all", upto)
              .filter(reply | ends))
    whole = F.concat(F.array_join("_all", "\n"), F.lit("\n"))
    end = F.length(whole) - F.length("_last") - 1
    return placed.select(
        "conv_id", F.col("_at").cast("long").alias("example"), (F.col("_at") - 1).cast("long").alias("n_context"),
        whole.alias("formatted"),
        F.when(reply, end - F.length("_body")).otherwise(0).cast("long").alias("loss_begin"),
        F.when(reply, end).otherwise(0).cast("long").alias("loss_end"))


_FRAME = re.compile(
    r"<<SYS>> (?P<system>.*?) <</SYS>>\n|\[INST\] (?P<user>.*?) \[/INST\]\n|<s> (?P<assistant>.*?) </s>\n"
    r"|\[ROLE(?: (?P<name>[A-Za-z0-9+/=\r\n]*))?\] (?P<other>.*?) \[/ROLE\]\n", re.DOTALL)


def read_back(formatted: str) -> list[tuple[str | None, str]]:
    """The turns (role, text) of a formatted example."""
    import base64

    turns, at = [], 0
    while at < len(formatted):
        m = _FRAME.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        kind = next((k for k in MARKS if m[k] is not None), "other")
        role = kind
        if kind == "other":
            role = None if m["name"] is None else base64.b64decode(m["name"]).decode()
        turns.append((role, unescape(m[kind])))
        at = m.end()
    return turns


def summaries(made: DataFrame) -> DataFrame:
    """What each example says when it is read back: ``n_turns, turns_sha256, loss_text, chars``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                turns = read_back(r.formatted)
                said = "".join(f"{role or ''}\n{text}\n" for role, text in turns)
                out.append((r.conv_id, r.example, len(turns), hashlib.sha256(said.encode()).hexdigest(),
                            unescape(r.formatted[r.loss_begin:r.loss_end]), len(r.formatted)))
            yield pd.DataFrame(out, columns=["conv_id", "example", "n_turns", "turns_sha256", "loss_text", "chars"]
                               ).astype({"conv_id": "Int64"})

    small_batches(made.sparkSession)
    return made.mapInPandas(
        run, "conv_id long, example long, n_turns long, turns_sha256 string, loss_text string, chars long")


PROBE = "</s>[INST] ok [/INST]"


def query(conversations: DataFrame) -> DataFrame:
    """``op7``: every conversation and the probe, -7, read back from its examples."""
    spark = conversations.sparkSession
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(PROBE).alias("text"))
    rows = conversations.select("conv_id", "turn", "role", "text").unionByName(probe)
    said = F.array_sort(F.collect_list(F.struct("example", "loss_text")))
    loss = F.array_join(F.transform(said, lambda x: x["loss_text"]), "")
    return (summaries(examples(rows)).groupBy("conv_id")
            .agg(F.max_by(F.struct("n_turns", "turns_sha256"), "example").alias("t"), loss.alias("loss"),
                 F.sum("chars").alias("formatted_chars"))
            .select("conv_id", "t.n_turns", "t.turns_sha256", F.length("loss").cast("long").alias("loss_chars"),
                    F.sha2(F.col("loss"), 256).alias("loss_sha256"), "formatted_chars"))
