"""Preference formatting of chosen and rejected conversations.

The longest common prefix of turns (equal roles and texts) is rendered once as the prompt;
what follows is rendered as two completions.  Of a completion only assistant turns are
trained on: ``spans`` gives their character ranges (start, end exclusive; the end mark is
included, the role header is not), everything else is masked.

``status``: ``ok``; ``identical`` when the conversations are equal (completions empty);
``chosen_is_prefix`` or ``rejected_is_prefix`` when one goes on where the other ends (its
completion is empty); ``no_answer`` when there is nothing to compare (a null side).

A null role or text counts as an empty one, a null turn as one with both empty.  Turns of a
conversation are ordered by turn number (null first), then role and text, so that repeated
turns have a place.  A row without a conversation id is a conversation of its own.  A key
column that has the name of a result column is given as key_<name>.  Everything is JVM-side.
A conversation is one row: the longest one bounds a row's memory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURNS = "array<struct<role:string,text:string>>"
RESULT = ("status", "prompt_turns", "prompt", "chosen", "rejected", "chosen_spans", "rejected_spans")


def conversations(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, turns; each row without a conversation id is one conversation, with a null id."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    row = F.struct(F.col(turn_col).cast("long").alias("turn"), empty(role_col).alias("role"), empty(text_col).alias("text"))
    rows = turns.select(F.col(id_col).cast("long").alias("conv_id"), row.alias("t"))
    found = rows.where("conv_id is not null").groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    found = found.unionByName(rows.where("conv_id is null").select("conv_id", F.array("t").alias("t")))
    return found.select("conv_id", F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).cast(TURNS).alias("turns"))


def contrasted(found: DataFrame, group_rows: int = 1000) -> DataFrame:
    """conv_id, chosen, rejected: the rejected conversation has, in place of its last assistant
    turn (and what follows), the last answer of the next conversation of its group (groups of
    about ``group_rows`` by hash of the id, in a ring)."""
    n = max(1, -(-found.count() // group_rows))
    last = F.aggregate(F.sequence(F.lit(1), F.size("turns")), F.lit(0), lambda a, i: F.when(F.element_at("turns", i)["role"] == "assistant", i).otherwise(a))
    rows = found.withColumn("at", F.when(F.size("turns") > 0, last).otherwise(0)).withColumn("h", F.xxhash64("conv_id", "turns")).withColumn("g", F.pmod("h", F.lit(n)))
    answer = F.when(F.col("at") > 0, F.element_at("turns", F.greatest(F.col("at"), F.lit(1))))
    rows = rows.withColumn("has", F.col("at") > 0).withColumn("answer", answer)
    ring = Window.partitionBy("g", "has").orderBy(F.col("conv_id").asc_nulls_first(), "h")
    rows = rows.withColumn("other", F.coalesce(F.lead("answer").over(ring), F.first("answer").over(ring)))
    rejected = F.when(F.col("has"), F.concat(F.slice("turns", F.lit(1), F.greatest(F.col("at") - 1, F.lit(0))), F.array("other")))
    chosen = F.when(F.col("has"), F.slice("turns", F.lit(1), F.greatest(F.col("at"), F.lit(1)))).otherwise(F.col("turns"))
    return rows.select("conv_id", chosen.cast(TURNS).alias("chosen"), rejected.cast(TURNS).alias("rejected"))


def rendered(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"), turn["text"], F.lit("<|end|>\n"))


def prefix(a: Column, b: Column) -> Column:
    """Number of equal turns at the start."""
    n = F.least(F.size(a), F.size(b))
    same = F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.element_at(a, i).eqNullSafe(F.element_at(b, i)))).otherwise(F.array().cast("array<boolean>"))
    at = F.array_position(same, False).cast("int")
    return F.when(at > 0, at - 1).otherwise(n)


def rest(turns: Column, n: Column) -> Column:
    return F.slice(turns, n + 1, F.greatest(F.size(turns) - n, F.lit(0)))


def trained(turns: Column) -> Column:
    """Character spans of the assistant turns in the rendering of ``turns``."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))

    def step(done: Column, turn: Column) -> Column:
        head = F.length(turn["role"]) + 5  # "<|", "|>" and the line feed
        stop = done["at"] + F.length(rendered(turn))
        span = F.struct((done["at"] + head).cast("long").alias("start"), (stop - 1).cast("long").alias("end"))
        spans = F.when(turn["role"] == "assistant", F.concat(done["spans"], F.array(span))).otherwise(done["spans"])
        return F.struct(stop.cast("long").alias("at"), spans.alias("spans"))

    return F.aggregate(turns, start, step)["spans"]


def format_pairs(pairs: DataFrame, keys: list[str], chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """The key columns and status, prompt_turns, prompt, chosen, rejected, chosen_spans, rejected_spans."""
    whole = lambda c: F.transform(F.col(c).cast(TURNS), lambda t: F.struct(*(F.coalesce(t[k], F.lit("")).alias(k) for k in ("role", "text"))))
    named = [f"key_{k}" if k.lower() in RESULT else k for k in keys]
    rows = pairs.select(*(F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)), whole(chosen).alias("a"), whole(rejected).alias("b"))
    a, b, n = F.col("a"), F.col("b"), F.col("n")
    rows = rows.withColumn("n", F.coalesce(prefix(a, b), F.lit(0)))
    rows = rows.withColumn("x", rest(a, n)).withColumn("y", rest(b, n))
    text = lambda turns: F.array_join(F.transform(turns, rendered), "")
    x, y = F.size("x") > 0, F.size("y") > 0
    status = F.when(a.isNull() | b.isNull(), "no_answer").when(x & y, "ok").when(x, "rejected_is_prefix").when(y, "chosen_is_prefix").otherwise("identical")
    out = [status, n.cast("long"), text(F.slice(F.coalesce(a, b), F.lit(1), n)), text(F.col("x")), text(F.col("y")), trained(F.col("x")), trained(F.col("y"))]
    return rows.select(*(F.col(f"k{i}").alias(k) for i, k in enumerate(named)), *(c.alias(k) for c, k in zip(out, RESULT)))
