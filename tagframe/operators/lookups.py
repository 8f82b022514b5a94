"""Keyed look-ups with their duplicate policies, positional fall-backs, set operations and range joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import first_by, last_by

ROW_KEY = ("filename", "frame_timestamp", "x_min", "y_min", "x_max", "y_max")


def raw_key(names=ROW_KEY) -> list[Column]:
    return [F.trim(F.coalesce(F.col(n).cast("string"), F.lit(""))).alias(f"k_{n}") for n in names]


def rounded_key(places: int, names=ROW_KEY) -> list[Column]:
    """Base name, time, and coordinates rounded half-even to ``places``."""
    head = [F.element_at(F.split(F.col(names[0]), "[/\\\\]"), -1).alias(f"k_{names[0]}"), F.col(names[1]).cast("string").alias(f"k_{names[1]}")]
    return head + [F.bround(F.regexp_replace(F.col(n).cast("string"), ",", ".").try_cast("decimal(20,6)"), places).alias(f"k_{n}") for n in names[2:]]


def looked_up(rows: DataFrame, build: DataFrame, key: list[Column], value: str, ordinal: str, policy: str = "last") -> DataFrame:
    """rows with ``value`` filled from ``build`` where it is missing; last or first row of a key wins."""
    b = build.select(*key, F.col(ordinal).alias("_o"), F.col(value).alias("_v"))
    ks = [c for c in b.columns if c.startswith("k_")]
    side = (last_by if policy == "last" else first_by)(b, ks, ["_o"], ["_v"])
    out = rows.select("*", *key).join(side, ks, "left")
    own = F.col(value) if value in rows.columns else F.lit(None).cast("string")
    return out.withColumn(value, F.coalesce(own, "_v")).drop("_v", *ks)


def positional(a: DataFrame, b: DataFrame, order_a: list[str], order_b: list[str], groups: list[str]) -> DataFrame:
    """The i-th row of each group of a with the i-th of b.  Groups bound the windows."""
    number = lambda df, o: df.withColumn("_i", F.row_number().over(Window.partitionBy(*groups).orderBy(*o)))
    return number(a, order_a).join(number(b, order_b), [*groups, "_i"], "left").drop("_i")


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` replace those of ``old`` with the same keys."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def merged(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer: new values where there are any, else the old ones."""
    rest = [c for c in old.columns if c not in keys]
    n = new.select(*keys, *(F.col(c).alias(f"_{c}") for c in rest if c in new.columns))
    out = old.join(n, keys, "full_outer")
    return out.select(*keys, *(F.coalesce(f"_{c}", c).alias(c) if c in new.columns else F.col(c) for c in rest))


def combined(frames: list[DataFrame], columns: list[str]) -> DataFrame:
    """Rows of all frames with the given columns, absent ones empty."""
    out = None
    for df in frames:
        own = df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c) for c in columns))
        out = own if out is None else out.unionByName(own)
    return out


def cell_join(boxes: DataFrame, tiles: DataFrame, on: list[str], cell: int, keep_boxes: list[str], keep_tiles: list[str]) -> DataFrame:
    """Overlapping (box, tile) pairs by an equi-join on grid cells: both cover their cells, and a
    pair counts in the first cell that both cover only."""
    def cells(df: DataFrame, p: str) -> DataFrame:
        at = lambda c: F.floor(F.col(f"{p}{c}") / cell)
        out = df.withColumn("cx", F.explode(F.sequence(at("x_min"), at("x_max"))))
        return out.withColumn("cy", F.explode(F.sequence(at("y_min"), at("y_max"))))

    b, t = cells(boxes, "b_"), cells(tiles, "t_")
    both = b.join(t, [*on, "cx", "cy"])
    first = (F.col("cx") == F.greatest(F.floor(F.col("b_x_min") / cell), F.floor(F.col("t_x_min") / cell))) & (F.col("cy") == F.greatest(F.floor(F.col("b_y_min") / cell), F.floor(F.col("t_y_min") / cell)))
    return both.where(first).select(*on, *keep_boxes, *keep_tiles)
