"""Where detectors, recognisers and decoders plug in: per-partition functions over images.

None is bundled.  A plug-in opens its model once per partition and maps batches of rows to rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame


class ModelPlugin(Protocol):
    """``schema``: DDL of the rows that ``run`` gives."""

    schema: str

    def open(self) -> None: ...

    def run(self, rows: pd.DataFrame) -> pd.DataFrame: ...


def applied(df: DataFrame, plugin: ModelPlugin) -> DataFrame:
    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        plugin.open()
        for b in batches:
            yield plugin.run(b)

    return df.mapInPandas(each, plugin.schema)


def engine_plan(text: str) -> dict[str, list[str]]:
    """``zone=a+b;zone2=c`` to engines by zone."""
    parts: Iterable[str] = (p for p in text.split(";") if "=" in p)
    return {z.strip(): [e.strip() for e in names.split("+") if e.strip()] for z, names in (p.split("=", 1) for p in parts)}
