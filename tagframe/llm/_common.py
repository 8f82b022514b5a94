"""Shared parts: table access, lineage cuts and vectorised text kernels.

The kernels work on the UTF-8 buffers of Arrow columns, so that no Python object is
made per word.  A batch is taken in slices of bounded bytes, which bounds memory
whatever the length of a text (one text is never split).
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only in local mode where none is set."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="tagframe-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def cut(df: DataFrame, name: str = "part") -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tagframe-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    for made in SCRATCH:
        made.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


SCRATCH: list[list[str]] = []  # of each open scratch(): the tables written in it


@contextmanager
def scratch(spark: SparkSession):
    """Deletes at its end the tables that ``cut`` wrote in it: what is wanted must be written elsewhere
    by then (yields a function that takes a table that ``cut`` gave out of the list)."""
    made: list[str] = []
    SCRATCH.append(made)

    def keep(df: DataFrame) -> DataFrame:
        made.remove(df.written_to)
        return df

    try:
        yield keep
    finally:
        SCRATCH.remove(made)
        for path in made:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def dealt(key: Column, parts: int = 16) -> Column:
    """A part number of a row, by which one hot key's rows are dealt over tasks in a join."""
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def parts_of(part: str) -> Column:
    """Aggregate: the parts that a key's rows have, as bits."""
    return F.bit_or(F.expr(f"shiftleft(1, `{part}`)"))


def each_part(mask: str, parts: int = 16) -> Column:
    """The parts of a mask, one row each: a key's row is repeated only for parts that it has."""
    return F.explode(F.filter(F.sequence(F.lit(0), F.lit(parts - 1)), lambda i: F.col(mask).bitwiseAND(F.pow(F.lit(2), i).cast("int")) != 0))


def byte_words(col) -> F.Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+`` of a text (null: 0), JVM-side."""
    return F.coalesce(F.regexp_count(col, F.lit("[^ \\t-\\r]+")), F.lit(0)).cast("long")


# ---------------------------------------------------------------- Arrow buffers


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null reads as empty; offsets start at 0."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_string()), "")
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64)[col.offset : col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = 1 << 21):
    """Row ranges whose texts sum to ``most`` bytes at most, or single rows."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + most, side="right")) - 1
        b = min(n, max(b, a + 1))
        yield a, b
        a = b


def lut(*ranges: tuple[int, int]) -> np.ndarray:
    t = np.zeros(256, bool)
    for a, b in ranges:
        t[a : b + 1] = True
    return t


SPACE = lut((0x20, 0x20), (0x09, 0x0D))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_bounds(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray):
    """Starts and ends of the runs of bytes outside ``gap``; runs end with their text.
    Third: for each text the index of its first run, and the number of runs at the end."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    w = ~gap[data]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = w[:-1]
    inner = offsets[:-1][offsets[:-1] < n]
    before[inner] = False
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = w[1:]
    last = offsets[1:]
    after[last[last > 0] - 1] = False
    starts = np.flatnonzero(w & ~before)
    ends = np.flatnonzero(w & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


# ---------------------------------------------------------------- 64-bit hashing

BASE = U64(0x9E3779B97F4A7C15 | 1)
BASE_INVERSE = U64(pow(int(BASE), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit words."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, U64)
    out[0] = 1
    return np.cumprod(out, dtype=U64)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of bytes: a polynomial by prefix sums, then finalised."""
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * powers(BASE, max(len(data) - 1, 0))[: len(data)], dtype=U64, out=sums[1:])
    back = powers(BASE_INVERSE, len(data))
    return mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(U64))


def odd_numbers(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed)) | U64(1)
