"""Helpers shared by the operators: the query registry, Arrow row mapping and
the places where lineage is cut."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from cascara.llm.encode import forget_encoders
from cascara.session import materialize, scratch_path  # noqa: F401
from cascara.sources.tables import load_table  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# The white space of every word rule, and its complement.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: What a Python worker unpacks at once, and what Spark sends it as one batch: at
#: least one row.
PART_BYTES = 4 << 20
#: Rows that a scan unpacks at once. Spark's own bounds for both (4,096 rows here,
#: 10,000 a batch) are made for short rows and hold tens of MB of texts.
SCAN_ROWS = 1024
#: Batches after which a worker hands memory back, in bytes.
HAND_BACK_BYTES = 32 << 20


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is its DuckDB equivalent, where there is one."""
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def hand_back() -> None:
    """Hands the memory that a worker has freed back to the system: a worker
    outlives its tasks, and what it keeps adds to what the next stage takes."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # only the GNU C library has it
        pass


def bound_batches(spark: SparkSession) -> None:
    """Bounds what an executor holds of texts at once by ``PART_BYTES`` and
    ``SCAN_ROWS``, for the session; where the caller has set a bound, that stands.
    Rows stay the same."""
    for key, most in (("spark.sql.execution.arrow.maxBytesPerBatch", PART_BYTES),
                      ("spark.sql.parquet.columnarReaderBatchSize", SCAN_ROWS)):
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, most)


def map_rows(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterable[dict | pa.RecordBatch]],
             schema: str, encodes: bool = False) -> DataFrame:
    """``mapInArrow`` for a function that turns a batch into column dicts.

    ``fn`` sees ``PART_BYTES`` of an Arrow batch at a time, so what it unpacks
    is bounded in bytes however many rows a batch has, and so are the batches
    (``bound_batches``). Encoders that the worker kept from an earlier stage are
    freed unless this one ``encodes``."""
    if isinstance(df, DataFrame):
        bound_batches(df.sparkSession)
    struct = T._parse_datatype_string(schema)
    arrow = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not encodes:
            forget_encoders()
        seen = 0
        for batch in batches:
            seen += batch.nbytes
            step = max(1, batch.num_rows * PART_BYTES // max(1, batch.nbytes))
            for at in range(0, batch.num_rows, step):
                for out in fn(batch.slice(at, step)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(out[f.name], f.type) for f in arrow], schema=arrow)
            batch = out = None
            if seen >= HAND_BACK_BYTES:
                hand_back()
                seen = 0
        hand_back()

    return df.mapInArrow(run, struct)


def hidden(name: str) -> str:
    """A column name of our own beside the columns of any table."""
    return f"__cascara_{name}"


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def beside_text(docs: DataFrame, text_col: str) -> tuple[Column, list[Column]]:
    """For a text that goes through Python: the other columns as one struct, to be
    named ``row``, and the columns of ``docs`` back from ``row`` and ``_text``. So
    a text crosses to Python once."""
    rest = [c for c in docs.columns if c != text_col]
    row = F.struct(F.lit(True).alias(hidden("row")), *rest)
    return row, [F.col("_text").alias(c) if c == text_col else F.col("row")[c].alias(c)
                 for c in docs.columns]
