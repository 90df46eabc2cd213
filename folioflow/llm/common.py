"""Shared parts of the corpus operators: inputs, staging, batches of text."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from folioflow.sources.storage import ensure_checkpoint_dir, remove_path

#: Texts are handed to the array code in slices of about so many bytes; a longer text is one slice.
SLICE_BYTES = 2 << 20
NO_ID = -(1 << 63)


#: Arrow batches between Spark and Python: texts can be long, so batches are short.
BATCH_ROWS = 2_000
BATCH_BYTES = 8 << 20


def short_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches for texts, unless they are bounded tighter already."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def released(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """Give memory back to the system when a task ends: Python workers outlive their tasks."""

    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return wrapped


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SCRATCH: ContextVar[str | None] = ContextVar("scratch", default=None)


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder name below the folder that all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{_SCRATCH.get() or spark.sparkContext.getCheckpointDir()}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Folders named within lie below one that is removed at the end, so it only serves work
    that ends within."""
    path = shared_folder(spark, "scratch")
    before = _SCRATCH.set(path)
    try:
        yield
    finally:
        _SCRATCH.reset(before)
        remove_path(spark, path)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write the rows to the shared folder and read on from there: cuts the lineage for good."""
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts(docs: DataFrame) -> DataFrame:
    """`doc_id` and `text` only, a null text as the empty one, plus the identity of a row.

    A row is identified by its id and the hash of its text, so an id that comes twice with two
    texts is two rows, and a row that repeats exactly gets the same answer twice. Null ids take
    part like any other. Columns of other names never get in, so they cannot clash.
    """
    short_batches(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).select(
        "doc_id",
        F.coalesce("doc_id", F.lit(NO_ID)).alias("_id"),
        F.xxhash64("text").alias("_text_hash"),
        "text",
    )


ROW = ["_id", "_text_hash"]


def free_name(base: str, taken: list[str]) -> str:
    """`base`, with as many underscores put in front as make it differ from every name in
    `taken` as Spark compares names (case ignored), so helper columns never clash with input ones."""
    lower = {t.lower() for t in taken}
    name = base
    while name.lower() in lower:
        name = "_" + name
    return name


#: Bits of a key filter per key, and words of 64 bits in it at most (16 MB).
FILTER_BITS = 16
FILTER_WORDS = 1 << 21


class KeyFilter:
    """A bit map that tells which rows may have one of some keys (64-bit hashes, two bits each).

    Rows that certainly have none need not be shuffled to meet the keys; what passes is to be
    joined with them. The map is bounded: with more keys than it has room for it lets more rows
    through, and what follows has more to do.
    """

    def __init__(self, keys: DataFrame, key: Column) -> None:
        spark = keys.sparkSession
        self.n_words = 1 << min((keys.count() * FILTER_BITS // 64).bit_length(), FILTER_WORDS.bit_length() - 1)
        at = keys.select(F.explode(F.array(*self._places(key))).alias("at"))
        found = (
            at.groupBy(F.shiftright("at", 6).alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 AS INT))")).alias("bits"))
            .toArrow()
        )
        self.words = np.zeros(self.n_words, np.int64)
        self.words[found["word"].to_numpy()] = found["bits"].to_numpy()
        one = pa.ListArray.from_arrays(pa.array([0, self.n_words], pa.int32()), pa.array(self.words))
        self._row = spark.createDataFrame(pa.table({"_filter_words": one}))

    def _places(self, key: Column) -> list[Column]:
        last = F.lit(64 * self.n_words - 1)
        return [key.bitwiseAND(last), F.shiftrightunsigned(key, 32).bitwiseAND(last)]

    def _rows(self, df: DataFrame, key: str, how: str) -> DataFrame:
        name = free_name("_filter_words", df.columns)
        row = self._row.toDF(name)
        meets = F.lit(True)
        for place in self._places(df[key]):
            word = F.get(row[name], F.shiftright(place, 6).cast("int"))
            bit = F.call_function("shiftright", word, place.bitwiseAND(F.lit(63)).cast("int"))
            meets &= bit.bitwiseAND(F.lit(1)) == 1
        return df.join(F.broadcast(row), meets, how)

    def may_have(self, df: DataFrame, key: str) -> DataFrame:
        """The rows of `df` whose key may be one of the keys: all that have one, and some others."""
        return self._rows(df, key, "left_semi")

    def have_none(self, df: DataFrame, key: str) -> DataFrame:
        """The other rows."""
        return self._rows(df, key, "left_anti")

    def marks(self) -> Callable[[np.ndarray], np.ndarray]:
        """`may_have` for arrays of keys, to be used in tasks."""
        words, last = self.words.view(np.uint64), np.uint64(64 * self.n_words - 1)

        def may_have(key: np.ndarray) -> np.ndarray:
            key = key.view(np.uint64)
            out = np.ones(len(key), bool)
            for place in (key & last, key >> np.uint64(32) & last):
                out &= (words[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)) == 1
            return out

        return may_have


def public_id() -> Column:
    """The id of a row as the caller knows it: null where it was null."""
    return F.when(F.col("_id") != NO_ID, F.col("_id"))


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[tuple]:
    """Cut a batch by bytes of text: (first row, row after the last, bytes, offsets of the rows).

    The bytes are a view of the batch's own buffer.
    """
    array = batch.column(column)
    if pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type):
        kind = np.int64
    elif pa.types.is_string(array.type) or pa.types.is_binary(array.type):
        kind = np.int32
    else:
        raise TypeError(f"{column} is {array.type}, not text")
    if not len(array):
        return
    _, where, data = array.buffers()
    offsets = np.frombuffer(where, kind)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(array):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(array))
        yield first, last, raw[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last
