"""Helpers shared by the operators: reading the tables, folds, text slices."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a table; other columns are never read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def slices(batch, chars: int = 4_000_000) -> Iterator:
    """Cut an Arrow batch with a column ``text`` into pieces of about so many bytes of text, one row at least."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
    start = held = 0
    for i, n in enumerate(sizes):
        if held and held + n > chars:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def texts(batch) -> list[str]:
    """The batch's texts; null becomes the empty text."""
    return [t or "" for t in batch.column("text").to_pylist()]


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, for mapInArrow; at a task's end its worker, which goes on to other stages, gives back what is free."""

    def whole(batches):
        yield from run(batches)
        _give_back()

    return whole


def _give_back() -> None:
    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc keeps freed memory below what is still held
    if trim:
        trim(0)


def sample_by_hash(df: DataFrame, key: str, expected: int, total: int, salt: int) -> DataFrame:
    """A repeatable sample of about ``expected`` of ``total`` rows, chosen by the key's hash."""
    if total <= expected:
        return df
    return df.where(F.pmod(F.xxhash64(F.lit(salt), F.col(key)), F.lit(1 << 30)) < F.lit(int((1 << 30) * expected / total)))


def likely(rows: DataFrame, key: str, wanted: DataFrame, inside: bool = True) -> DataFrame:
    """The rows whose key may be among those wanted (or not ``inside``: surely is not), without a shuffle of the rows.

    The wanted keys' hashes set bits of a filter of 2^16 words of 64 bits; that table, at most 2^16 rows whatever the
    input, is broadcast. Keys that are not wanted may pass; where wanted keys fill the filter, all do.
    """
    h = lambda: F.xxhash64(F.lit(3), F.col(key))
    word, bit = F.shiftright(h(), 6).bitwiseAND(F.lit((1 << 16) - 1)), F.expr(f"1L << cast(xxhash64(3, {key}) & 63 as int)")
    words = wanted.select(word.alias("_word"), bit.alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    met = rows.withColumn("_word", word).join(F.broadcast(words), "_word", "left")
    there = F.coalesce(F.col("_bits").bitwiseAND(bit) != 0, F.lit(False)) & F.col(key).isNotNull()
    return met.where(there if inside else ~there).select(*[F.col(f"`{c}`") for c in rows.columns])


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; where nothing is set, as in tests, one of this session's own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if folder is None:
            if not re.fullmatch(r"local(\[.*\])?", context.master):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors reach")
            folder = tempfile.mkdtemp(prefix="tidemark-checkpoints-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a copy in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
