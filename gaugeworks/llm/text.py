"""Text helpers shared by the document operators: words, word hashes and Arrow plumbing."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: A word is a run of characters other than blank, tab, line feed, vertical tab, form feed and return.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

_SLICE = 1024


def words_of(raw: bytes | None) -> list[bytes]:
    """The words of a UTF-8 text: ``bytes.split`` cuts at just the six characters that end a word."""
    return raw.split() if raw else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (shift, multiply, shift)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def shingle_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """One hash per window of ``width`` words; a shorter, non-empty sequence gives one hash of all its words."""
    if not len(h):
        return h
    width = min(width, len(h))
    n = len(h) - width + 1
    out = np.full(n, width, np.uint64)
    for k in range(width):
        out = mix64(out + h[k:k + n])
    return out


def encoded(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column."""
    return column.cast(pa.binary()).to_pylist()


def slices(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    """An Arrow batch in parts: texts become Python objects, so few of them at a time."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def crc_mod(doc_id: Column, m: int) -> Column:
    """crc32 of the id as text, modulo ``m``; null ids count as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % m


def guarded(docs: DataFrame) -> DataFrame:
    """``docs`` with names that cannot clash with those of an operator."""
    return docs.toDF(*[f"in_{c}" for c in docs.columns])


def restored(df: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` from a frame derived from ``guarded(docs)``."""
    return df.select(*[F.col(f"`in_{c}`").alias(c) for c in docs.columns])


def map_texts(df: DataFrame, text: str, out: str, fn: Callable[[list[bytes | None]], list[pa.Array]],
              keep: list[str] | None = None) -> DataFrame:
    """``df[keep]`` with further columns ``out`` (DDL) that ``fn`` derives from each Arrow batch of ``text``. A kept column
    with the name of a new one gives way to it."""
    added = StructType.fromDDL(out)
    made_names = {n.lower() for n in added.fieldNames()}
    keep = [c for c in (df.columns if keep is None else keep) if c.lower() not in made_names]
    passed = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("\x00text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, _SLICE)):
            cols = batch.columns
            made = fn(encoded(cols[-1]))
            yield pa.RecordBatch.from_arrays(cols[:-1] + made, keep + added.fieldNames())

    schema = StructType(list(passed.schema.fields[:-1]) + list(added.fields))
    return passed.mapInArrow(run, schema)
