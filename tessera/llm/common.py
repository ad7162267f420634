"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.session import BATCH_BYTES, SETTINGS
from tessera.sources.checkpoints import working_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

#: A word: a run without blanks, as a pattern that Java, RE2 and Python read alike.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows a Python helper looks at together; texts of one slice are held at once.
SLICE = 256


def text_of(column: str = "text") -> Column:
    """The text, '' for null."""
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else; texts of one byte a character take the quick way."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def remainder(key: str, divisor: int) -> Column:
    """crc32 of the key as text, modulo ``divisor``; null keys count as ''."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(divisor))


def bounded(df: DataFrame) -> DataFrame:
    """``df``, in a session whose Arrow batches hold few bytes; one that names a bound itself keeps it.

    A batch is held by the task's JVM, outside its heap, and by its Python worker.  By default it has up to 64 MB.
    """
    conf = df.sparkSession.conf
    if BATCH_BYTES not in conf.getAll:
        conf.set(BATCH_BYTES, SETTINGS[BATCH_BYTES])
    return df


def map_arrow(
    df: DataFrame,
    schema: str | StructType,
    function: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch] | pa.RecordBatch],
    rows: int = SLICE,
) -> DataFrame:
    """``mapInArrow`` over slices of at most ``rows`` rows, of few bytes, so that a task holds few texts at once."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                made = function(batch.slice(start, rows))
                if isinstance(made, pa.RecordBatch):
                    yield made
                else:
                    yield from made

    return bounded(df).mapInArrow(over, schema)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a compressed table in the shared folder, read again: computed once, lost with no executor."""
    path = working_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


#: Bits per key in a bitmap of keys, and most bits of one.
BITS_PER_KEY, MOST_BITS = 16, 1 << 28
#: Bits of one row of a bitmap.
PART = 32_768


def bitmap_bits(n: int) -> int:
    """A power of two with room for ``n`` keys; 32 MB of bits at most."""
    bits = PART
    while bits < min(MOST_BITS, BITS_PER_KEY * n):
        bits *= 2
    return bits


def place_in(bits: int, key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits))


def bitmap(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """(part, map): the places of all keys set, in rows of ``PART`` bits."""
    at = place_in(bits, F.col(key))
    return keys.groupBy(F.floor(at / PART).alias("part")).agg(
        F.bitmap_construct_agg(F.pmod(at, F.lit(PART))).alias("map")
    )


def without(docs: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among ``keys``, as an anti join gives them.

    A broadcast bitmap, of bounded size, clears most rows where they are; only those that it cannot
    clear are moved to be compared.
    """
    bits = bitmap_bits(keys.count())
    at = place_in(bits, F.col(key))
    maps = bitmap(keys, key, bits).select(F.col("part").alias("__part"), F.col("map").alias("__map"))
    byte = F.substring(F.col("__map"), (F.pmod(at, F.lit(PART)) / 8).cast("int") + 1, F.lit(1))
    filled = F.conv(F.hex(byte), 16, 10).cast("int")
    shifted = F.call_function("shiftright", filled, F.pmod(at, F.lit(8)).cast("int"))
    unset = shifted.bitwiseAND(F.lit(1)) == 0
    met = docs.join(F.broadcast(maps), F.floor(at / PART) == F.col("__part"), "left")
    clear = F.coalesce(unset, F.lit(True))
    names = docs.columns
    unsure = met.filter(~clear).select(*names).join(keys.select(key).distinct(), key, "left_anti")
    return met.filter(clear).select(*names).unionByName(unsure.select(*names))


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch, '' for null."""
    return [t or "" for t in batch.column(name).to_pylist()]


_kept: dict[object, object] = {}


def worker_state(name: object, make: Callable[[], object]) -> object:
    """What a Python worker keeps between tasks: of one operator only, so that workers which many operators
    use in turn hold no more than one of them needs."""
    if name not in _kept:
        _kept.clear()
        pa.default_memory_pool().release_unused()
        _kept[name] = make()
    return _kept[name]
