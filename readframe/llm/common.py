"""Small helpers shared by the text operators."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from readframe.session import scratch_path

# Texts are worked through in pieces of about this many bytes, so that memory does not follow the batch size.
PIECE_BYTES = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not use yet, in any case."""
    taken, name = {c.lower() for c in df.columns}, stem
    while name.lower() in taken:
        name = f"_{name}"
    return name


def fold(id_col: str, folds: int) -> Column:
    """The fold of a row: crc32 of the id as text, modulo ``folds``. A null id is in fold 0."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds)), F.lit(0)).cast("int")


def fold_of(value: object, folds: int) -> int:
    """The same in Python."""
    return 0 if value is None else zlib.crc32(str(value).encode()) % folds


def stored(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """``df`` written to the shared folder and read again: lineage is cut, lost executors lose nothing."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def pieces(batch: pa.RecordBatch, text_col: str, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of at most ``most`` text bytes; a longer text is a slice of its own."""
    if not batch.num_rows:
        return
    sizes = np.asarray(pc.binary_length(batch.column(text_col)).fill_null(0), dtype=np.int64)
    begin, total = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if row > begin and total + size > most:
            yield batch.slice(begin, row - begin)
            begin, total = row, 0
        total += size
    yield batch.slice(begin)


def each_piece(batches: Iterable[pa.RecordBatch], text_col: str, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from pieces(batch, text_col, most)


def texts_of(batch: pa.RecordBatch, text_col: str) -> list[str]:
    return [t or "" for t in batch.column(text_col).to_pylist()]


def gather(flat: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The runs ``flat[start : start + len]`` one after another."""
    total = int(lens.sum())
    ends = np.cumsum(lens)
    return flat[np.arange(total) + np.repeat(starts - (ends - lens), lens)]


def words_of(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text with A-Z lower-cased."""
    return text.lower().split()


# Bytes of words: digits, letters (A-Z lower-cased) and all above 0x7F; the others part words.
PLAIN_WORDS = bytes(b | 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def plain_words(text: str) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text with A-Z lower-cased."""
    return text.encode().translate(PLAIN_WORDS).split()


def sampled(df: DataFrame, group: str, key: str, bound: int) -> DataFrame:
    """About ``bound`` rows of each group at most, chosen by a hash of ``key``; all rows of a smaller group.

    The counts per group are merged on the map side, so a group of any size is cheap.
    """
    counts = df.groupBy(group).agg(F.count("*").alias("_n"))
    parts = 1 << 30
    chosen = df.join(F.broadcast(counts), group)
    return chosen.filter(F.pmod(F.xxhash64(key), F.lit(parts)) * F.col("_n") < F.lit(bound * parts)).drop("_n")


class Growing:
    """An array that grows by appending."""

    def __init__(self, dtype) -> None:
        self.data, self.size = np.zeros(1024, dtype=dtype), 0

    def extend(self, values: np.ndarray) -> None:
        need = self.size + len(values)
        if need > len(self.data):
            self.data = np.concatenate([self.data, np.zeros(max(need, len(self.data)), dtype=self.data.dtype)])
        self.data[self.size : need] = values
        self.size = need

    def view(self) -> np.ndarray:
        return self.data[: self.size]


class Numbered(dict):
    """Numbers keys in the order in which they are first asked for."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list = []

    def __missing__(self, key):
        self[key] = number = len(self)
        self.new.append(key)
        return number
