"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.session import remove_folder, written

WORD_CACHE = 1 << 18
#: Rows that a job sees at once, whatever the session sends to Python in a batch.
ROWS_AT_ONCE = 1_000
SHINGLE_WORDS = 5
_ODD = np.uint64(0x9E3779B97F4A7C15)
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def kept(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` as a table in the folder that all executors share.

    Computed once; a lost executor takes nothing of it along. Tables made inside
    a ``trawl.session.scratch`` block go when it ends.
    """
    return written(rows, name)


def drop_kept(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete tables of :func:`kept` that nothing reads any more."""
    for path in {f.rsplit("/", 1)[0] for t in tables for f in t.inputFiles()}:
        remove_folder(spark, path)


def fresh(rows: DataFrame, name: str) -> str:
    """A column name that ``rows`` does not have, whatever the case."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name = f"{name}_"
    return name


def by_arrow(
    rows: DataFrame, schema: str, job: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]]
) -> DataFrame:
    """``mapInArrow`` for a job that yields a dict of columns per batch.

    The job sees batches of at most ``ROWS_AT_ONCE`` rows, as it turns them into
    Python objects.
    """
    fields = rows.sparkSession.createDataFrame([], schema).schema
    names = fields.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        wanted = to_arrow_schema(fields)
        small = (
            batch.slice(i, ROWS_AT_ONCE)
            for batch in batches
            for i in range(0, batch.num_rows, ROWS_AT_ONCE)
        )
        for columns in job(small):
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[n], wanted.field(n).type) for n in names], schema=wanted
            )

    return rows.mapInArrow(run, schema)


def words_column(text: Column | str) -> Column:
    """Number of words, ``[^\\x20\\x09-\\x0D]+``, in a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def mixed(values: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = values + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hash of a word; a bounded cache, as words repeat."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def lower_words(text: str) -> list[bytes]:
    """Words with A-Z in lower case. ``bytes.split`` cuts at x20 and x09-x0D only."""
    return text.encode("utf-8", "surrogatepass").translate(_LOWER).split()


def shingles(hashes: np.ndarray, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Hashes of all runs of ``size`` words; of the whole if it is shorter."""
    n = len(hashes)
    if n == 0:
        return hashes
    size = min(n, size)
    out = np.zeros(n - size + 1, np.uint64)
    for i in range(size):
        out = out * _ODD + hashes[i : n - size + 1 + i]
    return mixed(out, size)
