"""Small helpers that the operators of this package share."""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statforge.session import stored

#: Words are runs of other characters than these six: ``bytes.split()`` cuts at exactly them.
WHITE = "\x20\t\n\x0b\x0c\r"


PRIME = np.uint64(0x9E3779B97F4A7C15)
_MOST_WORDS = 400_000


class WordHashes(dict):
    """64-bit hashes of words, kept while there are not too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MOST_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads every input bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z, and only those, in lower case; NULL counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def utf8(text: Column) -> Column:
    """The bytes of ``text``; NULL counts as empty. Workers then decode only what they need."""
    return F.coalesce(text, F.lit("")).cast("binary")


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id, as text, leaves no remainder by 5. A NULL id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def map_columns(df: DataFrame, schema: str, work: Callable[..., dict[str, object]], rows: int | None = None) -> DataFrame:
    """Run ``work`` over Arrow batches of ``df``: it gets each column as a list, and returns the result's columns by name.

    With ``rows`` it gets so many rows at once at most, where results are larger than what they come from.
    """
    names = df.columns
    target = arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in _slices(whole, rows)):
            columns = work(*(batch.column(i).to_pylist() for i in range(len(names))))
            yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in target], schema=target)

    return df.mapInArrow(run, schema)


def _slices(batch: pa.RecordBatch, rows: int | None) -> Iterator[pa.RecordBatch]:
    if rows is None:
        yield batch
        return
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    """The Arrow form of a DDL string."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, seed: int) -> DataFrame:
    """At most ``rows`` labelled training documents as (doc_id, text, label).

    They are drawn from all labelled ids outside the held-out fold, in the order of a hash. A document with
    several labels has the least of them. The drawn ids are at most ``rows`` pairs of numbers, which bounds
    the broadcast.
    """
    usable = labels.select(F.col("doc_id").alias("__id"), F.col(label).cast("int").alias("__y")).where(
        F.col("__id").isNotNull() & F.col("__y").isin(0, 1) & ~held_out(F.col("__id"))
    )
    drawn = usable.orderBy(F.xxhash64("__id", F.lit(seed)), "__id", "__y").limit(rows)
    drawn = drawn.groupBy("__id").agg(F.min("__y").alias("__y"))
    return docs.select("doc_id", "text").join(F.broadcast(drawn), F.col("doc_id") == F.col("__id")).select("doc_id", "text", F.col("__y").alias("label"))


def checkpointed(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, so that later steps and retries don't compute it again."""
    return stored(df, f"llm-{label}")
