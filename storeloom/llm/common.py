"""What several operators share: words, tables, folders that every executor reaches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storeloom.session import ensure_checkpoint_dir

#: A word: a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
#: The same characters, as ``bytes.split()`` splits on them.
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one that the cluster names in ``spark.checkpoint.dir``."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def whole_text(column: str) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def slices(batches: Iterator[pa.RecordBatch], text: str = "text",
           most: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of text, so that a task's memory does not
    depend on how long the texts are (a single longer text is a batch of its own)."""
    for batch in batches:
        lengths = pa.compute.fill_null(pa.compute.binary_length(
            batch.column(batch.schema.get_field_index(text))), 0).to_numpy(zero_copy_only=False)
        start = size = 0
        for i, n in enumerate(lengths):
            if i > start and size + n > most:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += int(n)
        if batch.num_rows > start:
            yield batch.slice(start)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch, empty where they are null."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def without(names: list[str], results: list[str]) -> list[str]:
    """The names of kept columns; a result column takes the place of a kept one of its name."""
    taken = {r.lower() for r in results}
    return [n for n in names if n.lower() not in taken]


def unused(name: str, names: list[str]) -> str:
    """The name, longer if a column has it."""
    while name.lower() in {n.lower() for n in names}:
        name += "_"
    return name
