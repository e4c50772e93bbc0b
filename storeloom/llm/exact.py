"""Exact dedup by a tree-merge of sorted digest runs, in DataFrame functions only.

Each input partition becomes a run: one entry for each of its texts, sorted by digest, with the
smallest row and the number of rows. In each round, runs whose numbers differ in the lowest four
bits only meet and are merged into one, sixteen at a time, until a single run is left. An entry is
known by the SHA-256 of the normalised text, its length and a second, independent hash; entries meet
only if all three agree, which verifies the digest at every level. A text that a third of all rows
share is one entry in each run, so that no task of any round gets more than sixteen entries of it. The
result goes back down the same tree: an entry asks its parent in the next run, and a row the
entry of its own run. Runs are dealt to tasks by run and digest and never gathered in one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeloom.llm.common import unused, whole_text, without
from storeloom.session import cut_lineage

#: Two to this power runs meet in one merge.
FAN_IN_BITS = 4
_RESULTS = ["keep_id", "group_size", "kept", "text_sha256"]
_ENTRY = ["sha", "chars", "check"]


def normalised(text: str) -> Column:
    """The text with each run of ASCII white space as one space; empty where it is null."""
    return F.regexp_replace(whole_text(text), r"[\x20\x09-\x0D]+", " ")


def _digested(docs: DataFrame, text: str, id_col: str, keep: list[str]) -> DataFrame:
    """One row for each document: its run, its place, and what identifies its text; texts stay
    behind unless they are to be kept."""
    kept = F.struct(*[F.col(f"`{c}`") for c in keep]) if keep else F.lit(0)
    body = (docs.select(F.col(f"`{id_col}`").alias("id"), normalised(text).alias("body"), kept.alias("keep"))
            .select("id", "body", "keep", F.spark_partition_id().alias("run"),
                    F.monotonically_increasing_id().alias("place")))
    return body.select(
        "run", F.unhex(F.sha2("body", 256)).alias("sha"), F.length("body").alias("chars"),
        F.xxhash64("body").alias("check"), "id", "place", "keep")


def _merged(entries: DataFrame, run: Column) -> DataFrame:
    """Entries of equal run and text as one: the least (id, place), null ids last, and all rows.

    The least of a structure makes Spark sort by the keys before and after the exchange and merge
    neighbours, so that a run is combined with itself before anything is sent.
    """
    return cut_lineage(entries.withColumn("run", run).groupBy("run", *_ENTRY).agg(
        F.min("least").alias("least"), F.sum("n").alias("n")))


def mark(docs: DataFrame, text: str = "text", id_col: str = "doc_id",
         keep_columns: list[str] | None = None, bits: int = FAN_IN_BITS) -> DataFrame:
    """``keep_columns`` (the id by default) of every row with ``keep_id`` (id of the row that stays),
    ``group_size``, ``kept`` and ``text_sha256`` (lowercase hex of the normalised text).

    Texts are equal if they agree after ``normalised``: null, empty and, but for one space, blank texts
    alike. The row with the smallest id stays, one of them where rows repeat with their id; a null id
    comes after all others. Very long texts are hashed whole. An empty table gives no rows. A
    result column takes the place of a kept one of its name; other columns may have any name.
    """
    keep = without([id_col] if keep_columns is None else keep_columns, _RESULTS)
    rows = cut_lineage(_digested(docs, text, id_col, keep))
    levels = [_merged(rows.select("run", *_ENTRY, F.lit(1).cast("long").alias("n"), F.struct(
        F.col("id").isNull().alias("unknown"), "id", "place").alias("least")), F.col("run"))]
    last = rows.agg(F.max("run")).first()[0] or 0
    while last:
        levels.append(_merged(levels[-1], F.shiftright("run", bits)))
        last >>= bits

    found = levels.pop()
    while levels:
        above = found.withColumnRenamed("run", "above")
        entries = levels.pop().select("run", *_ENTRY, F.shiftright("run", bits).alias("above"))
        found = cut_lineage(entries.join(above, ["above", *_ENTRY]).drop("above"))
    marked = rows.join(found.select("run", *_ENTRY, "least", "n"), ["run", *_ENTRY])
    kept = [F.col("keep").getField(c).alias(c) for c in keep]
    return marked.select(
        *kept, F.col("least.id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("place") == F.col("least.place")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def drop_copies(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows that stay, with all their columns; cases as in ``mark``.

    Whole rows are written once below the shared folder and meet the tree's result once.
    """
    every = unused("row", docs.columns)
    packed = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("body"),
                         F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(every))
    return mark(packed, "body", "id", [every]).where("kept").select(f"`{every}`.*")
