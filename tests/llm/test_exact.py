"""Exact dedup against grouping in Python, for several shapes of the tree."""

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from storeloom.llm import exact


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def plain(rows):
    """(id, keep_id, size, sha, number of kept copies of the row's id) for each row."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[normal(t)].append(i)
    least = {t: min(ids, key=lambda i: (i is None, i or 0)) for t, ids in groups.items()}
    return sorted((str(i), str(least[normal(t)]), len(groups[normal(t)]),
                   hashlib.sha256(normal(t).encode()).hexdigest()) for i, t in rows)


@pytest.mark.parametrize("parts, bits", [(1, 4), (3, 1), (40, 4), (33, 2)])
def test_against_grouping(spark, docs, parts, bits):
    many = docs.select("doc_id", "text").unionByName(spark.range(1000, 1400).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, " the  same\t\x0btext ").when(
            F.col("id") % 3 == 1, F.concat(F.lit("\ntext "), F.col("id") % 50)).otherwise("the same text").alias("text")))
    many = many.repartition(parts)
    out = exact.mark(many, bits=bits).collect()
    rows = [(r.doc_id, r.text) for r in many.collect()]
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in out) == plain(rows)
    # Exactly one row of each group stays, with the group's id.
    kept = [r for r in out if r.kept]
    assert len(kept) == len({normal(t) for _, t in rows}) and all(r.doc_id == r.keep_id for r in kept)


def test_empty_tables_and_clashing_columns(spark, docs, clashing):
    assert exact.mark(docs.limit(0)).collect() == [] and exact.drop_copies(docs.limit(0)).collect() == []
    odd = clashing.withColumns({c: F.lit(2) for c in ("run", "sha", "least", "n", "place", "id", "check", "above", "keep_id")})
    marked = exact.mark(odd, keep_columns=odd.columns)
    assert set(odd.columns) <= set(marked.columns) and marked.count() == docs.count()
    assert marked.select("run").distinct().count() == 1 and marked.schema["keep_id"].dataType.simpleString() == "bigint"
    kept = exact.drop_copies(odd)
    assert kept.columns == odd.columns
    assert sorted(normal(r.text) for r in kept.collect()) == sorted({normal(r.text) for r in docs.collect()})


def test_only_built_in_functions(spark, docs):
    plan = exact.mark(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_one_row_stays_where_rows_repeat(spark):
    df = spark.createDataFrame([(5, "x"), (5, "x"), (None, "x"), (None, "y"), (None, "y")], "doc_id long, text string")
    out = sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in exact.mark(df.repartition(4)).collect())
    assert out == [("5", "5", 3, False), ("5", "5", 3, True), ("None", "5", 3, False),
                   ("None", "None", 2, False), ("None", "None", 2, True)]
