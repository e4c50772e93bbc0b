"""The registered queries on the smallest tables, the pipeline, and the guard around both."""

import hashlib
import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as driver
import corpus_pipeline
from storeloom.llm import pii, quality
from storeloom.llm.queries import ORACLE, QUERIES
from tests.conftest import SMALL
from tests.llm import test_jaccard, test_pii, test_quality

REPO = os.path.dirname(os.path.abspath(driver.__file__))


def documents():
    return dict(duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{SMALL}/documents.parquet'").fetchall())


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(driver.queries()) and set(ORACLE) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    df = QUERIES[name](spark, SMALL)
    want = con.execute(ORACLE[name])
    columns = [c[0] for c in want.description]
    assert sorted(map(str, df.select(*columns).collect())) == sorted(
        str(df.sparkSession.createDataFrame([r], df.select(*columns).schema).first()) for r in want.fetchall())


def test_rows_of_the_others(spark):
    docs = documents()
    for r in QUERIES["op4_personal_data"](spark, SMALL).collect():
        base = test_pii.plain(docs[r.doc_id])
        text = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest() and r.spans.startswith(text)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x[0] == k for x in base) for k in range(4)]
    for r in QUERIES["op8_quality_rules"](spark, SMALL).collect():
        assert tuple(r)[1:7] == test_quality.plain(docs[r.doc_id]) and not (r.base_failed and r.kept)
    assert QUERIES["op3_licenses"](spark, SMALL).count() == len(docs)
    assert QUERIES["op5_toxicity"](spark, SMALL).count() == len(docs)


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, before = docs.columns, documents()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / str(k)))
        out = spark.read.parquet(str(tmp_path / str(k)))
        rows = out.collect()
        if k < 4:
            assert out.columns == columns
        if name == "quality_rules":
            model = quality.fit_quality(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
            good = quality.apply_quality(docs, model, keep_columns=["doc_id"]).where("kept")
            assert {r.doc_id for r in rows} == {r.doc_id for r in good.collect()}
            assert all(not test_quality.plain(r.text)[5] for r in rows)
        if name == "near_copies":
            classes = {c for _, c, _ in test_jaccard.plain([(r.doc_id, r.text) for r in docs.collect()])}
            assert sorted(r.doc_id for r in rows) == sorted(classes)
        if name == "personal_data":
            assert {r.doc_id for r in rows} == {r.doc_id for r in docs.collect()}
            assert not any(x[0] in (0, 1) for r in rows for x in test_pii.plain(r.text))
            assert all(r.n_chars == len(r.text) for r in rows)
        if name == "mix_sources":
            words = sum(len(t.encode().split()) for t in before.values())
            assert abs(sum(len(r.text.encode().split()) for r in rows) / (1.5 * words) - 1) < 0.01
        if name == "byte_bpe":
            assert len(rows) == len(before_rows)
            assert {r.decoded_sha256 for r in rows} == {
                hashlib.sha256(r.text.encode()).hexdigest() for r in before_rows}
        docs, before_rows, before = out, rows, {r.doc_id: getattr(r, "text", "") for r in rows}


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_awkward_tables(spark, clashing, name):
    """Nulls, repeated rows, clashing columns, long texts; then no rows at all."""
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, clashing, SMALL)
    rows = out.collect()
    if name == "byte_bpe":
        assert len(rows) == clashing.count() and out.columns[0] == "doc_id"
    else:
        assert out.columns == clashing.columns
    if name == "personal_data":
        assert len(rows) == clashing.count() and sum(r.text is None for r in rows) == 1
    none = stage(spark, clashing.limit(0), SMALL)
    assert none.columns == out.columns and none.count() == 0


def test_the_rest_imports_without_the_subpackage(tmp_path):
    for name in ("storeloom", "oracle"):
        shutil.copytree(f"{REPO}/{name}", tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{REPO}/__spark_entry__.py", tmp_path)
    done = subprocess.run(
        [sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), *e.queries())"],
        cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, check=True)
    assert "op1_" not in done.stdout and "pipeline" not in done.stdout.split()
    assert int(done.stdout.split()[0]) == len(driver.queries()) - len(QUERIES) - 1


@pytest.mark.parametrize("left", ["empty folder with compiled files", "no tokenizer package"])
def test_the_rest_imports_with_leftovers(tmp_path, left):
    ignore = shutil.ignore_patterns("__pycache__", *(["llm"] if left.startswith("empty") else []))
    for name in ("storeloom", "oracle"):
        shutil.copytree(f"{REPO}/{name}", tmp_path / name, ignore=ignore)
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        shutil.copy(f"{REPO}/{name}", tmp_path)
    if left.startswith("empty"):
        (tmp_path / "storeloom/llm/__pycache__").mkdir(parents=True)
        (tmp_path / "storeloom/llm/__pycache__/queries.cpython-313.pyc").write_bytes(b"")
    else:
        (tmp_path / "public_tokenizers.py").write_text("raise ImportError('no tokenizers here')")
    done = subprocess.run(
        [sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), *e.queries())"],
        cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, check=True)
    assert int(done.stdout.split()[0]) == len(driver.queries()) - len(QUERIES) - 1
