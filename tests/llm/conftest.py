import random

import pytest


@pytest.fixture(scope="session")
def docs(spark):
    """Documents with the awkward cases: nulls, empty, repeated, very long, odd spaces."""
    rng = random.Random(3)
    words = ["alpha", "beta", "gamma", "déjà", "the", "of", "x", "42", "🙂", "end.", "a|b", "##"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 60))), "en", f"s{i % 5}", 0)
            for i in range(120)]
    rows += [(200, None, None, None, None), (201, "", "en", "s0", 0), (202, " \n\t ", "en", "s1", 3),
             (203, "one two\n\n\none two\n three  four \r\n", "en", None, 1),
             (204, " ".join(rng.choices(words, k=30_000)), "en", "s2", 1), (205, "w" * 50_000, "de", "s2", 1),
             (206, rows[7][1], "en", "s3", 1), (207, rows[7][1], "en", "s0", 1), (207, rows[7][1], "en", "s0", 1),
             (None, rows[9][1], "en", "s0", 1), (208, "a b c d e f g h " * 3 + "end", "en", "s4", 1)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)


@pytest.fixture(scope="session")
def clashing(docs):
    """The same with columns named like results and helpers."""
    from pyspark.sql import functions as F

    return docs.withColumns({c: F.lit(1) for c in (
        "n_words", "kept", "score", "size", "key", "set_key", "kind", "ids", "_id", "_text", "row_")})


@pytest.fixture(scope="session")
def texts(docs):
    return [(r.doc_id, r.text or "") for r in docs.collect()]
