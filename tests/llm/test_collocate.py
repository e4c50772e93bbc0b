"""Collocations against counting every phrase in Python."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from storeloom.llm import collocate

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces_of(text):
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER))]


def brute(rows, least, longest=5, top=2000, absorbed=100):
    grams, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for w in pieces_of(text):
            totals[lang] += len(w)
            for k in range(1, longest + 1):
                grams[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in grams.items():
        n, found = totals[lang], {g: c for g, c in f.items() if len(g) > 1 and c >= least}
        held = defaultdict(int)
        for g, c in found.items():
            for k in range(2, len(g)):
                for i in range(len(g) - k + 1):
                    held[g[i:i + k]] = max(held[g[i:i + k]], c)
        rows = []
        for g, a in found.items():
            score, _, left, right = min((1000 * a * n // (f[g[:k]] * f[g[k:]]), k, f[g[:k]], f[g[k:]])
                                        for k in range(1, len(g)))
            if not (held[g] and 100 * held[g] >= absorbed * a):
                rows.append((-score, -a, " ".join(g).encode(), left, right))
        out += [(lang, r, p.decode(), -a, left, right, n, -s) for r, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def texts(seed=4, n=300):
    rng = random.Random(seed)
    words = ["Alpha", "beta", "the", "of", "déjà", "🙂", "a-b", "x"] + [f"w{i}" for i in range(30)]
    passage = " ".join(rng.choices(words, k=70)) + ". " + " ".join(rng.choices(words, k=40))
    rows = [(rng.choice(["en", "de", None]), rng.choice([" ", "  ", "\t", "\n", ". ", "\x0b"]).join(
        rng.choices(words, k=rng.randint(0, 60)))) for _ in range(n)]
    rows += [("en", f"{rng.choice(words)} {passage}\r\n{rng.choice(words)}") for _ in range(40)]
    rows += [("en", passage)] * 30 + [("und", "the of the of the"), (None, None), ("en", ""), ("en", " \t\n.,"),
                                      ("de", "the " * 3000), ("de", "w" * 70_000 + " the of")]
    return rows


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame(texts(), "lang string, text string").repartition(4)


@pytest.mark.parametrize("least, longest, one_in, top", [(20, 5, 32, 2000), (5, 3, 2, 40), (30, 2, 7, 7), (10, 5, 1, 2000)])
def test_against_counting(corpus, least, longest, one_in, top):
    got = collocate.collocations(corpus, longest=longest, least=least, one_in=one_in, top=top)
    want = brute(texts(), least, longest, top)
    assert len(want) > 5 and sorted(map(tuple, got.collect())) == want


def test_absorption_by_part_of_the_count(corpus):
    got = collocate.collocations(corpus, least=10, absorbed=60)
    assert sorted(map(tuple, got.collect())) == brute(texts(), 10, absorbed=60)


def test_empty_clashing_and_numbers_past_64_bits(spark, corpus):
    assert collocate.collocations(corpus.limit(0)).collect() == []
    odd = corpus.withColumns({c: F.lit(1) for c in ("_lang", "_text", "chunk", "owned", "weight", "k", "f", "n", "rank")})
    assert sorted(map(tuple, collocate.collocations(odd, least=20).collect())) == brute(texts(), 20)
    row = spark.sql("SELECT cast(1000 as decimal(4,0)) * cast(987654321987 as decimal(16,0)) * cast(1234567890123 as "
                    "decimal(16,0)) div (cast(77777777777 as decimal(16,0)) * cast(999999999 as decimal(16,0))) AS s").first()
    assert row.s == 1000 * 987654321987 * 1234567890123 // (77777777777 * 999999999)


def test_chunks_own_each_word_once():
    column = pa.array([t or "" for _, t in texts()])
    words = collocate.Words(column)
    chunks, owned, rows = collocate.chunks_of(words, 4, 8)
    assert owned.sum() == len(words.starts) == sum(len(p) for _, t in texts() for p in pieces_of(t))
    assert len(set(chunks)) < len(chunks) and (np.diff(rows) >= 0).all()
    # A chunk's words are its own ones and the window that starts the next chunk.
    for chunk, n in zip(chunks, owned.tolist(), strict=True):
        assert len(chunk.split()) in (n, n + 4)


def test_word_hashes_depend_on_the_word_only():
    text = "one two three two one " + "z" * 5_000_000 + " two"
    words = collocate.Words(pa.array(["pad pad", text]))
    h = words.hashes[2:]
    assert h[0] == h[4] and h[1] == h[3] == h[6] and len({*h.tolist()}) == 4


def test_bitmap_has_the_bits(spark):
    hashes = [3, -1, 1 << 40, (1 << 15) - 1, 12345678901]
    bits = collocate._bitmap(spark.createDataFrame([(h,) for h in hashes], "hash long"))
    assert len(bits) * 8 == 1 << 15
    want = {h & 0x7FFF for h in hashes}
    assert {i for i in range(1 << 15) if bits[i >> 3] >> (i & 7) & 1} == want
