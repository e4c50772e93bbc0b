import base64
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from storeloom.llm import bpe

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_odd_texts(library):
    rng = random.Random(5)
    letters = list("aeiou tnsr  \n\t'é🙂日1295.,!#\x1c\x85\xa0　") + ["'s", "'ll", " the", "<|endoftext|>"]
    texts = ["", " ", "x" * 3000, "ab" * 60 + " " + "1234567" * 30, "﻿ a", " lead", "trail "] + [
        "".join(rng.choices(letters, k=rng.randint(0, 90))) for _ in range(1500)]
    encoder = bpe.Encoder(PATH, P.PATTERN)
    for t, ids in zip(texts, encoder.encode(texts), strict=True):
        assert "".join(bpe.pieces_of(t)) == t
        assert ids.tolist() == library.encode_ordinary(t), repr(t)
        assert bpe.decode(ids, encoder.ranks.bytes_of) == t.encode()


def test_both_trees_agree():
    ranks = bpe.ranks_of(PATH)
    rng = random.Random(6)
    matches = [bytes(rng.choices(b"etaoin shr", k=rng.randint(1, 64))) for _ in range(300)]
    for m, ids in zip(matches, ranks.many(matches), strict=True):
        assert ids.tolist() == ranks.one(m)


def test_forgetting_changes_nothing(library, monkeypatch, texts):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    encoder = bpe.Encoder(PATH, P.PATTERN)
    for _, t in texts[:40]:
        assert encoder.encode([t])[0].tolist() == library.encode_ordinary(t)


def test_documents(spark, clashing, texts, library):
    got = bpe.encoding_digests(clashing, PATH, P.PATTERN).collect()
    want = Counter()
    for i, t in texts:
        ids = library.encode_ordinary(t)
        want[i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
             hashlib.sha256(t.encode()).hexdigest()] += 1
    assert Counter(map(tuple, got)) == want
    encoded = bpe.encode_documents(clashing, PATH, P.PATTERN)
    back = bpe.decode_documents(encoded, PATH)
    assert Counter(map(tuple, back.collect())) == Counter(texts)
    assert bpe.encode_documents(clashing.limit(0), PATH, P.PATTERN).count() == 0
    assert bpe.decode(np.zeros(0, np.uint32), []) == b""
