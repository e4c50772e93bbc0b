import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from storeloom.llm import tokenfile
from storeloom.llm.common import shared_folder

PATH = P.path("byte_bpe_50k.json")


@pytest.mark.parametrize("top", [1, 256, 50_000, 1 << 24, (1 << 32) - 1])
def test_codes(top):
    rng = np.random.default_rng(top)
    for n in (1, 511, 512, 513, 3000):
        ids = (rng.random(n) ** 4 * top).astype(np.uint32)
        ids[rng.integers(n)] = top
        segment = tokenfile.Segment(tokenfile.segment_bytes(ids))
        assert [segment.token(i) for i in range(0, n, 7)] == ids[::7].tolist()
        for a, b in np.sort(rng.integers(0, n + 1, (60, 2)), axis=1):
            assert (segment.run(int(a), int(b)) == ids[a:b]).all()


def test_library_encoder():
    library = Tokenizer.from_file(PATH)
    encoder = tokenfile.LibraryEncoder(PATH, P.PATTERN)
    texts = ["", " a  b ", "a<|endoftext|>b c", "don't  we'll", "\x00\xad\x7f\xa0é日🙂", "tail \n x", "x" * 999]
    for t, ids in zip(texts, encoder.encode(texts), strict=True):
        assert ids.tolist() == library.encode(t, add_special_tokens=False).ids


class _Counted:
    """The library's tokenizer; counts the calls of its model."""

    def __init__(self, library):
        self.encode, self.calls, outer = library.encode, 0, self

        class Model:
            token_to_id = library.model.token_to_id

            def tokenize(self, match, model=library.model):
                outer.calls += 1
                return model.tokenize(match)

        self.model = Model()


def _odd_texts(n):
    rng = random.Random(8)
    letters = list("aeiou tnsr  \n\t'é🙂日1295.,!#\x1c\x85\xa0　\"$%&()*+<=@[\\^`{~|>]}_-/ÿõ") + [
        "'s", " the", "<|endoftext|>", " naïve", " word", "Word"]
    return ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(n)]


def test_new_pieces_are_asked_many_at_a_time():
    library = Tokenizer.from_file(PATH)
    encoder = tokenfile.LibraryEncoder(PATH, P.PATTERN)
    encoder.tokenizer = counted = _Counted(library)
    texts = [" ".join(f"{a}{b}{c}õ" for a in "klmnop") for b in "aeiouy" for c in "klmnoprstuvw"] + _odd_texts(1500)
    for t, ids in zip(texts, encoder.encode(texts), strict=True):
        assert ids.tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)
    assert 0 < counted.calls < len(encoder.memory.slots) / 20


def test_without_a_letter_between():
    library = Tokenizer.from_file(PATH)
    encoder = tokenfile.LibraryEncoder(PATH, P.PATTERN)
    assert encoder.between is not None
    encoder.between = None
    texts = _odd_texts(200)
    for t, ids in zip(texts, encoder.encode(texts), strict=True):
        assert ids.tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)


@pytest.mark.parametrize("most", [3, 200, 100_000])
def test_memory_is_bounded_by_pieces_and_ids(most, monkeypatch):
    monkeypatch.setattr(tokenfile, "REMEMBERED", most)
    library = Tokenizer.from_file(PATH)
    encoder = tokenfile.LibraryEncoder(PATH, P.PATTERN)
    for k, t in enumerate(_odd_texts(60) + ["日本語" * 40 + str(k) for k in range(60)]):
        ids = encoder.encode([t, "the end"])[0].tolist()
        assert ids == library.encode(t, add_special_tokens=False).ids, repr(t)
        assert len(encoder.memory.slots) == len(encoder.memory.lengths)
        assert len(encoder.memory.flat) <= max(8 * most, 2 * len(ids) + 10)


def test_files(spark, clashing, texts, monkeypatch):
    folder = shared_folder(spark, "test")
    files = tokenfile.write_tokens(clashing, PATH, P.PATTERN, folder)
    got = tokenfile.read_tokens(spark, files).orderBy("start").collect()
    library = Tokenizer.from_file(PATH)
    assert sum(f[3] for f in files) == sum(r.n_tokens for r in got)
    known = {}
    for i, t in texts:
        known.setdefault(i, []).append(library.encode(t, add_special_tokens=False).ids + [0])
    order = [r.doc_id for r in got]
    assert order == sorted(order, key=lambda i: (i is not None, i))
    start = 0
    for r in got:
        assert r.start == start and list(r.ids) in known[r.doc_id] and len(r.ids) == r.n_tokens
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        start += r.n_tokens
    one = tokenfile.TokenFile(files[0][1])
    flat = [x for r in got for x in r.ids][:one.tokens]
    assert [one.token(k) for k in range(0, one.tokens, 101)] == flat[::101]
    assert len(got) == len(texts)


def test_empty_table(spark, docs):
    files = tokenfile.write_tokens(docs.limit(0), PATH, P.PATTERN, shared_folder(spark, "test"))
    assert files == [] and tokenfile.read_tokens(spark, files).count() == 0
