"""Byte-level BPE against the tiktoken library."""

import hashlib
import random

import numpy as np
import pytest

from grimlake.llm import byte_tokens as B
from tests.llm import odd

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def tokens():
    with open(PATH, "rb") as f:
        return B.read_ranks(f.read())


@pytest.fixture(scope="module")
def enc(tokens):
    return B.Encoder(tokens, B.parents(tokens), P.PATTERN)


@pytest.fixture(scope="module")
def library(tokens):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})


def text(r, tokens):
    k = r.random()
    if k < 0.3:
        return "".join(chr(r.choice([r.randrange(0, 127), r.randrange(0xa0, 0x600), r.randrange(0x3000, 0xd000),
                                     r.randrange(0x10000, 0x20000), r.randrange(9, 14)])) for _ in range(r.randint(0, 60)))
    if k < 0.6:
        return "".join(r.choice("ab c'stelre\n 12") for _ in range(r.randint(0, 80)))
    if k < 0.7:
        return r.choice("aä 字=-#") * r.randint(1, 500)
    return "".join(tokens[r.randrange(len(tokens))].decode("utf-8", "ignore") for _ in range(r.randint(0, 20)))


def test_equal_to_the_library(tokens, enc, library):
    r = random.Random(4)
    texts = [text(r, tokens) for _ in range(4000)] + ["", "<|endoftext|>", "a" * 30000, "字" * 5000]
    ids, sizes = enc.encode(texts)
    cut = np.split(ids, np.cumsum(sizes)[:-1])
    assert all(a.tolist() == library.encode_ordinary(t) for a, t in zip(cut, texts))
    data, ends = enc.decode(ids, sizes)
    assert data.tobytes() == "".join(texts).encode() and ends[-1] == len(data)


def test_unicode_classes_are_the_librarys():
    """Over all characters, assigned in whichever version."""
    single = [bytes([b]) for b in range(256)]
    for name in (r"\p{L}+", r"\p{N}", r"\s", r"\S", r"[^\s\p{L}\p{N}]+"):
        mine = B.Encoder(single, B.parents(single), name)
        theirs = tiktoken.Encoding("l", pat_str=name, mergeable_ranks={t: i for i, t in enumerate(single)}, special_tokens={})
        every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        assert mine.encode([every])[0].tolist() == theirs.encode_ordinary(every)


def test_every_prefix_has_the_encoding_of_its_bytes(tokens, enc):
    """The table against merging by rank, prefix by prefix."""
    rank = enc.vocabulary.rank

    def merged(data):
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            least, at = min((rank.get(parts[i] + parts[i + 1], B.NEVER), i) for i in range(len(parts) - 1))
            if least == B.NEVER:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [rank[p] for p in parts]

    r = random.Random(2)
    for _ in range(60):
        data = text(r, tokens).encode()[:60]
        table = B.Prefixes(enc.vocabulary, data)
        for n in range(1, len(data) + 1):
            assert table.last[n - 1] == merged(data[:n])[-1]
        assert table.ids() == (merged(data) if data else [])


def test_appends_and_edits_equal_a_new_table(tokens, enc):
    r = random.Random(3)
    for _ in range(400):
        data, new = text(r, tokens).encode(), text(r, tokens).encode()[:20]
        a = r.randint(0, len(data))
        b = r.randint(a, min(len(data), a + 10))
        table = B.Prefixes(enc.vocabulary, data)
        table.replace(a, b, new)
        whole = data[:a] + new + data[b:]
        assert table.data == whole and table.last == B.Prefixes(enc.vocabulary, whole).last
        table.append(b"tail" + new)
        assert table.last == B.Prefixes(enc.vocabulary, whole + b"tail" + new).last
    table = B.Prefixes(enc.vocabulary, b"word" * 5000)
    assert table.replace(5000, 5001, b"Q") < 200  # near the edit only


def test_documents(spark, library):
    rows = odd.texts() + [(9007199254740993, "big id", "a")]
    out = B.encode_documents(odd.frame(spark, rows), "file://" + PATH, P.PATTERN)
    got = sorted(map(tuple, B.digests(out).collect()), key=str)
    want = []
    for i, t, _ in rows:
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert {bytes(r["decoded"]).decode() for r in out.collect()} == {t or "" for _, t, _ in rows}
    assert B.digests(B.encode_documents(odd.empty(spark), "file://" + PATH, P.PATTERN)).count() == 0


def test_vocabularies_without_merges_are_an_error():
    single = [bytes([b]) for b in range(256)]
    with pytest.raises(ValueError):
        B.parents([*single, b"abc"])
