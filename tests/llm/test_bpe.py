import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from loanmill.llm import bpe

NAME = "byte_bpe_multi_50k.tiktoken"


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path(NAME))


@pytest.fixture(scope="module")
def library(ranks):
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}
    )


def test_same_ids_as_the_library(ranks, library):
    rng = random.Random(3)
    letters = "abcdetion '\n\t1 9é漢字😀-%\x1c\x85"
    texts = ["", " ", "it's we'LL 'tis", "x" * 5000, "ab" * 3000, "é" * 700]
    texts += ["".join(rng.choices(letters, k=rng.randint(0, 400))) for _ in range(500)]
    texts += ["".join(rng.choices("abcdefgh", k=n)) for n in (3, 900, 1025, 4000)]
    want = [np.array(library.encode_ordinary(t), "<u4").tobytes() for t in texts]
    assert bpe.Encoder(ranks, public_tokenizers.PATTERN).encode_all(texts) == want


def test_long_text_in_several_groups(ranks, library, monkeypatch):
    monkeypatch.setattr(bpe, "PIECES", 50)
    monkeypatch.setattr(bpe, "REMEMBERED", 60)
    text = " ".join(f"word{i} and" for i in range(2000))
    encoder = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    want = np.array(library.encode_ordinary(text), "<u4").tobytes()
    assert encoder.encode_all(["a b", text, "", text]) [1::2] == [want, want]


def check(documents, rows, ranks, library):
    got = {}
    for r in bpe.digests(documents, ranks, public_tokenizers.PATTERN).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, got.values())) == len(rows)
    for doc_id, text in rows:
        ids = library.encode_ordinary(text or "")
        for r in got[doc_id]:
            assert r.n_tokens == len(ids)
            assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
            assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_edge_rows(edge_documents, edge_rows, ranks, library):
    check(edge_documents, edge_rows, ranks, library)


def test_given_documents(some_documents, ranks, library):
    rows = [(r.doc_id, r.text) for r in some_documents.collect()]
    check(some_documents, rows, ranks, library)


def test_other_columns_stay_and_clashing_ones_are_replaced(edge_documents, ranks):
    out = bpe.encode(edge_documents, ranks, public_tokenizers.PATTERN)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "hits", "ids", "n_tokens"]
    row = bpe.unpacked(bpe.decode(out, ranks)).filter("doc_id = 44").first()
    assert bytes(row.decoded) == b"one" and row.lang == "en" and len(row.token_ids) == row.n_tokens


def test_round_trip_in_one_worker(edge_documents, edge_rows, ranks, library):
    out = bpe.round_trip(edge_documents, ranks, public_tokenizers.PATTERN)
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "hits", "ids", "n_tokens", "round_trip"]
    got = sorted((r.doc_id or 0, bytes(r.ids), r.n_tokens, r.round_trip) for r in out.collect())
    ids = [(i or 0, library.encode_ordinary(t or "")) for i, t in edge_rows]
    assert got == sorted((i, np.array(x, "<u4").tobytes(), len(x), True) for i, x in ids)
    assert bpe.round_trip(edge_documents.limit(0), ranks, public_tokenizers.PATTERN).count() == 0


def test_no_rows(no_documents, ranks):
    assert bpe.digests(no_documents, ranks, public_tokenizers.PATTERN).count() == 0
