"""Byte-level BPE against the public library, and on odd rows."""

import hashlib
import random
import unicodedata

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from spanledger.llm import bpe
from spanledger.llm.queries import op12_byte_bpe
from spanledger.llm.shipping import ship

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
DOCS = "doc_id long, text string, ids string, decoded string, n_tokens int"


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(PATH)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return bpe.BytePairEncoder(PATH, public_tokenizers.PATTERN)


def ids(encoder, text):
    return np.frombuffer(encoder.encode([text])[0], np.int32).tolist()


def test_hash_is_minimal_and_perfect(encoder, ranks):
    numbers = encoder.lookup.numbers(encoder._hashes(list(ranks)))
    assert sorted(numbers.tolist()) == list(range(len(ranks)))
    assert [encoder.tokens[n] for n in numbers.tolist()] == list(ranks)
    with pytest.raises(ValueError):
        bpe.PerfectHash(np.array([5, 5], np.uint64))
    empty = bpe.PerfectHash(np.array([], np.uint64))
    assert empty.numbers(np.array([1], np.uint64)).tolist() == [-1]


def test_every_token_and_code_point(encoder, library, ranks):
    whole = [t.decode() for t in ranks if t.isascii()]
    for text in ("".join(whole), " ".join(whole)):
        assert ids(encoder, text) == library.encode_ordinary(text)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3000 or unicodedata.category(chr(c)) != "Cn")]
    for k in range(0, len(points), 512):
        text = "".join(f"a{chr(c)}{chr(c)}b {chr(c)} 1{chr(c)}!{chr(c)}  " for c in points[k:k + 512])
        assert ids(encoder, text) == library.encode_ordinary(text), hex(points[k])


def test_random_pieces(encoder, library):
    rng = random.Random(2)
    for n in [*range(1, 40), 300, 999, 1000, 1001, 20_000]:
        for letters in ("ab", "aeinrst", "aé漢🙂", " \t\n x", "'sdlvertm1,.!", "<|endoftext|>"):
            text = "".join(rng.choice(letters) for _ in range(n))
            assert ids(encoder, text) == library.encode_ordinary(text)


def test_plain_merge_of_the_lowest_rank(ranks):
    """The heap gives what repeated search for the lowest, leftmost pair gives."""
    rng = random.Random(6)
    for _ in range(300):
        piece = "".join(rng.choice("aabcdeéß'") for _ in range(rng.randint(1, 25))).encode()
        parts = [bytes([b]) for b in piece]
        while True:
            pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
            if not pairs:
                break
            i = min(pairs)[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        assert bpe.merge(piece, ranks) == [ranks[p] for p in parts]


def test_forgotten_pieces_are_learned_again(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_BYTES", 2000)
    monkeypatch.setattr(bpe, "PART_PIECES", 7)
    monkeypatch.setattr(bpe, "LONG_TEXT", 30)
    encoder, rng = bpe.BytePairEncoder(PATH, public_tokenizers.PATTERN), random.Random(3)
    texts = [" ".join(rng.choice(["thenining", "quegaes", "x" * 300, "of", "1234"]) for _ in range(rng.randint(0, 60))) for _ in range(40)]
    assert [np.frombuffer(e, np.int32).tolist() for e in encoder.encode(texts)] == [library.encode_ordinary(t) for t in texts]


def test_vocabulary_without_a_byte(tmp_path):
    lines = [line for line in open(PATH, "rb") if not line.endswith(b" 5\n")]
    (tmp_path / "ranks").write_bytes(b"".join(lines))
    with pytest.raises(ValueError, match="lacks the bytes"):
        bpe.BytePairEncoder(str(tmp_path / "ranks"), public_tokenizers.PATTERN)


def test_rows(spark, library):
    """Null, empty and long texts, null ids, repeated rows, clashing columns: what comes out is what went in."""
    ship(spark)
    long = "réunion of 12345 words\n\n" * 60_000  # over a million code points
    texts = [(None, "no id"), (1, None), (2, ""), (3, "Hello  world"), (3, "Hello  world"), (4, long), (5, "w" * 30_000), (6, "\x00\x1c\x85﻿")]
    docs = spark.createDataFrame([(*t, "i", "d", 0) for t in texts], DOCS).repartition(2)
    rows = bpe.decode_ids(bpe.encode_texts(docs, PATH, public_tokenizers.PATTERN), PATH).collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(((r["doc_id"], bytes(r["decoded"]).decode()) for r in rows), key=key) == sorted(((i, t or "") for i, t in texts), key=key)
    for r in rows:
        assert r["ids"] == library.encode_ordinary(bytes(r["decoded"]).decode())


def test_no_rows_and_foreign_ids(spark):
    ship(spark)
    assert bpe.decode_ids(bpe.encode_texts(spark.createDataFrame([], DOCS), PATH, public_tokenizers.PATTERN), PATH).count() == 0
    odd = spark.createDataFrame([(1, None), (2, []), (3, [200])], "doc_id long, ids array<int>")
    assert [r["decoded"] for r in bpe.decode_ids(odd, PATH).orderBy("doc_id").collect()][:2] == [None, b""]


def test_query(spark, library):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = {r["doc_id"]: tuple(r)[1:] for r in op12_byte_bpe(spark, sf_dir).collect()}
    digest = lambda data: hashlib.sha256(data).hexdigest()
    expected = {}
    for i, t in texts.items():
        e = library.encode_ordinary(t)
        expected[i] = (len(e), digest(",".join(map(str, e)).encode()), digest(t.encode()))
    assert found == expected
