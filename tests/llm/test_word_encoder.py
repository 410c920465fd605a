"""The word encoder of packing against the tokenizer itself."""

import itertools
import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from spanledger.llm import packing
from spanledger.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(tokenizer_path())


def agree(whole, own, texts):
    for text, ids, encoded in zip(texts, own.encode([t.encode() for t in texts]), whole.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(ids, "<u4").tolist() == encoded.ids, text


def test_every_pair_of_letters_that_are_cut_here(whole):
    letters = [chr(c) for c in (*range(0x21, 0x7F), *range(0xC0, 0x100)) if c not in (0xD7, 0xF7)]
    assert not packing._NOT_PLAIN.search("".join(letters))
    words = ["".join(p) for p in itertools.product(letters, repeat=2)] + [f"ab{c}de" for c in letters]
    agree(whole, packing.WordEncoder(tokenizer_path()), [" ".join(words[i:i + 300]) for i in range(0, len(words), 300)])


def test_other_code_points(whole):
    points = [c for c in range(1, 0x2FFF) if c not in range(0xD800, 0xE000)]
    agree(whole, packing.WordEncoder(tokenizer_path()), [" ".join(f"a{chr(c)}b {chr(c)}" for c in points[i:i + 40]) for i in range(0, len(points), 40)])


def test_supplied_texts(whole):
    texts = [t or "" for t in pq.read_table("/root/testdata/sf0.01/documents.parquet").column("text").to_pylist()]
    agree(whole, packing.WordEncoder(tokenizer_path()), texts)


def test_words_that_are_learned_again(whole):
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["Straße", "don't", "x1y", "<|endoftext|>", "你好", "a", "%%%"]) for _ in range(rng.randint(0, 30))) for _ in range(60)]
    agree(whole, packing.WordEncoder(tokenizer_path(), cached=3), texts)


def test_ids_that_cannot_be_told_apart(whole, monkeypatch):
    """Words go to the whole tokenizer if the merged ids do not show where parts end."""
    own = packing.WordEncoder(tokenizer_path())
    own.ends[:] = False
    agree(whole, own, ["Some words, 3 of them", "Straße"])
