from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tapebook.llm import bpe

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
BOOK = bpe.codec(*bpe.vocabulary())


def expected(text: str) -> list[int]:
    return LIBRARY.encode(text, add_special_tokens=False).ids


AWKWARD = [
    "", " ", "  \n\t  ", "it's we'll I'd 'sx", "a b  c", "é" * 50 + "é" * 20, "日本語のテキスト 123٣٤",
    "x<|endoftext|>y <|endoftext|>", "<|endoftext", "a\x1cb\x1fc\x85d᠎e​f", "👩‍👩‍👧 emoji 🇩🇪", "1234567890" * 30,
    "�\u0000end", "don’t…—!!??  end ", "\r\n\r\n a", "A" * 300,
]


@pytest.mark.parametrize("text", AWKWARD)
def test_codec_equals_the_library(text):
    ids = BOOK.encode(text)
    assert ids == expected(text)
    assert BOOK.decode(np.array(ids, "<u4")) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_every_plane_character_between_letters():
    chars = [chr(c) for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(chars), 4096):
        text = " a".join(chars[i : i + 4096])
        assert BOOK.encode(text) == expected(text)


def rejoined(text: str, leaf: int) -> list[int]:
    runs: list[list[list[int]]] = []
    for piece, glued in BOOK.pieces(text, leaf):
        runs[-1].append(BOOK.encode(piece)) if glued else runs.append([BOOK.encode(piece)])
    return [i for run in runs for i in BOOK.join_all(run)]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="abtheinr äß日 \n'.,9<| ", max_size=200), st.integers(1, 9))
def test_pieces_and_joins_give_the_whole(text, leaf):
    assert "".join(p for p, _ in BOOK.pieces(text, leaf)) == text
    assert rejoined(text, leaf) == expected(text)


def test_long_unsplit_text():
    rng = random.Random(1)
    for alphabet in ("abcdeinorst", "aA", "äöüßab", "0123456789", "=-_*", " "):
        text = "".join(rng.choice(alphabet) for _ in range(4000))
        for leaf in (7, 64, 1000):
            assert rejoined(text, leaf) == expected(text)


SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("ids", T.StringType())]
)


def test_operator(spark):
    rng = random.Random(2)
    words = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(3000))
    texts = [None, *AWKWARD, words, "x" * 2500 + words, words]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(None, "hi there", None), (3, "again", "x")]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = bpe.encode(docs, keep=("doc_id",), with_text=True, long_chars=1000, leaf_chars=300)
    assert got.columns == ["doc_id", "n_tokens", "ids", "decoded"]
    found = sorted((str(r.doc_id), r.decoded, np.frombuffer(bytes(r.ids), "<u4").tolist(), r.n_tokens) for r in got.collect())
    want = sorted((str(i), t or "", expected(t or ""), len(expected(t or ""))) for i, t, _ in rows)
    assert found == want
    again = bpe.decode(got.drop("decoded")).collect()
    assert sorted(r.decoded for r in again) == sorted(t or "" for _, t, _ in rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert bpe.encode(docs).collect() == []
    assert bpe.decode(bpe.encode(docs)).collect() == []
