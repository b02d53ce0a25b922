from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from clickloom.llm.bytebpe import ByteBpe, byte_bpe, decode_ids, decoded_text, encode_texts
from clickloom.llm.common import settle
from clickloom.llm.queries import QUERIES

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PARTS = [
    *[" ", " ", "  ", "\n", "\t", "\r\n", "a", "B", "é", "ß", "日", "本", "🙂", "👩‍💻", "\xa0"],
    *["\x1c", "\x85", "'s", "'ll", "don't", "123", "½", "²", "٣", "...", "!?", "<|endoftext|>"],
    *["\x00", "ﬁ", "é", "xxxxx", "ab cd", "_", "-"],
]


@pytest.fixture(scope="module")
def plain():
    with open(MULTI, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def _texts(n):
    rng = random.Random(7)
    return ["".join(rng.choices(PARTS, k=rng.randrange(14))) for _ in range(n)]


def _ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


def test_ids_of_ranks_equal_those_of_tiktoken(plain):
    bpe = ByteBpe(MULTI, held=50)
    for text in _texts(5000):
        assert _ids(bpe.encode(text)) == plain.encode_ordinary(text)
        assert bpe.decode(bpe.encode(text)) == text.encode()


def test_ids_of_json_equal_those_of_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    bpe, library = ByteBpe(path), Tokenizer.from_file(path)
    library.encode_special_tokens = True
    for text in _texts(3000):
        assert _ids(bpe.encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_offsets_of_split_characters():
    bpe = ByteBpe(MULTI)
    text = "a🙂b日"
    starts, ends = bpe.offsets(bpe.encode(text))
    assert starts.tolist() == [0, 1, 1, 1, 2, 3] and ends.tolist() == [1, 2, 2, 2, 3, 4]
    half = bpe.encode(text)[:8]
    assert decoded_text(bpe.decode(half)) == "a�"


def test_offsets_cut_the_text_as_the_library_does(plain):
    bpe = ByteBpe(MULTI)
    for text in _texts(300):
        ids = bpe.encode(text)
        starts, ends = bpe.offsets(ids)
        for i, a, b in zip(_ids(ids), starts, ends):
            token = plain.decode_single_token_bytes(i)
            assert token in text[a:b].encode()


def test_whole_query_against_tiktoken(spark, plain):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    want = set()
    for r in docs:
        ids = plain.encode_ordinary(r.text or "")
        want.add(
            (
                r.doc_id,
                len(ids),
                hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256(plain.decode_bytes(ids)).hexdigest(),
            )
        )
    got = QUERIES["op7_byte_bpe"](spark, folder)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert {tuple(r) for r in got.collect()} == want


def test_encode_and_decode_columns(spark):
    docs = spark.createDataFrame(
        [(1, None, "x"), (1, "", "y"), (2, "Füße 🙂 " * 2000, "z")],
        "doc_id long, text string, ids string",
    )
    tokens = encode_texts(docs, MULTI)
    assert tokens.columns == ["doc_id", "text", "ids", "starts", "ends"]
    rows = decode_ids(tokens, MULTI).collect()
    assert all(bytes(r.decoded).decode() == (r.text or "") for r in rows)
    assert all(len(r.ids) == len(r.starts) == len(r.ends) for r in rows)
    nothing = spark.createDataFrame([(None,)], "ids array<int>")
    assert bytes(decode_ids(nothing, MULTI).first().decoded) == b""
    assert encode_texts(docs.limit(0), MULTI).count() == 0


def test_tables_go_when_another_operator_needs_the_worker():
    first = byte_bpe(MULTI)
    settle()
    assert byte_bpe(MULTI) is first
    settle(drop_tables=True)
    assert byte_bpe(MULTI) is not first
