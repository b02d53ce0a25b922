from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
from test_bytebpe import _ids, _texts
from tokenizers import Tokenizer

from clickloom.llm.bytebpe import ByteBpe
from clickloom.llm.packing import END_ID, pack_documents

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXT = "one <|endoftext|> two"


def test_ids_equal_those_of_the_library_in_its_default_state():
    bpe, library = ByteBpe(PATH, added=True), Tokenizer.from_file(PATH)
    for text in [TEXT, "<|endoftext|>", "<|endoftext|" + TEXT, *_texts(3000)]:
        ids = bpe.encode(text)
        assert _ids(ids) == library.encode(text, add_special_tokens=False).ids
        assert bpe.decode(ids) == text.encode()


def test_packed_pieces_hold_the_added_token(spark):
    ids = [*Tokenizer.from_file(PATH).encode(TEXT, add_special_tokens=False).ids, END_ID]
    row = pack_documents(spark.createDataFrame([(1, TEXT)], "doc_id long, text string")).first()
    assert (row.length, row.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
