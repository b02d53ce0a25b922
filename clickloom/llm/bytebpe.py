"""Byte-level BPE with the tokenizers library over Arrow batches.

The library works on characters, so every byte has one: printable bytes stand for themselves
and the others for characters from 256 on. Text is split by the vocabulary's pattern, each
piece is mapped to such characters and merged by the library's BPE model. Decoding looks up
the characters of each id and reverses the byte table; as a character may be split between
tokens, bytes are only decoded once they are all joined.

Natural text repeats its pieces, so ids of pieces are kept in tables of bounded size; the
ids are the same without them.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterable
from functools import cache, lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.models import BPE

from clickloom.llm.common import HELD_TABLES, fresh, full_text, put, settle, small_batches

PIECES_HELD = 400_000

# Fixed rule of byte-level BPE: bytes shown as themselves; the rest follow from 256 on.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]


@cache
def byte_chars() -> str:
    """The character of each byte, by byte."""
    rest = iter(range(256, 512))
    return "".join(chr(b) if b in _SHOWN else chr(next(rest)) for b in range(256))


def merges_of_ranks(ranks: dict[bytes, int]) -> list[tuple[str, str]]:
    """The merges a rank file stands for: every split of a token into two known tokens.

    A token of a lower rank is made first. Single bytes are known from the start.
    """
    chars = byte_chars()
    merges = []
    for token, _ in sorted(ranks.items(), key=lambda item: item[1]):
        splits = [(token[:i], token[i:]) for i in range(1, len(token))]
        known = [(a, b) for a, b in splits if a in ranks and b in ranks]
        known.sort(key=lambda pair: (ranks[pair[0]], ranks[pair[1]]))
        merges += [
            tuple("".join(chars[byte] for byte in half) for half in pair) for pair in known
        ]
    return merges


class ByteBpe:
    """Encoding and decoding by one vocabulary file.

    ``.tiktoken`` files hold ranks, ``.json`` files a tokenizer of the library, which must
    split by ``public_tokenizers.PATTERN`` as byte-level tokenizers do. With ``added`` the
    text of one of the file's added tokens is that token, as in the library; without, it is
    ordinary text.
    """

    def __init__(self, path: str, held: int = PIECES_HELD, added: bool = False) -> None:
        chars = byte_chars()
        self._table = {b: chars[b] for b in range(256)}
        if path.endswith(".tiktoken"):
            with open(path, "rb") as file:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
            vocab = {"".join(chars[b] for b in t): i for t, i in ranks.items()}
            self._model = BPE(vocab=vocab, merges=merges_of_ranks(ranks))
        else:
            tokenizer = Tokenizer.from_file(path)
            vocab, self._model = tokenizer.get_vocab(with_added_tokens=False), tokenizer.model
        self._added: list[str] = []
        special: dict[int, str] = {}
        if added and not path.endswith(".tiktoken"):
            self._library = tokenizer
            special = {i: t.content for i, t in tokenizer.get_added_tokens_decoder().items()}
            self._added = list(special.values())
        back = {c: b for b, c in enumerate(chars)}
        self._bytes = [b""] * (max(*vocab.values(), *special) + 1)
        for token, i in vocab.items():
            self._bytes[i] = bytes(back[c] for c in token if c in back)
        for i, content in special.items():
            self._bytes[i] = content.encode()
        self._packed = [i.to_bytes(4, "little") for i in range(len(self._bytes))]
        self._split = regex.compile(public_tokenizers.PATTERN)
        self._held = held
        self._words: dict[str, bytes] = {}
        self._pieces: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        ids = self._words.get(word)
        if ids is None:
            shown = word.encode().decode("latin-1").translate(self._table)
            ids = b"".join([self._packed[t.id] for t in self._model.tokenize(shown)])
            if len(self._words) < self._held:
                self._words[word] = ids
        return ids

    def _run(self, text: str) -> bytes:
        return b"".join([self._word(w) for w in self._split.findall(text)])

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit numbers.

        A single space between two other characters that are no white space always begins
        a piece of the pattern, so a text may be cut there and its parts be looked up whole.
        A text that holds an added token goes through the library.
        """
        if any(token in text for token in self._added):
            ids = self._library.encode(text, add_special_tokens=False).ids
            return b"".join([self._packed[i] for i in ids])
        first, *parts = text.split(" ")
        if not first or first != first.strip():
            return self._run(text)
        found = list(map(self._pieces.get, parts))
        if None in found:
            for i, part in enumerate(parts):
                if found[i] is None:
                    if not part or part != part.strip():
                        return self._run(text)
                    ids = found[i] = self._run(" " + part)
                    if len(self._pieces) < self._held:
                        self._pieces[part] = ids
        return self._run(first) + b"".join(found)

    def decode(self, ids: bytes) -> bytes:
        """The bytes that little-endian 32-bit ids stand for."""
        return b"".join(map(self._bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def offsets(self, ids: bytes) -> tuple[np.ndarray, np.ndarray]:
        """First and end code point of each token; a split character belongs to all its tokens."""
        tokens = [self._bytes[i] for i in np.frombuffer(ids, "<u4").tolist()]
        ends = np.cumsum([len(t) for t in tokens], dtype=np.int64)
        data = np.frombuffer(b"".join(tokens), np.uint8)
        # number of characters that have begun before and with each byte
        begun = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        first = begun[starts + 1] - 1 if len(tokens) else starts[:0]
        return first, begun[ends] if len(tokens) else first


@lru_cache(maxsize=1)
def byte_bpe(path: str, added: bool = False) -> ByteBpe:
    """The instance of a worker, with its tables; another vocabulary replaces it."""
    return ByteBpe(path, added=added)


HELD_TABLES.append(byte_bpe.cache_clear)


def decoded_text(data: bytes) -> str:
    """Text of decoded bytes; a character cut off by a cut id list is replaced."""
    return data.decode("utf-8", errors="replace")


def _mapped(docs: DataFrame, text: str, schema: str, rows: Callable[[Iterable[str]], pd.DataFrame]):
    @F.pandas_udf(schema)
    def encode(texts: pd.Series) -> pd.DataFrame:
        return rows(texts)

    return encode(full_text(text))


def encode_texts(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Every row of ``docs`` with ``ids``, ``starts`` and ``ends`` of its tokens.

    ``starts`` and ``ends`` are code points. A null text is an empty one and has empty
    arrays. No special token is added, and the text of one is ordinary text. Rows that
    repeat each other each get their ids. Columns named like a result are replaced.
    """
    (done,) = fresh(docs, "done")

    def rows(texts: Iterable[str]) -> pd.DataFrame:
        bpe, out = byte_bpe(path), []
        for value in texts:
            ids = bpe.encode(value)
            out.append((np.frombuffer(ids, "<u4").astype(np.int32), *bpe.offsets(ids)))
        return pd.DataFrame(out, columns=["ids", "starts", "ends"])

    schema = "ids array<int>, starts array<bigint>, ends array<bigint>"
    found = small_batches(docs).withColumn(done, _mapped(docs, text, schema, rows))
    return put(found, {n: found[done][n] for n in ("ids", "starts", "ends")}).drop(done)


def decode_ids(tokens: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """Every row of ``tokens`` with ``decoded``, the bytes of its ids; null ids give none."""

    @F.pandas_udf("binary")
    def decode(lists: pd.Series) -> pd.Series:
        bpe = byte_bpe(path)
        return pd.Series([bpe.decode(np.asarray(x, "<u4").tobytes()) for x in lists])

    return put(small_batches(tokens), {"decoded": decode(F.coalesce(ids, F.array().cast("array<int>")))})


def round_trips(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Every row of ``docs`` with ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``.

    Encodes and decodes in one pass and keeps digests only, as a check of a corpus:
    ``ids_sha256`` is over the decimal ids joined by commas, ``decoded_sha256`` over the
    decoded bytes, and equals the text's own digest. Nulls count as empty texts.
    """
    (done,) = fresh(docs, "done")

    def rows(texts: Iterable[str]) -> pd.DataFrame:
        bpe, out = byte_bpe(path), []
        for value in texts:
            ids = bpe.encode(value)
            numbers = ",".join(map(str, np.frombuffer(ids, "<u4").tolist()))
            out.append(
                (
                    len(ids) // 4,
                    hashlib.sha256(numbers.encode()).hexdigest(),
                    hashlib.sha256(bpe.decode(ids)).hexdigest(),
                )
            )
        settle()
        return pd.DataFrame(out, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    found = small_batches(docs).withColumn(done, _mapped(docs, text, schema, rows))
    names = ("n_tokens", "ids_sha256", "decoded_sha256")
    return put(found, {n: found[done][n] for n in names}).drop(done)
