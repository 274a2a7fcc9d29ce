"""Encoding with a public byte-level BPE vocabulary, run by sentencepiece."""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

#: Folder of the vocabulary files; a parameter wherever a vocabulary is read.
FOLDER = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Largest vocabulary file that is sent to the executors.
LARGEST_FILE = 16 << 20
#: Units of text remembered by a worker, and the characters of the longest.
REMEMBERED, LONGEST = 200_000, 40
#: Rows of a batch of results.
BATCH = 512

# fixed value: the pre-token pattern of the vocabulary
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> list[str]:
    """A printable letter for each byte: itself where it is printable Latin-1, else from 256 on."""
    printable = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    other = iter(range(256, 512))
    return [chr(b) if b in set(printable) else chr(next(other)) for b in range(256)]


_LETTERS = byte_letters()
_TO_LETTERS = {b: c for b, c in enumerate(_LETTERS)}
_TO_BYTES = {c: b for b, c in enumerate(_LETTERS)}


def to_letters(data: bytes) -> str:
    return data.decode("latin-1").translate(_TO_LETTERS)


def to_bytes(letters: str) -> bytes:
    return bytes(_TO_BYTES[c] for c in letters)


def ranks(path: str) -> list[bytes]:
    """Tokens by rank from a file of base64 tokens and ranks; refused beyond ``LARGEST_FILE``."""
    with open(path, "rb") as f:
        raw = f.read(LARGEST_FILE + 1)
    if len(raw) > LARGEST_FILE:
        raise ValueError(f"{path} is larger than {LARGEST_FILE} bytes")
    pairs = (line.split() for line in raw.splitlines() if line)
    tokens = {int(rank): base64.b64decode(token) for token, rank in pairs}
    if sorted(tokens) != list(range(len(tokens))):
        raise ValueError(f"{path}: the ranks aren't consecutive from 0")
    return [tokens[i] for i in range(len(tokens))]


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _block(field: int, data: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(data)) + data


def serialised(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model of the tokens, with their ranks as ids.

    Each piece is the token in printable letters and scores its negative rank, so the pair
    of lowest rank is merged first. The unknown piece that the format asks for comes behind
    all others and can't arise, since every byte is a token. Text is taken as it is.
    """
    normal, unknown, bpe, none = 1, 2, 2, -1  # the format's numbers for these
    pieces = b"".join(_block(1, _block(1, to_letters(t).encode()) + _varint(2 << 3 | 5) + struct.pack("<f", -rank) + _number(3, normal)) for rank, t in enumerate(tokens))
    pieces += _block(1, _block(1, b"<unk>") + _varint(2 << 3 | 5) + struct.pack("<f", 0.0) + _number(3, unknown))
    trainer = _number(3, bpe) + _number(4, len(tokens) + 1) + _number(40, len(tokens)) + _number(41, none) + _number(42, none) + _number(43, none)
    normalizer = _block(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return pieces + _block(2, trainer) + _block(3, normalizer)


class Encoder:
    """Ids of texts. Special tokens have no meaning; their strings are ordinary text.

    A text is first cut where a pre-token certainly begins: before a space and a word
    character, and before a line break behind a character that is no white space. Such a unit
    is a pre-token or a few of them; ids of short units and of pre-tokens are remembered, in
    bounded tables that are emptied when full. What isn't remembered goes through the pattern
    and the model.
    """

    _LINE = re.compile(r"(?<!\s)\n")
    _SPACE = re.compile(r" (?=\w)")
    _CLAUSE = re.compile(r"(?<=[。、，！？])(?=\w)")

    def __init__(self, model: bytes, value: Callable[[bytes], object] = lambda ids: ids):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_proto=model)
        self.pattern = regex.compile(PATTERN)
        self.value = value
        self.tokens: dict[str, bytes] = {}
        # units behind nothing, a space and a line break
        self.known: dict[str, dict[str, object]] = {"": {}, " ": {}, "\n": {}}

    def _token(self, token: str) -> bytes:
        ids = np.array(self.model.encode(to_letters(token.encode())), dtype="<i4").tobytes()
        if len(token) <= LONGEST:
            if len(self.tokens) >= REMEMBERED:
                self.tokens.clear()
            self.tokens[token] = ids
        return ids

    def _new(self, before: str, unit: str) -> object:
        tokens = self.tokens
        ids = b"".join([tokens.get(t) or self._token(t) for t in self.pattern.findall(before + unit)])
        value = self.value(ids)
        known = self.known[before]
        if len(unit) <= LONGEST:
            if len(known) >= REMEMBERED:
                known.clear()
            known[unit] = value
        return value

    def units(self, text: str) -> list:
        """The value of each unit of a text, in order; of the ids' bytes unless told otherwise."""
        out: list = []
        before = ""
        spaced = self.known[" "]
        for line in self._LINE.split(text) if "\n" in text else (text,):
            for clause in self._CLAUSE.split(line):
                first, *rest = self._SPACE.split(clause)
                if first or before:
                    value = self.known[before].get(first)
                    out.append(self._new(before, first) if value is None else value)
                for unit in rest:
                    value = spaced.get(unit)
                    out.append(self._new(" ", unit) if value is None else value)
                before = ""
            before = "\n"
        return out

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a text; none for an empty or null one."""
        return np.frombuffer(b"".join(self.units(text)) if text else b"", dtype="<i4")

    def decode(self, ids: list[int]) -> str:
        """The text that the ids stand for."""
        return b"".join(to_bytes(self.model.id_to_piece(int(i))) for i in ids).decode("utf-8", "replace")


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(model: Broadcast, kind: str = "ids", value: Callable[[bytes], object] = lambda ids: ids) -> Encoder:
    """This worker's encoder of a model, made once."""
    key = (model.value[0], kind)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(model.value[1], value)
    return _ENCODERS[key]


def broadcast_model(spark: SparkSession, folder: str = FOLDER, vocabulary: str = VOCABULARY) -> Broadcast:
    """The model, made on the driver from a file of bounded size, for all workers."""
    path = f"{folder}/{vocabulary}"
    return spark.sparkContext.broadcast((path, serialised(ranks(path))))


def encode_corpus(df: DataFrame, key: str = "doc_id", text: str = "text", folder: str = FOLDER, vocabulary: str = VOCABULARY) -> DataFrame:
    """Rows (key, ids) of all rows of ``df``; an empty list for null and empty texts.

    No shuffle: one narrow Arrow stage over the two columns. Repeated rows and null keys
    stay as they are, other columns are ignored, an empty table gives an empty table.
    """
    model = broadcast_model(df.sparkSession, folder, vocabulary)
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = encoder(model).units
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                rows = [b"".join(units(t)) if t else b"" for t in part.column(1).to_pylist()]
                ends = np.cumsum([0, *(len(r) // 4 for r in rows)], dtype=np.int64)
                values = pa.array(np.frombuffer(b"".join(rows), dtype="<i4"), type=pa.int32())
                ids = pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), values)
                yield pa.RecordBatch.from_arrays([part.column(0), ids], names=[key, "ids"])

    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def decode_corpus(df: DataFrame, key: str = "doc_id", ids: str = "ids", folder: str = FOLDER, vocabulary: str = VOCABULARY) -> DataFrame:
    """Rows (key, text) of rows (key, ids): the inverse of ``encode_corpus``.

    Empty and null lists give an empty text, so a null text comes back empty. Ids that the
    vocabulary doesn't have are left out; bytes that are no UTF-8 become the replacement
    character. Rows stay as they are.
    """
    model = broadcast_model(df.sparkSession, folder, vocabulary)
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = encoder(model).model
        size = pieces.get_piece_size() - 1  # without the unknown piece
        tokens = [to_bytes(pieces.id_to_piece(i)) for i in range(size)]
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                texts = [b"".join([tokens[i] for i in row or [] if i is not None and 0 <= i < size]).decode("utf-8", "replace") for row in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, type=pa.string())], names=[key, "text"])

    return df.select(key, ids).mapInArrow(run, f"`{key}` {kind}, text string")
