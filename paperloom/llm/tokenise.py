"""Token ids of a public byte-level BPE vocabulary, through sentencepiece.

The vocabulary (a file of ranks) is serialised directly as a sentencepiece BPE
model: every token becomes a piece of byte-mapped characters, scored by its
negative rank, so that the best-scored merge is the merge of lowest rank; the
normaliser is the identity. A text is cut into pre-tokens by the vocabulary's
pattern, each pre-token is byte-mapped and encoded; piece ids equal ranks.
Decoding is the inverse mapping. No tokenizer is trained.
"""

from __future__ import annotations

import base64
import os
import struct
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_VOCABULARY = os.path.join(os.environ.get("PAPERLOOM_TOKENIZERS", "/opt/tokenizers"), "byte_bpe_50k.tiktoken")
#: Fixed value: the pre-token pattern published with the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pre-tokens kept with their ids in each Python worker.
CACHE = 1 << 18


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where it is printable in
    Latin-1 and no space, else one from U+0100 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = [""] * 256
    for b in shown:
        out[b] = chr(b)
    hidden = [b for b in range(256) if not out[b]]
    for i, b in enumerate(hidden):
        out[b] = chr(0x100 + i)
    return out


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes(out) + bytes([n])


def _block(number: int, body: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(body)) + body


def _number(number: int, value: int) -> bytes:
    return _varint(number << 3) + _varint(value)


def read_ranks(path: str) -> list[bytes]:
    """Tokens in order of rank; ranks must be 0, 1, 2, ..."""
    ranks = [line.split() for line in Path(path).read_bytes().splitlines() if line]
    tokens = [base64.b64decode(t) for t, _ in sorted(ranks, key=lambda x: int(x[1]))]
    if [int(r) for _, r in sorted(ranks, key=lambda x: int(x[1]))] != list(range(len(tokens))):
        raise ValueError("ranks have gaps")
    return tokens


def serialise_model(tokens: list[bytes]) -> bytes:
    """A sentencepiece ModelProto of the tokens, written field by field."""
    chars = byte_characters()
    pieces = bytearray()
    for rank, token in enumerate(tokens):
        piece = "".join(chars[b] for b in token).encode()
        pieces += _block(1, _block(1, piece) + _varint(2 << 3 | 5) + struct.pack("<f", -float(rank)) + _number(3, 1))
    unknown = _block(1, _block(1, b"<unk>") + _varint(2 << 3 | 5) + struct.pack("<f", 0.0) + _number(3, 2))
    trainer = _block(2, _number(3, 2) + _number(4, len(tokens) + 1) + _number(40, len(tokens)))
    normaliser = _block(3, _block(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0))
    return bytes(pieces) + unknown + trainer + normaliser


class Encoder:
    """Encodes and decodes with a serialised model."""

    def __init__(self, model: bytes, pattern: str = PATTERN):
        import regex
        import sentencepiece

        self._sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self._cut = regex.compile(pattern).findall
        self._map = {b: c for b, c in enumerate(byte_characters())}
        self._latin = str.maketrans({chr(b): c for b, c in self._map.items()})
        self._back = {c: b for b, c in self._map.items()}
        self._known: dict[str, list[int]] = {}

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        known, out = self._known, []
        for w in self._cut(text):
            ids = known.get(w)
            if ids is None:
                ids = self._sp.encode(w.encode().decode("latin-1").translate(self._latin))
                if len(w) <= 64:
                    if len(known) >= CACHE:
                        known.clear()
                    known[w] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        text = "".join(self._sp.id_to_piece(list(ids))) if len(ids) else ""
        return bytes(self._back[c] for c in text).decode()


def encode_texts(df: DataFrame, key: str, text: str, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """(key, ids) for each row; null and empty texts give an empty list.

    The model is serialised once on the driver (its size is that of the
    vocabulary) and goes to the workers with the function. Narrow, no shuffle.
    Ids of special tokens never occur: their strings are ordinary text.
    """
    model = serialise_model(read_ranks(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model)
        for whole in batches:
            for lo in range(0, whole.num_rows, 1000):
                batch = whole.slice(lo, 1000)
                ids = [encoder.encode(t) for t in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=[key, "ids"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key), F.col(text)).mapInArrow(run, f"`{key}` {kind}, ids array<int>")
