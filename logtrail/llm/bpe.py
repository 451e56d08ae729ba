"""Byte-level BPE through sentencepiece: encode, decode, digests.

The rank file is turned into a sentencepiece BPE model without training: the
model file is written field by field, one piece per token, each byte mapped to
a printable character, the score the negative rank, and identity normalisation.
Pre-tokens are matched by a pattern and encoded one by one; a pre-token that is
itself a token is that token. Decoding is the inverse mapping of ids to bytes.

Defined cases: a null or empty text has no tokens; every other text, of any
length, is encoded whole. Repeated rows are encoded one by one; other columns
are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from functools import lru_cache

import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from logtrail.llm.common import batches, prepare

# Pre-tokens whose ids a worker remembers; then it starts anew.
REMEMBERED = 300_000
REMEMBERED_LENGTH = 64


def read_ranks(path: str) -> list[bytes]:
    """Tokens in rank order. The ranks have to be 0, 1, 2, ..."""
    with open(path, "rb") as file:
        found = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, file)}
    if sorted(found) != list(range(len(found))):
        raise ValueError("ranks are not consecutive")
    return [found[rank] for rank in range(len(found))]


@lru_cache(maxsize=1)
def byte_characters() -> str:
    """A printable character for each byte: itself where it is one in Latin-1, else one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return "".join(chr(byte) if byte in shown else chr(next(rest)) for byte in range(256))


def mapped(token: bytes) -> str:
    return token.decode("latin-1").translate(dict(enumerate(byte_characters())))


def _varint(value: int) -> bytes:
    out = bytearray()
    value &= (1 << 64) - 1
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    return bytes([*out, value])


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _block(field: int, content: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(content)) + content


def model_proto(tokens: list[bytes]) -> bytes:
    """A sentencepiece model file: pieces in rank order, then the unknown piece."""
    unknown_name = "⁇unknown"
    pieces = bytearray()
    for rank, token in enumerate(tokens):
        piece = _block(1, mapped(token).encode()) + _varint(2 << 3 | 5) + struct.pack("<f", -float(rank)) + _number(3, 1)
        pieces += _block(1, piece)
    pieces += _block(1, _block(1, unknown_name.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", 0.0) + _number(3, 2))
    trainer = (
        _number(3, 2)  # model type: BPE
        + _number(4, len(tokens) + 1)  # number of pieces
        + _number(24, 0)  # white space is no suffix
        + _number(40, len(tokens))  # id of the unknown piece
        + b"".join(_number(field, -1) for field in (41, 42, 43))  # no begin, end, padding
        + _block(45, unknown_name.encode())
    )
    identity = _block(1, b"identity") + b"".join(_number(field, 0) for field in (3, 4, 5))
    return bytes(pieces) + _block(2, trainer) + _block(3, identity)


class Codec:
    """Encoder and decoder of one process, made from the tokens and the pre-token pattern."""

    def __init__(self, tokens: list[bytes], model: bytes, pattern: str):
        self.tokens = tokens
        self.ids = {token: rank for rank, token in enumerate(tokens)}
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.find = regex.compile(pattern).findall
        self.table = dict(enumerate(byte_characters()))
        self.memory: dict[str, bytes] = {}

    def _encode_new(self, pretokens: list[str], into: dict[str, bytes]) -> None:
        rest = []
        for pretoken in pretokens:
            rank = self.ids.get(pretoken.encode())
            if rank is None:
                rest.append(pretoken)
            else:
                into[pretoken] = struct.pack("<I", rank)
        shown = [pretoken.encode().decode("latin-1").translate(self.table) for pretoken in rest]
        for pretoken, ids in zip(rest, self.pieces.encode(shown, num_threads=1)):
            into[pretoken] = struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        pretokens = self.find(text)
        memory = self.memory
        try:
            return b"".join(map(memory.__getitem__, pretokens))
        except KeyError:
            new = [pretoken for pretoken in set(pretokens) if pretoken not in memory]
        if len(memory) + len(new) > REMEMBERED:
            memory.clear()
            new = list(set(pretokens))
        own: dict[str, bytes] = {}
        self._encode_new(new, own)
        ids = b"".join([own[p] if p in own else memory[p] for p in pretokens])
        memory.update((p, packed) for p, packed in own.items() if len(p) <= REMEMBERED_LENGTH)
        return ids

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, memoryview(ids).cast("I")))


class SharedCodec:
    """What the driver broadcasts; each worker builds one Codec from it."""

    def __init__(self, path: str, pattern: str):
        self.tokens = read_ranks(path)
        self.model = model_proto(self.tokens)
        self.pattern = pattern
        self.name = hashlib.sha256(self.model + pattern.encode()).hexdigest()


_CODECS: dict[str, Codec] = {}


def codec(shared: SharedCodec) -> Codec:
    if shared.name not in _CODECS:
        _CODECS.clear()
        _CODECS[shared.name] = Codec(shared.tokens, shared.model, shared.pattern)
    return _CODECS[shared.name]


def encode_documents(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, ids (packed), decoded (bytes) of each row."""
    shared = prepare(docs.sparkSession).sparkContext.broadcast(SharedCodec(path, pattern))

    def encode(source):
        own = codec(shared.value)
        for batch in batches(source):
            ids = [own.encode(value or "") for value in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(ids, pa.binary()), pa.array(map(own.decode, ids), pa.binary())],
                ["key", "ids", "decoded"],
            )

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(encode, f"key {kind}, ids binary, decoded binary").withColumnRenamed("key", key)


def digests(encoded: DataFrame, key: str = "doc_id") -> DataFrame:
    return encoded.select(
        key,
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_byte_bpe(documents: DataFrame) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return digests(encode_documents(documents, path, public_tokenizers.PATTERN))
