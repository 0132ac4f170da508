"""Packing by power-of-two decomposition: every document is cut into pieces whose lengths are powers of two.

A document of n tokens (its ids and a closing id) gives n // 1024 pieces of 1,024 and one piece for each bit set in the rest, longest first.
A piece is a sequence of its own, in the bucket of its length; no sequence crosses documents and none
needs padding. One pass over the texts, no shuffle.

A text is encoded in one call whose ids come back as the bytes that are written, never as numbers of Python's. The ids equal those of
the tokenizers library with byte_bpe_50k.json (the ranks file holds the same vocabulary), added tokens such as
<|endoftext|> included: a text is cut at them, and each is its one id.

Defined results: a null or empty text is the closing id alone; rows with equal ids are separate documents; sequence numbers are unique and,
as they follow the input files, equal in every run over the same files.
"""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import spans

LENGTH = 1024


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def added_tokens() -> str:
    """The file that names the tokens added to the vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    def __init__(self, path: str, added: str | None = None):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.ranks = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.added: dict[str, int] = {}
        if added:
            with open(added, encoding="utf-8") as lines:
                self.added = {t["content"]: int(t["id"]) for t in json.load(lines)["added_tokens"]}
        self.cut = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")")

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), "<u4").tolist()

    def packed(self, text: str) -> bytes:
        """The ids as little-endian 32-bit numbers."""
        if not any(t in text for t in self.added):
            return self.ordinary(text)
        return b"".join(_packed(self.added[part]) if part in self.added else self.ordinary(part) for part in self.cut.split(text))

    def ordinary(self, text: str) -> bytes:
        return self.ranks.encode_to_numpy(text).astype("<u4", copy=False).tobytes()


def _packed(token: int) -> bytes:
    return token.to_bytes(4, "little")


_encoders: dict[tuple[str, str | None], Encoder] = {}


def piece_lengths(n: int, length: int = LENGTH) -> list[int]:
    rest = n % length
    return [length] * (n // length) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, length: int = LENGTH, closing: int = 0, path: str | None = None, id_column: str = "doc_id", text_column: str = "text", added: str | None = None) -> DataFrame:
    """Per piece: doc_id, start, length, tokens (little-endian 32-bit ids), doc_tokens, sequence_id, offset, bucket (log2 of the length)."""
    if length < 1 or length & (length - 1):
        raise ValueError("the sequence length must be a power of two")
    if path is None:
        path, added = vocabulary(), added_tokens()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoders.get((path, added)) or _encoders.setdefault((path, added), Encoder(path, added))
        number, end = TaskContext.get().partitionId() << 33, _packed(closing)
        for batch in batches:
            for rows, data, offsets in spans.slices(batch, "text"):
                body = data.tobytes()
                ids, starts, lengths, raw, totals = [], [], [], [], []
                for doc_id, a, b in zip(rows.column(0).to_pylist(), offsets[:-1], offsets[1:]):
                    tokens = encoder.packed(body[a:b].decode()) + end
                    at, total = 0, len(tokens) // 4
                    for size in piece_lengths(total, length):
                        ids.append(doc_id), starts.append(at), lengths.append(size), totals.append(total)
                        raw.append(tokens[4 * at : 4 * (at + size)])
                        at += size
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array(ids, pa.int64()),
                        "start": pa.array(starts, pa.int64()),
                        "length": pa.array(lengths, pa.int64()),
                        "tokens": pa.array(raw, pa.binary()),
                        "doc_tokens": pa.array(totals, pa.int64()),
                        "sequence_id": pa.array(np.arange(number, number + len(ids))),
                        "offset": pa.array(np.zeros(len(ids), np.int64)),
                    }
                )
                number += len(ids)

    typed = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    pieces = typed.mapInArrow(run, "doc_id long, start long, length long, tokens binary, doc_tokens long, sequence_id long, offset long")
    return pieces.withColumn("bucket", F.log2("length").cast("int"))
