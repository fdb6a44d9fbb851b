"""SentencePiece encoding and decoding over tables of distinct chunks.

A chunk is a run of word markers with what follows up to the next marker. If no piece of the model holds a marker after
another character, no merge crosses a chunk's start, and a text's ids are those of its chunks in turn. Each task
segments a distinct chunk once, keeps ids and surface in a table, and joins them back by position; tables of all
tasks together hold each chunk as often as tasks meet it, since a table for the whole corpus would have to move every
word of every text twice. A table is emptied at ``TABLE`` chunks, and long chunks never enter it, so memory is bounded.

Defined cases: a null text counts as empty and gives only the begin and end ids; spaces, also leading, trailing and
repeated ones, are kept; U+2581 is the marker itself and decodes to a space, as in the library; a model whose pieces
cross markers is refused.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import fresh

MARK = "▁"
TABLE = 400_000
LONGEST = 64
_CHUNK = re.compile(" +[^ ]*")


def load_model(content: bytes) -> sentencepiece.SentencePieceProcessor:
    model = sentencepiece.SentencePieceProcessor()
    model.LoadFromSerializedProto(content)
    return model


def check_model(content: bytes) -> None:
    model = load_model(content)
    crossing = [p for p in map(model.id_to_piece, range(model.vocab_size())) if MARK in p.lstrip(MARK)]
    if crossing:
        raise ValueError(f"pieces cross word markers, e.g. {crossing[0]!r}")
    if model.encode(" ") != model.encode(MARK) or len(model.decode(model.encode("  a  "))) != 5:
        raise ValueError("the model does not keep white space as it is")


class Chunks(dict):
    """Chunk to (ids as little-endian 32-bit numbers, surface)."""

    def __init__(self, model: sentencepiece.SentencePieceProcessor):
        super().__init__()
        self.model = model

    def __missing__(self, chunk: str) -> tuple[bytes, str]:
        # the library puts the first marker of a text itself, and takes it off again
        ids = self.model.encode(chunk[1:]) if len(chunk) > 1 else self.marker()
        out = (struct.pack(f"<{len(ids)}I", *ids), " " + self.model.decode(ids))
        if len(chunk) <= LONGEST:
            if len(self) >= TABLE:
                self.clear()
            self[chunk] = out
        return out

    def marker(self) -> list[int]:
        return [self.model.piece_to_id(MARK)]


def segment(text: str, chunks: Chunks) -> tuple[bytes, str]:
    """Ids without begin and end, and the decoded text."""
    if not text:
        return b"", ""
    parts = [chunks[c] for c in _CHUNK.findall(" " + text.replace(MARK, " "))]
    return b"".join([p[0] for p in parts]), "".join([p[1] for p in parts])[1:]


def encode(docs: DataFrame, model: bytes, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add the ids, begin and end included, as packed unsigned 32-bit numbers, and the text that they decode to."""
    check_model(model)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = load_model(shared.value)
        begin, end = (i.to_bytes(4, "little") for i in (own.bos_id(), own.eos_id()))
        chunks = Chunks(own)
        for b in batches:
            found = [segment(t or "", chunks) for t in b.column(0).to_pylist()]
            packed = pa.array([begin + f[0] + end for f in found], pa.binary())
            texts = pa.array([f[1] for f in found], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns[1:], packed, texts], [*b.schema.names[1:], ids, decoded])

    kept = [c for c in docs.columns if c.lower() not in (ids.lower(), decoded.lower())]
    first = fresh(docs, "_body")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema)
    return docs.select(F.col(text).alias(first), *[F.col(c) for c in kept]).mapInArrow(run, f"{schema}, `{ids}` binary, `{decoded}` string")


def digests(encoded: DataFrame) -> DataFrame:
    """Per document the number of ids and the digests of ids and decoded text."""
    return encoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()

