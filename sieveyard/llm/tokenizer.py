"""Byte-level BPE encoding and decoding with tiktoken and a local rank file."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_type

#: Characters after which a long text may be cut, and rows of an output batch.
PIECE_CHARS, BATCH_ROWS = 1 << 16, 256


@lru_cache(maxsize=4)
def encoding(rank_file: str, pattern: str):
    """The tiktoken encoding of a rank file, once a worker."""
    import tiktoken

    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """Cut a long text where no match of the pattern can cross.

    A cut lies before a space or newline that follows a character which isn't white space: no
    alternative of the pattern has white space after another character, and none looks back.
    A stretch without such a place stays whole.
    """
    start = 0
    while len(text) - start > size:
        at = start + size
        while at < len(text) and not (text[at] in " \n" and not text[at - 1].isspace()):
            at += 1
        if at >= len(text):
            break
        yield text[start:at]
        start = at
    yield text[start:]


def encode(text: str, enc) -> bytes:
    """Ids of a text as little-endian unsigned 32-bit integers."""
    return b"".join(enc.encode_to_numpy(p, disallowed_special=()).astype("<u4").tobytes() for p in pieces(text))


def decode(ids: bytes, enc) -> bytes:
    """Raw bytes of ids; they need not be valid UTF-8."""
    import numpy as np

    return enc.decode_bytes(np.frombuffer(ids, "<u4").tolist())


def encode_decode(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text and decode the ids again.

    Returns id_col, n_tokens long, ids binary (little-endian unsigned 32-bit), decoded binary. One
    output row for each input row, repeated rows included, in bounded batches. A null or empty text
    has no tokens. Other columns are ignored, whatever their names. Special-token strings in a text
    are ordinary text. No shuffle: a lost executor only repeats its own partitions.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(rank_file, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                ids = [encode(t or "", enc) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array([decode(x, enc) for x in ids], pa.binary())],
                    names=[id_col, "n_tokens", "ids", "decoded"],
                )

    own = docs.select(F.col(id_col), F.col(text_col).alias("__text"))
    return own.mapInArrow(run, row_type(**{id_col: own.schema[0].dataType}, n_tokens="long", ids="binary", decoded="binary"))
