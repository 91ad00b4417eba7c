"""Packing of documents into training sequences by power-of-two decomposition.

A document of n tokens becomes floor(n / longest) pieces of the longest length and one piece for each
set bit of the rest, so every piece length is a power of two. Pieces of equal length form a bucket and
each piece is a whole sequence of its bucket: batches are drawn from one bucket at a time, no sequence
crosses documents and no padding is needed. The work is one pass over the documents without a shuffle.
"""

from __future__ import annotations

import base64
import os
import zlib
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isohyet.llm import common

from isohyet.llm.common import text_of

DEFAULT_TOKENIZER = "byte_bpe_50k.json"
DEFAULT_RANKS = "byte_bpe_50k.tiktoken"


def tokenizer_path(name: str = DEFAULT_TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@cache
def _encoder(path: str, ranks_path: str | None):
    """text -> little-endian unsigned 32-bit ids of the ``tokenizers`` file at ``path``.

    ``ranks_path`` names the same vocabulary as byte ranks. Its ids are equal (tests compare them) and
    come about four times as fast; ``tokenizers`` itself encodes texts that hold an added token and those on
    which the fast pattern gives up.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import numpy as np
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    added = [str(t.content) for t in model.get_added_tokens_decoder().values()]
    slow = lambda text: np.array(model.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    if not ranks_path:
        return slow

    import tiktoken
    from public_tokenizers import PATTERN

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> bytes:
        if any(s in text for s in added):  # added tokens are matched before the pattern
            return slow(text)
        try:
            return fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()
        except ValueError:  # its pattern gives up on very long runs of white space
            return slow(text)

    return encode


def piece_lengths(n: int, longest: int) -> list[int]:
    """Lengths of the pieces of n tokens, longest first; all are powers of two."""
    return [longest] * (n // longest) + [1 << b for b in reversed(range(longest.bit_length() - 1)) if n % longest >> b & 1]


@common.shipped
def pack_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", longest: int = 1024, end_id: int = 0, tokenizer: str | None = None, ranks: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, bucket (and ids).

    ``longest`` must be a power of two. A null or empty text is the end id alone: one piece of length 1.
    Null ids stay null; repeated rows are packed once each; other columns of ``docs`` are not read.
    Very long texts give many pieces, one text in memory at a time. ``sequence_id`` is unique, not dense.
    An empty table gives an empty result.
    """
    if longest & (longest - 1) or longest < 1:
        raise ValueError("longest must be a power of two")
    path = tokenizer or tokenizer_path()
    ranks = ranks or (None if tokenizer else tokenizer_path(DEFAULT_RANKS))
    tail = end_id.to_bytes(4, "little")

    def cut(batches):
        import numpy as np
        import pyarrow as pa

        encode = _encoder(path, ranks)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            lo = 0
            while lo < batch.num_rows:
                rows, start, length, crc, total, parts = [], [], [], [], [], []
                size = 0
                while lo < batch.num_rows and size < 4_000_000:
                    text = texts[lo].as_py()
                    size += len(text)
                    data = encode(text) + tail
                    at, n = 0, len(data) // 4
                    for m in piece_lengths(n, longest):
                        rows.append(lo)
                        start.append(at)
                        length.append(m)
                        part = data[4 * at : 4 * (at + m)]
                        crc.append(zlib.crc32(part))
                        total.append(n)
                        if with_ids:
                            parts.append(part)
                        at += m
                    lo += 1
                out = [ids.take(pa.array(rows, pa.int64())), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(total, pa.int64())]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:
                    flat = pa.array(np.frombuffer(b"".join(parts), "<u4").astype(np.int32))
                    out.append(pa.ListArray.from_arrays(pa.array(np.cumsum([0, *length]), pa.int32()), flat))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names)

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids
    pieces = source.mapInArrow(cut, schema)
    return pieces.withColumns({"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long"), "bucket": F.log2("length").cast("int")})
