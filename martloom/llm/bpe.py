"""Byte-level BPE encoding and decoding by a local rank file.

The tiktoken library merges; this module only hands it texts it can take. Its
regex engine keeps a stack entry per matched character of a white-space run
and fails on very long runs, and one call holds a whole text. So a long text
is cut where the split pattern is bound to end a match whatever follows:

* after a character that is no white space and before white space;
* after an ASCII letter or digit and before ASCII punctuation.

No part of the pattern looks back, and only white space looks ahead, so the
matches on both sides are those of the whole text. A long white-space run is
one match but for its last character when more text follows, and is handed
over as the single piece it is.

Texts: NULL and empty give no ids. Repeated rows each get their own result.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
import zlib
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.common import ship

# The characters that the pattern's \s matches.
_WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

CHUNK_CHARS = 32_768
_RUN = re.compile(f"[{_WHITE}]{{1024,}}")
_SAFE = re.compile(
    f"(?<=[^{_WHITE}\x1c-\x1f])(?=[ \\t\\r\\n])|(?<=[A-Za-z0-9])(?=[!-/:-@\\[-`{{-~])"
)


@functools.lru_cache(maxsize=4)
def ranks_of(rank_file: str) -> bytes:
    """A rank file's lines, packed: a value of about a megabyte that goes to
    the workers, which need not have the file."""
    return zlib.compress(Path(rank_file).read_bytes(), 9)


def encoding(rank_file: str, pattern: str):
    return encoding_of(ranks_of(rank_file), pattern)


@functools.lru_cache(maxsize=4)
def encoding_of(packed: bytes, pattern: str):
    """The encoding of packed ranks, made once per Python worker."""
    import tiktoken

    lines = zlib.decompress(packed).splitlines()
    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _ordinary(enc, text: str, chunk: int) -> list[int]:
    ids, start = [], 0
    while len(text) - start > chunk:
        cut = _SAFE.search(text, start + chunk)
        if not cut or cut.start() >= len(text):
            break
        ids += enc.encode_ordinary(text[start : cut.start()])
        start = cut.start()
    ids += enc.encode_ordinary(text[start:])
    return ids


def encode_text(enc, text: str, chunk: int = CHUNK_CHARS) -> list[int]:
    """The ids of a text of any length."""
    ids, start = [], 0
    for run in _RUN.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        ids += _ordinary(enc, text[start : run.start()], chunk)
        ids += enc._encode_single_piece(text[run.start() : end])
        start = end
    return ids + _ordinary(enc, text[start:], chunk)


RESULT = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
)


def encode_udf(rank_file: str, pattern: str):
    """text -> array of ids; NULL gives an empty array."""
    ship()
    ranks = ranks_of(rank_file)

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def ids_of(texts: pa.Array) -> pa.Array:
        enc = encoding_of(ranks, pattern)
        return pa.array([encode_text(enc, t or "") for t in texts.to_pylist()], pa.list_(pa.int32()))

    return ids_of


def decode_udf(rank_file: str, pattern: str):
    """array of ids -> bytes, which need not be valid UTF-8; NULL gives none."""
    ship()
    ranks = ranks_of(rank_file)

    @F.arrow_udf(T.BinaryType())
    def bytes_of(ids: pa.Array) -> pa.Array:
        enc = encoding_of(ranks, pattern)
        return pa.array([enc.decode_bytes(x or []) for x in ids.to_pylist()], pa.binary())

    return bytes_of


def digest_udf(rank_file: str, pattern: str):
    """text -> count and digest of its ids and digest of the decoded bytes, in
    one visit, so that the ids need not go back to the JVM."""
    ship()
    ranks = ranks_of(rank_file)

    @F.arrow_udf(RESULT)
    def digests(texts: pa.Array) -> pa.Array:
        import numpy as np

        enc = encoding_of(ranks, pattern)
        n, ids_hex, text_hex = [], [], []
        for text in texts:
            ids = encode_text(enc, text.as_py() or "")
            n.append(len(ids))
            ids_hex.append(hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest())
            text_hex.append(hashlib.sha256(enc.decode_bytes(ids)).hexdigest())
        return pa.StructArray.from_arrays(
            [pa.array(n, pa.int64()), pa.array(ids_hex, pa.string()), pa.array(text_hex, pa.string())],
            names=RESULT.names,
        )

    return digests


def encode(docs: DataFrame, rank_file: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with a column of ids."""
    return docs.withColumn(ids, encode_udf(rank_file, pattern)(F.col(text)))


def decode(tokens: DataFrame, rank_file: str, pattern: str, ids: str = "ids", data: str = "data") -> DataFrame:
    """``tokens`` with a column of the bytes that ``ids`` stand for."""
    return tokens.withColumn(data, decode_udf(rank_file, pattern)(F.col(ids)))


def round_trip(docs: DataFrame, rank_file: str, pattern: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, n_tokens, ids_sha256, decoded_sha256)`` of every row; other
    columns are not carried, so their names cannot clash."""
    coded = docs.select(F.col(id), digest_udf(rank_file, pattern)(F.col(text)).alias("r"))
    return coded.select(id, *(F.col("r")[name].alias(name) for name in RESULT.names))
