"""Encoding of a corpus with a byte-level BPE vocabulary given as a local rank file.

Cases: null and empty texts give an empty list; every other text is encoded whole and without special tokens, also the
strings that look like special tokens; repeated rows are encoded each; the id column is passed through as it is, and other
columns of the input are dropped, so clashing names do no harm; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Folder of the public vocabulary files; a parameter of every function here.
TOKENIZER_DIR = os.environ.get("SIEVELINE_TOKENIZERS", "/opt/tokenizers")
#: The pre-splitting pattern of the vocabulary (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Texts longer than this are cut at safe boundaries, so that no single call gets an unbounded text.
PIECE_CHARS = 1 << 16

#: No pre-token reaches from a character that is not white space over a following white space, so a cut before that white
#: space never changes the pre-tokens on either side.
_SAFE = re.compile(r"(?<=\S)(?=\s)")
#: The second choice for scripts without spaces: from a letter to a sign that is neither letter, digit, space nor apostrophe.
_SAFE_SIGN = re.compile(r"(?<=[^\W\d_])(?=[^\w\s'])")

_LOADED: dict[str, object] = {}


def encoding(path: str):
    """The tiktoken encoding of a rank file, loaded once per Python worker."""
    if path not in _LOADED:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        _LOADED[path] = tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _LOADED[path]


def pieces(text: str, size: int = PIECE_CHARS) -> list[str]:
    """Cuts a text into parts whose encodings, joined, are the encoding of the whole."""
    out, at = [], 0
    while len(text) - at > size:
        cut = _last_cut(text, at + 1, at + size)
        if cut is None:  # one run without any boundary: go on to the next one
            m = _SAFE.search(text, at + size)
            cut = m.start() if m else len(text)
        out.append(text[at:cut])
        at = cut
    out.append(text[at:])
    return out


def _last_cut(text: str, low: int, high: int) -> int | None:
    for pattern in (_SAFE, _SAFE_SIGN):
        for start in range(max(low, high - 2048), low - 2048, -2048):
            found = [m.start() for m in pattern.finditer(text, max(low, start), min(high, start + 2048))]
            if found:
                return found[-1]
    return None


def encode_text(enc, text: str | None, size: int = PIECE_CHARS) -> list[int]:
    if not text:
        return []
    if len(text) <= size:
        return enc.encode_ordinary(text)
    out: list[int] = []
    for piece in pieces(text, size):
        out.extend(enc.encode_ordinary(piece))
    return out


def decode_ids(enc, ids: list[int]) -> bytes:
    """The raw bytes of ids; cutting a text anywhere may leave bytes that are no valid UTF-8 by themselves."""
    return enc.decode_bytes(list(ids))


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = "byte_bpe_50k", folder: str = TOKENIZER_DIR, size: int = PIECE_CHARS) -> DataFrame:
    """One row (id, ids) for each row of ``docs``. Narrow: no shuffle beyond the even spread of rows before Python."""
    path = f"{folder}/{vocabulary}.tiktoken"

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoding(path)
        for texts in batches:
            yield pd.Series([encode_text(enc, t if isinstance(t, str) else None, size) for t in texts], dtype=object)

    ids = F.pandas_udf(run, "array<int>")
    return docs.select(F.col(id_col).alias("doc_id"), ids(F.col(text_col).cast("string")).alias("ids"))


def decode(encoded: DataFrame, vocabulary: str = "byte_bpe_50k", folder: str = TOKENIZER_DIR) -> DataFrame:
    """The inverse of :func:`encode`: (doc_id, raw) with the raw bytes of each list of ids."""
    path = f"{folder}/{vocabulary}.tiktoken"

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoding(path)
        for lists in batches:
            yield pd.Series([b"" if x is None else decode_ids(enc, x) for x in lists], dtype=object)

    return encoded.select("doc_id", F.pandas_udf(run, "binary")(F.col("ids")).alias("raw"))
