"""Token counts by a public tokenizer, as a Pandas UDF."""

from __future__ import annotations

import base64
import os
import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Folder of the public vocabulary files; a parameter, never copied.
FOLDER = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.tiktoken"
#: How that vocabulary splits text before merging (fixed value of the public tokenizer).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters encoded at once, about; a longer text is cut where no token can cross.
STEP = 200_000
CUT = re.compile(r"(?<=\S) ")


@lru_cache(maxsize=4)
def encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, step: int = STEP):
    """The text in pieces of ``step`` characters or more, each cut at the next blank after a character
    that is none. There a token ends whatever follows; a text without such places stays whole."""
    at = 0
    while len(text) - at > step and (m := CUT.search(text, at + step)):
        yield text[at : m.start()]
        at = m.start()
    yield text[at:]


def count(text: str | None, path: str) -> int:
    if not text:
        return 0
    return sum(len(encoding(path).encode_ordinary(p)) for p in pieces(text))


def token_count(text: str | Column, folder: str = FOLDER, vocabulary: str = VOCABULARY) -> Column:
    """Tokens of the whole text; 0 for null and empty texts."""
    path = f"{folder}/{vocabulary}"

    @F.pandas_udf("long")
    def run(s: pd.Series) -> pd.Series:
        return pd.Series([count(t, path) for t in s], dtype="int64")

    return run(F.col(text) if isinstance(text, str) else text)
