"""Lengths of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pandas as pd
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where the vocabulary files are; the same path on every executor.
TOKENIZERS = os.environ.get("FILANDA_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.tiktoken"

#: Fixed value: how byte-level BPE cuts a text into words before merging.
WORDS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_LOADED: dict[str, tiktoken.Encoding] = {}


def encoding(path: str) -> tiktoken.Encoding:
    """The tokenizer of a rank file, loaded once in a process."""
    if path not in _LOADED:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _LOADED[path] = tiktoken.Encoding(os.path.basename(path), pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
    return _LOADED[path]


_WORD = regex.compile(WORDS)


class Counter:
    """Counts tokens word by word: a word's count never depends on its neighbours, so each distinct word is encoded once.

    The memory of words is bounded; beyond it, words are encoded anew.
    """

    def __init__(self, path: str, most: int = 200_000) -> None:
        self.encoding, self.most, self.seen = encoding(path), most, {}

    def __call__(self, text: str | None) -> int:
        if not text:
            return 0
        seen, total = self.seen, 0
        for w in _WORD.findall(text):
            n = seen.get(w)
            if n is None:
                n = len(self.encoding.encode_ordinary(w))
                if len(seen) < self.most:
                    seen[w] = n
            total += n
        return total


def with_token_counts(docs: DataFrame, tokenizers: str = TOKENIZERS, vocabulary: str = VOCABULARY, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with ``n_tokens bigint``: 0 for a null or empty text. The whole text is counted."""
    path = os.path.join(tokenizers, vocabulary)

    @F.pandas_udf("long")
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = Counter(path)
        for t in texts:
            yield t.map(counter).astype("int64")

    return docs.withColumn("n_tokens", F.coalesce(F.when(F.length(text) > 0, count(F.col(text))), F.lit(0)).cast("long")).drop(text)
