"""Sizes of texts in tokens of a public tokenizer, whose file is a parameter."""

from __future__ import annotations

import base64
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

#: Fixed value: the pre-tokenization pattern of the byte-level BPE vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def default_path() -> str:
    """The byte-level BPE vocabulary of the installed tokenizer files."""
    try:
        import public_tokenizers

        return public_tokenizers.path("byte_bpe_50k.tiktoken")
    except ImportError:
        return "/opt/tokenizers/byte_bpe_50k.tiktoken"


@functools.lru_cache(4)
def counter(path: str) -> Callable[[list[str]], list[int]]:
    """Counts the tokens of texts with the tokenizer in a file (.tiktoken, .json or .model), loaded once per process."""
    if path.endswith(".tiktoken"):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        return lambda texts: [len(enc.encode_ordinary(t)) for t in texts]
    if path.endswith(".model"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in sp.encode(texts, num_threads=1)]
    import os

    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    return lambda texts: [len(x.ids) for x in tok.encode_batch(texts, add_special_tokens=False)]


def sized(docs: DataFrame, path: str | None = None, text: str = "text") -> DataFrame:
    """docs without its text, with n_tokens (long): of the whole text; 0 for an empty and for a null one. A column of that name is replaced."""
    path = path or default_path()
    rest = [c for c in docs.columns if c not in (text, "n_tokens")]
    schema = StructType(list(docs.select(*rest).schema.fields)).add("n_tokens", "long")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = counter(path)
        for b in batches:
            b = b.copy()
            has = b[text].notna().to_numpy()
            n = np.zeros(len(b), np.int64)
            n[has] = of(b.loc[has, text].tolist())
            yield b[rest].assign(n_tokens=n)

    return docs.mapInPandas(count, schema)
