"""Text sizes in tokens: a pattern by default, or a public tokenizer's vocabulary file."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

PATTERN = r"[A-Za-z0-9]+|[^A-Za-z0-9 \t\r\n]"


def _counter(path: str):
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.encode_special_tokens = True
        return lambda texts: [len(e.ids) for e in tok.encode_batch(texts, add_special_tokens=False)]
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda texts: [len(enc.encode_ordinary(t)) for t in texts]


def token_count(text: Column, tokenizer: str | None = None) -> Column:
    """Tokens of the whole text; 0 for null. ``tokenizer`` is the path of a vocabulary file, else PATTERN counts."""
    if tokenizer is None:
        return F.coalesce(F.regexp_count(text, F.lit(PATTERN)), F.lit(0)).cast("long")

    @F.pandas_udf(T.LongType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lengths = _counter(tokenizer)
        for texts in batches:
            yield pd.Series(lengths(texts.fillna("").tolist()), dtype="int64")

    return count(text)
