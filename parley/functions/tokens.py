"""Token counts and token ids.

Two native tokenizers need no Python: ``"words"`` counts with a regular
expression, ``"codepoints"`` maps each character to its code point. A real
tokenizer is plugged in as a *factory*: a picklable zero-argument callable that
builds, once per task, a function from a list of texts to a list of id lists;
or as a ``Vocabulary``, whose tokens are matched longest first.
Plugged-in functions are declared non-deterministic so that each text is
encoded exactly once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.functions.vocabulary import Vocabulary, counted, encoded

Encode = Callable[[list[str]], list[list[int]]]
TokenizerFactory = Callable[[], Encode]

# A run of Latin letters and digits is one token, any other visible character is one too.
LATIN = r"0-9A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}"
BLANK = r"\x{9}-\x{D}\x{20}"


def tokenizer_file(path: str) -> TokenizerFactory:
    """Factory for a ``tokenizer.json`` that every executor can read at ``path``."""

    def load() -> Encode:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)

        def encode(texts: list[str]) -> list[list[int]]:
            return [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]

        return encode

    return load


def _encode_udf(factory: TokenizerFactory):
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        run = factory()
        for batch in batches:
            ids = run([t or "" for t in batch.to_pylist()])
            yield pa.array(ids, pa.list_(pa.int32()))

    return F.arrow_udf(encode, T.ArrayType(T.IntegerType())).asNondeterministic()


def _count_udf(factory: TokenizerFactory):
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        run = factory()
        for batch in batches:
            ids = run([t or "" for t in batch.to_pylist()])
            yield pa.array([len(i) for i in ids], pa.int64())

    return F.arrow_udf(count, T.LongType()).asNondeterministic()


def token_list(text: Column) -> Column:
    """The tokens that ``"words"`` counts, as strings; null stays null."""
    return F.regexp_extract_all(text, F.lit(f"[{LATIN}]+|[^{LATIN}{BLANK}]"), F.lit(0))


def token_count(text: Column, tokenizer: str | TokenizerFactory | Vocabulary = "words") -> Column:
    """Number of tokens, without special ones; null stays null."""
    if isinstance(tokenizer, Vocabulary):
        count = F.arrow_udf(counted(tokenizer), T.LongType()).asNondeterministic()
        return F.when(text.isNotNull(), count(text))
    if callable(tokenizer):
        return F.when(text.isNotNull(), _count_udf(tokenizer)(text))
    if tokenizer == "words":
        # One character per token is left to count, no list of matches is built.
        words = F.regexp_replace(text, f"[{LATIN}]+", "a")
        return F.length(F.regexp_replace(words, f"[{BLANK}]+", "")).cast("bigint")
    if tokenizer == "codepoints":
        return F.length(text).cast("bigint")
    raise ValueError(f"unknown tokenizer {tokenizer!r}")


def token_ids(text: Column, tokenizer: str | TokenizerFactory | Vocabulary = "codepoints") -> Column:
    """Token ids, without special ones; null stays null."""
    if isinstance(tokenizer, Vocabulary):
        encode = F.arrow_udf(encoded(tokenizer), T.ArrayType(T.IntegerType())).asNondeterministic()
        return F.when(text.isNotNull(), encode(text))
    if callable(tokenizer):
        return F.when(text.isNotNull(), _encode_udf(tokenizer)(text))
    if tokenizer == "codepoints":
        empty = F.array().cast("array<int>")
        return F.when(text == "", empty).otherwise(F.transform(F.split(text, ""), F.ascii))
    raise ValueError(f"tokenizer {tokenizer!r} gives no ids")
