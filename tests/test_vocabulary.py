from __future__ import annotations

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parley.functions.tokens import token_count, token_ids
from parley.functions.vocabulary import Trie, Vocabulary
from parley.operators.profile import length_sketches, length_stats, merge_sketches, token_stats
from parley.operators.sft import tokenize_sft

LETTERS = "ab é日😀\n"


def greedy(vocabulary, text, unknown=-1):
    out, at = [], 0
    while at < len(text):
        size = next((n for n in range(min(6, len(text) - at), 0, -1) if text[at : at + n] in vocabulary), 0)
        out.append(vocabulary[text[at : at + size]] if size else unknown)
        at += size or 1
    return out


@given(
    st.dictionaries(st.text(LETTERS, min_size=1, max_size=5), st.integers(0, 9999), max_size=30),
    st.lists(st.none() | st.text(LETTERS, max_size=25), max_size=8),
)
@settings(max_examples=150, deadline=None)
def test_ids_are_those_of_the_longest_matches(vocabulary, texts):
    trie = Trie.build({t.encode(): i for t, i in vocabulary.items()})
    found = Vocabulary(trie, -1).encode(pa.array([None, *texts], pa.string()).slice(1))
    assert found.to_pylist() == [greedy(vocabulary, t or "") for t in texts]


def test_a_large_vocabulary_and_long_texts():
    words = {f"{a}{b}{c}": n for n, (a, b, c) in enumerate((a, b, c) for a in "abcdefgh" for b in range(300) for c in ("", "x", "é"))}
    text = "".join(list(words)[::-3]) * 60
    found = Vocabulary(Trie.build({t.encode(): i for t, i in words.items()}), 7).encode(pa.array([text, "zz", text]))
    assert found.to_pylist() == [greedy(words, text, 7), [7, 7], greedy(words, text, 7)]


def test_a_vocabulary_table_plugs_in_everywhere(spark):
    table = spark.createDataFrame([("ab", 3), ("ab", 2), ("a", 1), (None, 5), ("", 6), ("x", None)], "token string, id int")
    vocabulary = Vocabulary.of(table, unknown=0)
    df = spark.createDataFrame([(1, "abab a"), (2, ""), (3, None)], "id int, text string")
    rows = df.select("id", token_ids(F.col("text"), vocabulary).alias("i"), token_count(F.col("text"), vocabulary).alias("n"))
    assert [tuple(r) for r in rows.orderBy("id").collect()] == [(1, [2, 2, 0, 1], 4), (2, [], 0), (3, None, None)]
    cut = tokenize_sft(df, vocabulary, max_length=3, keep=["id"]).orderBy("id").first()
    assert cut["input_ids"] == [2, 2, 0] and cut["was_truncated"]
    assert token_stats(df.select("text"), tokenizer=vocabulary).first()["seen"] == 3
    with pytest.raises(ValueError, match="more than 1"):
        Vocabulary.of(table, most=1)


def test_sketches_saved_by_split_merge_within_their_rank_error(spark):
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("split"),
        F.when(F.col("id") % 11 > 0, (F.col("id") * F.col("id")) % 10_007).alias("v"),
    )
    saved = length_sketches(df.repartition(9), "v")
    assert saved.count() <= 2 * 9 and merge_sketches(saved.limit(0)).first()["seen"] == 0
    for by in ([], ["split"]):
        found = {tuple(r[c] for c in by): r for r in merge_sketches(saved, by).collect()}
        exact = {tuple(r[c] for c in by): r for r in length_stats(df, "v", by).collect()}
        assert set(found) == set(exact)
        for key, e in exact.items():
            f = found[key]
            assert [f[c] for c in ("seen", "kept", "count", "min", "max")] == [e[c] for c in ("seen", "kept", "count", "min", "max")]
            assert f["mean"] == pytest.approx(e["mean"]) and abs(f["p95"] - e["p95"]) < 0.006 * 10_007


def test_sketches_of_nothing(spark):
    df = spark.createDataFrame([("a", None)], "split string, v long")
    row = merge_sketches(length_sketches(df, "v")).first()
    assert (row["seen"], row["kept"], row["p95"], row["mean"]) == (1, 0, None, None)
