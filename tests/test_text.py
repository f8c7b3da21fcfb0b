from __future__ import annotations

import sys
import unicodedata
from itertools import groupby

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parley.constants import WHITESPACE
from parley.functions import text as t
from parley.functions.metrics import perplexity
from parley.functions.tokens import token_count, token_ids, tokenizer_file


def apply(spark, function, values):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, v string").select("i", function(F.col("v")).alias("r"))
    return [r["r"] for r in df.orderBy("i").collect()]


def test_whitespace_is_what_python_strips():
    assert set(WHITESPACE) == {chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace()}


def test_stable_ranges_never_change_under_nfkc():
    after = [chr(c) for c in range(sys.maxunicode + 1) if unicodedata.decomposition(chr(c))]
    seconds = {unicodedata.normalize("NFD", c)[1] for c in after if len(unicodedata.normalize("NFD", c)) > 1}
    for low, high in t._NFKC_STABLE:
        for c in map(chr, range(low, high + 1)):
            assert unicodedata.is_normalized("NFKC", c), hex(ord(c))
            assert unicodedata.combining(c) == 0 and c not in seconds, hex(ord(c))


def test_foldable_characters_fold_anywhere():
    for a, b in zip(t._FOLD_FROM, t._FOLD_TO, strict=True):
        assert unicodedata.normalize("NFKC", a) == b and b.isascii()
    assert unicodedata.normalize("NFKC", t._ELLIPSIS) == "..."
    assert len(t._FOLD_FROM) > 94


def test_ordinary_chinese_needs_no_batch_function(spark):
    values = ["“你好……”，他说：ＯＫ！\u3000（一）", "plain", "naïve\xa0été", "ﬁ", "Ａ\u0301"]
    assert apply(spark, t._needs_tables, values) == [False, False, False, True, True]
    assert apply(spark, t.nfkc, values) == [unicodedata.normalize("NFKC", v) for v in values]


GOLDEN = [
    ("　ＡＢＣ①ﬁ \t x​\n\n\n\ny \x1c", "ABC1fi x\n\ny"),
    (None, ""),
    ("\n\n", ""),
    ("a\r\n\r\n\r\nb", "a\r\n\r\n\r\nb"),
    ("a \n b", "a \n b"),
    ("﻿hi", "hi"),
    ("é", "é"),
    ("a\tb", "a b"),
    ("", ""),
]


def test_normalize_text(spark):
    assert apply(spark, t.normalize_text, [v for v, _ in GOLDEN]) == [r for _, r in GOLDEN]


def test_compact_text(spark):
    values = [" a　b\n\nc ", None, "a b", "a  b", "\x85a\xa0\tb ", "​ x", "  "]
    assert apply(spark, t.compact_text, values) == [" ".join((v or "").split()) for v in values]


def expected_text(value: str) -> str:
    chars = [c for c in unicodedata.normalize("NFKC", value) if c not in "\u200b\ufeff"]
    out = ""
    for kind, run in groupby(chars, key=lambda c: {" ": "blank", "\t": "blank", "\n": "line"}.get(c)):
        letters = list(run)
        out += " " if kind == "blank" else "\n" * min(len(letters), 2) if kind == "line" else "".join(letters)
    return out.strip()


texts = st.text(st.sampled_from("…\u2003aȩ́́e 　\t\n\n\n\r​﻿\xa0\x1c\x85ＡﬁΑ中가ᅡ゙か① "), max_size=14)


@settings(max_examples=8, deadline=None)
@given(st.lists(texts, min_size=40, max_size=60))
def test_text_functions_match_python(spark, values):
    assert apply(spark, t.normalize_text, values) == [expected_text(v) for v in values]
    assert apply(spark, t.compact_text, values) == [" ".join(v.split()) for v in values]
    assert apply(spark, t.is_blank, values) == [expected_text(v) == "" for v in values]
    assert apply(spark, t.strip, values) == [v.strip() for v in values]


def test_nfkc_array_keeps_nulls(spark):
    rows = [(0, ["Ａ", None, "b"]), (1, None), (2, []), (3, ["x"]), (4, [None]), (5, ["é", "ﬁ"])]
    df = spark.createDataFrame(rows, "i int, v array<string>").repartition(2)
    got = {r["i"]: r["n"] for r in df.select("i", t.nfkc_array(F.col("v")).alias("n")).collect()}
    assert got == {0: ["A", None, "b"], 1: None, 2: [], 3: ["x"], 4: [None], 5: ["é", "fi"]}


def test_char_length_counts_code_points(spark):
    assert apply(spark, t.char_length, ["a😀中", "", None]) == [3, 0, None]


def test_native_tokenizers(spark):
    values = ["Hello wörld2, 你好!", "", None, "a😀b"]
    assert apply(spark, token_count, values) == [6, 0, None, 3]
    assert apply(spark, lambda c: token_count(c, "codepoints"), values) == [17, 0, None, 3]
    assert apply(spark, token_ids, values)[1:] == [[], None, [97, 128512, 98]]


def test_tokenizer_file(spark, tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers

    tokenizer = Tokenizer(models.WordLevel({"[UNK]": 0, "hi": 1, "there": 2}, unk_token="[UNK]"))
    tokenizer.pre_tokenizer = pre_tokenizers.Whitespace()
    path = str(tmp_path / "tokenizer.json")
    tokenizer.save(path)
    load = tokenizer_file(path)
    values = ["hi there", "there who", "", None]
    assert apply(spark, lambda c: token_ids(c, load), values) == [[1, 2], [2, 0], [], None]
    assert apply(spark, lambda c: token_count(c, load), values) == [2, 2, 0, None]


@pytest.mark.parametrize(
    ("loss", "expected"),
    [(0.0, 1.0), (100.0, float("inf")), (float("nan"), float("inf")), (None, float("inf")), (99.5, 2.718281828459045**99.5)],
)
def test_perplexity(spark, loss, expected):
    df = spark.createDataFrame([(loss,)], "loss double")
    assert df.select(perplexity(F.col("loss"))).first()[0] == pytest.approx(expected)
