from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from parley.functions import messages as m
from parley.functions.roles import normalize_role
from parley.operators.turns import fold_turns, unfold_turns

TURNS = "array<struct<from:string,value:string>>"
CHAT = "array<struct<role:string,content:string>>"


def one(spark, schema, value, function):
    df = spark.createDataFrame([(value,)], f"v {schema}")
    return df.select(function(F.col("v")).alias("r")).first()["r"]


def pairs(messages):
    return None if messages is None else [(x["role"], x["content"]) for x in messages]


@pytest.mark.parametrize(
    ("name", "role"),
    [
        ("Human", "user"),
        ("玩家", "user"),
        ("欢迎词", "system"),
        ("旁白", "assistant"),
        ("主角小明", "user"),
        ("ＮＰＣ", "assistant"),
        ("系统", "assistant"),
        ("系统设定", "system"),
        ("旁白者", "assistant"),
        ("张三", "user"),
        ("", "user"),
        (None, "user"),
        (" BOT\n", "assistant"),
    ],
)
def test_normalize_role(spark, name, role):
    assert one(spark, "string", name, normalize_role) == role


def test_own_alias_table(spark):
    role = one(spark, "string", "Elder", lambda c: normalize_role(c, {"Elder": "assistant"}, []))
    assert role == "assistant"


@pytest.mark.parametrize(
    ("speakers", "roles"),
    [
        (["system", "张三", "李四", "npc", "路人"], ["system", "user", "assistant", "assistant", "assistant"]),
        (["欢迎词", "玩家", "旁白"], ["system", "user", "assistant"]),
        (["旁白", "张三", "李四"], ["assistant", "assistant", "user"]),
        (["Alice", "系统设定"], ["user", "assistant"]),
        (["npc", "主角小明"], ["assistant", "assistant"]),
        (["用户A", "B", "玩家"], ["user", "assistant", "user"]),
    ],
)
def test_from_conversations(spark, speakers, roles):
    turns = [(s, f"text {i}") for i, s in enumerate(speakers)]
    build = lambda c: m.from_conversations(c, speaker_fields=["from"], value_fields=["value"])
    got = pairs(one(spark, TURNS, turns, build))
    assert got == [(r, f"text {i}") for i, r in enumerate(roles)]


def dispatch(spark, schema, row, null_policy="missing"):
    df = spark.createDataFrame([row], schema)
    got = df.select(
        m.to_messages(df, null_policy).alias("m"), m.has_messages(df, null_policy).alias("has")
    ).first()
    assert got["has"] == (got["m"] is not None)
    return pairs(got["m"])


def test_blank_turns_go_before_counting(spark):
    turns = [("张三", "a"), ("x", " 　"), ("李四", "b")]
    assert dispatch(spark, f"conversations {TURNS}", (turns,)) == [("user", "a"), ("assistant", "b")]


@pytest.mark.parametrize("value", [None, [], [None], [("user", None)], [("user", " ​")]])
def test_messages_without_text_give_nothing(spark, value):
    assert dispatch(spark, f"messages {CHAT}", (value,)) is None


def test_messages_list_wins_and_does_not_fall_through(spark):
    schema = f"messages {CHAT}, conversations {TURNS}, text string"
    chat, turns = [("gpt", "Ａ"), ("system", "s")], [("npc", "v")]
    assert dispatch(spark, schema, (chat, turns, "t")) == [("assistant", "A"), ("system", "s")]
    assert dispatch(spark, schema, ([], turns, "t")) is None
    assert dispatch(spark, schema, (None, turns, "t")) == [("assistant", "v")]
    assert dispatch(spark, schema, (None, None, " t ")) == [("user", "t")]
    assert dispatch(spark, schema, (None, None, None)) is None


def test_role_content_fields_in_conversations(spark):
    assert dispatch(spark, f"conversations {CHAT}", ([("npc", "x"), (None, "y")],)) == [
        ("assistant", "x"),
        ("user", "y"),
    ]


def test_list_of_plain_strings_has_no_messages(spark):
    assert dispatch(spark, "messages array<string>, text string", (["a"], "t")) is None


FLAT = "instruction string, input string, output string"


@pytest.mark.parametrize(
    ("row", "policy", "expected"),
    [
        (("do", "x", "ok"), "missing", [("user", "do\nx"), ("assistant", "ok")]),
        (("do", "", "ok"), "missing", [("user", "do"), ("assistant", "ok")]),
        (("do", None, "ok"), "missing", [("user", "do"), ("assistant", "ok")]),
        (("do", None, "ok"), "literal", [("user", "do\nNone"), ("assistant", "ok")]),
        (("do", "x", ""), "missing", None),
        (("", "x", "ok"), "missing", None),
        ((None, "x", "ok"), "missing", None),
        ((None, "", "ok"), "literal", [("user", "None"), ("assistant", "ok")]),
    ],
)
def test_instruction_shape(spark, row, policy, expected):
    assert dispatch(spark, FLAT, row, policy) == expected


def test_shape_is_chosen_by_columns(spark):
    schema = "prompt string, response string, question string, answer string, text string"
    assert dispatch(spark, schema, ("p", "r", "q", "a", "t")) == [("user", "p"), ("assistant", "r")]
    assert dispatch(spark, schema, ("p", None, "q", "a", "t")) is None
    assert dispatch(spark, "question string, answer string", ("q", "a")) == [("user", "q"), ("assistant", "a")]
    assert dispatch(spark, "text int", (5,)) is None
    assert dispatch(spark, "other string", ("x",)) is None


def test_literal_null_policy_in_lists(spark):
    schema = f"conversations {TURNS}"
    assert dispatch(spark, schema, ([(None, None), ("npc", "x")],), "literal") == [
        ("user", "None"),
        ("assistant", "x"),
    ]
    assert dispatch(spark, schema, ([(None, None), ("npc", "x")],)) == [("assistant", "x")]
    with pytest.raises(ValueError, match="null_policy"):
        dispatch(spark, "text string, prompt string, response string", ("t", "p", "r"), "other")


@pytest.mark.parametrize(
    ("roles", "expected"),
    [
        (["user", "assistant"], True),
        (["user"], False),
        (["assistant", "user"], False),
        (["system", "assistant"], False),
        (["assistant", "user", "assistant"], True),
    ],
)
def test_is_chat_pair(spark, roles, expected):
    assert one(spark, CHAT, [(r, "x") for r in roles], m.is_chat_pair) is expected


def test_is_chat_pair_ignores_empty_messages(spark):
    assert one(spark, CHAT, [("user", "x"), ("assistant", "")], m.is_chat_pair) is False
    assert one(spark, CHAT, None, m.is_chat_pair) is False


def test_content_key(spark):
    key = one(spark, CHAT, [("user", "a  b"), ("assistant", "c\nd")], m.content_key)
    assert key == "87e5e46f5629ed74b51a82fbf53b0eb3eb53b392"


def test_render_chat(spark):
    chat = [("system", "s"), ("user", "u")]
    assert one(spark, CHAT, chat, m.render_chat) == "<|system|>\ns\n\n<|user|>\nu"
    chatml = one(spark, CHAT, chat, lambda c: m.render_chat(c, "chatml", add_generation_prompt=True))
    assert chatml == "<|im_start|>system\ns<|im_end|>\n<|im_start|>user\nu<|im_end|>\n<|im_start|>assistant\n"


def test_extract_reply(spark):
    df = spark.createDataFrame([([("user", "q"), ("assistant", " a　")], " t\n"), ([], None)], f"c {CHAT}, t string")
    got = df.select(m.extract_reply(df, "c").alias("c"), m.extract_reply(df, "t").alias("t")).collect()
    assert [tuple(r) for r in got] == [("a", "t"), ("", "")]


def test_unfold_undoes_fold(spark):
    rows = [(c, t, f"r{t % 2}", f"text {c} {t}") for c in range(7) for t in range(c + 1)]
    df = spark.createDataFrame(rows, "c bigint, turn bigint, role string, text string").repartition(5)
    folded = fold_turns(df, "c", "turn", {"role": "role", "text": "text"}, "messages")
    assert sorted(map(tuple, unfold_turns(folded).collect())) == rows
