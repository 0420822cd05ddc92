"""D1-D10 golden strings, written by hand from the chat template."""

import pytest
from pyspark.sql import functions as F

from tokenloom.functions.chat import MESSAGES_TYPE, choose_tools, render_chat

DEFAULT = "<|im_start|>system\nYou are a helpful assistant<|im_end|>\n"
PRE = ("# Tools\n\nYou may call one or more functions to assist with the user query.\n\n"
       "You are provided with function signatures within <tools></tools> XML tags:\n<tools>")
POST = ("\n</tools>\n\nFor each function call, return a json object with function name and arguments "
        "within <tool_call></tool_call> XML tags:\n<tool_call>\n{\"name\": <function-name>, "
        "\"arguments\": <args-json-object>}\n</tool_call><|im_end|>\n")


def m(role, content, calls=None):
    return (role, content, [(n, a) for n, a in calls] if calls else None)


def call(name, args):
    return f'<tool_call>\n{{"name": "{name}", "arguments": {args}}}\n</tool_call>'


CASES = [
    ("default_system", [m("user", "hi"), m("assistant", "yo")], None,
     DEFAULT + "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nyo<|im_end|>\n"),
    ("own_system", [m("system", "S"), m("user", "hi")], None,
     "<|im_start|>system\nS<|im_end|>\n<|im_start|>user\nhi<|im_end|>\n"),
    ("tools_with_system", [m("system", "S"), m("user", "hi")], ['{"name": "f"}', '{"name": "g"}'],
     "<|im_start|>system\nS\n\n" + PRE + '\n{"name": "f"}\n{"name": "g"}' + POST +
     "<|im_start|>user\nhi<|im_end|>\n"),
    ("tools_without_system", [m("user", "hi")], ['{"name": "f"}'],
     "<|im_start|>system\n" + PRE + '\n{"name": "f"}' + POST + "<|im_start|>user\nhi<|im_end|>\n"),
    ("tool_run_of_one", [m("user", "q"), m("assistant", "", [("f", '{"a": 1}')]), m("tool", "r1"),
                         m("assistant", "done")], None,
     DEFAULT + "<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\n" + call("f", '{"a": 1}') +
     "<|im_end|>\n<|im_start|>user\n<tool_response>\nr1\n</tool_response><|im_end|>\n"
     "<|im_start|>assistant\ndone<|im_end|>\n"),
    ("tool_run_of_three", [m("user", "q"), m("tool", "r1"), m("tool", "r2"), m("tool", "r3")], None,
     DEFAULT + "<|im_start|>user\nq<|im_end|>\n<|im_start|>user\n<tool_response>\nr1\n</tool_response>"
     "\n<tool_response>\nr2\n</tool_response>\n<tool_response>\nr3\n</tool_response><|im_end|>\n"),
    ("tool_first_and_last", [m("tool", "r")], None,
     DEFAULT + "<|im_start|>user\n<tool_response>\nr\n</tool_response><|im_end|>\n"),
    ("calls_with_content", [m("assistant", "c", [("f", '"x"'), ("g", "{}")])], None,
     DEFAULT + "<|im_start|>assistant\nc\n" + call("f", '"x"') + "\n" + call("g", "{}") + "<|im_end|>\n"),
    ("two_calls_no_content", [m("assistant", "", [("f", "1"), ("g", "2")])], None,
     DEFAULT + "<|im_start|>assistant\n" + call("f", "1") + "\n" + call("g", "2") + "<|im_end|>\n"),
    ("unknown_role", [m("user", "a"), m("critic", "zzz"), m("assistant", "b")], None,
     DEFAULT + "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb<|im_end|>\n"),
    ("null_content", [m("user", None)], None, DEFAULT + "<|im_start|>user\n<|im_end|>\n"),
    ("second_system", [m("user", "a"), m("system", "S2")], None,
     DEFAULT + "<|im_start|>user\na<|im_end|>\n<|im_start|>system\nS2<|im_end|>\n"),
    ("empty", [], None, DEFAULT),
]


@pytest.mark.parametrize("name,msgs,tools,expected", CASES, ids=[c[0] for c in CASES])
def test_golden(spark, name, msgs, tools, expected):
    df = spark.createDataFrame([(msgs, tools)], f"messages {MESSAGES_TYPE}, tools array<string>")
    got = df.select(render_chat(F.col("messages"), F.col("tools")).alias("s")).first().s
    assert got == expected


@pytest.mark.parametrize("thinking,tail", [(None, "<|im_start|>assistant\n"),
                                          (True, "<|im_start|>assistant\n"),
                                          (False, "<|im_start|>assistant\n<think>\n\n</think>\n\n")])
def test_generation_tail(spark, thinking, tail):
    df = spark.createDataFrame([([m("user", "hi")],)], f"messages {MESSAGES_TYPE}")
    got = df.select(render_chat(F.col("messages"), add_generation_prompt=True,
                                enable_thinking=thinking).alias("s")).first().s
    assert got == DEFAULT + "<|im_start|>user\nhi<|im_end|>\n" + tail


def test_choose_tools(spark):
    rows = [([m("system", "S")], ["t"]), ([m("user", "u")], ["t"]), ([m("system", "S")], []),
            ([m("system", "S")], None)]
    df = spark.createDataFrame(rows, f"messages {MESSAGES_TYPE}, f array<string>")
    got = [r.x for r in df.select(choose_tools(F.col("messages"), F.col("f")).alias("x")).collect()]
    assert got == [["t"], None, None, None]
