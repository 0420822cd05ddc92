"""Chat rendering (D1-D10) as one Column expression.

The chat template is fixed, so instead of interpreting it per row it is
written out as ``concat``/``transform``/``array_join`` over the message
array. Neighbour look-ups for tool runs use the element index.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed import (DEFAULT_SYSTEM, EMPTY_THINK, GENERATION_PROMPT, IM_END, IM_START,
                     TOOL_CALL_ARGS, TOOL_CALL_CLOSE, TOOL_CALL_OPEN, TOOL_RESPONSE_CLOSE,
                     TOOL_RESPONSE_OPEN, TOOLS_POSTAMBLE, TOOLS_PREAMBLE)
from .util import let

TOOL_CALL_TYPE = "array<struct<name:string,arguments:string>>"
MESSAGE_TYPE = f"struct<role:string,content:string,tool_calls:{TOOL_CALL_TYPE}>"
MESSAGES_TYPE = f"array<{MESSAGE_TYPE}>"


def _lit(s: str) -> Column:
    return F.lit(s)


def _is(c: Column, value: str) -> Column:
    return F.coalesce(c == F.lit(value), F.lit(False))


def choose_tools(messages: Column, functions: Column) -> Column:
    """The first message's tool list iff it is a non-empty system message."""
    first = F.get(messages, 0)
    return F.when(_is(first["role"], "system") & (F.coalesce(F.size(functions), F.lit(0)) > 0),
                  functions)


def _tool_calls(content: Column, calls: Column) -> Column:
    """The tool-call blocks of one assistant message."""
    def one(tc: Column, j: Column) -> Column:
        sep = F.when((j > 0) | (F.length(content) > 0), _lit("\n")).otherwise(_lit(""))
        return F.concat(sep, _lit(TOOL_CALL_OPEN), F.coalesce(tc["name"], _lit("")),
                        _lit(TOOL_CALL_ARGS), F.coalesce(tc["arguments"], _lit("")),
                        _lit(TOOL_CALL_CLOSE))
    return F.coalesce(F.array_join(F.transform(calls, one), ""), _lit(""))


def render_message(role: Column, content: Column, tool_calls: Column, is_first: Column,
                   prev_is_tool: Column, next_is_tool: Column) -> Column:
    """One message given its neighbours' roles."""
    content = F.coalesce(content, _lit(""))  # D10
    plain = F.concat(_lit(IM_START), role, _lit("\n"), content, _lit(IM_END + "\n"))  # D5
    assistant = F.concat(_lit(IM_START + "assistant\n"), content,
                         _tool_calls(content, tool_calls), _lit(IM_END + "\n"))  # D6
    tool = F.concat(F.when(prev_is_tool, _lit("")).otherwise(_lit(IM_START + "user")),
                    _lit(TOOL_RESPONSE_OPEN), content, _lit(TOOL_RESPONSE_CLOSE),
                    F.when(next_is_tool, _lit("")).otherwise(_lit(IM_END + "\n")))  # D7
    return (F.when(_is(role, "user") | (_is(role, "system") & ~is_first), plain)
            .when(_is(role, "assistant"), assistant)
            .when(_is(role, "tool"), tool)
            .otherwise(_lit("")))  # D9


def _message(m: Column, i: Column, msgs: Column) -> Column:
    n = F.size(msgs)
    prev_tool = (i > 0) & _is(F.get(msgs, i - 1)["role"], "tool")
    next_tool = (i < n - 1) & _is(F.get(msgs, i + 1)["role"], "tool")
    return render_message(m["role"], m["content"], m["tool_calls"], i == 0, prev_tool, next_tool)


def render_head(first_role: Column, first_content: Column, tools: Column | None = None) -> Column:
    """The system head from the first message (and tools)."""
    first_is_system = _is(first_role, "system")
    first_content = F.coalesce(first_content, _lit(""))
    plain = F.when(first_is_system,
                   F.concat(_lit(IM_START + "system\n"), first_content, _lit(IM_END + "\n"))
                   ).otherwise(_lit(IM_START + "system\n" + DEFAULT_SYSTEM + IM_END + "\n"))  # D3
    if tools is None:
        return plain
    with_tools = F.concat(
        _lit(IM_START + "system\n"),
        F.when(first_is_system, F.concat(first_content, _lit("\n\n"))).otherwise(_lit("")),
        _lit(TOOLS_PREAMBLE),
        F.coalesce(F.array_join(F.transform(tools, lambda t: F.concat(_lit("\n"), t)), ""), _lit("")),
        _lit(TOOLS_POSTAMBLE))  # D4
    has_tools = F.coalesce(F.size(tools) > 0, F.lit(False))
    return F.when(has_tools, with_tools).otherwise(plain)


def _head(msgs: Column, tools: Column | None) -> Column:
    first = F.get(msgs, 0)
    return render_head(first["role"], first["content"], tools)


def generation_tail(add_generation_prompt: bool = False,
                    enable_thinking: bool | None = None) -> str:
    """D8 (constant for a job)."""
    if not add_generation_prompt:
        return ""
    return GENERATION_PROMPT + (EMPTY_THINK if enable_thinking is False else "")


def render_chat(messages: Column, tools: Column | None = None,
                add_generation_prompt: bool = False,
                enable_thinking: bool | None = None) -> Column:
    """Render a message array to the prompt string."""
    def build(msgs: Column) -> Column:
        body = F.array_join(F.transform(msgs, lambda m, i: _message(m, i, msgs)), "")
        return F.concat(_head(msgs, tools), F.coalesce(body, _lit("")),
                        _lit(generation_tail(add_generation_prompt, enable_thinking)))
    return let(messages, build)


def messages_from_turns(entries: Column) -> Column:
    """Turn structs (turn, role, content) sorted by turn -> message array."""
    return F.transform(F.array_sort(entries), lambda x: F.struct(
        x["role"].alias("role"), x["content"].alias("content"),
        F.lit(None).cast(TOOL_CALL_TYPE).alias("tool_calls")))
