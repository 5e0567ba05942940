"""Chat templates as column expressions: ChatML, tools, reasoning, tool results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
#: What introduces and closes the tools in the system's turn.
TOOLS_HEAD = (
    "# Tools / Ferramentas\n\nVocê pode chamar uma ou mais funções para auxiliar na consulta do usuário.\n\n"
    "Você recebe assinaturas de funções dentro de tags XML <tools></tools>:\n<tools>"
)
TOOLS_TAIL = (
    "\n</tools>\n\nPara cada chamada de função, retorne um objeto json com o nome da função e os argumentos dentro das tags XML <tool_call></tool_call>:\n"
    '<tool_call>\n{"name": <function-name>, "arguments": <args-json-object>}\n</tool_call>'
)
#: Roles that a template shows; messages of other roles are left out.
ROLES = ("system", "user", "assistant", "tool")


def _turn(role: Column | str, content: Column, newline: bool = True) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    return F.concat(F.lit(START), role, F.lit("\n"), content, F.lit(END + ("\n" if newline else "")))


def _text(m: Column) -> Column:
    return F.coalesce(m["content"], F.lit(""))


def rendered(messages: Column, generation: bool = False) -> Column:
    """ChatML of a conversation; the assistant's contents lose line breaks at their ends; with ``generation`` its turn is opened.

    Roles are system, user and assistant, as they stand; other messages are left out.

    '' for null and empty conversations without ``generation``.
    """
    turns = F.transform(
        F.filter(messages, lambda m: m["role"].isin(*ROLES[:3])), lambda m: F.when(m["role"] == "assistant", _turn("assistant", F.regexp_replace(_text(m), r"^\n+|\n+$", ""))).otherwise(_turn(F.coalesce(m["role"], F.lit("")), _text(m)))
    )
    made = F.coalesce(F.array_join(turns, ""), F.lit(""))
    return F.concat(made, F.lit(f"{START}assistant\n")) if generation else made


def plain(messages: Column) -> Column:
    """The contents with a blank line between them; null contents are left out."""
    return F.coalesce(F.array_join(F.filter(F.transform(messages, lambda m: m["content"]), lambda c: c.isNotNull()), "\n\n"), F.lit(""))


def tools_block(tools: Column, system: Column) -> Column:
    """The system's turn with its text and the tools, one JSON a line; ``tools`` is an array of JSON strings."""
    head = F.when(F.coalesce(system, F.lit("")) != "", F.concat(system, F.lit("\n\n"))).otherwise(F.lit(""))
    return _turn("system", F.concat(head, F.lit(TOOLS_HEAD), F.lit("\n"), F.array_join(tools, "\n"), F.lit(TOOLS_TAIL)))


def last_real_turn(messages: Column) -> Column:
    """Position, from 0, of the last user message with a content that is no tool's response in tags; the last position where there is none."""

    def is_real(m: Column) -> Column:
        answer = F.startswith(_text(m), F.lit("<tool_response>")) & F.endswith(_text(m), F.lit("</tool_response>"))
        return (m["role"] == "user") & m["content"].isNotNull() & ~answer

    return F.coalesce(F.array_max(F.transform(messages, lambda m, i: F.when(is_real(m), i))), F.size(messages) - 1)


def reasoning_of(content: Column) -> Column:
    """The thought of a content, between its first opening and its last closing tag, without line breaks at its ends; '' if there is none."""
    before = F.substring_index(content, "</think>", 1)
    return F.when(F.contains(content, F.lit("</think>")), F.regexp_replace(F.substring_index(before, "<think>", -1), r"^\n+|\n+$", "")).otherwise(F.lit(""))


def answer_of(content: Column) -> Column:
    """What follows the last thought, without line breaks before it."""
    return F.when(F.contains(content, F.lit("</think>")), F.regexp_replace(F.substring_index(content, "</think>", -1), r"^\n+", "")).otherwise(content)


def tool_call(name: Column, arguments: Column) -> Column:
    """One call in its tags; ``arguments`` is JSON."""
    return F.concat(F.lit('<tool_call>\n{"name": "'), name, F.lit('", "arguments": '), F.coalesce(arguments, F.lit("{}")), F.lit("}\n</tool_call>"))


def tool_calls(calls: Column) -> Column:
    """Tool calls, an array of JSON strings, in their tags."""
    return F.array_join(F.transform(calls, lambda c: F.concat(F.lit("<tool_call>\n"), c, F.lit("\n</tool_call>"))), "\n")


def called_tools(calls: Column) -> Column:
    """Tool calls, an array of structs of ``name`` and ``arguments``, these as JSON, each in its tags; '' for null."""
    return F.coalesce(F.array_join(F.transform(calls, lambda c: tool_call(c["name"], c["arguments"])), "\n"), F.lit(""))


def rendered_with_reasoning(
    messages: Column, generation: bool = False, enable_thinking: bool | None = None, keep_thoughts: bool = True, tools: Column | None = None,
    thoughts_field: str | None = None, calls_field: str | None = None,
) -> Column:
    """ChatML where thoughts stay in the turns after the last real question alone, and tool results are put together in user turns.

    ``tools``, an array of JSON strings, opens the system's turn, where it isn't empty. ``thoughts_field`` and
    ``calls_field`` name fields of the messages with a thought apart from the content, which then stays whole, and with
    the assistant's tool calls (``called_tools``). ``enable_thinking=False`` closes an empty thought in the opened turn;
    ``keep_thoughts=False`` gives contents as they are. Every turn ends with one line break, the assistant's too: blocks
    are trimmed, line breaks behind values stay.
    """
    messages = F.filter(messages, lambda m: m["role"].isin(*ROLES))
    last = last_real_turn(messages)
    n = F.size(messages)

    def assistant(m: Column, i: Column) -> Column:
        text = _text(m)
        if keep_thoughts:
            thought, answer = reasoning_of(text), answer_of(text)
            if thoughts_field:
                apart = m[thoughts_field]
                thought = F.when(apart.isNotNull(), F.regexp_replace(apart, r"^\n+|\n+$", "")).otherwise(thought)
                answer = F.when(apart.isNotNull(), text).otherwise(answer)
            shown = (i > last) & ((i == n - 1) | (thought != ""))
            body = F.when(shown, F.concat(F.lit("<think>\n"), thought, F.lit("\n</think>\n\n"), F.regexp_replace(answer, r"^\n+", ""))).otherwise(answer)
        else:
            answer = body = text
        if calls_field:
            called = called_tools(m[calls_field])
            body = F.concat(body, F.when((called != "") & (answer != ""), F.lit("\n")).otherwise(F.lit("")), called)
        return _turn("assistant", body)

    def turn(m: Column, i: Column) -> Column:
        text = _text(m)
        first = F.coalesce(F.try_element_at(messages, i)["role"], F.lit("")) != "tool"
        final = F.coalesce(F.try_element_at(messages, i + 2)["role"], F.lit("")) != "tool"
        first = F.when(i == 0, F.lit(True)).otherwise(first)
        result = F.concat(
            F.when(first, F.lit(f"{START}user")).otherwise(F.lit("")), F.lit("\n<tool_response>\n"), text, F.lit("\n</tool_response>"), F.when(final, F.lit(f"{END}\n")).otherwise(F.lit(""))
        )
        shown = F.when(m["role"] == "tool", result).when(m["role"] == "assistant", assistant(m, i)).otherwise(_turn(m["role"], text))
        # With tools, the first system message stands in their turn.
        return shown if tools is None else F.when((i == 0) & (m["role"] == "system") & (F.size(tools) > 0), F.lit("")).otherwise(shown)

    made = F.coalesce(F.array_join(F.transform(messages, turn), ""), F.lit(""))
    if tools is not None:
        first = F.try_element_at(messages, F.lit(1))
        head = tools_block(tools, F.when(first["role"] == "system", first["content"]))
        made = F.when(F.size(tools) > 0, F.concat(head, made)).otherwise(made)
    if not generation:
        return made
    opened = f"{START}assistant\n" + ("<think>\n\n</think>\n\n" if enable_thinking is False else "")
    return F.concat(made, F.lit(opened))
