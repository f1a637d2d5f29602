"""Parsing and checking of XML tool calls in model output: the parts that need a stack or a real XML parser.

All functions are total: they take any string and never raise, so that they can
run in Arrow-batched UDFs on unguarded rows.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Callable, Iterator
from functools import reduce
from typing import NamedTuple
from xml.etree import ElementTree

from . import deepjson
from .text import CALL_TAGS

# ------------------------------------------------------------------- tags

# A tag's name begins with a letter or an ideograph and goes on with word characters, ideographs, colons or hyphens.
_NAME = re.compile("[A-Za-z\u4e00-\u9fff][\\w\u4e00-\u9fff:-]*")
#: HTML elements that need no closer.
_VOID = {"br", "img", "hr", "input", "meta", "link"}
_ASCII_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


class Tag(NamedTuple):
    """A tag of a text: ``/name`` for a closer; whether it ends by ``/>`` right after its name, and at all."""

    name: str
    at: int
    closer: bool
    empty: bool
    slashed: bool


def tags(text: str) -> Iterator[Tag]:
    """The tags of a text in order; a ``<`` that begins no tag is text."""
    at, last = text.find("<"), text.rfind(">")
    while 0 <= at < last:  # no tag ends beyond it, so no search for an end runs through the rest in vain
        closer = text.startswith("/", at + 1)
        name = _NAME.match(text, at + 1 + closer)
        end = -1
        if name:
            after = text[name.end() : name.end() + 2]
            if after[:1] == ">":
                end = name.end()
            elif after == "/>":
                end = name.end() + 1
            elif after[:1].isspace():
                end = text.find(">", name.end())
        if end >= 0:
            yield Tag(name[0], at, closer, end == name.end() + 1 and text[end - 1] == "/", text[end - 1] == "/")
        at = text.find("<", at + 1 if end < 0 else end)


class Span(NamedTuple):
    """A block ``<tag>...</tag>``: where it begins and ends, and what it holds."""

    start: int
    end: int
    body: str


def spans(text: str, tag: str, any_case: bool = False) -> list[Span]:
    """The blocks of a tag, each up to its first closer, from left to right."""
    seen, opener, closer = text.translate(_ASCII_LOWER) if any_case else text, f"<{tag}>", f"</{tag}>"
    out, at = [], 0
    while (start := seen.find(opener, at)) >= 0 and (stop := seen.find(closer, start + len(opener))) >= 0:
        at = stop + len(closer)
        out.append(Span(start, at, text[start + len(opener) : stop]))
    return out


def first(text: str, tag: str, any_case: bool = False) -> str | None:
    """What the first block of a tag holds; None without one."""
    return next((s.body for s in spans(text, tag, any_case)), None)


def plain(text: str, tag: str, any_case: bool = False) -> str | None:
    """What the first block of a tag without markup inside holds; None without one."""
    for s in spans(text, tag, any_case):
        folded = s.body.translate(_ASCII_LOWER) if any_case else s.body
        body = s.body[folded.rfind(f"<{tag}>") + len(tag) + 2 :] if f"<{tag}>" in folded else s.body
        if body and "<" not in body:
            return body
    return None


def replaced(text: str, found: list[Span], by: Callable[[Span], str | None]) -> str:
    """The text with each span's replacement; None leaves it."""
    out, at = [], 0
    for s in found:
        new = by(s)
        if new is not None:
            out += [text[at : s.start], new]
            at = s.end
    return "".join([*out, text[at:]])


# ---------------------------------------------------------------- recovery


def _tree(body: str) -> ElementTree.Element | None:
    try:
        return ElementTree.fromstring(f"<root>{body}</root>")
    except ElementTree.ParseError:
        return None


def _values_as_text(body: str) -> str:
    """The first parameter block with each value that holds markup escaped."""
    block = first(body, "parameter")
    if block is None:
        return body
    out, at = [], 0
    for tag in tags(block):
        if tag.at < at or tag.closer or not {":", "-"}.isdisjoint(tag.name) or block[tag.at :].partition(">")[0] != f"<{tag.name}":
            continue  # inside of a value, or no plain opener
        start = tag.at + len(tag.name) + 2
        stop = block.find(f"</{tag.name}>", start)
        if stop >= 0:
            value = block[start:stop]
            out += [block[at:start], html.escape(value) if {"<", ">"} <= set(value) else value]
            at = stop
    return body.replace(block, "".join([*out, block[at:]]))


def _bare_ampersands(body: str) -> str:
    return body.replace("&", "&amp;")


def _name_and_block(body: str) -> str:
    """Nothing but the name and the parameter block, whatever stands around them."""
    name, block = plain(body, "tool_name", any_case=True), first(body, "parameter", any_case=True)
    return f"<tool_name>{'unknown' if name is None else name.strip()}</tool_name>" + ("" if block is None else f"<parameter>{block.strip()}</parameter>")


#: In this order.  Trimming lines isn't among them: white space never makes a body well-formed.
RECOVERY: list[Callable[[str], str]] = [str, _values_as_text, _bare_ampersands, _name_and_block]


def robust_tree(body: str) -> ElementTree.Element | None:
    """The first recovery step whose result is well-formed XML; None if none is."""
    return next((t for t in (_tree(fix(body)) for fix in RECOVERY) if t is not None), None)


# -------------------------------------------------------------- extraction


def restore_closing(text: str) -> str:
    for tag in CALL_TAGS:
        opened, closed = f"<{tag}>", f"</{tag}>"
        if opened in text and not text.rstrip().endswith(closed) and text.count(opened) > text.count(closed):
            text += closed
    return text


# Parameters by pattern, and a sub-agent call, which holds its two parts and nothing else.
_ANY_PARAM = re.compile(r"<([^>]+)>(.*?)</\1>", re.S)
_SUB_AGENT = re.compile(r"<sub-agent>(\s*<agent_name>[^<]+</agent_name>\s*<message>.*?</message>\s*)</sub-agent>", re.S)


def pattern_params(body: str) -> dict[str, str]:
    if "<" in body and ">" in body:
        return {k.strip(): v.strip() for k, v in _ANY_PARAM.findall(body)}
    return {"content": body.strip()} if body.strip() else {}


def _call(name: str, arguments: dict) -> tuple[str, str]:
    return name.strip(), json.dumps(arguments, ensure_ascii=False)


def _tool(body: str) -> tuple[str, str] | None:
    root = robust_tree(body.strip())
    if root is None:  # by position alone
        name, block = first(body, "tool_name"), first(body, "parameter")
        return None if name is None else _call(name, {} if block is None else pattern_params(block))
    name, block = root.find("tool_name"), root.find("parameter")
    if name is None:
        return None
    values = {p.tag: html.unescape(p.text if p.text is not None else "".join(p.itertext())).strip() for p in (() if block is None else block)}
    return _call(name.text or "", values)


def _agent(body: str) -> tuple[str, str] | None:
    name, message = plain(body, "agent_name"), first(body, "message")
    return None if name is None or message is None else _call(f"{name.strip()}_sub_agent", {"message": message.strip()})


def _batch(body: str) -> tuple[str, str] | None:
    name = first(body, "agent_name")
    if name is None:
        return None
    part = lambda tag, default: default if (found := first(body, tag)) is None else found.strip()
    return _call(f"{name.strip()}_sub_agent", {"batch_mode": True, "input_file": part("file_name", ""), "format": part("format", "jsonl"), "message_template": part("message", "")})


Parser = Callable[[str], tuple[str, str] | None]
#: Categories in the order in which they are taken: the block's tag, and the parser of its body or of the blocks inside.
_CATEGORIES: list[tuple[str, Parser | list[tuple[str, Parser]]]] = [
    ("tool_use", _tool),
    ("sub-agent", _agent),
    ("use_parallel_tool_calls", [("parallel_tool", _tool)]),
    ("use_parallel_sub_agents", [("parallel_agent", _agent), ("parallel_tool", _tool)]),
    ("use_batch_agent", _batch),
]


def extract_calls(text: str | None) -> tuple[str, list[tuple[str, str]]]:
    """(text without its calls, [(name, arguments JSON)]): category by category, in the order of the categories.

    Null is an empty text without calls.
    """
    text, calls = restore_closing(text or ""), []
    for tag, how in _CATEGORIES:

        def take(block: Span, how=how) -> str | None:
            inner = [how(block.body)] if callable(how) else [parse(s.body) for t, parse in how for s in spans(block.body, t)]
            if callable(how) and inner == [None]:
                return None  # no call: the block stays
            calls.extend(c for c in inner if c is not None)
            return ""

        found = [Span(m.start(), m.end(), m[1]) for m in _SUB_AGENT.finditer(text)] if tag == "sub-agent" else spans(text, tag)
        text = replaced(text, found, take)
    return text.strip(), calls


# -------------------------------------------------------------- validation


def _without_comments(text: str) -> str:
    out, at = [], 0
    while (start := text.find("<!--", at)) >= 0 and (stop := text.find("-->", start + 4)) >= 0:
        out.append(text[at:start])
        at = stop + 3
    return "".join([*out, text[at:]])


def tag_errors(text: str, strict: bool = True) -> list[str]:
    """One error for each tag without its partner.  Without ``strict``, a slash after attributes or a space closes a tag too."""
    errors: list[str] = []
    waiting: list[Tag] = []
    for tag in tags(_without_comments(text)):
        alone = tag.empty or (tag.slashed and not strict) or (tag.name.lower() in _VOID and not tag.closer)
        if not alone and not tag.closer:
            waiting.append(tag)
        elif not alone:
            partner = waiting.pop() if waiting else None  # a wrong partner is used up too
            if partner is None:
                errors.append(f"</{tag.name}> at {tag.at} closes nothing")
            elif partner.name != tag.name:
                errors.append(f"<{partner.name}> at {partner.at} meets </{tag.name}> at {tag.at}")
    errors.extend(f"<{tag.name}> at {tag.at} is not closed" for tag in waiting)
    return errors


def _blocks(text: str, tag: str, errors: list[str]) -> list[tuple[str, str]]:
    """(description, body) of the closed blocks; an opener without any closed block is an error."""
    found = [(f"{tag} #{i}", s.body) for i, s in enumerate(spans(text, tag), 1)]
    if not found and f"<{tag}>" in text:
        errors.append(f"{tag} is not closed")
    return found


def _check_tool(what: str, body: str, mode: str, strict: bool, errors: list[str]) -> None:
    name, block = first(body, "tool_name"), first(body, "parameter")
    if name is None or block is None:
        errors.append(f"{what} lacks {'tool_name' if name is None else 'parameter'}")
        return
    errors += [f"{what}: {e}" for e in tag_errors(block, strict)]
    if mode == "tools" and name.strip().startswith("agent:") and first(block, "message") is None:
        errors.append(f"{what} lacks message")


def _check_agent(what: str, body: str, errors: list[str]) -> None:
    errors += [f"{what} lacks {t}" for t in ("agent_name", "message") if first(body, t) is None]
    history = first(body, "history")
    if history is not None and not ("<![CDATA[" in history and "]]>" in history):
        errors.append(f"{what}: history is not CDATA")


def _tools(text: str, mode: str, strict: bool, errors: list[str]) -> None:
    for what, body in _blocks(text, "tool_use", errors):
        _check_tool(what, body, mode, strict, errors)


def _agents(text: str, mode: str, strict: bool, errors: list[str]) -> None:
    for what, body in _blocks(text, "sub-agent", errors):
        _check_agent(what, body, errors)


def _inner(what: str, body: str, tag: str, errors: list[str]) -> list[tuple[str, str]]:
    found = [(f"{what} {tag} #{i}", s.body) for i, s in enumerate(spans(body, tag), 1)]
    if body.count(f"<{tag}>") > len(found):
        errors.append(f"{what} has a {tag} that is not closed")
    return found


def _parallel_tools(text: str, mode: str, strict: bool, errors: list[str]) -> None:
    for what, body in _blocks(text, "use_parallel_tool_calls", errors):
        inner = _inner(what, body, "parallel_tool", errors)
        if not inner:
            errors.append(f"{what} holds no parallel_tool")
        for w, b in inner:
            _check_tool(w, b, mode, strict, errors)


def _parallel_agents(text: str, mode: str, strict: bool, errors: list[str]) -> None:
    for what, body in _blocks(text, "use_parallel_sub_agents", errors):
        agents, tools = (_inner(what, body, t, errors) for t in ("parallel_agent", "parallel_tool"))
        if not agents and not tools:
            errors.append(f"{what} holds no parallel_agent or parallel_tool")
        for w, b in agents:
            _check_agent(w, b, errors)
        for w, b in tools:
            _check_tool(w, b, mode, strict, errors)


def _batches(text: str, mode: str, strict: bool, errors: list[str]) -> None:
    for what, body in _blocks(text, "use_batch_agent", errors):
        if mode == "tools":
            if not (first(body, "tool_name") or "").strip().startswith("agent:"):
                errors.append(f"{what} lacks a tool_name of an agent")
        elif first(body, "agent_name") is None:
            errors.append(f"{what} lacks agent_name")
        source = first(body, "input_data_source")
        errors += [f"{what} lacks input_data_source"] if source is None else [f"{what} lacks {t}" for t in ("file_name", "format") if first(source, t) is None]
        if first(body, "message") is None:
            errors.append(f"{what} lacks message")


VALIDATORS = {"full": [_tools, _agents, _parallel_tools, _parallel_agents, _batches], "tools": [_tools, _parallel_tools, _batches]}


def message_errors(text: str | None, mode: str = "full", strict: bool = True) -> list[str]:
    """All errors of a message; none for null, empty text or text without ``<``."""
    errors: list[str] = []
    if text and "<" in text:
        for check in VALIDATORS[mode]:
            check(text, mode, strict, errors)
    return errors


# ---------------------------------------------------------------- dialects


def _join(name: str, params: list[tuple[str, str]], head: str, each: str, tail: str) -> str:
    return "\n".join([head.format(name=name), *[each.format(k=k, v=v) for k, v in params], tail.format(name=name)])


# The text forms of a call in each dialect.
_FORMS = {
    "qwen": ("<tool_call>\n<function={name}>", "<parameter={k}>{v}</parameter>", "</function>\n</tool_call>"),
    "minimax": ("<invoke name={name}>", "<parameter name={k}>{v}</parameter>", "</invoke>"),
    "glm": ("<tool_call>{name}", "<arg_key>{k}</arg_key>\n<arg_value>{v}</arg_value>", "</tool_call>"),
    "openrouter": ("<{name}>", "<{k}>{v}</{k}>", "</{name}>"),
}
_DEEPSEEK = ("<｜tool▁calls▁begin｜><｜tool▁call▁begin｜>", "<｜tool▁sep｜>", "<｜tool▁call▁end｜><｜tool▁calls▁end｜>")
DIALECTS = [*_FORMS, "deepseek"]


def render(name: str, params: list[tuple[str, str]], dialect: str) -> str:
    if dialect == "deepseek":
        return f"{_DEEPSEEK[0]}{name}{_DEEPSEEK[1]}{json.dumps(dict(params), ensure_ascii=False)}{_DEEPSEEK[2]}"
    return _join(name, params, *_FORMS[dialect])


def _dialect_tree(body: str) -> ElementTree.Element | None:
    found = _tree(body)
    return found if found is not None else _tree(re.sub(r"</\w+\s*$", "", body.strip()))


def _inner_text(e: ElementTree.Element | None) -> str:
    return "" if e is None else "".join(e.itertext()).strip()


def parse_tool(body: str) -> tuple[str, list[tuple[str, str]]] | None:
    root = _dialect_tree(body)
    name = None if root is None else root.find(".//tool_name")
    if name is None:
        return None
    block = root.find(".//parameter")
    params = {p.tag: _inner_text(p) for p in (block if block is not None else [])}
    return (name.text or "").strip(), list(params.items())


def parse_agent(body: str) -> tuple[str, list[tuple[str, str]]] | None:
    root = _dialect_tree(body)
    name = None if root is None else root.find(".//agent_name")
    if name is None:
        return None
    params = [("agent_name", (name.text or "").strip()), ("message", _inner_text(root.find(".//message")))]
    history = _inner_text(root.find(".//history"))
    return "sub-agent", params + ([("history", history)] if history else [])


def parse_batch(body: str) -> tuple[str, list[tuple[str, str]]] | None:
    root = _dialect_tree(body)
    if root is None:
        return None
    name, source, where = root.find(".//agent_name"), root.find(".//input_data_source"), ""
    if source is not None:
        file, form = source.find("file_name"), source.find("format")
        where = f"{'' if file is None else (file.text or '').strip()}|{'jsonl' if form is None else (form.text or 'jsonl').strip()}"
    return "batch-agent", [("agent_name", "" if name is None else (name.text or "").strip()), ("message", _inner_text(root.find(".//message"))), ("input_data_source", where)]


def rewrite_message(text: str | None, dialect: str) -> str | None:
    """A message's calls in another dialect; blocks that can't be parsed and the parallel wrappers stay."""
    if not text or "<" not in text:
        return text

    def blocks(t: str, tag: str, parse: Callable) -> str:
        return replaced(t, spans(t, tag), lambda s: None if (found := parse(s.body)) is None else render(*found, dialect))

    def within(t: str, wrapper: str, parts: list[tuple[str, Callable]]) -> str:
        return replaced(t, spans(t, wrapper), lambda s: f"<{wrapper}>{reduce(lambda body, part: blocks(body, *part), parts, s.body)}</{wrapper}>")

    text = blocks(text, "use_batch_agent", parse_batch)
    text = within(text, "use_parallel_sub_agents", [("parallel_agent", parse_agent), ("parallel_tool", parse_tool)])
    text = within(text, "use_parallel_tool_calls", [("parallel_tool", parse_tool)])
    text = blocks(text, "sub-agent", parse_agent)
    return blocks(text, "tool_use", parse_tool)


def rewrite_leaves(document: str | None, dialect: str) -> str | None:
    """Every string in a JSON document rewritten, at any depth; what isn't JSON stays."""
    if document is None:
        return None
    try:
        return deepjson.dumps(deepjson.map_strings(deepjson.loads(document), lambda x: rewrite_message(x, dialect)))
    except ValueError:
        return document
