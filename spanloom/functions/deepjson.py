"""JSON of any depth: reading, writing and changing strings without recursion.

Documents of ordinary depth go through the standard library; deeper ones, which it
refuses, are read and written with a stack of their own.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

_TOKEN = re.compile(r'[ \t\n\r]*(?:(?P<mark>[\[\]{}:,])|(?P<string>"(?:[^"\\]|\\.)*")|(?P<other>[^\s\[\]{}:,"]+))', re.S)
_ABSENT = object()


def loads(text: str):
    """The document; ``ValueError`` for what isn't JSON, at any depth."""
    try:
        return json.loads(text)
    except RecursionError:
        return _read(text)


def _read(text: str):
    open_, keys, top, at, want = [], [], _ABSENT, 0, "value"
    while at < len(text):
        m = _TOKEN.match(text, at)
        if m is None:
            if text[at:].strip(" \t\n\r"):
                raise ValueError(f"no JSON at {at}")
            break
        at, mark = m.end(), m["mark"]
        if mark == ":" and want == "colon":
            want = "value"
            continue
        if mark == "," and want == "next" and open_:
            want = "key" if isinstance(open_[-1], dict) else "value"
            continue
        if mark in ("]", "}"):
            empty = open_ and not open_[-1] and want == ("key" if mark == "}" else "value")
            if not open_ or (mark == "}") != isinstance(open_[-1], dict) or not (want == "next" or empty):
                raise ValueError(f"{mark} at {at - 1}")
            value = open_.pop()
            keys.pop()
            want = "next"
            continue
        if want == "key":
            if m["string"] is None:
                raise ValueError(f"no key at {at}")
            keys[-1], want = json.loads(m["string"]), "colon"
            continue
        if want != "value" or mark in (":", ","):
            raise ValueError(f"unexpected {m[0].strip()} at {at}")
        value = [] if mark == "[" else {} if mark == "{" else json.loads(m["string"] or m["other"])
        if not open_:
            if top is not _ABSENT:
                raise ValueError("more than one document")
            top = value
        elif isinstance(open_[-1], dict):
            open_[-1][keys[-1]] = value
        else:
            open_[-1].append(value)
        want = "next"
        if mark:
            open_.append(value)
            keys.append(None)
            want = "key" if mark == "{" else "value"
    if open_ or top is _ABSENT:
        raise ValueError("the document ends early")
    return top


def dumps(value) -> str:
    """The document's text, as :func:`json.dumps` writes it without escapes for other scripts."""
    try:
        return json.dumps(value, ensure_ascii=False)
    except RecursionError:
        pass
    out, todo = [], [value]
    plain = lambda x: json.dumps(x, ensure_ascii=False)
    while todo:
        x = todo.pop()
        if isinstance(x, _Raw):
            out.append(x.text)
        elif isinstance(x, dict):
            parts = [p for i, (k, v) in enumerate(x.items()) for p in (_Raw((", " if i else "") + plain(k) + ": "), v)]
            todo += [_Raw("}"), *reversed(parts), _Raw("{")]
        elif isinstance(x, list):
            parts = [p for i, v in enumerate(x) for p in ((_Raw(", "), v) if i else (v,))]
            todo += [_Raw("]"), *reversed(parts), _Raw("[")]
        else:
            out.append(plain(x))
    return "".join(out)


class _Raw:
    __slots__ = ("text",)

    def __init__(self, text: str) -> None:
        self.text = text


def map_strings(value, change: Callable[[str], str]):
    """The document with every string value changed in place; keys stay."""
    if isinstance(value, str):
        return change(value)
    todo = [value]
    while todo:
        x = todo.pop()
        for k, v in list(x.items() if isinstance(x, dict) else enumerate(x) if isinstance(x, list) else ()):
            if isinstance(v, str):
                x[k] = change(v)
            elif isinstance(v, (dict, list)):
                todo.append(v)
    return value
