"""Parsers, validators and dialects on hand-written cases."""

from __future__ import annotations

import json

import pytest
from hypothesis import given
from hypothesis import strategies as st

from spanloom.functions import xmlcalls as x


def tool(body: str) -> str:
    return f"<tool_use><tool_name>a</tool_name><parameter>{body}</parameter></tool_use>"


@pytest.mark.parametrize(
    ("text", "valid"),
    [
        (None, True), ("", True), ("no tag", True), (tool("<q>1</q>"), True), ("<tool_use><tool_name>a</tool_name></tool_use>", False), (tool("<q>1</p>"), False),
        (tool("<x/>"), True), (tool("<x />"), False), (tool("<br>"), True), (tool("<!-- <q> -->"), True), ("<tool_use>", False), (tool("<q>1</q>") + " <tool_use>", True),
        ("<sub-agent><agent_name>r</agent_name><message>m</message></sub-agent>", True), ("<sub-agent><agent_name>r</agent_name><message>m</message><history>h</history></sub-agent>", False),
        ("<use_parallel_tool_calls></use_parallel_tool_calls>", False), ("<use_parallel_tool_calls><parallel_tool><tool_name>a</tool_name><parameter></parameter></parallel_tool></use_parallel_tool_calls>", True),
        ("<use_parallel_sub_agents><parallel_agent><agent_name>r</agent_name><message>m</message></parallel_agent><parallel_agent></use_parallel_sub_agents>", False),
        ("<use_batch_agent><agent_name>r</agent_name><input_data_source><file_name>f</file_name><format>jsonl</format></input_data_source><message>m</message></use_batch_agent>", True),
    ],
)
def test_validity(text, valid):
    assert (not x.message_errors(text)) == valid


def test_corrected_mode_closes_spaced_tags():
    assert not x.tag_errors("<x />", strict=False) and x.tag_errors("<x />")


def test_modes_differ():
    batch = "<use_batch_agent><agent_name>r</agent_name><input_data_source><file_name>f</file_name><format>j</format></input_data_source><message>m</message></use_batch_agent>"
    assert not x.message_errors(batch, "full") and x.message_errors(batch, "tools")


def test_extraction_is_by_category():
    text = "x <sub-agent><agent_name>r</agent_name><message>go</message></sub-agent> y " + tool("<q>1 &amp; 2</q>") + " z"
    rest, calls = x.extract_calls(text)
    assert rest == "x  y  z"
    assert [n for n, _ in calls] == ["a", "r_sub_agent"]
    assert json.loads(calls[0][1]) == {"q": "1 & 2"}


def test_extraction_recovers():
    assert json.loads(x.extract_calls(tool("<q>a & b</q>"))[1][0][1]) == {"q": "a & b"}
    assert json.loads(x.extract_calls(tool("<code>if a < b and c > d: <p></code>"))[1][0][1])["code"].startswith("if a")
    assert x.extract_calls("<tool_use><tool_name>a</tool_name><parameter><q>1</q></parameter>")[1][0][0] == "a"  # closer restored
    assert x.extract_calls("<tool_use>nothing</tool_use>") == ("<tool_use>nothing</tool_use>", [])
    assert x.extract_calls(None) == ("", [])


@pytest.mark.parametrize(
    ("body", "found"),
    [
        ("<tool_name>a</tool_name><parameter><q><b>1</b></q></parameter>", {"q": "1"}),  # well-formed as it is: the text of the inner element
        ("<tool_name>a</tool_name><parameter><q>x<br>y</q><n>2</n></parameter>", {"q": "x<br>y", "n": "2"}),  # values as text
        ("<tool_name>a</tool_name><parameter><q>1 & 2</q></parameter>", {"q": "1 & 2"}),  # bare ampersands
        ("<TOOL_NAME>a</TOOL_NAME> < <Parameter><q>1</q></Parameter>", {"q": "1"}),  # name and block alone
        ("<tool_name>a</tool_name><parameter><q>1</parameter>", {}),  # by position alone, no parameter is whole
        ("<tool_name>a</tool_name> & < <parameter><sub-x>1 & </sub-x></parameter>", {"sub-x": "1 &"}),
    ],
)
def test_recovery_steps(body, found):
    ((name, arguments),) = x.extract_calls(f"<tool_use>{body}</tool_use>")[1]
    assert name == "a" and json.loads(arguments) == found


def test_tags_and_spans():
    assert [(t.name, t.at, t.closer, t.empty, t.slashed) for t in x.tags("a < b <q x='1'/> <p/></p ><1>")] == [("q", 6, False, False, True), ("p", 17, False, True, True), ("p", 21, True, False, False)]
    assert [s.body for s in x.spans("<a>1</a><a><a>2</a></a>", "a")] == ["1", "<a>2"] and x.plain("<a>1<b></a><a><a>2</a>", "a") == "2"


def test_parallel_and_batch():
    text = "<use_parallel_tool_calls><parallel_tool><tool_name>t</tool_name><parameter><k>v</k></parameter></parallel_tool></use_parallel_tool_calls>"
    text += "<use_batch_agent><agent_name>b</agent_name><input_data_source><file_name>f</file_name></input_data_source><message>m</message></use_batch_agent>"
    rest, calls = x.extract_calls(text)
    assert rest == "" and [n for n, _ in calls] == ["t", "b_sub_agent"]
    assert json.loads(calls[1][1]) == {"batch_mode": True, "input_file": "f", "format": "jsonl", "message_template": "m"}


CALL = "<tool_use><tool_name>lookup</tool_name><parameter><city>Oslo</city><n>2</n></parameter></tool_use>"


@pytest.mark.parametrize(
    ("dialect", "text"),
    [
        ("qwen", "<tool_call>\n<function=lookup>\n<parameter=city>Oslo</parameter>\n<parameter=n>2</parameter>\n</function>\n</tool_call>"),
        ("minimax", "<invoke name=lookup>\n<parameter name=city>Oslo</parameter>\n<parameter name=n>2</parameter>\n</invoke>"),
        ("glm", "<tool_call>lookup\n<arg_key>city</arg_key>\n<arg_value>Oslo</arg_value>\n<arg_key>n</arg_key>\n<arg_value>2</arg_value>\n</tool_call>"),
        ("openrouter", "<lookup>\n<city>Oslo</city>\n<n>2</n>\n</lookup>"),
        ("deepseek", '<｜tool▁calls▁begin｜><｜tool▁call▁begin｜>lookup<｜tool▁sep｜>{"city": "Oslo", "n": "2"}<｜tool▁call▁end｜><｜tool▁calls▁end｜>'),
    ],
)
def test_dialects(dialect, text):
    assert x.rewrite_message(f"a {CALL} b", dialect) == f"a {text} b"
    assert x.rewrite_message("<tool_use><tool_name>a<b</tool_name></tool_use>", dialect) == "<tool_use><tool_name>a<b</tool_name></tool_use>"


def test_agents_in_dialects():
    agent = "<sub-agent><agent_name>r</agent_name><message>m</message><history>h</history></sub-agent>"
    assert x.rewrite_message(agent, "openrouter") == "<sub-agent>\n<agent_name>r</agent_name>\n<message>m</message>\n<history>h</history>\n</sub-agent>"
    batch = "<use_batch_agent><agent_name>r</agent_name><input_data_source><file_name>f</file_name></input_data_source><message>m</message></use_batch_agent>"
    assert "<input_data_source>f|jsonl</input_data_source>" in x.rewrite_message(batch, "openrouter")


def test_leaves():
    doc = json.dumps([{"d": CALL, "n": 1, "l": ["x"]}])
    out = json.loads(x.rewrite_leaves(doc, "qwen"))
    assert out[0]["d"].startswith("<tool_call>") and out[0]["n"] == 1 and out[0]["l"] == ["x"]
    assert x.rewrite_leaves("no json", "qwen") == "no json" and x.rewrite_leaves(None, "qwen") is None


@given(st.text(alphabet="<>/ab&tool_use \n", max_size=80))
def test_parsers_never_raise(text):
    x.message_errors(text)
    x.message_errors(text, "tools")
    x.extract_calls(text)
    for d in x.DIALECTS:
        x.rewrite_message(text, d)
