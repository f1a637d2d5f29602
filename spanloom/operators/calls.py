"""Tool calls: extraction, pairing with results, tool and sub-agent definitions, workflow edges."""

import hashlib
import re
from collections import deque

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import xmlcalls
from ..functions.text import RESULT_PREFIX, call_id, tool_results, xml_params

CALLS = "struct<content:string,calls:array<struct<name:string,arguments:string>>>"


def call_extractor():
    """Arrow-batched UDF from a text to its text without calls and its calls."""

    @F.pandas_udf(CALLS)
    def extract(text: pd.Series) -> pd.DataFrame:
        found = [xmlcalls.extract_calls(t) for t in text]
        return pd.DataFrame({"content": [c for c, _ in found], "calls": [[{"name": n, "arguments": a} for n, a in calls] for _, calls in found]})

    return extract


def extract_calls(messages: DataFrame, text_col: str = "content", keys: tuple[str, ...] = ("trace_id", "span_id", "msg_idx")) -> DataFrame:
    """``messages`` plus ``clean_content`` and ``tool_calls`` (array<struct<id,type,name,arguments>>).

    Only messages with a call tag go through the parser (one Arrow-batched UDF);
    the others pass by.  Ids depend on ``keys`` and the call's place.
    """
    tagged = F.coalesce(F.col(text_col).rlike("<(tool_use|sub-agent|use_parallel_tool_calls|use_parallel_sub_agents|use_batch_agent)>"), F.lit(False))
    none = F.expr("cast(array() as array<struct<id:string,type:string,name:string,arguments:string>>)")
    plain = messages.filter(~tagged).withColumn("clean_content", F.col(text_col)).withColumn("tool_calls", none)
    parsed = messages.filter(tagged).withColumn("__x", call_extractor()(F.col(text_col)))
    made = F.transform("__x.calls", lambda c, i: F.struct(call_id(*[F.col(k) for k in keys], i).alias("id"), F.lit("function").alias("type"), c["name"].alias("name"), c["arguments"].alias("arguments")))
    return plain.unionByName(parsed.withColumn("clean_content", F.col("__x.content")).withColumn("tool_calls", made).drop("__x"))


def simple_calls(text: Column) -> Column:
    """array<struct<name,params>> of well-formed ``<tool_use>`` blocks without nesting, by expressions alone."""
    bodies = F.regexp_extract_all(text, F.lit(r"(?s)<tool_use>(.*?)</tool_use>"), F.lit(1))
    return F.transform(bodies, lambda b: F.struct(F.trim(F.regexp_extract(b, r"(?s)<tool_name>(.*?)</tool_name>", 1)).alias("name"), xml_params(F.regexp_extract(b, r"(?s)<parameter>(.*?)</parameter>", 1)).alias("params")))


def pair_results(messages: Column, call: str = "struct<id:string,name:string>") -> Column:
    """The messages with each message of tool results replaced by one ``tool`` message per result, ids matched.

    ``messages`` is array<struct<role,content,tool_calls>> in order, ``call`` the
    type of a call (with ``id`` and ``name``).  A result takes the earliest pending
    call of its name, else the earliest pending call, else a new id; what is
    pending stays so across turns.  Other messages keep their calls.
    """
    out = f"array<struct<role:string,content:string,name:string,tool_call_id:string,tool_calls:array<{call}>>>"
    none = F.expr(f"cast(array() as array<{call}>)")
    zero = F.struct(none.alias("queue"), F.expr(f"cast(array() as {out})").alias("out"))

    def message(role: Column, content: Column, name: Column, ident: Column, made: Column) -> Column:
        return F.struct(role.alias("role"), content.alias("content"), name.alias("name"), ident.alias("tool_call_id"), made.alias("tool_calls"))

    def emit(acc: Column, r: Column) -> Column:
        queue = acc["queue"]
        at = F.array_position(F.transform(queue, lambda c: c["name"]), r["name"])
        at = F.when(at > 0, at).when(F.size(queue) > 0, F.lit(1)).otherwise(F.lit(0)).cast("int")
        fresh = call_id(F.size(acc["out"]), r["name"])
        ident = F.when(at > 0, F.coalesce(F.get(queue, at - 1)["id"], fresh)).otherwise(fresh)
        made = message(F.lit("tool"), r["content"], r["name"], ident, F.lit(None).cast(f"array<{call}>"))
        return F.struct(F.filter(queue, lambda c, i: i != at - 1).alias("queue"), F.concat(acc["out"], F.array(made)).alias("out"))

    def step(acc: Column, m: Column) -> Column:
        is_result = F.coalesce((m["role"] == "user") & m["content"].startswith(RESULT_PREFIX), F.lit(False))
        passed = message(m["role"], m["content"], F.lit(None).cast("string"), F.lit(None).cast("string"), m["tool_calls"])
        queue = F.when(m["role"] == "assistant", F.concat(acc["queue"], F.coalesce(m["tool_calls"], none))).otherwise(acc["queue"])
        kept = F.struct(queue.alias("queue"), F.concat(acc["out"], F.array(passed)).alias("out"))
        return F.when(is_result, F.aggregate(tool_results(m["content"]), acc, emit)).otherwise(kept)

    return F.aggregate(messages, zero, step, lambda acc: acc["out"])


_RESULT = re.compile(r"<tool_result>\s*<tool_name>([^<]+)</tool_name>\s*<result>(.*?)</result>\s*</tool_result>", re.S)


class _Pairing:
    """A conversation's messages in order, one by one; what is kept between them is the queue of calls without a result.

    Pending calls lie in arrival order and, by name, in queues of their own, so a
    result finds its call in constant time however many are pending.
    """

    def __init__(self) -> None:
        self.waiting: dict[int, tuple] = {}
        self.by_name: dict[str, deque] = {}
        self.order, self.calls, self.made = deque(), 0, 0

    def _take(self, name: str) -> str | None:
        for queue in (self.by_name.get(name, ()), self.order):
            while queue:
                if (call := self.waiting.pop(queue.popleft(), None)) is not None:
                    return call[0]
        return None

    def eval(self, row):
        at, role, content = row["at"], row["role"], row["content"]
        if role == "user" and content is not None and content.startswith(RESULT_PREFIX):
            found = [(n.strip(), c.strip()) for n, c in _RESULT.findall(content)] or [("unknown_tool", content.replace(RESULT_PREFIX, "").strip())]
            for k, (name, text) in enumerate(found):
                ident = self._take(name)
                self.made += 1
                yield at, k, "tool", text, name, ident if ident is not None else "call_" + hashlib.md5(f"{at}:{k}:{name}".encode()).hexdigest(), None
            return
        if role == "assistant":
            for call in row["tool_calls"] or ():
                self.waiting[self.calls] = (call["id"], call["name"])
                self.by_name.setdefault(call["name"], deque()).append(self.calls)
                self.order.append(self.calls)
                self.calls += 1
        yield at, 0, role, content, None, None, row["tool_calls"]


def paired_rows(messages: DataFrame, keys: list[str]) -> DataFrame:
    """Messages as rows (``keys``, at, role, content, tool_calls) with tool results paired, however long a conversation is.

    The same rules as :func:`pair_results`, over a table partitioned by the keys and ordered
    by ``at``: messages stream through a table function that keeps the pending
    calls only, so no conversation is ever one row.  A result without a pending call gets an id of
    its place.  Rows come out with ``k``, the number of a result in its message.
    """
    call = messages.schema["tool_calls"].dataType.simpleString()
    kinds = {c: messages.schema[c].dataType.simpleString() for c in [*keys, "at"]}
    shape = ", ".join(f"{c} {t}" for c, t in kinds.items()) + f", k int, role string, content string, name string, tool_call_id string, tool_calls {call}"

    class Pair:
        def __init__(self) -> None:
            self.pairing = _Pairing()

        def eval(self, row):
            head = tuple(row[c] for c in keys)
            for out in self.pairing.eval(row):
                yield (*head, *out)

    pair = F.udtf(Pair, returnType=shape)
    return pair(messages.select(*keys, "at", "role", "content", "tool_calls").asTable().partitionBy(*keys).orderBy("at")).select("*")


def tool_definition(name: Column, description: Column, parameters: Column) -> Column:
    return F.struct(F.lit("function").alias("type"), F.struct(name.alias("name"), description.alias("description"), parameters.alias("parameters")).alias("function"))


def sub_agent_definition(agent: Column, description: Column) -> Column:
    """``<agent>_sub_agent(message)``."""
    schema = F.lit('{"type": "object", "properties": {"message": {"type": "string", "description": "Message for the sub-agent"}}, "required": ["message"]}')
    return tool_definition(F.concat(agent, F.lit("_sub_agent")), F.coalesce(description, F.concat(F.lit("Sub-agent "), agent)), schema)


def definition_from_text(name: Column, text: Column) -> Column:
    """A tool definition from prose: the parameters are the elements of its ``Usage:`` block."""
    usage = F.regexp_extract(text, r"(?s)Usage:.*?<parameter>(.*?)</parameter>", 1)
    keys = F.transform(xml_params(usage), lambda p: p["k"])
    body = F.array_join(F.transform(keys, lambda k: F.concat(F.lit('"'), k, F.lit('": {"type": "string"}'))), ", ")
    head = F.trim(F.split_part(text, F.lit("Usage:"), F.lit(1)))
    return tool_definition(name, head, F.concat(F.lit('{"type": "object", "properties": {'), body, F.lit("}}")))


def agent_tools(agents: DataFrame, tools: DataFrame, agent: str = "agent_name", names: str = "tools", tool: str = "tool_name", parts: int | None = None) -> DataFrame:
    """(agent, tool, all columns of tools): each name on an agent's list that is a tool; misses are dropped.

    ``names`` is a list, or a single name where an agent has a row for each: such rows needn't be gathered first.
    With ``parts`` pairs are dealt out to so many tasks where repeats are dropped and where the tables are joined, so that a task's share is small however many there are.
    """
    name = F.explode(names) if agents.schema[names].dataType.typeName() == "array" else F.col(names)
    listed = agents.select(agent, name.alias(tool))
    if parts:
        listed, tools = listed.repartition(parts, agent, tool), tools.repartition(parts, tool)
    return listed.distinct().join(tools, tool)


def agent_mcp_tools(agents: DataFrame, servers: DataFrame, server_tools: DataFrame) -> DataFrame:
    """agent -> its servers -> their tools."""
    listed = agents.select("agent_name", F.explode("mcp_servers").alias("server")).distinct()
    return listed.join(servers, "server").join(server_tools, "server")


def workflow_successors(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(src, dst) of the edges between two nodes of type ``agent``."""
    agents = nodes.filter("type = 'agent'").select("id")
    return edges.join(agents.withColumnRenamed("id", "src"), "src", "left_semi").join(agents.withColumnRenamed("id", "dst"), "dst", "left_semi").select("src", "dst")


#: State tools that need no registration.
STATE_TOOLS = ["StateSet", "StateGet", "StateAppend"]


def unregistered_tools(calls: DataFrame, tools: DataFrame, name: str = "tool_name") -> DataFrame:
    """Calls of tools that aren't registered; state tools need not be."""
    return calls.filter(~F.col(name).cast("string").isin(STATE_TOOLS)).join(tools.select(name).distinct(), name, "left_anti")
