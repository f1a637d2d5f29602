"""File sources: JSON lines with line numbers and a dead-letter table, taxonomies, personas, framework configurations."""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..adapters import AnswerCache, ask
from ..functions import deepjson


def json_lines(spark: SparkSession, path: str) -> DataFrame:
    """(src_file, line_no, _raw, ok): every line of the files under ``path``; ``ok`` says whether it is a JSON object.

    Files are split as usual; ``line_no`` rises with the place in the file (it
    joins the split's start and the line's place in the split) but has gaps.
    """
    read = spark.read.text(path).select(F.col("_metadata.file_path").alias("src_file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("_raw"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("nth"))
    ok = F.coalesce(F.schema_of_variant(F.try_parse_json("_raw")).startswith("OBJECT"), F.lit(False))
    # a line starts at or after `start` bytes, and a split of n bytes has at most n lines
    return read.select("src_file", (F.col("start") + F.col("nth")).alias("line_no"), "_raw", ok.alias("ok"))


def dead_letters(lines: DataFrame) -> DataFrame:
    """Lines that hold text but no JSON object."""
    return lines.filter(~F.col("ok") & (F.trim("_raw") != ""))


def _text(name: str) -> Column:
    return F.get_json_object("_raw", f"$.{name}")


def spans(spark: SparkSession, path: str) -> DataFrame:
    """Observation spans; payloads keep their JSON text, bad and blank lines are left out."""
    found = json_lines(spark, path).filter("ok")
    names = {"start_time_s": "startTime", "end_time_s": "endTime", "parent_id": "parentObservationId"}
    columns = [F.col(f.name) if f.name in ("src_file", "line_no", "_raw") else _text(names.get(f.name, f.name)).alias(f.name) for f in schemas.SPANS.fields]
    return found.select(*columns)


def queries(spark: SparkSession, path: str, frameworks: list[str] | None = None, limit: int | None = None, default: str = "deer-flow") -> DataFrame:
    """Query records; a missing framework is the default one.  ``frameworks`` filters while reading; ``limit`` (0 or None: none) takes the first lines after it."""
    found = json_lines(spark, path).filter("ok")
    found = found.select("line_no", "_raw", _text("query").alias("query"), F.coalesce(_text("framework"), F.lit(default)).alias("framework"), _text("difficulty").alias("difficulty"), _text("metadata").alias("metadata"))
    if frameworks:
        found = found.filter(F.col("framework").isin(frameworks))
    return found.orderBy("line_no").limit(limit) if limit else found


def personas(spark: SparkSession, path: str) -> DataFrame:
    """Personas; other keys go to ``metadata`` as JSON."""
    found = json_lines(spark, path).filter("ok")
    rest = F.map_filter(F.from_json("_raw", "map<string,string>"), lambda k, v: ~k.isin("persona", "persona_chinese"))
    return found.select(F.col("line_no").alias("persona_idx"), F.coalesce(_text("persona"), F.lit("")).alias("persona"), F.coalesce(_text("persona_chinese"), F.lit("")).alias("persona_chinese"), F.to_json(rest).alias("metadata"))


#: Nodes of a document that leave a Python worker at once.
NODES = 10_000


def walk_tree(node: dict, framework: str) -> Iterator[tuple]:
    """Adjacency rows of a tree in depth-first order, however deep it is."""
    todo = [(node, None, 0)]
    while todo:
        x, parent, place = todo.pop()
        yield framework, x["id"], parent, x.get("en", ""), x.get("zh", ""), place
        todo += [(child, x["id"], i) for i, child in reversed(list(enumerate(x.get("children") or [])))]


def taxonomy(spark: SparkSession, document: str) -> DataFrame:
    """Adjacency rows of one taxonomy document (``framework`` and ``tree``), a few hundred nodes."""
    data = deepjson.loads(document)
    return spark.createDataFrame(list(walk_tree(data["tree"], data.get("framework", ""))), schemas.TAXONOMY_NODES)


def taxonomy_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Adjacency rows of documents (``value``), at most :data:`NODES` at once."""
    for batch in batches:
        for text in batch["value"]:
            try:
                data = deepjson.loads(text)
                tree, framework = data["tree"], data.get("framework", "")
                deque(walk_tree(tree, framework), maxlen=0)  # a document with a node that isn't one gives no rows at all
            except (ValueError, KeyError, TypeError, AttributeError):
                continue
            rows = walk_tree(tree, framework)
            while part := list(islice(rows, NODES)):
                yield pd.DataFrame(part, columns=schemas.TAXONOMY_NODES.names)


def taxonomies(spark: SparkSession, path: str) -> DataFrame:
    """Adjacency rows of all taxonomy files under ``path``; each file is parsed where it is read."""
    return spark.read.text(path, wholetext=True).mapInPandas(taxonomy_rows, schemas.TAXONOMY_NODES)


def nested_tree(nodes: list[tuple[str, str | None, str, int]], parent: str | None = None) -> list[dict]:
    """Nested documents of one framework's (id, parent_id, name, sib_pos) rows, for display."""
    made, below = {}, {}
    for ident, above, name, _ in sorted(nodes, key=lambda n: n[3]):
        made[ident] = {"id": ident, "name": name}
        below.setdefault(above, []).append(ident)
    for above, kids in below.items():
        if above in made:
            made[above]["children"] = [made[k] for k in kids]
    return [made[k] for k in below.get(parent, [])]


def taxonomy_documents(nodes: DataFrame) -> DataFrame:
    """(framework, document): each framework's tree as one document, children in their places; the reverse of :func:`taxonomies`.

    A document is one row, so its nodes meet where it is written.  A node whose
    parent is missing, or that no root leads to, is left out; frameworks without a root give no row.
    """

    def nest(pdf):
        import pandas as pd

        framework, pdf = pdf["framework"].iloc[0], pdf.drop(columns="framework").sort_values("sib_pos", kind="stable")
        ids, parents = pdf["id"].tolist(), pdf["parent_id"].tolist()
        made = {i: {"id": i, "en": en, "zh": zh} for i, en, zh in zip(ids, pdf["en"], pdf["zh"], strict=True)}
        del pdf
        root = None
        for ident, parent in zip(ids, parents, strict=True):
            if parent is None:
                root = root or made[ident]
            elif parent in made:
                made[parent].setdefault("children", []).append(made[ident])
        documents = [] if root is None else [deepjson.dumps({"framework": framework, "tree": root})]
        return pd.DataFrame({"framework": [framework] * len(documents), "document": documents}, dtype=object)

    return nodes.groupBy("framework").applyInPandas(nest, "framework string, document string")


def framework_configs(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Tables ``agents``, ``tools``, ``llm_configs``, ``nodes`` and ``edges`` of the JSON configurations under ``path``.

    A file that isn't JSON gives no rows; what is missing is null, and
    :func:`config_violations` reports it.
    """
    docs = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+\z", 1).alias("framework"), F.col("value").alias("j"))

    def table(field: str, element: str, **renamed: str) -> DataFrame:
        rows = docs.select("framework", F.explode(F.from_json(F.get_json_object("j", field), f"array<{element}>")).alias("x"))
        flat = rows.select("framework", "x.*")
        for new, old in renamed.items():
            flat = flat.withColumnRenamed(old, new)
        return flat

    return {
        "agents": table("$.agents", "struct<agent_name:string,description:string,tools:array<string>,mcp_servers:array<string>,sysprompt_path:string,llm_config:string>"),
        "tools": table("$.tools", "struct<tool_name:string,description:string,config_path:string,binding:string,input_schema:string>"),
        "llm_configs": table("$.llm_configs", "struct<llm_name:string,provider:string,model:string,max_tokens:int,temperature:double,timeout:int>"),
        "nodes": table("$.workflow.nodes", "struct<id:string,type:string>"),
        "edges": table("$.workflow.edges", "struct<`from`:string,`to`:string>", src="from", dst="to"),
    }


def yaml_as_json(spark: SparkSession, path: str) -> DataFrame:
    """(path, framework, value): YAML documents under ``path`` as JSON text; what can't be read is null.

    Read with PyYAML where it is installed, on the executors, one file a row.
    """

    @F.pandas_udf("string")
    def as_json(texts: pd.Series) -> pd.Series:
        import yaml

        def one(text: str) -> str | None:
            try:
                return json.dumps(yaml.safe_load(text), ensure_ascii=False, default=str)
            except yaml.YAMLError:
                return None

        return texts.map(one)

    docs = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value"))
    return docs.select("path", F.regexp_extract("path", r"([^/]+)/[^/]+\z", 1).alias("framework"), as_json("value").alias("value"))


def tool_schemas(tools: DataFrame, yamls: DataFrame) -> DataFrame:
    """``tools`` with ``description`` and ``input_schema`` filled from the YAML file of each tool, where it has one.

    A tool's file is the one that ``config_path`` ends in, else ``tools/<name>.yaml``, else ``tools/<name>.yml``.
    """
    files = yamls.select(F.regexp_replace("path", r"^.*/(?=[^/]+/[^/]+\z)", "").alias("__at"), F.col("value").alias("__doc")).dropDuplicates(["__at"])
    wanted = F.array(F.regexp_replace(F.coalesce("config_path", F.lit("")), r"^.*/(?=[^/]+/[^/]+\z)", ""), F.concat(F.lit("tools/"), "tool_name", F.lit(".yaml")), F.concat(F.lit("tools/"), "tool_name", F.lit(".yml")))
    found = tools.select("framework", "tool_name", F.posexplode(wanted).alias("__rank", "__at")).join(files, "__at").groupBy("framework", "tool_name").agg(F.min_by("__doc", "__rank").alias("__doc"))
    joined = tools.join(found, ["framework", "tool_name"], "left")
    part = lambda c: F.coalesce(F.get_json_object("__doc", f"$.{c}"), F.col(c))
    return joined.withColumn("description", part("description")).withColumn("input_schema", part("input_schema")).drop("__doc")


def available_frameworks(spark: SparkSession, path: str) -> DataFrame:
    """(framework) of the folders under ``path`` that hold a ``meta.yaml``, in order."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "meta.yaml").option("recursiveFileLookup", True).load(path)
    return found.select(F.regexp_extract("path", r"([^/]+)/meta\.yaml\z", 1).alias("framework")).distinct().orderBy("framework")


#: Keys of a synthesis configuration that have a place of their own.
CONFIG_KEYS = ["name", "description", "description_chinese", "agents", "tools", "mcp_servers", "workflow", "llm_configs"]


def config_metadata(config: Column) -> Column:
    """map from each other key of a JSON configuration to its JSON text."""
    every = F.from_json(config, "map<string,string>")
    return F.map_filter(every, lambda k, v: ~k.isin(CONFIG_KEYS))


def config_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """(framework, item, problem): one row per broken constraint."""
    a, t, m, n = tables["agents"], tables["tools"], tables["llm_configs"], tables["nodes"]

    def rows(df: DataFrame, item: str, bad: Column, problem: str) -> DataFrame:
        return df.filter(F.coalesce(bad, F.lit(False))).select("framework", F.coalesce(F.col(item), F.lit("")).alias("item"), F.lit(problem).alias("problem"))

    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    found = [
        rows(a, "agent_name", blank("agent_name"), "agent without a name"),
        rows(a, "agent_name", blank("sysprompt_path"), "agent without a prompt"),
        rows(t, "tool_name", blank("tool_name"), "tool without a name"),
        rows(t, "tool_name", blank("description"), "tool without a description"),
        rows(t, "tool_name", blank("config_path"), "tool without a configuration"),
        rows(m, "llm_name", ~F.col("max_tokens").between(1, 200_000), "max_tokens out of range"),
        rows(m, "llm_name", ~F.col("temperature").between(0, 2), "temperature out of range"),
        rows(m, "llm_name", ~F.col("timeout").between(1, 300), "timeout out of range"),
        rows(n, "id", ~F.col("type").isin("agent", "tool", "mcp"), "unknown node type"),
    ]
    for df, item in ((a, "agent_name"), (t, "tool_name")):
        found.append(df.groupBy("framework", F.col(item).alias("item")).count().filter("count > 1").select("framework", "item", F.lit(f"{item} is not unique").alias("problem")))
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    return out


def env_values(text: str, existing: dict[str, str]) -> dict[str, str]:
    """Settings of an environment file's text; what exists wins, comments and lines without ``=`` are skipped."""
    out = {}
    for line in map(str.strip, text.splitlines()):
        key, found, value = line.partition("=")
        if found and not line.startswith("#"):
            out[key.strip()] = value.strip().strip("\"'")
    return out | {k: v for k, v in existing.items() if k in out}


def changed_files(spark: SparkSession, path: str, known: DataFrame) -> DataFrame:
    """Files under ``path`` whose md5 differs from that in ``known`` (path, hash) or that it lacks."""
    now = spark.read.format("binaryFile").load(path).select("path", F.md5("content").alias("hash"))
    return now.join(known.select("path", F.col("hash").alias("was")), "path", "left").filter("was is null or was <> hash").drop("was")


def framework_description(config: Column, language: Column) -> Column:
    """A framework's description in a language, from its JSON configuration; empty without one."""
    zh, en = F.get_json_object(config, "$.description_chinese"), F.get_json_object(config, "$.description")
    return F.coalesce(F.when(F.lower(language) == "chinese", F.coalesce(zh, en)).otherwise(en), F.lit(""))


def located(candidates: DataFrame, order: str = "rank") -> DataFrame:
    """Of each framework's candidate paths (framework, path, rank) the first."""
    return candidates.groupBy("framework").agg(F.min_by("path", order).alias("path"))


def server_tools(spark: SparkSession, servers: DataFrame, fetch, cache: AnswerCache | None = None) -> DataFrame:
    """(server, url_key, tool_name, description, parameters) of the tools that ``fetch`` (url -> JSON list) names; the url's md5 is the cache key.

    Each distinct URL is asked once, and with a ``cache`` only if it holds no answer that is young enough.
    A null URL and an answer that isn't a JSON list give no tools.
    """
    schema = "array<struct<name:string,description:string,inputSchema:string>>"
    asked = ask(servers, "url", fetch, "__answer", cache).withColumn("__t", F.explode(F.from_json("__answer", schema)))
    return asked.select("server", F.md5("url").alias("url_key"), F.col("__t.name").alias("tool_name"), F.col("__t.description").alias("description"), F.col("__t.inputSchema").alias("parameters"))


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, modificationTime) of the files of a cache folder, contents unread."""
    return spark.read.format("binaryFile").load(path).select("path", "length", "modificationTime")
