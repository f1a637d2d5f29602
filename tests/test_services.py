"""External services are asked once per request; stages, files, traces of tags and YAML configurations."""

from __future__ import annotations

import json
import sys
from collections import Counter
from dataclasses import dataclass, replace

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from spanloom import adapters
from spanloom.operators import spans, synth, taxonomy, urls
from spanloom.sources import files
from spanloom.sources.snapshots import Snapshots
from spanloom.storage import shared_folder


cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Counting:
    """A service that writes down every request that it gets."""

    inner: object
    log: str

    def __call__(self, requests: list[str]) -> list[str]:
        with open(self.log, "a") as f:
            f.writelines(json.dumps(r) + "\n" for r in requests)
        return self.inner(requests)


def asked(log) -> Counter:
    return Counter(map(json.loads, log.read_text().splitlines())) if log.exists() else Counter()


DRAWS = "draw_id long, framework string, persona string, problem_type string, trace_context array<string>, capabilities string"


@pytest.fixture(scope="module")
def draws(spark):
    return spark.createDataFrame([(i, "geo", f"persona {i % 9}", f"type {i % 4}", ["root", "x"], "search") for i in range(40)], DRAWS)


def test_each_request_goes_out_once(spark, draws, tmp_path):
    logs = {k: tmp_path / k for k in ("llm", "search", "probe", "download")}
    cfg = synth.SynthesisConfig(fuzzify=0.5, web_search=0.5, llm=Counting(adapters.StubLLM(), str(logs["llm"])), search=Counting(adapters.StubSearch(), str(logs["search"])), probe=Counting(adapters.StubProbe(), str(logs["probe"])), download=Counting(adapters.StubDownload(), str(logs["download"])))
    done = synth.synthesise(draws, cfg)
    first = done.count()
    before = {k: asked(v) for k, v in logs.items()}
    assert first == 40 == synth.query_records(done).count() + synth.error_rows(done).count()
    assert {k: asked(v) for k, v in logs.items()} == before  # using the result again asks nothing
    assert max(before["llm"].values()) == max(before["search"].values()) == max(before["download"].values()) == 1
    rows = done.filter("requires_local_files").collect()
    assert rows and all(len(r.files) == 1 and r.files[0].path.startswith("downloads/geo/") for r in rows)
    assert all("use the files of" in (r.original_query or r.query) for r in rows if r.files[0].status == "downloaded")


def test_repair_asks_once(spark, tmp_path):
    llm, probe = tmp_path / "llm", tmp_path / "probe"
    rows = spark.createDataFrame([(i, f"see http://x{i % 20}.example/a and http://x{i % 20}.example/a.") for i in range(60)], "id long, q string")
    out = urls.repair_urls(rows, "id", "q", Counting(adapters.StubProbe(), str(probe)), Counting(adapters.StubLLM(), str(llm))).collect()
    assert len(out) == 60 and all(r.url_stats.total_extracted == 1 for r in out) and all(r.url_stats.accessible + r.url_stats.repaired == 1 for r in out)
    assert max(asked(llm).values()) == 1 and max(asked(probe).values()) <= 2  # two tries of a URL that fails
    assert len(asked(probe)) <= 40


def test_null_requests_are_never_sent(spark, tmp_path):
    log = tmp_path / "log"
    df = spark.createDataFrame([(1, None), (2, "a"), (3, "a")], "id long, r string")
    got = {r.id: r.out for r in adapters.ask(df, F.col("r"), Counting(lambda xs: [x + "!" for x in xs], str(log)), "out").collect()}
    assert got == {1: None, 2: "a!", 3: "a!"} and asked(log) == Counter(["a"])


def test_probe_twice():
    seen = Counter()

    def flaky(requests):
        seen.update(requests)
        if "boom" in requests:
            raise OSError("down")
        return ["200" if r == "good" or seen[r] == 2 else "404" for r in requests]

    assert urls.probe_twice(flaky)(["good", "late"]) == ["200", "200"] and seen["good"] == 1
    assert urls.probe_twice(flaky)(["boom"]) == ["error: down"]


def test_a_failed_row_takes_no_part_in_later_stages(spark, draws):
    cfg = replace(synth.SynthesisConfig(), llm=lambda xs: ["" for _ in xs])
    done, times = synth.until_failure(draws, cfg, synth.STAGES)
    assert done.count() == 40 and [n for n, _ in times] == [f.__name__ for f in synth.STAGES]
    assert {r.stop for r in synth.error_rows(done).collect()} == {"empty_query"} and done.filter("files is not null").count() == 0


def test_prompts_in_both_languages():
    kinds = {k for k, _ in synth.TEMPLATES}
    assert all((k, lang) in synth.TEMPLATES for k in kinds for lang in ("english", "chinese")) and len(kinds) >= 8


def test_ancestry_beyond_any_row_limit(spark):
    """A chain of 30 provider spans under a named one: 20 steps up and no further; a loop ends."""
    n = 30
    rows = [("t", "s0", None, "lead", 0)] + [("t", f"s{i}", f"s{i - 1}", "OpenAI-generation", i) for i in range(1, n)] + [("u", "a", "b", "", 0), ("u", "b", "a", "", 1)]
    df = spark.createDataFrame(rows, "trace_id string, span_id string, parent_id string, span_name string, line_no long")
    assert {r.span_id: r.agent_name for r in spans.resolve_agent_by_ancestry(df).collect()} == {f"s{i}": "lead" for i in range(1, 21)}


def test_tag_traces(spark):
    nodes = spark.createDataFrame([("f", "r", None, "R", "R", 0), ("f", "a", "r", "A", "A", 0), ("f", "b", "r", "B", "B", 1), ("f", "c", "a", "C", "C", 0)], "framework string, id string, parent_id string, en string, zh string, sib_pos int")
    found = taxonomy.paths(nodes)
    counts = spark.createDataFrame([("f", "r→b", 1000)], "framework string, path_id string, n long")
    draws = spark.range(300).select(F.lit("f").alias("framework"), F.col("id").alias("draw_id"))
    traces, after = taxonomy.tag_traces(found, counts, draws, "1", 0.3, lambda rows: rows.withColumn("tag", F.concat(F.col("parent_id"), F.lit("_new"))))
    got = Counter(r.trace for r in traces.collect())
    assert sum(got.values()) == 300 and got["r→a→c"] > 150 and got["r→b"] <= 3 and got["r→a→a_new"] + got["r→a→c→c_new"] > 50
    assert {r.path_id: r.n for r in after.collect()}.get("r→b", 0) >= 1000 and sum(r.n for r in after.collect()) == 1300


def test_trace_rounds_go_on_after_a_failure(spark, tmp_path):
    """A run that fails in its second round and one that goes through leave the same traces; committed rounds send nothing again."""
    draws = spark.range(90).select(F.lit("f").alias("framework"), F.col("id").alias("draw_id"), (F.col("id") % 3).cast("int").alias("round"))
    first = spark.createDataFrame([("f", "r→a", ["r", "a"], 0), ("f", "r→b", ["r", "b"], 0)], "framework string, path_id string, node_ids array<string>, n long")
    asked = []

    def grow(rows):
        asked.append(1)
        if fails and len(asked) == 2:
            raise RuntimeError("no answer")
        return rows.withColumn("tag", F.concat(F.lit("t"), "parent_id"))

    results = []
    for where, fails in (("whole", False), ("cut", True)):
        asked.clear()
        state = Snapshots(str(tmp_path / where))
        state.commit(first)
        if fails:
            with pytest.raises(RuntimeError):
                taxonomy.trace_rounds(state, draws, "1", 3, 0.4, grow)
            assert state.versions(spark)[-1] == 1
        results.append({(r.draw_id, r.path_id, r.trace) for r in taxonomy.trace_rounds(state, draws, "1", 3, 0.4, grow).collect()})
        assert len(asked) == (4 if fails else 3) and state.versions(spark)[-1] == 3
        assert state.read(spark).agg(F.sum("n")).first()[0] == 90
    assert results[0] == results[1] and len(results[0]) == 90
    assert any(p.rsplit("→", 1)[1].startswith("t") for _, p, _ in results[0])  # a later round draws what an earlier one grew


def test_yaml_configurations(spark, tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "fw" / "tools").mkdir(parents=True)
    (tmp_path / "fw" / "meta.yaml").write_text("name: fw\nextra: [1, 2]\n")
    (tmp_path / "fw" / "tools" / "find.yaml").write_text("description: finds\ninput_schema:\n  type: object\n  properties: {q: {type: string}}\n")
    (tmp_path / "fw" / "tools" / "bad.yaml").write_text("a: [1\n")
    read = {r.path.rsplit("/", 1)[1]: r.value for r in files.yaml_as_json(spark, f"{tmp_path}/fw/tools").collect()}
    assert json.loads(read["find.yaml"])["description"] == "finds" and read["bad.yaml"] is None
    tools = spark.createDataFrame([("fw", "find", None, None, None), ("fw", "other", "as it was", "x/other.yaml", None)], "framework string, tool_name string, description string, config_path string, input_schema string")
    out = {r.tool_name: r for r in files.tool_schemas(tools, files.yaml_as_json(spark, f"{tmp_path}/fw/tools")).collect()}
    assert out["find"].description == "finds" and json.loads(out["find"].input_schema)["properties"] == {"q": {"type": "string"}} and out["other"].description == "as it was"
    assert [r.framework for r in files.available_frameworks(spark, str(tmp_path)).collect()] == ["fw"]
    meta = spark.createDataFrame([('{"name": "fw", "extra": [1, 2]}',)], "j string").select(files.config_metadata(F.col("j")).alias("m")).first().m
    assert meta == {"extra": "[1,2]"}


def test_no_machine_local_folder_on_a_cluster():
    class Session:
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})
        sparkContext = type("Context", (), {"master": "yarn", "getCheckpointDir": staticmethod(lambda: None)})

    with pytest.raises(ValueError, match="checkpoint"):
        shared_folder(Session(), "x")
