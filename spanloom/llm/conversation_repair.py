"""Conversation structure repair by weighted finite-state composition.

Three machines are composed lazily: an acceptor of a conversation's rows, a
transducer of edits (keep, rerole, delete, insert) and an acceptor of the role
grammar ``(s?(ua)+)?``.  Weights are (cost, labels so far), compared in that
order.  A row contributes one label that is not an insertion, so of two label
strings of equal cost neither begins the other: the smaller one stays smaller
whatever follows, and the best paths can be found and joined piece by piece.

A conversation of up to ``long_rows`` rows is repaired in one go.  A longer one is
cut into pieces: each piece's best paths between any two grammar states are found
by themselves and joined in a tree, so no task ever holds its texts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, release

#: Costs of the edits; what an undeleted truncated row adds.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: The role grammar: states 0 (start), 1 (after s), 2 (after u), 3 (after a), and those in which a conversation may end.
GRAMMAR = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
FINAL = (0, 3)
ROLE = {"u": "user", "a": "assistant"}
_WORD = re.compile(r"[^\x20\x09-\x0D]")

Weight = tuple[int, str]
Paths = dict[int, Weight]


def fault_of(role: str, text: str, seen: set) -> str:
    """A row's first fault: ``blank``, ``duplicate``, ``truncated`` or none; ``seen`` gets the row."""
    body = text.rstrip(" \t\n\x0b\x0c\r")
    key = hashlib.md5(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass")).digest()
    again = key in seen
    seen.add(key)
    if not body:
        return "blank"
    return "duplicate" if again else "" if body[-1] in ".!?" else "truncated"


def edits(initial: str, fault: str) -> Iterator[tuple[str, int, str]]:
    """Arcs of the edit transducer at a row: (label, cost, role initial given out; empty for a deletion)."""
    yield "D", DELETE, ""
    if fault not in ("blank", "duplicate"):
        more = TRUNCATED if fault == "truncated" else 0
        if initial:
            yield "K", KEEP + more, initial
        yield from (("R", REROLE + more, out) for out in ROLE)


def _better(paths: Paths, state: int, weight: Weight) -> None:
    if state not in paths or weight < paths[state]:
        paths[state] = weight


def inserted(paths: Paths) -> Paths:
    """The paths with up to two insertions after them; a third only leads back where one has been."""
    out, last = dict(paths), paths
    for _ in range(2):
        step: Paths = {}
        for state, (cost, labels) in last.items():
            for role in ROLE:
                if (to := GRAMMAR.get((state, role))) is not None:
                    _better(step, to, (cost + INSERT, labels + "I"))
        for state, weight in step.items():
            _better(out, state, weight)
        last = step
    return out


def through(rows: Iterable[tuple[str, str]], start: int) -> Paths:
    """Best weights of the composed machine from ``start`` through all rows (initial, fault), to each grammar state."""
    paths: Paths = {start: (0, "")}
    for initial, fault in rows:
        before, paths = inserted(paths), {}
        for state, (cost, labels) in before.items():
            for label, price, out in edits(initial, fault):
                if (to := GRAMMAR.get((state, out)) if out else state) is not None:
                    _better(paths, to, (cost + price, labels + label))
    return paths


def best_end(paths: Paths) -> Weight:
    """The best weight among final states, insertions after the last row included."""
    return min(w for state, w in inserted(paths).items() if state in FINAL)


def given_out(labels: str, at: int = 0, total: int | None = None) -> Iterator[tuple[str, str]]:
    """(label, role or empty for the row's own) of each output; ``at`` and ``total`` count outputs before these labels and in all."""
    total = len(labels) - labels.count("D") if total is None else total
    for label in labels:
        if label == "D":
            yield label, ""
            continue
        yield label, "" if label == "K" else ROLE["ua"[(at - total % 2) % 2]]  # an odd number of outputs starts with s
        at += 1


def repaired_lines(labels: str, rows: Iterable[tuple[str, str]], at: int = 0, total: int | None = None) -> list[str]:
    """``role:text`` of each output row."""
    source, out = iter(rows), []
    for label, role in given_out(labels, at, total):
        own, text = next(source) if label != "I" else ("", "")
        if label != "D":
            out.append(f"{role or own}:{text}")
    return out


def _sha(lines: list[str]) -> str:
    return hashlib.sha256("\n".join(lines).encode("utf-8", "surrogatepass")).hexdigest()


def illegal_pairs(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def repair(rows: list[tuple[int | None, str, str]]) -> tuple:
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of a conversation's rows (turn, role, text) in order."""
    turns, seen = {t for t, _, _ in rows if t is not None}, set()
    faults = [fault_of(role, text, seen) for _, role, text in rows]
    initials = [role[:1] for _, role, _ in rows]
    cost, audit = best_end(through(zip(initials, faults), 0))
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal_pairs(initials), cost, audit, _sha(repaired_lines(audit, [(r, x) for _, r, x in rows])))


FIELDS = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(__id, turn, role, text, times): rows as the damage leaves them; ``times`` is 0 for a dropped row, 2 for a repeated one.

    Which damage a row gets is the CRC-32 of ``conv_id:turn`` modulo 20: 0 drops it, 1
    empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes it the user's.  A
    null counts as one space, in role and text as in the hashed key.
    """
    c = {k: F.col(f"`{v}`") for k, v in (("id", conv), ("turn", turn), ("role", role), ("text", text))}
    spaced = lambda x: F.coalesce(x.cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spaced(c["id"]), F.lit(":"), spaced(c["turn"])).cast("binary")) % 20
    whole = F.when(kind == 0, None).when(kind == 1, "").when(kind == 2, F.regexp_replace(spaced(c["text"]), "[.!?]", "")).otherwise(spaced(c["text"]))
    return rows.select(
        c["id"].alias("__id"), c["turn"].cast("bigint").alias("turn"), F.when(kind == 4, "user").otherwise(spaced(c["role"])).alias("role"), whole.alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("times"),
    )


def _order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]


def _whole(rows: DataFrame, kind: str) -> DataFrame:
    """Conversations that fit a task: each is met once, in the stream of its sorted partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in FIELDS.split(", ")]
        types = [pa.int64()] * 6 + [pa.string()] * 2
        now, held, ids, made, id_type = None, None, [], [], None

        def close() -> None:
            if held is not None:
                ids.append(now)
                made.append(repair(held))

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(ids, id_type), *[pa.array([m[i] for m in made], t) for i, t in enumerate(types)]], names=["__id", *names])
            ids.clear()
            made.clear()
            return out

        for batch in batches:
            id_type = batch.schema.field("__id").type
            for ident, turn, role, text, times in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("__id", "turn", "role", "text", "times"))):
                if held is None or ident != now:
                    close()
                    now, held = ident, []
                held += [(turn, role, text)] * times
            if ids:
                yield flush()
        close()
        if ids:
            yield flush()

    return rows.repartition("__id").sortWithinPartitions("__id", *_order()).mapInArrow(run, f"__id {kind}, {FIELDS}")


#: What is known of a piece of a conversation; ``paths`` has the best weight between any two grammar states.
NODE = "first string, last string, illegal bigint, blank bigint, duplicate bigint, truncated bigint, n bigint, paths array<struct<p:int,q:int,cost:bigint,labels:string>>"


def _joined(parts: list[dict]) -> dict:
    """The node of neighbouring pieces, in order."""
    plain = lambda x: x.asDict() if hasattr(x, "asDict") else dict(x)
    out, rest = plain(parts[0]), parts[1:]
    for b in rest:
        out["illegal"] += b["illegal"] + illegal_pairs([out["last"], b["first"]])
        out["last"] = b["last"]
        for k in ("blank", "duplicate", "truncated", "n"):
            out[k] += b[k]
        paths: dict[tuple[int, int], Weight] = {}
        for x in out["paths"]:
            for y in b["paths"]:
                if x["q"] == y["p"] and ((key := (x["p"], y["q"])) not in paths or (x["cost"] + y["cost"], x["labels"] + y["labels"]) < paths[key]):
                    paths[key] = (x["cost"] + y["cost"], x["labels"] + y["labels"])
        out["paths"] = [{"p": p, "q": q, "cost": c, "labels": s} for (p, q), (c, s) in sorted(paths.items())]
    return out


def _pieces(rows: DataFrame, piece: int) -> DataFrame:
    """Rows in order and numbered: (part, at) orders a conversation, (part, piece) cuts it.

    Ranges of (id, turn, role, beginning of the text) split a conversation over
    many tasks; within a range rows are sorted in full.
    """
    each = rows.withColumn("text", F.coalesce("text", F.lit(""))).select("__id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(0), F.col("times"))).alias("__copy")).withColumn("__head", F.substring("text", 1, 64))
    ranged = each.repartitionByRange(F.col("__id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "__head").sortWithinPartitions("__id", *_order())
    numbered = ranged.withColumn("__n", F.monotonically_increasing_id()).withColumn("part", F.shiftright("__n", 33)).withColumn("at", F.col("__n").bitwiseAND(F.lit((1 << 33) - 1)))
    return numbered.select("__id", "turn", "role", "text", "part", "at", F.floor(F.col("at") / piece).alias("piece"), F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")).alias("same"))


def _by_pieces(rows: DataFrame, kind: str, piece: int, fan: int) -> DataFrame:
    numbered = materialize(_pieces(rows, piece), "numbered")
    first = numbered.groupBy(F.col("__id").alias("i"), F.col("same").alias("s")).agg(F.min(F.struct("part", "at")).alias("first"))
    body = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    narrow = numbered.select("__id", "turn", "part", "piece", "at", "same", F.substring("role", 1, 1).alias("initial"), (F.length(body) == 0).alias("blank"), body.rlike(r"[.!?]\z").alias("ends"))
    again = F.struct("part", "at") != F.col("first")
    fault = F.when(F.col("blank"), "blank").when(again, "duplicate").when(~F.col("ends"), "truncated").otherwise("")
    marked = narrow.join(first, F.col("__id").eqNullSafe(F.col("i")) & (F.col("same") == F.col("s"))).select("__id", "part", "piece", "at", "initial", fault.alias("fault"))
    runs = marked.groupBy("__id", "part", "piece").agg(F.sort_array(F.collect_list(F.struct("at", "initial", "fault"))).alias("rows"))  # at most ``piece`` rows

    @F.pandas_udf(NODE)
    def node(batch: pd.Series) -> pd.DataFrame:
        out = []
        for rows in batch:
            initials, faults = [r["initial"] for r in rows], [r["fault"] for r in rows]
            found = [(p, q, w) for p in range(4) for q, w in through(list(zip(initials, faults)), p).items()]
            out.append({"first": initials[0], "last": initials[-1], "illegal": illegal_pairs(initials), **{k: faults.count(k) for k in ("blank", "duplicate", "truncated")}, "n": len(rows), "paths": [{"p": p, "q": q, "cost": w[0], "labels": w[1]} for p, q, w in found]})
        return pd.DataFrame(out)

    @F.pandas_udf(NODE)
    def join(batch: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_joined([r["node"] for r in rows]) for rows in batch])

    leaves = materialize(runs.select("__id", "part", "piece", node("rows").alias("node")), "pieces")
    ranks = F.expr("row_number() over (partition by __id order by part, piece)") - 1  # pieces only, in a stream
    level = materialize(leaves.select("__id", ranks.alias("k"), "node"), "level")
    while not level.filter("k > 0").isEmpty():
        groups = level.groupBy("__id", F.floor(F.col("k") / fan).alias("g")).agg(F.sort_array(F.collect_list(F.struct("k", "node"))).alias("rows"))  # at most ``fan`` pieces
        above = materialize(groups.select("__id", F.col("g").alias("k"), join("rows").alias("node")), "level")
        release(level)
        level = above

    @F.pandas_udf("struct<cost:bigint,audit:string>")
    def choose(batch: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([best_end({x["q"]: (x["cost"], x["labels"]) for x in paths if x["p"] == 0}) for paths in batch], columns=["cost", "audit"])

    @F.pandas_udf("array<struct<part:bigint,piece:bigint,labels:string,at:bigint>>")
    def cut(audits: pd.Series, sizes: pd.Series) -> pd.Series:
        """The audit's share of each piece: insertions go with the row after them, those at the end with the last piece."""
        out = []
        for audit, pieces in zip(audits, sizes):
            ends, shares, begun, at, pieces = [i + 1 for i, label in enumerate(audit) if label != "I"], [], 0, 0, list(pieces)
            done = 0
            for j, p in enumerate(pieces):
                done += p["n"]
                labels = audit[begun:] if j == len(pieces) - 1 else audit[begun : ends[done - 1]]
                shares.append({"part": p["part"], "piece": p["piece"], "labels": labels, "at": at})
                begun, at = begun + len(labels), at + len(labels) - labels.count("D")
            out.append(shares)
        return pd.Series(out)

    best = materialize(level.select("__id", "node", choose("node.paths").alias("best")), "best")
    sizes = leaves.groupBy(F.col("__id").alias("i")).agg(F.sort_array(F.collect_list(F.struct("part", "piece", F.col("node.n").alias("n")))).alias("sizes"))
    total = F.length("best.audit") - F.length(F.regexp_replace("best.audit", "[KRI]", ""))
    shares = best.join(sizes, F.col("__id").eqNullSafe(F.col("i"))).select("__id", total.alias("total"), F.explode(cut("best.audit", "sizes")).alias("x"))
    shares = materialize(shares.select(F.col("__id").alias("i"), F.col("x.part").alias("p"), F.col("x.piece").alias("c"), "x.labels", F.col("x.at").alias("before"), "total"), "shares")

    def rewrite(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, one = pdf.sort_values("at"), pdf.iloc[0]
        lines = repaired_lines(one["labels"], zip(pdf["role"], pdf["text"]), int(one["before"]), int(one["total"]))
        return pd.DataFrame({"__id": pdf["__id"].iloc[:1], "part": [one["part"]], "piece": [one["piece"]], "body": ["\n".join(lines) if lines else None]})

    met = numbered.join(shares, F.col("__id").eqNullSafe(F.col("i")) & (F.col("part") == F.col("p")) & (F.col("piece") == F.col("c")))
    bodies = met.groupBy("__id", "part", "piece").applyInPandas(rewrite, f"__id {kind}, part bigint, piece bigint, body string")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """SHA-256 is sequential: a conversation's pieces pass in order and none is kept."""
        now, sha, begun, id_type = None, None, False, None
        for batch in batches:
            id_type = batch.schema.field("__id").type
            done = []
            for ident, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if sha is None or ident != now:
                    if sha is not None:
                        done.append((now, sha.hexdigest()))
                    now, sha, begun = ident, hashlib.sha256(), False
                if body is not None:
                    sha.update((("\n" if begun else "") + body).encode("utf-8", "surrogatepass"))
                    begun = True
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], id_type), pa.array([d[1] for d in done], pa.string())], names=["i", "sha"])
        if sha is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], id_type), pa.array([sha.hexdigest()])], names=["i", "sha"])

    shas = bodies.repartition("__id").sortWithinPartitions("__id", "part", "piece").select("__id", "body").mapInArrow(digest, f"i {kind}, sha string")
    turns = numbered.filter("turn is not null").groupBy("__id", "turn").count().groupBy(F.col("__id").alias("j")).agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"))
    out = best.join(shas, F.col("__id").eqNullSafe(F.col("i"))).join(turns, F.col("__id").eqNullSafe(F.col("j")), "left")
    return out.select("__id", F.coalesce("gaps", F.lit(0)).alias("gaps"), *[F.col(f"node.{c}").alias(c) for c in ("blank", "duplicate", "truncated", "illegal")], "best.cost", "best.audit", F.col("sha").alias("repaired_sha256"))


def repair_conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", long_rows: int = 4096, piece: int = 256, fan: int = 16) -> DataFrame:
    """Damage, then repair: one row per conversation id of ``rows`` (null is an id), with faults, cost, audit and the repaired text's SHA-256.

    Rows of equal turns follow one another by role, then text.  A conversation of
    which the damage leaves no row has zeros, an empty audit and the hash of nothing.  A
    role without characters has no initial and can't be kept.  Empty tables give empty
    results; other input columns are ignored.  Both ways of working give the
    same rows: up to ``long_rows`` rows a conversation is repaired by one task.
    """
    hurt = damaged(rows, conv, turn, role, text)
    kind = hurt.schema["__id"].dataType.simpleString()
    long = materialize(hurt.groupBy("__id").agg(F.sum("times").alias("n")).filter(F.col("n") > long_rows).select(F.col("__id").alias("__long")), "long-conversations")
    if long.isEmpty():
        return _whole(hurt, kind).withColumnRenamed("__id", conv)
    same = F.col("__id").eqNullSafe(F.col("__long"))
    out = _whole(hurt.join(long, same, "left_anti"), kind).unionByName(_by_pieces(hurt.join(long, same, "left_semi"), kind, piece, fan))
    return out.withColumnRenamed("__id", conv)
