"""Toxicity by a weighted finite-state pattern grammar.

A text is cut into clauses, each word becomes one or two symbols (insult, threat,
target, negation, report, intent, copula, other), and a composed transducer reads
the symbols of a clause:

* ``_select`` picks one insult or threat as the clause's core; its output feeds
* ``_insult``: is the core said of a target ("you are a ..."), put next to one ("you ..."), or bare?
* ``_threat``: does a word of intent precede the threat ("will ...")?
* ``_target``: is somebody meant, before the core or after it (a promise that the rest of the clause must keep)?
* ``_negation``: does a negation a few words before reach the core?
* ``_report``: is the clause reported speech, said before the core or after it?

Their arcs carry weights; composition multiplies them.  A clause scores the weight
of its best accepted path times the core's weight in the lexicon, a document the
noisy-or of its clauses.

Function words and seeds are fixed.  Further insults, threats and word beginnings
are those that training labels show only in toxic texts, and the weights of
terms and arcs are fitted to the labels, their first values counting as a few
documents.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass, field
from operator import itemgetter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import append_columns, materialize, unit_hash

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, INTENT, COPULA, CORE_INSULT, CORE_THREAT = range(10)
SYMBOLS = range(10)
CORES = {INSULT: CORE_INSULT, THREAT: CORE_THREAT}

# Function words of the grammar in the four languages it knows, and seed insults and threats.
TARGETS = "you your yours he she they them him her this that du dich dir ihr euch sie er tu te toi vous lui eux il elle tú ti usted ustedes él ella ellos".split()
NEGATIONS = "not no never don't doesn't didn't cannot can't nicht kein keine nie niemals ne pas jamais aucun nunca jamás ningún".split()
REPORTS = "said says claimed wrote reported quoted called according sagte schrieb laut zitierte dit écrivit selon affirma dijo escribió según afirmó".split()
INTENTS = "will shall would gonna going must should i'll we'll werde wirst wird werden vais vas va allons allez voy vamos vais".split()
COPULAS = "is are am was were be been bist ist seid sind war waren est êtes sont était suis es son era".split()
CONTRACTIONS = {"eres": (TARGET, COPULA), "sois": (TARGET, COPULA), "you're": (TARGET, COPULA), "he's": (TARGET, COPULA), "she's": (TARGET, COPULA), "they're": (TARGET, COPULA), "isn't": (COPULA, NEGATION), "aren't": (COPULA, NEGATION), "wasn't": (COPULA, NEGATION), "weren't": (COPULA, NEGATION), "won't": (INTENT, NEGATION), "you'll": (TARGET, INTENT), "he'll": (TARGET, INTENT), "she'll": (TARGET, INTENT), "they'll": (TARGET, INTENT)}
INSULTS = "idiot moron stupid scum trash loser pathetic worthless disgusting clown dummkopf abschaum trottel blödmann crétin abruti ordure connard imbécil estúpido escoria basura".split()
THREATS = "kill hurt destroy punish töten verletzen vernichten tuer détruire frapper matar destruir golpear".split()
#: Arcs' weights before labels are seen.
ARCS = {"predicate": 1.0, "address": 1.0, "bare": 0.85, "intended": 1.0, "casual": 0.35, "insult-unaimed": 0.95, "threat-unaimed": 0.4, "negated": 0.2, "reported": 0.3}

_CLAUSE = re.compile(r"[.!?;:\n]+")
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
_TERM = itemgetter(2)
STEMS = (4, 5)
#: So many different words of one beginning in a text make it a feature of its own.
BURST = 3
#: Words after a negation that it reaches; words between target, copula, intent and core.
SCOPE, REACH = 4, 4


def clauses(text: str) -> list[list[str]]:
    """Lower-cased words of each clause."""
    return [w for w in (_WORD.findall(c) for c in _CLAUSE.split(text.lower().replace("’", "'"))) if w]


@dataclass(frozen=True)
class Transducer:
    """``arcs``: (state, symbol) -> (next state, output symbol, names of weights), any number of them."""

    start: object
    arcs: dict[tuple, tuple[tuple, ...]]
    final: frozenset

    def compose(self, other: Transducer) -> Transducer:
        """What ``other`` makes of this one's output; only states that can be reached."""
        start = (self.start, other.start)
        arcs, todo, seen = {}, [start], {start}
        while todo:
            state = a, b = todo.pop()
            for symbol in SYMBOLS:
                moves = []
                for to, out, marks in self.arcs.get((a, symbol), ()):
                    for onward, last, more in other.arcs.get((b, out), ()):
                        moves.append(((to, onward), last, marks + more))
                if moves:
                    arcs[state, symbol] = tuple(moves)
                    for to, _, _ in moves:
                        if to not in seen:
                            seen.add(to)
                            todo.append(to)
        return Transducer(start, arcs, frozenset(s for s in seen if s[0] in self.final and s[1] in other.final))


def _machine(start, final, states, move) -> Transducer:
    """``move(state, symbol)``: the arcs as (next state, marks); symbols pass unchanged."""
    arcs = {(s, c): tuple((to, c, marks) for to, marks in move(s, c)) for s in states for c in SYMBOLS}
    return Transducer(start, {k: v for k, v in arcs.items() if v}, frozenset(final))


def _select() -> Transducer:
    arcs = {(s, c): ((s, c, ()),) for s in range(2) for c in range(8)}
    for c, core in CORES.items():
        arcs[0, c] += ((1, core, ()),)
    return Transducer(0, arcs, frozenset({1}))


def _insult() -> Transducer:
    def move(s, c):
        kind, left = s
        if c == TARGET:
            return [(("target", REACH), ())]
        if c == COPULA and kind == "target":
            return [(("said of", REACH), ())]
        mark = ("predicate" if kind == "said of" else "address" if s == ("target", REACH) else "bare",) if c == CORE_INSULT else ()
        return [((kind, left - 1) if left > 1 else ("none", 0), mark)]

    return _machine(("none", 0), states := [("none", 0), *((k, n) for k in ("target", "said of") for n in range(1, REACH + 1))], states, move)


def _threat() -> Transducer:
    def move(s, c):
        return [(REACH if c == INTENT else max(0, s - 1), ("intended" if s else "casual",) if c == CORE_THREAT else ())]

    return _machine(0, range(REACH + 1), range(REACH + 1), move)


def _target() -> Transducer:
    def move(s, c):
        if c in CORES.values():
            name = "insult-unaimed" if c == CORE_INSULT else "threat-unaimed"
            return [("seen", ())] if s == "seen" else [("alone", (name,)), ("promised", ())]
        if c == TARGET:
            return [] if s == "alone" else [("seen", ())]  # a core taken as alone must stay so
        return [(s, ())]

    return _machine("none", {"seen", "alone"}, ("none", "seen", "promised", "alone"), move)


def _negation() -> Transducer:
    return _machine(0, range(SCOPE + 1), range(SCOPE + 1), lambda s, c: [(SCOPE if c == NEGATION else max(0, s - 1), ("negated",) if s and c in CORES.values() else ())])


def _report() -> Transducer:
    def move(s, c):
        if c in CORES.values():
            return [("seen", ("reported",))] if s == "seen" else [("own", ()), ("promised", ("reported",))]
        if c == REPORT:
            return [] if s == "own" else [("seen", ())]
        return [(s, ())]

    return _machine("none", {"seen", "own"}, ("none", "seen", "promised", "own"), move)


def composed() -> Transducer:
    out = _select()
    for machine in (_insult(), _threat(), _target(), _negation(), _report()):
        out = out.compose(machine)
    return out


def _numbered(grammar: Transducer) -> tuple[list[list[tuple[tuple[int, tuple[str, ...]], ...]]], list[bool]]:
    """The grammar with states as numbers, the start first: [state][symbol] -> (next, marks) arcs, and which states are final."""
    number = {grammar.start: 0}
    for (s, _), moves in grammar.arcs.items():
        for x in (s, *(to for to, _, _ in moves)):
            number.setdefault(x, len(number))
    table = [[() for _ in range(8)] for _ in number]
    for (s, c), moves in grammar.arcs.items():
        if c < 8:
            table[number[s]][c] = tuple((number[to], tuple(sorted(marks))) for to, _, marks in moves)
    return table, [s in grammar.final for s in number]


GRAMMAR, FINAL = _numbered(composed())


@dataclass
class ToxicityModel:
    """``insults``, ``threats``: word or beginning (``abcd*``) -> weight; the longest that fits a word counts.  ``arcs``: weight by name."""

    insults: dict[str, float] = field(default_factory=lambda: dict.fromkeys(INSULTS, 0.95))
    threats: dict[str, float] = field(default_factory=lambda: dict.fromkeys(THREATS, 0.95))
    arcs: dict[str, float] = field(default_factory=lambda: dict(ARCS))
    _known: dict = field(default_factory=dict, repr=False)

    def __post_init__(self) -> None:
        words = ((COPULA, COPULAS), (INTENT, INTENTS), (REPORT, REPORTS), (NEGATION, NEGATIONS), (TARGET, TARGETS))
        self.fixed = {w: ((c,), 0.0, "") for c, group in words for w in group} | {w: (c, 0.0, "") for w, c in CONTRACTIONS.items()}
        weight = lambda marks: math.prod(self.arcs[m] for m in marks)
        self.table = [[tuple((to, weight(marks), marks) for to, marks in moves) for moves in row] for row in GRAMMAR]

    def classify(self, word: str) -> tuple[tuple[int, ...], float, str]:
        """Symbols of a word, its weight as a core and the term that gives it."""
        found = self._known.get(word)
        if found is None:
            found = self.fixed.get(word)
            if found is None:
                found = (OTHER,), 0.0, ""
                for term in (word, *(f"{word[:k]}*" for k in sorted(STEMS, reverse=True) if len(word) >= k)):
                    if term in self.threats or term in self.insults:
                        found = ((THREAT,), self.threats[term], term) if term in self.threats else ((INSULT,), self.insults[term], term)
                        break
            if len(self._known) < 200_000:
                self._known[word] = found
        return found

    def parse(self, words: list[str]) -> tuple[float, float, tuple[str, ...], str] | None:
        """Best path of a clause: (weight of the path, its core's weight, names of the path's weights, the core's term); None where no core stands."""
        known = self._known
        read = [known.get(w) or self.classify(w) for w in words]
        if not any(map(_TERM, read)):
            return None
        active: dict[int, tuple] = {0: (1.0, 1.0, (), "")}
        for symbols, lexical, term in read:
            for c in symbols:
                after: dict[int, tuple] = {}
                for state, found in active.items():
                    for to, weight, marks in self.table[state][c]:
                        # only the arc that takes a word as the core names weights
                        new = (found[0] * weight, lexical, marks, term) if marks else found
                        old = after.get(to)
                        if old is None or new[0] * new[1] > old[0] * old[1]:
                            after[to] = new
                active = after
        return max((v for s, v in active.items() if FINAL[s]), key=lambda v: v[0] * v[1])

    def matches(self, text: str) -> list[tuple[float, float, tuple[str, ...], str]]:
        """The matched clauses, see :meth:`parse`."""
        return [m for m in map(self.parse, clauses(text)) if m is not None]

    def score(self, text: str) -> float:
        return noisy_or(self.matches(text))


def noisy_or(matches: list[tuple[float, float, tuple[str, ...], str]]) -> float:
    return 1 - math.prod(1 - min(0.99, m[0] * m[1]) for m in matches)


def _features(texts: list[str]) -> list[list]:
    """Per text: its terms, and a number that near copies share (the least hash of three words in a row).

    Terms are words, ``abcd*`` beginnings, ``abcd*+`` beginnings of three or more
    different words, and ``word!`` words that follow a word of intent.
    """
    terms, groups, intents = [], [], set(INTENTS) | {w for w, c in CONTRACTIONS.items() if INTENT in c}
    known = set(INSULTS) | set(THREATS)
    for t in texts:
        parts = clauses(t)
        flat = [w for c in parts for w in c]
        words = set(flat)
        # a seed says nothing about other words that begin like it
        begun = Counter(w[:k] for w in words.difference(known) for k in STEMS if len(w) > k)
        meant = {w for c in parts for i, w in enumerate(c) if not intents.isdisjoint(c[max(0, i - REACH) : i])}
        terms.append(sorted(words | {f"{b}*" for b in begun} | {f"{b}*+" for b, n in begun.items() if n >= BURST} | {f"{w}!" for w in meant}))
        groups.append(min((zlib.crc32(" ".join(x).encode("utf-8", "surrogatepass")) for x in zip(flat, flat[1:] or flat, flat[2:] or flat, strict=False)), default=0))
    return [terms, groups]


def _telling(terms: DataFrame, margin: float) -> dict[str, float]:
    """Term -> share of toxic texts, of the terms that no chance explains.

    A term in n texts may have its toxic share by chance; over all terms of its
    kind that stand in n texts, fewer than 10^-``margin`` such terms are to be
    expected.  Near copies count once: their words would otherwise look as telling
    as an insult.
    """
    each = terms.groupBy("copies").agg(F.max("y").alias("y"))
    totals = each.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("bad")).first()
    if not 0 < totals["bad"] < totals["n"]:
        return {}
    base = totals["bad"] / totals["n"]
    once = terms.select("y", "copies", F.explode("terms").alias("term")).groupBy("term", "copies").agg(F.max("y").alias("y"))
    kind = F.regexp_extract("term", r"([*+!]*)$", 1)
    counts = materialize(once.groupBy("term").agg(F.sum("y").alias("bad"), F.count(F.lit(1)).alias("n")).withColumn("kind", kind), "toxicity-terms")
    level = F.broadcast(counts.groupBy("kind", "n").agg(F.count(F.lit(1)).alias("alike")))  # one row per number of texts of the bounded draw
    # Chernoff bound on drawing so large a toxic share by chance
    q = F.least(F.col("bad") / F.col("n"), F.lit(1 - 1e-9))
    odd = F.col("n") * (q * F.log10(q / base) + (1 - q) * F.log10((1 - q) / (1 - base)))
    strong = counts.join(level, ["kind", "n"]).filter((F.col("kind") != "!") & (q > 0.95) & (odd > F.log10("alike") + margin)).select("term")
    # a beginning weighs what its share in all texts that have it is, however often each has it
    named = strong.select(F.regexp_replace("term", r"\+$", "").alias("term")).distinct()
    found = counts.join(F.broadcast(named), "term").select("term", "bad", "n").collect()
    out = {r["term"]: (r["bad"] + 0.5) / (r["n"] + 1) for r in found}
    # words of a chosen beginning that several texts have weigh by themselves: some may be harmless
    under = F.coalesce(*[F.when(F.concat(F.substring("term", 1, k), F.lit("*")).isin(list(out)), F.lit(True)) for k in STEMS])
    for r in counts.filter((F.col("kind") == "") & (F.col("n") >= BURST) & under).select("term", "bad", "n").collect():
        out.setdefault(r["term"], (r["bad"] + 0.5) / (r["n"] + 1))
    meant = counts.filter("kind = '!'").select(F.expr("substring(term, 1, length(term) - 1)").alias("term"), F.col("bad").alias("meant"), F.col("n").alias("times")).join(F.broadcast(named), "term").collect()
    bad = {r["term"]: r["bad"] for r in found}
    return out | {f"{r['term']}!": out[r["term"]] for r in meant if 2 * r["meant"] > bad[r["term"]]}


def _with_terms(model: ToxicityModel, found: dict[str, float]) -> ToxicityModel:
    threats = {t[:-1]: w for t, w in found.items() if t.endswith("!")}
    return ToxicityModel(model.insults | {t: w for t, w in found.items() if t[-1] != "!" and t not in threats}, model.threats | threats, model.arcs)


def _matched(rows: DataFrame, model: ToxicityModel) -> DataFrame:
    """``rows`` plus ``found``: each text's matched clauses as (core's term, names of the arcs' weights, how many)."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def make():
        m = shared.value

        def run(texts: list[str]) -> list[list]:
            counts = [Counter((term, " ".join(marks)) for _, _, marks, term in m.matches(t)) for t in texts]
            return [[[{"term": k[0], "marks": k[1], "n": n} for k, n in sorted(c.items())] for c in counts]]

        return run

    return append_columns(rows, "__text", [("found", "array<struct<term:string,marks:string,n:int>>")], make)


def fit_weights(model: ToxicityModel, seen: list[tuple[int, float, list[tuple[str, str, int]]]], strength: float = 2.0, sweeps: int = 4) -> ToxicityModel:
    """The model with the terms' and arcs' weights of largest likelihood.

    ``seen``: documents as (label, weight, matched clauses).  Present weights count
    as ``strength`` documents each.  One weight moves at a time, over a grid.
    """
    flat = [(d, term, marks.split(), n) for d, (_, _, found) in enumerate(seen) for term, marks, n in found]
    names = sorted({("term", x[1]) for x in flat}) + sorted({("arc", m) for x in flat for m in x[2]})  # arcs take what terms leave
    if not names:
        return model
    at = {k: i for i, k in enumerate(names)}
    start = np.array([(model.arcs[k] if kind == "arc" else model.threats.get(k, model.insults.get(k))) for kind, k in names]).clip(0.02, 0.99)
    doc, n = np.array([x[0] for x in flat]), np.array([x[3] for x in flat], dtype=float)
    uses = [[at["term", x[1]], *(at["arc", m] for m in x[2])] for x in flat]
    by: list[list[int]] = [[] for _ in names]
    for i, ks in enumerate(uses):
        for k in ks:
            by[k].append(i)
    clauses_of = [np.array(x) for x in by]
    y, share = np.array([s[0] for s in seen]), np.array([s[1] for s in seen])
    w, grid = start.copy(), np.linspace(0.02, 0.99, 40)
    path = np.array([np.log(w[ks]).sum() for ks in uses])  # logarithm of each clause's weight
    clear = np.bincount(doc, n * np.log1p(-np.minimum(0.99, np.exp(path))), minlength=len(seen))
    for _ in range(sweeps):
        for k in range(len(names)):
            mine = clauses_of[k]
            docs, inside = np.unique(doc[mine], return_inverse=True)
            others = clear[docs] - np.bincount(inside, n[mine] * np.log1p(-np.minimum(0.99, np.exp(path[mine]))))
            tried = []
            for g in grid:
                p = np.bincount(inside, n[mine] * np.log1p(-np.minimum(0.99, np.exp(path[mine] + math.log(g / w[k]))))) + others
                p = np.clip(1 - np.exp(p), 1e-3, 1 - 1e-3)
                fit = share[docs] * np.where(y[docs] == 1, np.log(p), np.log(1 - p))
                tried.append(fit.sum() + strength * (start[k] * math.log(g) + (1 - start[k]) * math.log(1 - g)))
            best = grid[int(np.argmax(tried))]
            path[mine] += math.log(best / w[k])
            w[k] = best
            clear[docs] = others + np.bincount(inside, n[mine] * np.log1p(-np.minimum(0.99, np.exp(path[mine]))))
    terms, arcs = ({k: float(w[i]) for (kind, k), i in at.items() if kind == what} for what in ("term", "arc"))
    return ToxicityModel({t: terms.get(t, v) for t, v in model.insults.items()}, {t: terms.get(t, v) for t, v in model.threats.items()}, model.arcs | arcs)


def fit_toxicity_model(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_class: int = 6000, sure: float = 6.0, surprise: float = 0.5) -> ToxicityModel:
    """Learn the terms, and their and the arcs' weights, from about ``per_class`` labelled documents of each class.

    The bound is on labelled documents: drawn ones are read whole, and every term
    that passes enters.  First the terms enter that are toxic beyond doubt (margin
    ``sure``, see :func:`_telling`), then, with margin ``surprise``, those of the
    toxic texts without a match: words that merely stand beside an insult have no
    support there.  A learned word that mostly follows a word of intent is a
    threat, any other an insult.  Without labels of both classes the seeds and
    default weights stay; null labels and null texts count for nothing.
    """
    known = labels.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{label_col}`").cast("int").alias("y")).filter("y in (0, 1)")
    sizes = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    model = ToxicityModel()
    if set(sizes) != {0, 1}:
        return model
    share = F.coalesce(*[F.when(F.col("y") == k, F.lit(per_class / n)) for k, n in sizes.items()])
    drawn = known.filter(unit_hash("__id", F.lit(29)) < share)
    # the draw is bounded by per_class: with it on every executor no text is shuffled
    rows = docs.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").alias("__text")).join(F.broadcast(drawn), "__id").select("y", "__text")
    rows = materialize(append_columns(rows, "__text", [("terms", "array<string>"), ("copies", "bigint")], lambda: _features), "toxicity-sample")
    model = _with_terms(model, _telling(rows, sure))
    rest = _matched(rows, model).filter((F.col("y") == 0) | (F.size("found") == 0))
    model = _with_terms(model, _telling(rest, surprise))
    each = {k: max(1.0, n / per_class) for k, n in sizes.items()}
    seen = _matched(rows, model).filter(F.size("found") > 0).groupBy("y", "found").agg(F.count(F.lit(1)).alias("n")).collect()  # at most the draw
    return fit_weights(model, [(r["y"], r["n"] * each[r["y"]], [tuple(x) for x in r["found"]]) for r in seen])


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """``docs`` plus ``score`` (0 to 1), ``predicted`` and ``n_matches`` (matched clauses).

    Whole texts are read, each row for itself.  Null and empty texts score 0.
    Input columns keep their values; ones named like an output are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = shared.value

        def run(texts: list[str]) -> list[list]:
            found = [m.matches(t) for t in texts]
            scores = [noisy_or(x) for x in found]
            return [scores, [int(s >= threshold) for s in scores], [len(x) for x in found]]

        return run

    return append_columns(docs, text_col, [("score", "double"), ("predicted", "int"), ("n_matches", "int")], make)
