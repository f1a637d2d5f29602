"""Toxicity, extraction, quality and language: grammar and features by hand, held-out accuracy, odd rows."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spanloom.llm import html_extract as H
from spanloom.llm import language_id as L
from spanloom.llm import quality as Q
from spanloom.llm import toxicity as X
from spanloom.llm.common import held_out, load
from spanloom.llm.queries import queries

SF = "/root/testdata/sf0.01"
ODD = [(1, None), (2, ""), (3, "   \n"), (4, "1234 !!"), (None, "a text, with words."), (5, "w " * 50_000), (6, "same"), (6, "same")]


@pytest.fixture(scope="module")
def odd(spark):
    """Null and repeated ids, null, empty, blank and very long texts, and columns named like outputs."""
    return spark.createDataFrame(ODD, "doc_id long, text string").withColumn("score", F.lit("mine")).withColumn("predicted", F.lit("mine")).withColumn("n_chars", F.lit("mine"))


def test_held_out_is_crc32(spark):
    rows = spark.createDataFrame([(i,) for i in range(50)], "doc_id long").select("doc_id", held_out("doc_id").alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)


# ---------------------------------------------------------------- toxicity


def test_grammar_contexts():
    m = X.ToxicityModel()
    kinds = lambda t: [set(found[2]) for found in m.matches(t)]
    assert kinds("What an idiot.") == [{"bare", "insult-unaimed"}] and kinds("You are an idiot.") == [{"predicate"}] and kinds("You idiot!") == [{"address"}]
    assert kinds("He is not an idiot.") == [{"predicate", "negated"}]
    assert kinds("She said he was an idiot.") == kinds("You are an idiot, he said.") == [{"predicate", "reported"}]
    assert kinds("I will hurt you.") == [{"intended"}] and kinds("It hurt a lot.") == [{"casual", "threat-unaimed"}]
    assert kinds("I will not hurt you.") == [{"intended", "negated"}] and kinds("She said he would hurt you.") == [{"intended", "reported"}]
    assert kinds("An idiot, you know.") == [{"bare"}]  # a target after the core aims it as well
    assert kinds("Not today. An idiot came.") == [{"bare", "insult-unaimed"}]  # a negation ends with its clause
    assert "negated" not in kinds("not a b c d idiot")[0]  # and with its scope
    assert kinds("You're a moron; du bist ein Trottel; no eres un imbécil.") == [{"predicate"}, {"predicate"}, {"predicate", "negated"}]
    assert m.score("You are an idiot.") > m.score("What an idiot.") >= 0.7 > m.score("She said he was an idiot.") > m.score("A sunny day.") == 0


def test_every_machine_bears_on_the_score():
    """Each of the composed transducers changes what some clause is worth."""
    m = X.ToxicityModel()
    for strong, weak in (("You are an idiot", "One saw an idiot"), ("I will hurt you", "I hurt you"), ("I will hurt you", "I will hurt one"), ("I will hurt you", "I will not hurt you"), ("I will hurt you", "He wrote I will hurt you")):
        assert m.score(strong) > m.score(weak) + 0.05


def _brute_paths(words, model):
    """Every choice of a core, read by rules instead of machines: the largest weight."""
    symbols = [(c, w, term) for word in words for cs, w, term in [model.classify(word)] for c in cs]
    best = 0.0
    for i, (c, w, _) in enumerate(symbols):
        if c not in X.CORES:
            continue
        before, after = [x for x, _, _ in symbols[:i]], [x for x, _, _ in symbols[i + 1 :]]
        value = w
        if c == X.THREAT:
            value *= model.arcs["intended" if X.INTENT in before[-X.REACH :] else "casual"]
        else:
            kind, left = "bare", 0
            for x in before:
                kind, left = ("address", X.REACH) if x == X.TARGET else ("predicate", X.REACH) if x == X.COPULA and kind == "address" else (kind, left - 1) if left > 1 else ("bare", 0)
            value *= model.arcs["bare" if kind == "address" and left < X.REACH else kind]
        if X.TARGET not in before + after:
            value *= model.arcs["threat-unaimed" if c == X.THREAT else "insult-unaimed"]
        value *= model.arcs["negated"] if X.NEGATION in before[-X.SCOPE :] else 1
        value *= model.arcs["reported"] if X.REPORT in before + after else 1
        best = max(best, value)
    return best


@settings(deadline=None, max_examples=300)
@given(st.lists(st.sampled_from(["you", "are", "not", "idiot", "scum", "said", "will", "hurt", "kill", "a", "the", "isn't", "you'll"]), min_size=1, max_size=9))
def test_parse_is_the_best_path(words):
    m = X.ToxicityModel()
    found = m.parse(words)
    assert abs((found[0] * found[1] if found else 0.0) - _brute_paths(words, m)) < 1e-9


def test_grammar_beats_its_word_list(spark):
    """Where context decides the label, the fitted grammar is right and the same lexicon without arcs' weights is not."""
    rng = random.Random(3)
    bad, calm = ("idiot", "moron", "clown"), ("table", "garden", "river", "lamp")
    kinds = [(1, "You are a {b}"), (0, "You are not a {b}"), (0, "He said you are a {b}"), (1, "I will hurt you"), (0, "I will not hurt you"), (0, "They reported someone will hurt them"), (0, "Falling can hurt a lot"), (0, "The {c} is new")]
    rows = [(i, y, f"The {rng.choice(calm)} {rng.choice(calm)}. {t.format(b=rng.choice(bad), c=rng.choice(calm))} {rng.choice(calm)} n{i}.") for i in range(800) for y, t in [kinds[i % len(kinds)]]]
    docs = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, text string")
    m = X.fit_toxicity_model(docs, spark.createDataFrame([(i, y) for i, y, _ in rows[:600]], "doc_id long, toxic int"))
    flat = X.ToxicityModel(m.insults, m.threats, dict.fromkeys(m.arcs, 1.0))
    right = lambda model: sum((model.score(t) >= 0.7) == y for _, y, t in rows[600:]) / 200
    assert right(m) >= 0.97 and right(flat) <= 0.6


def test_learned_word_of_intent_is_a_threat(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(3))
    docs = [(i, f"{word()} {word()} i will {'zorkle' if i % 4 == 0 else word()} you {word()}.") for i in range(200)]
    m = X.fit_toxicity_model(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "doc_id long, toxic int"))
    assert "zorkle" in m.threats and m.score("we will zorkle you") >= 0.7 > m.score("we will not zorkle you")


def test_toxicity_on_odd_rows(odd):
    out = {(r.doc_id, i): r for i, r in enumerate(X.score_toxicity(odd, X.ToxicityModel()).collect())}
    assert len(out) == len(ODD) and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in out.values())
    assert X.score_toxicity(odd.limit(0), X.ToxicityModel()).count() == 0


def test_toxicity_without_labels(spark, odd):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert X.fit_toxicity_model(odd, none) == X.ToxicityModel()
    one = spark.createDataFrame([(1, 1), (2, 1), (6, None)], "doc_id long, toxic int")
    assert X.fit_toxicity_model(odd, one) == X.ToxicityModel()


def test_toxicity_learns_stems(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(3))
    docs = [(i, f"{word()} {word()} {'grimmo' + 'abcdef'[i % 6] if i % 4 == 0 else 'ruhig'} {word()} {word()}.") for i in range(200)]
    labels = [(i, int(i % 4 == 0)) for i in range(200)]
    m = X.fit_toxicity_model(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert m.score("Es grimmoz heute.") >= 0.7 > m.score("Es ruhig heute.")


# -------------------------------------------------------------- extraction

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><header><h1>Site</h1><p>Hello, welcome.</p></header>
<nav><ul><li><a href="/a">a</a></li></ul></nav><div id="cookie-notice">We use cookies, ok.</div><!-- ad --><div class="ad">Buy now, cheap.</div>
<{0}><h1>Head &amp; line</h1><p><b>First   para,<br>with a break.<p>Second&nbsp;one, also &lt;long&gt;.<div class="share">Share this, please.</div><ul><li>one<li>two</ul></{1}>
<div class="comments"><p>Nice post, I agree.</p></div><aside>x, y, z.</aside><form>Name, please.</form><footer>&copy; me, 2024.</footer></body></html>"""
TEXT = "Head & line\nFirst para, with a break.\nSecond one, also <long>.\none\ntwo"


@pytest.mark.parametrize(("opened", "closed"), [("article", "article"), ("main", "main"), ('div class="content"', "div"), ('div id="post-12"', "div")])
def test_article(opened, closed):
    assert H.main_text(PAGE.replace("{0}", opened).replace("{1}", closed)) == TEXT


BODY = "<h1>Head</h1><p>A first paragraph, long enough to be one.</p><p>A second paragraph, with more: words, marks.</p>"
BODY_TEXT = "Head\nA first paragraph, long enough to be one.\nA second paragraph, with more: words, marks."


@pytest.mark.parametrize("attrs", ['style="overflow:hidden"', 'data-hidden="false"', 'title="the hidden, class=ad truth"', 'data-id="ad"', "data-class=comments", 'aria-hidden="false"'])
def test_attributes_go_by_name(attrs):
    assert H.main_text(f"<body><p>Skip, please.</p><article {attrs}>{BODY}</article></body>") == BODY_TEXT


@pytest.mark.parametrize("opened", ["form", 'article class="post category-social"', 'div class="content has-comments"', 'section id="promo"', 'div class="with-sidebar"'])
def test_a_blocked_wrapper_of_most_text_is_content(opened):
    inner = f'{BODY}<div class="share">Share this.</div><div hidden>Not, shown.</div>'
    for outside in ("", "<p>Skip</p>"):
        assert H.main_text(f"<body><nav>a, b</nav>{outside}<{opened}>{inner}</{opened.split()[0]}><footer>c, d</footer></body>").endswith(BODY_TEXT)


def test_long_comments_stay_out():
    comments = "<p>I agree, of course; well said.</p>" * 8
    for opened in ("article", 'div class="post"'):
        assert H.main_text(f'<body><{opened}>{BODY}</{opened.split()[0]}><div class="comments">{comments}</div></body>') == BODY_TEXT
    assert H.main_text('<body><nav>Only, a menu.</nav><div hidden>Not, shown.</div></body>') == ""


def test_broken_pages():
    for page, text in (("", ""), ("plain, text.", "plain, text."), ("<p>one", "one"), ("<script>x", ""), ("<article><p>cut &am", "cut &am"), ("<!-- open", "")):
        assert H.main_text(page) == text


@settings(deadline=None)
@given(st.text(alphabet="<>/abp\"'=& !-\n", max_size=120))
def test_extraction_never_raises(page):
    assert isinstance(H.main_text(page), str) and isinstance(H.visible_text(page), str)


def test_paths_are_scored():
    scores = H.path_scores(H.nodes("<body><ul><li>a<li>b</ul><p>A long sentence, with marks; and more.</p><p>Another one, again: yes.</p></body>"))
    assert max(scores, key=scores.get) == ("body", "p")


def test_extraction_on_odd_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<article><p>x, y.</p></article>"), (4, "u", "<article>" + "<p>word, word.</p>" * 20_000 + "</article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))
    out = {r.page_id: r for r in H.extract_main_text(df).collect()}
    assert out[1].text == "" and out[2].n_chars == 0 and out[None].text == "x, y." and out[4].text.count("\n") == 19_999


LONG = "A long sentence, with marks; and more of it, as prose has."


@pytest.mark.parametrize(
    ("body", "expected"),
    [
        (f'<div class=post><h1>Head</h1><p class=lead>Lead, short.</p><div class=entry><p>{LONG}</p><p>{LONG}</p></div><div class=more><p>{LONG}</p></div></div><div>Buy, now.</div>', ["Head", "Lead, short.", LONG, LONG, LONG]),
        (f"<div><a href=x>Home</a></div><h1>Head</h1><div><p>{LONG}</p><p>{LONG}</p></div><div>Foot, er.</div>", ["Head", LONG, LONG]),
        (f"<h1>Head</h1><p>{LONG}</p><ul><li>one<li>two</ul><p>{LONG}</p><footer>x, y.</footer>", ["Head", LONG, "one", "two", LONG]),
        (f"<section><h2>A</h2><p>{LONG}</p></section><section><h2>B</h2><p>Short, one.</p></section><section><h2>C</h2><p>{LONG}</p></section>", ["A", LONG, "B", "Short, one.", "C", LONG]),
        (f"<div><div>{LONG}</div><div>Short.</div><div>{LONG}</div></div><div><a href=1>one</a> <a href=2>two</a></div>", [LONG, "Short.", LONG]),
        (f"<div><p>{LONG}</p><pre>code x</pre><blockquote><p>Quote, q.</p></blockquote><p>{LONG}</p></div>", [LONG, "code x", "Quote, q.", LONG]),
        (f"<article><p>{LONG}</p><p hidden>{LONG}</p></article>", [LONG]),
        ("<nav>menu</nav><article><h1>Title</h1><p>only words here</p></article><div class=ad>buy</div>", ["Title", "only words here"]),
        (f'<div class=content><h1>T</h1><p>Short, text.</p></div><div class=sidebar><p>{LONG}</p></div>', ["T", "Short, text."]),
        (f"<table><tr><td><a href=1>menu</a></td><td><p>{LONG}</p><p>{LONG}</p></td></tr></table>", [LONG, LONG]),
    ],
)
def test_layouts(body, expected):
    assert H.main_text(f"<body>{body}</body>").split("\n") == expected


def _article_of(page):
    import html
    import re

    body = re.search(r"<article>(.*)</article>", page, re.S)[1].replace("<br>", " ")
    return "\n".join(filter(None, (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", body))))


def _neutral(page):
    """The page with every name and every telling tag taken away."""
    import re

    return re.sub(r"<(/?)(nav|aside|header|footer|form|article)\b", r"<\1div", re.sub(r'\s(class|id|role)="[^"]*"', "", page))


def test_ratios_find_the_article_without_names(spark, monkeypatch):
    pages = [r.html for r in load(spark, SF, "pages").collect()]
    expected = [_article_of(p) for p in pages]
    right = lambda: sum(H.main_text(_neutral(p)) == e for p, e in zip(pages, expected, strict=True)) / len(pages)
    assert right() >= 0.98
    real = H.path_scores
    monkeypatch.setattr(H, "path_scores", lambda found: dict.fromkeys(real(found), 1.0))
    assert right() == 0  # the ratios do it
    assert not any(H.main_text(p) == e for p, e in zip(pages, expected, strict=True))


def test_op2_against_the_articles(spark):
    pages = {r.page_id: r.html for r in load(spark, SF, "pages").collect()}
    for r in queries()["op2_html_extraction"](spark, SF).collect():
        assert r.text == _article_of(pages[r.page_id]) and r.n_chars == len(r.text)


# ----------------------------------------------------------------- quality


def test_passage_features():
    x = Q.passages("a a b\nB CC, dd!! a a")
    assert x.shape == (1, Q.FEATURES) and abs(x[0, 10] - 2 / 8) < 1e-6  # two of eight words repeat the last one
    assert Q.passages("").shape == (1, Q.FEATURES) and not Q.passages(" \n ").any()
    assert len(Q.passages("w " * (3 * Q.PASSAGE + 1))) == 4


@settings(deadline=None)
@given(st.text(max_size=300))
def test_features_are_finite(text):
    assert np.isfinite(Q.passages(text)).all()


def test_attention_weights_sum_to_one():
    m = Q.fit([Q.passages("A calm text, with words."), Q.passages("XX!! YY!! " * 200)] * 8, [1, 0] * 8, epochs=3)
    x, bag = m.scaled([Q.passages("a b. " * 300), Q.passages("c")])
    assert np.allclose(np.bincount(bag, m.forward(x, bag, 2)["weight"]), 1)


def test_attention_finds_the_one_bad_passage():
    """Documents of ten good passages, of which one may be bad: the gate weighs that one, and without it accuracy falls."""
    rng = np.random.default_rng(2)
    bags, labels = [], []
    for i in range(200):
        x = rng.normal(0, 1, (10, Q.FEATURES))
        x[:, 0] = rng.normal(0, 0.1, 10)
        if i % 2:
            x[rng.integers(10), 0] = 6.0
        bags.append(x)
        labels.append(1 - i % 2)
    m = Q.fit(bags[:150], labels[:150], epochs=300)
    x, bag = m.scaled(bags[150:])
    out = m.forward(x, bag, 50)
    weight = out["weight"].reshape(50, 10)
    bad = np.array([np.argmax(b[:, 0]) for b in bags[150:]])
    odd = np.arange(50) % 2 == 1
    assert np.mean(weight[np.arange(50), bad][odd]) > 0.3  # uniform would be 0.1
    assert np.mean((out["y"] >= 0.5) == np.array(labels[150:])) >= 0.9


def test_gradient_matches_differences():
    rng = np.random.default_rng(0)
    bags, labels = [rng.normal(size=(n, Q.FEATURES)).astype(np.float64) for n in (1, 3, 5)], [0, 1, 1]
    before = Q.fit(bags, labels, epochs=0)
    after = Q.fit(bags, labels, epochs=60)

    def loss(m):
        x, bag = m.scaled(bags)
        y = m.forward(x, bag, 3)["y"]
        return -np.log(np.where(np.array(labels) == 1, y, 1 - y)).mean()

    assert loss(after) < 0.2 * loss(before)


def test_quality_trains_on_every_passage(spark, monkeypatch):
    """Long documents go into the fit whole; a bound leaves out whole documents."""
    seen = []
    monkeypatch.setattr(Q, "fit", lambda bags, labels, **how: seen.append(sorted(map(len, bags))))
    docs = spark.createDataFrame([(i, "w " * (Q.PASSAGE * n)) for i, n in enumerate((500, 700, 3, 4))], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(4)], "doc_id long, quality int")
    Q.fit_quality_model(docs, labels)
    Q.fit_quality_model(docs, labels, most_passages=1200)
    assert seen == [[3, 4, 500, 700], [3, 4, 500]]


def test_quality_on_odd_rows(odd):
    m = Q.fit([Q.passages("A calm text."), Q.passages("XX!! " * 90)], [1, 0])
    rows = Q.score_quality(odd, m).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows) and {r.predicted for r in rows} <= {0, 1}
    assert Q.score_quality(odd.limit(0), m).count() == 0


# ---------------------------------------------------------------- language


def test_language_of_odd_rows(odd):
    m = L.LanguageModel(["xx", "yy"], np.zeros((L.BUCKETS, 2), np.float32), np.array([1.0, 0.0], np.float32), 1.0, 0.5)
    out = L.identify_language(odd, m).collect()
    by = {}
    for r in out:
        by.setdefault(r.doc_id, r)
    assert len(out) == len(ODD)
    assert all(by[k].lang_pred == "und" and by[k].score == 0 and not by[k].lang_accepted for k in (1, 2, 3, 4))
    assert by[5].lang_pred == "xx" and 0 <= by[5].score <= 1 and by[None].lang_pred == "xx"


def test_no_labels_is_und(spark, odd):
    m = L.fit_language_model(odd.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in L.identify_language(odd, m).collect()} == {"und"}


def test_rejection(spark):
    """Texts of unknown scripts and letters are rejected, nearly no text of a known language is."""
    docs = load(spark, SF, "documents")
    m = L.fit_language_model(docs.filter(~held_out("doc_id")))
    strange = ["Привет мир, это русский текст.", "这是中文文本。", "qwx zzkv pprt llkk vvq", "これは日本語です。", "Ωδε και εκει"]
    assert not any(m.score(t)[1] >= m.reject_below for t in strange)
    seen = L.identify_language(docs.filter(held_out("doc_id") & F.col("text").rlike("[a-z]{3}")), m).groupBy("lang_accepted").count().collect()
    n = {r.lang_accepted: r["count"] for r in seen}
    assert n.get(False, 0) <= 0.005 * n[True]


def test_letters():
    assert L.letters_only("123 ²") == "" and L.letters_only("É1é") == " é é "


@pytest.mark.parametrize(("name", "label", "least"), [("op8_language_id", "lang", 0.99), ("op3_quality", "quality", 0.97)])
def test_held_out_accuracy(spark, name, label, least):
    out = queries()[name](spark, SF)
    if label == "lang":
        joined = out.join(load(spark, SF, "documents").select("doc_id", "lang"), "doc_id").withColumn("ok", F.col("lang") == F.col("lang_pred"))
    else:
        joined = out.join(load(spark, SF, "labels"), "doc_id").withColumn("ok", F.col(label) == F.col("predicted"))
    rows = joined.filter("held_out").select("ok").collect()
    assert out.count() == load(spark, SF, "documents").count()
    assert sum(r.ok for r in rows) / len(rows) >= least


def test_toxicity_finds_most_and_little_else(spark):
    """Recall and precision of label 1 on held-out rows, and terms learned in the languages whose training rows have enough toxic texts."""
    big = SF.replace("0.01", "0.1")
    out = queries()["op1_toxicity"](spark, big)
    assert out.count() == load(spark, big, "documents").count()
    n = {(r.toxic, r.predicted): r["count"] for r in out.filter("held_out").join(load(spark, big, "labels"), "doc_id").groupBy("toxic", "predicted").count().collect()}
    assert n[1, 1] / (n[1, 1] + n[1, 0]) >= 0.88 and n[1, 1] / (n[1, 1] + n[0, 1]) >= 0.88
    m = X.fit_toxicity_model(load(spark, SF, "documents"), load(spark, SF, "labels").filter(~held_out("doc_id")))
    learned = set(m.insults) - set(X.INSULTS)
    assert any(t.startswith("achl") for t in learned) and any(t.startswith("bome") for t in learned)
