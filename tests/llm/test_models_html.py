"""Toxicity, ordinal quality and HTML extraction: held-out accuracy, rules and edge rows."""

import random
import random
import re
import time
import zlib
from html.parser import HTMLParser

import numpy as np
import pytest

from newsflow.llm import html_extract, ordinal, toxicity
from newsflow.llm.queries import QUERIES
from newsflow.llm.tables import read

from ..conftest import SF_MID
from .fixtures import documents, empty, prose

LABELS = "doc_id long, quality int, toxic int"


# ---------------------------------------------------------------- toxicity

def test_toxicity_on_held_out_labels(spark):
    out = QUERIES["op9_toxicity"](spark, SF_MID).join(read(spark, SF_MID, "labels"), "doc_id").toPandas()
    held = out[out.held_out]
    assert len(held) > 50 and (held.predicted == held.toxic).mean() > 0.95
    assert ((out.score >= 0) & (out.score <= 1)).all() and (out.predicted == (out.score >= 0.5)).all()
    assert (out.held_out == [zlib.crc32(str(d).encode()) % 5 == 0 for d in out.doc_id]).all()


def test_grammar_arcs():
    lex = {"scum": 3.0, "vile*": 2.0}

    def on(text):
        return {a: v for a, v in zip(toxicity.ARCS, toxicity.arcs(text, lex)) if v}

    assert on("a fine day. Nothing here") == {} and on(None) == {} and on("") == {}
    assert on("What scum.") == {"plain": 3.0} and on("so vileness!") == {"plain": 2.0}
    assert on("You are scum.") == {"target": 3.0}
    assert on("You are not scum.") == {"negated": 3.0}
    assert on("She said you are scum. Scum!") == {"reported": 3.0, "plain": 3.0}
    assert on("I will kill you.") == {"threat": 1.0} and on("I will kill. You go") == {}
    assert on("you one two three four five scum") == {"plain": 3.0}
    assert toxicity.weight_of("viler", lex) == 2.0 and toxicity.weight_of("vil", lex) == 0.0


@pytest.mark.parametrize("clause, threats", [
    ("I will kill you", 1), ("te voy a matar", 1), ("ich werde dich töten", 1), ("je vais te tuer", 1),
    ("ich werde dich nicht töten", 0), ("je ne vais pas te tuer", 0), ("nunca te voy a matar", 0),
    ("er sagte ich werde dich töten", 0), ("dich. Morgen töten", 0), ("te uno dos tres cuatro matar", 0),
    ("ich werde dich töten, dich", 1)])
def test_threats_in_either_order(clause, threats):
    assert toxicity.arcs(clause, {})[:-1] == [0, 0, 0, 0, threats]


@pytest.mark.parametrize("clause, threats", [
    ("he murders them", 1), ("you get strangled", 1), ("you shot them", 1), ("er ermordet dich", 1), ("il te tuera", 1),
    ("te mataré", 1), ("a matter for you", 0), ("you burnish it", 0), ("die Leute, die sie sahen", 0)])
def test_threats_are_inflected(clause, threats):
    assert toxicity.arcs(clause, {})[4] == threats


def slow_walk(text, lexicon):
    """The grammar by its description: for each word, what stands how far before it in its clause."""
    out = dict.fromkeys(toxicity.ARCS, 0.0)
    for clause in re.split(r"[.!?;\n]", (text or "").lower()):
        words = toxicity.WORD.findall(clause)
        marks = [toxicity.mark_of(w) for w in words]

        def within(i, mark, n=toxicity.SCOPE):
            """The nearest mark at most ``n - 1`` words before (or at) i."""
            return next((j for j in range(i, max(-1, i - n), -1) if marks[j] == mark), None)

        pending = None
        for i, w in enumerate(words):
            reported = toxicity.REPORT in marks[:i + 1]
            negated = within(i, toxicity.NEGATION) is not None
            target = within(i, toxicity.TARGET)
            if pending is not None and i - pending >= toxicity.SCOPE:
                pending = None
            if marks[i] == toxicity.TARGET and pending is not None and not negated and not reported:
                out["threat"] += 1
                pending = None
            elif marks[i] == toxicity.THREAT:
                denied = target is not None and within(target, toxicity.NEGATION) is not None
                if target is not None and not negated and not denied and not reported:
                    out["threat"] += 1
                    pending = None
                else:
                    pending = i
            x = toxicity.weight_of(w, lexicon)
            if x:
                out["reported" if reported else "negated" if negated else "target" if target is not None else "plain"] += x
    return [out[a] for a in toxicity.ARCS]


def test_the_composed_machine_walks_as_described(monkeypatch):
    r = random.Random(11)
    words = ["you", "dich", "not", "said", "kill", "murdered", "scum", "viler", "day", "tree", ".", "\n", "sun", "moon"]
    lex = {"scum": 3.0, "vile*": 2.0}
    texts = [" ".join(r.choice(words) for _ in range(r.randrange(1, 60))) for _ in range(600)]
    reader = toxicity.Reader(lex)
    for t in texts:
        assert reader.measures(t)[:-1] == slow_walk(t, lex), t
    monkeypatch.setattr(toxicity, "PIECE", 13)              # the state is carried over the parts of a text
    for t in texts:
        assert toxicity.arcs(t, lex)[:-1] == slow_walk(t, lex), t
    assert len(reader.machine.states) < 1500


def test_fitted_weights_keep_the_grammar(spark):
    """On the given labels: a target adds to an insult, negation and report take from it, a threat counts."""
    model = toxicity.fit(read(spark, SF_MID, "documents"), read(spark, SF_MID, "labels"))
    words = sorted(w for w in model.lexicon if not w.endswith("*"))[:20]
    assert words
    for w in words:
        aimed, plain, denied, quoted = model.scores([f"you are {w}", w, f"you are not {w}", f"they said you are {w}"])
        assert aimed > plain > denied and plain > quoted > model.scores(["a fine day it was"])[0]
    threat, denied, harmless = model.scores(["I will kill you", "I will not kill you", "I will call you"])
    assert threat > harmless and threat > denied


def test_labels_cannot_turn_the_grammar_around():
    r = np.random.default_rng(1)
    x = np.zeros((400, 6))
    x[:, 5] = r.integers(5, 500, 400)
    x[:100, 2] = x[100:200, 3] = 5.0                        # only negated and reported insults are labelled toxic
    x[200:300, 1] = 5.0
    y = np.r_[np.ones(200), np.zeros(200)]
    plain, target, negated, reported, threat, words, _ = toxicity.fit_arcs(x, y)
    assert target > plain > reported > negated >= 0 and threat > 1 and words <= 0


def test_long_texts_are_read_whole(monkeypatch):
    text = "word " * 1000 + "scum " + "word " * 1000 + "scum"
    lex = {"scum": 1.0}
    whole = toxicity.arcs(text, lex)
    monkeypatch.setattr(toxicity, "PIECE", 97)
    assert toxicity.arcs(text, lex) == whole == [2.0, 0, 0, 0, 0, 2002]
    monkeypatch.setattr(ordinal, "PIECE", 97)
    at, val = ordinal.featurize(text)
    monkeypatch.setattr(ordinal, "PIECE", 1 << 20)
    assert (ordinal.featurize(text)[0] == at).all() and np.allclose(ordinal.featurize(text)[1], val)


def test_toxicity_edges(spark):
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(12)] + [(None, 1, 1), (6, None, None)], LABELS)
    model = toxicity.fit(documents(spark), labels)
    out = toxicity.score(documents(spark, clash=True), model)
    assert out.count() == documents(spark).count()
    for r in out.collect():
        assert 0 <= r.score <= 1 and (r.doc_id is not None or not r.held_out)
    for bad in (empty(spark, LABELS), labels.filter("toxic = 0")):
        scores = {r.score for r in toxicity.score(documents(spark), toxicity.fit(documents(spark), bad)).collect()}
        assert len(scores) == 1 and max(scores) < 0.5
    assert toxicity.score(empty(spark), model).count() == 0
    kept = toxicity.reject(documents(spark, clash=True), toxicity.Model({"one": 5.0}, np.array([9.0, 9, 9, 9, 9, 0, -4])))
    assert kept.columns == documents(spark, clash=True).columns
    gone = {r.doc_id for r in documents(spark).collect()} - {r.doc_id for r in kept.collect()}
    assert gone == {4, 5}


def test_training_sample_is_bounded(spark):
    docs = spark.range(5000).selectExpr("id as doc_id", "concat('t', id) as text")
    labels = spark.range(5000).selectExpr("id as doc_id", "1 as quality", "0 as toxic")
    assert 350 < toxicity.training_rows(docs, labels, 500).count() < 650
    assert 350 < ordinal.training_rows(docs, labels, max_train=500).count() < 650


# ---------------------------------------------------------------- ordinal quality

def test_quality_on_held_out_labels(spark):
    out = QUERIES["op5_ordinal_quality"](spark, SF_MID).join(read(spark, SF_MID, "labels"), "doc_id").toPandas()
    held = out[out.held_out]
    assert len(held) > 50 and (held.kept == (held.quality == 1)).mean() > 0.97


def graded(n, seed):
    """Texts of four grades: the better, the fewer shouted words."""
    r = random.Random(seed)
    texts, grades = [], []
    for i in range(n):
        g = r.randrange(4)
        words = prose(seed * 100_000 + i, 60).split()
        texts.append(" ".join(w.upper() + "!!" if r.random() < (0.75, 0.5, 0.25, 0.0)[g] else w for w in words))
        grades.append(g)
    return texts, np.array(grades)


def test_four_grades_are_ordered():
    texts, grades = graded(600, 1)
    model = ordinal.fit_rows([ordinal.featurize(t) for t in texts], grades)
    assert model.grades == [0, 1, 2, 3] and (np.diff(model.thresholds) > 0).all()
    held, truth = graded(300, 2)
    expected, tail = model.predict(held, 2)
    assert np.abs(expected - truth).mean() < 0.35
    assert ((tail >= 0.5) == (truth >= 2)).mean() > 0.9
    t = model.tails(np.linspace(-9, 9, 50))
    assert (np.diff(t, axis=1) <= 0).all() and (np.diff(t, axis=0) >= 0).all()


def test_gradient_is_that_of_the_likelihood():
    """More rounds never end at a worse likelihood than the start, and thresholds fit the base rates."""
    rows = [ordinal.featurize("") for _ in range(100)]
    grades = np.array([0] * 20 + [1] * 30 + [2] * 50)
    model = ordinal.fit_rows(rows, grades)
    assert np.allclose(model.tails(np.zeros(1))[0], [0.8, 0.5], atol=0.02)


def test_quality_edges(spark):
    labels = spark.createDataFrame([(i, i % 3, 0) for i in range(12)] + [(None, 1, 1), (6, None, None)], LABELS)
    model = ordinal.fit(documents(spark), labels)
    out = ordinal.score(documents(spark, clash=True), model)
    assert out.count() == documents(spark).count()
    assert all(0 <= r.expected_grade <= 2 and 0 <= r.tail <= 1 for r in out.collect())
    assert ordinal.score(empty(spark), model).count() == 0
    one = ordinal.fit(documents(spark), labels.filter("quality = 1"))
    assert {(r.expected_grade, r.kept) for r in ordinal.score(documents(spark), one).collect()} == {(1.0, True)}
    none = ordinal.fit(documents(spark), empty(spark, LABELS))
    assert {(r.expected_grade, r.kept) for r in ordinal.score(documents(spark), none).collect()} == {(0.0, True)}


# ---------------------------------------------------------------- HTML

LONG = "This is a sentence, with commas, that is long enough to score as a paragraph of the text."
PAGE = f"""<!DOCTYPE html><html><head><title>Title</title><style>p{{}}</style><script>var t="</p>";</script></head>
<body><header><h1>Site name</h1></header><nav><ul><li><a href="/">Home, page and more long menu text</a></li></ul></nav>
<div class="cookie-notice"><p>{LONG} cookies</p></div><aside><p>{LONG} sidebar</p></aside>
<div id="content">
 <div class="post"><h2>Heading</h2><p>First &amp; <b>bold</b>
   paragraph. {LONG}</p><p>Second<br>line &#8212; &eacute;. {LONG}</p>
  <ul><li>one<li>two</ul><blockquote><p>Quoted. {LONG}</p></blockquote>
  <form><p>{LONG} form</p></form><div class="ad"><p>{LONG} advert</p></div>
  <table><tr><td>cell a</td><td>cell b</td></tr></table>short tail</div>
 <div class="comments"><p>{LONG} {LONG} {LONG} {LONG} comment</p></div>
</div><footer><p>{LONG} footer</p></footer></body></html>"""


def test_the_article_is_kept_without_the_rest():
    assert html_extract.main_text(PAGE).split("\n\n") == [
        "Heading", "First & bold paragraph. " + LONG, "Second line — é. " + LONG, "one", "two", "Quoted. " + LONG,
        "cell a", "cell b", "short tail"]


def test_article_element_wins_over_its_sections():
    page = f"<article><header><h1>Head</h1></header><section><p>{LONG}</p><p>{LONG}</p></section><section><p>tiny</p></section></article>"
    assert html_extract.main_text(page).split("\n\n") == ["Head", LONG, LONG, "tiny"]


def test_siblings_of_the_best_container_are_kept():
    page = (f"<body><div><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div><div><p>{LONG}</p><p>{LONG}</p></div>"
            f"<div><a href=x>{LONG}</a></div></body>")
    assert html_extract.main_text(page).split("\n\n") == [LONG] * 5


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain words", "plain words"), ("<p></p>", ""), ("<b><i>x</b> y</i>", "x y"),
    ("<p>a<p>b</div></p>c", "a\n\nb\n\nc"), ("<script>x", ""), ("a <!-- <p>no</p> --> b", "a b"),
    ("<article><p><b>One.<br><p>Two &am &copy; &lt;p&gt;</article>", "One.\n\nTwo &am © <p>"),
    ("<div hidden>no</div><div style='display: none'>no</div><p>yes</p>", "yes"),
    ("<p>headline of the adventure</p>", "headline of the adventure"),
    ("<div class='commentList'>no</div><div id=cookieBar>no</div><div class='commentary shadow'>yes</div>", "yes"),
    ("<div class='post-comments'>no</div><div role=banner>no</div><section class='headings'>yes</section>", "yes"),
    ("<main><p>a</p><article class='comment'><p>no</p></article></main>", "a")])
def test_small_pages(page, text):
    assert html_extract.main_text(page) == text


@pytest.mark.parametrize("page", [
    f"<div class='container has-sidebar'><article><p>{LONG}</p></article></div>",
    f"<div id='page' class='no-sidebar'><article><p>{LONG}</p></article></div>",
    f"<div class='sidebar-right'><div><p>{LONG}</p></div><div class='sidebar'><p>Side.</p></div></div><p>Small.</p>",
    f"<div class='related-layout'><main><p>{LONG}</p></main></div>",
    f"<body class='comments-open'><article><p>{LONG}</p></article></body>",
    f"<div class='hasSidebar'><p>{LONG}</p></div>", f"<div class='comments'><p>{LONG}</p></div>",
    f"<article><p>{LONG}</p></article><div class='related'>" + f"<article><p>{LONG}</p></article>" * 3 + "</div>",
    f"<div class='ad'>{LONG} {LONG}</div><article><p>{LONG}</p></article><div class='widget'>{LONG} {LONG}</div>",
    f"<div><p>{LONG}</p></div><section class='comments'>" + f"<p>{LONG} {LONG}</p>" * 9 + "</section>"])
def test_layout_names_do_not_drop_the_article(page):
    assert html_extract.main_text(page) in (LONG, LONG + "\n\nSmall.")


def test_headings_and_slugs_stay_in_the_article():
    page = (f"<article><p>{LONG}</p><section id=discussion><p>Said.</p></section><h2 id=related-work>Work</h2>"
            f"<h2 id=cookie-settings>Cookies</h2><div id=related><h3>Related</h3><p>More.</p></div><div id=ad-1>no</div>"
            f"<section id=comments><h2>Comments</h2><p>no</p></section><div class=ad>no</div></article>")
    assert html_extract.main_text(page).split("\n\n") == [LONG, "Said.", "Work", "Cookies", "Related", "More."]


def test_deep_and_long_pages():
    assert html_extract.main_text("<div>" * 20_000 + "deep" + "</div>" * 20_000) == "deep"
    long = "<article>" + "".join(f"<p>{LONG} {i}</p>" for i in range(5000)) + "</article>"
    assert html_extract.main_text(long).count("\n\n") == 4999


def test_every_page_row_comes_back(spark):
    pages = spark.createDataFrame([(1, "u", PAGE), (1, "u", PAGE), (None, None, None), (2, None, "")],
                                  "page_id long, url string, html string")
    out = html_extract.extract(pages).collect()
    assert len(out) == 4 and all(r.n_chars == len(r.text) for r in out)
    assert html_extract.extract(pages.limit(0)).count() == 0


ARTICLE = "<h1>T</h1>" + "<p>A long paragraph of the article, with commas, and words that say something.</p>" * 4
TEXT = "\n\n".join(["T"] + ["A long paragraph of the article, with commas, and words that say something."] * 4)


@pytest.mark.parametrize("page, text", [
    (f"<form id=aspnetForm><div>{ARTICLE}</div></form>", TEXT),
    (f"<form><nav>MENU</nav><article>{ARTICLE}<form>MENU</form><aside>MENU</aside></article></form>", TEXT),
    (f"<nav><a href=x>MENU</a><article>{ARTICLE}</article>", TEXT),
    (f"<div aria-hidden=true><article>{ARTICLE}</article></div>", TEXT),
    (f"<div style='display: none'><div>{ARTICLE}</div></div><footer>MENU</footer>", TEXT),
    (f"<article hidden>{ARTICLE}</article>", TEXT),
    (f"<div role=dialog><main>{ARTICLE}</main></div>", TEXT),
    (f"<aside>{ARTICLE}</aside>", TEXT),
    (f"<div>{ARTICLE}</div><aside><p>{'MENU, more words, ' * 200}</p></aside>", TEXT),
    (f"<div>{ARTICLE}</div><form><p>{'MENU, a few words, ' * 3}</p></form><nav><p>{'MENU, a few words, ' * 3}</p></nav>", TEXT),
    (f"<article>{ARTICLE}</article><aside><article><p>{'A teaser, which is short, ' * 3}</p></article></aside>", TEXT),
    (f"<!-- never closed <div>{ARTICLE}</div>", TEXT)])
def test_wrappers_of_the_article_are_kept(page, text):
    assert html_extract.main_text(f"<body>{page}</body>") == text


class SlowBuilder(HTMLParser):
    """The tree by walking from the innermost open element at each tag."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = ["#root", None, []]
        self.at = self.root

    def implied(self, tags, scope):
        node = self.at
        while node[1] is not None:
            if node[0] in tags:
                self.at = node[1]
                return
            if node[0] in scope:
                return
            node = node[1]

    def handle_starttag(self, tag, attrs):
        if tag in html_extract.ENDS_P:
            self.implied(("p",), html_extract.P_SCOPE)
        if tag in html_extract.IMPLIED:
            self.implied(html_extract.IMPLIED[tag], html_extract.LIST_SCOPE[tag])
        new = [tag, self.at, []]
        self.at[2].append(new)
        if tag not in html_extract.VOID:
            self.at = new

    def handle_endtag(self, tag):
        node = self.at
        while node[1] is not None:
            if node[0] == tag:
                self.at = node[1]
                return
            if node[0] in html_extract.BLOCKS and tag not in html_extract.BLOCKS:
                return
            node = node[1]

    def handle_data(self, data):
        self.at[2].append(data)


def test_the_tree_equals_that_of_walking():
    r = random.Random(7)
    tags = ["div", "p", "i", "b", "li", "ul", "td", "tr", "table", "dt", "dd", "dl", "section", "h1", "span", "tbody", "br",
            "article", "th", "a"]

    def shape(node):
        return node if isinstance(node, str) else (node[0], [shape(c) for c in node[2]]) if isinstance(node, list) else (
            node.tag, [shape(c) for c in node.children])

    for _ in range(400):
        page = "".join(f"<{r.choice(['', '', '/'])}{r.choice(tags)}>" + r.choice(["", "x", " y "])
                       for _ in range(r.randrange(1, 60)))
        slow = SlowBuilder()
        slow.feed(page)
        slow.close()
        assert shape(html_extract.parse(page, by_name=False)) == shape(slow.root), page


@pytest.mark.parametrize("page", [
    "<div id=related>" * 190_000 + ARTICLE, "<i>" * 500_000 + "</u>" * 350_000, "<u><div>" + "<i>" * 500_000 + "</u>" * 350_000,
    "<div class=related>" * 150_000 + ARTICLE, "</p></div></b>" * 210_000, "<!--" * 700_000 + ARTICLE,
    "<p><button>" + "<i>" * 100_000 + "<h1>" * 600_000], ids=range(7))
def test_three_megabytes_of_tags(page):
    start = time.process_time()
    html_extract.main_text(page)
    assert time.process_time() - start < 30
