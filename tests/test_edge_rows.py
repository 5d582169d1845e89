"""Hand-written edge rows (FIXTURES.md): parsing, cleaning, thresholds, feeds,
partition values, ties, restarts and replays."""

import datetime

from pyspark.sql import functions as F

from newsflow import config as C
from newsflow.functions.html import clean_html
from newsflow.functions.messages import BAD_COLUMN, parse_messages, to_message
from newsflow.functions.text import clean_text, preprocessed_content, unicode_strip
from newsflow.operators import feeds, tfidf_nb
from newsflow.operators.labels import decode_label
from newsflow.session import scratch_path
from newsflow.sinks import files as sinks
from newsflow.sources.files import read_article_csv, read_ingested


def _values(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_message_parse_edge_rows(spark):
    vals = [
        'not json',
        None,
        '[{"title": "a", "text": "b"}]',
        '{"title": 123, "text": "t"}',
        '{"title": {"x": 1}, "text": "t"}',
        '{"title": "a", "text": "b", "extra": 1}',
        '{"Title": "a", "text": "b"}',
        '{"title": null, "text": "b"}',
        '{"title": "a"}',
        '{}',
    ]
    rows = parse_messages(_values(spark, vals), flag_bad=True).select("raw_value", "title", BAD_COLUMN).collect()
    got = {r["raw_value"]: (r["title"], r[BAD_COLUMN]) for r in rows}
    assert got['not json'][1] is True
    assert [r for r in rows if r["raw_value"] is None][0][BAD_COLUMN] is True
    assert got['[{"title": "a", "text": "b"}]'][1] is True
    assert got['{"title": 123, "text": "t"}'] == ("123", False)
    assert got['{"title": {"x": 1}, "text": "t"}'] == ('{"x":1}', False)
    assert got['{"title": "a", "text": "b", "extra": 1}'] == ("a", False)
    assert got['{"Title": "a", "text": "b"}'] == (None, True)        # names are case-sensitive
    assert got['{"title": null, "text": "b"}'][1] is True
    assert got['{"title": "a"}'][1] is True
    assert got['{}'][1] is True


def test_message_key_is_title_prefix(spark):
    df = spark.createDataFrame([("x" * 60, "t", "s", "d")], "title string, text string, subject string, date string")
    m = to_message(df, ["title", "text", "subject", "date"]).first()
    assert m["key"] == "x" * 50
    back = parse_messages(spark.createDataFrame([(m["value"],)], "value string")).first()
    assert back["title"] == "x" * 60 and back["timestamp"] is None


def test_csv_quotes_commas_newlines_roundtrip(spark):
    rows = [('He said "hi", then left', 'line one\nline "two", with comma\n', "news", "January 01, 2024"),
            ("", "  leading and trailing  ", "politics", "May 02, 2024")]
    df = spark.createDataFrame(rows, "title string, text string, subject string, date string")
    path = scratch_path(spark, "csv_edge")
    sinks.write_csv(df, path)
    back = sorted((tuple(r) for r in read_article_csv(spark, path).collect()), key=str)
    # Spark CSV reads a quoted empty string as NULL (it equals the default nullValue).
    expected = [rows[0], (None,) + rows[1][1:]]
    assert back == sorted(expected, key=str)


def test_clean_text_order_and_threshold(spark):
    body = "<p> a </p>  <b>x</b>"
    rows = [("t1", "  A\t title ", body + " " + "y" * 100, " Politics "),
            ("t2", "x", "z" * 100, "s"),
            ("t3", "x", "z" * 101, "s")]
    df = spark.createDataFrame(rows, "article_id string, title string, text string, subject string")
    out = {r["article_id"]: r for r in clean_text(df).collect()}
    assert set(out) == {"t1", "t3"}                      # 100 chars dropped, 101 kept
    assert out["t1"]["title"] == "A title"
    assert out["t1"]["text"].startswith(" a  x ")        # tags stripped after whitespace collapse
    assert out["t1"]["subject"] == "politics"


def test_content_threshold_and_null(spark):
    rows = [("a", "b" * 48), ("a", "b" * 49), (None, "b" * 100), ("Café, naïve!", "ok")]
    df = spark.createDataFrame(rows, "title string, text string").withColumn("article_id", F.monotonically_increasing_id())
    prep = tfidf_nb.prepare(df, C.MIN_CONTENT_CHARS, keep=("title",)).collect()
    assert [len(r["content"]) for r in prep] == [51]     # 50 dropped, 51 kept, NULL dropped
    c = df.select(preprocessed_content().alias("c")).collect()
    assert c[2]["c"] is None
    assert c[3]["c"] == "caf nave ok"


def test_unicode_strip_and_html(spark):
    df = spark.createDataFrame([("   Title 　",), ("<p>5<6 and 7>3</p>",),
                                ("<script>var a='<p>';</script><p> x &amp; y </p><!-- c --><b>&lt;z&gt;</b>",),
                                (None,)], "s string")
    r = df.select(unicode_strip("s").alias("u"), clean_html("s").alias("h")).collect()
    assert r[0]["u"] == "Title"
    assert r[1]["h"] == "5<6 and 7>3"
    assert r[2]["h"] == "x & y <z>"
    assert r[3]["h"] == ""


def _feed(items, pos=0, url=None):
    body = "".join(items)
    return ("politics", pos, url or f"u{pos}", f"<rss><channel>{body}</channel></rss>",
            datetime.datetime(2024, 1, 1))


def _item(title, desc, pub="Mon, 04 Mar 2024 05:00:00 GMT"):
    p = f"<pubDate>{pub}</pubDate>" if pub else ""
    return f"<item><title>{title}</title><description>{desc}</description>{p}</item>"


FEED_SCHEMA = "subject string, feed_pos int, url string, xml string, fetched_at timestamp"


def test_feed_extraction_rules(spark):
    long = "L" * 40
    f0 = _feed([_item(f"t{i}", long) for i in range(11)], 0)             # eleventh entry dropped
    f1 = _feed([_item("dup", "short"), _item("dup", long), _item("   ", long),
                _item("n29", "x" * 29), _item("n30", "x" * 30), _item("nodate", long, None)], 1)
    f2 = _feed([_item("one", long)], 2)                                    # one-item feed
    f3 = ("world", 3, "u3", "<rss><channel></channel></rss>", datetime.datetime(2024, 1, 1))
    f4 = ("world", 4, "u4", "<rss><channel><item><title>broken", datetime.datetime(2024, 1, 1))
    f5 = _feed([_item("t0", long)], 5)                                     # later copy of t0
    docs = spark.createDataFrame([f0, f1, f2, f3, f4, f5], FEED_SCHEMA)
    out = {(r["feed_pos"], r["title"]): r for r in feeds.extract_feeds(docs).collect()}
    titles = sorted(t for _, t in out)
    assert titles == sorted([f"t{i}" for i in range(10)] + ["n30", "nodate", "one"])
    assert (0, "t0") in out and (5, "t0") not in out
    assert out[(0, "t1")]["date"] == "March 04, 2024"
    assert out[(1, "nodate")]["date"] == "January 01, 2024"                 # the time of the poll
    assert out[(1, "nodate")]["date_guessed"] and not out[(0, "t1")]["date_guessed"]
    errors = [r["feed_pos"] for r in feeds.feed_errors(docs).collect()]
    assert errors == [4]                                                    # broken XML; an empty channel is none


def test_first_by_title_of_relanded_and_unplaced_entries(spark):
    """A document landed twice gives one copy; NULL positions and urls lose nothing."""
    at = datetime.datetime
    rows = [("a", 1, "u", 0, at(2024, 1, 2)), ("a", 1, "u", 0, at(2024, 1, 1)), ("b", None, None, 0, at(2024, 1, 1)),
            ("b", 2, "u", 0, at(2024, 1, 1)), ("c", 1, None, 0, None)]
    e = spark.createDataFrame(rows, "title string, feed_pos int, url string, pos int, fetched_at timestamp")
    out = {r.title: r for r in feeds.first_by_title(e).collect()}
    assert len(out) == 3 and out["a"].fetched_at == at(2024, 1, 1) and out["b"].feed_pos is None


def test_feed_shapes_dates_and_references(spark):
    """F1: Atom published and content, RSS 1.0; T7: date variants; T2: numeric and named references."""
    from newsflow.functions.text import parse_published
    atom = ('<feed xmlns="http://www.w3.org/2005/Atom"><title>f</title><entry><title>A</title><content type="html">'
            'only content, long enough to stay in</content><published>2024-03-04T05:00:00Z</published>'
            '<updated>2024-05-01T00:00:00Z</updated></entry></feed>')
    rdf = ('<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns="http://purl.org/rss/1.0/" '
           'xmlns:dc="http://purl.org/dc/elements/1.1/"><channel><title>c</title></channel><item><title>R</title>'
           '<description>text of an RDF item, long enough</description><dc:date>2024-03-04T05:00:00Z</dc:date></item></rdf:RDF>')
    tricky = _feed([_item("T", "an entry of &lt;rss that Atom markers do not mislead")], 3)
    docs = spark.createDataFrame([("w", 1, "u1", atom, None), ("w", 2, "u2", rdf, None), tricky], FEED_SCHEMA)
    out = {r.title: r for r in feeds.extract_feeds(docs).collect()}
    assert {t: r.date for t, r in out.items()} == dict.fromkeys("ART", "March 04, 2024")
    assert feeds.feed_errors(docs).count() == 0
    dates = ["Mon, 04 Mar 2024 05:00:00 GMT", "Mon, 4 Mar 2024 05:00 GMT", "4 Mar 24 07:00:00 +0200",
             "Monday, 04 Mar 2024 00:00:00 EST", "04 Mar 2024 05:00:00 UT", "2024-03-04T07:00:00+02:00"]
    got = spark.createDataFrame([(d,) for d in dates + ["soon"]], "p string").select(
        F.date_format(parse_published("p"), "yyyy-MM-dd HH:mm")).collect()
    assert [r[0] for r in got] == ["2024-03-04 05:00"] * 6 + [None]
    html = spark.createDataFrame([("It&#8217;s &mdash; caf&eacute; &#x2019; &amp;lt; &bogus; & &#0; &#128512;",)], "s string")
    assert html.select(clean_html("s")).first()[0] == "It’s — café ’ &lt; &bogus; & &#0; 😀"


def test_partition_values_stay_strings(spark):
    rows = [("a", "t", "s", "id", datetime.datetime(2024, 1, 1), "123", "d1"),
            ("b", "t", "s", "id", datetime.datetime(2024, 1, 1), None, "d1"),
            ("c", "t", "s", "id", datetime.datetime(2024, 1, 1), "", "d1")]
    df = spark.createDataFrame(rows, "title string, text string, source string, article_id string, "
                                     "processed_at timestamp, subject string, date string")
    path = scratch_path(spark, "partitions")
    sinks.write_parquet(df, path, partition_by=("subject", "date"))
    back = {r["title"]: r["subject"] for r in read_ingested(spark, path).collect()}
    assert back == {"a": "123", "b": None, "c": None}


def test_tie_is_fake(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (None,)], "p double")
    assert [r[0] for r in df.select(decode_label("p")).collect()] == ["FAKE", "TRUE", "TRUE"]
    train = spark.createDataFrame([("a", "alpha beta gamma " * 5, 0.0), ("b", "delta epsilon " * 5, 1.0)],
                                  "article_id string, content string, label double")
    model = tfidf_nb.fit(train, min_doc_freq=1)
    doc = spark.createDataFrame([("x", "zzz")], "article_id string, content string")
    r = model.predict(doc).first()
    assert r["score0"] == r["score1"] and r["prediction"] == 0.0 and abs(r["prob_fake"] - 0.5) < 1e-12


def test_restart_and_replay(spark):
    from newsflow.checks import queries
    from newsflow.sources.tables import articles
    sf = "/root/testdata/sf0.001"
    once = queries.st1_ingest(spark, sf).count()
    twice = queries.st6_restart(spark, sf).first()["n"]
    assert once == twice                                   # a restart on the same checkpoint adds nothing
    replayed = queries.k6_replay_idempotent(spark, sf).count()
    assert replayed == articles(spark, sf, labelled=False).count()   # batch 0 written twice, kept once


def test_first_by_title_with_hot_title_matches_window(spark):
    """D1 against a brute-force window, with one title holding a third of the rows."""
    from pyspark.sql import Window
    rows = []
    for feed in range(30):
        for pos in range(12):
            title = "hot" if (feed * 12 + pos) % 3 == 0 else f"t{(feed * 7 + pos) % 50}"
            rows.append((feed, f"u{feed}", pos, title))
    e = spark.createDataFrame(rows, "feed_pos int, url string, pos int, title string")
    ours = feeds.first_by_title(e).select("feed_pos", "pos", "title")
    w = Window.partitionBy("title").orderBy("feed_pos", "url", "pos")
    brute = e.withColumn("rn", F.row_number().over(w)).filter("rn = 1").select("feed_pos", "pos", "title")
    assert sorted(ours.collect()) == sorted(brute.collect())
    assert ours.filter("title = 'hot'").count() == 1


def test_atom_feed_entries(spark):
    atom = ('<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>Atom one</title>'
            '<summary>&lt;p&gt;An Atom summary long enough to pass the filter&lt;/p&gt;</summary>'
            '<updated>2024-03-04T05:00:00Z</updated></entry></feed>')
    docs = spark.createDataFrame([("world", 9, "a9", atom, datetime.datetime(2024, 1, 1))], FEED_SCHEMA)
    out = feeds.extract_feeds(docs).collect()
    assert [(r["title"], r["text"], r["date"]) for r in out] == [
        ("Atom one", "An Atom summary long enough to pass the filter", "March 04, 2024")]
    assert out[0]["timestamp"][10] == "T" and len(out[0]["timestamp"]) == 26     # T8 ISO with microseconds


def test_hidden_elements_single_pass(spark):
    df = spark.createDataFrame([("<!-- <script>x</script> --><p>y</p>",),
                                ("<SCRIPT type='a'>s</SCRIPT><style>p{}</style><template><b>t</b></template>z",),
                                ("<script>never closed <p>kept as text</p>",)], "s string")
    assert [r[0] for r in df.select(clean_html("s")).collect()] == ["y", "z", "never closed kept as text"]


def test_strip_is_linear_on_long_inner_whitespace(spark):
    """An anchored regex strip backtracks quadratically here; trim with a set does not."""
    import time
    s = "  x" + " " * 200_000 + "y　"
    df = spark.createDataFrame([(s,)], "s string")
    t = time.time()
    out = df.select(unicode_strip("s").alias("u"), clean_html("s").alias("h")).first()
    assert time.time() - t < 60
    assert out["u"] == s.strip() and out["h"] == s.strip()


def _titles(spark, *xml):
    docs = spark.createDataFrame([("s", i, f"u{i}", x, None) for i, x in enumerate(xml)], FEED_SCHEMA)
    return {(r.feed_pos, r.pos): (r.title, r.summary, r.published) for r in feeds.feed_entries(docs).collect()}, {
        r.feed_pos: (r.error, r.recovered, r.rest) for r in feeds.feed_errors(docs).collect()}


def test_names_of_other_namespaces_are_other_names(spark):
    """media, itunes and atom elements before or after the entry's own; full text where there is no summary."""
    other = ("<media:title>photo</media:title><media:description>caption</media:description><itunes:title>ep</itunes:title>"
             "<atom:title>x</atom:title><media:group><media:title>y</media:title></media:group>")
    own = "<title>T</title><description>a real summary</description><pubDate>D</pubDate>"
    rss = ('<rss xmlns:media="m" xmlns:itunes="i" xmlns:atom="http://www.w3.org/2005/Atom" '
           'xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel><title>c</title><atom:title>no</atom:title>'
           f"<item>{other}{own}</item><item>{own}{other}</item>"
           "<item><title>F</title><content:encoded><![CDATA[<p>full & text</p>]]></content:encoded></item>"
           "<item><title>B</title><description> </description><content:encoded>full</content:encoded></item>"
           "<item><title>I</title><itunes:summary>spoken</itunes:summary></item>"
           "<item><title>N</title><media:description>caption</media:description></item></channel></rss>")
    got, errors = _titles(spark, rss)
    assert got[0, 0] == got[0, 1] == ("T", "a real summary", "D")
    assert got[0, 2][:2] == ("F", "<p>full & text</p>") and got[0, 3][:2] == ("B", "full")
    assert got[0, 4][:2] == ("I", "spoken") and got[0, 5][:2] == ("N", None) and errors == {}


def test_prefixes_are_those_that_the_document_declares(spark):
    atom = ('<a.b:feed xmlns:a.b="http://www.w3.org/2005/Atom" xmlns:media="m"><a.b:entry><media:title>no</media:title>'
            "<a.b:title>T</a.b:title><a.b:summary>S</a.b:summary><a.b:published>P</a.b:published></a.b:entry></a.b:feed>")
    rdf = ('<r:RDF xmlns:r="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:rss="http://purl.org/rss/1.0/" '
           "xmlns:d='http://purl.org/dc/elements/1.1/'><rss:channel><rss:title>c</rss:title></rss:channel>"
           "<rss:item><rss:title>T</rss:title><rss:description>S</rss:description><d:date>P</d:date></rss:item></r:RDF>")
    dc = ('<rss xmlns:when="http://purl.org/dc/elements/1.1/" xmlns:c="http://purl.org/rss/1.0/modules/content/"><channel>'
          "<item><title>T</title><c:encoded>S</c:encoded><when:date>P</when:date></item></channel></rss>")
    old = ('<feed xmlns="http://purl.org/atom/ns#"><entry><title>T</title><content>S</content><issued>P</issued></entry></feed>')
    got, errors = _titles(spark, atom, rdf, dc, old)
    assert got == {(i, 0): ("T", "S", "P") for i in range(4)} and errors == {}


def test_text_constructs_of_atom(spark):
    """Atom: escaped, XHTML and CDATA content all give the same visible text."""
    from newsflow.functions.html import clean_html
    bodies = ['<content type="html">&lt;p&gt;one &lt;b&gt;two&lt;/b&gt;&lt;/p&gt;</content>',
              '<content type="xhtml"><div xmlns="http://www.w3.org/1999/xhtml"><p>one <b>two</b></p></div></content>',
              "<content><![CDATA[<p>one <b>two</b></p>]]></content>"]
    xml = "<feed>" + "".join(f"<entry><title>t</title>{b}</entry>" for b in bodies) + "</feed>"
    docs = spark.createDataFrame([("s", 0, "u", xml, None)], FEED_SCHEMA)
    got = feeds.feed_entries(docs).select(clean_html("summary").alias("t")).distinct().collect()
    assert [r.t for r in got] == ["one two"]


def test_broken_documents_keep_their_complete_entries(spark):
    """entries before, between and after what is broken; the rest is kept for the dead letter."""
    def item(t):
        return f"<item><title>{t}</title></item>"

    cut = f"<rss><channel>{item('a')}{item('b')}<item><title>c"
    inner = f"<rss><channel>{item('a')}<item><title>b<x></title></item>{item('c')}</channel></rss>"
    entity = f"<rss><channel>{item('a&nbsp;b')}{item('AT&T &amp; x')}</channel></rss>"
    open_ = f"<rss><channel><item><title>lost{item('b')}</channel></rss>"
    cdata = "<rss><channel><item><title><![CDATA[</item> & <i>]]></title></item><item><title>x"
    comment = f"<rss><channel><!-- {item('no')} -->{item('a')}<oops></channel></rss>"
    never = "<rss><channel><item><title>x</title><description><![CDATA[ " + "y" * 100_000
    control = f"<rss><channel>{item('a' + chr(1))}</channel></rss>"
    upper = "<feed><entry a='1'><title>e</title></entry ><entry>"
    got, errors = _titles(spark, cut, inner, entity, open_, cdata, comment, never, control, upper)
    by_doc = {}
    for (doc, _), (title, _, _) in sorted(got.items()):
        by_doc.setdefault(doc, []).append(title)
    assert by_doc == {0: ["a", "b"], 1: ["a", "c"], 2: ["a&nbsp;b", "AT&T & x"], 3: ["b"], 4: ["</item> & <i>"], 5: ["a"],
                      7: ["a"], 8: ["e"]}
    assert {d: (e[0], e[1]) for d, e in errors.items()} == {d: ("broken", len(by_doc.get(d, []))) for d in range(9)}
    assert errors[0][2] == "<rss><channel><item><title>c" and "<item><title>b<x></title></item>" in errors[1][2]
    assert "lost" in errors[3][2] and errors[6][2] == never


def test_long_broken_documents_take_linear_time(spark):
    import time
    many = "<rss><channel>" + "<item><title>x" * 60_000
    half = "<rss><channel>" + "<item><title>x</title></item>" * 20_000 + "<![CDATA[" * 20_000
    start = time.monotonic()
    got, errors = _titles(spark, many, half)
    assert len(got) == 20_000 and len(errors) == 2 and time.monotonic() - start < 60


def test_all_named_references(spark):
    """Every name of HTML, with its semicolon and, for old ones, without; the longest name that fits."""
    import html
    from html.entities import html5
    from newsflow.functions.html import decode_references
    texts = [f"a&{n} b" for n in html5] + [f"x&{n}y" for n in html5 if not n.endswith(";")]
    texts += ["&amp&nbsp;&rarr;&CounterClockwiseContourIntegral;", "&notit; &notin; &notin", "&amplt; &amp;lt;", "AT&T & R&D",
              "&#150;&#x97; &#65 &#x42;", "&unknown; &;&&amp;", "&NotEqualTilde;", "&#129;", ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.d for r in df.select("i", decode_references(F.col("t")).alias("d")).collect()}
    assert [t for i, t in enumerate(texts) if got[i] != html.unescape(t)] == []
