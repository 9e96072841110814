"""Links, private-use characters, elements that are not closed."""

from docloom.operators import legal_sections as G
from docloom.operators import pages as P

LINK = '<a href="/legal-content/EN/TXT/?uri=OJ:L_2024{}"></a>'


def test_fallback_title_is_all_of_the_block(spark):
    html = ('<div id="MainContent"><ul><li>Lead words <a href="/x">one</a> mid ' + LINK.format("01016") + ' more <a href="/y">two</a> tail</li>'
            '<li>' + LINK.format("01017") + LINK.format("01018") + ' both <b>of</b> them</li><li>none</li></ul>'
            '<p><a href="/z">first</a> of four ' + LINK.format("01019") + "</p></div>")
    df = spark.createDataFrame([(1, html)], "id long, html string")
    got = [(r.link_no, r.document_id, r.title) for r in P.links(df, "html", "id", "https://e.org").orderBy("link_no").collect()]
    assert got == [(2, "202401016", "Lead words one mid  more two tail"), (4, "202401017", "both of them"),
                   (5, "202401018", "both of them"), (7, "202401019", "first of four")]


def test_private_use_characters_stay(spark):
    marks = "\ue000\ue0001 \ue001 \ue0021 \ue003 \ue0010"
    body = f"<p>\ue002a {marks} z</p><p>b\ue003c &#xE001; <b>d</b></p>"
    lines = [f"\ue002a {marks} z", "b\ue003c \ue001d"]
    html = f'<div id="TexteOnly">{body}<p class="navigation">menu</p></div>'
    df = spark.createDataFrame([(1, html)], "id long, html string")
    assert P.page_text(df, "html").first().full_text == "\n".join(lines)
    df = spark.createDataFrame([(1, f"<article><h1>Ti\ue003tle</h1>{body}</article>")], "id long, html string")
    got = [(r.title, r.content) for r in P.heading_sections(df, "html", "id", "article").collect()]
    assert got == [("Ti\ue003tle", "\n".join(lines))]


def sections_of(spark, body, **options):
    df = spark.createDataFrame([(1, f'<body><div class="eli-container">{body}</div></body>')], "id long, html string")
    return [(r.title, r.content) for r in G.sections(df, "id", "html", **options).orderBy("section_order").collect()]


def test_sections_of_elements_that_are_not_closed(spark):
    head = '<div class="eli-subdivision"><p class="oj-ti-art">Article {}'
    want = [("Main Content", "One body\nTwo words"), ("Article 1", "One body\nfirst item\nsecond\ncell\nnext cell"), ("Article 2", "Two words\nterm\nmeaning")]
    loose = (head.format(1) + '<p class="oj-normal">One body<ul><li>first item<li>second</ul><div><table><tr><td>cell<td>next cell</table></div></div>'
             + head.format(2) + '<p class="oj-normal">Two words<dl><dt>term<dd>meaning</dl></div></section></i>')
    closed = (head.format(1) + '</p><p class="oj-normal">One body</p><ul><li>first item</li><li>second</li></ul><div><table><tr><td>cell</td><td>next cell</td></tr></table></div></div>'
              + head.format(2) + '</p><p class="oj-normal">Two words</p><dl><dt>term</dt><dd>meaning</dd></dl></div>')
    assert sections_of(spark, closed) == want
    assert sections_of(spark, loose) == want
    crossed = head.format(1) + '</p><p>some <b>bold <i>slanted</b> words</i> end</p><p>tail</p></div>'
    assert sections_of(spark, crossed) == [("Article 1", "some\nbold\nslanted\nwords\nend\ntail")]


def test_implied_ends_can_be_left_out(spark):
    body = '<div class="eli-subdivision"><p class="oj-normal">one<p class="oj-normal">two</div>'
    assert sections_of(spark, body) == [("Main Content", "one\ntwo")]
    assert sections_of(spark, body, implied=False) == [("Main Content", "onetwo")]  # the second is inside the first


def test_pages_without_text(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "<p>"), (4, "</p></div>"), (5, "< a <")], "id long, html string")
    assert G.sections(df, "id", "html").count() == 0


def test_elements_without_and_with_nested_ones(spark):
    from pyspark.sql import functions as F

    pages = ['a<div id="x">one</div>b</div>', 'a<DIV id="x">one<div>two</div>three</DIV >b', '<div id="x">open', '<div id="x"><div>open', '<div id="x"><divan>y</divan></div>z']
    df = spark.createDataFrame([(h,) for h in pages], "h string").repartition(1)
    got = [r.e for r in df.select("h", P.element(F.col("h"), '(?i)<div\\b[^>]*id="x"[^>]*>', "div").alias("e")).collect()]
    assert got == ['<div id="x">one</div>', '<DIV id="x">one<div>two</div>three</DIV >', '<div id="x">', '<div id="x"><div>', '<div id="x"><divan>y</divan></div>']


def test_references_are_decoded_without_casts_that_fail(spark, capsys):
    from docloom.functions import text as T

    df = spark.createDataFrame([("&amp; &#38; &#x26; &#; &#x; &nope; &#0; &#9999999; &",)], "h string")
    df = df.select(T.decode_entities(df["h"]).alias("d"))
    assert df.first().d == "& & & &#; &#x; &nope; &#0; &#9999999; &"
    df.explain()
    assert "try_cast" not in capsys.readouterr().out


METADATA = ('<html><!-- <p id="title">no</p> --><script>"<dt>Form</dt><dd>no</dd>"</script><body><p class="x DocumentTitle">Document&nbsp;32020R1</p>{}'
            '<DIV><p\nid = "title">Order &amp; <b>text</b></p><p id="originalTitle">hidden</p><div><p>A/2020/1 </p></div></DIV><a href="http://data.europa.eu/eli/1&amp;x">ELI</a>'
            '<dl class="a NMetadata"><dt>Date of document, date of effect: </dt><dd>1;2</dd><dl><dt>Date of effect</dt><DD>3</DD ></dl><dt>Date of document</dt><dd>4</dd></dl>'
            '<dl><dt><i>Au</i>thor</dt><dt>Form</dt><dd>A, B,</dd><dd>F</dd><dt>Directory code</dt><dd><li> 11 x<span>a</span><span> b</span></li><li></li></dd>'
            '<dt>EUROVOC descriptor</dt><dd><li>u <b> v</b></li></dd><dt>Subject matter</dt></dl><dt>Responsible body</dt><dd>left open')


def test_metadata_of_odd_pages(spark):
    # An emoji before the date list, which the list was once not found behind.
    pages = [METADATA.format(""), METADATA.format("<p>\U0001f600</p>"), METADATA.format("").replace('id = "title"', "id = title"), None]
    got = P.page_metadata(spark.createDataFrame([*enumerate(pages)], "id long, html string"), "html").orderBy("id").collect()
    dates = {"Date of document": "4", "Date of effect": "3", "Date of end of validity": ""}
    lists = {"authors": ["A", "B", ""], "responsible_body": "", "form": "A, B,", "eurovoc_descriptors": ["uv"], "subject_matters": [],
             "directory_codes": ["11", None], "directory_descriptions": ["a / b", ""]}
    whole = {"celex_number": "32020R1", "title": "Order & text", "identifier": "A/2020/1", "eli_uri": "http://data.europa.eu/eli/1&x", "dates": dates, **lists, "status": "ok"}
    none = dict.fromkeys(["celex_number", "title", "identifier", "eli_uri"]) | {"dates": dict.fromkeys(dates, "")}
    none |= {**dict.fromkeys(lists, []), "responsible_body": "", "form": ""}
    rows = [{n: v for n, v in r.asDict().items() if n not in ("id", "html")} for r in got]
    assert rows == [whole, whole, {**whole, "title": None, "identifier": None, "status": "incomplete"}, {**none, "status": "incomplete"}]


def test_metadata_reads_a_page_in_one_step(spark, capsys):
    P.page_metadata(spark.createDataFrame([(1, "")], "id long, html string"), "html").drop("html").explain()
    plan = capsys.readouterr().out
    assert plan.count("ArrowEvalPython") == 1
    assert "regexp" not in plan and "Generate" not in plan
