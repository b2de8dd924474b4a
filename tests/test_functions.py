import datetime as dt
import json
import random
import warnings
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from tessera.functions.dates import normalize_date_string, parse_mixed_date, with_mixed_date
from tessera.functions.html import VOID, tag_attrs, tag_texts
from tessera.functions.jsonx import canonical_json, claim_status, field_text, field_token, literal_token
from tessera.functions.text import normalize_text, title_case


def one_col(spark, values, fn, ddl="s string"):
    df = spark.createDataFrame([(v,) for v in values], ddl)
    return [r[0] for r in df.select(fn(F.col(df.columns[0]))).collect()]


def test_normalize_dates(spark):
    cases = {
        "01-Jan-2024": "2024-01-01", "2024/01/01": "2024-01-01", "Jan 1 2024": "2024-01-01",
        "January 15 2024": "2024-01-15", "01/15/2024": "2024-01-15", "2024-03-20": "2024-03-20",
        "01/02/2024": "2024-01-02", "15/01/2024": "2024-01-15", "Jan  1 2024": "2024-01-01",
        "2024-02-30": "FAILED: 2024-02-30", "junk": "FAILED: junk", "  2024-03-20 ": "2024-03-20",
    }
    got = one_col(spark, list(cases) + [None], normalize_date_string)
    assert got == list(cases.values()) + [None]


#: Seventeen spellings of one day, texts that name no day, and readings of short numbers.
SPELLED = ["2024-01-15T10:00:00", "2024-01-15 10:00", "15-Jan-24", "Jan 15th 2024", "1/15/24", "01-15-2024", "Mon Jan 15 2024",
           "\u00a015\u00a0January\u2003 2024", "15th of January 2024", "Monday, January 15, 2024 at 3:04 PM", "2024/1/15 3pm",
           "20240115T100059", "15Jan2024", "Jan. 15, '24", "10:00 2024-01-15", "2024-01-15T10:00:00.123+05:30", "15/01/2024"]
UNREADABLE = ["2024-02-30", "29 Feb 2023", "2024-15-01", "Jan 2024", "15 Jan", "10:30", "Sunday", "2024-01-15 25:00",
              "2024-01-15 12:61", "2024-01-15 13:00 pm", "Jan Feb 2024", "1 2 3 4", "2024015", "", "the day after", "(Jan 15 2024)",
              "Jan 15 2024 or so", "2024-W03-1", "13/13/2024"]


def test_dates_of_any_spelling(spark):
    assert one_col(spark, SPELLED, normalize_date_string) == ["2024-01-15"] * len(SPELLED)
    assert one_col(spark, UNREADABLE, normalize_date_string) == [f"FAILED: {s}" for s in UNREADABLE]
    short = {"1/2/3": "2003-01-02", "13/2/3": "2003-02-13", "32/2/3": "2032-02-03", "Jan 2 3": "2003-01-02", "2 Jan 3": "2003-01-02",
             "2 3 Jan": "2002-01-03", "Jan 42 3": "2042-01-03", "42 Jan 3": "2042-01-03", "3 42 Jan": "2042-01-03",
             "1/1/69": "2069-01-01", "1/1/70": "1970-01-01"}
    assert one_col(spark, list(short), normalize_date_string) == list(short.values())
    assert one_col(spark, ["1/1/69", "1/1/70"], lambda c: parse_mixed_date(c, 1950)) == [dt.date(1969, 1, 1), dt.date(1970, 1, 1)]


def test_dates_like_a_free_form_parser(spark):
    """Against dateutil's parser, which fills missing parts from a default: texts that two defaults tell apart are partial."""
    parser = pytest.importorskip("dateutil.parser")
    rng, texts = random.Random(1), [*SPELLED, *UNREADABLE]
    months = ["Jan", "February", "mar", "APR", "May", "june", "Jul", "Aug", "Sept", "October", "nov", "December"]
    for _ in range(1500):
        t = [str(rng.choice([rng.randint(1, 12), rng.randint(1, 31), rng.randint(1, 99), rng.randint(1980, 2050)])) for _ in range(3)]
        t = [x.zfill(2) if rng.random() < .5 else x for x in t]
        if rng.random() < .5:
            t[rng.randrange(3)] = rng.choice(months)
        s = rng.choice([" ", "-", "/", ".", ", ", " - ", "  "]).join(t)
        s += rng.choice(["", "", "", " 10:00", "T10:00:00", " 3pm", " 11:59 PM", " 23:59:60", " 7:05:09.5 am", " 10:00 UTC"])
        texts.append(rng.choice(["", "", "", "Mon ", "Tuesday, "]) + s)

    def expected(s):
        try:
            with warnings.catch_warnings():
                warnings.simplefilter("ignore")
                a, b = (parser.parse(s.strip(), default=d).date() for d in (dt.datetime(2001, 1, 1), dt.datetime(2002, 2, 2)))
        except (ValueError, OverflowError):
            return None
        return a if a == b else None

    window = dt.date.today().year - 50  # that parser's own rule for two-digit years
    df = spark.createDataFrame([(i, s) for i, s in enumerate(texts)], "i int, s string").repartition(4)
    got = {r.i: r.d for r in with_mixed_date(df, "s", "d", window).collect()}
    assert sum(d is not None for d in got.values()) > 500
    assert {texts[i]: d for i, d in got.items()} == {s: expected(s) for s in texts}
    again = {r[0]: r[1] for r in df.select("i", parse_mixed_date(F.col("s"), window)).collect()}
    assert again == got


def test_parse_mixed_date(spark):
    got = one_col(spark, ["Jan 02 2024", "2024/01/01"], parse_mixed_date)
    assert got == [dt.date(2024, 1, 2), dt.date(2024, 1, 1)]


def test_normalize_text(spark):
    got = one_col(spark, ["Hello   world\r\n\r\n\r\nThis\t\tis OCR", "   ", None], normalize_text)
    assert got == ["Hello world\n\nThis is OCR", "No text detected.", "No text detected."]


def test_title_case(spark):
    got = one_col(spark, ["o'neil-x", "mumbai", "UNITED STATES", "1st place"], title_case)
    assert got == ["O'Neil-X", "Mumbai", "United States", "1St Place"]


def test_html_tags(spark):
    html = ('<html><!-- <h5>hidden</h5> --><script>var s="<h5>no</h5>";</script>'
            '<h5 class="t">First &amp; <b>best</b></h5><h5>Second</h5><h5>Third &lt;3</h5>'
            '<img src="a.png"><img alt="x"><img class="y" src=\'b.jpg\'></html>')
    df = spark.createDataFrame([(html,)], "html string")
    r = df.select(tag_texts(F.col("html"), "h5").alias("t"), tag_attrs(F.col("html"), "img", "src").alias("a")).first()
    assert r["t"] == ["First & best", "Second", "Third <3"]
    assert r["a"] == ["a.png", "b.jpg"]


def test_field_tokens_distinguish_types(spark):
    vals = ['{"f": 1}', '{"f": 1.0}', '{"f": "1"}', '{"f": true}', '{"f": null}', '{"g": 1}',
            '{"f": {"a": 1, "b": 2}}', '{"f": {"b": 2, "a": 1}}']
    toks = one_col(spark, vals, lambda c: field_token(c, "f"))
    assert toks[5] is None                      # absent
    assert len(set(toks[:5])) == 5              # 1, 1.0, "1", true, null all differ
    assert toks[6] == toks[7]                   # object key order does not matter
    lit = spark.range(1).select(literal_token("1")).first()[0]
    assert lit == toks[0]


def test_claim_status(spark):
    rows = [('{"aud":"otp","exp":100}', 101), ('{"aud":"otp"}', 1), ('{"aud":"otp","exp":100}', 100),
            ('{"aud":"web","exp":500}', 100)]
    df = spark.createDataFrame(rows, "c string, now long")
    got = [r[0] for r in df.select(claim_status(F.col("c"), F.col("now").cast("double"), "otp")).collect()]
    assert got == ["expired", "expired", "active", "invalid"]


def test_window_index_and_seconds_left(spark):
    from tessera.functions.dates import seconds_to_window_end, tumbling_index
    df = spark.createDataFrame([(0.0,), (299.5,), (300.0,), (601.2,)], "t double")
    got = [tuple(r) for r in df.select(tumbling_index(F.col("t"), 300), seconds_to_window_end(F.col("t"), 300)).collect()]
    assert got == [(0, 300), (0, 1), (1, 300), (2, 299)]


def test_filename_helpers_and_split_join(spark):
    from tessera.functions.text import file_suffix, safe_filename, split_join
    df = spark.createDataFrame([("/up/loads/My Photo (1).PNG",), ("C:\\tmp\\scan.jpeg",), ("noext",)], "p string")
    got = [tuple(r) for r in df.select(safe_filename(F.col("p")), file_suffix(F.col("p"))).collect()]
    assert got == [("My_Photo__1_.PNG", ".png"), ("scan.jpeg", ".jpeg"), ("noext", "")]
    assert spark.createDataFrame([("a b c",)], "s string").select(split_join(F.col("s"))).first()[0] == "a-b-c"


def test_many_blank_lines_and_unicode_blanks(spark):
    from tessera.functions.text import normalize_text, strip_all
    rows = [("a" + "\n \t" * 1_000_000 + "b",), ("\u00a0x\u2003\n\u00a0\n\u3000\n\u00a0y\x1c",), (" \u2003\n ",), ("p\r\nq\rr",)]
    df = spark.createDataFrame(rows, "s string")
    assert [r[0] for r in df.select(normalize_text(F.col("s"))).collect()] == ["a\n\nb", "x\n\ny", "No text detected.", "p\nq\nr"]
    assert [r[0] for r in df.select(strip_all(F.col("s"))).collect()] == [t.strip() for t, in rows]


def test_split_join_takes_the_separator_literally(spark):
    from tessera.functions.text import split_join
    assert spark.createDataFrame([("a.b.c",)], "s string").select(split_join(F.col("s"), ".")).first()[0] == "a-b-c"


def test_attributes_and_noise_in_document_order(spark):
    html = """<script>var x = "<!--";</script><h1>kept</h1><!-- <script> --><a href="it's.html">1</a><a class=x href=bare.html>2</a>
    <a-b href="no.html"></a-b><a href='say "x"'>3</a><h1 class=y>also</h1><h12>no</h12>"""
    df = spark.createDataFrame([(html,)], "h string")
    texts, links = df.select(tag_texts(F.col("h"), "h1"), tag_attrs(F.col("h"), "a", "href")).first()
    assert texts == ["kept", "also"]
    assert links == ["it's.html", "bare.html", 'say "x"']


def test_field_with_a_dot(spark):
    df = spark.createDataFrame([('{"a.b": 1, "a": {"b": 2}}',)], "s string")
    assert df.select(field_token(F.col("s"), "a.b") == literal_token("1")).first()[0]


class Tree(HTMLParser):
    """Texts and attributes by a stack of open elements; an end tag closes what is open above its element."""

    def __init__(self, tag, attr):
        super().__init__(convert_charrefs=True)
        self.tag, self.attr, self.stack, self.found, self.values = tag, attr, [], [], []

    def handle_starttag(self, tag, attrs):
        if tag == self.tag:
            self.found.append([])
            if self.attr in dict(attrs):
                self.values.append(dict(attrs)[self.attr] or "")
        if tag not in VOID:
            self.stack.append((tag, self.found[-1] if tag == self.tag else None))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.stack.pop()

    def handle_endtag(self, tag):
        if tag in [t for t, _ in self.stack]:
            while self.stack.pop()[0] != tag:
                pass

    def handle_data(self, data):
        for _, texts in self.stack:
            if texts is not None:
                texts.append(data)


def test_html_like_a_tree(spark):
    rng, pages = random.Random(8), [
        "<div>x<div>y</div>z</div>", "<div title='a>b'>caf&eacute;&#8217;&#x2014; &amp;lt; &nope; &#150;&#0;&#xD800;</div><div>open <b>e",
        "no tags < here", "<p><div>a<div/>b</p>c</div><DIV>q</DIV >", '<a title="1>2" href="k">', "<a href='1' HREF='2&quot;'>",
        "<a href><a hreflang=x><a data-href='no' href = bare/x>", "<a href=it's><a\nhref='say \"x\"'/>", ""]
    parts = ["<div>", "<div class='x>y'>", "</div>", "<p>", "</p>", "<br>", "<b>", "</b>", "<a href=one>", "<a href='t&amp;o'>", "</a>",
             "<a id=x href>", "text ", "&lt;", "&eacute;", "&#65;", " more", "<div/>", "<img href=no>"]
    pages += ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)] + [(-1, None)], "i int, h string").repartition(4)
    rows = df.select("i", tag_texts(F.col("h"), "div"), tag_attrs(F.col("h"), "a", "href")).collect()
    for i, texts, values in rows:
        if i < 0:
            assert texts is None and values is None
            continue
        tree = Tree("div", None)
        tree.feed(pages[i])
        tree.close()
        links = Tree("a", "href")
        links.feed(pages[i])
        links.close()
        assert texts == ["".join(t) for t in tree.found], pages[i]
        assert values == links.values, pages[i]


def test_json_comes_back_as_it_is(spark):
    kept = ['{"b":1.0,"a":2}', '{"a":1,"a":2}', '{"a":{"b":1,"b":2.50}}', "[1e5,-0,0.10,123456789012345678901234567890]",
            '"say \\"x : y\\" \\\\"', '["a",":",", "]', "null", "true", '{"":[]}', '"\\u00e9\\n"', "[[[[[[]]]]]]"]
    assert one_col(spark, kept, canonical_json) == kept
    spaced = {' { "b" : 1.0 ,\n"a": [ 1 , "x  y" ] } ': '{"b":1.0,"a":[1,"x  y"]}', '["a \\" ]", 1 ]\t': '["a \\" ]",1]'}
    assert one_col(spark, list(spaced), canonical_json) == list(spaced.values())
    text = ['{"a":1} x', "1 2", "[1,]", "01", "{} {}", "[1]]", '"a" : 1', "{'a':1}", "1,2", '1,"k":2', "1}", "1] [2", "", "plain",
            '{"a":1,"a":}', '"\x01"', '"tab\t"', '{"a":1 "a":2}']
    assert one_col(spark, text, canonical_json) == [json.dumps(t) for t in text]
    assert one_col(spark, [None], canonical_json) == [None]
    # thousands of escapes do not deepen the matcher
    long = '"' + '\\"' * 50_000 + '"'
    assert one_col(spark, [long], canonical_json) == [long]


def test_fields_at_the_top_as_written(spark):
    cases = {'{"f": 1.0}': "1.0", '{"f":1,"g":{"f":2}}': "1", '{"g":{"f":2}}': None, '{"f":1,"f":[2, {"f":3}]}': '[2,{"f":3}]',
             '[{"f":1}]': None, '{"x":"f","f":"a\\"b, c"}': '"a\\"b, c"', '{"\\u0066":true}': "true", '{"f":1} x': None, "f": None,
             '{"g":["f",":"],"f":null}': "null", "{}": None}
    assert one_col(spark, list(cases) + [None], lambda c: field_text(c, "f")) == [*cases.values(), None]
    equal = [('{"f":"\\u0041"}', '{"f":"A"}'), ('{"f":1e2}', '{"f":100.0}'), ('{"f":{"a":1,"b":2}}', '{"f":{"b":2,"a":1}}'),
             ('{"f":-0}', '{"f":0}'), ('{"f":2,"f":1}', '{"f":1}')]
    a, b = (one_col(spark, list(x), lambda c: field_token(c, "f")) for x in zip(*equal))
    assert a == b and None not in a
