"""Expressions on single values, among them the cases real payloads trip over."""

import html as html_lib
import random
import re

from pyspark.sql import functions as F

from inkloom.functions import html as H
from inkloom.functions import payload as P
from inkloom.functions import text as T
from inkloom.functions import urls as U

BASE = "https://novels.example"


def run(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    rows = df.select("i", fn(F.col("v")).alias("o")).collect()
    return [r.o for r in sorted(rows, key=lambda r: r.i)]


def check(spark, fn, cases):
    assert run(spark, fn, [c[0] for c in cases]) == [c[1] for c in cases]


def test_numbers(spark):
    check(
        spark,
        T.parse_number,
        [("12", 12.0), ("1d", None), ("0x10", 16.0), ("Infinity", None), ("NaN", None), ("1e3", 1000.0), (" 5 ", 5.0),
         (" 7﻿", 7.0), ("1e999", None), ("0b11", 3.0), ("0o17", 15.0), ("", None), ("1.", 1.0), (".5", 0.5), ("-3", -3.0), ("1 2", None)],
    )


def test_chapter_numbers(spark):
    check(
        spark,
        T.parse_chapter_number,
        [("глава 12,5", 12.5), ("ГЛАВА7", 7.0), ("Chapter 3.25 x", 3.25), ("part 3", None), ("Глава", None), (None, None)],
    )


def test_body_must_be_one_json_value(spark):
    bodies = ["1 2", "{} x", "1],[2", "1,2", '{"a":1,"a":2}', "", "  ", "[1]", "null", "x", '﻿{"b":1}', "NaN", None]
    df = P.with_document(spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, body string"))
    rows = df.select("i", F.to_json(P.within(F.col("doc"))).alias("d"), F.col("doc").isNotNull().alias("ok")).orderBy("i").collect()
    good = {bodies[r.i]: r.d for r in rows if r.ok}
    assert good == {'{"a":1,"a":2}': '{"a":2}', "[1]": "[1]", "null": "null", '﻿{"b":1}': '{"b":1}'}


def test_field_types(spark):
    body = (
        '{"n":5,"s":"5","d":1.50,"e":1e3,"t":true,"z":null,"blank":" ","hex":"0x10","inf":"Infinity",'
        '"big":-7.9,"yes":"yes","one":1,"two":2,"str1":"1","obj":{},"arr":[]}'
    )
    df = P.with_document(spark.createDataFrame([(body,)], "body string")).withColumn("doc", P.within(F.col("doc")))
    df, f = P.read_fields(
        df, F.col("doc"), "_",
        ids={"id_n": "n", "id_s": "z blank s", "id_e": "e", "id_t": "t"},
        texts={"t_n": "n", "t_blank": "blank s"},
        numbers={"n_hex": "hex", "n_true": "t", "n_inf": "inf", "n_bad": "blank n", "n_null": "z n", "n_d": "d"},
        integers={"i_big": "big"},
        flags={"f_yes": "yes", "f_one": "one", "f_two": "two", "f_str": "str1", "f_null": "z", "f_none": "none"},
        maybe_flags={"m_null": "z", "m_none": "none", "m_true": "t"},
    )
    row = df.select(*[c.alias(n) for n, c in f.items()]).first()
    ids = {n: tuple(row[n]) if row[n] else None for n in ("id_n", "id_s", "id_e", "id_t")}
    assert ids == {"id_n": ("5", True), "id_s": ("5", False), "id_e": ("1000", True), "id_t": None}
    assert (row.t_n, row.t_blank) == (None, "5")
    assert (row.n_hex, row.n_true, row.n_inf, row.n_bad, row.n_null, row.n_d) == (16.0, None, None, None, 5.0, 1.5)
    assert row.i_big == -7
    assert (row.f_yes, row.f_one, row.f_two, row.f_str, row.f_null, row.f_none) == (False, True, False, True, False, False)
    assert (row.m_null, row.m_none, row.m_true) == (False, None, True)


def test_absolute_urls(spark):
    check(
        spark,
        lambda c: U.absolute_url(c, BASE),
        [
            ("/a", f"{BASE}/a"), ("b?c", f"{BASE}/b?c"), ("//h.com/x", "https://h.com/x"),
            ("https://H.com:443/a/../b", "https://h.com/b"), ("http://x", "http://x/"), ("HTTPS:foo", f"{BASE}/foo"),
            ("data:x", None), ("javascript:1", None), ("java\tscript:1", None), ("mailto:a", None), ("", None), (" ", None), (None, None),
            ("/für ü", f"{BASE}/f%C3%BCr%20%C3%BC"), ("?q=1", f"{BASE}/?q=1"), ("#f", f"{BASE}/#f"),
            ("https://пример.рф/я", "https://xn--e1afmkfd.xn--p1ai/%D1%8F"), ("http://h:99999/", None), ("//", None),
            ("/a/./b/..", f"{BASE}/a/"), ("/../../x", f"{BASE}/x"), ("\\a\\b", f"{BASE}/a/b"), ("https://a b/", None),
            ("https://u:p@h.com/", "https://u:p@h.com/"), ("https://h.com/a b?q=\"x'y", "https://h.com/a%20b?q=%22x%27y"),
            (" /x\n", f"{BASE}/x"), ("/a//b", f"{BASE}/a//b"), ("/a#x y", f"{BASE}/a#x%20y"), ("/%zz", f"{BASE}/%zz"),
        ],
    )


def test_path_segments(spark):
    check(
        spark,
        U.path_segments,
        [("/a/%D1%8F+b/", ["a", "я+b"]), ("https://h/x?y#z", ["x"]), ("/%zz", None), ("/%ff", None), ("/", []), (None, None)],
    )


def test_clean_html_cases(spark):
    check(
        spark,
        lambda c: H.clean_html(c, BASE),
        [
            ("<p>Hello&nbsp;world</p><img data-src=\"javascript:bad\"><iframe>x</iframe>", "<p>Hello&nbsp;world</p>"),
            ('<p style="text-align:center;color:red" onclick="bad()">x</p>', '<p style="text-align:center">x</p>'),
            ("<td align=CENTER style=\"font-weight:bold\">", '<td style="font-weight:bold;text-align:center">'),
            ('<a href="mailto:x@y" title="q&quot;">m</a>', '<a href="mailto:x@y" title="q&quot;">m</a>'),
            ('<A HREF=/x href="/y">m</a>', f'<a href="{BASE}/y" rel="noopener noreferrer nofollow">m</a>'),
            ("a < b", "a  b"), ("1 <", "1"), ("<b>x</b><i>y</i><del>z</del>", "<strong>x</strong><em>y</em><s>z</s>"),
            ('<img src="/a.png" alt="a>b">', f'<img src="{BASE}/a.png" alt="" loading="lazy" decoding="async">b"&gt;'.replace("&gt;", ">")),
            ("<SCRIPT>x</script ><!-- c --><!DOCTYPE html><br/></br><p/>", "<br><p>"), ("<pé>q", "<p>q"), ("", ""), (None, None),
            ('<ol start="-3"><ol start="x"><th colspan="12" rowspan="1234">', '<ol start="-3"><ol><th colspan="12">'),
            ('<p style="text-align: left ; background:url(x)" >', '<p style="text-align:left">'),
            ('<p style=\'font-weight:"bold"\'>', "<p>"),
        ],
    )


def test_text_cases(spark):
    check(
        spark,
        H.html_text,
        [
            ("<p>Hello&nbsp;world</p>", "Hello world"),
            ("&lt;b&gt; &amp;lt; &#160;x&#x1F600;&#99999999; &unk; &AMP; &am&#112;;", "<b> &lt;  x\U0001f600&#99999999; &unk; & &amp;"),
            ("<p>a</p>  \n\n <br><br>b\t\tc", "a\n\nb c"), ("<td>a</td><td>b</td>", "ab"), ("<br <p>q>", ""), ("a\r\nb", "a\nb"),
            ("&#55296;|&#0;|&#x110000;", "�|\u0000|&#x110000;"), ("   x﻿ ", "x"), (None, None),
        ],
    )


def test_images(spark):
    raw = "<script><img src='/in.png'></script><img src='/a.jpg'><IMG data-lazy-src=/b%20c.jpg?x alt=''><img src=' ' data-url='/a.jpg'><imgx src=/c><img>"
    [images] = run(spark, lambda c: H.html_images(c, BASE), [raw])
    assert [(i.url, i.name, i.alt) for i in images] == [
        (f"{BASE}/in.png", "in.png", None), (f"{BASE}/a.jpg", "a.jpg", None), (f"{BASE}/b%20c.jpg?x", "b c.jpg", ""),
    ]


PIECES = [
    "<p>", "</p>", "<br>", "<div class=x>", "<script>", "</script>", "<img src=/a.png onerror=x>", "<img src='javascript:1'>", "<", ">", " ", "\n",
    "\t", "text", "&amp;", "&lt;p&gt;", "&nbsp;", "&#65;", "&#x26;lt;", "&x;", "&", ";", '"', "'", "<a href='/q' onclick=1>", "</a>", "<b", "<svg/onload=x>",
    "</svg>", "<!--", "-->", "<p style='text-align:left;x:y'>", "<td align=left>", "éж",
]


def random_pages(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 25))) for _ in range(n)]


def test_clean_html_is_stable_and_safe(spark):
    once = run(spark, lambda c: H.clean_html(c, BASE), random_pages(300, 1))
    again = run(spark, lambda c: H.clean_html(c, BASE), once)
    # attribute text is escaped once per pass, so compare pages without it
    for first, second in zip(once, again, strict=True):
        assert not re.search(r"<[^>]*\son\w+=", first)
        for tag in re.findall(r"<\s*/?\s*([a-zA-Z0-9]+)", first):
            assert tag.lower() in H.ALLOWED_TAGS
        assert first == second


def plain_text(html):
    for tag in H.BLOCK_TAGS:
        html = re.sub(rf"</?{tag}(?![A-Za-z0-9_])[^>]*>", "\n", html, flags=re.I)
    html = re.sub("<[^>]+>", "", html)
    known = {"&nbsp;": " ", "&x;": "&x;"}
    html = re.sub(r"&(?:#x[0-9a-f]+|#\d+|[a-z][a-z0-9]+);", lambda m: known.get(m[0], html_lib.unescape(m[0])), html, flags=re.I)
    html = re.sub(r"[\t ]+\n", "\n", html)
    html = re.sub(r"\n[\t ]+", "\n", html)
    html = re.sub(r"\n{3,}", "\n\n", html)
    return re.sub(r"[\t ]{2,}", " ", html).strip()


def test_text_against_brute_force(spark):
    pages = random_pages(400, 2)
    assert run(spark, H.html_text, pages) == [plain_text(p) for p in pages]


def test_names_in_paths_are_escaped_as_one_text(spark):
    """Letters of other scripts and blanks take the short way, with the same result as segment by segment."""
    from urllib.parse import quote

    from inkloom.functions.text import encode_path
    from inkloom.functions.urls import _NAMED_ROOTED, column_url
    from inkloom.operators.fetches import _PLAIN_ROUTE, route_file

    names = ["/order-1/глава 1!", "/é/a b/(x)'", "/a/b~", "/order-7"]
    other = ["/a//b", "/a%2Fb", "/a ", "/a/", "/", "/a/../b c"]
    rows = spark.createDataFrame([(n,) for n in names + other], "p string")
    p = F.col("p")
    got = {r.p: r for r in rows.select(p, encode_path(p).alias("e"), route_file(p).alias("r"), column_url(p, "https://n.example").alias("u"), p.rlike(_PLAIN_ROUTE).alias("plain"), p.rlike(_NAMED_ROOTED).alias("named")).collect()}
    for n in names:
        assert got[n].plain and got[n].e == quote(n, safe="/!'()~*") and got[n].r == got[n].e[1:] + ".json"
        assert got[n].named == ("~" not in n) and got[n].u == "https://n.example" + quote(n, safe="/!'()~*")
    assert [o for o in other if got[o].plain] == ["/a/../b c"]
    assert not any(got[o].named for o in ("/a%2Fb", "/a ", "/a/../b c"))
    assert [got[o].r for o in other] == ["a/b.json", "a%2Fb.json", "a.json", "a.json", "index.json", "a/../b%20c.json"]
    assert [got[o].u for o in other] == [f"https://n.example{t}" for t in ("/a//b", "/a%2Fb", "/a", "/a/", "/", "/b%20c")]


def test_texts_are_read_without_variants(spark):
    """Texts and numbers leave an object as such; only ids and flags, whose kind of value matters, as VARIANT."""
    bodies = ['{"s":"x","n":"-0.5","m":12.25,"o":{"k":1},"i":"9"}', '{"s":5,"n":true,"m":"0b11","o":{},"i":[1]}', '{"s":" \\u3000","n":{"a":1},"m":null,"o":[1],"i":7.0}']
    docs = spark.createDataFrame([(b,) for b in bodies], "body string").select(F.try_parse_json("body").alias("raw"))
    df, f = P.read_fields(docs, F.col("raw"), "_", texts={"s": "s"}, raw_texts={"any": "s"}, numbers={"n": "n", "m": "m"}, integers={"i": "i"}, filled={"o": "o"}, ids={"id": "i"})
    read = next(line for line in df._jdf.queryExecution().analyzed().toString().split("\n") if "try_variant_get(raw" in line)
    assert "BinaryType" in read and read.count("VariantType") == 1
    rows = df.select(*[f[n].alias(n) for n in ("s", "any", "n", "m", "i", "o")], f["id"]["value"].alias("id")).collect()
    assert [tuple(r) for r in rows] == [
        ("x", "x", -0.5, 12.25, 9, True, "9"), (None, None, None, 3.0, None, False, None), (None, " 　", None, None, 7, None, "7"),
    ]


def test_first_place(spark):
    """The first place with a non-empty object, told where it lies."""
    bodies = ['{"a":{},"b":{"x":1}}', '{"a":[1],"b":5}', '{"a":{"id":null}}', '{"b":{"id":1},"a":{"z":{}}}', "[1]", "5"]
    docs = P.with_document(spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, body string"))
    paths = ("a", "b")
    out = docs.withColumn("place", P.first_place(F.col("doc"), paths)).withColumn("x", P.at_place(F.col("place"), F.col("doc"), paths)("struct<x: string>"))
    got = [(r.place, r.x and r.x.x) for r in out.orderBy("i").collect()]
    assert got == [(1, "1"), (None, None), (0, None), (0, None), (None, None), (None, None)]


def test_tails_are_found_from_the_end(spark):
    """No text is turned round to find a last mark, and short image lists are not sorted."""
    from inkloom.functions import html as H

    rows = ["", "x", "a>b", "a>b>", ">", "é>ü<!-- c --> d --", "<!doctype x>y<!--", "<!-- a", "-->", "<img src=' ' data-src='/a.png'>é", None]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, h string")
    h = F.col("h")
    out = df.select("i", H._split_after_last(h, ">", lambda a, b: F.struct(a.alias("a"), b.alias("b"))).alias("s"), H.drop_unsafe_html(h).alias("d"), H.html_images(h, BASE)["url"].alias("u"))
    assert "reverse(h" not in out._jdf.queryExecution().analyzed().toString()
    got = [r for r in out.orderBy("i").collect()]
    want = [(r[: r.rfind(">") + 1], r[r.rfind(">") + 1 :]) for r in rows[:-1]]
    assert [tuple(r.s) for r in got[:-1]] == want and (got[-1].d, got[-1].u) == (None, None)
    assert [r.d for r in got[:-1]] == ["", "x", "a>b", "a>b>", ">", "é>ü d --", "y<!--", "<!-- a", "-->", rows[9]]
    assert [r.u for r in got[:-1]] == [[]] * 9 + [[f"{BASE}/a.png"]]
