from pyspark.sql import functions as F

from corpusmill import api
from corpusmill.functions.html import decode_bytes, html_strip, html_to_text

PAGE = """<!DOCTYPE html>
<html><head><title>Hidden</title><meta name="a" content="b"><style>p > a {}</style></head>
<body><!-- no --><div>
  <h1>The   heading</h1>
  <div><p>
     First paragraph over
     two lines.
  </p><img alt="hidden" src="x.png"/>
  <p>Second with <a href="y>z">a link</a>&nbsp;&amp; &lt;tag&gt; &#8217;q&#x2019;.</p></div>
  <div class="t"><ul><li>one</li><li><p>two</p></li><li></li></ul></div>
  <script>if (a < b) { "</p>" }</script>
  last<br>line</div></body></html>
"""
TEXT = """The heading

First paragraph over two lines.

Second with a link & <tag> ’q’.

  • one
  • two

last
line"""


def run(spark, values, function):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, html string")
    return [r[1] for r in df.select("i", function(F.col("html"))).orderBy("i").collect()]


def test_page(spark):
    assert run(spark, [PAGE], html_to_text) == [TEXT]


def test_odd_pages(spark):
    cases = {
        "": "",
        "plain": "plain",
        "a < b and c > d": "a < b and c > d",
        "<p>one<p>two": "one\n\ntwo",
        "<script>never closed": "",
        "<!-- never closed": "",
        "<div><div>x</div></div><div>y</div>": "x\ny",
        "<table><tr><td>1</td><td>2</td></tr><tr><td>3</td></tr></table>": "1 2\n3",
        "<LI>x</LI>": "  • x",
        "<a title='a<b>c'>q</a>": "q",
        "a&unknown;b": "a&unknown;b",
    }
    assert run(spark, list(cases), html_to_text) == list(cases.values())


def test_broken_tags_do_not_crawl(spark):
    pages = ["<div>" * 100_000 + "x", "<li>" * 100_000, "<a href='" * 50_000, "<!--" * 50_000, "<" * 300_000, '<p a="' * 50_000]
    assert len(run(spark, pages, html_to_text)) == len(pages)


def test_strip(spark):
    assert run(spark, ["<head>x</head><p>a &amp; b</p><p>c</p><!-- d -->"], html_strip) == ["\na & b\nc\n"]


def test_bytes(spark):
    pages = [
        "<p>naïve</p>".encode(),
        b"\xef\xbb\xbf<p>bom</p>",
        '<meta charset="iso-8859-1"><p>naïve</p>'.encode("latin-1"),
        "<p>naïve “q”</p>".encode("cp1252"),
        "<p>wide</p>".encode("utf-16"),
        '<meta charset="utf-8"><p>bad '.encode() + b"\xff\xfe</p>",
        '<meta charset="koi8-r"><p>привет</p>'.encode("koi8-r"),
        b"",
        None,
    ]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, content binary")
    got = [r.text for r in api.extract_text_from_html_bytes(df).orderBy("i").collect()]
    assert got == ["naïve", "bom", "naïve", "naïve “q”", "wide", "bad", "привет", "", None]


def test_long_quoted_values_and_late_charsets(spark):
    long = "y" * 2500
    pages = {
        f'<p data-x="<b>x</b> > {long}">visible</p>': "visible",
        f'one<p data-x="<b>{long}">two</p>': "one\n\ntwo",
        "<p don't>kept</p>": "kept",
        '<p>kept</p><p title="open>lost</p>': "kept",
    }
    for page, text in pages.items():
        got = spark.createDataFrame([(page,)], "h string").select(html_to_text("h").alias("t")).first().t
        assert got.strip() == text
    late = ("<!--" + "x" * 5000 + '--><meta charset="koi8-r">').encode() + "привет".encode("koi8-r")
    got = spark.createDataFrame([(bytearray(late),)], "b binary").select(decode_bytes(F.col("b")).alias("t")).first().t
    assert got.endswith("привет")


def test_unclosed_and_foreign_elements_hide_no_more_than_themselves(spark):
    cases = {
        '<p>one</p><svg class="i"/><p>two</p>': "one\n\ntwo",
        "<p>one</p><object data=x><p>two</p>": "one\n\ntwo",
        "<p>one</p><select><option>a</select><p>two</p>": "one\n\ntwo",
        "<p>one</p><select><option>a<p>two</p>": "one\n\na\n\ntwo",
        "<div><object>fallback</object>kept</div>": "kept",
        "<div><button>press<button>again</button>kept</div>": "kept",
        "<svg><title>t</title><path d='M0'/><g>x</g></svg>kept": "kept",
        "<svg><path d='M0'><p>kept</p>": "kept",
        "<svg><foreignObject><p>label</p></foreignObject></svg>kept": "kept",
        "<svg><style>a<c></style>x</svg>kept": "kept", "<svg>x<b>y</b></svg>kept": "ykept",
        "<math><mi>x</mi><![CDATA[<y>]]></math> z": "x<y> z",
        "<template><p>a</p></template>b": "b",
        "<title>never closed<p>kept</p>": "never closed\n\nkept",
        "<title>a<b>c</title>kept": "kept",
        "<script>if (a</b>c) '</scripts>'</script >kept": "kept",
        "<style>a > b {}</STYLE\n>kept": "kept",
        "a<!-->b<!--->c<!-- > -- > --!>d<!x>e<?y?>f</ z>g</>h": "abcdefgh",
        "<a href=x/>link</a><br/>next": "link\nnext",
        "<div <p>x</div>": "x",
        "cut <p": "cut",
        "1 < 2 <3 <é>": "1 < 2 <3 <é>",
        "</p></div></li>x</svg>": "x",
        "<li>a<li>b</li><li><ul><li>c</ul>": "  • a\n  • b\n  • c",
    }
    assert dict(zip(cases, run(spark, list(cases), html_to_text), strict=True)) == cases


def test_references_of_the_standard(spark):
    cases = {
        "&apos;&amp;lt;": "'&lt;", "&#150;&#x80;&#146;": "–€’", "&notit; &hellip; &NotEqualTilde;": "¬it; … ≂̸",
        "&copy &copycat &#x1F600; &#0; &#xD800;": "© ©cat 😀 � �", "&am<b>p;</b>": "&amp;", "a&nbsp;b": "a b",
        "a&#10;&#9;b": "a b", "&lt;p&gt;": "<p>",
    }
    assert dict(zip(cases, run(spark, list(cases), html_to_text), strict=True)) == cases


def test_broken_pages_take_linear_time():
    import time

    from corpusmill.functions.html import page_text

    def seconds(n):
        pages = ["<svg>" * n, "<select>" * n, "<title>" * n, "<object><p>" * n, "</p>" * n, "<p></div>" * n, "&" * n, "<svg><p>" * n, "<a b=" * n, "<!" * n, "<div><button>" * n]
        start = time.process_time()
        for page in pages:
            page_text(page)
        return time.process_time() - start

    assert seconds(80_000) < 8 * 3 * max(seconds(10_000), 0.05)


def test_encodings_without_mark_or_declaration():
    from corpusmill.functions.encodings import decode_page

    pages = {
        "cp1252": "Die Mädchen gehen über die Straße und hören schöne Lieder — “gut”",
        "latin-1": "Le garçon a été très étonné où la forêt était brûlée",
        "cp1250": "Zażółć gęślą jaźń; mężczyźni śpiewają pieśń o żółwiu",
        "iso8859-2": "Příliš žluťoučký kůň úpěl ďábelské ódy, říkal šťastný muž",
        "cp1251": "Съешь же ещё этих мягких французских булок да выпей чаю",
        "koi8-r": "В чащах юга жил бы цитрус, да фальшивый экземпляр",
        "cp866": "Широкая электрификация южных губерний даст мощный толчок",
        "cp1253": "Ξεσκεπάζω την ψυχοφθόρα βδελυγμία και γράφω ένα γράμμα",
        "cp1254": "Pijamalı hasta yağız şoföre çabucak güvendi, öğle güneşi altında",
        "cp1255": "דג סקרן שט בים מאוכזב ולפתע מצא לו חברה",
        "cp1256": "نص حكيم له سر قاطع وذو شأن عظيم مكتوب على ثوب أخضر",
        "cp932": "これは日本語の文章です。いろはにほへと、ちりぬるを。わかよたれそ",
        "euc-jp": "吾輩は猫である。名前はまだ無い。どこで生れたかとんと見当がつかぬ。",
        "gb18030": "这是一个中国人的故事，我们在这里说的是他的生活，不是你的。",
        "big5": "這是一個中國人的故事，我們在這裡說的是他的生活，不是你的。",
        "cp949": "이것은 한국어로 쓴 글이다. 나는 학교에서 한국의 역사를 배우고 있다.",
        "cp874": "ภาษาไทยเป็นภาษาที่มีระดับเสียงของคำ",
        "utf-16-le": "plain letters without a mark",
        "utf-16-be": "plain letters without a mark",
    }
    for encoding, text in pages.items():
        page = f"<html><p class='a'>{text}</p>\n<p>{text}</p></html>"
        assert decode_page(page.encode(encoding)) == page, encoding
    # A few bad bytes do not make a page of another encoding; unknown names say nothing.
    assert decode_page("naïve café déjà vu".encode() + b"\xff").endswith("vu")
    assert decode_page(b'<meta charset="nonsense">' + pages["koi8-r"].encode("koi8-r")).endswith(pages["koi8-r"])
    assert decode_page(b'<meta charset="gb2312">' + pages["gb18030"].encode("gb18030")).endswith(pages["gb18030"])
