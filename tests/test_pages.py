import zlib

import pytest
from pyspark.sql import functions as F

from syllaspark.functions import discovery, pdf, text
from syllaspark.functions.html import Selector, extract_css, parse, rendered_text, select_text, text_of
from syllaspark.functions.pdfread import read_pages
from syllaspark.schema import CODE


def _ids(selector, html):
    return [n.attrs.get("id") for n in Selector(selector).all(parse(html))]


PAGE = """<main><div id=a class="x col-md-12"><p id=p1>En<p id=p2>To <b>tre</p></b></div>
<article id=b class="content-emweb"><ul><li id=l1>1<li id=l2 class="link--">2</ul></article></main><div id=c class=hovedfelt><main id=m><div id=d class="col-md-12">x</div></main></div>
<select id=s><option id=o1 value="?p_document_id=1">A<option id=o2 value=2>B</select>"""


@pytest.mark.parametrize(
    ("selector", "want"),
    [
        ("p", ["p1", "p2"]),
        ("#a", ["a"]),
        (".link--", ["l2"]),
        ("article.content-emweb", ["b"]),
        ("article li", ["l1", "l2"]),
        (".hovedfelt > main > div.col-md-12", ["d"]),
        ("main > p", []),
        ("li, p", ["p1", "p2", "l1", "l2"]),
        ("option[value*='p_document_id']", ["o1"]),
        ("select#s", ["s"]),
        ("[class]", ["a", "b", "l2", "c", "d"]),
    ],
)
def test_selectors(selector, want):
    assert _ids(selector, PAGE) == want


def test_bad_selector():
    with pytest.raises(ValueError):
        Selector("p:first-child")


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("<p>En   to\n tre</p>", "En to tre"),
        ("a<br>b<br/>c", "a\nb\nc"),
        ("<p>a</p><p>b</p>", "a\n\nb"),
        ("<div>a</div><div>b <span>c</span></div>", "a\nb c"),
        ("<ul><li>a<li>b</ul>", "a\nb"),
        ("<table><tr><td>a</td><td>b</td></tr><tr><td>c</td></tr></table>", "a\tb\nc"),
        ("x<script>var a='</p>'</script><style>p{}</style>y", "xy"),
        ("<pre>a\n  b</pre>", "a\n  b"),
        ("&lt;b&gt; &amp; &aring;", "<b> & å"),
        ("", ""),
        ("</p></div>løs", "løs"),
    ],
)
def test_text(html, want):
    assert text_of(parse(html)) == want


def test_references_end_in_a_semicolon():
    page = parse("<h1 title='?a=1&copy=2&amp;b'>a &amp&amp; b&ampx; c&nbsp d &#229; &copyright; &amp</h1><script>x &amp&y</script>")
    h1 = Selector("h1").first(page)
    assert text_of(h1) == "a &amp& b&ampx; c&nbsp d å &copyright; &amp" and h1.attrs == {"title": "?a=1&copy=2&b"}
    assert Selector("script").first(page).raw_text() == "x &amp&y"


def test_nested_matches_repeat_their_text():
    assert select_text("<div class=a>x<div class=a>y</div></div>", Selector(".a"), "multi") == "x\ny\ny"


def test_extract_column(spark):
    rows = spark.createDataFrame([("<main> a <p>b</p></main>",), ("<p>no</p>",), ("",), (None,), ("<main></main>",)], "h string")
    assert [r[0] for r in rows.select(extract_css(F.col("h"), "main", after=F.upper)).collect()] == ["A\n\nB", None, None, None, None]
    cells = spark.createDataFrame([("<main><table><tr><td>a</td><td>b</td></tr></table></main>",)], "h string")
    assert cells.select(extract_css(F.col("h"), "main", before=text.break_cells)).first()[0].split() == ["a", "b"]


def test_links_and_options(spark):
    pages = spark.createDataFrame([("A.1", '<a href="/emne/A.1/12">2024 Haust</a><a href="/emne/AX1/13">2023 Vår</a><a href="/emne/A.1/x">2022 Vår</a><a>2021 Vår</a><a href="/emne/A.1/14">uten</a>'), ("B", None)], f"{CODE} string, html string")
    assert [tuple(r)[:4] for r in discovery.discover_links(pages).collect()] == [("A.1", 2024, "Høst", "https://www.hivolda.no/emne/A.1/12")]
    menu = spark.createDataFrame([("A", '<select><option value="/x?p_document_id=7">A: H 2023<option value="/y">A: V 2022</select>')], f"{CODE} string, html string")
    assert [tuple(r)[:4] for r in discovery.discover_options(menu).collect()] == [("A", 2023, "Høst", "https://uit.no/x?p_document_id=7")]


def test_first_pdf(spark):
    rows = spark.createDataFrame([('<p>se https://a.no/x.pdf?v=1 "</p><iframe src="/y.pdf">',), ('<embed src="/y.pdf">',), ("<p>x</p>",), (None,)], "h string")
    assert [r[0] for r in rows.select(discovery.first_pdf(F.col("h"))).collect()] == ["https://a.no/x.pdf?v=1", "/y.pdf", None, None]


def test_pdf_text(spark):
    def reader(data):
        if data == b"bad":
            raise ValueError
        return data.decode().split("|")

    rows = spark.createDataFrame([(bytearray(b"a|b\n\n\n\nc "),), (bytearray(b"bad"),), (None,), (bytearray(b" | "),)], "raw binary")
    assert [r[0] for r in rows.select(pdf.pdf_text(F.col("raw"), reader)).collect()] == ["a\nb\n\nc", None, None, None]
    assert spark.range(1).select(pdf.cache_name(F.lit("Pedagogikk og æ!"))).first()[0] == "pedagogikk_og_"


def test_small_texts(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    assert one(text.module_name(F.lit("  Pedagogikk og  Elevkunnskap 1 , emne 4"))) == "pedagogikk og elevkunnskap1, emne 4"
    assert one(text.renumber_module(F.lit("pedagogikk og elevkunnskap1, emne 4"))) == "pedagogikk og elevkunnskap2, emne 1"
    assert one(text.shadow_text(F.lit("keyboard_backspace\n  a  \n\n\n\n b"))) == "a\n\nb"
    assert one(text.cut_timetable(F.lit("a Vis detaljert timeplan\nb"))) == "a"
    assert one(text.same_text(F.lit(" a\n"), F.lit("a"))) is True
    assert one(text.sentences(F.lit(" A. B.\n\nC "))) == ["A.", "B.", "C"]
    assert one(text.soft_404(F.lit("hvl"), F.lit("Vi kunne ikkje finne emnet du ser etter"))) == "hvl_not_found_error"
    assert one(text.soft_404(F.lit("uia"), F.lit("Vi kunne ikkje finne emnet du ser etter"))) is None


def test_page_ok(spark):
    rows = [(200, "text/html", "Emne", "x" * 120, "A1"), (200, "text/html", "Emne", "kort a1", "A1"), (200, "text/html", "Emne", "kort", "A1"), (404, "text/html", "Emne", "x" * 200, "A1"), (200, "application/pdf", None, "x" * 200, "A1"), (302, "text/html", "Page not found", "x" * 200, "A1"), (None, None, None, None, None)]
    frame = spark.createDataFrame(rows, "s int, t string, h string, b string, c string")
    assert [r[0] for r in frame.select(text.page_ok(*[F.col(c) for c in "sthbc"])).collect()] == [True, True, False, False, False, False, False]


def _pdf(*objects: bytes) -> bytes:
    return b"%PDF-1.5\n" + b"".join(b"%d 0 obj\n%s\nendobj\n" % (k, o) for k, o in enumerate(objects, 1)) + b"trailer << /Root 1 0 R >>"


def _stream(data: bytes, extra: bytes = b"") -> bytes:
    packed = zlib.compress(data)
    return b"<< /Length %d /Filter /FlateDecode %s >>\nstream\n%s\nendstream" % (len(packed), extra, packed)


def test_pdf_reader():
    plain = _pdf(
        b"<< /Type /Catalog /Pages 2 0 R >>",
        b"<< /Type /Pages /Kids [3 0 R 4 0 R] /Resources << /Font << /F1 << /Subtype /Type1 >> /F2 7 0 R >> >> >>",
        b"<< /Type /Page /Parent 2 0 R /Contents 5 0 R >>",
        b"<< /Type /Page /Parent 2 0 R /Contents [6 0 R] >>",
        _stream(b"BT /F1 12 Tf (Norsk 1, emne 1) Tj 0 -14 Td [(Inn) 20 (hold) -300 (og \\(m\\345l\\))] TJ ET"),
        _stream(b"BT /F2 9 Tf <00010002> Tj T* <0010> Tj ET"),
        b"<< /Subtype /Type0 /ToUnicode 8 0 R >>",
        _stream(b"1 begincodespacerange <0000> <FFFF> endcodespacerange 2 beginbfchar <0001> <00C5> <0002> <006B0061> endbfchar 1 beginbfrange <0010> <0012> <0041> endbfrange"),
    )
    assert read_pages(plain) == ["Norsk 1, emne 1\nInnhold og (mål)", "Åka\nA"]
    inner = b"1 0 2 34 << /Type /Catalog /Pages 2 0 R >> "
    first = inner.index(b"<<")
    body = inner[first:] + b"<< /Type /Pages /Kids [4 0 R] >>"
    table = b"1 0 2 %d " % len(inner[first:])
    packed = _pdf(b"null", b"null", _stream(table + body, b"/Type /ObjStm /N 2 /First %d" % len(table)), b"<< /Type /Page /Contents 5 0 R >>", _stream(b"BT (tett) Tj ET"))
    packed = packed.replace(b"1 0 obj\nnull\nendobj\n", b"").replace(b"2 0 obj\nnull\nendobj\n", b"")
    assert read_pages(packed) == ["tett"]
    assert read_pages(b"no document") == []
    with pytest.raises(ValueError):
        read_pages(b"%PDF /Encrypt")


def test_rendered_text(spark):
    inner = "<h1>Plan</h1><div>En <b>to</b><br>tre</div><x-y><template shadowrootmode=open><p>inni</p></template>etter</x-y>"
    page = f"<usn-study><template shadowrootmode=open><usn-study-subject><template shadowrootmode=open>{inner}</template></usn-study-subject></template></usn-study>"
    rows = spark.createDataFrame([(page,), ("<usn-study>x</usn-study>",), (None,)], "h string")
    assert [r[0] for r in rows.select(rendered_text(F.col("h"))).collect()] == ["Plan\nEn to\ntre\ninni\netter", None, None]
