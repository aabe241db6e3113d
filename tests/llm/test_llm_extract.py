import pytest
from llm_cases import prose

from millrace.llm.extract import extract_text, low_branches, main_text

CASES = [
    (
        '<html><body><header><h1>Site</h1></header><div class="content with-sidebar"><article><header><h1>T</h1></header>'
        '<p>a&nbsp;b &amp;  c<br>d<p>e<div class="ad">x</div><aside>n</aside><p>f<form><p>q</form>'
        '<section id="comments"><p>zz</section></article></div><div class="cookie-notice">ck</div><footer>f</footer>',
        "T\na b & c d\ne\nf",
    ),
    ("plain text", "plain text"),
    ("", ""),
    ('<p>one<p>two<ul><li>x<li>y</ul><script>if(a<b)"</p>"</script>tail', "one\ntwo\nx\ny\ntail"),
    ('<div><nav>a</nav><h2>H</h2><p>foo <b>bar</b>baz</p><div class="sidebar">s</div></div>', "H\nfoo barbaz"),
    ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"),
    ('<article><p>a <span class="ad">buy</span> b</p></article>', "a b"),
    ('<main><p>x</p><div class="share">s</div></main><p>out</p>', "x"),
    ('<p title="a>b">x</p><p class=\'ad\'>y</p><p>1 < 2</p><!-- <p>c</p> --><p>&lt;b&gt;</p>', "x\n1 < 2\n<b>"),
    ("<p><b>open<br><p>next", "open\nnext"),
    ("<article><p>x</article><!-- never closed <p>y", "x"),
    ("<style>p{}</style><p>&#233;&eacute;&copy;</p><script>never closed", "éé©"),
]


@pytest.mark.parametrize("html, text", CASES)
def test_single_pages(html, text):
    assert main_text(html, frozenset()) == text


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows], "page_id bigint, url string, html string, text string, host int")


def test_repeated_branches_of_a_site_go(spark):
    # No name marks the frame: only its return on every page of the host does.
    rows = []
    for i in range(12):
        body = f"<div class=top><p>{prose(i, 30)}</p><p>{prose(50 + i, 20)}</p></div>"
        rows.append((i, f"http://Site.test/{i}", f"<body><div class=frame><div class=z1><p>Buy our things<p>Call us</div></div>{body}"))
    rows.append((100, "http://lone.test/", "<body><div class=z1><p>Buy our things</div>"))
    rows += [(200, None, None), (201, "no scheme", ""), (None, "http://site.test/9", rows[3][2]), (5, *rows[5][1:])]
    low = {(r.host, r.path) for r in low_branches(pages(spark, rows)).collect()}
    assert low and {h for h, _ in low} == {"site.test"}
    got = {(r.page_id, r.url): r for r in extract_text(pages(spark, rows)).collect()}
    assert extract_text(pages(spark, rows)).count() == len(rows)
    for i in range(12):
        assert got[i, f"http://Site.test/{i}"].text == f"{prose(i, 30)}\n{prose(50 + i, 20)}"
    assert got[100, "http://lone.test/"].text == "Buy our things"
    assert got[200, None].text == "" and got[200, None].n_chars == 0
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_copies_of_an_article_stay(spark):
    html = f"<body><article><h1>T</h1><p>{prose(1, 40)}</p></article>"
    rows = [(i, "http://a.test/", html + f"<!-- {i} -->") for i in range(20)]
    assert {r.text for r in extract_text(pages(spark, rows)).collect()} == {f"T\n{prose(1, 40)}"}


def test_blocks_outside_an_article_are_judged(spark):
    rows = []
    for i in range(12):
        titled = f"<body><main><div><h1>{prose(i, 5)}</h1><p>Call us now</div><article><p>{prose(i, 30)}</article></main>"
        carded = f"<body><main><div><p>{prose(i, 40)}</div><article class=card><p>Read our offers</article></main>"
        rows += [(i, f"http://titled.test/{i}", titled), (100 + i, f"http://carded.test/{i}", carded)]
    got = {r.page_id: r.text for r in extract_text(pages(spark, rows)).collect()}
    for i in range(12):
        assert got[i] == f"{prose(i, 5)}\n{prose(i, 30)}"
        assert got[100 + i] == prose(i, 40)


def test_empty_table(spark):
    assert extract_text(pages(spark, [(1, "u", "h")]).limit(0)).count() == 0
