import pytest

from wirelake.llm import html

PAGES = {
    "<p>One &amp; two&nbsp;&copy; <b>three</b>\n four<br>five</p>": "One & two © three four five",
    "<script>var a = '<p>no</p>';</script><style>p{}</style><article><p>a b c &lt;p&gt;</article>": "a b c <p>",
    "<article><h1>T</h1><div class=ad>Buy this now and never again be sad about it, only today</div><p>Short.<p>Next one</article><footer>&copy; x</footer>": "T\nShort.\nNext one",
    "<nav><a href='/'>Home</a></nav><article><p>5 < 6 and 7 > 3<p title='a > b'>quoted": "5 < 6 and 7 > 3\nquoted",
    "<article><p>cut off in a tag <a hre": "cut off in a tag",
    "<article><!-- <p>hidden</p> --><p hidden>gone</p><p>shown</p><section class='comments'><p>I do not agree with any of this at all, sorry</p></section></article>": "shown",
    "<main><p>text</p><form><p>Leave us your address and we will write to you</p></form></main>": "text",
    "<article><p>unclosed <b>bold</article><aside><p>Something quite different that stands beside the article itself</p></aside>": "unclosed bold",
    "": "", "<html></html>": "", "<script>never closed <p>x</p>": "", "<!-- never closed <p>x</p>": "",
}


@pytest.mark.parametrize("page", PAGES)
def test_pages(page):
    assert html.main_text(page) == PAGES[page]


@pytest.mark.parametrize(
    "attributes, shown",
    [
        ("data-title='The hidden valley'", True), ('class="prose hidden md:block"', True), ('alt="style=\'display:none\'"', True),
        ("title='a aria-hidden=true b'", True), ("data-hidden=1", True), ("aria-hidden=false", True), ("style='color:red'", True),
        ("style='--display:none'", True), ("style='display:none;display:block'", True), ("hidden", False), ("title='x'hidden", False),
        ("HIDDEN=''", False), ("aria-hidden = TRUE", False), ('style="color: red; display : none"', False), ("title=> hidden", True),
    ],
)
def test_hidden_is_an_attribute(attributes, shown):
    assert html.main_text(f"<article {attributes}><p>The whole text</p></article>").endswith("The whole text") == shown


PROSE = "The harvest ended two weeks early this year because the summer had been dry and the grain was ripe. " * 3
WRAPPED = {
    "part of a name": '<div class="layout has-sidebar"><article><p>@</p></article></div>',
    "article inside": '<div class="layout sidebar"><article><p>@</p></article><p>More</p></div><div><p>@ @ @</p></div>',
    "form round the page": "<form id=aspnetForm><nav><a href=1>x</a></nav><div><p>@</p></div></form>",
    "named widget": '<div class="elementor-widget elementor-widget-text-editor"><p>@</p></div>',
    "wrapper with most words": "<div class=sidebar><div><p>@</p></div></div><div class=footer>All rights</div>",
    "wrapper inside main": '<main><h1>Hi</h1><div class="widget"><p>@</p></div></main>',
    "words alone": "<div class=notice><p>@ @</p></div><div class=legal><p>@ @</p></div><div class=alert><p>@ @</p></div>",
}


@pytest.mark.parametrize("name", WRAPPED)
def test_wrappers_do_not_hide_the_article(name):
    found = html.main_text(WRAPPED[name].replace("@", PROSE.strip()))
    assert found.count("The harvest") == PROSE.count("The harvest") * WRAPPED[name].count("@")


def test_what_lies_beside_the_article_stays_out():
    rest = f"<article><p>{PROSE} {PROSE}</p></article>"
    for beside in ("<aside><article><p>@</p></article></aside>", "<section id=comments><p>@</p></section>", "<nav>" + "<a href=1>The harvest of it</a> " * 90 + "</nav>"):
        assert html.main_text(rest + beside.replace("@", "Nobody asked for my view of it but here it is anyway")).count("\n") == 0
    found = html.page_blocks("<div class=sidebar>" * 20_000 + "<article>x")
    assert [(b.aside, b.main) for b in found] == [(False, True)]


def test_tree_fits_its_table():
    tree = html.tree()
    for page in html.LABELLED:
        found = html.page_blocks(page)
        assert [tree.says(row) for row in html.features(found)] == [b.label for b in found]


def test_hostile_pages_end():
    for page in ("<a title=\"" * 20_000, "<" * 100_000, "<div>" * 20_000 + "x", "</div>" * 50_000, "<p>" * 50_000, "&" * 100_000):
        html.main_text(page)


def test_table(spark):
    rows = [(1, "u", "<p>" + "long text here " * 100_000), (2, None, None), (None, "v", "<article><p>x</article>"), (2, None, None), (3, "w", "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'t' AS text", "1 AS n_chars")
    got = html.extract(pages).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: (r["url"], r["text"], r["n_chars"]) for r in got}
    assert by[None] == ("v", "x", 1) and by[2] == (None, "", 0) and by[3] == ("w", "", 0) and by[1][2] == 1_499_999
    assert html.extract(pages.limit(0)).count() == 0


def test_query(spark, sf_dir):
    got = html.op10(spark, sf_dir)
    assert got.count() == spark.read.parquet(f"{sf_dir}/pages.parquet").count()
    assert got.filter("n_chars <> length(text) OR text LIKE '%<p>%' OR text LIKE '%©%'").count() == 0
