import html
import re

import pytest

from envlake.llm.html_text import extract, main_text

BODY = "<h1>Title &amp; more</h1><p>First   paragraph\n of <b>text</b> with <a href=x>one link</a> and words enough to be dense &eacute;.</p><p>Second &lt;tag&gt; &#x41; paragraph with words words words words.<p>Tiny."
TEXT = "Title & more\nFirst paragraph of text with one link and words enough to be dense é.\nSecond <tag> A paragraph with words words words words.\nTiny."
AROUND = [
    "<article>{}</article>",
    "<main><div class=post>{}</div></main>",
    "<div class=content>{}</div>",
    "<nav><ul><li><a href=/>Home</a><li><a href=/b>More</a></ul></nav><article>{}</article><footer>(c) 2020</footer>",
    "<header><a href=/>Site</a> name of it</header><div id=menu><a href=a>A</a> <a href=b>B</a></div><div><div class='entry'>{}</div><div class='sidebar'><p>Popular things you should read next on this site.</p></div></div>",
    "<div class='cookie-notice'>We use cookies on this site, as all do.</div><article>{}<section id=comments><h3>Comments</h3><p>Reader: nice article, I liked it very much and so on.</p></section></article>",
    "<div class=ad>Buy this, it is very good and cheap and new.</div><article>{}<form>Search <input name=q><button>Go</button></form><script>var a='<p>no</p>';</script><style>p{{x:1}}</style></article><aside>Related words</aside>",
    "<div role=banner>Sign in here to go on reading</div><div class=story>{}</div><div role=contentinfo>Imprint and more</div><!-- <p>gone</p> -->",
]


@pytest.mark.parametrize("around", AROUND)
def test_the_article_alone_is_left(around):
    page = f"<!DOCTYPE html><html><head><title>T</title><script>x</script></head><body>{around.format(BODY)}</body></html>"
    assert main_text(page) == TEXT


@pytest.mark.parametrize("page, text", [(None, ""), ("", ""), ("text only", "text only"), ("<p>a<p>b", "a\nb"), ("<!-- x", ""), ("<script>never", ""), ("<", "<"), ("a <b c", "a <b c"), ("<a title='x>y'>z</a>", "z"), ("<ul><li>one<li>two</ul>", "one\ntwo"), ("a<br>b", "a b")])
def test_odd_pages(page, text):
    assert main_text(page) == text


def test_hostile_pages_end():
    for page in ('<a title="' * 20000, "<div>" * 20000 + "x", "<!--" * 20000, "<script>" * 20000, "&" * 100000, "<p" * 50000 + ">"):
        main_text(page)


def test_columns_and_driver_rows(spark, data):
    pages = spark.read.parquet(f"{data}/pages.parquet")
    for r in extract(pages).collect():
        article = re.search("<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:h1|p)>", article)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)
    odd = spark.createDataFrame([(1, None, "u"), (2, "", "u"), (3, "<p>😀", "u")], "page_id bigint, html string, text string")
    assert [(r.text, r.n_chars) for r in extract(odd).orderBy("page_id").collect()] == [("", 0), ("", 0), ("😀", 1)]
    assert extract(odd.limit(0)).count() == 0


LINKS = "<ul>" + "".join(f"<li><a href=/{i}>Some other page of this site {i}</a></li>" for i in range(9)) + "</ul>"


@pytest.mark.parametrize(
    "around",
    [
        "<main><div class=rail>" + LINKS + "</div><div class=post>{}</div></main>",
        "<div><div class=rail>" + LINKS + "</div><div class=post>{}</div></div>",
        "<article><div>" + LINKS + "</div><div class=post>{}</div></article>",
    ],
)
def test_density_decides_inside_main_too(around):
    assert main_text(f"<html><body>{around.format(BODY)}</body></html>") == TEXT


@pytest.mark.parametrize(
    "head, body",
    [
        ("<div class='post'><div class='entry-header'>{}</div>{}</div>", 1),
        ("<div id=page><div class='post'><div class='entry-header'>{}</div><div class='entry-content'>{}</div></div></div>", 1),
        ("<main><div class='share-box'>{}</div><div class=x>{}</div></main>", 1),
        ("<article><div class='page-header'>{}</div><div class=x>{}</div></article><div class=sidebar>no</div>", 1),
        ("<header>{}</header><div class=x>{}</div>", 0),
        ("<div class=header>{}</div><div class=x>{}</div>", 0),
    ],
)
def test_headings_of_the_article_survive_their_class(head, body):
    title, rest = BODY.split("</h1>")
    got = main_text(f"<html><body>{head.format(title + '</h1>', rest)}</body></html>")
    assert got == (TEXT if body else TEXT.partition("\n")[2])


def test_the_core_is_that_of_the_formula():
    """Composite text density, written again for pages of divs, paragraphs and links without classes."""
    import random
    from math import e, log
    from xml.etree import ElementTree

    from envlake.llm import html_text

    rng = random.Random(6)

    def part(depth):
        if depth == 0 or rng.random() < 0.3:
            words = " ".join(rng.choice(["word", "a", "longerword"]) for _ in range(rng.randint(1, 30)))
            return f"<p>{words}<a>{'link ' * rng.randint(0, 5)}x</a></p>" if rng.random() < 0.4 else f"<p>{words}</p>"
        return "<div>" + "".join(part(depth - 1) for _ in range(rng.randint(1, 4))) + "</div>"

    for _ in range(60):
        page = "<html>" + "".join(part(3) for _ in range(3)) + "</html>"
        nodes = list(ElementTree.fromstring(page).iter())
        chars = {n: len("".join(n.itertext()).replace("\n", "")) for n in nodes}
        strip = {n: sum(len((x.text or "").strip()) for x in n.iter()) + sum(len((x.tail or "").strip()) for x in n.iter() if x is not n) for n in nodes}
        tags = {n: len(list(n.iter())) for n in nodes}
        links = {n: [x for x in n.iter("a")] for n in nodes}
        lc = {n: sum(strip[x] for x in links[n]) for n in nodes}
        lt = {n: sum(tags[x] for x in links[n]) for n in nodes}
        body = nodes[0]

        def density(n):
            c, t = strip[n], tags[n]
            if not c:
                return 0.0
            base = log(c / max(c - lc[n], 1) * lc[n] + lc[body] / max(strip[body], 1) * c + e)
            up = log(max(c / max(lc[n], 1) * t / max(lt[n], 1), 1.0))
            return c / t * max(up / log(base) if base > 1.0001 else up, 0.0)

        sums = {n: sum(density(x) for x in n) for n in nodes}
        root = html_text.tree(page)
        _, core, _ = html_text._densest(root, html_text._measure(root))
        assert core.total == pytest.approx(max(sums.values())) and chars
        assert core.chars in {strip[n] for n in nodes if sums[n] == pytest.approx(max(sums.values()))}


LONG = "".join(f"<p>Reader {i}: I liked this very much and have a lot of words to say about it, more than the article has.</p>" for i in range(30))


@pytest.mark.parametrize(
    "around",
    [
        "<article>{}<section id=comments>" + LONG + "</section></article>",
        "<div class=content>{}</div><div class=comments>" + LONG + "</div>",
        "<div class=content>{}</div><section id=comments><h1>Comments</h1><article>" + LONG + "</article></section>",
        "<div class=content>{}</div><div class=sidebar>" + LONG + "</div>",
        "<div class='cookie-notice'>" + LONG + "</div><article>{}</article>",
        "<div class='page sidebar-right'><article>{}</article><div class=comments>" + LONG + "</div></div>",
        "<div class='page sidebar-right'>{}<div class=comments>" + LONG + "</div></div>",
        "<div class='comments-open'><main>{}</main></div>",
    ],
)
def test_parts_are_cut_for_what_they_are_not_for_their_length(around):
    assert main_text(f"<html><body>{around.format(BODY)}</body></html>") == TEXT


def test_a_page_inside_one_layout_part_is_not_lost():
    assert main_text("<div class=sidebar-page><p>First words of it.</p><p>More words.</p></div>") == "First words of it.\nMore words."
    assert main_text("<div class=comments><p>First words of it.</p></div>") == ""


PARAGRAPHS = "".join(f"<p>Paragraph {i} has a sentence that is long enough to be taken for prose, with some words more.</p>" for i in range(4))


def test_a_form_around_the_page_is_no_form():
    page = f"<body><form id=aspnetForm><input name=q><label>Search</label><main><h1>Title</h1>{PARAGRAPHS}</main></form></body>"
    want = main_text(f"<body><main><h1>Title</h1>{PARAGRAPHS}</main></body>")
    assert main_text(page) == want and want.startswith("Title\nParagraph 0")
    assert main_text(page.replace("</body>", "<div>x y z</div></body>")) == want
    bare = main_text(f"<body><form action=/><div>{PARAGRAPHS}</div><button>Send</button></form></body>")
    assert bare.count("Paragraph") == 4 and "Send" not in bare
    # a form beside or inside an article is cut, whatever it says
    beside = f"<body><article><h1>Title</h1>{PARAGRAPHS}<form><p>Tell us what you think of this.</p><label>Name</label></form></article><form><p>Subscribe now.</p></form></body>"
    assert main_text(beside) == want


def test_sections_whose_names_are_also_those_of_other_parts():
    for name in ("id=discussion", "id=related-work", "class=warning", "class='side-effects'"):
        page = f"<body><article><h1>Title</h1>{PARAGRAPHS}<section {name}><h2>Head</h2>{PARAGRAPHS.replace('Paragraph', 'Section')}</section></article></body>"
        assert main_text(page).count("Section") == 4, name
    cut = {
        "class=related": "<h3>More</h3><ul><li><a href=/a>One teaser</a></li><li><a href=/b>Other teaser</a></li></ul>",
        "class=recommended": "<div>Short teaser</div><div>Other one</div>",
        "id=discussion": f"<div class=comment>{PARAGRAPHS.replace('Paragraph', 'Opinion')}</div>",
        "class=comments": PARAGRAPHS.replace("Paragraph", "Opinion"),
    }
    for name, inner in cut.items():
        page = f"<body><article><h1>Title</h1>{PARAGRAPHS}<section {name}>{inner}</section></article></body>"
        assert main_text(page) == main_text(f"<body><article><h1>Title</h1>{PARAGRAPHS}</article></body>"), name
    page = f"<body><article><h1>Title</h1>{PARAGRAPHS}</article><div class=responses>{PARAGRAPHS.replace('Paragraph', 'Opinion')}</div></body>"
    assert "Opinion" not in main_text(page)


def test_what_a_style_hides():
    page = f"<body><article><h1>Title</h1>{PARAGRAPHS}<div style='color:red; display : none'>{PARAGRAPHS.replace('Paragraph', 'Unseen')}</div></article></body>"
    assert main_text(page).count("Paragraph") == 4 and "Unseen" not in main_text(page)
