import html as escapes
import random
import re

import pytest

from peakwise.llm import html_text, queries

SF_DIR = "/root/testdata/sf0.01"
PROSE = "This is the text of the page and it is long enough to be seen as such by the rules here."
MORE = "Another part of the same text, which is about the things that are in the world for all."


def test_query_against_the_articles_of_the_pages(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()
    got = {r.page_id: r for r in queries.op9_html_text(spark, SF_DIR).collect()}
    assert len(got) == len(pages)
    for p in pages:
        article = re.search(r"<article>(.*?)</article>", p.html, re.DOTALL)[1]
        blocks = [" ".join(escapes.unescape(re.sub(r"<[^>]*>", " ", b)).split())
                  for b in re.split(r"</?(?:h1|p)\b[^>]*>", article)]
        text = "\n".join(b for b in blocks if b)
        assert (got[p.page_id].text, got[p.page_id].n_chars) == (text, len(text))


@pytest.mark.parametrize("page, expected", [
    (None, ""), ("", ""), ("   ", ""), ("<p>", ""), ("<", ""),
    (f"<p>{PROSE}</p>", PROSE),
    (f"<p>{PROSE}<p>Short.<p>{MORE}", f"{PROSE}\nShort.\n{MORE}"),
    (f"<nav><a href=x>Home</a> {MORE}</nav><p>{PROSE}</p><footer>{MORE}</footer>", PROSE),
    (f"<ul><li><a href='a'>One</a><li><a href='b'>Two</a></ul><p>{PROSE}</p>", PROSE),
    (f"<header>{MORE}</header><aside>{MORE}</aside><form>{MORE}</form><div>{PROSE}</div>", PROSE),
    (f"<div class='cookie-notice'>{MORE}</div><div id=comments><p>{MORE}</p></div>{PROSE}", PROSE),
    (f"<p class=ad>{MORE}</p><p>{PROSE}</p><div style='display: none'>{MORE}</div>", PROSE),
    (f'<script>var t="</p>{MORE}";</script><style>p{{}}</style><p>{PROSE}</p><!-- {MORE} -->', PROSE),
    (f"<h2>A title</h2><p>{PROSE}</p><h2>Links</h2><p><a href=x>{MORE}</a></p>", f"A title\n{PROSE}"),
    (f"<p>{PROSE}</p><p>end</p><div><a href=x>{MORE}</a></div>", f"{PROSE}\nend"),
    ("<article><h1>T</h1><p>x &amp; y&nbsp;&#8212;\n z</p><p>qwrt zxcv</p></article><p>Out</p>",
     "T\nx & y — z\nqwrt zxcv"),
    (f"<article><p>{PROSE}</p><nav>{MORE}</nav><div class=share>a b</div><p>b</p></article>",
     f"{PROSE}\nb"),
    (f"<body class='no-sidebar'><main><header><h1>T</h1></header><p>{PROSE}</p></main></body>",
     f"T\n{PROSE}"),
    (f"<article><p>{PROSE}</p><article class=comment><p>{MORE}</p></article></article>", PROSE),
    (f"<p>{PROSE} &lt;b&gt; 1 &lt 2</p>", f"{PROSE} <b> 1 < 2"),
    (f"<P title='a>b'>{PROSE}<BR>more<br/>still</P>", f"{PROSE} more still"),
    (f"<table><tr><td>{PROSE}</td><td>{MORE}</td></tr></table>", f"{PROSE}\n{MORE}"),
    (f"<p>{PROSE}<!-- open", PROSE),
])
def test_blocks(page, expected):
    assert html_text.main_text(page) == expected


def test_odd_markup_takes_linear_time():
    import time

    start = time.time()
    for text in ("<div>", "<", "<a ", '<a href="', "<script>", "</b>", "<!--", "<p class='",
                 "<div class=ad>", '<a b=c"'):
        html_text.main_text(text * 30_000)
        html_text.main_text(text * 30_000 + ">")
    assert time.time() - start < 20


def test_clashing_columns_and_the_empty_table(spark):
    frame = spark.createDataFrame(
        [(1, "u", f"<p>{PROSE}", 5, "t"), (1, "u", None, 5, "t")],
        "page_id bigint, url string, html string, n_chars int, text string")
    got = html_text.extract_text(frame)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(map(tuple, got.collect())) == [(1, "u", "", 0), (1, "u", PROSE, len(PROSE))]
    assert html_text.extract_text(frame.limit(0)).count() == 0


@pytest.mark.parametrize("page, expected", [
    (f"<div><p>{PROSE}</p></div><article class=card><p>A teaser</p></article>",
     f"{PROSE}\nA teaser"),
    (f"<article><p>{PROSE}</p></article><article><p>{MORE}</p><p>end</p></article>",
     f"{PROSE}\n{MORE}\nend"),
    (f"<h1>T</h1><p>{MORE}</p><article><p>{PROSE}</p></article><p>{'qwrt zxcv ' * 20}</p>",
     f"T\n{MORE}\n{PROSE}"),
    # Stop words decide inside an article too: labels beside a link list go with it.
    (f"<article><ul><li><a href=x>{MORE}</a></li></ul><p>{'qwrt zxcv ' * 20}</p>"
     f"<ul><li><a href=x>{MORE}</a></li></ul><p>{PROSE}</p></article>", PROSE),
])
def test_articles_are_hints(page, expected):
    assert html_text.main_text(page) == expected


LONG_GREEK = "Αυτό είναι ένα μεγάλο κείμενο σε γλώσσα χωρίς λέξεις στη λίστα, και μένει με τα άλλα εδώ."
WRAPPERS = [
    "<div class='content-sidebar-wrap'>", "<div class='content with-sidebar'>",
    "<div class='has-sidebar'>", "<div class='post no-comments'>",
    "<div class='article-share-enabled'>", "<div class='notice-of-meeting'>",
    "<div class='entry-related-content'>", "<div class='site has-sidebar'><main><article>",
    "<div class='overlay'><main>", "<section class='page-social-story'>",
    "<form id=aspnetForm action=x><input type=hidden name=v><div>",
]


@pytest.mark.parametrize("wrapper", WRAPPERS)
def test_names_do_not_delete_articles(wrapper):
    page = (f"<nav><a href=x>Home</a></nav>{wrapper}<h1>T</h1><p>{PROSE}</p><p>Short.</p>"
            f"<p>{MORE}</p>")
    ends = "".join(f"</{t}>" for t in reversed(re.findall(r"<(div|main|article|section|form)\b", page)))
    assert html_text.main_text(page + ends + f"<footer>{MORE}</footer>") == (
        f"T\n{PROSE}\nShort.\n{MORE}")


@pytest.mark.parametrize("page, expected", [
    # Comments, longer than the article, stay away; so do articles within them.
    (f"<div class=post><p>{PROSE}</p></div><section class='comments-area'>"
     f"<ol class='comment-list'><li><article class='comment-body'><p>{MORE}</p></article></li>"
     f"<li><p>{MORE}</p><p>{MORE}</p></li></ol></section>", PROSE),
    (f"<main><p>{PROSE}</p></main><div class=sidebar><article><p>{MORE}</p></article></div>", PROSE),
    (f"<div class='entry-share-tools'>Tell your friends</div><p>{PROSE}</p>", PROSE),
    (f"<p>{PROSE}</p><form><p>{MORE}</p></form><p>{MORE}</p>", f"{PROSE}\n{MORE}"),
    (f"<div class='post no-comments'><p>{PROSE}</p></div><div class='post no-comments'>"
     f"<p>{MORE}</p></div>", f"{PROSE}\n{MORE}"),
    # A fifth language, and code, inherit from what is beside them.
    (f"<p>{PROSE}</p><p>{LONG_GREEK}</p><p>{MORE}</p>", f"{PROSE}\n{LONG_GREEK}\n{MORE}"),
    (f"<p>{PROSE}</p><pre>{'x = compute(y); ' * 9}</pre>", f"{PROSE}\n{('x = compute(y); ' * 9).strip()}"),
    (f"<h1>T</h1><p>{LONG_GREEK * 2}</p>", f"T\n{LONG_GREEK * 2}"),
])
def test_evidence_is_weighed(page, expected):
    assert html_text.main_text(page) == expected


def brute_labels(blocks):
    """Both passes from their definitions, looking at every other block for each."""
    marked = any(b.article for b in blocks)

    def first(b):
        n, share = len(b.text), b.linked / len(b.text)
        words = re.findall(r"[^\W\d_]+", b.text.lower())
        dense = sum(w in html_text.STOP_WORDS for w in words) >= 0.08 * max(1, len(words))
        if b.away or (share > 0.4 and not b.article):
            return False
        if share > 0.6 and b.article:
            return False if b.tag in ("li", "ul", "ol", "td") else None
        if b.tag in html_text.HEADINGS:
            return None
        if n < 70:
            return False if b.linked and not b.article else None
        return True if dense else False if marked and not b.article else None

    labels = [first(b) for b in blocks]
    if True not in labels:
        labels = [True if not b.away and b.tag not in html_text.HEADINGS and len(b.text) >= 120
                  and b.linked <= 0.4 * len(b.text) else x for b, x in zip(blocks, labels)]
    result = []
    for i, b in enumerate(blocks):
        same = [j for j, o in enumerate(blocks) if o.article == b.article and labels[j] is not None]
        if labels[i] is not None:
            result.append(labels[i])
            continue

        def gap(j):
            low, high = min(i, j), max(i, j)
            return sum(len(o.text) for k, o in enumerate(blocks)
                       if low < k < high and o.article == b.article)

        before, after = [j for j in same if j < i][-1:], [j for j in same if j > i][:1]
        if b.tag in html_text.HEADINGS and after:
            result.append(labels[after[0]])
        elif before and after and gap(before[0]) == gap(after[0]):
            result.append(labels[before[0]] or labels[after[0]])
        elif before or after:
            result.append(labels[min(before + after, key=gap)])
        else:
            result.append(b.article > 0)
    return result


def test_both_passes_against_brute_force():
    rng = random.Random(11)
    texts = [PROSE, MORE, "Short.", "Label one", LONG_GREEK, "x", "of the", "qwrt zxcv " * 14, "2024"]
    shapes = ["<p>{}</p>", "<h2>{}</h2>", "<p><a href=x>{}</a></p>", "<li><a href=x>{}</a> and",
              "<div class=ad>{}</div>", "<article><p>{}</p></article>", "<div>{}</div>",
              "<article><h1>{}</h1>", "</article><p>{}", "<nav>{}</nav>", "<td>{}</td>"]
    for _ in range(3000):
        page = "".join(rng.choice(shapes).format(rng.choice(texts))
                       for _ in range(rng.randrange(1, 12)))
        blocks = html_text.blocks_of(page)
        labels = brute_labels(blocks)
        assert html_text.main_text(page) == "\n".join(
            b.text for b, label in zip(blocks, labels) if label), page


def test_columns_with_dots(spark):
    frame = spark.createDataFrame([("u", f"<p>{PROSE}")], "`a.b` string, html string")
    got = html_text.extract_text(frame)
    assert got.columns == ["a.b", "text", "n_chars"] and got.first()[0] == "u"
