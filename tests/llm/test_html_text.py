"""Main text of made pages, and boilerplate by repetition against a plain count."""

import pytest

from riskframe.llm import html_text

PAGES = [
    ("<html><body><nav><a>Menu</a></nav><article><h1>T &amp; t</h1><p>One\n two<br>three<p>four</article><footer>f</footer>", "T & t\n\nOne two three\n\nfour"),
    ('<head><title>x</title><script>var t="</p><article>";</script><style>p{}</style></head><main><p>a &lt;b&gt; &#233;&nbsp;c</p></main>', "a <b> é c"),
    ("<article><p><b>never closed<p>next <i>one</i></p><div class='comments'><p>reader</p></div>tail</article>after", "never closed\n\nnext one\n\ntail"),
    ("<article><aside>side</aside><form><input>f</form><p>keep</p><!-- <p>no</p> --><div id=cookie-notice>c</div></article>", "keep"),
    ("<div class=\"ad\">buy</div><article><p>no end tags", "no end tags"),
    ("<article><p>cut off in a tag</p><p class=\"x", "cut off in a tag"),
    ("<nav>only<article>chrome</article></nav>", ""),
    ("<article><p>1 < 2 and 3 > 2</p></article>", "1 < 2 and 3 > 2"),
    ("<ARTICLE><P>Upper</P><UL><LI>a<LI>b</UL><table><tr><td>c</td><td>d</td></tr></table></ARTICLE>", "Upper\n\na\n\nb\n\nc\n\nd"),
    ("plain text only", "plain text only"),
    ("", ""),
    (None, ""),
]


@pytest.mark.parametrize("page,want", PAGES)
def test_blocks(page, want):
    assert "\n\n".join(html_text.blocks(page)[0]) == want


def test_long_page():
    page = "<article>" + "<p>" * 20_000 + "x" * 1_000_000 + "</p>" * 3 + "<div>" * 5_000 + "end</article>"
    assert [len(b) for b in html_text.blocks(page)[0]] == [1_000_000, 3]


def by_count(rows, run):
    """Words that lie in a run of ``run`` words which is on another page of the host too."""
    seen = {}
    for host, page, words in rows:
        for i in range(len(words) - run + 1):
            seen.setdefault((host, tuple(words[i : i + run])), set()).add(page)
    out = []
    for host, page, words in rows:
        gone = set()
        for i in range(len(words) - run + 1):
            if len(seen[host, tuple(words[i : i + run])]) > 1:
                gone.update(range(i, i + run))
        out.append(" ".join(w for i, w in enumerate(words) if i not in gone))
    return out


def test_repetition_decides_where_structure_is_silent(spark):
    menu, notice = "home news sport weather money people places about", "we use cookies to make this site better for you all"
    bodies = [f"s{k} has its own words w{k} x{k} y{k} z{k} e{k}" for k in range(4)]
    rows = [(k, f"http://a.org/{k}", f"<div>{menu}</div><div>{b}</div><div>{notice}</div>") for k, b in enumerate(bodies)]
    rows += [(10, "http://b.org/", f"<div>{menu}</div><div>alone on its host</div>"), (11, None, bodies[0]), (12, "http://c.org/1", bodies[1]), (12, "http://c.org/1", bodies[1])]
    rows += [(13, "http://a.org/art", f"<article><p>{menu}</p></article>"), (None, "http://a.org/n", None)]
    table = spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, host string, text int")
    got = html_text.main_text(table.repartition(3)).collect()
    plain = [("a.org" if "a.org" in (u or "") else str(u), k, " ".join(html_text.blocks(h)[0]).split()) for k, u, h in rows]
    silent = [p for p, r in zip(plain, rows) if "<article" not in (r[2] or "")]
    want = dict(zip([str(p[1]) for p in silent], by_count(silent, 8))) | {"13": menu}
    assert sorted((str(r.page_id), " ".join(r.text.split()), r.n_chars) for r in got) == sorted(
        (str(r[0]), want[str(r[0])], len(g)) for r, g in ((r, next(x.text for x in got if x.page_id == r[0])) for r in rows)
    )
    assert {r.text for r in got if r.page_id in (0, 1, 2, 3)} == set(bodies)
    assert html_text.main_text(table.limit(0)).count() == 0


def test_pages(spark):
    rows = html_text.main_text(spark.read.parquet("/root/testdata/sf0.001/pages.parquet")).collect()
    assert len(rows) == 50 and all(r.from_structure and r.n_chars == len(r.text) > 0 for r in rows)
    assert not any("©" in r.text or "<" in r.text for r in rows)


ARTICLE_PARTS_KEPT = [
    '<section id="related-work">{}</section>', '<h1 class="article-header">{}</h1>', '<section id="side-effects">{}</section>',
    '<p class="social-policy">{}</p>', '<table class="menu"><tr><td>{}</td></tr></table>', '<div class="post content">{}</div>',
    '<p class="comment-period-2024">{}</p>', '<section id="noticeable">{}</section>', '<div class="banner-history">{}</div>',
    '<p class="header">{}</p>', '<section id="share-prices">{}</section>', '<div class="cookies-recipe">{}</div>',
]
ARTICLE_PARTS_DROPPED = [
    *(f'<div class="box {c}">' for c in ("ad", "Advert", "sponsored", "comments", "share")),
    '<section id="comments">', '<div class="comment">', '<div class="reader-comments">', '<ol class="comment-list">', '<div id="disqus_thread">',
    '<div class="newsletter">', '<div id="newsletter-signup">', '<p class="notice">', '<div id="cookie">', '<div class="cookie-notice">', '<ul class="related">',
    '<div class="related-posts">', '<div id="share-buttons">', '<div class="ad-container">', '<div class="x sidebar">', '<div role="search">', '<div hidden>',
]


@pytest.mark.parametrize("element", ["article", "main"])
def test_parts_of_an_article(element):
    kept = [k.format(f"text {n}") for n, k in enumerate(ARTICLE_PARTS_KEPT)]
    mixed = "".join(k + d + f"<b>gone</b></{d[1:].split(' ')[0]}>" for k, d in zip(kept * 2, ARTICLE_PARTS_DROPPED))
    rest = "".join(kept)
    page = f"<{element}>{rest}{mixed}</{element}>"
    got = html_text.blocks(page)[0]
    assert "gone" not in " ".join(got) and got[: len(kept)] == [f"text {n}" for n in range(len(kept))]
    for d in ARTICLE_PARTS_DROPPED:
        assert html_text.blocks(f"<{element}>{d}gone</{d[1:].split(' ')[0]}><p>kept</p></{element}>")[0] == ["kept"], d
    assert html_text.blocks('<div id="side-effects">gone</div><div>kept</div>')[0] == ["kept"]


def test_repetition_decides_inside_articles(spark):
    notice, passage = "all rights belong to the makers of this page here", "a line that two articles of this host both quote"
    own = [" ".join(f"w{k}x{j}" for j in range(30)) for k in range(5)]
    page = "<main><p>{}</p><p>{}</p></main>"
    rows = [(k, f"http://a.org/{k}", page.format(b, notice)) for k, b in enumerate(own[:4])]
    rows += [(4, "http://a.org/4", page.format(own[4], passage)), (5, "http://a.org/5", page.format(own[0] + " more", passage))]
    want = dict(enumerate(own[:4])) | {4: f"{own[4]}\n\n{passage}", 5: f"{own[0]} more\n\n{passage}"}
    # copies of one article are no evidence, near copies stay whole, two articles are too few
    rows += [(10 + k, f"http://b.org/{k}", page.format(own[0], notice)) for k in range(5)]
    rows += [(20 + k, f"http://c.org/{k}", page.format(own[1] + f" n{k}", "end")) for k in range(4)]
    rows += [(30 + k, f"http://d.org/{k}", page.format(own[k], notice)) for k in range(2)]
    want |= {r[0]: r[2][9:-11].replace("</p><p>", "\n\n") for r in rows if r[0] >= 10}
    rows += [rows[0], (None, None, None)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = html_text.main_text(table.repartition(3)).collect()
    assert len(got) == len(rows) and {r.page_id: r.text for r in got} == want | {None: ""}
