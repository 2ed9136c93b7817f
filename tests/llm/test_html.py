import html

import pytest

from mediabatch.llm import html_wrapper
from mediabatch.llm.html_tree import Page, align

SCHEMA = "page_id long, url string, html string"


def text_of(source):
    return "\n\n".join(t for _, t in Page(source).content())


def tree_size(a, b):
    """Simple tree matching, by its plain recursion."""
    from mediabatch.llm.html_tree import read_skeleton

    (la, ca), (lb, cb) = read_skeleton(a), read_skeleton(b)

    def match(x, y):
        if la[x] != lb[y]:
            return 0
        m = [[0] * (len(cb[y]) + 1) for _ in range(len(ca[x]) + 1)]
        for i, p in enumerate(ca[x], 1):
            for j, q in enumerate(cb[y], 1):
                m[i][j] = max(m[i - 1][j], m[i][j - 1], m[i - 1][j - 1] + match(p, q))
        return m[-1][-1] + 1

    return match(0, 0)


@pytest.mark.parametrize(
    "source, expected",
    [
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<article><h1>T</h1><p><b>A.<br>b<p>C&nbsp;d &lt;e&gt; &#233;</article><footer>F</footer>", "T\n\nA. b\n\nC d <e> é"),
        ("<script>var a='<p>x</p>';</script><main><p>y</p></main>", "y"),
        ("<nav><ul><li>n</ul></nav><div><p>one two three</p><p>four</p></div><div class='cookie-notice'>c</div>", "one two three\n\nfour"),
        ("<article><p>a</p><!-- <p>no</p> --><form><p>f</p></form><aside>s</aside><p>b</article>", "a\n\nb"),
        ("<article><p>a</p></article><section id=comments><article><p>c</p></article></section>", "a"),
        ("<body><article><p>un<b>closed<i> tags<p>next", "unclosed tags\n\nnext"),
        ("<header>site</header><article><header><h1>T</h1></header><p>x</article>", "T\n\nx"),
        ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table></article>", "a\n\nb\n\nc\n\nd\n\ne"),
        ("<article><p title='a>b'>x</p><p class=\"broken>y</p></article>", "x\n\ny"),
        ("<p>a < b and c</p>", "a < b and c"),
        ("<article><script>never closed <p>x", ""),
    ],
)
def test_blocks_of_a_page(source, expected):
    assert text_of(source) == expected


def test_alignment_is_the_largest_matching():
    pages = [
        "<body><div class=x><p>a</p></div><div><ul><li>q</ul></div><article><h1>t</h1><p>b</article>",
        "<body><div><ul><li>q</ul></div><article><h1>t</h1><p>b<h2>s</h2></article><div class=x><p>a</p></div>",
        "<body><section><article><p>z</article></section><table><tr><td>1</table>",
        "text only",
    ]
    trees = [Page(p).skeleton() for p in pages]
    for a in trees:
        for b in trees:
            found = align(a, b)
            assert len(found) == tree_size(a, b)
            assert len(set(found.values())) == len(found)


def site_page(i, text, host="a.example"):
    teaser = "<p class='box'>Read our other pages today.</p>" if i % 2 else ""
    return (
        f"https://{host}/{i}",
        f"<html><body><div class='top'>Welcome to this site</div><div><p>{html.escape(text)}</p>{teaser}"
        f"<p>Second part of page {i}.</p><p>All rights are kept by us.</p></div></body></html>",
    )


def test_constant_blocks_of_a_host_are_template(spark, rows_of):
    rows = [(i, *site_page(i, f"Text {i} & more of it <here>")) for i in range(12)]
    rows += [(100 + i, *site_page(i, "Same everywhere", "b.example")) for i in range(3)]  # too few pages to tell
    rows += [(200 + i, "https://c.example/", "<article><p>always this</p></article>") for i in range(6)]
    got = {i: t for i, _, t, _ in rows_of(html_wrapper.extract(spark.createDataFrame(rows, SCHEMA).repartition(4)))}
    for i in range(12):
        assert got[i] == f"Text {i} & more of it <here>\n\nSecond part of page {i}."
    assert "Same everywhere" in got[101] and "All rights" in got[101]
    assert got[203] == "always this"  # a page of template only keeps it


def test_nulls_repeats_and_empty_tables(spark, rows_of):
    big = "<article>" + "".join(f"<p>part {i}</p>" for i in range(5_000)) + "</article>"
    rows = [(1, None, "<p>a</p>"), (None, "not a url", None), (2, "https://x/", ""), (2, "https://x/", ""), (3, "https://x/", big)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "html AS text", "url AS host", "url AS skeleton", "url AS tree")
    got = rows_of(html_wrapper.extract(df))
    assert len(got) == 5
    assert (None, "not a url", "", 0) in got and got.count((2, "https://x/", "", 0)) == 2 and (1, None, "a", 1) in got
    whole = next(r for r in got if r[0] == 3)
    assert whole[2] == "\n\n".join(f"part {i}" for i in range(5_000)) and whole[3] == len(whole[2])
    assert html_wrapper.extract(spark.createDataFrame([], SCHEMA)).count() == 0


def test_template_is_found_where_every_page_has_its_own_tree(spark, rows_of):
    tags = ["section", "ul", "table", "dl", "ol"]
    rows, skeletons = [], set()
    for i in range(20):
        name = "".join(chr(97 + int(x)) for x in str(i))
        more = "".join(f"<div><{t}></{t}></div>" for k, t in enumerate(tags) if i >> k & 1)
        source = (
            f"<body><div class='page-{name}'><div>Welcome to this site</div><p class='x{name}'>Text of {i}.</p>"
            f"<p>All rights are kept by us.</p>{more}</div></body>"
        )
        rows.append((i, f"https://own.example/{i}", source))
        skeletons.add(Page(source).skeleton())
    assert len(skeletons) == 20
    got = {i: t for i, _, t, _ in rows_of(html_wrapper.extract(spark.createDataFrame(rows, SCHEMA).repartition(4)))}
    assert got == {i: f"Text of {i}." for i in range(20)}


@pytest.mark.parametrize(
    "source, expected",
    [
        ("<div><p>body one</p><p>body two</p></div><article><p>card</p></article>", "body one\n\nbody two\n\ncard"),
        (f"<div class=a><p>{'lead ' * 40}</p></div><div class=b><p>{'text ' * 200}</p></div>", f"{('lead ' * 40).strip()}\n\n{('text ' * 200).strip()}"),
        ("<div><p>all of it</p><p><a href=x>a source that is linked</a></p></div>", "all of it\n\na source that is linked"),
    ],
)
def test_only_furniture_is_dropped_before_pages_are_compared(source, expected):
    assert text_of(source) == expected


def test_template_of_two_pages_and_of_a_page_type(spark, rows_of, tmp_path):
    from mediabatch.llm.queries import op6_html_text

    rows = [(i, *site_page(2 * i, f"Text {i}", "two.example")) for i in range(2)]
    rows += [(10 + i, "https://copies.example/", "<p>one page</p><p>stored twice</p>") for i in range(2)]
    for i in range(20):  # eight of twenty pages are recipes
        kind = "recipe" if i < 8 else "story"
        notice = "All recipes are tried by us." if i < 8 else f"Told by {i}."
        source = f"<body><div class='{kind}'><div>{notice}</div><p>Text {i}.</p></div></body>"
        rows.append((100 + i, f"https://types.example/{i}", source))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/pages.parquet")
    got = {i: t for i, _, t, _ in rows_of(op6_html_text(spark, str(tmp_path)))}
    assert [got[i] for i in range(2)] == [f"Text {i}\n\nSecond part of page {2 * i}." for i in range(2)]
    assert got[10] == got[11] == "one page\n\nstored twice"
    assert [got[100 + i] for i in range(8)] == [f"Text {i}." for i in range(8)]
    assert got[110] == "Told by 10.\n\nText 10."


def article(head, parts, around="<div class=top>Welcome to this site</div>"):
    return f"<body>{around}<div class=text><h1>{head}</h1>{''.join(f'<p>{p}</p>' for p in parts)}</div></body>"


def test_revisions_of_an_article_keep_what_they_share(spark, rows_of):
    parts = [f"Paragraph {i} of the article that was revised later on." for i in range(6)]
    rows = [(i, f"https://two.example/{i}", article(f"Headline {i}", parts)) for i in range(2)]
    # On a large host the revisions are a small part; its template goes from them as well.
    rows += [(10 + i, f"https://large.example/{i}", article(f"Headline {i}", [f"Own text {i}.", f"More of {i}."])) for i in range(8)]
    rows += [(20 + i, f"https://large.example/r{i}", article(f"Revision {i}", parts)) for i in range(2)]
    got = {i: t for i, _, t, _ in rows_of(html_wrapper.extract(spark.createDataFrame(rows, SCHEMA), least_pages=2))}
    for i in range(2):
        assert all(p in got[i] and p in got[20 + i] for p in parts)
        assert got[20 + i] == "\n\n".join([f"Revision {i}", *parts])
    assert got[13] == "Headline 3\n\nOwn text 3.\n\nMore of 3."


def test_headings_before_varying_text_stay(spark, rows_of):
    def page(i):
        return (
            f"<body><h3>Recent posts</h3><ul><li>Post {i}</ul><div><h1>Title {i}</h1><h2>Introduction</h2><p>First {i}.</p><p>Second {i}.</p>"
            f"<h2>Conclusion</h2><p>Last {i}.</p><h2>Imprint</h2><p>Printed by us.</p></div></body>"
        )

    rows = [(i, f"https://two.example/{i}", page(i)) for i in range(2)]
    got = {i: t for i, _, t, _ in rows_of(html_wrapper.extract(spark.createDataFrame(rows, SCHEMA), least_pages=2))}
    for i in range(2):
        assert got[i] == f"Post {i}\n\nTitle {i}\n\nIntroduction\n\nFirst {i}.\n\nSecond {i}.\n\nConclusion\n\nLast {i}."


@pytest.mark.parametrize("open_tag, close_tag", [("<article>", "</article>"), ("<div class=text>", "</div>"), ("", "")])
def test_names_inside_the_text_that_only_hold_a_furniture_word(open_tag, close_tag):
    inside = (
        "<h1>Title</h1><p>A long paragraph of the article, with many words.</p><div class='section-header'><h2>Part</h2></div>"
        "<div class='related-work'><p>Others wrote on it.</p></div><p class='notice-board-history'>Boards were black.</p>"
        "<p class=byline>By A. Writer</p><p><span aria-hidden='true'>Seen</span> text</p>"
    )
    furniture = (
        "<div class='site-header'>site</div><div class='ad'>buy</div><div class='cookie-notice'>c</div><ul class='comment-list'><li>nice</ul>"
        "<div class='newsletter'>join</div><p hidden>not shown</p>"
    )
    expected = "Title\n\nA long paragraph of the article, with many words.\n\nPart\n\nOthers wrote on it.\n\nBoards were black.\n\nBy A. Writer\n\nSeen text"
    assert text_of(f"<body>{furniture}{open_tag}{inside}{close_tag}</body>") == expected
    assert text_of(f"<body>{open_tag}{inside}{furniture}{close_tag}</body>") == expected


def test_names_that_hold_a_furniture_word_outside_the_text():
    text = "<div class=text><h1>Title</h1><p>A long paragraph of the article, with many words.</p></div>"
    outside = "<div class='story-related-teaser'><p>Read this.</p></div><section class='visitor-comments-zone'><p>nice</p></section>"
    assert text_of(f"<body>{outside}{text}{outside}</body>") == "Title\n\nA long paragraph of the article, with many words."
    # A hint at an element around the article itself says nothing.
    assert text_of(f"<body><div class='widget-layout'><article>{text}</article></div><p>x</p></body>").startswith("Title\n\nA long")


def by_definition(pages, share, least):
    """The module's definition, host by host, over whole pages and slots worked out for every page."""
    from collections import Counter, defaultdict

    from mediabatch.llm.html_tree import slots

    hosts, out = defaultdict(list), {}
    for i, url, source in pages:
        page = Page(source)
        blocks = page.content()
        hosts[url.split("/")[2]].append((i, page.skeleton(), blocks, page.leads(blocks)))
    for own in hosts.values():
        trees = Counter(skeleton for _, skeleton, *_ in own)
        reference = max(trees, key=lambda t: (trees[t], t))
        different = {(skeleton, frozenset(blocks)) for _, skeleton, blocks, _ in own}
        place = {(t, tag): slots(t, reference, tag) for t in trees for tag in (False, True)}
        on, has = Counter(), Counter()
        for skeleton, blocks in different:
            for tag in (False, True):
                at = place[skeleton, tag]
                on.update({(tag, at[n], t): sum(1 for m, u in blocks if at[m] == at[n] and u == t) for n, t in blocks})
                has.update({(tag, s): sum(1 for m in {m for m, _ in blocks} if at[m] == s) for s in {at[n] for n, _ in blocks}})

        def constant(skeleton, n, t):
            slot = [(tag, place[skeleton, tag][n]) for tag in (False, True)]
            return any(on[s, x, t] >= max(least, share * has[s, x]) for s, x in slot)

        holders = defaultdict(list)
        for skeleton, blocks in different:
            same = {b for b in blocks if constant(skeleton, *b)}
            rest = blocks - same
            a, b = (sum(len(t) for _, t in x) for x in (rest, same))
            for t in {t for _, t in same}:
                holders[t].append((len(rest) >= len(same) or a >= b, 4 * len(rest) >= len(same) or 4 * a >= b))
        template = {
            t for t, h in holders.items() if sum(c for c, _ in h) >= 2 or len(h) >= 4 and sum(likely for _, likely in h) >= 2
        }
        for i, skeleton, blocks, leads in own:
            gone = [t in template and constant(skeleton, n, t) for n, t in blocks]
            kept = [t for (_, t), g, x in zip(blocks, gone, leads, strict=True) if not g or x >= 0 and not gone[x]]
            out[i] = "\n\n".join(kept if not all(gone) else [t for _, t in blocks])
    return out


def test_extraction_equals_its_definition_on_small_hosts(spark, rows_of):
    import random

    rng, rows = random.Random(5), []
    for site in range(12):
        template = [f"Template {k} of site {site}" for k in range(4)]
        shared = [f"Shared paragraph {k} of site {site}." for k in range(5)]
        for i in range(rng.randint(1, 7)):
            top = "".join(f"<div class='t{'ab'[k % 2]}'>{template[k]}</div>" for k in range(4) if rng.random() < 0.7)
            body = [rng.choice(shared) if rng.random() < 0.4 else f"Own {rng.randint(0, 999)} {i}." for _ in range(rng.randint(0, 6))]
            body = "".join(f"<h2>{rng.choice(['Notes', 'Part'])}</h2><p>{b}</p>" if rng.random() < 0.3 else f"<p>{b}</p>" for b in body)
            tag = rng.choice(["div", "div", "section"])
            rows.append((len(rows), f"https://s{site}.example/{i}", f"<body>{top}<{tag}><h1>Head {i}</h1>{body}</{tag}></body>"))
    rows += [(len(rows) + i, u, h) for i, (_, u, h) in enumerate(rows[:5])]
    for least in (2, 4):
        got = {i: t for i, _, t, _ in rows_of(html_wrapper.extract(spark.createDataFrame(rows, SCHEMA).repartition(3), least_pages=least))}
        assert got == by_definition(rows, 0.5, least)


def test_articles_of_the_pages_table_come_out_whole(spark, rows_of):
    """Recall and precision by words against the text of each page's `article`, read by the standard library's parser."""
    from collections import Counter
    from html.parser import HTMLParser

    from mediabatch.llm.queries import op6_html_text

    class Article(HTMLParser):
        def __init__(self):
            super().__init__()
            self.depth, self.text = 0, []

        def handle_starttag(self, tag, attrs):
            self.depth += tag == "article"
            self.text.append(" ")

        def handle_endtag(self, tag):
            self.depth -= tag == "article"
            self.text.append(" ")

        def handle_data(self, data):
            if self.depth > 0:
                self.text.append(data)

    sf_dir = "/root/testdata/sf0.01"
    got = {i: t for i, _, t, _ in rows_of(op6_html_text(spark, sf_dir))}
    right = wanted = given = 0
    for row in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html").collect():
        reader = Article()
        reader.feed(row.html or "")
        a, b = Counter("".join(reader.text).split()), Counter(got[row.page_id].split())
        right, wanted, given = right + sum((a & b).values()), wanted + sum(a.values()), given + sum(b.values())
    print(right / wanted, right / given)
    assert right >= 0.99 * wanted and right >= 0.99 * given
