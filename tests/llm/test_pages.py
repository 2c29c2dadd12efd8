from pyspark.sql import functions as F

from barlake.llm import pages

SCHEMA = "page_id long, url string, html string, text string, host int, removed string"


def frame(spark, data):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in data], SCHEMA).repartition(3)


def text(html):
    return "\n".join(t for t, _ in pages.parse(html)[0])


def test_article_without_the_rest():
    html = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var x="</p><article>";</script></head><body class="has-sidebar">
    <header>Site</header><nav><ul><li>Home</li></ul></nav><div class="cookie-notice">We use cookies</div><aside>side</aside>
    <article><header><h1>Big &amp; small</h1></header><p>One <b>two<br>three</p><p>four&nbsp;\n five &lt;x&gt; &#8364; &copy</p>
    <div class="ad">buy</div><ul><li>item 1<li>item 2</ul><form>f <input> g</form><!-- note <p>no</p> --><table><tr><td>c1<td>c2</table>
    <section id="comments"><article class="comment">reader</article></section></article>
    <section class="reader-comments"><p>no</p></section><footer>&copy; me</footer></body></html>"""
    assert text(html) == "Big & small\nOne two three\nfour five <x> € ©\nitem 1\nitem 2\nc1\nc2"


def test_broken_html():
    assert text("") == "" and text("plain & <b>bold") == "plain & bold"
    assert text("<article><p>a<p>b</article") == "a\nb"
    assert text("<article><p>a</p></div></p>b<!-- never closed <p>c") == "a\nb"
    assert text("<p>a < b and <3 c") == "a < b and <3 c"
    assert text('<div class="ad">x<article><p title="a>b">main</p></article>') == "main"  # an advert that is not closed
    assert text("<article><script>if (a<b) {}") == ""
    assert text("<ARTICLE><P>up</P></ARTICLE>") == "up"
    assert text("<p>" + "w " * 50_000) == ("w " * 50_000).strip()
    assert text("<article><p>x</p></article><article class=comment><p>y</p></article>") == "x"


def site(n, host="www.site.example"):
    """Pages without a marked article: one box says the same everywhere, one is the text."""
    return [(i, f"https://{host}/{i}", f"<body><div class='x1'><p>Always the same</p><ul><li>a</li></ul></div>"
                f"<div class='x2'><p>Story {i} begins</p><p>and ends {i}</p></div></body>") for i in range(n)]


def texts(spark, data):
    return sorted(map(tuple, pages.main_texts(frame(spark, data)).select("page_id", "text", "n_chars").collect()), key=str)


def test_style_tree_removes_what_a_site_repeats(spark):
    assert texts(spark, site(12)) == sorted(((i, t := f"Story {i} begins\nand ends {i}", len(t)) for i in range(12)), key=str)
    few = texts(spark, site(3, "few.example"))
    assert all(t.startswith("Always the same\na\nStory") for _, t, _ in few)  # three pages are no evidence


def test_copies_are_one_page_and_hosts_are_apart(spark):
    page = "<body><div class='x2'><p>One story</p></div></body>"
    data = [(i, "https://one.example/a", page) for i in range(30)] + [(100 + i, f"https://h{i}.example/", page) for i in range(12)]
    assert {t for _, t, _ in texts(spark, data)} == {"One story"}
    article = "<body><article><p>Same</p></article></body>"
    marked = [(i, f"https://two.example/{i}", article + f"<!--{i}--><div class='z'>{i}</div>") for i in range(20)]
    assert {t for _, t, _ in texts(spark, marked)} == {"Same"}


def test_importance_is_between_nothing_and_one(spark):
    got = {r.pages: r.importance for r in pages.node_importance(pages.page_shapes(frame(spark, site(12)))).collect()}
    values = sorted(r.importance for r in pages.node_importance(pages.page_shapes(frame(spark, site(12)))).collect())
    assert set(got) == {12} and values[0] < 0.05 and 0.8 < values[-1] <= 1


def test_awkward_rows(spark):
    data = [(None, None, None), (1, None, "<p>x</p>"), (1, None, "<p>x</p>"), (2, "no url", ""), (3, "//h.example:80/x", None),
            (4, "http://u@H.example/x", "<article></article>")]
    got = pages.main_texts(frame(spark, data))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert texts(spark, data) == sorted([(None, "", 0), (1, "x", 1), (1, "x", 1), (2, "", 0), (3, "", 0), (4, "", 0)], key=str)
    assert pages.main_texts(frame(spark, [])).count() == 0
    hosts = frame(spark, [(0, u, "") for u in ("http://u@H.example:80/x", "x", None, "//a.b?c")]).select(pages.host_of(F.col("url")))
    assert sorted(map(str, (r[0] for r in hosts.collect()))) == ["None", "None", "a.b", "h.example"]


def test_unnamed_menus_and_leaves_go_by_importance(spark):
    """No known name and no container: what repeats over the host's pages goes, also as a leaf among the text's paragraphs."""
    data = [(i, f"https://plain.example/{i}", f"<body><p>Home | Shop | About</p><h1>Title {i}</h1><p>Story {i} is told here</p>"
             f"<div class='q7'><a>One</a> <a>Two</a></div><p>All rights belong to us</p>loose</body>") for i in range(12)]
    assert [t for _, t, _ in texts(spark, data)] == [t for _, t, _ in sorted(
        ((i, f"Title {i}\nStory {i} is told here", 0) for i in range(12)), key=str)]


def test_named_elements_are_in_the_tree(spark):
    """Pages that mark their article tell what a page of the host without one repeats; menus and adverts are nodes."""
    page = "<nav><ul><li>Home</li></ul></nav><div class='ad'>buy {0}</div><div class='q7'>Our shops</div>"
    data = [(i, f"https://m.example/{i}", (page + "<article><p>Text {0}</p></article>").format(i)) for i in range(12)]
    assert pages.page_shapes(frame(spark, data)).count() == 12
    assert {pages._hash(p) for p in ("/nav", "/nav/ul/li", "/div.ad", "/div.q7")} <= {
        r.path for r in pages.node_importance(pages.page_shapes(frame(spark, data))).collect()}
    got = {i: t for i, t, _ in texts(spark, [*data, (99, "https://m.example/", (page + "<p>Welcome {0}</p>").format(99))])}
    assert got[99] == "Welcome 99" and got[3] == "Text 3"


def test_names_count_whole_and_on_containers_only():
    assert text("<article><h2 id='related-work'>Related</h2><p class='social-science'>a</p><section id='search'><p>b</p></section>"
                "<div class='elementor-widget-container'>c</div><p class='notice'>d</p><span class='share'>e</span>"
                "<div class='social-share'>gone</div></article>") == "Related\na\nb\nc\nd\ne"
    for wrapper in ("content-sidebar-wrap", "has-sidebar", "sidebar"):
        assert text(f"<body><nav>{'link ' * 50}</nav><div class='{wrapper}'><p>The story is here</p><div class='ad'>x</div></div></body>") \
            == "The story is here"
    assert text("<body><p>The story is here, long enough</p><div class='sidebar'>x</div><div id='site-menu'>y</div></body>") \
        == "The story is here, long enough"


def test_near_copies_keep_their_text(spark):
    """A host of near copies: nine of ten paragraphs alike, in a wrapper, with and without a marked article."""
    same = "".join(f"<p>Paragraph {k} says the same on all of them</p>" for k in range(9))
    for n, (start, end) in enumerate((("<article>", "</article>"), ("<article><div class='b'>", "</div></article>"), ("", ""))):
        data = [(i, f"https://copies{n}.example/{i}", f"<body><div id='page'>{start}{same}<p>Only {i}</p>{end}</div></body>") for i in range(30)]
        assert all(t.count("\n") == 9 and t.endswith(f"Only {i}") for i, t, _ in texts(spark, data))


def test_skipped_elements_end_where_they_end():
    assert text("<article><p>a</p><svg/><p>b</p><math/><p>c</p></article>") == "a\nb\nc"
    assert text("<article><p>a <svg width='1' /> b <svg><text>no</text></svg> c</p></article>") == "a b c"
    assert text("<article><p>so <math><mi>x</mi><mo>=</mo><mn>1</mn></math></p><xmp>if a < b & <i>c</article></xmp><p>d</p></article>") \
        == "so x=1\nif a < b & <i>c</article>\nd"
    assert text("<article><p>a</p><iframe src=x><p>b</p></article>") == "a\nb" and text("<article><p>a</p><script>b") == "a"


def test_comments_buttons_and_labels_are_no_text():
    assert text("<article><p>Read <button>Share this</button><label>a</label> more</p><section id='comments'><p>c</p></section>"
                "<div class='user-reviews'>r</div><div id='disqus'>q</div><p>so <span hidden>no</span>it <i style='display: none'>x</i>is"
                " <i aria-hidden='true'>*</i></p></article>") == "Read more\nso it is *"
    assert text("<article class='review'><div class='review'><p>A book</p></div><section id='notice'>n</section></article>") == "A book\nn"
    assert text("<button>x<article><p>never closed</p></article>") == "never closed"


def test_head_ends_where_the_text_begins():
    for start in ("<html><head><title>T</title><body>", "<head><meta charset=utf-8><link rel=x>", "<html><head><title>T</title></head>"):
        assert text(f"{start}<p>x</p>") == "x" and text(f"{start}plain") == "plain"


def test_a_page_of_nothing_but_the_menu_is_empty(spark):
    menu = "<div class='m1'><p>Home</p><p>About us</p></div>"
    data = [(i, f"https://menu.example/{i}", f"<body>{menu}<p>Story {i}</p></body>") for i in range(29)]
    got = {i: t for i, t, _ in texts(spark, [*data, (99, "https://menu.example/99", f"<body>{menu}</body>")])}
    assert got == {**{i: f"Story {i}" for i in range(29)}, 99: ""}


def test_near_copies_are_no_evidence_beside_other_pages(spark):
    """Near copies on a host with a menu: the menu goes from all of them, what only they share stays."""
    menu = "<div class='m1'><p>Home is here</p></div>"
    same = "".join(f"<p>Paragraph {k} says the same on each</p>" for k in range(9))
    data = [(i, f"https://mixed.example/{i}", f"<body>{menu}<div class='c'><p>Story {i} is told at length here</p><p>{i}</p></div></body>")
            for i in range(40)]
    copies = [(100 + i, f"https://mixed.example/{i}", f"<body>{menu}<section class='c'>{same}<p>Only {i}</p></section></body>") for i in range(10)]
    got = {i: t for i, t, _ in texts(spark, data + copies)}
    assert got[3] == "Story 3 is told at length here\n3"
    assert all(got[100 + i].count("\n") == 9 and "Home" not in got[100 + i] for i in range(10))


def test_deep_and_unclosed_elements_cost_what_their_length_does():
    import time
    import tracemalloc
    for html in ("<div>x" * 20_000, "<div class=ad>y" * 20_000 + "<p>hello</p>", "<select>" * 20_000, "<b>" * 20_000 + "</i>" * 20_000,
                 "<p>a" * 20_000):
        began = time.process_time()
        pages.parse(html)
        took = time.process_time() - began
        tracemalloc.start()
        pages.parse(html)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert took < 4 and peak < 100e6, (html[:20], took, peak)
    deep = text("<div>" * 1000 + "<p>deep</p><nav>n</nav>" + "</div>" * 1000 + "<p>after</p>")
    assert deep == "deep\nafter"


def brute_importance(data):
    """Importance of every (host, path) and leaf from the pages' elements, by counting."""
    import math
    from collections import Counter, defaultdict
    seen, looks, said, leaves = set(), defaultdict(Counter), defaultdict(Counter), Counter()
    for _, url, html in data:
        host = url.split("/")[2]
        _, kids, found = pages.parse(html)
        mark = (host, tuple(f[:3] for f in found), tuple(kids))
        if mark in seen or not any(paths or leaf for _, paths, leaf, _ in found):
            continue
        seen.add(mark)
        for path, k in kids.items():
            looks[host, path][" ".join(k)] += 1
        once = {(t, paths, leaf) for t, paths, leaf, _ in found if paths or leaf}
        for t, paths, leaf in once:
            for p in paths:
                said[host, p][t] += 1
        for at, leaf in {(paths[-1] if paths else "", leaf) for _, paths, leaf in once if leaf}:
            leaves[host, at, leaf] += 1
    out = {}
    for (host, path), look in looks.items():
        m, blocks = sum(look.values()), said[host, path]
        if path:
            logm = math.log(max(m, 2))
            looked = -sum(c / m * math.log(c / m) for c in look.values()) / logm
            total = sum(blocks.values())
            told = 1 - min(1, sum(k * math.log(k) for k in blocks.values()) / total / logm) if total else 0
            out[host, pages._hash(path)] = (m, 0.1 * looked + 0.9 * told)
    for (host, at, leaf), k in leaves.items():
        m = sum(looks[host, at].values())
        if k > 8 ** (1 - 0.2 / 0.9):
            out[host, pages._hash(leaf)] = (m, 0.9 * (1 - min(1, math.log(k) / math.log(max(m, 2)))))
    return out


def test_importance_equals_counting(spark):
    import random
    rnd = random.Random(7)
    def part(depth):
        tag = rnd.choice(["div class=a", "div class=b", "ul", "section", "p", "nav", "article"] if depth else ["div class=a", "p"])
        inner = "".join(part(depth - 1) for _ in range(rnd.randrange(3))) if depth and tag != "p" else ""
        return f"<{tag}>{rnd.choice(['Home', 'About', 'Shop', str(rnd.randrange(99))])}{inner}</{tag.split()[0]}>"
    data = [(i, f"https://h{i % 3}.example/{i}", "<body>" + "".join(part(3) for _ in range(3)) + "</body>") for i in range(60)]
    data += data[:9]
    got = {(r.host, r.path): (r.pages, r.importance) for r in pages.node_importance(pages.page_shapes(frame(spark, data))).collect()}
    want = brute_importance(data)
    assert got.keys() == want.keys() and len(want) > 30
    assert all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-9 for k in want)
