import html as entities
import re

from creditmart.llm import html_extraction as extraction

SF = "/root/testdata/sf0.01"


def text(page, noisy=()):
    return extraction.main_text(page, frozenset(noisy))


def test_blocks_and_references():
    page = """<html><head><title>t</title><style>p{}</style></head><body><nav>menu</nav><header>top</header>
    <article class="post"><h1>A &amp; B</h1><p>One  <b>bo</b>ld<i>er</i>
    word&nbsp;x.<br>Next<p>Un<a href="x>y">link</a>ed &lt;tag&gt; &#233;<ul><li>i1<li>i2</ul><!-- no <p>comment</p> -->
    <div class="comment-list"><p>reader says</p></div><form>f<input></form><script>var t="</p>";</script>
    <aside>side</aside><div class="ad">buy</div><p hidden>h</p><p style="display: none">d</p>last</article>
    <footer>foot</footer><div>after</div></body>"""
    assert text(page) == "A & B One bolder word x. Next Unlinked <tag> é i1 i2 last"


def test_odd_pages():
    for page in ("", "   ", "<p", "<!--", "<script>x", "</p></div>", "<nav>only</nav>", '<a href="'):
        assert text(page) == ""
    assert text("plain") == "plain"
    assert text("a < b") == "a < b"
    assert text("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    assert text("<p>x</p>" * 20000) == " ".join(["x"] * 20000)


def test_articles_of_the_test_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    found = {r.page_id: r for r in extraction.extracted(pages).collect()}
    for page in pages.collect():
        article = re.search(r"<article>(.*?)</article>", page.html, re.S).group(1)
        plain = re.sub(r"<[^>]*>", " ", re.sub(r"</?[ab]\b[^>]*>", "", article))
        wanted = " ".join(entities.unescape(plain).split())
        assert (found[page.page_id].text, found[page.page_id].n_chars) == (wanted, len(wanted))


def site(n):
    for i in range(n):
        yield f"<body><div class='x'>Same words on top {i % 2}</div><div class='y'><p>Story {i} of its own.</p></div></body>"


def test_the_tree_finds_noise_without_names(spark):
    rows = [(i, "http://H.example/a", h, "c") for i, h in enumerate(site(60))] + [(99, "http://h.example:80/b", next(site(1)), "c")]
    rows += [(100 + i, f"http://h{i}.example/", h, "c") for i, h in enumerate(site(3))]
    rows += [(200, None, "<p>no host</p>", "c"), (201, "http://h.example/", None, "c"), (202, "http://h.example/", "", "c")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = {r.page_id: r.text for r in extraction.extracted(df).collect()}
    assert all(found[i] == f"Story {i} of its own." for i in range(60)) and found[99] == "Story 0 of its own."
    # hosts with one page have nothing to compare with
    assert found[101] == "Same words on top 1 Story 1 of its own."
    assert (found[200], found[201], found[202]) == ("no host", "", "")
    tree = {r.node: r for r in extraction.style_tree(df).where("host = 'h.example'").collect()}
    assert max(r.m for r in tree.values()) == 60  # equal pages count once


def test_empty_table(spark):
    assert extraction.extracted(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_importances_against_their_definition(spark):
    """Entropies computed page by page, from the texts and children of every node."""
    import math
    from collections import defaultdict

    pages = [
        f"<body><div><p>Top {i % 3}</p></div><section><p>Story {i}.</p>{'<ul><li>one</ul>' * (i % 2)}<p>Same end</p></section></body>"
        for i in range(24)
    ]
    seen_texts, shapes, may = defaultdict(lambda: defaultdict(set)), defaultdict(list), {}
    for number, page in enumerate(pages):
        found, nodes = extraction.blocks(page)
        for path, (shape, kept, _) in nodes.items():
            shapes[path].append(shape)
            may[path] = may.get(path, True) and kept
        for path, _, _, words in found:
            seen_texts[path][words].add(number)
    df = spark.createDataFrame([(i, "http://h.example/", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    tree = {r.node % (1 << 64): r for r in extraction.style_tree(df).collect()}
    assert set(tree) == set(shapes)
    for path, of_pages in shapes.items():
        m = len(of_pages)
        base = math.log(max(m, 2))
        texts = [math.log(len(on)) for on in seen_texts[path].values()]
        content = 1 - (sum(texts) / len(texts) if texts else 0.0) / base
        shares = [of_pages.count(s) / m for s in set(of_pages)]
        presentation = -sum(p * math.log(p) for p in shares) / base if m > 1 else 1.0
        own = extraction.CONTENT_SHARE * content + (1 - extraction.CONTENT_SHARE) * presentation
        wanted = (m * own + extraction.PRIOR_PAGES * may[path]) / (m + extraction.PRIOR_PAGES)
        assert tree[path].m == m and math.isclose(tree[path].importance, wanted, abs_tol=1e-9)
    assert min(r.importance for r in tree.values()) < 0.5 < max(r.importance for r in tree.values())


def bare(page):
    """A page whose menu, advert, article and footer are boxes that say nothing of themselves."""
    page = re.sub(r"</?(nav|article|footer)>", lambda tag: tag.group().replace(tag.group(1), "div"), page)
    return re.sub(r' class="[^"]*"', "", page)


def test_the_tree_alone_leaves_the_articles(spark):
    """On hosts of 150 pages and more exactly the article stays; on smaller ones it stays whole."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url", "html")
    wanted = {r.page_id: r.text for r in extraction.extracted(pages).collect()}
    rows = [(r.page_id, r.url, bare(r.html)) for r in pages.collect()]
    plain = spark.createDataFrame(rows, pages.schema)
    found = {r.page_id: r.text for r in extraction.extracted(plain).collect()}
    of_host = {}
    for page_id, url, _ in rows:
        of_host.setdefault(url.split("/")[2].lower(), []).append(page_id)
    large = [page for of_it in of_host.values() if len(of_it) >= 150 for page in of_it]
    assert len(large) > 300
    assert all(found[page] == wanted[page] for page in large)
    assert all(wanted[page] in found[page] for page in found)
    untouched = {r.page_id: r.text for r in extraction.extracted(plain, -1, -1).collect()}
    assert all(untouched[page] != wanted[page] for page in large)


def test_the_place_of_a_box_tells_it_apart(spark):
    rows = [
        (i, "http://h.example/", f"<div><p>Menu {i % 2}</p></div><div><h1>Title {i}</h1><p>Story {i}.</p><p>Its end {i}.</p></div><div>Foot</div>")
        for i in range(40)
    ]
    few = [(100 + i, "http://few.example/", f"<div>Top</div><div>Story {i} on a host of three pages.</div>") for i in range(3)]
    df = spark.createDataFrame(rows + few, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in extraction.extracted(df).collect()}
    assert all(found[i] == f"Title {i} Story {i}. Its end {i}." for i in range(40))
    assert found[101] == "Top Story 1 on a host of three pages."
