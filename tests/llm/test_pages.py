import html
import math
import random
import re
from collections import Counter, defaultdict

from daygrid.llm.pages import extracted, hashes, main_text, parsed, templates
from daygrid.llm.queries import QUERIES


def text_of(page):
    return main_text(parsed(page), set(), {})


def test_blocks_inline_and_references():
    assert text_of("<article><h1>A&amp;B</h1><p>one <b>t</b>wo<br>three&nbsp;&#233;\n\t four<p>fi<i>ve</i></article>") == "A&B one two three é four five"
    assert text_of("<p>x</p>y<div>z</div>") == "x y z"
    assert text_of("<ul><li>a<li>b<ul><li>c</ul><li>d</ul><table><tr><td>e<td>f<tr><th>g</table>") == "a b c d e f g"
    assert text_of("") == text_of("<div") == text_of("<!-- x") == "" and text_of("a < b") == "a < b"
    assert text_of("no markup  at\nall") == "no markup at all"


def test_named_noise():
    noise = [
        "<nav>n</nav>", "<header>n</header>", "<footer>n</footer>", "<aside>n</aside>", "<form>n<p>n</form>", "<script>var t = '</p>n';</script>", "<style>n</style>",
        "<div class='ad'>n</div>", "<div id=comments><p>n</div>", "<section class='post-comments'>n</section>", "<div class='cookie-notice'>n</div>", "<div role=banner>n</div>",
        "<div class='sidebar left'><div>n</div></div>", "<p hidden>n</p>", "<!-- n -->", "<button>n</button>", "<div style='display: none'>n</div>",
    ]
    for piece in noise:
        assert text_of(f"<html><head><title>n</title></head><body>{piece}<article><p>a</p>{piece}<p>b</p></article>{piece}</body></html>") == "a b", piece
        assert text_of(f"<body>{piece}<p>a</p>{piece}<p>b</p>{piece}") == "a b", piece
    assert text_of("<body class='has-sidebar'><div class='header-image-free adventure'>a</div><div class='shareholder menuet'>b</div></body>") == "a b"


def test_long_and_deep_pages():
    assert text_of("<div>" * 20_000 + "x") == "x"
    assert text_of("<p>" + "word " * 200_000) == ("word " * 200_000).strip()


def page(k, host="a.example.com"):
    body = f"<div><p>Read {host} daily</p></div><div><h1>Title {k}</h1><p>Text number {k}</p><p>Shared by two</p></div><div>All rights of {host}</div>"
    return (k, f"http://{host}/{k}", f"<html><body>{body}</body></html>")


def test_templates_by_host(spark):
    rows = [page(k) for k in range(10)] + [page(20 + k, "b.example.com") for k in range(3)]
    rows[7] = (7, rows[7][1], rows[7][2].replace("Shared by two", "Its own"))
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id int, url string, html string, host string, template int")
    found = {r.page_id: r.text for r in extracted(frame).collect()}
    assert found[3] == "Title 3 Text number 3" and found[7] == "Title 7 Text number 7 Its own"
    assert found[21] == "Read b.example.com daily Title 21 Text number 21 Shared by two All rights of b.example.com"  # too few pages to tell


def test_copies_are_one_page(spark):
    story = "<html><body><div>Side %d</div><%s><h1>A story</h1><p>Told under many addresses</p></%s></body></html>"
    rows = [(100 + k, f"http://a.example.com/copy/{k}", story % (k, "article", "article")) for k in range(12)]  # half of the host and more
    rows += [(200 + k, f"http://b.example.com/copy/{k}", story % (0, "div", "div")) for k in range(12)]  # without an article, and with a second group
    rows += [(300 + k, f"http://b.example.com/other/{k}", "<p>Another text</p>") for k in range(12)]
    rows += [page(k) for k in range(10)] + [page(20, "b.example.com")]
    found = {r.page_id: r.text for r in extracted(spark.createDataFrame(rows, "page_id int, url string, html string")).collect()}
    assert {found[100 + k] for k in range(12)} == {"A story Told under many addresses"}
    assert {found[200 + k] for k in range(12)} == {"Side 0 A story Told under many addresses"} and {found[300 + k] for k in range(12)} == {"Another text"}
    assert found[3] == "Title 3 Text number 3"  # the template of the host is still found


def test_section_templates_of_a_large_host(spark):
    rows = []
    for k in range(80):
        section = f"<div class=bar><a>Part {k % 4}</a> <a>News of part {k % 4}</a></div>"
        advert = "<p>Write to our office today and get the best of the daily news by mail</p>" if k % 5 < 2 else ""
        head = "<h2>Introduction</h2>" if k % 5 == 3 else ""
        rows.append((k, f"http://a.example.com/{k}", f"<body>{section}<article><h1>Title {k}</h1>{head}<p>Text number {k}</p>{advert}</article><div><h3>Own {k}</h3></div></body>"))
        rows.append((100 + k, f"http://b.example.com/{k}", f"<body>{section}<div><h1>Title {k}</h1>{head}<p>Text number {k}</p></div>{advert}</body>"))
    story = " ".join(f"<p>This is what paragraph {i} of the long story tells of it</p>" for i in range(6))
    rows += [(200 + k, f"http://b.example.com/story/{k}", f"<body><div>{story}<p>Version {k}</p></div></body>") for k in range(12)]
    found = {r.page_id: r.text for r in extracted(spark.createDataFrame(rows, "page_id int, url string, html string")).collect()}
    for k in range(80):
        assert found[k] == found[100 + k] == f"Title {k} {'Introduction ' if k % 5 == 3 else ''}Text number {k}"
    assert all(found[200 + k].startswith("This is what paragraph 0") and found[200 + k].endswith(f"of it Version {k}") for k in range(12))


def test_edges(spark):
    rows = [(1, None, None), (1, None, None), (2, "no host", "<p>a"), (None, "http://h/", "<p>b"), (3, "http://h/", "")]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    assert sorted(map(tuple, extracted(frame).collect()), key=str) == sorted([(1, None, ""), (1, None, ""), (2, "no host", "a"), (None, "http://h/", "b"), (3, "http://h/", "")], key=str)
    assert extracted(frame.limit(0)).count() == 0


def test_equal_subtrees_have_equal_hashes():
    a, b, c = (set(hashes(parsed(t)).values()) for t in ("<div class=x><p>a  b</p></div>", "<i>z</i><div class='x'><p>a b", "<div class=y><p>a b</p></div>"))
    assert len(a & b) == 2 and len(a & c) == 1


def test_query_against_the_known_frame(spark, sf_dir):
    """The pages of the tables all have their text in one article of plain blocks."""
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    found = QUERIES["op5_html_extraction"](spark, sf_dir).collect()
    assert len(found) == len(pages)
    for r in found:
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id].html, re.DOTALL)[1]
        own = re.sub(r"<[^>]*>", "", re.sub(r"</?(?:p|h1|br)>", " ", article))
        assert r.text == " ".join(html.unescape(own).split()) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_articles_and_what_only_sounds_like_noise():
    body = "<article><h1>T</h1><p>The text itself goes on for some words here.</p></article>"
    assert text_of(f"<main>{body}<article class='comment'>Reader says hi</article></main>") == "T The text itself goes on for some words here."
    assert text_of("<div class='post'>Body text.</div><article class='related teaser'><a>More of it</a></article>") == "Body text."
    assert text_of(f"{body}<article><h2>Teaser</h2></article><article><p>Another one</p></article>") == "T The text itself goes on for some words here."
    legal = "<section id='legal'><h2>Legal background</h2><p>What the court said of it in the year before.</p></section>"
    assert text_of(f"<article><p>One.</p>{legal}<p class='notice'>It was put up on the door, and everybody read the notice.</p></article>") == (
        "One. Legal background What the court said of it in the year before. It was put up on the door, and everybody read the notice."
    )
    share = "<div class='share'><a>Post</a> <a>Send</a></div>"
    assert text_of(f"<article><p>One.</p>{share}<p>Two.</p><div class='legal'>All rights reserved</div></article>{legal}") == "One. Two."
    assert text_of("<body><div id='search'>Find <p>it</p></div><p>a</p></body>") == "a"


def test_headings_of_every_article_stay(spark):
    rows = [
        (k, f"http://a.example.com/{k}", f"<body><div class=x>Welcome to the long list of our daily pages here</div><article><h1>Title {k}</h1><h2>Background</h2><p>Number {k}.</p><p>To be continued.</p></article></body>")
        for k in range(30)
    ]
    found = {r.page_id: r.text for r in extracted(spark.createDataFrame(rows, "page_id int, url string, html string")).collect()}
    assert found == {k: f"Title {k} Background Number {k}. To be continued." for k in range(30)}


def test_host_counts_against_brute_force(spark):
    """Which subtrees are templates, counted page by page without Spark, on hosts of many sizes with unnamed parts."""
    draw = random.Random(2)
    parts = [f"<div>{' '.join(draw.choices('of the daily news from our town and all that'.split(), k=12))} {i}</div>" for i in range(12)]
    rows = []
    for h, n in enumerate([3, 5, 8, 30, 120]):
        for k in range(n):
            own = "".join(p for i, p in enumerate(parts) if draw.random() < (i + 1) / 14)
            rows.append((len(rows), f"http://h{h}.net/{k}", f"<body>{own}<div><p>Page {k} of host {h} has a text of its own that nobody else has</p></div></body>"))
    counted = defaultdict(Counter)
    pages = defaultdict(set)
    for _, url, page_html in rows:
        host = url.split("/")[2]
        if page_html not in pages[host]:
            pages[host].add(page_html)
            counted[host].update(set(hashes(parsed(page_html)).values()))
    want = set()
    for host, counts in counted.items():
        total = len(pages[host])
        for digest, n in counts.items():
            most = 2 * n >= total
            many = n >= max(5, math.sqrt(total), total / 100) and not digest & 1
            if total >= 5 and n > 1 and (most or many):
                want.add((host, digest, most))
    frame = spark.createDataFrame([(u.split("/")[2], h) for _, u, h in rows], "host string, html string")
    assert {tuple(r) for r in templates(frame).collect()} == want and len({w[0] for w in want}) == 4
