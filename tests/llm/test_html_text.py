import random
from itertools import permutations
from time import process_time

from mailspark.llm import html_text
from mailspark.llm.html_text import (
    aligned,
    extract,
    leaves,
    main_text,
    matched,
    merged,
    numbered,
    parse,
    shape_of,
)
from tests.llm.helpers import CLASHES, EDGE, table


def page(body, title="t"):
    return (
        f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style>"
        f"<script>var a='</p>';</script></head><body>{body}</body></html>"
    )


def shape(html):
    return shape_of(parse(html))


def test_article_without_the_rest():
    html = page(
        "<header>Site</header><nav><ul><li>Menu</li></ul></nav><div class='cookie-notice'>Ok?</div>"
        "<article><h1>Head &amp; line</h1><p>One<b> bold</b>\n  text<br>next &lt;x&gt; &#233;"
        "<p>Two<div class=ad>Buy</div><form>Name <input></form><ul><li>a<li>b</ul>"
        "<section class='comments'><article>Nice!</article></section></article>"
        "<aside>Side</aside><div id=sidebar>More</div><footer>&copy; me</footer>"
    )
    expected = ["Head & line", "One bold text next <x> é", "Two", "a", "b"]
    assert main_text(html, set()) == "\n\n".join(expected)


def test_names_that_only_sound_like_regions():
    inside = (
        "<div class='entry-header'><h1>Head</h1></div><p class='byline'>By A</p>"
        "<section class='article-body share-enabled'><p>Text</p><pre>x = 1 "
        "<span class='hljs-comment'># one</span> <span class='token comment'># two</span></pre>"
        "<p>so <math><semantics><mi>a</mi><mo>=</mo><mn>2</mn><annotation>a=2</annotation>"
        "</semantics></math> <a class='share'>here</a></p></section>"
    )
    gone = (
        "<div class='comments'>Nice</div><div class='related-posts'>More</div><div id='ad-1'>Buy"
        "</div><div class='newsletter-signup x'>Join</div><ul class='share-links'><li>Send</ul>"
        "<span hidden>never</span>"
    )
    expected = "Head\n\nBy A\n\nText\n\nx = 1 # one # two\n\nso a=2 here"
    assert main_text(page(f"<article>{inside}{gone}</article>"), set()) == expected
    bare = inside.replace(" <a class='share'>here</a>", "")
    around = "<div class='site-header'>Site</div><div class='top-nav'>Menu</div><a class='skip'>Go</a>"
    assert main_text(page(around + bare + gone), set()) == expected.removesuffix(" here")
    code = "<div class='page has-sidebar'>is <code>1 <i class='comment'>#</i></code> and <i class=ad>Buy</i></div>"
    assert main_text(page(code), set()) == "is 1 # and"


def test_pages_without_an_article():
    assert main_text(page("<div>Text <i>one</i></div><p>two</p><nav>x</nav>"), set()) == "Text one\n\ntwo"
    assert main_text("plain < text & more", set()) == "plain < text & more"
    assert main_text("", set()) == main_text("<p>", set()) == main_text("<!-- x", set()) == ""


def test_deep_and_broken_markup():
    assert main_text("<div>" * 5000 + "deep", set()) == "deep"
    assert main_text("</p></div>a<p>b</div></span>c<li>d", set()) == "a\n\nb\n\nc\n\nd"


def test_text_after_closed_deep_nesting():
    deep = "<div>" * 70 + "in<nav>menu</nav><div class=comments>nice</div>x" + "</div>" * 70
    html = page(f"<div class=wrap><article><p>a</p>{deep}<p>b</p><ul><li>c<li>d</ul></article>out</div>")
    assert main_text(html, set()) == "a\n\nin\n\nx\n\nb\n\nc\n\nd"
    lists = "<ul><li>e" * 200 + "</ul>" * 200
    assert main_text(page(f"<main>{lists}<p>f</p></main>g"), set()) == "\n\n".join("e" * 200 + "f")


def test_simple_tree_matching():
    a = ("x", (("a", ()), ("b", (("c", ()),)), ("d", ())))
    b = ("x", (("b", (("c", ()), ("e", ()))), ("a", ()), ("d", ())))
    assert matched(a, a) == 5 and matched(a, b) == 4 and matched(a, ("y", ())) == 0
    both = merged(a, b)
    assert matched(both, a) == 5 and matched(both, b) == 6
    places = aligned(a, both)
    assert -1 not in places and len(set(places)) == 5


def test_repeated_siblings_have_one_shape():
    assert shape("<ul><li>a<li>b</ul>") == shape("<ul><li>a<li>b<li>c<li>d</ul>")


def all_matches(a, b):
    """Simple tree matching by trying every order-preserving match of children."""
    if a[0] != b[0]:
        return 0

    def best(xs, ys):
        if not xs or not ys:
            return 0
        skip = max(best(xs[1:], ys), best(xs, ys[1:]))
        return max(skip, all_matches(xs[0], ys[0]) + best(xs[1:], ys[1:]))

    return 1 + best(a[1], b[1])


def test_matching_is_the_best_of_all():
    rng = random.Random(5)

    def tree(depth):
        kids = rng.randrange(5) if depth else 0
        return rng.choice("abc"), tuple(tree(depth - 1) for _ in range(kids))

    for _ in range(300):
        a, b = ("x", (tree(2), tree(2), tree(1))), ("x", (tree(2), tree(1), tree(2)))
        assert matched(a, b) == all_matches(a, b) == matched(b, a)


def test_long_pages_take_linear_time():
    rng = random.Random(6)
    kinds = ["<h3>a</h3>", "<p>b</p>", "<ul><li>c</ul>", "<div class=x><p>d<h4>e</h4></div>"]
    for pick in (lambda i: kinds[i % 2], lambda i: rng.choice(kinds)):
        body = "".join(map(pick, range(20_000)))
        began, known = process_time(), {}
        tree = parse(f"<div>{body}</div><div><p>x</p></div>")
        shape = shape_of(tree, known)
        found = list(numbered(tree, shape, known))
        assert len(found) == sum(1 for _ in leaves(tree))
        assert merged(shape, shape_of(parse(body))) and process_time() - began < 10
        assert len({number for _, number in found}) < 12


def site(n, rng):
    """Pages of one host: what is constant is template, whatever its element."""
    rows = []
    for i in range(n):
        words = " ".join(rng.choice("abcdefgh") * 3 for _ in range(20))
        lead = "<div>Breaking: subscribe today</div>" if i % 10 else ""
        body = f"{lead}<div class=main><p>Page {i} {words}</p><p>{words[::-1]}</p></div><div>All rights kept</div>"
        rows.append((i, f"http://host.example/{i}", page(body)))
    return rows


def test_constant_nodes_are_template(spark):
    rows = site(40, random.Random(1))
    docs = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in extract(docs.repartition(3)).collect()}
    for i in range(40):
        blocks = found[i].split("\n\n")
        assert len(blocks) == 2 and blocks[0].startswith(f"Page {i} ")


def test_few_pages_or_no_host_have_no_template(spark):
    rows = [(i, "http://small.example/", page("<p>same</p>")) for i in range(3)]
    rows += [(i, u, page("<p>same</p>")) for i in range(10, 30) for u in (None, "http://[")]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.text for r in extract(docs).collect()} == {"same"}


LONG = "It was said that much of this goes on for a good while. " * 6


def test_regions_inside_an_article():
    names = "user-comments reader-comment cookie-policy-notice sponsored-content".split()
    gone = "".join(f"<div class='{n}'>no</div>" for n in names) + " and <span class=advert>Buy</span>"
    assert main_text(page(f"<article><p>Text</p>{gone}</article>"), set()) == "Text\n\nand"


def test_sections_with_the_word_of_a_region_are_judged_by_their_text():
    for name in ("div class=social-sciences", "section class=related-work", "div id=search-results-story"):
        tag = name.split()[0]
        links = "".join(f"<a href=/{i}>{LONG}</a>" for i in range(3))
        for inner, stays in ((f"<p>{LONG}</p>", True), ("<p>Short</p>", False), (links, False)):
            html = page(f"<p>{LONG}</p><{name}>{inner}</{tag}>")
            assert main_text(html, set()).count("\n\n") == stays
    for name in ("comments", "post-comments", "sidebar-left", "site-footer"):
        assert main_text(page(f"<p>One</p><div class={name}><p>{LONG}</p></div>"), set()) == "One"


def test_a_teaser_is_not_the_article():
    teaser = "<article><h3>Read too</h3></article>"
    html = page(f"{teaser}<div class=post><p>{LONG}</p><p>{LONG}</p></div>")
    assert main_text(html, set()) == f"{LONG.strip()}\n\n{LONG.strip()}"
    assert main_text(page(f"<article><p>{LONG}</p></article><div>{LONG}</div>"), set()) == LONG.strip()


def test_the_wrapper_tells_regions_without_names(spark):
    """Menus, adverts and footers that vary, whose elements and classes say nothing."""
    rng = random.Random(7)

    def words(n):
        return " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(n))

    rows, expected = [], {}
    for i in range(24):
        blocks = [words(rng.randrange(30, 60)) for _ in range(rng.randrange(2, 9))]
        menu = "".join(f"<li><a href=/{k}>{words(1)}</a></li>" for k in range(rng.randrange(3, 7)))
        named = ("nav", "advert", "post", "footer") if i < 12 else ("qa", "qb", "qc", "qd")
        host = "named" if i < 12 else "renamed"
        parts = [f"<ul>{menu}</ul>", words(4), "".join(f"<p>{b}</p>" for b in blocks), words(3)]
        body = "".join(f"<div class={n}>{x}</div>" for n, x in zip(named, parts))
        rows.append((i, f"http://{host}.example/{i}", page(body)))
        expected[i] = "\n\n".join(blocks)
    docs = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in extract(docs).collect()} == expected
    # A page alone has nothing to tell an advert by.
    alone = extract(docs.where("page_id = 20")).first().text
    assert expected[20] in alone and alone != expected[20]


def test_copied_articles_stay(spark):
    article = "<article><p>The same story.</p></article>"
    rows = [(i, f"http://c.example/{i}", page(f"<nav>{i}</nav>{article if i % 3 else f'<article><p>Own {i}</p></article>'}")) for i in range(30)]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert sum(r.text == "The same story." for r in extract(docs).collect()) == 20


def test_copies_count_as_one_page(spark):
    story = "<div><p>The same story.</p><p>It goes on.</p></div>"
    own = [page(f"<nav>{i}</nav><div><p>Own {i}</p></div><div>Rights kept</div>") for i in range(6)]
    copies = [page(f"<nav>{i}</nav>{story}<div>Rights kept</div>") for i in range(20)]
    rows = [(i, f"http://c.example/{i}", h) for i, h in enumerate(own + copies)]
    only = [(100 + i, "http://d.example/", page(f"<article>{story}</article>")) for i in range(9)]
    docs = spark.createDataFrame(rows + only, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in extract(docs).collect()}
    assert [found[i] for i in range(6)] == [f"Own {i}" for i in range(6)]
    assert {t for i, t in found.items() if i >= 6} == {"The same story.\n\nIt goes on."}


def test_template_of_few_pages(spark):
    bodies = [f"<div><p>Page {i} says {w * 30}</p></div>" for i, w in enumerate("abcd")]
    kept, story = "<div>All rights kept</div>", "<div><p>One long story.</p></div>"
    hosts = {f"h{n}": [b + kept for b in bodies[:n]] for n in (1, 2, 3, 4)}
    hosts["some"] = [bodies[0] + kept, bodies[1] + kept, bodies[2]]
    hosts["versions"] = [f"{story}<div>Seen {i} times</div>" for i in (5, "many")]
    rows = [(n, f"http://{h}.example/{n}", page(b)) for h, bs in hosts.items() for n, b in enumerate(bs)]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {(r.url.split(".")[0][7:], r.page_id): r.text for r in extract(docs).collect()}
    for (host, i), text in found.items():
        assert ("All rights kept" in text) == (host == "h1" or host == "some" and i < 2)
        assert ("One long story." in text) == (host == "versions")
        assert host == "versions" or f"Page {i} says" in text


def test_shapes_of_a_host_are_folded_in_bounded_groups(spark, monkeypatch):
    sizes, real = [], html_text.folded

    def folded(shapes, *by):
        sizes.extend(r["count"] for r in shapes.groupBy("host", *by).count().collect())
        return real(shapes, *by)

    monkeypatch.setattr(html_text, "folded", folded)
    found = [("x", tuple((t, ()) for t in p)) for n in (4, 5, 6) for p in permutations("abcdef", n)]
    rows = [("h", html_text.packed(s)) for s in found] + [("i", html_text.packed(found[0]))]
    rows += [("h", html_text.packed(("x", tuple((t, ()) for t in f"{a}{b}")))) for a in "ghijklmnopqrst" for b in "uvwxyz0123456789"]
    shapes = spark.createDataFrame(rows, "host string, shape string")
    nodes = html_text.wrapper_nodes(shapes).collect()
    assert len(rows) > 1500 and max(sizes) < 120
    assert sorted((r.host, r.shape) for r in nodes) == sorted(rows)
    for r in nodes:
        assert -1 not in r.nodes and r.nodes == sorted(set(r.nodes))


def test_edge_rows(spark):
    docs = table(spark, EDGE, text="html").withColumnRenamed("doc_id", "page_id")
    docs = docs.withColumnRenamed("source", "url")
    assert "host" in CLASHES
    found = extract(docs).collect()
    assert len(found) == len(EDGE)
    assert sorted(repr(r.page_id) for r in found) == sorted(repr(i) for i, _ in EDGE)
    assert all(r.text is not None for r in found)
    assert "lorem ipsum" in next(r.text for r in found if r.page_id == 5)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "page_id long, url string, html string")
    assert extract(docs).collect() == []
