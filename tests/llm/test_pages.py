"""Article texts of made-up pages."""

from __future__ import annotations

import random

from starweave.llm.pages import blocks, main_text

PAGES = "page_id long, url string, html string"


def text(page):
    return "\n".join(b.text for b in blocks(page)[0] if b.free)


def test_blocks_entities_and_white_space():
    page = (
        "<!DOCTYPE html><html><head><title>no</title><style>p{}</style></head><body><nav><a href=x>menu</a></nav>"
        "<article><h1>A &amp; b</h1><p><b>one\n two<br><p>caf&eacute;&nbsp;&#33; &lt;x&gt; &am</p>"
        "<script>var t='</p>';</script><!-- <p>gone</p> --><ul><li>x<li>y<ul><li>z</ul></ul>"
        "<div class='comments'><p>reader</p></div><form><p>q</p></form></article>"
        "<aside>side</aside><footer>&copy; foot</footer></body></html>"
    )
    assert text(page) == "A & b\none two\ncafé ! <x> &am\nx\ny\nz"


def test_marks_do_not_take_whole_pages_or_headings():
    body = "<article class='post widget'><div class='article-header'><h1>One</h1></div><h2 id='search'>Two</h2><p>three</p>"
    body += "<div class='box ad'>buy</div></article>"
    for page in (body, f"<body class='sidebar'>{body}</body>", f"<main class='has-header' id='comments'>{body}</main>"):
        assert text(page) == "One\nTwo\nthree"
    assert text("<body><div class='widget'><p>all of it</p></div></body>") == "all of it"
    assert text("<div>top</div><main><div class='widget'><p>all of it</p></div></main>") == "top\nall of it"
    assert text("<p>kept</p><div class='widget'>gone</div>") == "kept"


def test_broken_pages_end():
    for page in ("<", "<p", "<p class=", '<p class="', "<a b='c", "</", "</p", "<!--", "<!", "<script>x", "a < b <c", "<p =x>y</p>", "<p/>z", "&"):
        blocks(page)
    assert text("a < b") == "a < b"
    assert text('<p title="a>b">x') == "x"
    assert text("<p>" * 50 + "deep") == "deep"
    assert text("<div>" * 3000 + "deep") == "deep"
    blocks('<a "' * 20_000)


def page(rng, i):
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    body = [" ".join(word() for _ in range(30)) for _ in range(rng.randint(1, 5))]
    shared = "Subscribe to our weekly letter today"
    html = (
        f"<body><div><a href=/>{word()}</a></div><div>{shared}</div>"
        f"<div class='x'><h2>{body[0][:20]}</h2>{''.join(f'<p>{b}</p>' for b in body)}</div><div>Terms of use apply</div></body>"
    )
    return html, "\n".join([body[0][:20].strip(), *body])


def test_template_of_a_host_is_taken_away(spark, scratch):
    rng = random.Random(1)
    rows, want = [], {}
    for i in range(40):
        html, want[i] = page(rng, i)
        rows.append((i, f"https://user@Host.example:80/{i}", html))
    rows += [(100, "https://few.example/a", "<div>All of this stays</div>"), (101, None, "<p>no url</p>"), (102, "x", None)]
    rows += [(200 + i, "https://copies.example/", "<p>the same page</p>") for i in range(20)]
    got = {r["_row"]["page_id"]: r["text"] for r in main_text(spark.createDataFrame(rows, PAGES), scratch).collect()}
    assert {i: got[i] for i in want} == want
    assert got[100] == "All of this stays" and got[101] == "no url" and got[102] == ""
    assert {got[200 + i] for i in range(20)} == {"the same page"}


def test_small_hosts_have_templates(spark, scratch):
    rng = random.Random(2)
    rows, want = [], {}
    for n in (3, 5, 7):
        for i in range(n):
            html, want[10 * n + i] = page(rng, i)
            rows.append((10 * n + i, f"https://host{n}.example/{i}", html))
    rows += [(100 + i, "https://most.example/", f"<p>on four of five</p><p>own {i}</p>") for i in range(4)]
    rows += [(104, "https://most.example/", "<p>own 4</p>")]
    got = {r["_row"]["page_id"]: r["text"] for r in main_text(spark.createDataFrame(rows, PAGES), scratch).collect()}
    assert {i: got[i] for i in want} == want
    assert got[100] == "on four of five\nown 0" and got[104] == "own 4"


def test_empty_table(spark, scratch):
    assert main_text(spark.createDataFrame([], PAGES), scratch).count() == 0
