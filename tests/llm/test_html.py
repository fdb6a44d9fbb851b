"""Layouts of pages that the given ones do not have."""

from driftline.llm import html

TEXT = "".join(f"<p>Sentence {i} of the long report, with <a href=/x>a link</a> in it.</p>" for i in range(6))
WANT = "\n".join(f"Sentence {i} of the long report, with a link in it." for i in range(6))
QUOTE = "<p>A passage that many pages quote word for word.</p>"


def texts(corpus, sources):
    rows = [(i, f"http://host/{i}", s) for i, s in enumerate(sources)]
    out = html.extract_text(corpus.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    return [r["text"] for r in sorted(out, key=lambda r: r["page_id"])]


def pages(layout, bodies):
    return [f"<html><head><title>t</title></head><body><nav>Menu</nav>{layout % b}<footer>Foot</footer></body></html>" for b in bodies]


def test_copies_are_no_templates(corpus):
    for layout in ("<main>%s</main>", "<div class=content>%s</div>", "%s", "<article><section>%s</section></article>", "<article><div>%s</div></article>"):
        assert texts(corpus, pages(layout, [TEXT] * 8)) == [WANT] * 8, layout
        # near copies: one short block differs
        near = [TEXT + f"<p>Visit {i}</p>" for i in range(8)]
        assert texts(corpus, pages(layout, near)) == [f"{WANT}\nVisit {i}" for i in range(8)], layout


def test_quoted_passages_and_links_stay(corpus):
    for layout in ("<main>%s</main>", "<article><section>%s</section></article>", "<article><div>%s</div></article>"):
        got = texts(corpus, pages(layout, [f"<p>Own words of page {i}.</p>{QUOTE}<p>And more of {i}.</p>" for i in range(8)]))
        assert all("A passage that many pages quote word for word." in t and f"page {i}" in t for i, t in enumerate(got)), layout
    got = texts(corpus, pages("%s", [f"<p>Visitor {i} lives in <a href=/p>Paris</a> now.</p>" for i in range(8)]))
    assert got == [f"Visitor {i} lives in Paris now." for i in range(8)]


def test_templates_still_go(corpus):
    for layout in ("<div class=x1>Daily of the town</div><div>%s</div><div>Write to the office</div>", "<main><div>Daily of the town</div>%s</main>", "<article><div>Daily of the town</div><section>%s</section></article>"):
        own = [f"<p>Own words of page {i}, and some more words of {i} to read on it.</p>" for i in range(8)]
        got = texts(corpus, pages(layout, own))
        assert got == [f"Own words of page {i}, and some more words of {i} to read on it." for i in range(8)], layout


def test_names_do_not_take_real_text(corpus):
    got = texts(corpus, [
        "<article><h2 id=related-work>Related work</h2><h2 id=search-algorithms>Search</h2><p id=comment-3>Third</p><p class=notice>Mind</p><pre>a <span class=comment># b</span></pre></article>",
        "<body><div class='content has-sidebar'><article><p>Inside the wrapper</p></article></div></body>",
        "<body><div class='sidebar'><article><p>Inside the wrapper</p></article></div></body>",
        "<article class='post comments-open ad-free'><p>The post itself</p></article>",
        "<body><div class='search page'><h1>Bare</h1><p>Text of the page</p></div><div class=menu><a href=/all>A long list of links to all the other pages</a></div></body>",
        "<body><form><article><p>In a form</p></article><input></form></body>",
        "<article><p>Let <math><mi>x</mi></math> be <label>real</label>.</p></article>",
        "<article><section id=related-work><h2>Related work</h2><p>Others did it.</p></section><p>We did it too, and at some length.</p></article>",
    ])
    assert got == ["Related work\nSearch\nThird\nMind\na # b", "Inside the wrapper", "Inside the wrapper", "The post itself", "Bare\nText of the page", "In a form", "Let x be real.", "Related work\nOthers did it.\nWe did it too, and at some length."]


def test_named_furniture_still_goes(corpus):
    body = "<article><p>The text of the article, long enough to be most of it.</p>%s</article>"
    for extra in ("<div class=comments>no</div>", "<div class='cookie-banner x'>no</div>", "<div class=site-footer>no</div>", "<section id=comments>no</section>", "<ul class=relatedPosts><li>no</ul>", "<div role=search>no</div>", "<form>no</form>"):
        assert texts(corpus, [body % extra]) == ["The text of the article, long enough to be most of it."], extra
    assert texts(corpus, ["<article><p>One</p></article><div class=comments><article>A comment that is longer than the article</article></div>"]) == ["One"]
