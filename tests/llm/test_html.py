import random

from hiresight.llm import html as ht


def regex_of(*pages):
    g = ht.Grammar()
    out = None
    for p in pages:
        out = g.page(p) if out is None else g.merge(out, g.page(p))
    return ht.regex(g.dump(out))


def test_wrapper_has_slots_repeats_and_optionals():
    a = "<ul><li>x</li><li>y <b>z</b></li></ul>"
    b = "<h1>t</h1><ul><li>x</li></ul><p>end</p>"
    assert regex_of(a) == "(<ul>(<li>#TEXT(<b>#TEXT</b>)?</li>)+</ul>)"
    assert regex_of(a, b) == regex_of(b, a) == "((<h1>#TEXT</h1>)?<ul>(<li>#TEXT(<b>#TEXT</b>)?</li>)+</ul>(<p>#TEXT</p>)?)"
    assert regex_of("<dl><dt>a</dt><dd>b</dd><dt>c</dt><dd>d</dd></dl>") == "(<dl>(<dt>#TEXT</dt><dd>#TEXT</dd>)+</dl>)"


def text_of(page):
    g = ht.Grammar()
    return ht.main_text(page, ht.places(g.dump(g.page(page)), ht.masses(page)))


def test_boilerplate_and_decoding():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>if (a<b) {"</p>"}</script></head><body>
    <header><h1>Site</h1></header><nav><a href="/">Home</a></nav><div class="cookie-notice">We use</div><!-- c <p>x</p> -->
    <article class="post"><header><h1>A &amp; B&nbsp; &#233;</h1></header><p>One\n two<br>three <i>four</i>
    <p>Five<aside>side</aside> six</p><form><input value="x"><p>Mail</p></form><ul><li>l1<li>l2</ul><div id="comments"><p>bad</p></div>
    <div class="ad slot-3">buy</div><script>track("</article>")</script></article>
    <article class="comment">reader</article><div class="sidebar"><p>links</p></div><footer>&copy; f</footer></body></html>"""
    assert text_of(page) == "A & B é\nOne two three four\nFive\nsix\nl1\nl2"


def test_odd_pages():
    assert text_of("") == "" and text_of(" \n<p> </p>") == "" and text_of("plain &lt;text") == "plain <text"
    assert text_of("<div><p>a</p><p>b</p></div>") == "a\nb"
    assert text_of("<body><div class=menu>x y z</div><div><p>long text here</p><p>more <b>text</p></div></body>") == "long text here\nmore text"
    deep = "<div>" * 5000 + "core" + "</div>" * 5000
    assert text_of(f"<article>{deep}</article>") == "core"
    assert text_of("<main>a < b <p title='x>y'>c</p></main") == "a < b\nc"
    assert text_of("<article><p>" + "w " * 200_000 + "</p>") == ("w " * 200_000).strip()
    assert text_of("<article>" + "<p>x</p><hr>" * 20_000 + "</article>") == "\n".join(["x"] * 20_000)


def page(r, style):
    words = [f"w{i}&amp;" if i == 3 else f"w{i}" for i in range(50)]
    blocks = [" ".join(r.choices(words, k=r.randint(3, 30))) for _ in range(r.randint(1, 9))]
    want = "\n".join(b.replace("&amp;", "&") for b in blocks)
    junk = " ".join(r.choices(words, k=5))
    if style == "article":
        body = "".join(f"<p>{'<b>' if r.random() < .3 else ''}{b}{'<br>' if r.random() < .3 else ''}</p>" for b in blocks)
        return f"<html><body><nav><a>{junk}</a></nav><div class='ad'>{junk}</div><article>{body}</article><footer>{junk}</footer></body></html>", want
    body = "".join(f"<div class='row'><span>{b}</span></div>" for b in blocks) + f"<div class='row'>{'tail ' * 20}</div>"
    return f"<html><body><div class='menu'>{junk}</div><div class='content'>{body}</div><div class='sidebar'>{junk}</div></body></html>", want + "\n" + ("tail " * 20).strip()


def test_operator(spark, monkeypatch):
    monkeypatch.setattr(ht, "FORMS", 3)
    r = random.Random(2)
    rows, want = [], {}
    for i in range(300):
        host = "big.example.com" if i % 3 else f"h{i % 7}.example.com"
        html, want[i] = page(r, "article" if host.startswith("big") or host < "h4" else "div")
        rows.append((i, f"https://{host}/x/{i}?u=1", html, 5))
    rows += [(900, None, None, 1), (901, "https://big.example.com", "", 1), (902, "nonsense", "<p>alone</p>", 1), (5, rows[5][1], rows[5][2], 9)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int").repartition(9)
    out = ht.extract(df).collect()
    assert len(out) == len(rows)
    for x in out:
        assert x["text"] == want.get(x["page_id"], {902: "alone"}.get(x["page_id"], ""))
        assert x["n_chars"] == len(x["text"])
    wrappers = ht.infer_wrappers(df).collect()
    assert len(wrappers) == len({w["host"] for w in wrappers}) == len({f"h{i % 7}" for i in range(0, 300, 3)}) + 2
    assert sum(w["pages"] for w in wrappers) == len(rows)
    assert ht.extract(df.limit(0)).count() == 0


def test_deep_nesting():
    def deep(inside, n):
        return "<div>" * n + inside + "</div>" * n

    for n in (30, 57, 58, 59, 70, 3_000):
        inner = deep("<p>in</p><script>var x = 1;</script><nav>menu</nav><div class='comments'>reader</div>", n)
        assert text_of(f"<body><div><article>{inner}<p>rest</p></article></div><footer>f</footer></body>") == "in\nrest"
        assert text_of(f"<body><div>links</div>{deep('<div>side</div><article><p>in</p><p>rest</p></article>', n)}</body>") == "in\nrest"


def test_class_words_do_not_hide_the_main_text():
    for page in ("<body class='no-sidebar'><div class='sidebar'>s</div><article>text</article></body>",
                 "<body class='search-enabled'><p>text</p></body>", "<body class='search'><p>text</p></body>",
                 "<body><article class='post has-comments'>text</article></body>",
                 "<body><article class='recommended'>text</article><div class='comments'>c</div></body>",
                 "<body><main id='content-with-sidebar'>text</main></body>", "<body><main class='search'>text</main></body>",
                 "<body><div class='widget'><div><main>text<div class='ad'>a</div></main></div></div></body>",
                 "<body><div class='page social'><article>text</article></div><nav>n</nav></body>",
                 "<body><div class='alert'>text</div></body>"):
        assert text_of(page) == "text", page
    assert text_of("<body><article class='comment'>reader</article><article>text</article></body>") == "text"


def test_compound_classes_agree_or_say_nothing():
    for box in ("cookie-banner", "related-posts", "newsletter-signup", "share-buttons", "comment-list", "ad-slot", "site-footer",
                "comments-area", "commentlist", "social_links", "sidebar-left", "blog-sidebar", "ad_unit_3"):
        assert text_of(f"<article><p>story</p><div class='{box}'><p>junk</p></div><p>end</p></article>") == "story\nend", box
    for kept in ("no-sidebar", "has-comments", "with-ads", "share-price", "search-results", "post-content", "cookies-recipe", "legal-history", "download"):
        assert text_of(f"<article><p>story</p><div class='{kept}'><p>text</p></div></article>") == "story\ntext", kept


def test_topic_words_on_text_inside_an_article():
    page = ("<article><p class='search'>How search works.</p><section class='legal'><h2>Law</h2><p>The case.</p></section>"
            "<p class='ad'>buy</p><div class='search'><p>find</p></div><ul class='comments'><li>reader</li></ul></article>")
    assert text_of(page) == "How search works.\nLaw\nThe case."


def test_teasers_beside_the_story():
    story = "".join(f"<p>Paragraph {i} of the story, which goes on for a while.</p>" for i in range(4))
    teasers = "".join(f"<article><h3>Other {i}</h3><p>Short teaser.</p></article>" for i in range(3))
    for page in (f"<main><article>{story}</article></main><section>{teasers}</section>", f"<section>{teasers}</section><main><article>{story}</article></main>",
                 f"<body><article class='story'>{story}</article><div>{teasers}</div></body>"):
        assert text_of(page) == "\n".join(f"Paragraph {i} of the story, which goes on for a while." for i in range(4)), page
    # several parts of one place stay together
    assert text_of("<main><article><p>one</p></article><article><p>two</p></article></main>") == "one\ntwo"
