from feedloom.llm import html


def text(page, gone=()):
    return html.main_text(html.parse(page), frozenset(gone))


def test_main_text():
    page = """<html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body><nav>menu</nav><header>top</header><div class="ad">buy</div>
    <article><header><h1>Head &amp; line</h1></header><p>One  two<br>three <b>b</b>old</p><p>Open <i>end<p>Next &eacute;&#233;</p><!-- c --><form>f<input></form>
    <div class="comments"><p>reader</p></div><ul><li>x<li>y</ul><aside>side</aside></article><footer>foot</footer></body></html>"""
    assert text(page) == "Head & line\nOne two three bold\nOpen end\nNext éé\nx\ny"


def test_without_article():
    assert text("<body><div id='sidebar'>s</div><div>a</div>b<p>c") == "a\nb\nc"
    assert text("<main><p>m</p></main><p>o</p>") == "m"
    assert text("") == "" and text("plain") == "plain" and text("</p></div>x<p") == "x"
    assert text("<p>" * 20000 + "deep") == "deep"
    assert text("<div>" * 5000 + "deep") == "deep"


def test_templates_are_counted_per_host(spark):
    rows = [(k, f"https://h.example/{k}", f"<body><div class='x'>Same words on all pages</div><div>Own {k}</div></body>") for k in range(10)]
    rows += [(100 + k, f"https://o.example/{k}", f"<body><div class='x'>Same words on all pages</div><div>Own {k}</div></body>") for k in range(3)]
    rows += [(200 + k, "https://c.example/", f"<article><p>Quoted passage</p><p>Own {k}</p></article>") for k in range(12)]
    rows += [(300, None, None), (None, "https://h.example/0", rows[0][2]), (301, "x", "<body><p>one</p></body>")] + [(302, "https://d.example/", "<body><div>copy</div></body>")] * 20
    out = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    by = {r.page_id: r.text for r in out}
    assert len(out) == len(rows)
    assert by[3] == "Own 3" and by[None] == "Own 0"
    assert by[101] == "Same words on all pages\nOwn 1"
    assert by[205] == "Quoted passage\nOwn 5"
    assert by[300] == "" and by[301] == "one" and by[302] == "copy"
    assert all(r.n_chars == len(r.text) for r in out)
    assert html.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_text_outside_of_articles_is_judged_by_the_counts(spark):
    page = "<body><div class='strap'>Strap line</div><article><div>Box of the site</div><p>Own {0}</p></article><div class='more'><header>Top</header><p>Second part {0}</p></div></body>"
    rows = [(k, "https://h.example/", page.format(k)) for k in range(9)] + [(100 + k, "https://few.example/", page.format(k)) for k in range(7)]
    rows += [(200, "https://h.example/", "<main><p>m</p></main><p>o</p>")]
    by = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert by[3] == "Own 3\nSecond part 3" and by[200] == "m\no"
    assert by[103] == "Box of the site\nOwn 3"


def test_a_wrapper_of_most_of_the_page_is_no_boilerplate():
    assert text("<body><div class='layout has-sidebar'><article><p>Long words of the article</p></article></div><p>x</p></body>") == "Long words of the article"
    assert text("<form><main><p>Long words of the page</p></main></form>") == "Long words of the page"
    assert text("<article><p>Long words of the article</p></article><div class='related'><article>card</article></div>") == "Long words of the article"
    assert text("<aside><article><p>Long words of an aside</p></article></aside><p>own</p>") == "own"


def test_counts_equal_plain_counting(spark):
    import random
    from collections import Counter, defaultdict

    rng = random.Random(5)
    blocks = [f"<div class='b{k}'><p>Block {k}</p></div>" for k in range(12)]
    rows = []
    for k in range(900):
        host = "big" if k < 850 else "mid" if k < 880 else "small" if k < 885 else "twin"
        body = "".join(b for i, b in enumerate(blocks) if rng.random() < (0.5, 0.2, 0.02, 0.009)[i % 4])
        rows.append((k, f"https://{host}.example/{k}", f"<body>{body}<article><p>Own {0 if host == 'twin' else k}</p></article></body>"))
    pages, seen = defaultdict(set), defaultdict(set)
    for _, url, page in rows:
        host = url.split("/")[2]
        pages[host].add(page)
        for _, h in html.subtrees(html.parse(page)):
            seen[host, h].add(page)
    counts = Counter({k: len(v) for k, v in seen.items()})

    def want(url, page):
        host, root = url.split("/")[2], html.parse(page)
        n = len(pages[host])
        gone = {at for at, h in html.subtrees(root) if counts[host, h] >= max(html.MIN_PAGES, html.SHARE * n)}
        return html.main_text(root, frozenset(gone | ({0} if n >= html.MIN_PAGES else set())))

    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {k: want(url, page) for k, url, page in rows}
    assert len({c for (h, _), c in counts.items() if h == "big.example" and html.MIN_PAGES <= c < html.SHARE * 850 + 1}) > 0


def test_clashing_names(spark):
    clash = spark.createDataFrame([(1, "https://h.example/", "<p>a</p>", "x", 5)], "host long, url string, html string, page string, gone int")
    assert [(r.host, r.url, r.text) for r in html.extract(clash, "host").collect()] == [(1, "https://h.example/", "a")]
