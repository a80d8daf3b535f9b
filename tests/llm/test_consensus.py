"""Main text on hosts of several layouts, in nested containers, and beside names that look like furniture."""

from pagework.llm.html_consensus import extract_pages

BODY = [f"paragraph {k} " + "of plain words " * 8 for k in range(6)]


def paragraphs(texts):
    return "".join(f"<p>{t}</p>" for t in texts)


def lines(*texts):
    return "\n".join(" ".join(t.split()) for t in texts)


def test_host_of_two_layouts(spark):
    rows = [(k, "http://h/a", f"<body><div><h1>title {k}</h1>{paragraphs(BODY)}</div></body>") for k in range(7)]
    rows += [(k, "http://h/b", f"<body><div>by somebody</div><section class=story><h1>title {k}</h1>{paragraphs(BODY)}</section></body>") for k in (7, 8)]
    # Two winners, and text in both: the second one holds the article.
    rows += [(k, "http://g/a", f"<body><div class=x>{paragraphs(BODY)}</div></body>") for k in (20, 21, 22)]
    rows += [(k, "http://g/b", f"<body><div class=x>teaser</div><div class=y>{paragraphs(BODY)}</div></body>") for k in (23, 24)]
    got = {r.page_id: r.text for r in extract_pages(spark.createDataFrame(rows, "page_id LONG, url STRING, html STRING")).collect()}
    assert got == {k: lines(f"title {k}", *BODY) if k < 20 else lines(*BODY) for k, _, _ in rows}


def test_whole_article_around_the_best_container():
    from pagework.llm.html_consensus import main_text, read_page

    for n in (1, 6, 60):
        inner = f"<h1>title</h1><div class=wrap><div class=lead>the lead</div><div class=body>{paragraphs(BODY * n)}</div><div class=note>a note</div></div>"
        for page in (f"<article>{inner}</article>", f"<main>{inner}</main>", f"<div class=story>{inner}</div>", inner):
            source = f"<body><nav>menu</nav>{page}</body>"
            assert main_text(read_page(source), []) == lines("title", "the lead", *BODY * n, "a note")
    linked = f"<body><div class=top><a href=/>all</a> <a href=/b>others</a></div><div class=story><h1>title</h1><div>{paragraphs(BODY * 9)}</div></div></body>"
    assert main_text(read_page(linked), []) == lines("title", *BODY * 9)


def test_names_within_an_article():
    from pagework.llm.html_consensus import main_text, read_page

    kept = ["<h2 id='search-and-sharing'>{}</h2>", "<h2 id=related-work>{}</h2>", "<h3 id=comments>{}</h3>", "<section id='login'><p>{}</section>",
            "<p id='comment-on-results'>{}</p>", "<div class='share-price'>{}</div>", "<ul><li id=sharing>{}</ul>", "<table><tr><td id=menu-prices>{}</table>",
            "<div class='search-results-explained'>{}</div>", "<div id=cookie-recipes><p>{}<p>with <a href=/>one link</a></div>"]
    gone = ["<div class='share-buttons'>{}</div>", "<div class='x comment-list'>{}</div>", "<div id=comments>{}</div>", "<div role=navigation>{}</div>",
            "<p class=advert>{}</p>", "<section class=newsletter>{}</section>", "<div class='related-stories'><a href=/>{}</a></div>",
            "<section id=related><ul><li><a href=/>{}</a><li><a href=/b>{}</a></ul></section>"]
    for tag in ("<article>", "<main>", "<div role=main>"):
        source = f"<body>{tag}{paragraphs(BODY)}" + "".join(x.replace("{}", f"kept text {k}") for k, x in enumerate(kept))
        source += "".join(x.replace("{}", "gone text") for x in gone) + "<p>the end"
        want = [y for k, _ in enumerate(kept) for y in ([f"kept text {k}"] + ["with one link"] * (k == len(kept) - 1))]
        assert main_text(read_page(source), []) == lines(*BODY, *want, "the end")
    outside = "<body><article><p>text</article><div class=ad-text>a</div><h2 id=related-work>heading</h2></body>"
    assert [t for t, *_ in read_page(outside).blocks] == ["text", "heading"]
