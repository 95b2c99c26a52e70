"""What counts as a host's template: texts of all its pages, at least two different ones."""

import random

from profilerank.llm import html


def _texts(spark, pages):
    rows = [(i, f"http://{host}/{i}", source) for i, (host, source) in enumerate(pages)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    return [r["text"] for r in html.extract_text(frame).orderBy("page_id").collect()]


def test_texts_of_some_pages_stay(spark):
    assert _texts(spark, [
        ("a.org", "<div><p>Intro A</p><blockquote>Only here</blockquote><p>Team</p></div>"), ("a.org", "<div><p>Intro B</p><p>Team</p></div>"),
        ("a.org", None), ("one.org", "<h2>Alone</h2><p>x</p><p>y</p>"), ("same.org", "<h2>Copy</h2><p>x</p>"), ("same.org", "<h2>Copy</h2><p>x</p>"),
    ]) == ["Intro A\n\nOnly here", "Intro B", "", "Alone\n\nx\n\ny", "Copy\n\nx", "Copy\n\nx"]


def test_template_text_inside_articles_goes(spark):
    def page(i, body):
        return f"<div>side line {i}</div><article><h1>Head {i}</h1>{body}<p>Write to the desk</p><section><p>Desk rules</p></section></article>"

    # The shared paragraph stands behind one to three others, and after other elements.
    bodies = ["<p>x</p>", "<p>x</p><ul><li>i</li></ul><p>y</p>", "<p>v</p><p>y</p><blockquote>z</blockquote><p>w</p>"]
    found = _texts(spark, [("a.org", page(i, b)) for i, b in enumerate(bodies)]
                   + [("b.org", "<main><p>Old</p></main>"), ("b.org", "<main><p>Old</p><p>New</p></main>")])
    assert found[:3] == ["Head 0\n\nx", "Head 1\n\nx\n\ni\n\ny", "Head 2\n\nv\n\ny\n\nz\n\nw"]
    assert found[3:] == ["Old", "New"]  # a page that holds nothing but what all have is not emptied


def test_the_expression_decides(spark):
    """Generated pages of hosts with planted templates, against the texts that were planted as content."""
    rng, pages, wanted, alone = random.Random(5), [], [], []
    for host in range(12):
        fixed = [f"fixed {host} {k}" for k in range(4)]
        for number in range(9):
            word = (lambda h, n: lambda: f"text {h} {n} {rng.random()}")(host, number)
            title, lines, items = word(), [word() for _ in range(rng.randint(1, 9))], [word() for _ in range(rng.randint(0, 4))]
            optional = [f"sometimes {host}"] if number % 3 else []  # a text that some pages lack is content
            source = (f"<div class=kicker>{fixed[0]}</div><h1>{title}</h1><div class=date>{fixed[1]}</div>"
                      + "".join(f"<p>{line}</p>" for line in lines) + "".join(f"<blockquote>{t}</blockquote>" for t in optional)
                      + (f"<ul>{''.join(f'<li>{i}</li>' for i in items)}</ul>" if items else "")
                      + f"<div class=end><p>{fixed[2]}</p><section>{fixed[3]}</section></div>")
            pages.append((f"h{host}.org", f"<nav>menu</nav><article>{source}</article><footer>foot</footer>"))
            content = [*lines, *optional, *items]
            wanted.append("\n\n".join([title, *content]))
            alone.append("\n\n".join([fixed[0], title, fixed[1], *content, fixed[2], fixed[3]]))
    assert _texts(spark, pages) == wanted
    assert ["\n\n".join(html.blocks(html.parse(source), None)) for _, source in pages] == alone  # without the expression


def test_slots_optional_parts_and_groups_are_read():
    def of(source):
        return html.describe(html.parse(source))

    page = html.parse("<p>same</p><h2>same</h2><ul><li>same<li>own</ul>")
    whole = of("<p>same</p><h2>same</h2><ul><li>same</ul>")
    assert html.blocks(page, whole) == ["own"]
    assert html.blocks(page, html.merge(whole, of("<p>other</p><h2>same</h2><ul><li>same</ul>"))) == ["same", "own"]  # a slot
    assert html.blocks(page, html.merge(whole, of("<p>same</p><ul><li>same</ul>"))) == ["same", "own"]  # an optional part
    assert html.blocks(page, html.merge(whole, of("<p>same</p><h2>same</h2><ul><li>a<li>b</ul>"))) == ["same", "own"]  # a group
    # Copies of one kind at several places, more kinds than an alignment has cells, and any order of a group's parts.
    many = "".join(f"<x-{chr(97 + i // 26)}{chr(97 + i % 26)}>{i}</x-{chr(97 + i // 26)}{chr(97 + i % 26)}>" for i in range(300))
    assert html.blocks(html.parse(many + "<p>own</p>"), html.merge(of(many), of(many + "<p>z</p>"))) == ["own"]


def test_names_count_as_a_whole():
    def read(source):
        return html.blocks(html.parse(source), None)

    for name in ("ad-hoc-analysis", "social-science", "related-work", "comment-on-law", "content", "css-ad1x"):
        assert read(f"<article><p>Intro</p><div class='{name}'><p>Real</p></div></article>") == ["Intro", "Real"], name
    for name in ("ad", "ad-slot", "ad_1", "share-buttons", "social-share", "comments", "cookie-notice", "related-posts"):
        assert read(f"<article><p>Intro</p><div class='{name}'><p>No</p></div></article>") == ["Intro"], name
    assert read("<article><p>a</p><address>Street 1</address><p>b <math><mi>x</mi><mo>=</mo><mn>2</mn></math></p>"
                "<dialog>said</dialog><object>drawn</object></article><address>site</address>") == ["a", "Street 1", "b x=2", "said", "drawn"]
