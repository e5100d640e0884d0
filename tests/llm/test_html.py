"""Main text of pages of one template, of marked and of odd pages."""

import random

import pytest

from navloom.llm import html_extract
from navloom.llm.common import table

SCHEMA = "page_id long, url string, html string, text string, host string, slots int"


def extracted(spark, rows):
    found = html_extract.extract_text(spark.createDataFrame([(*r, None, "h", 1) for r in rows], SCHEMA))
    return {r.row.page_id: r.text for r in found.select("row", "text").collect()}


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))


def test_articles_of_the_table(spark, sf_dir):
    import html
    import re

    rows = html_extract.extract_text(table(spark, sf_dir, "pages")).select("row.html", "text").collect()
    for r in rows:
        inner = re.search(r"<article>(.*?)(?:</article>|<footer|$)", r.html or "", re.S)
        plain = re.sub(r"<[^>]+>", "", re.sub(r"</?(?:p|h1|br|li|ul|div|section)[^>]*>", " ", inner[1] if inner else ""))
        assert r.text == " ".join(html.unescape(plain).split())


def test_host_without_marks_is_read_by_its_template(spark):
    rng = random.Random(4)
    rows, want = [], {}
    for k in range(40):
        body = [words(rng, 40) for _ in range(rng.randrange(1, 5))]
        links = "".join(f"<li><a href=/{j}>{words(rng, 2)}</a></li>" for j in range(6))
        rows.append((k, f"https://plain.example:80{k % 2}/p/{k}", f"<html><body><div><ul>{links}</ul></div><div><h1>{words(rng, 4)}</h1><div>" + "".join(f"<p>{b}" for b in body) + "</div></div><div><b>Made by us, all rights kept</b></div></body></html>"))
        want[k] = body
    found = extracted(spark, rows)
    for k, body in want.items():
        assert all(b in found[k] for b in body)
        assert "all rights kept" not in found[k]


def test_parts_of_a_marked_page(spark):
    page = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t="<p>No</p>";</script></head><body>
    <header class="top"><h2>No</h2></header><nav><a href=x>No</a></nav><div class="cookie-notice">No</div><!-- No <p> -->
    <main><article><header><h1>Yes &amp; no</h1></header><p>One <b>t</b>wo<br>three&nbsp;four <a href="/">link</a><p>Five &#x3c;six&gt;
    <div class="ad">No</div><form><input value=No><label>No</label></form><aside>No</aside><ul><li>a<li>b</ul>
    <section id="comments"><article><p>No</p></article></section><p hidden>No</p><noscript>No</noscript><p>1 < 2 & 3</p></article></main>
    <div class="sidebar">No</div><footer>&copy; No</footer></body></html>"""
    assert extracted(spark, [(1, "http://a.example/1", page)])[1] == "Yes & no One two three four link Five <six> a b 1 < 2 & 3"


def test_odd_pages(spark):
    rows = [
        (1, None, None), (2, "http://x.example", ""), (3, "nonsense", "plain text, no tags"), (4, "http://x.example/b", "<p>cut off <b>in the mid"), (5, "http://x.example/c", "<p>an <a title=\"open quote>x</p>"),
        (None, "http://y.example", "<article>no id</article>"), (6, "http://y.example/", "<article>twice</article>"), (7, "http://y.example/", "<article>twice</article>"), (8, "http://z.example/", "<p>" + "long " * 100_000), (9, "http://z.example/", "<" * 20_000),
        (10, "http://z.example/", "<div>" * 3000 + "deep"), (11, "http://z.example/", "<!-- never closed <p>no</p>"), (12, "http://z.example/", "<article><script>never closed"),
    ]
    found = extracted(spark, rows)
    assert (found[1], found[2], found[3], found[4], found[None], found[6], found[7]) == ("", "", "plain text, no tags", "cut off in the mid", "no id", "twice", "twice")
    assert found[8] == ("long " * 100_000).strip() and found[10] == "deep" and found[11] == found[12] == ""
    assert extracted(spark, []) == {}


@pytest.mark.parametrize("copies", [1, 2])
def test_equal_pages_are_no_template(spark, copies):
    """An article that stands on many pages is still an article."""
    rows = [(k, f"http://copies.example/{k}", f"<body><nav>{k}</nav><article><p>the same words</p></article></body>") for k in range(20) for _ in range(copies)]
    assert set(extracted(spark, rows).values()) == {"the same words"}


def test_headline_and_lead_beside_the_body(spark):
    """All open slots of a template are text, but for slots of links; what the template repeats is not."""
    rng = random.Random(9)
    rows, want = [], {}
    for k in range(30):
        head, lead, body, more = words(rng, 5), words(rng, 12), words(rng, 80), words(rng, 30)
        links = "".join(f"<li><a href=/{j}>{words(rng, 3)}</a></li>" for j in range(8))
        rows.append((k, f"http://open.example/{k}", f"<body><div><ul>{links}</ul></div><div><h1>{head}</h1><p class=lead>{lead}</p><div class=text><p>{body}</p></div><div class=more>{more}</div></div><div><b>Made by us, all rights kept</b></div></body>"))
        want[k] = " ".join((head, lead, body, more))
    assert extracted(spark, rows) == want


def test_texts_that_change_their_order_are_no_template(spark):
    """Tokens with equal occurrence vectors are a class only if they come in the same order on every page; one that moves is left out, the others stay."""
    rng = random.Random(11)
    rows, want = [], {}
    for k in range(30):
        body, labels = words(rng, 40), ["economy and trade", "weather of the week"]
        rng.shuffle(labels)
        rows.append((k, f"http://order.example/{k}", f"<body><div><b>Made by us</b></div><div class=text><p>{body}</p><p>{labels[0]}</p><p>{labels[1]}</p></div><div><i>all rights kept</i></div></body>"))
        want[k] = " ".join((body, *labels))
    assert extracted(spark, rows) == want


def test_tokens_get_roles_by_their_slot(spark):
    """Two elements of one name, one of links and one of text, are told apart by what the template has around them."""
    rng = random.Random(12)
    rows, want = [], {}
    for k in range(30):
        links, body = "".join(f"<a href=/{j}>{words(rng, 3)}</a> " for j in range(rng.randrange(2, 9))), [words(rng, 30) for _ in range(rng.randrange(1, 4))]
        rows.append((k, f"http://roles.example/{k}", f"<body><div>{links}</div><hr><div>{''.join(f'<p>{b}</p>' for b in body)}</div></body>"))
        want[k] = " ".join(body)
    assert extracted(spark, rows) == want


def test_classes_that_cross_are_no_template():
    """Of two classes that cross, the smaller one is given up; a class that is not in turns is, too."""
    large, small = {r: (7, 4) for r in (10, 11, 12, 13)}, {20: (8, 2), 21: (8, 2)}
    assert html_extract._settled([10, 11, 20, 12, 13, 21], large | small)[2] == {8}
    assert html_extract._settled([10, 20, 21, 11, 20, 21, 12, 13], large | small) == ([0, 10, 10, 0, 11, 11, 0, 0], {10: [0, 0], 11: [1, 1], 12: [2, 2], 13: [3, 3], 20: [0, 0], 21: [1, 1]}, set())
    assert html_extract._settled([10, 11, 12, 20, 20, 21, 13, 21], large | small)[2] == {8}


def test_teasers_are_no_article(spark):
    rng = random.Random(10)
    cards = "".join(f"<article><h3>{words(rng, 3)}</h3></article>" for _ in range(4))
    body = [words(rng, 40) for _ in range(2)]
    text = "".join(f"<p>{b}</p>" for b in body)
    assert extracted(spark, [(1, "http://t.example/", f"<body><div class=story>{text}</div><div>{cards}</div></body>")])[1] == " ".join(body)
    assert extracted(spark, [(1, "http://t.example/", f"<body><main><div>{text}</div>{cards}</main><p>elsewhere</p></body>")])[1].startswith(" ".join(body))
    posts = "".join(f"<article><p>{b}</p></article>" for b in body)
    assert extracted(spark, [(1, "http://t.example/", f"<body><p>short</p>{posts}</body>")])[1] == " ".join(body)


def test_an_article_inside_the_main_text(spark):
    page = "<main><p>some intro words</p><article>x</article><p>and the body of it</p></main><p>outside</p>"
    assert extracted(spark, [(1, "http://m.example/", page)])[1] == "some intro words x and the body of it"


@pytest.mark.parametrize("name", ["share-price", "related-work", "notice-period", "search-results", "promotion-code", "comment-on-law", "copyright-history"])
def test_names_that_only_begin_like_a_frame(spark, name):
    page = f'<article><p>one</p><div class="{name}"><fieldset>two <label>three</label></fieldset></div><div class="share-buttons">no</div><p id="{name}">four</p></article>'
    assert extracted(spark, [(1, "http://n.example/", page)])[1] == "one two three four"


def test_deep_pages_take_time_and_memory_in_proportion():
    import time
    import tracemalloc

    spent, held = [], []
    for n in (25_000, 50_000, 100_000):
        source = "<div>" * n + "deep" + "</div>" * (n // 2)
        started = time.perf_counter()
        page = html_extract.read_page(source)
        spent.append(time.perf_counter() - started)
        assert len(page.elements) == n + 1
        tracemalloc.start()
        assert html_extract.main_text(source, {}, set()) == "deep"
        held.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert spent[2] < 8 * spent[0] + 0.1 and held[2] < 6 * held[0] and held[2] < 200e6
