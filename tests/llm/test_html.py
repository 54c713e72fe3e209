"""Main text on pages that mislead by their marks, in time in proportion to the page, and against labelled pages."""

import random
import time

import pytest

from mediasieve.llm.html_text import main_text

LONG = "A sentence of the article, with a comma, goes on for a while and tells something. " * 3
P = f"<p>{LONG}</p>"
TEXT = LONG.strip()
CHROME = "<nav><a href=/a>A</a> <a href=/b>B</a></nav><div class=cookie-notice><p>We use cookies, sorry.</p></div>"


@pytest.mark.parametrize(
    "page",
    [
        f"<body>{CHROME}<form id=aspnetForm><div>{P * 3}</div><input name=q></form></body>",
        f"<body>{CHROME}<form><article>{P * 3}</article><button>Send</button></form></body>",
        f"<body>{CHROME}<div class='article-ad-free'>{P * 3}</div></body>",
        f"<body>{CHROME}<div class='legal-opinion'>{P * 3}</div></body>",
        f"<body>{CHROME}<div class='ad-free story'><div class='story-body'>{P * 3}</div></div><div class=ad><p>Buy now, cheap, and more.</p></div></body>",
        f"<body>{CHROME}<main>{P * 3}<p>&copy; 2024 Someone, all rights reserved.</p></main></body>",
        f"<body>{CHROME}<main>{P * 3}<div>Copyright 2024 by us, all rights, all of them</div></main></body>",
        f"<body>{CHROME}<div class=social><div class=x>{P * 3}</div></div></body>",
        f"<body>{CHROME}<article>{P * 3}<section id=comments>{'<p>Nice, so nice, really nice, and more of it, and more.</p>' * 40}</section></article></body>",
        f"<body>{CHROME}<div>{P * 3}</div><form><label for=x>Name</label><input id=x><p>Please, do, write.</p></form><footer>{P}</footer></body>",
    ],
)
def test_marks_are_penalties(page):
    assert main_text(page).split("\n") == [TEXT] * 3


def test_linked_sources_and_labels_stay():
    sources = '<ul><li><a href="https://a.org/1">First source</a></li><li><a href="https://b.org/2">Second source</a></li></ul>'
    menu = "<ul><li><a href=/x>More</a></li><li><a href=/y>Even more</a></li></ul>"
    got = main_text(f"<body>{CHROME}<article>{P}{sources}{menu}<p><label>Note:</label> read this</p></article></body>").split("\n")
    assert got == [TEXT, "First source", "Second source", "Note: read this"]


def test_siblings_of_the_best_element_stay():
    got = main_text(f"<body>{CHROME}<div><h3>Sub</h3><div>{P * 2}</div><ul><li>Flour</li><li>Sugar</li></ul>bare text</div></body>").split("\n")
    assert got == ["Sub", TEXT, TEXT, "Flour", "Sugar", "bare text"]


def test_nothing_but_chrome_is_empty():
    assert main_text(f"<body>{CHROME}<footer><p>Imprint, address, and so on</p></footer><script>x</script></body>") == ""


@pytest.mark.parametrize("tag", ["div", "b", "p", "li", "span><div", "article", "form", "table><tr><td"])
def test_time_is_in_proportion_to_nesting(tag):
    took = []
    for n in (25_000, 100_000):
        began = time.time()
        got = main_text(f"<{tag}>text, here " * n + "end")
        took.append(time.time() - began)
        assert got.startswith("text, here") and got.endswith("end")
    assert took[1] < 12 * took[0] + 1


def made(rng):
    """A page and its blocks of article text, in one of several layouts."""
    words = [f"{a}{b}" for a in "lor ips dol sit am con".split() for b in ("em", "um", "or", "et", "ing")]
    sentence = lambda n: " ".join(rng.choices(words, k=n)).capitalize() + rng.choice([".", ", then.", "!"])
    blocks, parts = [sentence(6)], []
    parts.append(f"<h1>{blocks[0]}</h1>")
    for _ in range(rng.randrange(3, 12)):
        text = " ".join(sentence(rng.randrange(6, 25)) for _ in range(rng.randrange(1, 5)))
        tag = rng.choice(["p", "p", "p", "blockquote", "h2", "li"])
        blocks.append(text)
        parts.append(f"<ul><li>{text}</li></ul>" if tag == "li" else f"<{tag}>{text}</{tag}>")
    noise = lambda cls, n: f"<div class='{cls}'><p>{' '.join(sentence(12) for _ in range(n))}</p></div>"
    for cls in rng.sample(["ad", "social-share", "related-posts", "newsletter-signup"], 2):
        parts.insert(rng.randrange(1, len(parts)), noise(cls, 1))
    body = "".join(parts)
    body = rng.choice([f"<article>{body}</article>", f"<main>{body}</main>", f"<div class=post>{body}</div>", f"<div class='layout has-sidebar'><div id=content>{body}</div></div>", f"<form id=f><div>{body}</div></form>", f"<table><tr><td>{body}</td></tr></table>"])
    menu = "<nav><ul>" + "".join(f"<li><a href=/{w}>{w}</a></li>" for w in rng.sample(words, 6)) + "</ul></nav>"
    comments = f"<section id=comments>{''.join(f'<p>{sentence(15)}</p>' for _ in range(rng.randrange(20)))}</section>"
    return f"<html><head><title>x</title></head><body><header><p>{sentence(8)}</p></header>{menu}{noise('cookie-banner', 2)}{body}{noise('sidebar', 2)}{comments}<footer>&copy; {sentence(10)}</footer></body></html>", blocks


def test_precision_and_recall():
    """Words of the blocks of 400 labelled pages of six layouts."""
    rng, right, got_n, want_n = random.Random(4), 0, 0, 0
    for _ in range(400):
        page, blocks = made(rng)
        got = set(main_text(page).split("\n"))
        right += sum(len(b.split()) for b in blocks if b in got)
        want_n += sum(len(b.split()) for b in blocks)
        got_n += sum(len(b.split()) for b in got)
    print(f"precision {right / got_n:.4f} recall {right / want_n:.4f}")
    assert right / got_n > 0.97 and right / want_n > 0.97
