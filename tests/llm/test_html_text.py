"""Main text of pages: regions by line scores, omitted end tags, wrappers, depth."""

from __future__ import annotations

import html as entities
import random
import re
import time

import pyarrow.parquet as pq
import pytest

from clickshop.llm import html_text

LONG = "A long paragraph of the article that goes on for quite some time, as they do. " * 3
ARTICLE = f"<h1>Title</h1><p>{LONG}</p><p>Short one.</p><p>{LONG}</p>"
WANTED = "\n\n".join(["Title", LONG.strip(), "Short one.", LONG.strip()])
LINKS = "<ul>" + "<li><a href=/x>Some link</a></li>" * 8 + "</ul>"


@pytest.mark.parametrize(
    "page",
    [
        # No article or main part, no telling names: only the lines' scores.
        f"<body><div>{LINKS}</div><div><div>{ARTICLE}</div></div><div>{LINKS}</div></body>",
        f"<body><table><tr><td>{LINKS}<td>{ARTICLE}<td>{LINKS}</table>",
        f"<div class=a>{LINKS}</div><div class=b>{ARTICLE}</div><div class=c>Terms <a>Help</a> <a>Imprint</a></div>",
        f"<body>{ARTICLE}<div>{LINKS}</div></body>",
        # End tags that may be omitted.
        f"<html><head><title>T</title><body>{ARTICLE}",
        f"<html><head><title>T</title><body><main>{ARTICLE}</main>",
        f"<html><head><meta charset=utf-8><title>T</title><article>{ARTICLE}</article>",
        f"<article>{ARTICLE.replace('</p>', '')}</article>",
        # Names that only look like marks.
        f"<article><div class='social-science'>{ARTICLE}</div></article>",
        f"<article><div class='entry-header'><h1>Title</h1></div>{ARTICLE[14:]}</article>",
        f"<div class='entry-header'><h1>Title</h1></div>{ARTICLE[14:]}",
        f"<div class='menu-card-history'>{ARTICLE}</div>",
        # Marks that hold.
        f"<article>{ARTICLE}<div class='ad-container'>{LONG}</div></article>",
        f"<div>{ARTICLE}</div><div class='post-comments'>{'<p>' + LONG + '</p>'}{'<p>' + LONG + '</p>'}</div>",
        f"<div class='sidebar left'><p>{LONG}</p></div><article>{ARTICLE}</article><p>{LONG}</p>",
    ],
)
def test_region(page):
    assert html_text.main_text(page) == WANTED


def test_text_right_behind_an_open_head():
    assert html_text.main_text("<html><head><title>T</title>Text of the page") == "Text of the page"


@pytest.mark.parametrize(("page", "text"), [(None, ""), ("", ""), ("  \n", ""), ("<script>x</script>", ""), ("plain &amp; text", "plain & text")])
def test_small_pages(page, text):
    assert html_text.main_text(page) == text


def test_the_threshold_decides(monkeypatch):
    page = f"<body><div>{LINKS}</div><div>{ARTICLE}</div></body>"
    assert html_text.main_text(page) == WANTED
    monkeypatch.setattr(html_text, "_threshold", lambda scores: float("-inf"))
    assert html_text.main_text(page) != WANTED


@pytest.mark.parametrize("page", ["<div>a" * 100_000, "<div>a" * 50_000 + "</p>" * 50_000, "<article>b" * 20_000 + "</div></section>" * 20_000])
def test_deep_nesting_takes_time_in_proportion(page):
    start = time.perf_counter()
    text = html_text.main_text(page)
    assert len(text) >= 20_000 and time.perf_counter() - start < 20


def test_given_pages_hold_their_articles():
    """The given pages mark their article; its blocks, cut out by pattern, are the text."""
    block = re.compile(r"</?(?:p|h1|h2|h3|ul|ol|li|div|blockquote|pre|table|tr|td)\b[^>]*>")
    for page in pq.read_table("/root/testdata/sf0.01/pages.parquet").column("html").to_pylist():
        (inner,) = re.findall(r"<article>(.*?)</article>", page, re.S)
        inner = re.sub(r"<br\s*/?>", " ", re.sub(r"<!--.*?-->", "", inner, flags=re.S))
        blocks = [" ".join(entities.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in block.split(inner)]
        assert html_text.main_text(page) == "\n\n".join(b for b in blocks if b)


# --- the scores again, line by line and element by element


def plain_text(page: str) -> str:
    """What ``main_text`` says of pages without marks and articles, each sum taken anew."""
    parser = html_text._Lines()
    parser.feed(page)
    parser.close()
    parser.flush()
    lines = parser.lines
    ratio = [len(x.text) / (1 + x.tags) for x in lines]
    kernel = [0.1353352832366127, 0.6065306597126334, 1.0, 0.6065306597126334, 0.1353352832366127]
    scores = []
    for i in range(len(lines)):
        near = [(kernel[j - i + 2], ratio[j]) for j in range(max(0, i - 2), min(len(lines), i + 3))]
        scores.append(sum(w * r for w, r in near) / sum(w for w, _ in near))
    threshold = sum(scores) / len(scores) / 2

    def around(e):
        found = []
        while e is not None:
            found.append(e)
            e = e.parent
        return found

    def gain(e):
        return sum(s - threshold for s, x in zip(scores, lines) if e in around(x.holder))

    region = max((e for e in parser.elements if e.tag not in html_text.LEAVES), key=lambda e: round(gain(e), 6))
    kept = []
    for x in lines:
        path = around(x.holder)
        if region not in path:
            continue
        below = path[: path.index(region)]
        odd = [e for e in below if region.tag in html_text.PAGE and e.tag not in html_text.LEAVES | html_text.PAGE and gain(e) < 0]
        if not odd:
            kept.append(x.text)
    return "\n\n".join(kept)


def test_scores_of_generated_pages():
    rng = random.Random(3)

    def part(depth: int) -> str:
        kind = rng.choice(["text", "links", "parts"]) if depth else rng.choice(["text", "links"])
        if kind == "text":
            return "".join(f"<p>{'word ' * rng.randint(1, 60)}</p>" for _ in range(rng.randint(1, 4)))
        if kind == "links":
            return "".join(f"<a href=x>{'go ' * rng.randint(1, 3)}</a><br>" for _ in range(rng.randint(1, 6)))
        return "".join(f"<{t}>{part(depth - 1)}</{t}>" for t in rng.choices(["div", "section", "ul"], k=rng.randint(1, 4)))

    for _ in range(300):
        page = f"<body>{part(3)}{part(3)}</body>"
        assert html_text.main_text(page) == plain_text(page)
