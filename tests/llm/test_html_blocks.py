import html
import time

import numpy as np
import pytest

from boxframe.llm import html_blocks

PAGES = "/root/testdata/sf0.01/pages.parquet"


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet(PAGES)


@pytest.fixture(scope="module")
def model(pages):
    return html_blocks.train(pages, sample_pages=120)


def test_blocks():
    page = (
        "<html><head><title>No</title><style>p{}</style></head><body><p>One <b>bold</b>\n word<p>Two&nbsp;&amp; three<br>four"
        "<ul><li><a href='/x>y'>link</a><li>Item</ul><script>var t='</p>';</script><!-- gone --><td>a < b</body>"
    )
    assert [b.text for b in html_blocks.blocks_of(page)] == ["One bold word", "Two & three four", "link", "Item", "a < b"]
    assert [b.linked for b in html_blocks.blocks_of(page)][2] == 1.0
    assert html_blocks.blocks_of(None) == [] and html_blocks.blocks_of("<p>") == [] and html_blocks.blocks_of("<!-- open") == []


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    samples = html_blocks.examples(["<nav><a>x y</a></nav><article><p>one two.</p><p>three</p></article>", "<main>a<p>b</main><footer>c</footer>"], 1, 0)
    model = html_blocks.Labeller.fresh(1)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    parts = html_blocks.vectors([b for b, _ in samples])
    lengths, wanted = np.array([len(b) for b, _ in samples]), np.concatenate([y for _, y in samples]).astype(float)
    share = np.clip(wanted.mean(), 0.05, 0.95)

    def loss():
        scores, _ = model.forward(parts, lengths)
        each = np.logaddexp(0, scores) - wanted * scores
        return (each * np.where(wanted > 0, 0.5 / share, 0.5 / (1 - share))).mean()

    grads = model.gradients(parts, lengths, wanted)
    for name, g in grads.items():
        flat, weights = g.reshape(-1), model.weights[name].reshape(-1)
        for k in [int(np.abs(flat).argmax()), int(rng.integers(len(flat)))]:
            kept = weights[k]
            weights[k] = kept + 1e-2
            high = loss()
            weights[k] = kept - 1e-2
            low = loss()
            weights[k] = kept
            assert flat[k] == pytest.approx((high - low) / 2e-2, rel=0.05, abs=2e-4), name


def test_pages_not_seen_in_training(spark, pages, model):
    rows = pages.orderBy("page_id").collect()
    unseen = html_blocks.examples([r.html for r in rows[-60:]], 3, 99)
    found = html_blocks.label(model, [b for b, _ in unseen])
    right = sum(int((a == y).sum()) for a, (_, y) in zip(found, unseen, strict=True))
    assert right >= 0.97 * sum(len(y) for _, y in unseen)
    # The layout at hand: every block.
    whole = [r.html for r in rows]
    blocks = [html_blocks.blocks_of(p) for p in whole]
    wrong = sum(not np.array_equal(a, [bool(html_blocks.weak_label(b)) for b in bs]) for a, bs in zip(html_blocks.label(model, blocks), blocks, strict=True))
    assert wrong <= 0.02 * len(whole)


def test_odd_pages(spark, model):
    deep = "<div>" * 3000 + "x"
    rows = [(1, None, "a"), (2, "", "a"), (3, "plain text", "a"), (4, "<<<>>><p", "a"), (5, deep, "a"), (6, "<article><p>" + "word " * 50_000, "a"), (7, "<p>é", "a"), (7, "<p>é", "a")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = html_blocks.extract(pages, model).collect()
    assert len(got) == len(rows) and {r.row.page_id: r.text for r in got}[1] == "" and all(r.row.text == "a" and r.text is not None for r in got)
    assert html_blocks.extract(pages.limit(0), model).count() == 0
    assert html_blocks.train(pages.limit(0)) is None and html_blocks.extract(pages, None).count() == len(rows)


def plain_page(rng, i):
    def words(n):
        return " ".join(f"{'abcdefgh'[k % 8]}word{k}" for k in rng.integers(0, 3000, n))

    links = "".join(f'<div><a href="/{j}">menu{j}</a></div>' for j in range(6))
    return f'<html><body><div class="top">{links}</div><div class="x{i % 3}">' + "".join(f"<div>{words(30)}</div>" for _ in range(4)) + "</div></body></html>"


def test_pages_of_plain_divs(spark):
    rng = np.random.default_rng(1)
    made = [plain_page(rng, i) for i in range(40)]
    pages = spark.createDataFrame(list(enumerate(made)), "page_id long, html string")
    model = html_blocks.train(pages)
    for found in (html_blocks.extract(pages, model).collect(), html_blocks.extract(pages, None).collect()):
        texts = [r.text for r in found]
        assert sum(t.count("\n") == 3 and "menu" not in t for t in texts) >= 36 and all(texts)


def test_sample_is_of_distinct_pages(spark):
    rows = [(i, f"<p>page {i % 3 and i}</p>") for i in range(6000)]
    pages = spark.createDataFrame(rows, "page_id long, html string")
    for seed in range(6):
        got = html_blocks.sampled(pages, "html", 240, seed)
        assert len(set(got)) == len(got) == 240
    assert len(html_blocks.sampled(pages.limit(9), "html", 240, 0)) == 7


@pytest.mark.parametrize(
    ("page", "texts"),
    [
        ("<div class='x>hello</div><p>rest</p>", ["hello", "rest"]),
        ("<a href=foo'>bar</a> baz", ["bar baz"]),
        ("<p title=\"a > b\" class='c'>one</p><p class='it>don't</p>two", ["one", "don't", "two"]),
        ('<p class="a"id="b">x</p></3>y<br/>z<div class="open', ["x", "y z"]),
        ("<p>a</p><svg viewBox=1 /><p>b</p>", ["a", "b"]),
        ("<p>a<svg><path d='x'/><text>no</text></svg>b</p>", ["ab"]),
        ("<p>a</p><svg><g></svg><p>b</p><svg>c<p>d</p>", ["a", "b", "c", "d"]),
        ("<div>a<noscript>no <p>script</p></noscript>b</div><template><p>no</p></template>c", ["a", "b", "c"]),
        ("<div>a</div><noscript>b<p>c<iframe src=x><p>d", ["a", "b", "c", "d"]),
        ("<p>a <!--> b</p><!-- no --!>c<script>no</script x>d", ["a b", "cd"]),
    ],
)
def test_broken_markup_is_no_text_and_hides_none(page, texts):
    assert [b.text for b in html_blocks.blocks_of(page)] == texts


@pytest.mark.parametrize("bad", ['<a href="', "<noscript>", "<a b='", "<svg>", "<iframe>", "<!--", "<"])
def test_long_runs_of_broken_tags_take_linear_time(bad):
    started = time.monotonic()
    html_blocks.blocks_of(bad * 50_000)
    html_blocks.blocks_of(bad * 50_000 + "</svg></noscript></iframe>")
    assert time.monotonic() - started < 10



def marked_page(rows, k):
    """A page whose elements are all named by numbers, with the article's text between ``top`` and ``end``."""
    body = [b.text for b in html_blocks.blocks_of(rows[k]) if html_blocks.weak_label(b)]
    others = [html.escape(w) for b in html_blocks.blocks_of(rows[k - 1]) for w in b.text.split()]

    def words(start, n):
        return " ".join(others[(start + i) % len(others)] for i in range(n))

    links = "".join(f'<li><a href="/{i}">{words(i, 2)}</a></li>' for i in range(5))
    top = [("div", words(0, 2)), ("ul", links)]
    reply = [("h3", words(3, 2)), *[x for i in range(3) for x in (("span", words(i, 1)), ("p", words(40 + 9 * i, 12 + 7 * i)))]]
    end = [*reply, ("div", "&copy; " + words(7, 6))]
    keep = "".join(f'<{"h1" if i == 0 else "p"} data-mark="keep">{html.escape(x)}</{"h1" if i == 0 else "p"}>' for i, x in enumerate(body))

    def made(parts):
        return "".join(f'<div class="q{k}{i}"><{tag}>{text}</{tag}></div>' for i, (tag, text) in enumerate(parts))

    return f'<html><body><div id="z1">{made(top)}</div><div id="z2">{keep}</div><div id="z3">{made(end)}</div></body></html>'


def test_pages_whose_names_say_nothing(pages, model):
    rows = [r.html for r in pages.orderBy("page_id").collect()]
    blocks = [html_blocks.blocks_of(marked_page(rows, k)) for k in range(len(rows) - 60, len(rows))]
    found = np.concatenate(html_blocks.label(model, blocks))
    wanted = np.array([b.mark == "keep" for page in blocks for b in page])
    assert 0 < wanted.sum() < len(wanted)
    # F1 of blocks.
    assert 2 * (found & wanted).sum() >= 0.9 * (found.sum() + wanted.sum())
