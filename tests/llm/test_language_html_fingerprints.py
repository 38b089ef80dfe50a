import hashlib
import random
import re

import numpy as np
import pytest

from cornermart.llm import byte_cnn, fingerprints, html_extract, iblt, language, page_samples
from cornermart.llm.html_dom import parse
from tests.llm.conftest import invented

TONGUES = {"aa": "an er in on re ti al ra", "bb": "sch ung ein der zu ß ö ch", "cc": "ción ñ lla ez qu os ar í"}


@pytest.fixture(scope="module")
def spoken(frame):
    return frame(
        [{"doc_id": k, "text": invented(60, k, list(TONGUES.values())[k % 3]), "lang": list(TONGUES)[k % 3] if k % 5 else None} for k in range(300)]
    )


def test_language_of_held_out_documents(spoken, frame, edge_rows):
    model = language.fit(spoken)
    assert model.languages == tuple(TONGUES)
    rows = language.identify(spoken, model).collect()
    assert len(rows) == 300 and all(0 <= r.score <= 1 for r in rows)
    right = [r.lang_pred == list(TONGUES)[r.doc_id % 3] for r in rows if r.held_out]
    assert np.mean(right) > 0.95
    edge = language.identify(frame([*edge_rows, (60, "123 !? 456"), (60, "½ ² ① Ⅷ")]), model).collect()
    assert len(edge) == len(edge_rows) + 2
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in edge if r.doc_id in (2, 3, 4, 60))
    assert all(r.lang_pred in TONGUES for r in edge if r.doc_id in (1, 6, 8))
    assert language.identify(frame([]), model).count() == 0


def test_language_without_labels(frame):
    docs = frame([(1, "some text"), (2, None)])
    model = language.fit(docs)
    assert [(r.lang_pred, r.score) for r in language.identify(docs, model).collect()] == [("und", 0.0)] * 2


def test_language_rows_without_id_and_copies_crowd_none_out(frame):
    """Many labelled rows without id, and copies of one, leave every language its place."""
    names = list(TONGUES)
    rows = [{"doc_id": None, "text": "a" + invented(12, k, TONGUES["aa"]), "lang": "aa"} for k in range(150)]
    rows += [{"doc_id": None, "text": "a copy of one text", "lang": "aa"}] * 300
    rows += [{"doc_id": None, "text": "z" + invented(12, k, TONGUES[t]), "lang": t} for t in names[1:] for k in range(150)]
    seen = {}

    def train(windows, label, n):
        seen["labels"], seen["texts"] = np.bincount(label, minlength=n), {bytes(w).rstrip(b"\0") for w in windows}
        return None

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(byte_cnn, "train", train)
        model = language.fit(frame(rows), per_language=20)
    assert model.languages == tuple(names)
    per_text = language.WINDOWS_PER_DOC
    assert all(5 <= n <= 45 * per_text for n in seen["labels"]) and len(seen["texts"]) > 15


def test_tables_equal_convolution():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 256, (5, byte_cnn.WINDOW))
    net = byte_cnn.train(x, np.array([0, 1, 0, 1, 1]), 2, epochs=1)
    emb, pooled, n = net.embedding[x], [], byte_cnn.WINDOW - 3
    for w, f, b in zip(byte_cnn.WIDTHS, net.filters, net.biases, strict=True):
        strips = np.concatenate([emb[:, j : j + n] for j in range(w)], axis=2)
        pooled.append(np.maximum((strips @ f + b).max(1), 0))
    z = np.concatenate(pooled, axis=1) @ net.dense + net.offset
    p = np.exp(z) / np.exp(z).sum(1, keepdims=True)
    assert np.allclose(net.probabilities(x.astype(np.uint8), net.tables()), p, atol=1e-4)


def test_windows_cover_the_whole_text():
    rows, sizes = language.windows_of("é" * 300)
    assert rows.shape == (3, 256) and sizes.tolist() == [256, 256, 88]
    assert rows.reshape(-1)[:600].tobytes() == ("é" * 300).encode()
    assert len(language.windows_of("")[0]) == 0


# pages


@pytest.fixture(scope="module")
def extractor():
    return html_extract.learn([])


def gold(source):
    page = parse(source)
    return page.text([bool(x) for x in html_extract.marked(page)])


def test_unseen_invented_pages(extractor):
    pages = page_samples.pages(120, seed=77)
    got = extractor.texts([re.sub(r' data-main="[01]"', "", p) for p in pages])
    exact = [a == gold(p) for a, p in zip(got, pages, strict=True)]
    assert np.mean(exact) > 0.9


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header class="site-header"><a href="/">Site</a></header><nav><ul><li><a href="/a">A</a><li><a href="/b">B</a></ul></nav>
<div class="cookie-banner"><p>We use cookies.</p><button>OK</button></div>
<article><h1>A &amp; B</h1><p>First   part,<br>same block. It goes on for a while.<p><b>Second</b> block &eacute; of the text.
<div class="ad"><a href="/x">Buy this now</a></div><p>Third block ends it, as it should.</article>
<section class="comments"><h3>2 comments</h3><div class="comment"><p>Nice one.</p></div></section>
<footer>&copy; Someone</footer></body></html>"""


def test_a_page(extractor):
    want = "A & B\n\nFirst part, same block. It goes on for a while.\n\nSecond block é of the text.\n\nThird block ends it, as it should."
    assert extractor.texts([PAGE]) == [want]


SENTENCES = (
    "The first sentence of the story tells what happened in town.", "A second one, with more detail, follows the first quite closely.",
    "Then a third sentence ends this part of the article.", "A fourth explains why it matters to the reader.",
    "The fifth is the last one, as it should be.",
)


@pytest.mark.parametrize("n", [3, 5])
@pytest.mark.parametrize(
    ("around", "block"),
    [
        ("<div class='content'>{}</div>", "<div>{}</div>"), ("<div>{}</div>", "<div>{}</div>"), ("{}", "<div>{}</div>"),
        ("<article>{}</article>", "<div>{}</div>"), ("<div id='x1'>{}</div>", "<div><span>{}</span></div>"), ("{}", "<div><span>{}</span></div>"),
        ("<main><h1>Title of it</h1><dl>{}</dl></main>", "<dt>Term</dt><dd>{}</dd>"),
        ("<article><h1>Title of it</h1><ul>{}</ul></article>", "<li><a href='/s'>{}</a></li>"),
        # none of these is among the invented pages
        ("<article><ol>{}</ol></article>", "<li>{}</li>"), ("<div class='text'><pre>{}</pre></div>", "{}\n\n"),
        ("<table><tr><td>{}</td></tr></table>", "{}<br><br>"), ("<main><section><div>{}</div></section></main>", "<center>{}</center>"),
    ],
)
def test_main_text_is_found_however_paragraphs_are_written(extractor, around, block, n):
    chrome = (
        "<html><head><title>t</title></head><body><header class='site-header'><a href='/'>Site</a></header><nav><ul><li><a href='/a'>Home</a></li>"
        "<li><a href='/b'>News</a></li></ul></nav>{}<div class='sidebar'><h3>Related</h3><ul><li><a href='/c'>Other story</a></li><li><a href='/d'>"
        "More of it</a></li></ul></div><footer>&copy; 2024 Someone. All rights reserved.</footer></body></html>"
    )
    (text,) = extractor.texts([chrome.format(around.format("".join(block.format(s) for s in SENTENCES[:n])))])
    assert all(s in text for s in SENTENCES[:n])
    assert not any(s in text for s in ("Home", "News", "Other story", "rights", "Site"))


def test_comments_that_are_articles_are_not_told_to_be_main():
    page = parse("<article><p>a</p></article><section class='comments'><article><p>b</p></article></section>")
    assert page.text([bool(x) for x in html_extract.told(page)]) == "a"


def test_decoding_is_the_best_choice_with_kept_parents():
    class Given(html_extract.Extractor):
        def log_odds(self, nodes):
            return worth

    r = random.Random(8)
    for _ in range(200):
        source = "".join(r.choice(["<div>", "<div>x", "</div>", "<b>y", "</b>"]) for _ in range(r.randint(1, 9)))
        page = parse(source)
        worth = np.array([r.uniform(-3, 3) for _ in page.tags])
        own = np.where(html_extract.Nodes([page]).below(html_extract.Nodes([page]).own[:, 0]) > 0, worth, 0)
        kept = Given({}, 0.0, ()).keep([page])[0]
        best = 0.0
        for choice in range(1 << len(page.tags)):
            closed = all(p < 0 or choice >> p & 1 or not choice >> k & 1 for k, p in enumerate(page.parents))
            best = max(best, sum(own[k] for k in range(len(page.tags)) if choice >> k & 1)) if closed else best
        assert all(kept[p] or not k for k, p in zip(kept, page.parents, strict=True) if p >= 0)
        assert sum(own[k] for k in range(len(kept)) if kept[k]) == pytest.approx(best)


def test_no_kept_element_has_a_dropped_parent(extractor):
    pages = [parse(p) for p in page_samples.pages(40, seed=5)]
    for page, kept in zip(pages, extractor.keep(pages), strict=True):
        assert all(kept[p] or not k for k, p in zip(kept, page.parents, strict=True) if p >= 0)


def test_reader_copes_with_broken_pages():
    cases = {
        "": "", "plain &amp; simple": "plain & simple", "<p>a<p>b": "a\n\nb", "x<script>1<2</script>y": "xy", "<p>cut &am": "cut &am",
        "<div class='": "", "a<!-- <p>no</p>": "a", "<ul><li>a<li>b</ul>": "a\n\nb", "<td>a</td><td>b</td>": "a\n\nb", "a<br>b": "a b",
        "<p>a<b>b</b>c</p>d": "abc\n\nd", "<a href=\"x>y\">z</a>": "z", "</div></p>q": "q", "<SCRIPT>x</ScRiPt >k": "k", "1 < 2 &lt; 3": "1 < 2 < 3",
    }
    for source, want in cases.items():
        page = parse(source)
        assert page.text([True] * len(page.tags)) == want, source
    deep = parse("<div>" * 20_000 + "x")
    assert deep.text([True] * len(deep.tags)) == "x"


def test_reader_ends_tags_and_keeps_foreign_elements_as_browsers_do(extractor):
    cases = {
        '<p title="5" tall">One.</p><p>Two <a href="x">it</a>': "One.\n\nTwo it", '<img alt="a"b"><p>t</p><i class="c">u</i>': "t\n\nu",
        "<p title=it's>One</p><p>isn't": "One\n\nisn't", '<a href=/a?b="c>d</a>"e': 'd"e', '<i class = "a>b">c</i>': "c",
        "<div><svg><path d='M0'></div><p>text</p>": "text", "<p>If <math><mi>x</mi><mo>=</mo><mn>1</mn></math> so": "If x=1 so",
        "<p><object data='a'>instead</object> of it": "instead of it", "<p>a<noscript>b</noscript>c": "abc",
    }
    for source, want in cases.items():
        page = parse(source)
        assert page.text([True] * len(page.tags)) == want, source
    icon = PAGE.replace('<a href="/">Site</a>', '<svg class="logo"><path d="M0"><a href="/">Site</a>')
    assert extractor.texts([icon]) == extractor.texts([PAGE])


def test_pages_table(spark, extractor):
    rows = [(1, "u", PAGE, 5), (2, "u", None, 5), (3, None, "", 5), (1, "u", PAGE, 5), (None, "v", "<article><p>Some text of it.</p></article>" * 2, 5)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text int")
    out = html_extract.extract(pages, extractor).collect()
    assert len(out) == 5 and all(r.n_chars == len(r.text) for r in out)
    assert {r.text for r in out if r.page_id in (2, 3)} == {""} and len({r.text for r in out if r.page_id == 1}) == 1
    assert html_extract.extract(pages.filter("false"), extractor).count() == 0
    assert html_extract.fit(pages.filter("false")).forest


# fingerprints


def test_sketches_recover_the_difference():
    rng = np.random.default_rng(9)
    a, b = [], []
    for k in range(200):
        shared, x, y = (rng.integers(0, 2**63, n).astype(np.uint64) for n in rng.integers(0, 60, 3))
        a.append(np.concatenate([shared, x])), b.append(np.concatenate([y, shared]))
    want = [len(set(x.tolist()) ^ set(y.tolist())) for x, y in zip(a, b, strict=True)]
    assert iblt.differing(a, b, 6).tolist() == want
    diff = iblt.Sketches.of(a[:1], 600).minus(iblt.Sketches.of(b[:1], 600))
    _, keys, empty = diff.peel()
    assert set(keys.tolist()) == set(a[0].tolist()) ^ set(b[0].tolist()) and empty.all()


def test_comparison_equals_brute_force(frame, edge_rows):
    rows = [*edge_rows, *[(100 + k, invented(50 + k, k // 2)) for k in range(40)]]
    got = fingerprints.compare(frame(rows)).collect()
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()), reverse=True)
    texts = [t or "" for _, t in ordered]
    want = []
    for k, (doc_id, _) in enumerate(ordered):
        text, after = texts[k], texts[(k + 1) % len(texts)]
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        sets = [set(fingerprints.digests(t).tolist()) for t in (text, changed, after)]

        def like(a, b):
            return round(2 * len(a & b) / (len(a) + len(b)), 9) if a or b else 1.0

        want.append((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), like(sets[0], sets[1]), like(sets[0], sets[2])))
    rows = [(r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got]
    assert sorted(rows, key=str) == sorted(want, key=str)
    prints = {}
    for r in got:
        prints.setdefault(r.doc_id, set()).add(r.fingerprint)
    assert len(prints[5]) == 1 and prints[1] == prints[5] and prints[2] == prints[3] and prints[1] != prints[100]


def test_one_document_follows_itself(frame):
    (row,) = fingerprints.compare(frame([(4, "abc def")])).collect()
    assert row.near_next == 1.0 and row.edited_sha256 == hashlib.sha256(b"abc abc").hexdigest()
    assert fingerprints.compare(frame([])).count() == 0


def test_large_ids_beside_missing_ones_keep_every_document(spark, frame):
    """64-bit ids above 2**53 meet their neighbours exactly, though rows without id share their batches."""
    big = 2**62 + 1
    rows = [(big + 3 * k, invented(9, k)) for k in range(60)] + [(None, invented(9, 99)), (-big, "last one")]
    got = {r.doc_id: r.edited_sha256 for r in fingerprints.compare(frame(rows).coalesce(1)).collect()}
    texts = dict(rows)
    ordered = [*sorted((k for k in texts if k is not None), reverse=True), None]
    assert got.keys() == texts.keys()
    for k, doc_id in enumerate(ordered):
        changed = fingerprints.edited(texts[doc_id], texts[ordered[(k + 1) % len(ordered)]])
        assert got[doc_id] == hashlib.sha256(changed.encode()).hexdigest()
