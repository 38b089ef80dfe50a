"""Main text of web pages: boosted trees over DOM elements, and a decoding that can't contradict itself.

Each element with text gets log-odds of belonging to the main text. A kept element needs a kept
parent, so the best such choice is found from the leaves up: an element is worth its own log-odds and
what its children are worth, and is dropped with all below it if that is negative.

The trees learn from invented pages with known main text, and from a bounded sample of the pages at
hand, as far as their elements say what they are (article and main against nav, aside, footer, form
and telling names).

Defined cases: a null, empty or text-free page has the empty text; a page cut off in a tag, an entity
or a script is read up to there; repeated rows agree; an empty table gives no rows; columns other than
page_id, url and html are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import page_samples, trees
from .common import map_arrow
from .html_dom import Page, parse
from .html_features import Nodes, features

SAMPLE_PAGES = 300  # pages of the table that are learned from, at most
INVENTED_PAGES = 900
PLACES = 1 << 52  # that hashes choose from
ROUNDS, DEPTH = 80, 4
HELD_PAGES, HELD_CHARS = 200, 4_000_000  # pages read together
NOT_MAIN_TAGS = frozenset("nav aside footer form header menu button select dialog".split())
NOT_MAIN_WORDS = frozenset(
    "ad ads advert advertisement sponsored promo cookie consent newsletter subscribe sidebar menu nav navbar navigation breadcrumb "
    "breadcrumbs footer share social related recommended comment comments reply login signup popup modal pagination copyright".split()
)


@dataclass(frozen=True)
class Extractor:
    odds: dict[str, float]
    start: float
    forest: tuple[trees.Tree, ...]

    def log_odds(self, nodes: Nodes) -> np.ndarray:
        x = features(nodes, self.odds)
        return self.start + sum(t.predict(x) for t in self.forest)

    def keep(self, pages: list[Page]) -> list[list[bool]]:
        """Which elements of each page are kept."""
        nodes = Nodes(pages)
        chars = nodes.below(nodes.own[:, 0])
        worth = np.where(chars > 0, np.clip(self.log_odds(nodes), -6, 6), 0.0)
        for level in reversed(nodes.levels[1:]):
            np.add.at(worth, nodes.parent[level], np.maximum(worth[level], 0))
        kept = worth > 0
        for level in nodes.levels[1:]:
            kept[level] &= kept[nodes.parent[level]]
        return [part.tolist() for part in np.split(kept, nodes.first[1:])]

    def texts(self, sources: list[str | None]) -> list[str]:
        pages = [parse(s) for s in sources]
        return [p.text(k) for p, k in zip(pages, self.keep(pages), strict=True)]


def marked(page: Page) -> list[int]:
    """1 or 0 per element by the nearest training mark at or above it."""
    out = []
    for mark, parent in zip(page.marks, page.parents, strict=True):
        out.append(int(mark) if mark else (out[parent] if parent >= 0 else 0))
    return out


def told(page: Page) -> list[int] | None:
    """1 or 0 per element by telling tags and names; None for a page without article or main."""
    if not {"article", "main"} & set(page.tags):
        return None
    out, barred = [], []  # a comment may be an article, but never main
    for tag, words, parent in zip(page.tags, page.tokens, page.parents, strict=True):
        barred.append((parent >= 0 and barred[parent]) or tag in NOT_MAIN_TAGS or bool(NOT_MAIN_WORDS.intersection(words)))
        above = parent >= 0 and out[parent] == 1
        out.append(int(not barred[-1] and (above or tag in ("article", "main"))))
    return out


def learn(samples: list[str]) -> Extractor:
    """Fits word odds and trees on invented pages and the sample."""
    pages, labels = [], []
    for source in page_samples.pages(INVENTED_PAGES):
        pages.append(parse(source))
        labels.append(marked(pages[-1]))
    for source in samples:
        page = parse(source)
        label = told(page)
        if label is not None:
            pages.append(page), labels.append(label)
    nodes = Nodes(pages)
    mine = np.array([x for label in labels for x in label], float)
    chars = nodes.below(nodes.own[:, 0])
    holds = nodes.below(nodes.own[:, 0] * mine)
    seen = np.flatnonzero(chars > 0)
    y = (holds > 0).astype(float)  # an element above main text must be kept for it
    good, bad = Counter(), Counter()
    for k in seen.tolist():
        (good if y[k] else bad).update({f"<{nodes.tags[k]}", *nodes.words[k]})
    odds = {
        w: float(np.log((good[w] + 1) / (bad[w] + 1)))
        for w in sorted(good.keys() | bad.keys())
        if good[w] + bad[w] >= 5
    }
    x = features(nodes, odds)[seen]
    start, forest = trees.boost(x, y[seen], ROUNDS, DEPTH, rate=0.2, least=3.0)
    return Extractor(odds, start, tuple(forest))


def fit(pages: DataFrame, n: int = SAMPLE_PAGES, longest: int = 20_000) -> Extractor:
    """Learns, among others, from at most ``n`` pages of at most ``longest`` characters, by hash.

    The hash is cut where somewhat more than ``n`` pages are left, so that tasks hand on few.
    """
    chosen = pages.filter(F.length("html") <= longest).select(F.col("page_id"), F.col("html").cast("string").alias("html"))
    place = F.pmod(F.xxhash64("page_id", "html"), F.lit(PLACES))
    chance = min(1.0, 2 * n / max(chosen.count(), 1))
    got = chosen.filter(place < chance * PLACES).orderBy(place, "page_id", "html").limit(n).collect()
    return learn([r["html"] for r in got])


def extract(pages: DataFrame, model: Extractor) -> DataFrame:
    """page_id, url, text and n_chars of every page, from its whole html."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, held, size = [], [], 0
            for source in batch["html"]:
                held.append(source.as_py())
                size += len(held[-1] or "")
                if len(held) >= HELD_PAGES or size >= HELD_CHARS:
                    texts += model.texts(held)
                    held, size = [], 0
            if held:
                texts += model.texts(held)
            columns = [batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    )
    return map_arrow(rows, run, "page_id bigint, url string, text string, n_chars bigint")
