"""Features of DOM elements, for many pages at once: subtree density, attribute words, depth, siblings."""

from __future__ import annotations

import re
from collections.abc import Mapping

import numpy as np

from .html_dom import Page

STOPS, COMMAS = re.compile(r"[.!?。](?=\s|$)"), re.compile(r"[,;:]")
NAMES = (
    "depth", "children", "chars", "own_chars", "page_share", "link_share", "elements", "density", "paragraphs", "paragraph_share",
    "stops", "commas", "items", "controls", "images", "headings", "order", "order_from_end", "siblings", "same_tag", "sibling_share",
    "sibling_mean", "before", "after", "tag_odds", "word_odds", "word_low", "word_high", "parent_odds", "above_low", "above_high",
)


class Nodes:
    """All elements of some pages, with global parents."""

    def __init__(self, pages: list[Page]):
        sizes = np.array([len(p.tags) for p in pages], np.int64)
        self.first = np.cumsum(sizes) - sizes
        self.page = np.repeat(np.arange(len(pages)), sizes)
        n = int(sizes.sum())
        parent = np.array([k for p in pages for k in p.parents], np.int64)
        self.parent = np.where(parent < 0, -1, parent + self.first[self.page])
        self.tags = [t for p in pages for t in p.tags]
        self.words = [w for p in pages for w in p.tokens]
        own = np.zeros((n, 3))  # characters, sentence ends, commas
        before = np.zeros(n)
        for page, first in zip(pages, self.first.tolist(), strict=True):
            for run in page.runs:
                if run is not None:
                    size = len(run[1].strip())
                    if size:
                        own[first + run[0]] += (size, len(STOPS.findall(run[1])), len(COMMAS.findall(run[1])))
        self.depth = np.zeros(n, np.int64)
        level = np.flatnonzero(self.parent < 0)
        self.levels = []
        children_of = np.argsort(self.parent, kind="stable")
        sorted_parent = self.parent[children_of]
        while len(level):
            self.levels.append(level)
            self.depth[level] = len(self.levels) - 1
            low, high = np.searchsorted(sorted_parent, level, "left"), np.searchsorted(sorted_parent, level, "right")
            width = high - low
            step = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
            level = np.sort(children_of[np.repeat(low, width) + step])
        self.own, self.before = own, before

    def above(self, own: np.ndarray, join) -> np.ndarray:
        """Folds a value down from the page: join(parent's, own)."""
        out = own.copy()
        for level in self.levels[1:]:
            out[level] = join(out[self.parent[level]], own[level])
        return out

    def below(self, own: np.ndarray) -> np.ndarray:
        """Sums over subtrees."""
        out = own.copy()
        for level in reversed(self.levels[1:]):
            np.add.at(out, self.parent[level], out[level])
        return out


def features(nodes: Nodes, odds: Mapping[str, float]) -> np.ndarray:
    """One row per element; ``odds`` has the learned log-odds of tags (as ``<tag``) and words."""
    n = len(nodes.tags)
    tags = np.array(nodes.tags, object)
    is_tag = {t: tags == t for t in set(nodes.tags)}

    def among(*names: str) -> np.ndarray:
        out = np.zeros(n, bool)
        for name in names:
            if name in is_tag:
                out |= is_tag[name]
        return out.astype(float)

    in_link = nodes.above(among("a"), np.maximum)
    in_paragraph = nodes.above(among("p", "pre", "blockquote"), np.maximum)
    own = nodes.own[:, 0]
    parts = np.column_stack(
        [nodes.own, own * in_link, own * in_paragraph, np.ones(n), among("p"), among("li", "option"), among("input", "button", "select"),
         among("img"), among("h1", "h2", "h3", "h4", "h5", "h6")]
    )
    chars, stops, commas, linked, written, elements, paragraphs, items, controls, images, headings = nodes.below(parts).T
    top = nodes.first[nodes.page]
    whole = np.maximum(chars[top], 1)
    has = np.maximum(chars, 1)

    parent = np.maximum(nodes.parent, 0)
    by_parent = np.lexsort((np.arange(n), nodes.parent))
    group = nodes.parent[by_parent]
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[starts, n])
    order, siblings = np.zeros(n), np.zeros(n)
    order[by_parent] = np.arange(n) - np.repeat(starts, sizes)
    siblings[by_parent] = np.repeat(sizes, sizes)
    roots = nodes.parent < 0
    order[roots], siblings[roots] = 0, 1
    codes = np.unique(tags.astype(str), return_inverse=True)[1]
    kind = parent * (codes.max(initial=0) + 1) + codes
    _, which, times = np.unique(kind, return_inverse=True, return_counts=True)
    children = np.bincount(nodes.parent[~roots], minlength=n).astype(float)
    around = np.where(roots, chars, chars[parent])

    cumulative = np.cumsum(own)
    ended = cumulative - own  # characters before an element, over all pages
    begun = ended - ended[top]

    tag_odds = np.array([odds.get(f"<{t}", 0.0) for t in nodes.tags])
    words = [[odds[w] for w in ws if w in odds] for ws in nodes.words]
    mean = np.array([sum(v) / len(v) if v else 0.0 for v in words])
    low, high = np.array([min(v, default=0.0) for v in words]), np.array([max(v, default=0.0) for v in words])
    low, high = np.minimum(low, 0), np.maximum(high, 0)
    over = np.minimum(low, np.minimum(tag_odds, 0))
    above_low = nodes.above(over, np.minimum)
    above_high = nodes.above(np.maximum(high, np.maximum(tag_odds, 0)), np.maximum)
    log = np.log1p
    return np.column_stack(
        [
            nodes.depth, log(children), log(chars), log(own), chars / whole, linked / has, log(elements), log(chars / elements),
            log(paragraphs), written / has, 100 * stops / has, 100 * commas / has, items / elements, log(controls), log(images),
            log(headings), log(order), log(siblings - order - 1), log(siblings), times[which] / siblings, chars / np.maximum(around, 1),
            log(around / siblings), begun / whole, np.maximum(whole - begun - chars, 0) / whole, tag_odds, mean, low, high,
            tag_odds[parent] + mean[parent], above_low[parent], above_high[parent],
        ]
    )
