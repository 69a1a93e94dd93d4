"""Main text of pages by a tree-structured graphical model over the DOM.

Each block element and each run of text is a variable, content or not. Its own
potential comes from its features (tag, words of class, id and role, length, share of
links, end of sentence); an edge potential ties it to its parent. Sum-product messages
go up to the root and down again, which on a tree gives exact marginals. Runs whose
marginal exceeds one half are the text. All are learned from labelled
pages.

Defined results: a null or empty page, or one without content, gives an empty text.
Markup that is cut off or not closed is read as browsers read it. Every row is
extracted by itself, so repeated rows and null ids each get a result.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql.functions import arrow_udf

from evenkeel.llm.labelled_pages import pages as labelled
from evenkeel.llm.markup import Page, parse

SMOOTHING = 0.5
CONTENT_TAGS = ("article", "main")


def _weights(page: Page) -> tuple[list[int], list[int]]:
    """Characters of text, and of text within links, below each node."""
    size, linked = [len(t) for t in page.text], list(page.linked)
    for i in range(len(size) - 1, 0, -1):
        size[page.parent[i]] += size[i]
        linked[page.parent[i]] += linked[i]
    return size, linked


def features(page: Page) -> list[list[str]]:
    size, linked = _weights(page)
    found, within = [], []  # whether a node is in an article or main element
    for i, tag in enumerate(page.tag):
        within.append(i > 0 and (within[page.parent[i]] or page.tag[page.parent[i]] in CONTENT_TAGS))
        share = 0 if not linked[i] else 1 if 2 * linked[i] < size[i] else 2 if linked[i] < 0.9 * size[i] else 3
        kind = "text" if tag == "#text" else "box"
        one = [f"{kind} links {share}"]
        if tag == "#text":
            one.append(f"below {page.tag[page.parent[i]]}")
            one.append(f"length {min(size[i].bit_length() // 2, 5)}")
            one.append(f"ends {page.text[i][-1] in '.!?'}")
        else:
            one.append(f"tag {tag}")
            one.append(f"tag {tag} within {within[i]}")
            one.append(f"tag {tag} named {bool(page.names[i])}")
            one += [f"name {x}" for x in page.names[i]]
        found.append(one)
    return found


@dataclass(frozen=True)
class Model:
    prior: float                       # log odds of the root
    feature: dict[str, float]          # log odds of content, by feature
    edge: dict[bool, tuple]            # by whether the child is text: [parent][child]

    def marginals(self, page: Page, described: list[list[str]] | None = None) -> list[float]:
        """Probability that a node is content, by messages up and down the tree."""
        n, parent = len(page.tag), page.parent
        # Beliefs are pairs (not content, content), scaled to sum to one.
        up = []
        for one in described or features(page):
            odds = sum(self.feature.get(f, 0.0) for f in one)
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
            up.append([1 - p, p])
        message = [(1.0, 1.0)] * n
        for i in range(n - 1, 0, -1):
            (a, b), (c, d) = self.edge[page.tag[i] == "#text"]
            off, on = up[i]
            m0, m1 = a * off + b * on, c * off + d * on
            scale = m0 + m1
            message[i] = m0, m1 = m0 / scale, m1 / scale
            above = up[parent[i]]
            above[0] *= m0
            above[1] *= m1
            scale = above[0] + above[1]
            above[0] /= scale
            above[1] /= scale
        root = 1 / (1 + math.exp(-self.prior))
        up[0][0] *= 1 - root
        up[0][1] *= root
        belief = up  # of the root it is final; each child then takes its parent's, without its own message
        for i in range(1, n):
            (a, b), (c, d) = self.edge[page.tag[i] == "#text"]
            p0, p1 = belief[parent[i]]
            m0, m1 = message[i]
            p0, p1 = p0 / max(m0, 1e-300), p1 / max(m1, 1e-300)
            off, on = belief[i][0] * (a * p0 + c * p1), belief[i][1] * (b * p0 + d * p1)
            scale = off + on
            belief[i] = [off / scale, on / scale]
        return [on / (off + on) for off, on in belief]

    def text(self, source: str | None) -> str:
        page = parse(source)
        return "\n".join(t for t, p in zip(page.text, self.marginals(page)) if t and p > 0.5)


def train(sources: list[str] | None = None, epochs: int = 12, rate: float = 0.3) -> Model:
    """A model from pages in which comments ``main`` and ``/main`` enclose the content.

    A run of text is content if it is marked, an element if most of its text is. Edges
    are frequencies; the weights of features start as log odds and then climb the
    likelihood of the labels, whose gradient is label less marginal (AdaGrad).
    """
    counts, totals = defaultdict(Counter), Counter()
    edges, roots = defaultdict(lambda: [[SMOOTHING] * 2, [SMOOTHING] * 2]), [SMOOTHING] * 2
    read = []
    for source in labelled() if sources is None else sources:
        page = parse(source, marks=True)
        size = [len(t) for t in page.text]
        good = [len(t) * m for t, m in zip(page.text, page.marked)]
        for i in range(len(size) - 1, 0, -1):
            size[page.parent[i]] += size[i]
            good[page.parent[i]] += good[i]
        label = [int(2 * g > s) for g, s in zip(good, size)]
        described = features(page)
        read.append((page, described, label))
        roots[label[0]] += 1
        for i, one in enumerate(described):
            totals[label[i]] += 1
            for f in one:
                counts[f][label[i]] += 1
            if i:
                edges[page.tag[i] == "#text"][label[page.parent[i]]][label[i]] += 1
    feature = {f: 0.5 * (math.log((c[1] + SMOOTHING) / (SMOOTHING + totals[1]))
                         - math.log((c[0] + SMOOTHING) / (SMOOTHING + totals[0])))
               for f, c in counts.items()}
    edge = {k: tuple(tuple(x / sum(row) for x in row) for row in edges[k]) for k in (False, True)}
    model = Model(math.log(roots[1] / roots[0]), feature, edge)
    steps = dict.fromkeys(feature, 1.0)
    for _ in range(epochs):
        for page, described, label in read:
            slope = Counter()
            for one, y, p in zip(described, label, model.marginals(page, described)):
                for f in one:
                    slope[f] += y - p
            for f, g in slope.items():
                steps[f] += g * g
                feature[f] += rate * g / math.sqrt(steps[f])
    return model


def _extractor(shipped: Broadcast):
    @arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shipped.value
        for sources in batches:
            yield pa.array([model.text(s.as_py()) for s in sources], pa.string())

    return run


def main_text(source: Column, model: Model, df: DataFrame) -> Column:
    """The main text of a page of the frame."""
    return _extractor(df.sparkSession.sparkContext.broadcast(model))(source)
