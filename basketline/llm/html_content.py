"""Main text of web pages by a tree-structured graphical model over DOM nodes."""

from __future__ import annotations

import math
import random
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketline.llm.html_tree import Tree, labelled_page, names, parse

EDGES = ("#text", "block")  # kinds of children with potentials of their own


@lru_cache(maxsize=200_000)
def element_features(tag: str, attrs: str) -> tuple[str, ...]:
    return (f"tag={tag}", *[f"name={w}" for w in names(attrs)])


def run_features(size: int, linked: int, parent: str) -> tuple[str, ...]:
    """Features of a run of text: its length, the share of links, and the element around it."""
    share = 0 if not linked else 1 if 2 * linked < size else 2 if linked < size else 3
    return (f"size={min(size.bit_length(), 9)}", f"links={share}", f"in={parent}")


def node_features(tree: Tree) -> list[tuple[str, ...]]:
    return [
        run_features(len(tree.text[i]), tree.linked[i], tree.tag[tree.parent[i]]) if t == "#text" else element_features(t, tree.attrs[i])
        for i, t in enumerate(tree.tag)
    ]


class TreeModel:
    """Pages as trees of binary nodes, content or not.

    A node has a weight for each of its features; an edge has one of two potentials for each pair of
    states, for text runs and for elements. Marginals come from sum-product messages from the leaves
    up and from the root down, in log-odds.
    """

    def __init__(self) -> None:
        self.weights: dict[str, float] = {}
        # log potentials [parent state][child state] by kind of child
        self.edges = {kind: [[0.5, -0.5], [-0.5, 0.5]] for kind in EDGES}

    def messages(self) -> dict[str, tuple]:
        return {kind: tuple(math.exp(x) for row in e for x in row) for kind, e in self.edges.items()}

    def marginals(self, parent: list[int], kinds: list[str], unary: list[float], pairs: bool = False):
        """Log-odds of content for each node; with ``pairs`` also what the learning needs of each edge."""
        psi = self.messages()
        n = len(parent)
        up = list(unary)
        message = [0.0] * n
        for i in range(n - 1, 0, -1):
            p00, p01, p10, p11 = psi[kinds[i]]
            e = math.exp(max(-30.0, min(30.0, up[i])))
            message[i] = math.log((p10 + p11 * e) / (p00 + p01 * e))
            up[parent[i]] += message[i]
        belief = list(up)
        without = [0.0] * n
        for i in range(1, n):
            p00, p01, p10, p11 = psi[kinds[i]]
            x = belief[parent[i]] - message[i]
            without[i] = x
            e = math.exp(max(-30.0, min(30.0, x)))
            belief[i] = up[i] + math.log((p01 + p11 * e) / (p00 + p10 * e))
        return (belief, up, without) if pairs else belief

    def score(self, features: tuple[str, ...]) -> float:
        w = self.weights
        return sum([w.get(f, 0.0) for f in features])

    def fit(self, pages: list[tuple[Tree, list[int]]], rounds: int = 8, lot: int = 25, rate: float = 0.3, decay: float = 1e-4) -> TreeModel:
        """Maximum likelihood by gradient steps over lots of pages: observed less expected counts of
        features and edges, with a step size of its own for each."""
        ready = []
        for tree, labels in pages:
            kinds = ["#text" if t == "#text" else "block" for t in tree.tag]
            ready.append((tree.parent, kinds, node_features(tree), labels))
        speed: dict = {}
        for at in [a for _ in range(rounds) for a in range(0, len(ready), lot)]:
            some = ready[at : at + lot]
            total = sum(len(x[0]) for x in some)
            grad: dict[str, float] = {}
            edge = {kind: np.zeros((2, 2)) for kind in EDGES}
            for parent, kinds, features, labels in some:
                unary = [self.score(f) for f in features]
                belief, up, without = self.marginals(parent, kinds, unary, pairs=True)
                for f, b, y in zip(features, belief, labels):
                    d = y - 1 / (1 + math.exp(-max(-30.0, min(30.0, b))))
                    for name in f:
                        grad[name] = grad.get(name, 0.0) + d
                for i in range(1, len(parent)):
                    e = self.edges[kinds[i]]
                    joint = [[e[a][b] + a * without[i] + b * up[i] for b in (0, 1)] for a in (0, 1)]
                    top = max(map(max, joint))
                    p = np.exp(np.array(joint) - top)
                    edge[kinds[i]] -= p / p.sum()
                    edge[kinds[i]][labels[parent[i]], labels[i]] += 1
            for name, g in grad.items():
                g = g / total - decay * self.weights.get(name, 0.0)
                speed[name] = speed.get(name, 0.0) + g * g
                self.weights[name] = self.weights.get(name, 0.0) + rate * g / math.sqrt(speed[name] + 1e-12)
            for kind, g in edge.items():
                for a in (0, 1):
                    for b in (0, 1):
                        d = g[a, b] / total
                        key = (kind, a, b)
                        speed[key] = speed.get(key, 0.0) + d * d
                        self.edges[kind][a][b] += rate * float(d) / math.sqrt(speed[key] + 1e-12)
        return self


_LABEL = re.compile(r'\s*data-y="?([01])"?')


def labelled(page: str) -> tuple[Tree, list[int]]:
    """A page with data-y attributes as a tree without them and the label of every node."""
    tree = parse(page)
    labels: list[int] = []
    for i, attrs in enumerate(tree.attrs):
        found = _LABEL.search(attrs)
        labels.append(int(found.group(1)) if found else labels[tree.parent[i]] if i else 0)
        tree.attrs[i] = _LABEL.sub("", attrs).strip()
    return tree, labels


def trained(pages: int = 500, seed: int = 7) -> TreeModel:
    """A model learned from made-up labelled pages."""
    rng = random.Random(seed)
    return TreeModel().fit([labelled(labelled_page(rng)) for _ in range(pages)])


def content(page: str, model: TreeModel) -> str:
    """The runs of text that are likelier content than not, two line ends apart."""
    tree = parse(page)
    kinds = ["#text" if t == "#text" else "block" for t in tree.tag]
    belief = model.marginals(tree.parent, kinds, [model.score(f) for f in node_features(tree)])
    return "\n\n".join([t for t, b in zip(tree.text, belief) if t and b >= 0])


def main_texts(pages: DataFrame, model: TreeModel | None = None) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    The whole html is read into a tree of elements and runs of text; a tree model (``trained`` unless
    one is given) yields the marginal of each run being content. A run is the text between two
    block borders with single spaces. Null and empty html gives an empty text. Every row counts,
    repeated ones and those without page_id or url too; other columns are not looked at. Pages of
    any length are read in linear time, one at a time.
    """
    model = model or trained()

    def run(batches):
        for batch in batches:
            texts = [content(x, model) if x else "" for x in (v.as_py() for v in batch.column("html"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
