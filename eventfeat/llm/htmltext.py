"""HTML extraction with a tree-structured graphical model.

Every node of a page's block tree (module ``htmltree``) is main text or not.  A node's own
potential comes from its element, the names its author gave it, its text length, share of
links and punctuation; a potential for each kind of parent and child couples neighbours.
One upward and one downward pass of sum-product messages over all pages of a batch give
exact marginals; text runs whose marginal is at least one half are the main text.

Training maximises the conditional likelihood of labelled pages with the same messages.
The pages of the corpus carry no such labels, so the labelled pages are ``TRAIN_PAGES``
made by the generator of ``htmltree`` (fixed seed; held-out accuracy is a test).

Defined results: a null or empty page has no text; broken markup is read as far as it
goes; white space inside a block is one space; blocks are joined by one newline in page
order; repeated rows and null ids are rows of their own; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventfeat.llm.htmltree import HEADINGS, PARTS, Tree, labelled_page, parse

TRAIN_PAGES = 400
STEPS = 120
PAGES_AT_ONCE = 256
_KNOWN = {n: kind for kind, names in PARTS.items() for n in names}
_GROUPS = ("root", "body", "plain", "article", "edge", "list", "p", "heading", "run", "other")
_GROUP_OF = {"root": "root", "html": "body", "body": "body", "div": "plain", "section": "plain", "main": "plain", "td": "plain",
             "article": "article", "nav": "edge", "footer": "edge", "header": "edge", "aside": "edge", "form": "edge",
             "ul": "list", "ol": "list", "li": "list", "p": "p", "#": "run", **dict.fromkeys(HEADINGS, "heading")}


def _features(t: Tree, n: int) -> list[str]:
    """Names of the features of node ``n``."""
    tag, chars = t.tag[n], t.chars[n]
    f = ["bias:" + ("run" if tag == "#" else "node"), "tag:" + tag]
    f += {f"kind:{_KNOWN[x]}" for x in t.names[n] if x in _KNOWN}
    f += {f"name:{x}" for x in t.names[n]}
    share = t.linked[n] / chars if chars else 0.0
    f.append(f"links:{min(4, int(share * 5))}:{'run' if tag == '#' else 'node'}")
    f.append(f"chars:{min(6, int(math.log(chars + 1, 4)))}:{'run' if tag == '#' else 'node'}")
    if tag == "#":
        text = t.text[n]
        f.append(f"marks:{min(3, text.count('.') + text.count(','))}")
        if "©" in text:
            f.append("copyright")
    return f


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    pairs: list  # [group of parent][group of child][y parent][y child]


class Forest:
    """Trees of a batch as arrays: all pages pass their messages together."""

    def __init__(self, trees: list[Tree], index: dict[str, int] | None = None, grow: bool = False):
        import numpy as np

        index = {} if index is None else index
        parent, depth, group, node, feat, label = [], [], [], [], [], []
        self.first = []
        for t in trees:
            base = len(parent)
            self.first.append(base)
            parent += [p + base if p >= 0 else -1 for p in t.parent]
            depth += t.depth
            label += t.label
            group += [_GROUPS.index(_GROUP_OF.get(x, "other")) for x in t.tag]
            for n in range(len(t.tag)):
                for name in _features(t, n):
                    k = index.setdefault(name, len(index)) if grow else index.get(name, -1)
                    if k >= 0:
                        node.append(base + n)
                        feat.append(k)
        self.index = index
        self.parent, self.depth, self.group = np.array(parent, int), np.array(depth, int), np.array(group, int)
        self.node, self.feat, self.label = np.array(node, int), np.array(feat, int), np.array(label, int)
        by_depth = np.argsort(self.depth, kind="stable")
        self.levels = np.split(by_depth, np.cumsum(np.bincount(self.depth))[:-1]) if len(parent) else [by_depth]

    def messages(self, w, pairs):
        """Sum-product: (marginals, pair marginals of each node with its parent)."""
        import numpy as np

        n = len(self.parent)
        up = np.zeros((n, 2))
        up[:, 1] = np.bincount(self.node, w[self.feat], n) if len(self.node) else 0.0
        theta = pairs[self.group[self.parent], self.group]  # row of the root is not used
        sent = np.zeros((n, 2))
        for at in self.levels[:0:-1]:
            sent[at] = np.logaddexp(up[at, None, 0] + theta[at, :, 0], up[at, None, 1] + theta[at, :, 1])
            np.add.at(up, self.parent[at], sent[at])
        full = up.copy()
        both = np.zeros((n, 2, 2))
        for at in self.levels[1:]:
            above = full[self.parent[at]] - sent[at]  # what the parent knows without this child
            joint = above[:, :, None] + theta[at]
            full[at] = up[at] + np.logaddexp(joint[:, 0], joint[:, 1])
            joint = joint + up[at][:, None, :]
            joint -= joint.max(axis=(1, 2), keepdims=True)
            e = np.exp(joint)
            both[at] = e / e.sum(axis=(1, 2), keepdims=True)
        full -= full.max(axis=1, keepdims=True)
        e = np.exp(full)
        return (e / e.sum(axis=1, keepdims=True))[:, 1], both


def truth(t: Tree) -> list[int]:
    """Label of each node of a labelled page: most of its text is main text."""
    good = [c if tag == "#" and y == 1 else 0 for c, tag, y in zip(t.chars, t.tag, t.label)]
    for n in range(len(good) - 1, 0, -1):
        good[t.parent[n]] += good[n]
    return [int(2 * g > c) if c else 0 for g, c in zip(good, t.chars)]


def train(pages: int = TRAIN_PAGES, steps: int = STEPS, seed: int = 7, decay: float = 1e-3) -> Model:
    """Weights by gradient ascent on the conditional likelihood (Adam steps)."""
    import numpy as np

    rng = random.Random(seed)
    trees = [parse(labelled_page(rng), labelled=True) for _ in range(pages)]
    f = Forest(trees, grow=True)
    y = np.concatenate([truth(t) for t in trees])
    inner = np.flatnonzero(f.parent >= 0)
    gp, gc = f.group[f.parent[inner]], f.group[inner]
    g = len(_GROUPS)
    seen_pairs = np.zeros((g, g, 2, 2))
    np.add.at(seen_pairs, (gp, gc, y[f.parent[inner]], y[inner]), 1)
    seen_feats = np.bincount(f.feat, y[f.node], len(f.index))
    w, pairs = np.zeros(len(f.index)), np.zeros((g, g, 2, 2))
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(pairs), np.zeros_like(pairs)]
    for k in range(1, steps + 1):
        p, both = f.messages(w, pairs)
        expected = np.zeros_like(pairs)
        np.add.at(expected, (gp, gc), both[inner])
        grads = ((seen_feats - np.bincount(f.feat, p[f.node], len(w))) / len(y) - decay * w,
                 (seen_pairs - expected) / len(y) - decay * pairs)
        for i, (x, d) in enumerate(zip((w, pairs), grads)):
            m, v = moments[2 * i], moments[2 * i + 1]
            m += 0.1 * (d - m)
            v += 0.01 * (d * d - v)
            x += 0.15 * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.99 ** k)) + 1e-8)
    return Model({name: float(w[i]) for name, i in f.index.items()}, pairs.tolist())


def extract(trees: list[Tree], model: Model) -> list[str]:
    """Main text of each page."""
    import numpy as np

    index = {name: i for i, name in enumerate(model.weights)}
    f = Forest(trees, index)
    p, _ = f.messages(np.array([*model.weights.values()]), np.array(model.pairs))
    out = []
    for t, base in zip(trees, f.first):
        out.append("\n".join(t.text[n] for n in range(len(t.tag)) if t.tag[n] == "#" and p[base + n] >= 0.5))
    return out


def _extracted(model: Model):
    def run(batches) -> Iterator:
        import pyarrow as pa

        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])
        for b in batches:
            for k in range(0, b.num_rows, PAGES_AT_ONCE):
                some = b.slice(k, PAGES_AT_ONCE)
                texts = extract([parse(h) for h in some.column(2).to_pylist()], model)
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1).cast(pa.string()), pa.array(texts, pa.string())], schema=schema)

    return run


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                 model: Model | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` per row of ``pages``."""
    d = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                     F.col(html_col).cast("string").alias("html"))
    return d.mapInArrow(_extracted(model or train()), "page_id long, url string, text string").withColumn(
        "n_chars", F.length("text").cast("long"))
