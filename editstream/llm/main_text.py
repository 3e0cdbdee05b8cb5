"""Main text of HTML pages: a graphical model over each page's tree, solved by message passing."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editstream.llm.bpe import chunks
from editstream.llm.common import python_path, table
from editstream.llm.labelled_pages import labelled_pages
from editstream.llm.page_trees import KIND, SIZES, Trees

TRAINING_PAGES = 500
CHUNK_BYTES = 2_000_000
STEPS = 60
PRIOR = 1.0


def log_sum(a: np.ndarray) -> np.ndarray:
    """Over the last axis, of two."""
    return np.logaddexp(a[..., 0], a[..., 1])


@dataclass(frozen=True)
class TreeModel:
    """Is a node main text (1) or not (0)? A conditional random field over the trees.

    Log-potentials: ``start[label]`` of roots; ``edge[role, parent's label, label]`` between parent and
    child, by the child's kind and what its names say; ``seen[feature][kind, value, label]`` of what a
    node shows.
    """

    start: np.ndarray
    edge: np.ndarray
    seen: list[np.ndarray]

    @classmethod
    def fit(cls, pages: Iterable[str], steps: int = STEPS, rate: float = 0.2, prior: float = PRIOR) -> TreeModel:
        """Potentials from labelled pages: elements with ``data-main="1"`` are main text with all
        they hold, but for elements in them with ``data-main="0"``.

        Gradient ascent of the labels' log-likelihood, with a normal prior on every potential: the
        gradient is what the labels count less what the marginals of nodes and edges expect.
        """
        trees = Trees()
        for number, html in enumerate(pages):
            trees.add(number, html)
        model = cls(
            np.zeros(2), np.zeros((len(KIND) * 3, 2, 2)), [np.zeros((len(KIND), n, 2)) for n in SIZES]
        )
        if not trees.parent:
            return model
        kind, parent, label = (np.array(x, dtype=np.int64) for x in (trees.kind, trees.parent, trees.label))
        root, child = np.flatnonzero(parent < 0), np.flatnonzero(parent >= 0)
        features, roles = trees.features(), trees.roles()
        truth = np.eye(2)[label]
        pairs = truth[parent[child]][:, :, None] * truth[child][:, None, :]
        weights = [model.start, model.edge, *model.seen]
        slope = [np.zeros_like(w) for w in weights]
        scale = [np.zeros_like(w) for w in weights]
        for step in range(1, steps + 1):
            nodes, edges = model.expected(trees, features)
            missed = truth - nodes
            gradient = [-prior * w for w in weights]
            gradient[0] += missed[root].sum(axis=0)
            np.add.at(gradient[1], roles[child], pairs - edges)
            for g, values in zip(gradient[2:], features):
                np.add.at(g, (kind, values), missed)
            for w, g, m, v in zip(weights, gradient, slope, scale):  # Adam
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        return model

    def _messages(self, trees: Trees, features: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Messages up to the roots, then down. Returns the nodes' beliefs; what each node knew from
        below; and what it told its parent."""
        kind, parent = (np.array(x, dtype=np.int64) for x in (trees.kind, trees.parent))
        edge, levels = self.edge[trees.roles()], trees.levels()
        below = sum(table[kind, values] for table, values in zip(self.seen, features))
        below[levels[0]] += self.start
        up = np.zeros_like(below)
        for level in levels[:0:-1]:
            up[level] = log_sum(edge[level] + below[level][:, None, :])
            np.add.at(below, parent[level], up[level])
        belief = below.copy()
        for level in levels[1:]:
            above = belief[parent[level]] - up[level]
            belief[level] += log_sum((edge[level] + above[:, :, None]).transpose(0, 2, 1))
        return belief, below, up

    def expected(self, trees: Trees, features: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Marginals of the labels of nodes, and of parent and child."""
        belief, below, up = self._messages(trees, features)
        parent = np.array(trees.parent, dtype=np.int64)
        child = np.flatnonzero(parent >= 0)
        above = belief[parent[child]] - up[child]
        joint = self.edge[trees.roles()[child]] + above[:, :, None] + below[child][:, None, :]
        joint -= log_sum(log_sum(joint))[:, None, None]
        return np.exp(belief - log_sum(belief)[:, None]), np.exp(joint)

    def marginals(self, trees: Trees) -> np.ndarray:
        """The probability of main text for every node."""
        if not trees.parent:
            return np.zeros(0)
        belief, _, _ = self._messages(trees, trees.features())
        return np.exp(belief[:, 1] - log_sum(belief))


@cache
def default_model() -> TreeModel:
    return TreeModel.fit(labelled_pages(TRAINING_PAGES))


def main_texts(pages: list[str], model: TreeModel) -> list[str]:
    trees = Trees()
    for number, html in enumerate(pages):
        trees.add(number, html)
    kept: list[list[str]] = [[] for _ in pages]
    sure = model.marginals(trees)[np.array(trees.leaves, dtype=np.int64)] >= 0.5
    for page, text, keep in zip(trees.page, trees.texts, sure.tolist()):
        if keep:
            kept[page].append(text)
    return ["\n\n".join(found) for found in kept]


def extract(
    pages: DataFrame, id_col: str = "page_id", html_col: str = "html", model: TreeModel | None = None
) -> DataFrame:
    """``id, url`` (if there is one), ``text`` and ``n_chars`` of every page's main text.

    ``model`` is fitted on the driver, by default on ``TRAINING_PAGES`` made pages that carry labels
    (a fixed bound), and goes to the tasks with the function: a few KB. Every node of a page is an element
    or a run of text between block elements; a run counts as main text if its marginal probability
    is a half or more. Runs come in page order, white space in them as one space. Nothing is cut:
    pages are read whole, however long. A null or empty page, or one without main text, gives an
    empty text; repeated rows stay repeated; an empty table gives no rows. Other columns are dropped.
    """
    python_path(pages.sparkSession)
    fitted = model or default_model()
    url = pages["url"] if "url" in pages.columns else F.lit(None).cast("string")
    rows = pages.select(
        pages[id_col].alias("page_id"),
        url.alias("url"),
        F.coalesce(pages[html_col], F.lit("")).alias("html"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "html", CHUNK_BYTES):
                texts = main_texts(part.column("html").to_pylist(), fitted)
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string())],
                    names=["page_id", "url", "text"],
                )

    kind = rows.schema["page_id"].dataType.simpleString()
    found = rows.mapInArrow(run, f"page_id {kind}, url string, text string")
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
