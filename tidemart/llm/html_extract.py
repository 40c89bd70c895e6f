"""Main text of web pages: flat text blocks classified by a decision tree.

A block is described by its word count and link density, those of its neighbours, and where it
stands in the page. The tree is trained, each time a job is planned, on a small labelled table
of blocks cut from pages that :func:`labelled_pages` lays out by rule.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.html_blocks import IN_APART, IN_MAIN, Block, text_blocks

FEATURES = (
    "words",
    "link_density",
    "previous_words",
    "previous_link_density",
    "next_words",
    "next_link_density",
    "in_main",
    "set_apart",
    "heading",
    "page_has_main",
)
MAX_DEPTH = 8

Tree = bool | tuple[int, float, "Tree", "Tree"]


def features(blocks: list[Block]) -> list[tuple[float, ...]]:
    """A row of ``FEATURES`` for each block of a page."""
    own = [(b.words, b.link_words / b.words) for b in blocks]
    around = [(0, 0.0), *own, (0, 0.0)]
    has_main = float(any(b.place == IN_MAIN for b in blocks))
    return [
        (*own[i], *around[i], *around[i + 2], b.place == IN_MAIN, b.place >= IN_APART, b.heading, has_main)
        for i, b in enumerate(blocks)
    ]


def labelled_pages() -> Iterator[str]:
    """Pages whose blocks begin with ``+`` if they are main text and with ``-`` if not."""

    def words(n: int, sign: str) -> str:
        return " ".join([sign, *["word"] * (n - 1)])

    def linked(n: int, sign: str) -> str:
        return f"<a href='/'>{words(n, sign)}</a>"

    menu = "".join(f"<li>{linked(n, '-')}</li>" for n in (1, 1, 2, 3))
    tops = (
        "",
        f"<nav><ul>{menu}</ul></nav>",
        f"<header><div>{words(3, '-')}</div><ul>{menu}</ul></header>",
        f"<ul>{menu}</ul><div class='cookie-notice'>{words(25, '-')}</div>",
        f"<div class='ad'>{words(12, '-')}</div><div id='banner'>{words(60, '-')}</div>",
    )
    bottoms = (
        "",
        f"<footer>{words(9, '-')}</footer>",
        f"<aside><h3>{words(2, '-')}</h3><p>{words(30, '-')}</p></aside><footer>{words(40, '-')}</footer>",
        f"<section id='comments'><h2>{words(1, '-')}</h2><article><p>{words(35, '-')}</p></article>"
        f"<p>{words(90, '-')}</p></section>",
        f"<form><p>{words(8, '-')}</p></form><ul>{menu}</ul><div class='share'>{linked(4, '-')}</div>",
    )
    asides = ("", f"<div class='promo'>{words(20, '-')}</div>", f"<aside><p>{words(55, '-')}</p></aside>")
    bodies = ((120, 80, 60), (1, 45, 2), (7,), (2, 1, 1), (30, 5, 200, 14))
    frames = ("<article>{}</article>", "<main>{}</main>", "<div class='content'>{}</div>")
    for top, bottom, aside, body, frame in product(tops, bottoms, asides, bodies, frames):
        text = "".join(f"<p>{words(n, '+')}</p>" for n in body)
        item = f"<ul><li>{linked(3, '+')}</li><li>{words(4, '+')}</li></ul>"
        main = f"<h1>{words(6, '+')}</h1>{text}{aside}{item}<h2>{words(3, '+')}</h2><p>{words(25, '+')}</p>"
        yield f"<body>{top}{frame.format(main)}{bottom}</body>"
    # Without a marked main part only length, links and neighbours tell.
    crumbs = f"<div>{linked(2, '-')}</div><div>{words(2, '-')}</div><div>{linked(1, '-')}</div>"
    ends = f"<div>{linked(3, '-')}</div><div>{words(4, '-')}</div><div>{linked(2, '-')}</div>"
    bodies = ((120, 80, 12, 90), (1, 40, 2, 25, 60), (7, 3), (1,), (15, 1, 1, 200))
    for top, bottom, body in product(("", crumbs, *tops), ("", ends, *bottoms), bodies):
        text = "".join(f"<p>{words(n, '+')}</p>" for n in body)
        yield f"<body>{top}<div><p>{words(22, '+')}</p>{text}<p>{words(18, '+')}</p></div>{bottom}</body>"
    for n in (1, 2, 5, 9, 30):
        yield words(n, "+")


def labelled_table() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the blocks of all labelled pages."""
    rows, labels = [], []
    for page in labelled_pages():
        blocks = text_blocks(page)
        rows += features(blocks)
        labels += [b.text[0] == "+" for b in blocks]
    return np.array(rows, float), np.array(labels)


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = MAX_DEPTH) -> Tree:
    """A binary decision tree by least Gini impurity; equal splits go to the first feature."""
    positive = int(labels.sum())
    if depth == 0 or positive in (0, len(labels)):
        return 2 * positive >= len(labels)
    best = None
    for feature in range(rows.shape[1]):
        order = np.argsort(rows[:, feature], kind="stable")
        values, hits = rows[order, feature], np.cumsum(labels[order])
        cuts = np.flatnonzero(values[1:] > values[:-1])
        if not len(cuts):
            continue
        left, right = cuts + 1, len(labels) - cuts - 1
        in_left, in_right = hits[cuts], positive - hits[cuts]
        impurity = in_left * (left - in_left) / left + in_right * (right - in_right) / right
        at = int(np.argmin(impurity))
        if best is None or impurity[at] < best[0] - 1e-9:
            best = (float(impurity[at]), feature, float(values[cuts[at]] + values[cuts[at] + 1]) / 2)
    if best is None:
        return 2 * positive >= len(labels)
    _, feature, threshold = best
    low = rows[:, feature] <= threshold
    return feature, threshold, grow(rows[low], labels[low], depth - 1), grow(rows[~low], labels[~low], depth - 1)


def trained_tree() -> Tree:
    """The tree of the labelled table."""
    return grow(*labelled_table())


def decide(tree: Tree, row: tuple[float, ...]) -> bool:
    """Whether a block with these features is main text."""
    while not isinstance(tree, bool | np.bool_):
        feature, threshold, low, high = tree
        tree = low if row[feature] <= threshold else high
    return bool(tree)


def main_text(source: str, tree: Tree) -> str:
    """The main blocks of a page, one a line."""
    blocks = text_blocks(source)
    return "\n".join([b.text for b, row in zip(blocks, features(blocks), strict=True) if decide(tree, row)])


def extract(
    pages: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ("url",)
) -> DataFrame:
    """``(page_id, *keep, text)``, one row per input row.

    White space within a block is one space; blocks are joined by one line feed in page order. A null
    or empty page, and one without main text, gives an empty text. Columns in ``keep`` are passed
    on as they are, all others ignored.
    """
    tree = trained_tree()

    @F.pandas_udf("string")
    def extracted(sources):
        return sources.map(lambda source: main_text(source or "", tree))

    return pages.select(F.col(id_col).alias("page_id"), *keep, extracted(F.col(html_col)).alias("text"))
