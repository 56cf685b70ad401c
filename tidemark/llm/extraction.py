"""Main text of HTML pages by minimum cuts.

A page is a graph of its text blocks. A classifier's cost of calling a block content or
boilerplate becomes its capacity from the source and to the sink; blocks that follow each
other, and blocks of one parent, are joined by smoothness edges that weaken with their
distance in the document tree. The blocks on the source's side of a minimum cut, found by
maximum flow, are the main text.

The classifier is a logistic regression on what a block's text looks like. It is fitted on
pages whose markup says what is what (article and main against nav, footer and the like);
that markup then counts as a cost of its own, on the pages that have it. Names of elements
(class, id, role) are weaker evidence: they cost less than the classifier can make up for, and
weaken the smoothness edges across their bounds; those of readers' comments cost more.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import by_bytes, table
from tidemark.llm.html_blocks import Block, page_blocks

#: Pages that the classifier is fitted on: those with the least hash of their html.
SAMPLE_PAGES = 1000
BATCH_BYTES = 4 << 20
#: Costs in units of log odds: of markup that names content or something else, and of
#: cutting between neighbours in page order and between blocks of one parent.
MAIN_COST = 6.0
OTHER_COST = 14.0
#: Of a name that tells of something else: half of `CLIP`, so that what the text looks like can outweigh it.
NAME_COST = 1.5
#: Of a name that tells of readers' comments: more than what the text looks like makes up for.
COMMENT_COST = 8.0
#: What is left of a smoothness edge between a block under such a name and one that is not.
NAME_EDGE = 0.25
NEXT_COST = 1.0
PARENT_COST = 1.5
CLIP = 3.0
#: Capacities are whole numbers, in these parts of a unit.
SCALE = 1000

FEATURES = 9


def features(block: Block, place: float) -> list[float]:
    """What the text looks like, without a look at the markup around it."""
    text = block.text
    words = text.split(" ")
    return [
        1.0,
        min(1.0, block.linked / len(text)),
        np.log1p(len(words)),
        min(20.0, len(text) / len(words)),
        float(text[-1] in ".!?:;…。\"'”»)"),
        min(1.0, sum(map(text.count, ".,;:!?")) / len(words)),
        sum(word[:1].isupper() for word in words) / len(words),
        float(block.tag in ("li", "td", "th", "dt", "dd")),
        place,
    ]


def page_features(blocks: list[Block]) -> np.ndarray:
    last = max(1, len(blocks) - 1)
    return np.array([features(b, abs(2 * k / last - 1)) for k, b in enumerate(blocks)])


def fit(rows: np.ndarray, content: np.ndarray, rounds: int = 12, ridge: float = 1.0) -> np.ndarray:
    """Weights of a ridge logistic regression, by Newton's method, both classes weighing alike."""
    weights = np.zeros(FEATURES)
    n = max(1, len(content))
    share = content.mean() if len(content) else 0.5
    if share in (0.0, 1.0):
        return weights
    balance = np.where(content, 0.5 / share, 0.5 / (1 - share)) * min(1.0, 2000 / n)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        slope = rows.T @ (balance * (content - p)) - ridge * weights
        curve = (rows * (balance * p * (1 - p))[:, None]).T @ rows + ridge * np.eye(FEATURES)
        weights = weights + np.linalg.solve(curve, slope)
    return weights


def train(pages: DataFrame, sample: int = SAMPLE_PAGES) -> np.ndarray:
    """Weights from at most `sample` pages, the same ones on every run."""
    hashed = pages.filter("html IS NOT NULL").select("html", F.xxhash64("html").alias("h"))
    least = hashed.select("h").distinct().orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    chosen = hashed.filter(F.col("h") <= F.lit(least)).dropDuplicates(["h"]).select("html")

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "html", BATCH_BYTES):
            rows, labels = [], []
            for html in batch.column("html").to_pylist():
                blocks = page_blocks(html)
                for row, block in zip(page_features(blocks), blocks, strict=False):
                    if block.in_named and block.in_main and not block.in_other:
                        continue  # may be either
                    if block.in_main or block.in_other or block.in_named:
                        rows.append(row.tolist())
                        labels.append(block.in_main and not block.in_other)
            yield pa.record_batch(
                [pa.array(rows, pa.list_(pa.float64())), pa.array(labels, pa.bool_())], ["x", "y"]
            )

    found = chosen.mapInArrow(weigh, "x array<double>, y boolean").collect()
    rows = np.array([row["x"] for row in found]).reshape(-1, FEATURES)
    return fit(rows, np.array([row["y"] for row in found], dtype=bool))


def maximum_flow(
    source: list[int], sink: list[int], edges: list[tuple[int, int, int]]
) -> list[bool]:
    """For each node whether it is on the source's side of the least minimum cut.

    `source` and `sink` are terminal capacities, `edges` (a, b, capacity) join nodes both
    ways. Dinic's method: flow is sent along shortest paths, level graph by level graph.
    """
    n = len(source)
    s, t = n, n + 1
    graph: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    room: list[int] = []

    def join(a: int, b: int, forth: int, back: int) -> None:
        graph[a].append(len(to))
        to.append(b)
        room.append(forth)
        graph[b].append(len(to))
        to.append(a)
        room.append(back)

    for node in range(n):
        direct = min(source[node], sink[node])  # flows straight through
        if source[node] > direct:
            join(s, node, source[node] - direct, 0)
        if sink[node] > direct:
            join(node, t, sink[node] - direct, 0)
    for a, b, capacity in edges:
        if capacity:
            join(a, b, capacity, capacity)

    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = deque([s])
        while queue:
            a = queue.popleft()
            for e in graph[a]:
                if room[e] and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[t] < 0:
            return [level[node] >= 0 for node in range(n)]
        place = [0] * (n + 2)
        path: list[int] = []
        a = s
        while True:
            if a == t:
                least = min(room[e] for e in path)
                for e in path:
                    room[e] -= least
                    room[e ^ 1] += least
                cut = next(k for k, e in enumerate(path) if not room[e])
                a = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while place[a] < len(graph[a]):
                e = graph[a][place[a]]
                if room[e] and level[to[e]] == level[a] + 1:
                    break
                place[a] += 1
            if place[a] < len(graph[a]):
                path.append(graph[a][place[a]])
                a = to[path[-1]]
            elif path:
                e = path.pop()
                a = to[e ^ 1]
                place[a] += 1
            else:
                break


def tree_distance(a: tuple[int, ...], b: tuple[int, ...]) -> int:
    """Steps between two places of the document tree."""
    common = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        common += 1
    return len(a) + len(b) - 2 * common


def label(blocks: list[Block], weights: np.ndarray) -> list[bool]:
    """For each block whether it is content."""
    if not blocks:
        return []
    odds = np.clip(page_features(blocks) @ weights, -CLIP, CLIP)
    some_main = any(b.in_main and not b.in_other for b in blocks)
    for k, block in enumerate(blocks):
        if block.in_other:
            odds[k] -= OTHER_COST
        elif block.in_comments:
            odds[k] -= COMMENT_COST
        elif block.in_named:
            odds[k] -= NAME_COST if block.in_main or not some_main else NAME_COST + MAIN_COST
        elif some_main:
            odds[k] += MAIN_COST if block.in_main else -MAIN_COST
    source = [max(0, round(SCALE * x)) for x in odds.tolist()]
    sink = [max(0, round(-SCALE * x)) for x in odds.tolist()]
    edges = []

    def join(a: int, b: int, cost: float) -> None:
        across = blocks[a].in_named != blocks[b].in_named
        edges.append((a, b, round(SCALE * cost * (NAME_EDGE if across else 1.0))))

    of_parent: dict[tuple[int, ...], int] = {}
    for k, block in enumerate(blocks):
        if k:
            steps = tree_distance(blocks[k - 1].path, block.path)
            join(k - 1, k, NEXT_COST * 2.0 ** (1 - max(1, steps / 2)))
        parent = block.path[:-1]
        if parent in of_parent:
            join(of_parent[parent], k, PARENT_COST)
        of_parent[parent] = k
    return maximum_flow(source, sink, edges)


def main_text(html: str | None, weights: np.ndarray) -> str:
    """Content blocks joined by an empty line; empty if there are none."""
    blocks = page_blocks(html)
    return "\n\n".join(b.text for b, keep in zip(blocks, label(blocks, weights), strict=True) if keep)


def extract(pages: DataFrame, weights: np.ndarray | None = None) -> DataFrame:
    """page_id, url, text, n_chars for every row of pages; other columns are not read.

    Null and empty pages have an empty text. Rows are judged one by one, so repeated ids
    and rows are fine. The graph of a page has at most two edges per block, so its size
    and the flow's memory grow with the page alone. Without `weights` they are fitted here.
    """
    if weights is None:
        weights = train(pages)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "html", BATCH_BYTES):
            texts = [main_text(html, weights) for html in batch.column("html").to_pylist()]
            yield pa.record_batch(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(text) for text in texts], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    kinds = dict(pages.dtypes)
    return pages.select("page_id", "url", "html").mapInArrow(
        read, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    )


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
