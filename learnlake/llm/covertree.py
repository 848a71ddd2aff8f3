"""Exact search for the largest inner products with two cover trees.

Rows and queries of a grid cell are each put into a cover tree: a node has a centre and a radius that covers all vectors
below it, and its children's centres lie far apart. A pair of nodes is dropped when no vector under the one can reach
the worst kept score of any query under the other: centre times centre plus what the two radii can add.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnlake.llm import vectors
from learnlake.session import written

LEAF = 64  # rows a lowest node has on average
EXACT = 2.0**53  # sums of products below this are exact in doubles
FAR = 2.0**400  # components beyond this have no squared distance in doubles; they are compared without a tree


@dataclass
class Node:
    """A centre, which is one of the rows, at a level: everything below lies within ``radius``."""

    point: int
    level: int
    at: np.ndarray  # rows below the node
    centre: np.ndarray
    norm: float
    radius: float
    children: list["Node"]


def _gaps(x: np.ndarray, point: int) -> np.ndarray:
    return np.sqrt(((x - x[point]) ** 2).sum(axis=1))


def net(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centres by farthest-first traversal, the level of each, and the nearest centre (its place) of every row.

    A centre's level is the greatest i with 2**i below its distance to the centres before it. So the centres of level i and
    above are more than 2**i apart, and every centre is within 2**i of one of them. The first one is above all levels.
    """
    points, levels, owner = [0], [np.inf], np.zeros(len(x), int)
    nearest = _gaps(x, 0)
    while len(points) < max(1, len(x) // LEAF):
        pick = int(nearest.argmax())
        if nearest[pick] == 0:
            break
        levels.append(float(np.ceil(np.log2(nearest[pick])) - 1))
        gap = _gaps(x, pick)
        owner[gap < nearest] = len(points)
        nearest = np.minimum(nearest, gap)
        points.append(pick)
    return np.array(points), np.array(levels), owner


def build(x: np.ndarray) -> Node:
    """A cover tree down to its lowest centres, each with the rows that are nearest to it.

    Levels nest (a node's first child has its point), cover (a child's point is within 2**level of its parent's) and
    separate (points of a level are more than 2**level apart). Levels at which a node has no new child are left out.
    """
    points, levels, owner = net(x)
    below: dict[int, list[int]] = {}  # place of a centre -> places of the centres hung below it, highest first
    for k in np.argsort(-levels, kind="stable")[1:]:
        higher = np.flatnonzero(levels > levels[k])
        parent = higher[((x[points[higher]] - x[points[k]]) ** 2).sum(axis=1).argmin()]
        below.setdefault(int(parent), []).append(int(k))
    order = np.argsort(owner, kind="stable")
    edges = np.searchsorted(owner[order], np.arange(len(points) + 1))

    def node(k: int, level: float, at: np.ndarray, children: list[Node]) -> Node:
        centre = x[points[k]]
        gap = np.sqrt(((x[at] - centre) ** 2).sum(axis=1))
        return Node(int(points[k]), int(level), at, centre, float(np.sqrt(centre @ centre)), float(gap.max()), children)

    made: dict[int, Node] = {}
    for k in np.argsort(levels, kind="stable"):  # lowest first, so that what hangs below a centre is there
        own = node(k, levels[below[k][-1]] if k in below else (levels[k] if k else 0), order[edges[k]: edges[k + 1]], [])
        hung = below.get(int(k), [])
        for level in sorted({levels[c] for c in hung}):
            new = [made[c] for c in hung if levels[c] == level]
            own = node(k, level + 1, np.concatenate([own.at, *[c.at for c in new]]), [own, *new])
        made[int(k)] = own
    return made[0]


def _leaves(at: np.ndarray) -> list[np.ndarray]:
    return [at[i: i + 4 * LEAF] for i in range(0, len(at), 4 * LEAF)]


def whole(x: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` (a power of two) as doubles where these are exact, else as integers of any size."""
    if np.abs(x).max(initial=0) < EXACT / scale:
        return np.floor(x * scale)
    flat = [int(v) * scale if abs(v) >= EXACT else int(np.floor(v * scale)) for v in x.ravel().tolist()]
    return np.array(flat, object).reshape(x.shape)


def products(x: np.ndarray, y: np.ndarray, plain: bool) -> np.ndarray:
    """Integer inner products; in doubles where these are exact, else in Python's integers."""
    if plain:
        return x @ y.T
    wide = np.frompyfunc(int, 1, 1)
    return wide(x) @ wide(y).T


def dual(x: np.ndarray, ids: np.ndarray, q: np.ndarray, own: np.ndarray, top: int) -> list[tuple[int, int, int]]:
    """``(query id, row id, score)`` of the ``top`` rows of each query, without rows of its own id."""
    tops = [max((abs(v) for v in a.ravel().tolist()), default=0) for a in (x, q)]
    plain = x.dtype != object and q.dtype != object and tops[0] * tops[1] * x.shape[1] < EXACT
    kept: list[list[tuple]] = [[] for _ in q]  # (-score, id), best first
    worst = np.full(len(q), -np.inf, float if plain else object)

    def bound(a: Node, b: Node) -> float:
        reach = float(a.centre @ b.centre) + a.norm * b.radius + b.norm * a.radius + a.radius * b.radius
        return reach + 1e-9 * (a.norm + a.radius) * (b.norm + b.radius) + 1e-6

    def compare(qs: np.ndarray, xs: np.ndarray) -> None:
        score = products(q[qs], x[xs], plain)
        good = (score >= worst[qs][:, None]) & (own[qs][:, None] != ids[xs])
        for k in np.flatnonzero(good.any(axis=1)):
            i, at = qs[k], np.flatnonzero(good[k])
            if plain and len(at) > top:
                at = at[np.lexsort((ids[xs[at]], -score[k, at]))[:top]]
            merged = kept[i] + [(-int(score[k, j]), int(ids[xs[j]])) for j in at]
            merged.sort()
            kept[i] = merged[:top]
            if len(kept[i]) == top:
                worst[i] = -kept[i][-1][0]

    if max(tops) > FAR:
        for qs in _leaves(np.arange(len(q))):
            for xs in _leaves(np.arange(len(x))):
                compare(qs, xs)
        return _rows(kept, own)
    root_q, root_x = build(q.astype(np.float64)), build(x.astype(np.float64))
    stack = [(bound(root_q, root_x), root_q, root_x)]
    while stack:
        most, a, b = stack.pop()
        if most < worst[a.at].min():
            continue
        if not a.children and not b.children:
            for qs in _leaves(a.at):
                for xs in _leaves(b.at):
                    compare(qs, xs)
        elif b.children and (not a.children or b.radius >= a.radius):
            stack += sorted(((bound(a, c), a, c) for c in b.children), key=lambda t: t[0])
        else:
            stack += sorted(((bound(c, b), c, b) for c in a.children), key=lambda t: t[0])
    return _rows(kept, own)


def _rows(kept: list[list[tuple]], own: np.ndarray) -> list[tuple[int, int, int]]:
    low, high = -(1 << 63), (1 << 63) - 1
    return [(int(own[i]), j, min(max(-s, low), high)) for i, found in enumerate(kept) for s, j in found]


def _cell(top: int, scale: int):
    def run(block: pa.Table, asking: pa.Table, dim: int) -> dict:
        x, q = (whole(vectors.matrix(t["embedding"], dim), scale) for t in (block, asking))
        found = dual(x, block["vec_id"].to_numpy(), q, asking["vec_id"].to_numpy(), top)
        return {name: [f[i] for f in found] for i, name in enumerate(("query_id", "vec_id", "score"))}

    return run


def largest(embeddings: DataFrame, asks: int, top: int = 5, scale: int = 256) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``top`` inner products of each row whose id is divisible by ``asks``.

    Components become ``floor(scale * x)``. Ties go to the smaller id. A repeated id asks once, by the smallest of its vectors, and each of its rows is a
    candidate of others; rows with the query's own id are not its candidates. Rows with a NULL id, and vectors that are
    NULL, empty or hold a NULL or non-finite component, take no part; an empty table gives no rows; a query with fewer
    candidates gets them all. Scores beyond a long end at its limits.
    """
    rows = embeddings.where(F.col("vec_id").isNotNull() & vectors.usable(F.col("embedding")))
    doubles = F.col("embedding").cast("array<double>").alias("embedding")
    rows = written(rows.select(F.monotonically_increasing_id().alias("_row"), "vec_id", doubles), "cover-rows")
    # of the rows with one id the smallest vector asks, whatever the order of the rows
    queries = rows.where(F.col("vec_id") % asks == 0).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    return vectors.search(rows, queries, [], _cell(top, scale), "long", top, F.col("score").desc())
