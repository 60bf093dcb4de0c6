"""Exact top-k inner products with M-trees.

Vectors become points of a metric space: with one more component that brings every candidate to the same length, the
largest inner product is the nearest point. Candidates lie in blocks of bounded size, each an M-tree: pages of points
and of routing objects with covering radii and distances to the parent. Best-first search opens the page with the least
lower bound and stops when no bound can reach the k-th score; the stored parent distances and the triangle inequality tell
which distances need no computing. Scores themselves are integers and exact.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortlake.llm.common import as_array
from cohortlake.sources.workspace import materialise


@dataclass
class Page:
    """A page of the tree. Entries are points (leaf) or routing objects; each has its distance to the page's own object."""

    points: np.ndarray
    to_parent: np.ndarray
    rows: np.ndarray | None = None
    radii: np.ndarray | None = None
    children: list[Page] = field(default_factory=list)


def centre_of(points: np.ndarray) -> int:
    """The point nearest to the mean."""
    return int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin())


def distances(points: np.ndarray, q: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(((points - q) ** 2).sum(axis=1), 0))


def split_groups(points: np.ndarray, rows: np.ndarray, capacity: int) -> list[np.ndarray]:
    """Rows in groups of at most ``capacity`` near points: halved again and again between two far points.

    Equal points have equal distances, so the cut goes by order, not by value, and always halves.
    """
    out, todo = [], [rows]
    while todo:
        rows = todo.pop()
        if len(rows) <= capacity:
            out.append(rows)
            continue
        own = points[rows]
        a = own[int(distances(own, own[centre_of(own)]).argmax())]
        b = own[int(distances(own, a).argmax())]
        order = np.argsort(distances(own, a) - distances(own, b), kind="stable")
        todo += [rows[order[: len(rows) // 2]], rows[order[len(rows) // 2 :]]]
    return out


def build_tree(points: np.ndarray, capacity: int = 64) -> Page:
    """A balanced M-tree, built from the leaves up; the root's own object is its centre."""
    groups = split_groups(points, np.arange(len(points)), capacity)
    nodes = []
    for rows in groups:
        own = points[rows]
        c = own[centre_of(own)]
        d = distances(own, c)
        nodes.append((c, float(d.max()), Page(own, d, rows=rows)))
    while len(nodes) > 1:
        centres = np.stack([n[0] for n in nodes])
        up = []
        for rows in split_groups(centres, np.arange(len(nodes)), capacity):
            own = centres[rows]
            c = own[centre_of(own)]
            d, radii = distances(own, c), np.asarray([nodes[i][1] for i in rows])
            up.append((c, float((d + radii).max()), Page(own, d, radii=radii, children=[nodes[i][2] for i in rows])))
        nodes = up
    return nodes[0][2]


def search(root: Page, q: np.ndarray, q_whole: np.ndarray, whole: np.ndarray, ids: np.ndarray, own_id: int, k: int, reach: float) -> list[tuple[int, int]]:
    """The ``k`` best (score, id) of one query in one tree, ties to smaller ids; the query's own id does not count.

    ``reach`` is |q|^2 plus the common squared length, so that distance^2 = reach - 2 * score.
    """
    best: list[tuple[int, int]] = []  # a heap of (score, -id); the worst on top
    heap: list[tuple[float, int, Page, float | None]] = [(0.0, 0, root, None)]
    count = 1
    slack = 1e-6 * max(1.0, reach) ** 0.5

    def limit() -> float:
        """The greatest distance that can still matter: that of the k-th score, ties included."""
        return float("inf") if len(best) < k else max(0.0, reach - 2 * best[0][0]) ** 0.5 + slack

    while heap:
        bound, _, page, to_object = heapq.heappop(heap)
        far = limit()
        if bound > far:
            break
        radii = page.radii if page.radii is not None else 0.0
        # the triangle inequality over stored distances rules entries out before their own distance is computed
        near = np.arange(len(page.points)) if to_object is None else np.flatnonzero(np.abs(to_object - page.to_parent) - radii <= far)
        if page.rows is not None:
            rows = page.rows[near]
            scores = whole[rows] @ q_whole
            mine = ids[rows] != own_id
            rows, scores = rows[mine], scores[mine]
            if len(rows) > k:
                cut = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
                rows, scores = rows[cut], scores[cut]
            for s, i in zip(scores.tolist(), ids[rows].tolist()):
                if len(best) < k:
                    heapq.heappush(best, (s, -i))
                elif (s, -i) > best[0]:
                    heapq.heapreplace(best, (s, -i))
            continue
        d = distances(page.points[near], q)
        low = np.maximum(d - page.radii[near], 0)
        for i, dist, b in zip(near.tolist(), d.tolist(), low.tolist()):
            if b <= far:
                heapq.heappush(heap, (b, count, page.children[i], dist))
                count += 1
    return [(s, -i) for s, i in best]


def whole_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """``id, v``: floor(scale * x) per component, for vectors without null or non-finite components.

    The whole numbers are doubles: from 2^53 on every double is whole, and beyond 2^63 there is no long for them.
    """
    x = F.col(vec_col)
    good = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))

    def whole(c):
        y = c.cast("double") * F.lit(float(scale))
        return F.when(F.abs(y) < float(1 << 53), F.floor(y).cast("double")).otherwise(y)

    v = F.transform(x, whole)
    return df.where(good & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), v.alias("v"))


def size_of(rows: DataFrame) -> tuple[int, int, float]:
    """Rows, most components of a row, and the greatest component without its sign."""
    n, d, top = rows.agg(F.count("*"), F.max(F.size("v")), F.max(F.array_max(F.transform("v", F.abs)))).first()
    return n, d or 0, top or 0.0


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    *,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    k: int = 5,
    scale: int = 256,
    block_rows: int = 4096,
    query_rows: int = 1024,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every query its ``k`` highest inner products over all other rows, exact.

    Both sides are vectors of ``floor(scale * x)``. Blocks of candidates meet blocks of queries, one pair of blocks a task, so a
    task's memory is bounded whatever the tables; each returns ``k`` rows a query, which are ranked per query.

    Vectors that are null, or hold null or non-finite components, and rows with a null id take no part; nor do candidates of
    another length than the query's. Ties go to the smaller id. A row is no candidate for a query of the same id; repeated
    rows count once. Fewer than ``k`` candidates are all returned; empty tables give an empty one; other columns are ignored.

    Scores are exact whatever the components' size. Where a result's score has no place in a ``long`` the query fails and says so;
    it never returns a wrapped number.
    """
    rows = materialise(whole_vectors(vectors, id_col, vec_col, scale).distinct(), "candidates")
    asked = materialise(whole_vectors(queries, id_col, vec_col, scale).distinct(), "queries")
    (n_rows, d_rows, top_rows), (n_asked, d_asked, top_asked) = size_of(rows), size_of(asked)
    blocks = max(1, -(-n_rows // block_rows))
    parts = max(1, -(-n_asked // query_rows))
    # squared lengths and scores of all pairs, and a squared length plus another, stay below 2^63
    small = max(d_rows, d_asked) * max(top_rows, top_asked) ** 2 < 2.0**62
    left = rows.select("id", "v", F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block")).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    )
    right = asked.select("id", "v", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part")).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    )

    def meet(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[tuple[int, int, int]] = []
        q_lengths = np.asarray([len(x) for x in queries["v"]], int)
        c_lengths = np.asarray([len(x) for x in candidates["v"]], int)
        for n in np.intersect1d(q_lengths, c_lengths).tolist():
            ids, whole = _matrix(candidates, c_lengths == n, n, small)
            q_ids, q_whole = _matrix(queries, q_lengths == n, n, small)
            norms = (whole**2).sum(axis=1)
            common = int(norms.max())
            points = np.column_stack([whole.astype(float), np.sqrt((common - norms).astype(float))])
            root = build_tree(points)
            for i, q in zip(q_ids.tolist(), q_whole):
                reach = float((q**2).sum() + common)
                best = search(root, np.append(q.astype(float), 0.0), q, whole, ids, i, k, reach)
                if any(s >= 1 << 63 for s, _ in best):
                    raise OverflowError(f"a score of query {i} is {max(best)[0]} and has no place in a long")
                # a score below all longs only matters if it is among the best over all blocks; null stands for it
                found += [(i, j, s if s >= -(1 << 63) else None) for s, j in best]
        columns = list(zip(*found)) or [(), (), ()]
        return pa.table({c: as_array(list(v), pa.int64()) for c, v in zip(("query_id", "vec_id", "score"), columns)})

    met = left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInArrow(meet, "query_id long, vec_id long, score long")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = met.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(order))
    kept = F.coalesce("score", F.raise_error(F.lit("a score is below -2^63 and has no place in a long")).cast("long"))
    return best.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", kept.alias("score"))


def _matrix(rows: pa.Table, wanted: np.ndarray, n: int, small: bool) -> tuple[np.ndarray, np.ndarray]:
    """Ids and whole vectors of length ``n``, in 64 bits if that is enough for all sums of products."""
    rows = rows.filter(pa.array(wanted))
    flat = rows["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    whole = flat.astype(np.int64) if small else np.asarray([int(x) for x in flat.tolist()], object)
    return rows["id"].to_numpy(), whole.reshape(len(rows), n)
