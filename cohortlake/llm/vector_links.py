"""Embedding near-duplicates by a robust-pruned flat graph over overlapping cluster shards.

Equal vectors are one from the start. The rest go, within their label, to the shard of their nearest cluster centre and to all
whose border they are near enough to for a link across it, so that every link lies inside some shard. Where centres would copy
vectors too often, shards are the pairs of a label's blocks, read by tasks from one stored copy. Every shard lists for each of its
vectors near neighbours that no kept neighbour is much nearer to (robust pruning); a vector's lists of all its cluster shards are
united. The graph is searched for every vector that is near another: from medoids and the vector's own place, then on
from all vectors in range as long as that finds more. A sample in every shard, in a pair of blocks all of it, is compared with the
whole shard; where the search missed one of its links, all similarities of that shard are taken. A pair of vectors is counted in the
first shard both are in, and a shard gives out one row per vector, never its pairs. All decisions are in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlake.llm.common import arrow_pass, as_array, components
from cohortlake.sources.workspace import materialise

#: In how many cells a vector may be on average; beyond it, a cell is searched by pairs of its blocks, of which the disk holds one copy.
MOST_COPIES = 1.5


def matrix(column) -> np.ndarray:
    """Unit vectors, in double precision, of a column of arrays of one length."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def centres(sample: np.ndarray, n: int, rounds: int = 8) -> np.ndarray:
    """``n`` cluster centres of unit vectors by k-means, from evenly spaced rows of the sample on."""
    c = sample[np.linspace(0, len(sample) - 1, n).astype(int)]
    for _ in range(rounds):
        near = (sample @ c.T).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, sample)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(norms > 0, sums / np.maximum(norms, 1e-300), c)
    return c


def pruned_lists(x: np.ndarray, *, degree: int, alpha: float, pool: int, far: int, block: int = 512) -> np.ndarray:
    """Each vector's list by robust pruning, filled up with -1: a candidate goes if a kept one is ``alpha`` times nearer to it.

    Candidates are the ``pool`` nearest and ``far`` evenly spaced ones, which make the long steps of the search.
    """
    n = len(x)
    single = x.astype(np.float32)
    dist = single @ single.T
    dist *= -2
    dist += 2
    np.sqrt(np.maximum(dist, 0, out=dist), out=dist)
    lists = np.full((n, degree), -1)
    spread = np.unique(np.linspace(0, n - 1, min(far, n)).astype(int))
    for low in range(0, n, block):
        own = np.arange(low, min(low + block, n))
        take = min(pool, n)
        near = np.argpartition(dist[own], take - 1, axis=1)[:, :take]
        at = np.concatenate([near, np.broadcast_to(spread, (len(own), len(spread)))], axis=1)
        order = np.argsort(dist[own[:, None], at], axis=1, kind="stable")
        at = np.take_along_axis(at, order, axis=1)
        away = dist[own[:, None], at]
        alive = at != own[:, None]
        for k in range(degree):
            on = np.flatnonzero(alive.any(axis=1))
            if not len(on):
                break
            first = alive[on].argmax(axis=1)
            best = at[on, first]
            lists[low + on, k] = best
            alive[on] &= alpha * dist[best[:, None], at[on]] > away[on]
            alive[on] &= at[on] != best[:, None]
    return lists


def both_ways(p: np.ndarray, q: np.ndarray, n: int, width: int) -> np.ndarray:
    """Neighbours per vector of the edges ``p -> q``, own lists first, then those that list it; filled up with the vector itself."""
    keys = np.concatenate([p * n + q, q * n + p])
    _, first = np.unique(keys, return_index=True)
    first.sort()
    u, v = keys[first] // n, keys[first] % n
    order = np.argsort(u, kind="stable")
    u, v = u[order], v[order]
    rank = np.arange(len(u)) - np.searchsorted(u, u)
    out = np.repeat(np.arange(n)[:, None], min(width, int(rank.max(initial=0)) + 1), axis=1)
    fits = rank < width
    out[u[fits], rank[fits]] = v[fits]
    return out


def linked(x: np.ndarray, a: np.ndarray, b: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Similarities of pairs and whether they are links; those at the threshold are summed in one order, alike in all shards."""
    s = np.einsum("ij,ij->i", x[a], x[b])
    good = s >= threshold
    close = np.flatnonzero(np.abs(s - threshold) < 1e-9)
    good[close] = (x[a[close]] * x[b[close]]).sum(axis=1) >= threshold
    return s, good


def to_ask(inside: np.ndarray) -> np.ndarray:
    """Rows whose searches see every pair a shard owns. ``inside``: which earlier shards each row is in; a pair in one together is owned there.

    Rows in the same earlier shards form a group. A group that owns pairs of its own is asked, and of two groups that own
    pairs with each other one.
    """
    if not inside.shape[1]:
        return np.arange(len(inside))
    groups, of, sizes = np.unique(inside > 0, axis=0, return_inverse=True, return_counts=True)
    of = of.reshape(-1)
    flags = groups.astype(np.float32)
    asked = ~groups.any(axis=1)
    for g in np.argsort(sizes, kind="stable"):
        if not asked[g]:
            asked[g] = bool(((flags @ flags[g] == 0) & ~asked).any())
    return np.flatnonzero(asked[of])


def search(x: np.ndarray, asked: np.ndarray, graph: np.ndarray, starts: np.ndarray, *, threshold: float, beam: int, block: int = 128,
           lot: int = 50_000) -> np.ndarray:
    """Which vectors the graph leads each of the ``asked`` to within the threshold, as a matrix of flags over all vectors.

    All queries of a block step together: every vector that is newly seen and among the ``beam`` nearest of its query, or in
    range of it, is expanded in the next step. It ends when no query has one left.
    """
    n = len(x)
    hit = np.zeros((n, n), bool)
    for first in range(0, len(asked), block):
        of = asked[first : first + block]
        m = len(of)
        seen = np.zeros(m * n, bool)
        best = np.full((m, beam), -np.inf)
        own = np.arange(m)
        keys = np.unique(np.concatenate([own * n + of, (own[:, None] * n + starts).ravel()]))
        while len(keys):
            seen[keys] = True
            q, p = keys // n, keys % n
            s, good = np.empty(len(keys)), np.empty(len(keys), bool)
            for i in range(0, len(keys), lot):
                s[i : i + lot], good[i : i + lot] = linked(x, of[q[i : i + lot]], p[i : i + lot], threshold)
            hit[of[q[good]], p[good]] = True
            rank = np.arange(len(q)) - np.searchsorted(q, q)
            fresh = np.full((m, int(rank.max()) + 1), -np.inf)
            fresh[q, rank] = s
            best = -np.partition(-np.concatenate([best, fresh], axis=1), beam - 1, axis=1)[:, :beam]
            open_ = np.flatnonzero(good | (s >= best.min(axis=1)[q]))
            new = []
            for i in range(0, len(open_), lot):
                at = open_[i : i + lot]
                k = (q[at][:, None] * n + graph[p[at]]).ravel()
                new.append(np.unique(k[~seen[k]]))
            keys = np.unique(np.concatenate(new)) if new else np.empty(0, int)
    return hit


def least_linked(hit: np.ndarray) -> np.ndarray:
    """Per vector the first one it reaches by links; ``hit`` is symmetric and every vector hits itself."""
    label = np.arange(len(hit))
    a, b = np.nonzero(hit)
    starts = np.searchsorted(a, label)
    while True:
        low = np.minimum.reduceat(label[b], starts)
        low = low[low]
        if (low == label).all():
            return label
        label = low


def build_shard(rows: pa.Table, degree: int, alpha: float, pool: int, far: int) -> pa.Table:
    """``shard, id, near``: each vector's pruned list in this shard, as ids."""
    rows = rows.take(np.argsort(rows["id"].to_numpy(), kind="stable"))
    ids = rows["id"].to_numpy()
    lists = pruned_lists(matrix(rows["v"]), degree=degree, alpha=alpha, pool=pool, far=far)
    kept = lists >= 0
    near = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], kept.sum(axis=1).cumsum()]), pa.int32()), pa.array(ids[lists[kept]], pa.int64()))
    return pa.table({"shard": rows["shard"], "id": rows["id"], "near": near})


def parts_of(column) -> tuple[np.ndarray, pa.Array]:
    """Row numbers and values of a column of arrays."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.repeat(np.arange(len(column)), column.value_lengths().to_numpy(zero_copy_only=False)), column.flatten()


OUT = "id long, n long, root long, found long, truth long, completed long"


def search_shard(rows: pa.Table, threshold: float, degree: int, beam: int, medoids: int, audited: int) -> pa.Table:
    """What ``search_graph`` gives of a shard whose rows bring their lists ``near`` and the names of their ``shards``."""
    rows = rows.take(np.argsort(rows["id"].to_numpy(), kind="stable"))
    ids = rows["id"].to_numpy()
    p, q = parts_of(rows["near"])
    q = q.to_numpy(zero_copy_only=False)
    at = np.minimum(np.searchsorted(ids, q), len(ids) - 1)
    here = ids[at] == q
    inside = earlier_shards(rows["shards"], rows["shard"][0].as_py())
    return search_graph(ids, matrix(rows["v"]), rows["n"].to_numpy(), p[here], at[here], inside, threshold, degree, beam, medoids, audited)


def search_alone(rows: pa.Table, threshold: float, degree: int, beam: int, medoids: int, audited: int, **lists) -> pa.Table:
    """Lists and search of a shard whose vectors are in no other, so that there are no lists to unite."""
    rows = rows.take(np.argsort(rows["id"].to_numpy(), kind="stable"))
    return search_lists(rows["id"].to_numpy(), matrix(rows["v"]), rows["n"].to_numpy(), np.zeros((len(rows), 0), np.float32),
                        threshold, degree, beam, medoids, audited, **lists)


def search_lists(ids: np.ndarray, x: np.ndarray, n: np.ndarray, inside: np.ndarray, threshold: float, degree: int, beam: int, medoids: int,
                 audited: int, *, alpha: float, pool: int, far: int) -> pa.Table:
    """What ``search_graph`` gives with these vectors' own lists. A list begins with the nearest vector: out of range, nothing links."""
    lists = pruned_lists(x, degree=degree, alpha=alpha, pool=pool, far=far)
    p, k = np.nonzero(lists >= 0)
    nearest = lists[:, 0]
    near = (nearest >= 0) & (np.einsum("ij,ij->i", x, x[nearest]) >= threshold - 1e-5)  # nearest in single precision
    return search_graph(ids, x, n, p, lists[p, k], inside, threshold, degree, beam, medoids, audited, near)


def earlier_shards(shards, own: str) -> np.ndarray:
    """Which of the shards before ``own`` that hold two of the rows each row is in."""
    r, names = parts_of(shards)
    coded = names.dictionary_encode()
    earlier = np.asarray([name < own for name in coded.dictionary.to_pylist()], bool)
    inside = np.zeros((len(shards), len(earlier)), np.float32)
    inside[r, coded.indices.to_numpy(zero_copy_only=False)] = 1
    return inside[:, earlier & (inside.sum(axis=0) > 1)]


def search_graph(ids: np.ndarray, x: np.ndarray, weights: np.ndarray, p: np.ndarray, q: np.ndarray, inside: np.ndarray, threshold: float,
                 degree: int, beam: int, medoids: int, audited: int, near: np.ndarray | None = None) -> pa.Table:
    """``id, n, root`` of a shard's vectors with links, and a row without id on how the search did. ``p -> q`` are the lists' edges.

    Only vectors ``near`` another are searched, all if it is None; the audit takes its sample from all.

    ``n`` counts the vectors (copies included) linked by pairs this shard owns; ``root`` is the least vector reached by these.
    ``found`` of ``truth`` links of ``audited`` vectors came from the search; where one is missing, the shard is completed.
    """
    n = len(ids)
    graph = both_ways(p, q, n, 2 * degree)
    starts = np.unique((x @ centres(x, min(medoids, n)).T).argmax(axis=0))
    mine = to_ask(inside)
    hit = search(x, mine if near is None else mine[near[mine]], graph, starts, threshold=threshold, beam=beam)
    np.fill_diagonal(hit, True)

    def truth(low: np.ndarray) -> np.ndarray:
        flags = x[low] @ x.T >= threshold - 1e-9
        a, b = np.nonzero(flags)
        for i in range(0, len(a), 50_000):
            flags[a[i : i + 50_000], b[i : i + 50_000]] = linked(x, low[a[i : i + 50_000]], b[i : i + 50_000], threshold)[1]
        flags[np.arange(len(low)), low] = True
        return flags

    asked = mine[np.unique(np.linspace(0, len(mine) - 1, min(audited, len(mine))).astype(int))]
    true = np.concatenate([truth(asked[low : low + 512]) for low in range(0, len(asked), 512)])
    found, total = int((hit[asked] & true).sum()) - len(asked), int(true.sum()) - len(asked)
    hit |= hit.T
    completed = bool((true & ~hit[asked]).any())
    if completed:
        for low in range(0, n, 512):
            hit[low : low + 512] |= truth(np.arange(low, min(low + 512, n)))
        hit |= hit.T
    weights, counts = weights.astype(float), np.zeros(n)
    for low in range(0, n, 512):
        counted = hit[low : low + 512]
        if inside.shape[1]:
            counted &= inside[low : low + 512] @ inside.T == 0
        counted[np.arange(len(counted)), np.arange(low, low + len(counted))] = False
        counts[low : low + 512] = counted.astype(float) @ weights
    np.fill_diagonal(hit, True)
    root = least_linked(hit)
    out = np.flatnonzero(counts > 0)
    note, none = [found, total, int(completed)], [None] * len(out)
    return pa.table({
        "id": pa.array([*ids[out].tolist(), None], pa.int64()), "n": pa.array([*counts[out].astype(int).tolist(), None], pa.int64()),
        "root": pa.array([*ids[root[out]].tolist(), None], pa.int64()),
        **{c: pa.array([*none, v], pa.int64()) for c, v in zip(("found", "truth", "completed"), note)},
    })


def members(x: np.ndarray, c: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``x`` and the cells of centres ``c`` they belong to: the nearest, and all whose border is within ``margin``."""
    g = x @ c.T - (c * c).sum(axis=1) / 2
    home = g.argmax(axis=1)
    apart = np.sqrt(np.maximum(((c[:, None] - c[None]) ** 2).sum(axis=2), 1e-24)) if len(c) <= 64 else np.sqrt(
        np.maximum((c * c).sum(axis=1)[:, None] + (c * c).sum(axis=1) - 2 * c @ c.T, 1e-24)
    )
    return np.nonzero(g[np.arange(len(x)), home][:, None] - g <= margin * apart[home])


def fit_cells(rows: DataFrame, big: DataFrame, *, shard_rows: int, max_centres: int, sample_rows: int, margin: float) -> DataFrame:
    """``cell, c, grown``: centres of those cells in ``big`` (``cell, size, copies``) that they make smaller, from samples of their rows.

    The sample is dealt to its centres first, and to half as many as long as the largest part or the pairs of all parts would be above
    0.7 of the cell's, or a vector in more than ``MOST_COPIES`` cells by now; ``grown`` is in how many it would be.
    """
    least = F.least(F.lit(sample_rows), F.greatest(F.lit(2048), F.col("size") / 8))
    sample = rows.join(big, "cell").where(F.pmod(F.xxhash64("id", F.lit("centres")), F.ceil(F.col("size") / least)) == 0)

    def fit(t: pa.Table) -> pa.Table:
        x = matrix(t["v"])[np.argsort(t["id"].to_numpy(), kind="stable")]
        n = min(-(-t["size"][0].as_py() // shard_rows), max_centres, len(x))
        while True:
            c = centres(x, n)
            parts = np.zeros(n)
            for low in range(0, len(x), 2000):
                parts += np.bincount(members(x[low : low + 2000], c, margin)[1], minlength=n)
            grown = t["copies"][0].as_py() * parts.sum() / len(x)
            fine = parts.max() <= 0.7 * len(x) and (parts * parts).sum() <= 0.7 * len(x) ** 2 and grown <= MOST_COPIES
            if fine or n <= 2:
                return pa.table({"cell": t["cell"][:1], "c": pa.array([c.tobytes()], pa.binary()), "grown": [float(grown)]}).slice(0, int(fine))
            n //= 2

    return sample.select("cell", "id", "v", "size", "copies").groupBy("cell").applyInArrow(fit, "cell string, c binary, grown double")


def split_cells(rows: DataFrame, fitted: DataFrame, margin: float) -> DataFrame:
    """``id, n, v, cell, copies``: the rows of the cells in ``fitted`` (``cell, size, c, grown``), dealt to the cells of their centres.

    Centres travel to the rows as records of the same partitions, so neither the driver nor a broadcast holds them.
    """
    sizes = fitted.select("cell", "size", "grown")
    kind, lots = rows.schema["v"].dataType.simpleString(), F.ceil(F.col("size") / 20_000).cast("int")
    heads = fitted.select("cell", F.explode(F.sequence(F.lit(0), lots - 1)).alias("lot"), "c")
    tails = rows.join(sizes, "cell").select("cell", F.pmod(F.xxhash64("id", F.lit("lot")), lots).cast("int").alias("lot"), "id", "n", "v", "grown")
    stream = tails.unionByName(heads, allowMissingColumns=True).repartition("cell", "lot").sortWithinPartitions("cell", "lot", F.col("c").isNull())

    def deal(batches: Iterator[dict]) -> Iterator[dict]:
        cell = c = None
        for t in batches:
            n = len(t["cell"])
            starts = np.flatnonzero(t["c"].is_valid().to_numpy(zero_copy_only=False))
            cuts = sorted({0, n, *starts.tolist(), *(starts + 1).tolist(), *range(0, n, 2000)})
            for low, high in zip(cuts, cuts[1:]):
                if t["c"][low].is_valid:
                    cell, c = t["cell"][low].as_py(), np.frombuffer(t["c"][low].as_py())
                    continue
                if t["cell"][low].as_py() != cell:
                    raise ValueError(f"no centres of cell {t['cell'][low]}")
                x = matrix(t["v"].slice(low, high - low))
                at, sub = members(x, c.reshape(-1, x.shape[1]), margin)
                names = pa.array([f"{cell}.{i}" for i in range(len(c) // x.shape[1])]).take(pa.array(sub))
                at = pa.array(at + low)
                yield {"id": t["id"].take(at), "n": t["n"].take(at), "v": t["v"].take(at), "cell": names, "copies": t["grown"].take(at)}

    return arrow_pass(stream, deal, f"id long, n long, v {kind}, cell string, copies double")


def leaves_of(reps: DataFrame, *, threshold: float, shard_rows: int, sample_rows: int, max_centres: int) -> tuple[DataFrame, DataFrame | None, DataFrame | None, DataFrame | None]:
    """Cells ``cell, id, n, v``: every two vectors of a label whose cosine reaches the threshold are in a cell together.

    A cell of more than three times ``shard_rows`` is split at the bisectors of its centres. Linked vectors in different
    cells are ``reach`` apart at most, so one of them is within half of it of the bisector between, and belongs to both cells.
    Four parts, the last three None where empty: labels small enough as they are; cells of split labels; large labels and large
    cells that splitting does not make smaller (a ball of vectors all near each other, or vectors without clusters).
    """
    margin = np.sqrt(max(0.0, 2 - 2 * threshold)) / 2 + 1e-6
    todo = reps.select("id", "n", "v", F.col("label").cast("string").alias("cell"), F.lit(1.0).alias("copies"))
    whole, split, large, stuck = None, [], None, []
    while True:
        sizes = materialise(todo.groupBy("cell").agg(F.count("*").alias("size"), F.max("copies").alias("copies")), "sizes")
        small, big = sizes.where(F.col("size") <= 3 * shard_rows), sizes.where(F.col("size") > 3 * shard_rows)
        rows = todo.select("cell", "id", "n", "v")
        ready, first = rows.join(small.select("cell"), "cell"), whole is None
        if first:
            whole = ready
        else:
            split.append(ready)
        if not big.limit(1).count():
            break
        fitted = materialise(
            fit_cells(rows, big, shard_rows=shard_rows, max_centres=max_centres, sample_rows=sample_rows, margin=margin).join(big.select("cell", "size"), "cell"),
            "centres",
        )
        left = materialise(big.join(fitted.select("cell"), "cell", "left_anti"), "large")
        if left.limit(1).count():
            rest = rows.join(left.select("cell"), "cell")
            if first:
                large = rest
            else:
                stuck.append(rest)
        if not fitted.limit(1).count():
            break
        todo = materialise(split_cells(rows, fitted, margin), "cells")
    return whole, reduce(DataFrame.unionByName, split) if split else None, large, reduce(DataFrame.unionByName, stuck) if stuck else None


def packed(rows: DataFrame, block_rows: int) -> DataFrame:
    """Blocks of at most ``block_rows`` vectors of a cell, each one row: ``cell, first`` (its least id), ids, counts and vectors as bytes.

    Blocks are made where the rows are, so that no vector is shuffled for them. ``shards`` are the cells of each vector, or null.
    """
    single = rows.schema["v"].dataType.elementType.simpleString() == "float"

    def cut(batches: Iterator[dict]) -> Iterator[dict]:
        held: dict[str, list[pa.Table]] = {}

        def block(t: pa.Table) -> dict:
            t = t.take(np.argsort(t["id"].to_numpy(), kind="stable"))
            v = t["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
            ids = t["id"].to_numpy()
            return {
                "first": ids[:1], "ids": [ids.tobytes()], "n": [t["n"].to_numpy().tobytes()],
                "v": [(v if single else v.astype(float)).tobytes()], "shards": [None if t["shards"].null_count else t["shards"].to_pylist()],
            }

        for t in batches:
            coded = t["cell"].dictionary_encode()
            codes = coded.indices.to_numpy(zero_copy_only=False)
            rest = pa.table({c: t[c] for c in ("id", "n", "v", "shards")})
            for k, cell in enumerate(coded.dictionary.to_pylist()):
                held.setdefault(cell, []).append(rest.take(np.flatnonzero(codes == k)))
                if sum(map(len, held[cell])) < 2 * block_rows:
                    continue
                own = pa.concat_tables(held[cell])
                while len(own) >= 2 * block_rows:
                    yield {"cell": [cell], **block(own.slice(0, block_rows))}
                    own = own.slice(block_rows)
                held[cell] = [own.take(np.arange(len(own)))]
        for cell, parts in held.items():
            own = pa.concat_tables(parts)
            half = len(own) if len(own) <= block_rows else -(-len(own) // 2)
            for low in range(0, len(own), half):
                yield {"cell": [cell], **block(own.slice(low, half))}

    return arrow_pass(rows.select("cell", "id", "n", "v", "shards"), cut, "cell string, first long, ids binary, n binary, v binary, shards array<array<string>>")


def block_pairs(rows: DataFrame, *, block_rows: int, threshold: float, degree: int, beam: int, medoids: int, **lists) -> DataFrame:
    """What ``search_graph`` gives of all pairs of blocks of each cell ``cell, id, n, v, shards``, each pair a shard with its own lists.

    Every block is on disk once. Tasks, one for each two groups of blocks, read the pairs from there, and none is stored or shuffled.
    Pairs of vectors of one block belong to it and the next block (the last two share theirs), so that no link is put out twice; links
    that a task finds are merged before they leave it. A pair has no lists of other shards to lean on, so all its vectors are audited.
    """
    total = rows.count()
    blocks = max(1, total // block_rows)
    tasks = -(-total // (64 * block_rows))
    kind = np.float32 if rows.schema["v"].dataType.elementType.simpleString() == "float" else np.float64
    stored = materialise(packed(rows.coalesce(tasks), block_rows), "blocks", rows_per_file=max(1, min(64, blocks // 16)))
    follows = Window.partitionBy("cell").orderBy("first")
    turns = materialise(stored.select("cell", "first").withColumn("next", F.lead("first").over(follows)), "turns")
    names = stored.join(turns, ["cell", "first"])
    a, b = (names.select([F.col(c).alias(f"{side}_{c}") for c in names.columns]) for side in "ab")
    pairs = a.hint("shuffle_replicate_nl").join(b, (F.col("a_cell") == F.col("b_cell")) & (F.col("a_first") < F.col("b_first")))

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        merged, waiting, due = None, [], 200_000
        for t in batches:
            for k in range(len(t["a_cell"])):
                r = {c: col[k].as_py() for c, col in t.items()}
                ids, n = (np.concatenate([np.frombuffer(r[f"{side}_{c}"], np.int64) for side in "ab"]) for c in ("ids", "n"))
                x = np.concatenate([np.frombuffer(r[f"{side}_v"], kind) for side in "ab"]).astype(float).reshape(len(ids), -1)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                of_b = np.arange(len(ids)) >= len(r["a_ids"]) // 8
                owns_a = r["a_next"] == r["b_first"]
                flags = [side for side, owned in ((~of_b, owns_a), (of_b, owns_a and r["b_next"] is None)) if not owned]
                inside = np.stack(flags, axis=1).astype(np.float32) if flags else np.zeros((len(ids), 0), np.float32)
                if r["a_shards"] is not None:
                    inside = np.concatenate([inside, earlier_shards(pa.array(r["a_shards"] + r["b_shards"], pa.list_(pa.string())), r["a_cell"])], axis=1)
                order = np.argsort(ids, kind="stable")
                found = search_lists(ids[order], x[order], n[order], inside[order], threshold, degree, beam, medoids, len(ids), **lists)
                yield {c: found[c].slice(len(found) - 1).combine_chunks() for c in found.column_names}
                waiting.append([found[c].slice(0, len(found) - 1).to_numpy() for c in ("id", "n", "root")])
                if sum(len(w[0]) for w in waiting) >= due:
                    merged, waiting = merge_links(waiting + ([merged] if merged else [])), []
                    due = max(200_000, len(merged[0]))
        merged = merge_links(waiting + ([merged] if merged else []))
        none = pa.nulls(len(merged[0]), pa.int64())
        yield {**dict(zip(("id", "n", "root"), merged)), "found": none, "truth": none, "completed": none}

    return arrow_pass(pairs, work, OUT)


def merge_links(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
    """``id, n, root`` of several shards as one row a vector: counts are summed, and roots are the least vectors reached through all of them."""
    if not parts:
        return [np.empty(0, np.int64)] * 3
    ids, n, root = (np.concatenate(c).astype(np.int64) for c in zip(*parts))
    nodes, at = np.unique(np.concatenate([ids, root]), return_inverse=True)
    own, to = at[: len(ids)], at[len(ids) :]
    counts = np.zeros(len(nodes), np.int64)
    np.add.at(counts, own, n)
    label = np.arange(len(nodes))
    while True:
        low = label.copy()
        np.minimum.at(low, own, label[to])
        np.minimum.at(low, to, label[own])
        np.minimum.at(low, label, low.copy())
        low = low[low]
        if (low == label).all():
            break
        label = low
    return [nodes, counts, nodes[label]]


def shard_links(reps: DataFrame, *, threshold: float, shard_rows: int, sample_rows: int, max_centres: int, degree: int, alpha: float,
                pool: int, far: int, beam: int, medoids: int, audited: int) -> DataFrame:
    """What ``search_graph`` gives, of all shards of vectors ``id, label, v, n``."""
    whole, split, large, stuck = leaves_of(reps, threshold=threshold, shard_rows=shard_rows, sample_rows=sample_rows, max_centres=max_centres)
    how = {"threshold": threshold, "degree": degree, "beam": beam, "medoids": medoids}
    lists = {"alpha": alpha, "pool": pool, "far": far}
    blocks = how | lists | {"block_rows": -(-3 * shard_rows // 2)}
    work = [whole.groupBy("cell").applyInArrow(lambda rows: search_alone(rows, **how, audited=audited, **lists), OUT)]
    if split is not None:
        shards = split.withColumnRenamed("cell", "shard")
        built = shards.groupBy("shard").applyInArrow(lambda rows: build_shard(rows, degree, alpha, pool, far), "shard string, id long, near array<long>")
        if stuck is not None:
            built = built.unionByName(stuck.select(F.col("cell").alias("shard"), "id", F.array().cast("array<long>").alias("near")))
        united = built.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"), F.collect_list("shard").alias("shards"))
        if stuck is not None:
            united = materialise(united, "united")
            work.append(block_pairs(stuck.join(united.select("id", "shards"), "id"), **blocks))
        rows = shards.join(united, "id")
        work.append(rows.groupBy("shard").applyInArrow(lambda rows: search_shard(rows, **how, audited=audited), OUT))
    if large is not None:
        work.append(block_pairs(large.withColumn("shards", F.lit(None).cast("array<string>")), **blocks))
    return materialise(reduce(DataFrame.unionByName, work), "links")


def recall_of(counts: DataFrame, reps: DataFrame, *, threshold: float, queries: int) -> float:
    """Share of the true links of ``queries`` sampled vectors that ``counts`` (``id, n_links``) has; 1 if they have none."""
    asked = reps.orderBy(F.xxhash64("id", F.lit("audit")), "id").limit(queries).select("id", "label", "v").toArrow()
    if not len(asked):
        return 1.0
    q_ids, q_labels, q = asked["id"].to_numpy(), asked["label"].to_numpy(), matrix(asked["v"])

    def all_links(batches: Iterator[dict]) -> Iterator[dict]:
        for t in batches:
            hit = (q @ matrix(t["v"]).T >= threshold) & (q_labels[:, None] == t["label"].to_numpy()[None, :])
            hit &= q_ids[:, None] != t["id"].to_numpy()[None, :]
            yield {"id": q_ids, "true": (hit.astype(float) @ t["n"].to_numpy().astype(float)).astype(int)}

    true = arrow_pass(reps.select("id", "label", "v", "n"), all_links, "id long, true long").groupBy("id").agg(F.sum("true").alias("true"))
    got = F.coalesce("n_links", F.lit(0))
    r = true.join(counts, "id", "left").agg(F.sum("true"), F.sum(F.least(got, "true"))).first()
    return r[1] / r[0] if r[0] else 1.0


def near_duplicates(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    threshold: float = 0.98,
    shard_rows: int = 1000,
    sample_rows: int = 16_384,
    max_centres: int = 1024,
    degree: int = 16,
    alpha: float = 1.2,
    pool: int = 48,
    far: int = 16,
    beam: int = 8,
    medoids: int = 4,
    shard_audit: int = 64,
    audit_queries: int = 200,
    min_recall: float = 0.9,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row: links by cosine within a label, and their components.

    Vectors that are null, zero or hold null or non-finite components, and those with a null label, link with nothing; each is its own component and
    kept. Equal vectors of one label link with each other and share all other links; repeated rows (same id) are one vector.
    Vectors of different length do not link. Centres of each split come from about ``sample_rows`` vectors at most; all are indexed. ``search_recall``
    is the share of true links the graph search alone found for ``shard_audit`` vectors of every shard, ``completed`` the share of shards
    completed since it missed one, ``recall`` the audited share of true links in the result. Rows with null ids come back unlinked; an empty table gives an empty one; other
    columns are ignored.
    """
    x = F.col(vec_col)
    good = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    good = x.isNotNull() & F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & good & F.exists(x, lambda c: c != 0)
    # Vectors are equal where their digests are; only the first of each is shuffled as a whole.
    plain = F.transform(x, lambda c: F.when(c == 0, F.lit("0")).otherwise(c.cast("string")))
    key = F.when(good, F.unhex(F.sha2(F.array_join(plain, ","), 256)))
    base = vectors.where(good).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), key.alias("key"), F.size(x).alias("d"), x.alias("v"))
    once = base.groupBy("id", "label", "key", "d").agg(F.count("*").alias("rows"))
    first = F.min(F.struct("id", "rows"))
    places = once.groupBy("label", "key", "d").agg(first.alias("first"), F.count("*").alias("n"))
    places = materialise(places.select("label", "key", "d", "first.id", "first.rows", "n"), "places")
    firsts = base.join(places.drop("rows", "d"), ["id", "label", "key"])
    if places.where("rows > 1").limit(1).count():
        firsts = firsts.dropDuplicates(["id", "label", "key"])
    firsts = materialise(firsts.select("id", "label", "d", "v", "n"), "vectors")
    found = recall = None
    for d in sorted(r["d"] for r in places.select("d").distinct().collect()):
        reps = firsts.where(F.col("d") == d)
        part = shard_links(reps, threshold=threshold, shard_rows=shard_rows, sample_rows=sample_rows, max_centres=max_centres, degree=degree,
                           alpha=alpha, pool=pool, far=far, beam=beam, medoids=medoids, audited=shard_audit)
        r = recall_of(part.where("id IS NOT NULL").groupBy("id").agg(F.sum("n").alias("n_links")), reps, threshold=threshold, queries=audit_queries)
        if r < min_recall:
            raise RuntimeError(f"only {r:.3f} of the audited links were found")
        recall = r if recall is None else min(recall, r)
        found = part if found is None else found.unionByName(part)
    ids = vectors.select(F.col(id_col).alias("doc"), F.col(label_col).cast("long").alias("label"), key.alias("key"))
    if found is None:
        own = F.col("doc").cast("long")
        return ids.select(
            F.col("doc").alias(id_col), F.lit(0).cast("long").alias("n_links"), own.alias("component_id"), F.lit(True).alias("kept"),
            F.lit(1.0).alias("recall"), F.lit(1.0).alias("search_recall"), F.lit(0.0).alias("completed"),
        )
    audit = found.where("id IS NULL").agg(F.sum("found"), F.sum("truth"), F.avg("completed")).first()
    search_recall = audit[0] / audit[1] if audit[1] else 1.0
    degree_of = found.where("n > 0").groupBy("id").agg(F.sum("n").alias("n_links"))
    of = components(found.where("id != root"), "id", "root")
    known = (
        places.join(degree_of, "id", "left").join(of, "id", "left")
        .select("label", "key", (F.coalesce("n_links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
    )
    out = ids.join(known, ["label", "key"], "left")
    component = F.coalesce("component_id", F.col("doc").cast("long"))
    return out.select(
        F.col("doc").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(component == F.col("doc"), F.lit(True)).alias("kept"), F.lit(float(recall)).alias("recall"),
        F.lit(float(search_recall)).alias("search_recall"), F.lit(float(audit[2])).alias("completed"),
    )
