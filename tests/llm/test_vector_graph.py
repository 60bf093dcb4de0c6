"""The pieces of the vector graph: pruned lists, search, ownership of pairs, and what a shard gives out."""

from __future__ import annotations

from pathlib import Path

import numpy as np
import pytest

from cohortlake.llm import vector_links


def crowds(n: int = 900, d: int = 24, seed: int = 4) -> np.ndarray:
    """Unit vectors: loose ones, pairs, and groups of a few to a hundred near copies."""
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 3, d))
    of = np.concatenate([np.arange(n // 3), rng.integers(0, 40, n // 3), np.zeros(n // 9, int), rng.integers(0, n // 3, n - 2 * (n // 3) - n // 9)])
    x = base[of] + 0.1 / np.sqrt(d) * np.linalg.norm(base[of], axis=1, keepdims=True) * rng.normal(size=(n, d))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_search_alone_reaches_the_links():
    """No completion here: the graph, its medoids and range expansion find the links by themselves."""
    x = crowds()
    n = len(x)
    lists = vector_links.pruned_lists(x, degree=16, alpha=1.2, pool=48, far=16)
    p, k = np.nonzero(lists >= 0)
    graph = vector_links.both_ways(p, lists[p, k], n, 32)
    starts = np.unique((x @ vector_links.centres(x, 4).T).argmax(axis=0))
    hit = vector_links.search(x, np.arange(n), graph, starts, threshold=0.98, beam=8)
    true = x @ x.T >= 0.98
    assert not (hit & ~true).any() and true.sum() > 5 * n
    assert (hit & true).sum() >= 0.99 * true.sum()


def test_every_owned_pair_has_a_searched_end():
    rng = np.random.default_rng(1)
    for share in (0.0, 0.05, 0.3, 0.8):
        inside = (rng.random((80, 6)) < share).astype(np.float32)
        asked = np.zeros(80, bool)
        asked[vector_links.to_ask(inside)] = True
        owned = inside @ inside.T == 0
        assert not (owned & ~asked[:, None] & ~asked[None, :]).any()
    assert vector_links.to_ask(np.zeros((5, 0), np.float32)).tolist() == list(range(5))


def test_least_linked_crosses_long_chains():
    n = 300
    order = np.random.default_rng(2).permutation(n)
    hit = np.eye(n, dtype=bool)
    for a, b in zip(order[:200], order[1:200]):
        hit[a, b] = hit[b, a] = True
    label = vector_links.least_linked(hit)
    chain = order[:200]
    assert set(label[chain]) == {chain.min()}
    assert (label[order[200:]] == order[200:]).all()


def test_group_of_near_copies_gives_a_row_a_vector(spark):
    """A ball that no centres split and whose vectors all link: counts are exact and no pair is put out."""
    rng = np.random.default_rng(9)
    x = 1 + 0.02 * rng.normal(size=(900, 16))
    reps = spark.createDataFrame([(i, 0, v, 1 + i % 2) for i, v in enumerate(x.tolist())], "id long, label long, v array<double>, n long")
    found = vector_links.shard_links(reps, threshold=0.98, shard_rows=100, sample_rows=1000, max_centres=64, degree=16, alpha=1.2, pool=48,
                                     far=16, beam=8, medoids=4, audited=16).toPandas()
    rows = found[found["id"].notna()]
    shards = len(found) - len(rows)
    assert shards == 15 and len(rows) <= 5 * 900
    counts = rows.groupby("id")["n"].sum()
    weights = 1 + np.arange(900) % 2
    assert {int(i): int(n) for i, n in counts.items()} == {i: int(weights.sum() - weights[i]) for i in range(900)}
    audit = found[found["id"].isna()]
    assert audit["found"].sum() >= 0.9 * audit["truth"].sum()


def test_too_low_recall_stops_the_query(spark, monkeypatch):
    monkeypatch.setattr(vector_links, "recall_of", lambda *a, **k: 0.5)
    df = spark.createDataFrame([(i, [1.0, i / 9], 0) for i in range(9)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(RuntimeError, match="0.500"):
        vector_links.near_duplicates(df)


HOW = {"threshold": 0.98, "shard_rows": 40, "sample_rows": 1000, "max_centres": 64}
GRAPH = {"degree": 16, "alpha": 1.2, "pool": 48, "far": 16, "beam": 8, "medoids": 4, "audited": 16}


def table_of(spark, x: np.ndarray):
    return spark.createDataFrame([(i, 0, v, 1) for i, v in enumerate(x.tolist())], "id long, label long, v array<double>, n long")


def test_disk_grows_with_the_vectors_of_a_cell_that_no_centres_split(spark):
    """Twice the vectors are four times the pairs of blocks, but twice the bytes."""
    folder, rng, written = Path(spark.conf.get("spark.checkpoint.dir")), np.random.default_rng(3), []
    for n in (900, 1800):
        before = set(folder.rglob("*.parquet"))
        vector_links.shard_links(table_of(spark, rng.normal(size=(n, 64))), **HOW, **GRAPH)
        written.append(sum(p.stat().st_size for p in set(folder.rglob("*.parquet")) - before))
    assert written[1] < 2.5 * written[0]


def test_split_cells_and_blocks_of_a_part_that_does_not_split(spark):
    """Distinct clusters, one of them a ball of more vectors than a shard takes: every link is counted once."""
    rng = np.random.default_rng(8)
    at = np.concatenate([np.zeros(400, int), np.repeat(np.arange(1, 5), 90)])
    x = 4 * np.eye(24)[at] + rng.normal(size=(len(at), 24)) * np.where(at == 0, 0.12, 0.05)[:, None]
    reps = table_of(spark, x)
    _, split, large, stuck = vector_links.leaves_of(reps, **HOW)
    assert split is not None and large is None and stuck is not None
    counts = vector_links.shard_links(reps, **HOW, **GRAPH).where("id IS NOT NULL").groupBy("id").sum("n").collect()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    true = (unit @ unit.T >= 0.98).sum(axis=1) - 1
    assert {r[0]: r[1] for r in counts if r[1]} == {i: int(n) for i, n in enumerate(true) if n}


def test_links_of_shards_are_merged():
    parts = [[np.array(c) for c in zip(*rows)] for rows in ([(5, 2, 3), (3, 1, 3)], [(5, 1, 4), (4, 1, 4), (9, 1, 7), (7, 1, 7)], [(4, 3, 1), (1, 1, 1)])]
    ids, n, root = vector_links.merge_links(parts)
    assert list(zip(ids, n, root)) == [(1, 1, 1), (3, 1, 1), (4, 4, 1), (5, 3, 1), (7, 1, 7), (9, 1, 7)]
