"""Near-duplicate documents by DartMinHash over weighted word shingles.

A document is a set of weighted elements: its shingles of five words, weighted by how often they occur. DartMinHash
throws hashed darts at every element: each dart has a rank, arriving like a Poisson process over the element's weight, and a
coordinate of the signature. The earliest dart of each coordinate is the signature's value there, and two documents
agree on a coordinate with the probability of their weighted Jaccard similarity. Long documents need few darts an
element, so a signature costs about one pass over the shingles. Bands of coordinates make buckets.

Inside a bucket no two members are paired for being there: all are compared with the smallest. Similarity being one
minus a metric, the distances found bound the others, and what they leave open between separate components is compared
exactly, in blocks of a bucket's members, of which only links that join components come out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortlake.llm.common import arrow_pass, components, mix64, words_of
from cohortlake.llm.substrings import window_hash
from cohortlake.sources.workspace import materialise


def word_hashes(words: list[str], known: dict[str, int]) -> np.ndarray:
    try:
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    except KeyError:
        if len(known) > 500_000:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def shingle_cells(hashes: np.ndarray, n: int) -> np.ndarray:
    """Unit cells of a document's weighted shingles: a shingle of weight w has cells 0 .. w - 1. Sorted.

    Fewer than ``n`` words are one shingle; none have none. Whole weights make weighted similarity that of the cells.
    """
    if not len(hashes):
        return hashes
    shingles = np.sort(window_hash(hashes, min(n, len(hashes))))
    first = np.append(0, np.flatnonzero(shingles[1:] != shingles[:-1]) + 1)
    copy = np.arange(len(shingles)) - np.repeat(first, np.diff(np.append(first, len(shingles))))
    return np.sort(mix64(shingles + mix64(copy.astype(np.uint64)) * (copy > 0)))


def dart_min_hash(cells: np.ndarray, k: int) -> np.ndarray:
    """The earliest dart of each of ``k`` coordinates over the unit cells of a document (not empty).

    The n-th dart of a cell comes an exponential step after the one before and goes to a hashed coordinate; both depend
    on cell and n alone, so documents that share a cell share its darts. Darts are thrown up to a rank at which every
    coordinate very likely has one, and further if one has none.
    """
    limit = (k * np.log(k) + 2 * k) / len(cells)
    while True:
        at, base, n, ranks, darts = cells, np.zeros(len(cells)), 0, [], []
        while len(at):
            step = max(1, int(limit + 3 * np.sqrt(limit)) if n == 0 and limit > 1 else 1)
            number = np.arange(n, n + step, dtype=np.uint64)
            dart = mix64(at[:, None] ^ mix64(number)[None, :])
            rank = base[:, None] + np.cumsum(-np.log1p(-(dart >> np.uint64(11)).astype(float) * 2.0**-53), axis=1)
            here = rank < limit
            ranks.append(rank[here])
            darts.append(dart[here])
            at, base, n = at[here[:, -1]], rank[:, -1][here[:, -1]], n + step
        rank, dart = np.concatenate(ranks), np.concatenate(darts)
        name = mix64(dart)
        place = (name % np.uint64(k)).astype(np.int64)
        if len(np.unique(place)) == k:
            break
        limit *= 2
    order = np.argsort(rank)[::-1]  # later ones are overwritten by earlier ones
    out = np.empty(k, np.uint64)
    out[place[order]] = name[order]
    return out


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two documents, from their sorted cells."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    total = len(a) + len(b) - both
    return both / total if total else 0.0


def signatures(docs: DataFrame, *, id_col: str, text_col: str, shingle: int, bands: int, rows: int) -> DataFrame:
    """``id, d1, d2, bands``: a digest of the words in their order, and a hash per band. Documents without words are left out."""

    def sign(batches: Iterator[dict]) -> Iterator[dict]:
        known: dict[str, int] = {}
        for b in batches:
            ids, d1, d2, out = [], [], [], []
            for i, text in zip(b["id"].to_pylist(), b["text"]):
                words = words_of(text.as_py())
                if not words or i is None:
                    continue
                digest = hashlib.blake2b(" ".join(words).encode("utf-8", "surrogatepass"), digest_size=16).digest()
                darts = dart_min_hash(shingle_cells(word_hashes(words, known), shingle), bands * rows).reshape(bands, rows)
                key = np.arange(bands, dtype=np.uint64)
                for j in range(rows):
                    key = mix64(key ^ mix64(darts[:, j]))
                ids.append(i)
                d1.append(int.from_bytes(digest[:8], "little", signed=True))
                d2.append(int.from_bytes(digest[8:], "little", signed=True))
                out.append(key.view(np.int64))
            yield {"id": ids, "d1": d1, "d2": d2, "bands": out}

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return arrow_pass(source, sign, "id long, d1 long, d2 long, bands array<bigint>")


def verified(pairs: DataFrame, docs: DataFrame, *, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """``a, b, similarity`` of given pairs of ids, exact, from whole texts."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    both = pairs.select("a", "b").join(texts.withColumnsRenamed({"id": "b", "text": "text_b"}), "b")
    both = both.join(texts.withColumnsRenamed({"id": "a", "text": "text_a"}), "a")

    def compare(batches: Iterator[dict]) -> Iterator[dict]:
        known: dict[str, int] = {}
        last, cells = None, None
        for b in batches:
            found = []
            for a, text_a, text_b in zip(b["a"].to_pylist(), b["text_a"], b["text_b"]):
                if a != last:
                    last, cells = a, shingle_cells(word_hashes(words_of(text_a.as_py()), known), shingle)
                found.append(similarity(cells, shingle_cells(word_hashes(words_of(text_b.as_py()), known), shingle)))
            yield {"a": b["a"], "b": b["b"], "similarity": found}

    out = arrow_pass(both, compare, "a long, b long, similarity double")
    return materialise(out, "verified")


def open_links(rows: pa.Table, threshold: float) -> pa.Table:
    """Pairs ``a, b`` of components that a stray of one and a member of the block of the other link; those that others imply are left out.

    Distances to the bucket's leader and sizes rule most members out; what they leave is counted exactly.
    """
    component, s = (rows[c].to_numpy() for c in ("component", "s"))
    cells = [np.frombuffer(x.as_py(), np.uint64) for x in rows["cells"]]
    asks, member = rows["asks"].to_numpy(zero_copy_only=False).astype(bool), ~rows["asks"].to_numpy(zero_copy_only=False).astype(bool)
    sizes = np.asarray([len(x) for x in cells])
    _, flat = np.unique(np.concatenate(cells), return_inverse=True)
    begin = np.cumsum(sizes) - sizes
    mark = np.zeros(flat.max() + 1, bool)
    same: dict[int, int] = {}

    def root(c: int) -> int:
        while c in same:
            c = same[c]
        return c

    a, b = [], []
    for x in np.flatnonzero(asks).tolist():
        able = member & (component != component[x]) & (np.abs(s - s[x]) <= 1 - threshold + 1e-9)
        able &= np.minimum(sizes, sizes[x]) >= threshold * np.maximum(sizes, sizes[x])
        if not able.any():
            continue
        own = flat[begin[x] : begin[x] + sizes[x]]
        mark[own] = True
        both = np.add.reduceat(mark[flat], begin)
        mark[own] = False
        for y in np.flatnonzero(able & (both >= threshold * (sizes + sizes[x] - both) - 1e-9)).tolist():
            if both[y] / (sizes[x] + sizes[y] - both[y]) >= threshold:
                p, q = root(int(component[x])), root(int(component[y]))
                if p != q:
                    same[max(p, q)] = min(p, q)
                    a.append(int(component[x]))
                    b.append(int(component[y]))
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def linked_in_buckets(known: DataFrame, docs: DataFrame, *, id_col: str, text_col: str, shingle: int, threshold: float, block: int = 1024) -> DataFrame:
    """Pairs ``a, b`` of components to join, found within buckets; members go in blocks, and a bucket's strays to each of them."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(known.select("id").distinct(), "id", "left_semi")

    def cut(batches: Iterator[dict]) -> Iterator[dict]:
        words: dict[str, int] = {}
        for b in batches:
            yield {"id": b["id"], "cells": [shingle_cells(word_hashes(words_of(t.as_py()), words), shingle).tobytes() for t in b["text"]]}

    cells = materialise(arrow_pass(texts, cut, "id long, cells binary"), "cells").dropDuplicates(["id"])
    pieces = F.ceil(F.col("n") / block).cast("int")
    placed = known.withColumn("piece", F.array(F.pmod(F.xxhash64("id"), pieces).cast("int"))).withColumn("asks", F.lit(False))
    asking = known.where("stray").withColumn("piece", F.sequence(F.lit(0), pieces - 1)).withColumn("asks", F.lit(True))
    rows = placed.unionByName(asking).withColumn("piece", F.explode("piece")).join(cells, "id")
    rows = rows.select("bucket", "piece", "component", "s", "asks", "cells")
    return rows.groupBy("bucket", "piece").applyInArrow(lambda t: open_links(t, threshold), "a long, b long")


def classes(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    threshold: float = 0.8,
    bands: int = 20,
    rows: int = 5,
) -> DataFrame:
    """``id, class_id, kept`` per input row: documents linked by weighted Jaccard similarity of ``threshold`` or more.

    ``class_id`` is the smallest id of the class; ``kept`` marks that document. At a similarity of 0.8, 20 bands of 5
    find a pair with probability 0.9996, and every link found is verified on whole texts. Documents with the same words
    are one text from the start, however many there are.

    Null and empty texts (no words) link with nothing and are kept. A text of fewer words than a shingle is one shingle.
    Repeated rows (same id, same text) are one document: each row comes back, all with the same answer. Rows with a null
    id come back as kept, with a null class. An empty table gives an empty one. Other columns are ignored.
    """
    signed = materialise(signatures(docs, id_col=id_col, text_col=text_col, shingle=shingle, bands=bands, rows=rows), "signatures")
    firsts = materialise(signed.groupBy("d1", "d2").agg(F.min("id").alias("rep"), F.count("*").alias("n")), "texts")
    reps = signed.join(firsts.select("d1", "d2", F.col("rep").alias("id")), ["d1", "d2", "id"], "left_semi").select("id", "bands")
    members = reps.select("id", F.explode("bands").alias("bucket")).distinct()
    leaders = members.groupBy("bucket").agg(F.min("id").alias("leader"), F.count("*").alias("n")).where("n > 1").drop("n")
    members = materialise(members.join(leaders, "bucket"), "buckets")
    pairs = members.where("id != leader").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()
    stars = verified(pairs, docs, id_col=id_col, text_col=text_col, shingle=shingle)
    links = stars.where(F.col("similarity") >= threshold).select("a", "b")
    found = materialise(components(links, "a", "b"), "classes")

    # what the stars leave open: members of a bucket in another component than its leader, against all members
    known = members.join(stars.select(F.col("a").alias("leader"), F.col("b").alias("id"), "similarity"), ["leader", "id"], "left")
    known = known.join(found, "id", "left").select(
        "bucket", "id", "leader", F.coalesce("component_id", "id").alias("component"), F.coalesce("similarity", F.lit(1.0)).alias("s")
    )
    of_leader = found.select(F.col("id").alias("leader"), F.col("component_id").alias("of_leader"))
    known = known.join(of_leader, "leader", "left").withColumn("stray", F.col("component") != F.coalesce("of_leader", "leader"))
    open_buckets = known.groupBy("bucket").agg(F.count("*").alias("n"), F.max("stray").alias("some")).where("some AND n > 2")
    known = materialise(known.join(open_buckets.select("bucket", "n"), "bucket"), "open")
    if known.limit(1).count():
        more = linked_in_buckets(known, docs, id_col=id_col, text_col=text_col, shingle=shingle, threshold=threshold)
        joined = components(more, "a", "b")  # of components, so only what strays touch goes through rounds again
        into = joined.select(F.col("id").alias("component_id"), F.col("component_id").alias("into"))
        moved = found.join(into, "component_id", "left").select("id", F.coalesce("into", "component_id").alias("component_id"))
        found = materialise(moved.unionByName(joined).distinct(), "classes")

    of_text = firsts.join(found.withColumnRenamed("id", "rep"), "rep", "left").select("d1", "d2", F.coalesce("component_id", "rep").alias("class_id"))
    of_doc = signed.select("id", "d1", "d2").distinct().join(of_text, ["d1", "d2"]).groupBy("id").agg(F.min("class_id").alias("class_id"))
    ids = docs.select(F.col(id_col).alias("doc"))
    out = ids.join(of_doc, ids["doc"].cast("long") == of_doc["id"], "left")
    class_id = F.coalesce(F.col("class_id"), F.col("doc").cast("long"))
    kept = F.coalesce(class_id == F.col("doc"), F.lit(True))
    return out.select(F.col("doc").alias(id_col), class_id.alias("class_id"), kept.alias("kept"))


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **parameters) -> DataFrame:
    """The rows of ``docs``, all columns, less those of a near-duplicate class whose first document is another.

    Of repeated rows (same id, same text) one stays. Rows with a null id, and texts without words under different ids, all stay.
    """
    gone = classes(docs.select(id_col, text_col), id_col=id_col, text_col=text_col, **parameters).where("NOT kept")
    gone = gone.select(F.col(id_col).alias("gone_id")).distinct()
    once = W.partitionBy(id_col, F.xxhash64(text_col)).orderBy(F.lit(0))
    own = docs.columns
    left = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"), id_col, text_col)
    left = left.join(gone, F.col(id_col) == F.col("gone_id"), "left_anti").withColumn("copy", F.row_number().over(once))
    return left.where(F.col(id_col).isNull() | (F.col("copy") == 1)).select("row.*")
