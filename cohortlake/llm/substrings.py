"""Repeated word windows by super-k-mer partitioning.

A text's windows of consecutive words are keyed by a minimiser, the least hash among the short word groups inside the
window. Consecutive windows with one minimiser form a super-k-mer, and travel as one packed string of words to the
minimiser's bucket, where equal windows meet: sorting them counts them, and words are compared as words, not as hashes.
All super-k-mers that a batch of documents sends to one bucket go in one compressed block with its own word list.
Super-k-mers repeated within a batch are settled there, so a passage in very many documents reaches its bucket once a batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.llm.common import WORD_PATTERN, arrow_pass, as_array, give_back, mix64, words_of
from cohortlake.llm.decontamination import word_places
from cohortlake.sources.workspace import materialise

_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Words are what stands between ASCII white space, unchanged.
_AS_IS = np.arange(256, dtype=np.uint8)
_LETTERS = np.ones(256, bool)
_LETTERS[[0x20, *range(0x09, 0x0E)]] = False


def window_hash(words: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of every run of ``n`` consecutive entries."""
    with np.errstate(over="ignore"):
        out = words[: len(words) - n + 1].copy()
        for j in range(1, n):
            out *= _ODD
            out += words[j : len(words) - n + 1 + j]
    return mix64(out)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The integers of all ranges ``start .. start + length``, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def super_k_mers(hashes: np.ndarray, doc_of: np.ndarray, window: int, group: int) -> tuple[np.ndarray, ...]:
    """Start, number of windows and minimiser of every super-k-mer of documents laid end to end.

    ``hashes`` has a hash per word, ``doc_of`` its document; no window crosses a document's end.
    """
    if len(hashes) < window:
        none = np.empty(0, np.int64)
        return none, none, np.empty(0, np.uint64)
    least = sliding_window_view(window_hash(hashes, group), window - group + 1).min(axis=1)
    whole = doc_of[: len(least)] == doc_of[window - 1 :]
    new = np.ones(len(least), bool)
    new[1:] = (least[1:] != least[:-1]) | (doc_of[1 : len(least)] != doc_of[: len(least) - 1]) | ~whole[:-1]
    starts = np.flatnonzero(new & whole)
    ends = np.append(np.flatnonzero(new | ~whole), len(least))
    stop = ends[np.searchsorted(ends, starts, side="right")]
    return starts, stop - starts, least[starts]


def planes(x: np.ndarray) -> bytes:
    """The numbers byte by byte, all lowest bytes first: equal high bytes lie together and compress."""
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def from_planes(raw: bytes, kind: type, n: int, at: int) -> np.ndarray:
    size = kind().itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n).T).view(kind).ravel()


def numbered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for every word, equal for equal words only, and for every number a place in ``data`` that has its word.

    Words are gathered by hash and compared with their number's word byte by byte; should two words share a hash, all are
    numbered by their bytes.
    """
    _, first, ids = np.unique(hashes, return_index=True, return_inverse=True)
    length = ends - starts
    same = bool(np.all(length == length[first][ids]))
    for at in range(0, len(starts) if same else 0, 1 << 16):
        here = slice(at, at + (1 << 16))
        own, its = ranges(starts[here], length[here]), ranges(starts[first[ids[here]]], length[here])
        same = same and bool(np.array_equal(data[own], data[its]))
    if not same:
        raw, number = data.tobytes(), Numbers()
        ids = np.fromiter((number[raw[s:e]] for s, e in zip(starts.tolist(), ends.tolist())), np.int64, len(starts))
        first = np.unique(ids, return_index=True)[1]
    return ids.astype(np.uint32), first


def pack_block(doc: np.ndarray, row: np.ndarray, at: np.ndarray, windows: np.ndarray, ids: np.ndarray, raw: bytes, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """One block: document numbers, row keys, starts, window counts and words of its super-k-mers, with its word list.

    Words are numbered by how often they occur; documents and row keys are listed once per run of super-k-mers. The word
    of a number is at ``starts`` and ``ends`` in ``raw``.
    """
    if len(ids) * 8 < len(starts):
        used, local, count = np.unique(ids, return_inverse=True, return_counts=True)
    else:
        every = np.bincount(ids, minlength=len(starts))
        used = np.flatnonzero(every)
        count = every[used]
        every[used] = np.arange(len(used))
        local = every[ids]
    order = np.argsort(-count, kind="stable")
    place = np.empty(len(used), np.int64)
    place[order] = np.arange(len(used))
    listed = used[order]
    words = b"\x20".join([raw[s:e] for s, e in zip(starts[listed].tolist(), ends[listed].tolist())])
    kind = np.uint16 if len(used) < 1 << 16 else np.uint32
    new = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (row[1:] != row[:-1])))
    runs = np.diff(np.append(new, len(doc))).astype(np.int32)
    head = np.asarray([len(doc), len(new), len(ids), len(words), kind().itemsize], np.int64)
    parts = (doc[new].astype(np.int64), row[new].astype(np.int64), runs, at.astype(np.int32), windows.astype(np.int32), place[local].astype(kind))
    return zstandard.ZstdCompressor(level=3).compress(head.tobytes() + b"".join(map(planes, parts)) + words)


def unpack_block(block: bytes) -> tuple:
    raw = zstandard.ZstdDecompressor().decompress(block)
    n, d, m, w, size = np.frombuffer(raw, np.int64, 5).tolist()
    to, parts = 40, []
    for kind, k in ((np.int64, d), (np.int64, d), (np.int32, d), (np.int32, n), (np.int32, n), (np.uint16 if size == 2 else np.uint32, m)):
        parts.append(from_planes(raw, kind, k, to))
        to += k * kind().itemsize
    doc, row, runs, at, windows, ids = parts
    return np.repeat(doc, runs), np.repeat(row, runs), at, windows, ids, raw[len(raw) - w :]


def repeats(ids: np.ndarray, starts: np.ndarray, doc: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    """For every window, given by its start in ``ids``, whether the same words start at a smaller (doc, at)."""
    hashed = window_hash(mix64(ids.astype(np.uint64)), window)[starts]
    order = np.argsort(hashed, kind="stable")
    h = hashed[order]
    edge = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
    sizes = np.diff(np.append(edge, len(h)))
    out = np.zeros(len(starts), bool)
    several = np.repeat(sizes > 1, sizes)
    order, group = order[several], np.repeat(np.arange((sizes > 1).sum()), sizes[sizes > 1])
    if not len(order):
        return out
    order = order[np.lexsort((at[order], doc[order], group))]
    first = order[np.append(0, np.flatnonzero(np.diff(group)) + 1)][group]
    same = np.ones(len(order), bool)
    for j in range(window):
        same &= ids[starts[order] + j] == ids[starts[first] + j]
    for g in np.unique(group[~same]):  # one hash for different words: settle the group by the words themselves
        earliest: dict[bytes, tuple] = {}
        for i in order[group == g].tolist():
            here = (int(doc[i]), int(at[i]))
            out[i] = earliest.setdefault(ids[starts[i] : starts[i] + window].tobytes(), here) < here
        same[group == g] = False
    later = (doc[order] > doc[first]) | (at[order] > at[first])
    out[order[same & later]] = True
    return out


def spans(key: np.ndarray, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows that start one word after the other, as (index of the first, first word, number of words)."""
    new = np.append(True, (key[1:] != key[:-1]) | (at[1:] != at[:-1] + 1)) if len(at) else np.empty(0, bool)
    first = np.flatnonzero(new)
    return first, at[first], np.diff(np.append(first, len(at))) + window - 1


def send(batches: Iterator[dict], window: int, group: int, buckets: int, batch_bytes: int = 8_000_000) -> Iterator[dict]:
    """Blocks of super-k-mers by bucket, and the spans that a batch settles by itself (as rows of bucket -1 - n)."""
    give_back()
    docs: list[tuple[int, int, bytes]] = []
    held = 0
    for b in batches:
        for i, k, t in zip(b["id"].to_pylist(), b["row_key"].to_pylist(), b["text"].cast(pa.binary())):
            if i is not None:
                docs.append((i, k, t.as_py() or b""))
                held += len(docs[-1][2])
                if held >= batch_bytes:
                    yield from _send(docs, window, group, buckets)
                    docs, held = [], 0
                    give_back()
        del b
    yield from _send(docs, window, group, buckets)
    del docs
    give_back()


class Numbers(dict):
    """Numbers for words, given as they are first asked for."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def _send(docs: list, window: int, group: int, buckets: int) -> Iterator[dict]:
    docs.sort(key=lambda d: d[:2])
    raw = b"".join([d[2] for d in docs])
    data = np.frombuffer(raw, np.uint8)
    bounds = np.append(0, np.cumsum([len(d[2]) for d in docs])).astype(np.int64)
    starts, ends, word_hash = word_places(data, bounds[:-1], lower=_AS_IS, letters=_LETTERS)
    sizes = np.diff(np.searchsorted(starts, bounds))
    enough = np.repeat(sizes >= window, sizes)
    docs = [d for d, n in zip(docs, sizes.tolist()) if n >= window]
    if not docs:
        return
    sizes = sizes[sizes >= window]
    starts, ends, word_hash = starts[enough], ends[enough], word_hash[enough]
    ids, first = numbered(data, starts, ends, word_hash)
    word_starts, word_ends = starts[first], ends[first]
    hashes = mix64(word_hash)
    del starts, ends, word_hash, enough
    doc_of = np.repeat(np.arange(len(docs)), sizes)
    starts, n, least = super_k_mers(hashes, doc_of, window, group)
    doc_id, row_key = np.asarray([d[0] for d in docs], np.int64), np.asarray([d[1] for d in docs], np.int64)
    own = doc_of[starts]
    at = starts - (np.cumsum(sizes) - sizes)[own]

    # the same super-k-mer again in this batch: every window of it starts earlier, unless it is the same place
    seen: dict[bytes, tuple[int, int]] = {}
    keep = np.ones(len(starts), bool)
    bytes_of = ids.tobytes()
    h = window_hash(hashes, window)[starts] if len(starts) else least
    order = np.lexsort((n, h))
    h, m = h[order], n[order]
    twin = np.zeros(len(order), bool)
    twin[1:] = (h[1:] == h[:-1]) & (m[1:] == m[:-1])
    twin[:-1] |= twin[1:]
    for i in np.sort(order[twin]).tolist():  # in order of document and place
        s = int(starts[i])
        here = (int(doc_id[own[i]]), int(at[i]))
        keep[i] = seen.setdefault(bytes_of[4 * s : 4 * (s + int(n[i]) + window - 1)], here) == here
    settled = np.flatnonzero(~keep)
    bucket, block, doc, row, first, length = [], [], [], [], [], []
    if len(settled):
        windows = ranges(at[settled], n[settled])
        f, a, w = spans(np.repeat(own[settled], n[settled]), windows, window)
        who = np.repeat(own[settled], n[settled])[f]
        bucket += [-1 - x % 1024 for x in range(len(f))]
        block += [None] * len(f)
        doc, row, first, length = doc_id[who].tolist(), row_key[who].tolist(), a.tolist(), w.tolist()
    kept = np.flatnonzero(keep)
    where = (least[kept] >> np.uint64(11)) % np.uint64(buckets)
    kept = kept[np.argsort(where, kind="stable")]
    where = np.sort(where)
    for b, part in zip(np.unique(where).tolist(), np.split(kept, np.flatnonzero(np.diff(where)) + 1)) if len(kept) else ():
        words = ids[ranges(starts[part], n[part] + window - 1)]
        bucket.append(int(b))
        block.append(pack_block(doc_id[own[part]], row_key[own[part]], at[part], n[part], words, raw, word_starts, word_ends))
        doc.append(None)
        row.append(None)
        first.append(None)
        length.append(None)
    yield {"bucket": bucket, "block": block, "id": doc, "row_key": row, "first": first, "length": length}


def meet(bucket: pa.Table, window: int) -> dict:
    """The spans of one bucket's windows that are repeats, and the spans that batches settled, as they came."""
    done = bucket.filter(bucket["block"].is_null())
    out = {c: [done[c].combine_chunks().to_numpy(zero_copy_only=False)] for c in ("id", "row_key", "first", "length")}
    parts, lists = [], []
    for block in bucket["block"].drop_null():
        *numbers, words = unpack_block(block.as_py())
        parts.append(numbers)
        lists.append(words)
    if parts:
        # the blocks' word lists end to end: one number for a word of all blocks
        data = np.frombuffer(b"\x20".join(lists), np.uint8)
        names, _ = numbered(data, *word_places(data, np.zeros(1, np.int64), lower=_AS_IS, letters=_LETTERS))
        size = np.asarray([x.count(b"\x20") + 1 for x in lists])
        for p, to, k in zip(parts, np.cumsum(size).tolist(), size.tolist()):
            p[4] = names[to - k : to][p[4]]
        doc, row, at, n, ids = (np.concatenate(x) for x in zip(*parts))
        text_starts = np.cumsum(n + window - 1) - (n + window - 1)
        starts, places = ranges(text_starts, n), ranges(at.astype(np.int64), n)
        own = np.repeat(np.arange(len(n)), n)
        hit = np.flatnonzero(repeats(ids, starts, doc[own], places, window))
        f, a, w = spans(own[hit], places[hit], window)
        for c, v in (("id", doc[own[hit][f]]), ("row_key", row[own[hit][f]]), ("first", a), ("length", w)):
            out[c].append(v)
    return {c: np.concatenate([x.astype(np.int64) for x in v]) for c, v in out.items()}


def repeated_spans(docs: DataFrame, *, id_col: str, text_col: str, window: int, group: int, words_per_bucket: int) -> DataFrame:
    """``id, row_key, first, length``: the runs of words of documents that repeated windows cover, as they were found."""
    source = docs.select(
        F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("row_key"), F.col(text_col).alias("text")
    ).where(F.col("text").isNotNull())
    total = docs.agg(F.sum(F.length(text_col))).first()[0] or 0
    buckets = max(12, int(total / 6 // words_per_bucket) + 1)
    sent = arrow_pass(
        source, lambda batches: send(batches, window, group, buckets),
        "bucket long, block binary, id long, row_key long, first long, length long",
    )

    def met(rows: pa.Table) -> pa.Table:
        found = meet(rows, window)
        give_back()
        return pa.table({c: as_array(found[c], pa.int64()) for c in ("id", "row_key", "first", "length")})

    found = sent.groupBy("bucket").applyInArrow(met, "id long, row_key long, first long, length long")
    return materialise(found, "spans")


#: Bits of the sketch of documents with spans, for each span and at most; it is broadcast, 32 MB at most. Documents that it
#: wrongly takes for some with spans are joined and keep all words, so its size only decides how many texts are shuffled.
BITS_A_SPAN = 16
MOST_BITS = 1 << 28


def sketched(found: DataFrame) -> np.ndarray:
    """One bit for every hash of a document that has a span."""
    spans = found.count()
    bits = min(MOST_BITS, max(1 << 15, 1 << int(BITS_A_SPAN * spans).bit_length()))
    place = F.pmod(F.xxhash64("id", "row_key"), F.lit(bits)) + 1
    packed = found.select(place.alias("place")).groupBy(F.expr("bitmap_bucket_number(place)").alias("bucket")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(place))").alias("bits")
    )
    out = np.zeros(bits // 8, np.uint8)
    for r in packed.toLocalIterator():
        at = (r["bucket"] - 1) * 4096
        out[at : at + 4096] |= np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


def kept_words(words: list[str], found: list[dict] | None) -> list[str]:
    """The words that no span covers."""
    if not found:
        return words
    keep = np.ones(len(words) + 1, bool)
    for s in found:
        keep[s["first"] : s["first"] + s["length"]] = False
    return [words[i] for i in np.flatnonzero(keep[:-1]).tolist()]


def drop_repeats(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 20,
    group: int = 4,
    words_per_bucket: int = 800_000,
) -> DataFrame:
    """Every input row with ``n_words, n_removed, kept_text`` added: words that repeated windows cover are taken out.

    A window is ``window`` consecutive words of one document (words: between ASCII white space, unchanged); it is
    repeated if the same words also start in a document of smaller id or earlier in the same document. Windows are
    judged on the input. ``kept_text`` is the input text itself where nothing is removed, else the kept words joined by
    a space.

    Null and empty texts, and texts shorter than a window, lose nothing; null stays null. Rows with the same id and
    text are one document told twice: none repeats the other. Rows with null ids are neither changed nor compared. An
    empty table gives an empty one. Other columns pass through, but for one called like an added column, which that replaces.
    """
    found = repeated_spans(docs, id_col=id_col, text_col=text_col, window=window, group=group, words_per_bucket=words_per_bucket)
    own = [c for c in docs.columns if c not in ("n_words", "n_removed", "kept_text")]
    text = f"c{own.index(text_col)}"
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(own)])
    rows = rows.withColumns({"id": F.col(f"c{own.index(id_col)}").cast("long"), "row_key": F.xxhash64(text)})
    rows = rows.withColumn("place", F.xxhash64("id", "row_key"))
    sketch = docs.sparkSession.sparkContext.broadcast(sketched(found))
    kept_columns = [*rows.columns[: len(own)]]
    ddl_rows = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "place")
    ddl = ", ".join([*[f"{c} {rows.schema[c].dataType.simpleString()}" for c in kept_columns], "n_words long", "n_removed long", "kept_text string"])

    def split(batches: Iterator[dict], with_spans: bool) -> Iterator[dict]:
        """The rows of documents that may have spans, or of the others."""
        bits = sketch.value
        for b in batches:
            place = b["place"].to_numpy(zero_copy_only=False) % (8 * len(bits))
            some = (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
            here = pa.array(np.flatnonzero(some == with_spans))
            if len(here):
                yield {c: v.take(here) for c, v in b.items() if c != "place"}

    def take_out(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            n, removed, kept = [], [], []
            spans = b["spans"] if "spans" in b else [None] * len(b[text])
            for t, s in zip(b[text], spans):
                t, s = t.as_py(), s.as_py() if s is not None else None
                words = words_of(t)
                rest = kept_words(words, s)
                n.append(len(words))
                removed.append(len(words) - len(rest))
                kept.append(t if len(rest) == len(words) else " ".join(rest))
            yield {**{c: b[c] for c in kept_columns}, "n_words": n, "n_removed": removed, "kept_text": kept}

    untouched = arrow_pass(rows, lambda batches: take_out(split(batches, False)), ddl)
    told = arrow_pass(rows, lambda batches: split(batches, True), ddl_rows)
    of = found.groupBy("id", "row_key").agg(F.collect_list(F.struct("first", "length")).alias("spans"))
    of = of.withColumnsRenamed({"id": "fid", "row_key": "fkey"})
    joined = told.join(of, on=(F.col("id") == F.col("fid")) & (F.col("row_key") == F.col("fkey")), how="left").select(*kept_columns, "spans")
    cut = arrow_pass(joined, take_out, ddl)
    return untouched.unionByName(cut).toDF(*own, "n_words", "n_removed", "kept_text")


def removal_digest(docs: DataFrame, **parameters) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256``: the digest of the kept words joined by one space."""
    kept = drop_repeats(docs.select("doc_id", "text"), **parameters)
    one_space = F.array_join(F.regexp_extract_all("kept_text", F.lit(f"({WORD_PATTERN})"), F.lit(1)), " ")
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.coalesce(one_space, F.lit("")), 256).alias("kept_sha256"))
