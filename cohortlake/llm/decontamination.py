"""Passages of test items in training texts, by a generalised suffix automaton.

The items are normalised to words, and one automaton holds every run of words of every item. Training words stream
through it: at each word it gives the longest run of item words that ends there, going down suffix links where a run
breaks. A run of at least ``window`` words is an occurrence of an item's window; an item shorter than a window occurs
where the run ends in the whole item.

Words are told apart by 64-bit hashes of their bytes while they stream, and every word that counts as hit is then
compared letter by letter; a document in which one differs is streamed again by the words themselves. Long documents are
cut into lanes that overlap by ``window - 1`` words, so the lanes of a batch advance together, one word a step.

Items go to blocks of a bounded number of words. A block's automaton is built in a task and broadcast; its size is bounded
by the block's words, whatever the number of items, and documents pass once per block.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.llm.common import arrow_pass, mix64
from cohortlake.sources.workspace import materialise

#: After lower-casing A-Z: digits, a-z and everything beyond ASCII.
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, bool)
_IS_WORD[48:58] = _IS_WORD[97:123] = _IS_WORD[128:] = True
_BYTE_VALUE = mix64(np.arange(256, dtype=np.uint64))
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}

#: Bytes of text hashed at once, bytes of documents streamed at once, and words of a lane.
SLAB = 1 << 20
GATHER = 1 << 22
LANE = 256


def _powers(base: int, n: int) -> np.ndarray:
    """``base`` to the powers 0 to n - 1, modulo 2^64."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        x = np.full(max(n, SLAB), base, np.uint64)
        x[0] = 1
        with np.errstate(over="ignore"):
            have = _POWERS[base] = np.cumprod(x, dtype=np.uint64)
    return have[:n]


def _slab_words(low: np.ndarray, cuts: np.ndarray, letters: np.ndarray = _IS_WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    word = letters[low]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    first[cuts] = word[cuts]
    last[cuts - 1] = word[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    with np.errstate(over="ignore"):
        sums = np.zeros(len(low) + 1, np.uint64)
        np.cumsum(_BYTE_VALUE[low] * _powers(_BASE, len(low)), dtype=np.uint64, out=sums[1:])
        hashes = (sums[ends] - sums[starts]) * _powers(_BASE_INVERSE, len(low))[starts] if len(starts) else np.empty(0, np.uint64)
    return starts, ends, hashes


def word_places(
    data: np.ndarray, bounds: np.ndarray, slab: int = SLAB, lower: np.ndarray = _LOWER, letters: np.ndarray = _IS_WORD
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of every word of UTF-8 texts laid end to end; ``bounds`` are the texts' first bytes, sorted.

    ``lower`` maps bytes before they are hashed, ``letters`` tells the mapped bytes that words are made of. Works through
    the bytes in slabs that end between words, so its scratch space does not grow with a text.
    """
    at, parts = 0, []
    while at < len(data):
        to = min(at + slab, len(data))
        while to < len(data):
            part = data[at:to]
            gaps = np.flatnonzero(~letters[lower[part]])
            bound = bounds[max(np.searchsorted(bounds, to, side="right") - 1, 0)]
            cut = max(at + int(gaps[-1]) + 1 if len(gaps) else at, int(bound))
            if cut > at:
                to = cut
                break
            to = min(to + slab, len(data))  # one word longer than the slab
        inside = bounds[np.searchsorted(bounds, at, side="right") : np.searchsorted(bounds, to, side="left")] - at
        starts, ends, hashes = _slab_words(lower[data[at:to]], inside, letters)
        parts.append((starts + at, ends + at, hashes))
        at = to
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*parts))


def word_hash(word: bytes) -> int:
    data = np.frombuffer(word, np.uint8)
    return int(word_places(data, np.zeros(1, np.int64))[2][0])


# -- the automaton ---------------------------------------------------------------------------------


@dataclass
class Automaton:
    """Arrays of a generalised suffix automaton over numbered words; state 0 is the root.

    ``step`` holds ``state * words + word`` sorted, ``to`` the states it leads to. ``up`` is the state that holds a state's
    last ``window`` words, ``near`` the closest state at or above it that is a whole short item. ``at`` and ``item`` list
    the items of window states and of whole short items, ordered by state.
    """

    window: int
    words: list[bytes]
    hashes: np.ndarray
    number: np.ndarray
    step: np.ndarray
    to: np.ndarray
    link: np.ndarray
    longest: np.ndarray
    up: np.ndarray
    near: np.ndarray
    at: np.ndarray
    item: np.ndarray
    items: list[str]
    least: int

    @property
    def collides(self) -> bool:
        return len(np.unique(self.hashes)) < len(self.hashes)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Word numbers by hash, -1 for words of no item."""
        if not len(self.hashes):
            return np.full(len(hashes), -1, np.int64)
        i = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[i] == hashes, self.number[i], -1)

    def dump(self) -> bytes:
        return zstandard.ZstdCompressor(level=3).compress(pickle.dumps(self.__dict__, protocol=4))

    @staticmethod
    def load(raw: bytes) -> Automaton:
        return Automaton(**pickle.loads(zstandard.ZstdDecompressor().decompress(raw)))


def build(items: Sequence[tuple[str | None, Sequence[str]]], window: int) -> Automaton:
    """The automaton of ``(item id, words)``. A null id is matched but listed nowhere; items without words are nothing."""
    number: dict[str, int] = {}
    step: list[dict[int, int]] = [{}]
    link, longest = [-1], [0]

    def state(length: int, above: int, steps: dict[int, int]) -> int:
        step.append(steps)
        link.append(above)
        longest.append(length)
        return len(step) - 1

    def split(p: int, w: int, q: int) -> int:
        """A state of its own for the runs of ``q`` that end in ``p`` and ``w``."""
        twin = state(longest[p] + 1, link[q], dict(step[q]))
        while p != -1 and step[p].get(w) == q:
            step[p][w] = twin
            p = link[p]
        link[q] = twin
        return twin

    def extend(last: int, w: int) -> int:
        q = step[last].get(w)
        if q is not None:
            return q if longest[q] == longest[last] + 1 else split(last, w, q)
        new, p = state(longest[last] + 1, 0, {}), last
        while p != -1 and w not in step[p]:
            step[p][w] = new
            p = link[p]
        if p != -1:
            q = step[p][w]
            link[new] = q if longest[q] == longest[p] + 1 else split(p, w, q)
        return new

    coded = [(i, [number.setdefault(w, len(number)) for w in words]) for i, words in items if len(words)]
    for _, words in coded:
        last = 0
        for w in words:
            last = extend(last, w)

    n = len(step)
    above, size = np.asarray(link), np.asarray(longest)
    by_length = np.argsort(size, kind="stable")[1:].tolist()
    up, near = np.arange(n), np.full(n, -1)
    whole: set[int] = set()
    found: set[tuple[int, int]] = set()
    names: dict[str, int] = {}
    for s in by_length:
        if size[above[s]] >= window:
            up[s] = up[above[s]]
    for name, words in coded:
        i = -1 if name is None else names.setdefault(name, len(names))
        s = 0
        for k, w in enumerate(words):
            s = step[s][w]
            if k + 1 >= window and i >= 0:
                found.add((int(up[s]), i))
        if len(words) < window:
            whole.add(s)
            if i >= 0:
                found.add((s, i))
    for s in by_length:
        near[s] = s if s in whole else near[above[s]]
    ordered = np.asarray(sorted(found), np.int64).reshape(-1, 2)
    v = max(len(number), 1)
    key = np.asarray([s * v + w for s, steps in enumerate(step) for w in steps], np.int64)
    to = np.asarray([q for steps in step for q in steps.values()], np.int64)
    order = np.argsort(key)
    words = [w.encode("utf-8", "surrogatepass") for w in number]
    hashes = np.asarray([word_hash(w) for w in words], np.uint64)
    by_hash = np.argsort(hashes, kind="stable")
    least = min([window, *[len(w) for _, w in coded]])
    return Automaton(
        window, words, hashes[by_hash], by_hash, key[order], to[order], above, size, up, near, ordered[:, 0], ordered[:, 1], list(names), least
    )


def stream(a: Automaton, words: np.ndarray, bounds: np.ndarray, lane: int = LANE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where runs of at least ``a.least`` item words end: word place, state and length of the longest run, capped by the lane.

    ``words`` are the numbers of documents' words laid end to end, ``bounds`` the documents' first places and the end.
    """
    sizes = np.diff(bounds)
    cuts = -(-sizes // lane)
    k = np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    home, size = np.repeat(bounds[:-1], cuts), np.repeat(sizes, cuts)
    begin = home + np.maximum(k * lane - (a.window - 1), 0)
    length = home + np.minimum((k + 1) * lane, size) - begin
    order = np.argsort(-length, kind="stable")
    begin, length = begin[order], length[order]
    state, run = np.zeros(len(begin), np.int64), np.zeros(len(begin), np.int64)
    v, last = max(len(a.words), 1), len(a.step) - 1
    out = []
    for t in range(int(length[0]) if len(length) else 0):
        active = int(np.searchsorted(-length, -t, side="left"))
        word = words[begin[:active] + t]
        s, r = state[:active], run[:active]
        unknown = word < 0
        s[unknown] = 0
        r[unknown] = 0
        open_ = np.flatnonzero(~unknown)
        while len(open_):
            key = s[open_] * v + word[open_]
            i = np.minimum(np.searchsorted(a.step, key), last)
            met = a.step[i] == key
            on = open_[met]
            s[on] = a.to[i[met]]
            r[on] += 1
            open_ = open_[~met]
            s[open_] = a.link[s[open_]]
            r[open_] = a.longest[s[open_]]
        long = np.flatnonzero(r >= a.least)
        if len(long):
            out.append((begin[long] + t, s[long], r[long]))
    if not out:
        none = np.empty(0, np.int64)
        return none, none, none
    return tuple(np.concatenate(x) for x in zip(*out))


def occurrences(a: Automaton, place: np.ndarray, state: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of words and state of every window, and every whole short item, that ends at these places."""
    long = run >= a.window
    out = [(place[long] - a.window + 1, np.full(long.sum(), a.window), a.up[state[long]])]
    here = a.near[state]
    inside = (here == state) & (run < a.longest[state])  # the run ends in less than the whole item
    here[inside] = a.near[a.link[state[inside]]]
    while True:
        some = here > 0
        if not some.any():
            return tuple(np.concatenate(x) for x in zip(*out))
        place, here = place[some], here[some]
        out.append((place - a.longest[here] + 1, a.longest[here], here))
        here = a.near[a.link[here]]


def judge(a: Automaton, texts: Sequence[bytes]) -> tuple[list[int], list[int], list[list], list[list[str]]]:
    """Per text: number of words, of hit words, runs of hit words as (first, length), and the items that occur."""
    sizes = np.asarray([len(t) for t in texts], np.int64)
    bounds = np.append(0, np.cumsum(sizes))
    data = np.frombuffer(b"".join(texts), np.uint8)
    starts, ends, hashes = word_places(data, bounds[:-1])
    first = np.searchsorted(starts, bounds)
    numbers = a.numbers(hashes)
    if a.collides:
        numbers = _by_letter(a, data, starts, ends)
    covered, who = _hits(a, numbers, first)
    hit = np.flatnonzero(covered)
    wrong = [i for i in hit.tolist() if a.words[numbers[i]] != _LOWER[data[starts[i] : ends[i]]].tobytes()]
    if wrong:  # another word with an item word's hash
        numbers = _by_letter(a, data, starts, ends)
        covered, who = _hits(a, numbers, first)
    return (*_per_text(covered, first), [[a.items[i] for i in found] for found in who])


def _by_letter(a: Automaton, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    number = {w: i for i, w in enumerate(a.words)}
    raw = _LOWER[data].tobytes()
    return np.asarray([number.get(raw[s:e], -1) for s, e in zip(starts.tolist(), ends.tolist())], np.int64)


def _hits(a: Automaton, numbers: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, list[list[int]]]:
    start, n, state = occurrences(a, *stream(a, numbers, first))
    change = np.zeros(len(numbers) + 1, np.int64)
    np.add.at(change, start, 1)
    np.add.at(change, start + n, -1)
    text = np.searchsorted(first, start, side="right") - 1
    pairs = np.unique(np.stack([text, state], axis=1), axis=0) if len(start) else np.empty((0, 2), np.int64)
    who: list[set[int]] = [set() for _ in first[:-1]]
    low, high = np.searchsorted(a.at, pairs[:, 1], side="left"), np.searchsorted(a.at, pairs[:, 1], side="right")
    for t, i, j in zip(pairs[:, 0].tolist(), low.tolist(), high.tolist()):
        who[t].update(a.item[i:j].tolist())
    return np.cumsum(change[:-1]) > 0, [sorted(w) for w in who]


def _per_text(covered: np.ndarray, first: np.ndarray) -> tuple[list[int], list[int], list[list]]:
    total = np.append(0, np.cumsum(covered))
    spans: list[list] = [[] for _ in first[:-1]]
    edge = np.append(True, covered[1:] != covered[:-1]) if len(covered) else np.empty(0, bool)
    edge[first[:-1][first[:-1] < len(covered)]] = True
    at = np.flatnonzero(edge)
    length = np.diff(np.append(at, len(covered)))
    kept = covered[at]
    for t, f, n in zip((np.searchsorted(first, at[kept], side="right") - 1).tolist(), at[kept].tolist(), length[kept].tolist()):
        spans[t].append({"first": f - int(first[t]), "length": n})
    return np.diff(first).tolist(), np.diff(total[first]).tolist(), spans


# -- on tables -------------------------------------------------------------------------------------

_FOUND = "n_words long, n_hit long, spans array<struct<first: long, length: long>>, items array<string>"


def item_words(benchmark: DataFrame, *, item_col: str, text_col: str, window: int, piece: int) -> DataFrame:
    """``item, words``: an item's words, in pieces of ``piece`` words that overlap by ``window - 1`` if it has more."""
    lower = F.translate(F.col(f"`{text_col}`"), UPPER, UPPER.lower())
    words = benchmark.select(F.col(f"`{item_col}`").cast("string").alias("item"), F.regexp_extract_all(lower, F.lit(WORD_PATTERN), F.lit(0)).alias("all"))
    words = words.where(F.size("all") > 0)
    last = F.greatest(F.size("all") - window, F.lit(0))
    starts = F.explode(F.sequence(F.lit(0), last, F.lit(piece)))
    return words.select("item", "all", starts.alias("start")).select("item", F.expr(f"slice(all, start + 1, {piece + window - 1})").alias("words"))


def automata(benchmark: DataFrame, *, item_col: str, text_col: str, window: int, block_words: int) -> DataFrame:
    """``block, automaton``: the items in blocks of about ``block_words`` words, each built in a task."""
    pieces = materialise(item_words(benchmark, item_col=item_col, text_col=text_col, window=window, piece=max(block_words // 8, 1)), "items")
    total = pieces.agg(F.sum(F.size("words").cast("long"))).first()[0] or 0
    blocks = int(-(-total // block_words))
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64("item", "words"), F.lit(max(blocks, 1))).cast("int"))

    def built(rows: pa.Table) -> pa.Table:
        items = list(zip(rows["item"].to_pylist(), rows["words"].to_pylist()))
        return pa.table({"block": pa.array([rows["block"][0].as_py()], pa.int32()), "automaton": pa.array([build(items, window).dump()], pa.binary())})

    return materialise(dealt.groupBy("block").applyInArrow(built, "block int, automaton binary"), "automata")


def _scan(docs: DataFrame, text: str, raw: bytes, only_hits: bool) -> DataFrame:
    """``docs`` with what one automaton finds, with all rows or those with hits."""
    shared = docs.sparkSession.sparkContext.broadcast(raw)
    names = docs.columns

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        a = Automaton.load(shared.value)
        for b in batches:
            texts = b[text].cast(pa.binary())
            sizes = pc.binary_length(texts).fill_null(0).to_numpy()
            part = (np.cumsum(sizes) - sizes) // GATHER
            for i in np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(part)) + 1):
                lo, hi = int(i[0]), int(i[-1]) + 1
                n, hit, spans, items = judge(a, [x or b"" for x in texts.slice(lo, hi - lo).to_pylist()])
                out = {c: b[c].slice(lo, hi - lo) for c in names} | {"n_words": n, "n_hit": hit, "spans": spans, "items": items}
                if only_hits:
                    keep = [k for k, h in enumerate(hit) if h]
                    out = {c: v.take(pa.array(keep, pa.int64())) if isinstance(v, pa.Array) else [v[k] for k in keep] for c, v in out.items()}
                yield out

    ddl = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema], _FOUND])
    return arrow_pass(docs, run, ddl)


def _united(found: DataFrame) -> DataFrame:
    """Runs and items of several automata as one: ``n_hit, spans, items`` from lists of them."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            spans, items, hit = [], [], []
            for ss, ii in zip(b["spans"].to_pylist(), b["items"].to_pylist()):
                places = sorted({w for s in ss or [] for w in range(s["first"], s["first"] + s["length"])})
                x = np.asarray(places, np.int64)
                at = np.flatnonzero(np.append(True, np.diff(x) > 1)) if len(x) else x
                spans.append([{"first": int(x[i]), "length": int(j - i)} for i, j in zip(at, np.append(at[1:], len(x)))])
                hit.append(len(x))
                items.append(sorted(set(ii or [])))
            yield {**b, "n_hit": hit, "spans": spans, "items": items}

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema)
    return arrow_pass(found, run, ddl)


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    block_words: int = 500_000,
) -> DataFrame:
    """Every row of ``docs`` with ``n_words, n_hit, spans, items``: its words, those inside an occurrence of an item's window.

    A window is ``window`` consecutive words of an item; an item of fewer words, but not none, is one window. ``spans`` are
    runs of hit words as (first, length) in words, ``items`` the ids, as strings, of items with occurring windows.

    Null and empty texts have no words. Items without words occur nowhere; an item with a null id marks words but is not
    listed, and an id given to several texts is listed once. Repeated rows and rows with null ids are judged like others.
    Very long texts are worked through in slabs, very long items cut into overlapping pieces. No items, or no documents:
    nothing is hit, or no rows. Other columns pass through, but for one called like an added column, which that replaces.
    """
    own = [c for c in docs.columns if c not in ("n_words", "n_hit", "spans", "items")]
    text = f"c{own.index(text_col)}"
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(own)])
    built = automata(benchmark, item_col=item_col, text_col=item_text_col, window=window, block_words=block_words)
    blocks = [r.block for r in built.select("block").collect()]

    def automaton(block: int) -> bytes:
        return bytes(built.where(F.col("block") == block).first()["automaton"])

    if len(blocks) <= 1:
        raw = automaton(blocks[0]) if blocks else build([], window).dump()
        found = _scan(rows, text, raw, False)
    else:
        key = [F.col(f"c{own.index(id_col)}").alias("k_id"), F.sha2(text, 256).alias("k_text")]
        hits = [materialise(_scan(rows.select(text, *key), text, automaton(b), True).drop(text).dropDuplicates(["k_id", "k_text"]), "hits") for b in blocks]
        every = hits[0]
        for h in hits[1:]:
            every = every.unionByName(h)
        by_row = every.groupBy("k_id", "k_text").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
        left = _scan(rows, text, build([], window).dump(), False).drop("spans", "items").withColumn("k_text", F.sha2(text, 256))
        same = F.col(f"c{own.index(id_col)}").eqNullSafe(F.col("k_id")) & (left["k_text"] == by_row["k_text"])
        joined = left.join(by_row, same, "left").drop("k_id", "k_text")
        found = _united(joined.select(*rows.columns, "n_words", "n_hit", "spans", "items"))
    return found.toDF(*own, "n_words", "n_hit", "spans", "items")


def without_spans(text: str, spans: Sequence[dict]) -> str:
    """The text less its hit words and what stands between them; what is left is joined by one space."""
    raw = text.encode("utf-8", "surrogatepass")
    starts, ends, _ = word_places(np.frombuffer(raw, np.uint8), np.zeros(1, np.int64))
    parts, at = [], 0
    for s in spans:
        parts.append(raw[at : starts[s["first"]]])
        at = int(ends[s["first"] + s["length"] - 1])
    parts.append(raw[at:])
    return " ".join(t for t in (p.decode("utf-8", "surrogatepass").strip() for p in parts) if t)


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", max_coverage: float = 0.5, **parameters) -> DataFrame:
    """The rows to train on: hit words are cut out of ``text_col``, and rows with a larger share of hit words than
    ``max_coverage`` are left out. Cases as in :func:`find`; texts without hits stay as they are, null stays null."""
    found = find(docs, benchmark, text_col=text_col, **parameters)
    kept = found.where(F.col("n_hit") <= F.col("n_words") * F.lit(float(max_coverage)))
    columns = [c for c in found.columns if c not in ("n_words", "n_hit", "spans", "items")]
    numbered = kept.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)], "spans")
    text = f"c{columns.index(text_col)}"

    def cut(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            texts = [without_spans(t, s) if s else t for t, s in zip(b[text].to_pylist(), b["spans"].to_pylist())]
            yield {**b, text: texts}

    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in numbered.schema if f.name != "spans")
    return arrow_pass(numbered, cut, ddl).toDF(*columns)


def digest(docs: DataFrame, benchmark: DataFrame, **parameters) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of :func:`find`."""
    found = find(docs.select("doc_id", "text"), benchmark, **parameters)
    listed = F.array_join(F.array_sort("items"), ",")
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(listed, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )
