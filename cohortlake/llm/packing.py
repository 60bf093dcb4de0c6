"""Best-fit-decreasing packing of tokenized documents into sequences of fixed length.

Documents become pieces of at most one sequence; a piece's row carries its length and a digest of its ids, not the ids.
Pieces are dealt over shards of bounded size, and each shard is packed longest first into the fullest open sequence with
room, found in a segment tree over remaining capacities. Sharding costs at most about one part-filled sequence each.
"""

from __future__ import annotations

import functools
import json
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.llm.common import arrow_pass
from cohortlake.llm.wordwise import encode_words
from cohortlake.sources.workspace import materialise

END_ID = 0
#: Letters beyond the Latin blocks, whose lower case or composition may differ between Unicode versions.
UNUSUAL = regex.compile("[^\\x00-\u024f\u2010-\u2027]")
#: Separators that are white space to str.split and not to the pattern.
CONTROL = regex.compile(r"[\x1c-\x1f]")


class WordEncoder:
    """Token ids of texts as little-endian 32-bit bytes, by word through caches; one per worker and tokenizer file.

    No match of the splitting pattern holds white space, so runs between white space are looked up first and cut into
    words only when new. Lower-casing Latin text in composed form is the same in Python; other text goes through the
    library's normaliser.
    """

    def __init__(self, tokenizer_path: str, max_cached: int = 700_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        with open(tokenizer_path, encoding="utf-8") as f:
            spec = json.load(f)
        added = spec["added_tokens"]
        steps = spec["pre_tokenizer"].get("pretokenizers", [])
        # splitting by a pattern and then by bytes encodes each match for itself; other designs are encoded whole
        self.by_word = (
            [s["type"] for s in steps] == ["Split", "ByteLevel"] and steps[0].get("invert") and steps[0]["behavior"] == "Removed"
            and [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
            and not steps[1]["use_regex"] and not steps[1]["add_prefix_space"] and not any(t["normalized"] for t in added)
        )
        if self.by_word:
            self.words = regex.compile(steps[0]["pattern"]["Regex"]).findall
        special = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.cache: dict[str, bytes] = {}
        self.runs: dict[str, bytes] = {}
        self.max_cached = max_cached

    def whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.by_word or (self.special and self.special.search(text)):
            return self.whole(text)
        if text.isascii() or not UNUSUAL.search(text) and unicodedata.is_normalized("NFC", text):
            text = text.lower()
        else:
            text = self.tokenizer.normalizer.normalize_str(text) if self.tokenizer.normalizer else text
        if CONTROL.search(text):
            return b"".join(map(self._word, self.words(text)))
        runs, words = self.runs, text.split()
        try:
            return b"".join(map(runs.__getitem__, words))
        except KeyError:
            self._learn(words)
            return b"".join(map(self._run, words))

    def _learn(self, words: list[str]) -> None:
        """Encodes what is new among the letter runs of one text with one call."""
        if len(self.cache) >= self.max_cached:
            self.cache.clear()
        new = {}
        for w in words:
            if w not in self.runs:
                w = w if w.isalpha() else w[:-1]
                if w.isalpha() and w not in self.cache:
                    new[w] = None
        for w, ids in zip(new, encode_words(self.tokenizer, list(new), "")):
            self.cache[w] = array("I", ids).tobytes()

    def _run(self, run: str) -> bytes:
        ids = self.runs.get(run)
        if ids is None:
            if len(self.runs) >= self.max_cached:
                self.runs.clear()
            ids = self.cache.get(run)
            if ids is None:
                stem = self.cache.get(run[:-1]) if run[-1] in ".," and run[:-1].isalpha() else None
                ids = stem + self._word(run[-1]) if stem else b"".join(map(self._word, self.words(run)))
            self.runs[run] = ids
        return ids

    def _word(self, word: str) -> bytes:
        ids = self.cache.get(word)
        if ids is None:
            if len(self.cache) >= self.max_cached:
                self.cache.clear()
            ids = self.cache[word] = self.whole(word)
        return ids


@functools.lru_cache(maxsize=4)
def encoder_of(tokenizer_path: str) -> WordEncoder:
    return WordEncoder(tokenizer_path)


class OpenSequences:
    """Open sequences by remaining capacity, in a segment tree of counts: the tightest that fits in logarithmic time."""

    def __init__(self, capacity: int):
        self.leaves = 1 << (capacity + 1).bit_length()
        self.count = [0] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _add(self, room: int, step: int) -> None:
        i = room + self.leaves
        while i:
            self.count[i] += step
            i >>= 1

    def put(self, bin_id: int, room: int) -> None:
        if room > 0:
            self.bins[room].append(bin_id)
            self._add(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """The sequence with the least room of ``need`` or more, taken out, and its room."""
        i = need + self.leaves
        if i >= 2 * self.leaves:
            return None
        if not self.count[i]:
            while i > 1 and (i & 1 or not self.count[i ^ 1]):  # up, until there is a sibling to the right with any
                i >>= 1
            if i <= 1:
                return None
            i ^= 1
            while i < self.leaves:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        room = i - self.leaves
        self._add(room, -1)
        return self.bins[room].pop(), room


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece; pieces of one length are placed in the order given."""
    order = np.argsort(-lengths, kind="stable")
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    open_, n = OpenSequences(capacity), 0
    for i in order.tolist():
        need = int(lengths[i])
        found = open_.take(need)
        if found is None:
            found, n = (n, capacity), n + 1
        sequence[i], offset[i] = found[0], capacity - found[1]
        open_.put(found[0], found[1] - need)
    return sequence, offset


def tokenized_pieces(
    docs: DataFrame, tokenizer_path: str, *, id_col: str, text_col: str, capacity: int
) -> DataFrame:
    """``id, piece, start, length, ids_crc32`` of every piece of every document."""

    def cut(batches: Iterator[dict]) -> Iterator[dict]:
        encoder, end = encoder_of(tokenizer_path), np.asarray([END_ID], dtype="<u4").tobytes()
        for b in batches:
            rows, piece, start, length, crc = [], [], [], [], []
            for r, text in enumerate(b["text"]):
                ids = encoder.encode(text.as_py()) + end
                n = len(ids) // 4
                for k, at in enumerate(range(0, n, capacity)):
                    to = min(n, at + capacity)
                    rows.append(r)
                    piece.append(k)
                    start.append(at)
                    length.append(to - at)
                    crc.append(zlib.crc32(ids[4 * at : 4 * to]))
            yield {"id": b["id"].take(pa.array(rows, pa.int64())), "piece": piece, "start": start, "length": length, "ids_crc32": crc}

    kind = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return arrow_pass(source, cut, f"id {kind}, piece int, start long, length long, ids_crc32 long")


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 2048,
    shard_pieces: int = 16_384,
) -> DataFrame:
    """Where each piece of each document goes: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    A document is its ids and the end id 0; only a longer one is cut, into pieces of ``capacity``, the last shorter.
    Pieces are spread over shards by hash, whatever their document, so a shard holds about ``shard_pieces`` at any size
    of the table. A null or empty text is the end id alone. Repeated rows and null ids are packed like any others; an
    empty table gives an empty one; other columns are ignored. Sequence numbers are shard times 2**32 plus a count.
    """
    pieces = materialise(tokenized_pieces(docs, tokenizer_path, id_col=id_col, text_col=text_col, capacity=capacity), "pieces")
    shards = max(1, -(-pieces.count() // shard_pieces))
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"

    def place(key: tuple, batch: pa.Table) -> pa.Table:
        # a fixed order first: the result does not depend on how the rows arrived
        batch = batch.sort_by([(c, "ascending") for c in ("id", "piece", "start", "ids_crc32")])
        sequence, offset = best_fit_decreasing(batch["length"].to_numpy(), capacity)
        return pa.table({
            **{c: batch[c] for c in ("id", "piece", "start", "length", "ids_crc32")},
            "sequence_id": pa.array(sequence + (key[0].as_py() << 32)), "offset": pa.array(offset),
        })

    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(shards)))
    return dealt.groupBy("shard").applyInArrow(place, schema).withColumnRenamed("id", id_col)
