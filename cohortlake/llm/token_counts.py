"""Token counts by a two-tier lookup: a broadcast table of frequent pieces, then a cache in each worker.

A byte-level tokenizer first cuts a text into pieces by a pattern and encodes each piece for itself, so a text's count
is the sum over its pieces. Frequent pieces are looked up in one compact broadcast table; the rest are encoded by the
library once per worker and remembered. Pieces are never shuffled.
"""

from __future__ import annotations

import functools
import json
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.llm.common import arrow_pass
from cohortlake.llm.wordwise import encode_words

#: The pattern that byte-level tokenizers of this family cut texts by (fixed by the vocabulary file's format).
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space other than the space and the line feed.
OTHER_SPACES = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]


def odd_space(text: str) -> bool:
    """Whether there is white space that is not one space or one line feed between two words."""
    return (
        any(c in text for c in OTHER_SPACES) or any(c in text for c in ("  ", "\n\n", " \n", "\n "))
        or text[0].isspace() or text[-1].isspace()
    )


class PieceCounter:
    """Counts tokens of texts; one per worker and tokenizer file.

    Where single spaces and line feeds are all the white space there is, no piece reaches over the start of a space or
    a line feed, so a run between two spaces, with the space before it, is a whole number of pieces: the lookup takes
    such runs first, and cuts a run into pieces only if neither tier knows it. Other texts are cut by the pattern.
    """

    def __init__(self, tokenizer_path: str, max_cached: int = 700_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        with open(tokenizer_path, encoding="utf-8") as f:
            spec = json.load(f)
        added, pre = spec["added_tokens"], spec["pre_tokenizer"]
        # other designs are encoded whole by the library: right, only slower
        self.by_piece = (
            spec["normalizer"] is None and pre["type"] == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]
            and not any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)
        )
        special = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.pieces = regex.compile(BYTE_LEVEL_PATTERN).findall
        self.max_cached = max_cached
        self.frequent: dict[str, int] = {}
        self.runs: dict[str, int] = {}
        self.cache: dict[str, int] = {}
        self.line_feed = self.encoded("\n")

    def encoded(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def use(self, frequent: dict[str, int]) -> None:
        """Takes the first tier; the worker's own finds are kept with it."""
        if frequent is not self.frequent:
            self.frequent, self.runs = frequent, dict(frequent)

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if not self.by_piece:
            return self.encoded(text)
        if self.special is None or not self.special.search(text):
            return self._plain(text)
        parts = self.special.split(text)  # a special string is one token, and pieces do not cross it
        return len(parts) - 1 + sum(self._plain(p) for p in parts if p)

    def _plain(self, text: str) -> int:
        if odd_space(text):
            return self._cut(text)
        runs = self.runs
        lines = text.split("\n")
        total = self.line_feed * (len(lines) - 1)
        words = []
        for line in lines:
            first, _, rest = line.partition(" ")
            total += self._cut(first)
            if rest:
                words += rest.split(" ")
        try:
            return total + sum(map(runs.__getitem__, words))
        except KeyError:
            self._learn(words)
            return total + sum(map(self._run, words))

    def _learn(self, words: list[str]) -> None:
        """Encodes what is new among the letter runs of one text with one call."""
        if len(self.cache) >= self.max_cached:
            self.cache.clear()
        new = {}
        for w in words:
            if w not in self.runs:
                w = w if w.isalpha() else w[:-1]
                if w.isalpha() and " " + w not in self.cache:
                    new[w] = None
        for w, ids in zip(new, encode_words(self.tokenizer, list(new), " ")):
            self.cache[" " + w] = len(ids)

    def _run(self, word: str) -> int:
        n = self.runs.get(word)
        if n is None:
            if len(self.runs) >= self.max_cached:
                self.runs.clear()
                self.runs.update(self.frequent)
            stop = word[-1] in ".," and word[:-1].isalpha()  # letters and one stop: two pieces, the stop one token
            n = self.cache.get(" " + word[:-1]) if stop else None
            n = self._cut(" " + word) if n is None else n + 1
            self.runs[word] = n
        return n

    def _cut(self, text: str) -> int:
        cache, total = self.cache, 0
        for p in self.pieces(text):
            n = cache.get(p)
            if n is None:
                if len(cache) >= self.max_cached:
                    cache.clear()
                n = cache[p] = self.encoded(p)
            total += n
        return total


@functools.lru_cache(maxsize=4)
def counter_of(tokenizer_path: str) -> PieceCounter:
    return PieceCounter(tokenizer_path)


@functools.lru_cache(maxsize=2)
def _unpack(table: bytes) -> dict[str, int]:
    pieces, lengths = zlib.decompress(table).split(b"\x00\x00", 1)
    return dict(zip(json.loads(pieces), lengths))


def frequent_pieces(docs: DataFrame, tokenizer_path: str, *, text_col: str, sample_docs: int, max_pieces: int) -> bytes:
    """The first tier, from a bounded sample: the most frequent runs between spaces and their token counts, packed.

    Only speed depends on the sample: what the table lacks, workers encode and remember. Each task returns its own ``max_pieces`` most frequent, and ``sample_docs``
    bounds how many texts there are in all.
    """

    def pieces(batches: Iterator[dict]) -> Iterator[dict]:
        counter, seen = counter_of(tokenizer_path), Counter()
        for b in batches:
            for text in b["text"].to_pylist():
                if text and counter.by_piece:
                    seen.update(text.replace("\n", " ").split(" "))
        top = seen.most_common(max_pieces)
        yield {"piece": [p for p, _ in top], "n": [n for _, n in top]}

    sample = docs.select(F.col(text_col).alias("text")).limit(sample_docs)
    found = arrow_pass(sample, pieces, "piece string, n long")
    top = found.groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(max_pieces).collect()
    counter = counter_of(tokenizer_path)
    lengths = {r["piece"]: counter.encoded(" " + r["piece"]) for r in top if r["piece"] and not any(map(str.isspace, r["piece"]))}
    lengths = {p: n for p, n in lengths.items() if n < 256 and "\x00" not in p}
    names = json.dumps(list(lengths), ensure_ascii=True).encode()
    return zlib.compress(names + b"\x00\x00" + bytes(lengths.values()))


def token_counts(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 1024,
    sample_docs: int = 2000,
    max_pieces: int = 30_000,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row, whole texts, no added tokens.

    Null and empty texts count 0 bytes and 0 tokens. Strings of special tokens inside a text count as the library has
    them by default, one token each. Rows are independent: repeated rows and null ids come back as they are; an empty
    table gives an empty one; other columns are ignored. The broadcast table holds at most ``max_pieces`` pieces.
    """
    if not counter_of(tokenizer_path).by_piece:
        table = zlib.compress(b"[]\x00\x00")
    else:
        table = frequent_pieces(docs, tokenizer_path, text_col=text_col, sample_docs=sample_docs, max_pieces=max_pieces)
    shared = docs.sparkSession.sparkContext.broadcast(table)
    source = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"),
        F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long").alias("n_bytes"),
    )

    def count(batches: Iterator[dict]) -> Iterator[dict]:
        counter = counter_of(tokenizer_path)
        counter.use(_unpack(shared.value))
        for b in batches:
            n = [counter.count(t.as_py()) for t in b["text"]]
            yield {"id": b["id"], "n_bytes": b["n_bytes"], "n_tokens": n, "over_limit": pa.array([x > limit for x in n])}

    kind = docs.schema[id_col].dataType.simpleString()
    out = arrow_pass(source, count, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean")
    return out.withColumnRenamed("id", id_col)
