"""What each of several filters removes, in every order of applying them.

A row fails a set of filters, its mask. How many rows of a part have each mask is all that any order of the filters needs:
a step removes the rows whose mask holds its filter and none of an earlier one. So texts are read for flags, masks are
counted once, and the orders are arithmetic on at most 32 counts a part.

Whether a text repeats an earlier one needs other rows. A counting Bloom prepass clears the texts that are surely alone:
cells of two hashes are counted, as partial sums that merge by cell, and a text with a cell of its own is unique. Only the
others' texts are shuffled, for the exact smallest id of every text; equal rows are combined before the shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import permutations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlake.llm.common import WORD_PATTERN, arrow_pass
from cohortlake.sources.workspace import materialise

FILTERS = "ABCDE"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MARKS = "[#$%&*|]"
REPEAT = FILTERS.index("E")

#: Cells of the sketch for each text, and the most cells it has: one bit each is broadcast, 64 MB at most. A corpus of more
#: than a sixteenth as many texts is cleared less well and shuffles more texts; its results are the same.
CELLS_A_TEXT = 16
MOST_CELLS = 1 << 29
#: Bits of one row of the packed sketch.
BUCKET = 32768


def text_flags(text: Column) -> Column:
    """The mask of filters A to D: fewer than 200 words, under half of them distinct, over 3 % capitals, a mark."""
    words = F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0))

    def mask(w: Column) -> Column:
        n = F.size(w)
        capitals = F.length(text) - F.length(F.translate(text, UPPER, ""))
        fails = [n < 200, 100 * F.size(F.array_distinct(w)) < 50 * n, 100 * capitals > 3 * F.length(text), text.rlike(MARKS)]
        return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))

    return F.element_at(F.transform(F.array(words), mask), 1)


def narrow_rows(docs: DataFrame, *, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """``id, part, mask, h1, h2``: what the audit needs of every row, without its text."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
        text_flags(text).alias("mask"),
        *_keys(text),
    )


def _keys(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit("second"), text).alias("h2")]


# -- the sketch ------------------------------------------------------------------------------------


def repeated_cells(rows: DataFrame, cells: int) -> bytes:
    """One bit per cell that more than one row fell into, packed; ``cells / 8`` bytes.

    The counters are partial sums of each task, merged by cell; a hot text adds one row a task. Only the packed bits of
    cells counted twice or more reach the driver, a bounded number.
    """
    cell = F.explode(F.array(*[F.pmod(h, F.lit(cells)) for h in ("h1", "h2")])).alias("cell")
    twice = rows.select(cell).groupBy("cell").count().where("count > 1")
    packed = twice.groupBy(F.expr("bitmap_bucket_number(cell + 1)").alias("bucket")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(cell + 1))").alias("bits"))
    bits = np.zeros(cells // 8 + BUCKET // 8, np.uint8)
    for r in packed.toLocalIterator():
        at = (r["bucket"] - 1) * (BUCKET // 8)  # bucket 1 starts at number 1, cell 0
        part = np.frombuffer(bytes(r["bits"]), np.uint8)
        bits[at : at + len(part)] |= part
    return bits.tobytes()


def possible_repeats(docs: DataFrame, bits: bytes, cells: int, *, id_col: str, text_col: str) -> DataFrame:
    """``id, text, h1, h2`` of the rows that the sketch does not clear."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("text"), *_keys(text))
    shared = rows.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        sketch = np.frombuffer(shared.value, np.uint8)
        for b in batches:
            keep = np.ones(len(b["id"]), bool)
            for h in ("h1", "h2"):
                cell = b[h].to_numpy(zero_copy_only=False) % cells
                keep &= (sketch[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1
            found = np.flatnonzero(keep)
            if len(found):
                yield {c: b[c].take(found) for c in ("id", "text", "h1", "h2")}

    return arrow_pass(rows, run, "id long, text string, h1 long, h2 long")


# -- exact repeats ---------------------------------------------------------------------------------


def first_ids(docs: DataFrame, rows: DataFrame, *, id_col: str, text_col: str, cells: int | None = None) -> tuple[DataFrame, DataFrame]:
    """For every text of several rows its smallest id: by its two hashes, and by the text itself where texts share both.

    ``h1, h2, least, n`` and ``text, h1, h2, least``; the second is empty but for colliding hashes.
    """
    if cells is None:
        cells = min(MOST_CELLS, max(BUCKET, 1 << math.ceil(math.log2(max(CELLS_A_TEXT * rows.count(), 1)))))
    suspects = possible_repeats(docs, repeated_cells(rows, cells), cells, id_col=id_col, text_col=text_col)
    exact = materialise(suspects.groupBy("text", "h1", "h2").agg(F.min("id").alias("least"), F.count("*").alias("n")), "texts")
    keyed = exact.groupBy("h1", "h2").agg(F.count("*").alias("texts"), F.min("least").alias("least"), F.sum("n").alias("n"))
    clash = keyed.where("texts > 1").select("h1", "h2")
    return keyed.where("texts = 1 AND n > 1").drop("texts"), exact.join(clash, ["h1", "h2"], "left_semi").where("n > 1").drop("n")


def repeat_rows(docs: DataFrame, rows: DataFrame, *, id_col: str, text_col: str, part_col: str, hot_rows: int = 10_000, cells: int | None = None) -> DataFrame:
    """``id, part, mask`` of the rows whose text an earlier row has, once for each such row.

    A text of more than ``hot_rows`` rows, and than a thousandth of all, is hot; there are fewer than a thousand of these,
    and they are broadcast. The others join on their hashes.
    """
    keyed, clashing = first_ids(docs, rows, id_col=id_col, text_col=text_col, cells=cells)
    keyed = materialise(keyed, "first-ids")
    hot_rows = max(hot_rows, rows.count() // 1000)
    keys = ["h1", "h2"]
    hot = keyed.where(F.col("n") > hot_rows).select(*keys, F.col("least").alias("hot_least"))
    cold = keyed.where(F.col("n") <= hot_rows).select(*keys, "least")
    told = rows.join(F.broadcast(hot), keys, "left")
    of_hot = told.where("hot_least IS NOT NULL AND id > hot_least").select("id", "part", "mask")
    of_cold = told.where("hot_least IS NULL").join(cold, keys).where("id > least").select("id", "part", "mask")
    found = of_hot.unionByName(of_cold)
    clashing = materialise(clashing, "clashing")
    if clashing.limit(1).count():
        with_text = docs.select(
            F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
            F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"), text_flags(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("mask"),
        )
        found = found.unionByName(with_text.join(clashing.select("text", "least"), "text").where("id > least").select("id", "part", "mask"))
    return found


# -- counts and orders -----------------------------------------------------------------------------


def mask_counts(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", cells: int | None = None) -> DataFrame:
    """``part, mask, n, good, toxic``: rows of each mask of failed filters, and those labelled good or toxic.

    All are sums: every row counts under its mask of A to D, and a repeat moves from there to the mask with E.
    """
    rows = materialise(narrow_rows(docs, id_col=id_col, text_col=text_col, part_col=part_col), "flags")
    again = materialise(
        repeat_rows(docs, rows, id_col=id_col, text_col=text_col, part_col=part_col, cells=cells).groupBy("id", "part", "mask").agg(F.count("*").alias("n")), "repeats"
    )
    bit = 1 << REPEAT
    moved = again.select("id", "part", F.explode(F.array(
        F.struct(F.col("mask"), (-F.col("n")).alias("n")), F.struct((F.col("mask") + bit).alias("mask"), F.col("n").alias("n")))).alias("m"))
    every = rows.groupBy("id", "part", "mask").agg(F.count("*").alias("n")).unionByName(moved.select("id", "part", "m.mask", "m.n"))
    marked = (
        labels.where("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)")
        .groupBy(F.col("doc_id").cast("long").alias("id"))
        .agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    )
    of_marked = every.join(marked, "id").groupBy("part", "mask").agg(F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))
    of_all = every.groupBy("part", "mask").agg(F.sum("n").alias("n"))
    both = of_all.select("part", "mask", "n", F.lit(0).cast("long").alias("good"), F.lit(0).cast("long").alias("toxic")).unionByName(
        of_marked.select("part", "mask", F.lit(0).cast("long").alias("n"), "good", "toxic"))
    return both.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def every_order(counts: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from counts by mask."""
    counts = counts.select("part", F.col("mask").cast("int").alias("mask"), "n", "good", "toxic")
    steps = []
    for order in permutations(range(len(FILTERS))):
        name = "".join(FILTERS[f] for f in order)
        steps += [(name, k + 1, sum(1 << f for f in order[:k]), 1 << f) for k, f in enumerate(order)]
    literal = F.array(*[F.struct(F.lit(o).alias("o"), F.lit(s).alias("s"), F.lit(b).alias("b"), F.lit(f).alias("f")) for o, s, b, f in steps])
    at = counts.select("*", F.explode(literal).alias("x")).select("*", "x.*")
    m, before, own = F.col("mask"), F.col("b"), F.col("f")
    fails, gone = m.bitwiseAND(own) != 0, m.bitwiseAND(before) != 0
    orders = math.factorial(len(FILTERS))

    def total(where: Column, what: str = "n") -> Column:
        return F.sum(F.when(where, F.col(what)).otherwise(0)).cast("long")

    won = F.sum(F.when(fails, F.col("n") * F.lit(orders) / F.bit_count(m)).otherwise(0)).cast("long")
    return at.groupBy("part", F.col("o").alias("filter_order"), F.col("s").alias("step")).agg(
        total(~fails & ~gone).alias("kept"), total(fails & ~gone).alias("removed"), total(fails & gone).alias("redundant"),
        total(m == own).alias("unique_fails"), total(fails & ~gone, "good").alias("good_lost"), total(fails & ~gone, "toxic").alias("toxic_lost"),
        won.alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", cells: int | None = None) -> DataFrame:
    """One row per part, order of the five filters and step, with what the step's filter does there.

    Parts are the values of ``part_col``, null as the empty string. A row fails E if a row of smaller id has the same text,
    null texts being empty ones; rows with null ids neither repeat nor are repeated, and rows of one id and text do not
    repeat each other. Labels of one id are united: good or toxic if any of them says so; labels without a document, or
    with a null id, count nowhere. An empty table has no parts and gives no rows. Very long texts are read whole. Columns
    beyond those named are not read, whatever their names.
    """
    return every_order(mask_counts(docs, labels, id_col=id_col, text_col=text_col, part_col=part_col, cells=cells))
