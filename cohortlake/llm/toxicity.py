"""Toxicity by cumulative-link ordinal regression over sparse words.

Severity grades are ordered, and one weight per word serves all of them: the probability of a grade above k is a
logistic function of the document's score less threshold k. The output is the expected grade. A text's features are
which words and word beginnings of the model's vocabulary it has, so length alone does not count, and the vocabulary is the words that
tell the labelled sample's toxic documents from the others beyond chance.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.llm.common import arrow_pass

TOKEN = re.compile(r"\w+")


#: Lengths of the word beginnings that are features besides whole words; they stand for a word's inflections and compounds.
STEMS = (4, 5, 6, 7)


def features(text: str | None) -> set[str]:
    """A text's distinct lower-case words, their beginnings with a star, and with two where several of its words share one."""
    words = set(TOKEN.findall(text.lower())) if text else set()
    stems = Counter()
    for n in STEMS:
        stems.update([w[:n] for w in words if len(w) >= n])
    return words.union((f"{s}*" for s in stems), (f"{s}**" for s, c in stems.items() if c > 1))


@dataclass(frozen=True)
class OrdinalModel:
    """Weights per word and the ordered thresholds between grades 0, 1, ..."""

    weights: dict[str, float]
    thresholds: tuple[float, ...]

    def expected(self, words: set[str]) -> float:
        """Expected grade: the sum over thresholds of the probability of lying above."""
        score = sum(w for t, w in self.weights.items() if t in words)
        return sum(1 / (1 + math.exp(min(700.0, cut - score))) for cut in self.thresholds)


def telling_words(counts: DataFrame, n1: int, n0: int, *, max_words: int, least_share: float = 0.03, z: float = 5.0, ratio: float = 5.0) -> list[str]:
    """Words whose share among toxic documents is above that among the others, by ``z`` standard errors and ``ratio`` times.

    ``counts`` has a row ``word, a, b`` per word: in how many toxic and other documents it is. A word must be in
    ``least_share`` of the toxic documents, and three, so that a few copies of one text don't make a word telling.
    """
    p = (F.col("a") + F.col("b")) / (n1 + n0)
    score = (F.col("a") / n1 - F.col("b") / n0) / F.sqrt(p * (1 - p) * (1 / n1 + 1 / n0) + 1e-12)
    enough = (F.col("a") >= max(3, least_share * n1)) & (F.col("a") / n1 >= ratio * F.col("b") / n0)
    found = counts.where(enough).withColumn("z", score).where(F.col("z") >= z)
    return [r["word"] for r in found.orderBy(F.desc("z"), "word").limit(max_words).collect()]


def grades_of(docs: Sequence[set[str]], toxic: np.ndarray, words: Sequence[str], cuts: Sequence[int]) -> np.ndarray:
    """Grade 0 for clean documents; a toxic one's grade rises with how many of the telling words it has."""
    telling = set(words)
    n = np.asarray([len(d & telling) for d in docs])
    return np.where(toxic, 1 + sum((n >= c).astype(int) for c in cuts), 0)


def fit_ordinal(x: np.ndarray, grade: np.ndarray, n_grades: int, *, penalty: float = 1e-3, steps: int = 400, rate: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of greatest penalised likelihood, by Adam; thresholds keep their order by construction."""
    n, d = x.shape
    w, raw = np.zeros(d), np.concatenate([[1.0], np.zeros(n_grades - 2)])  # first threshold, logs of the gaps
    m, v = np.zeros(d + len(raw)), np.zeros(d + len(raw))
    for t in range(1, steps + 1):
        gaps = np.exp(raw[1:])
        cuts = np.concatenate([[raw[0]], raw[0] + np.cumsum(gaps)])
        s = x @ w
        above = 1 / (1 + np.exp(-np.clip(s[:, None] - cuts, -500, 500)))
        edge = np.column_stack([np.ones(n), above, np.zeros(n)])
        slope = np.column_stack([np.zeros(n), above * (1 - above), np.zeros(n)])
        i = np.arange(n)
        p = np.maximum(edge[i, grade] - edge[i, grade + 1], 1e-12)
        upper, lower = slope[i, grade] / p, slope[i, grade + 1] / p  # derivatives of log p with respect to s at each edge
        g_w = -(x.T @ (upper - lower)) / n + penalty * w
        g_cut = np.zeros(len(cuts) + 2)
        np.add.at(g_cut, grade, upper)
        np.add.at(g_cut, grade + 1, -lower)
        g_cut = g_cut[1:-1] / n
        g_raw = np.concatenate([[g_cut.sum()], [g_cut[k + 1 :].sum() * gaps[k] for k in range(len(gaps))]])
        g = np.concatenate([g_w, g_raw])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, raw = w - step[:d], raw - step[d:]
    return w, np.concatenate([[raw[0]], raw[0] + np.cumsum(np.exp(raw[1:]))])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_rows_per_label: int = 3000,
    max_words: int = 200,
    cuts: Sequence[int] = (3, 6),
) -> OrdinalModel:
    """Fits on a bounded sample: at most ``max_rows_per_label`` labelled documents of each label, in order of a hash of the id.

    Only counts of telling words, and which of them a sampled document has, reach the driver. Without documents of both labels the model finds nothing.
    """
    known = labels.select(F.col(id_col).alias("lid"), (F.col(label_col) > 0).alias("toxic")).where("lid IS NOT NULL AND toxic IS NOT NULL")
    picked = None
    for flag in (True, False):
        part = known.where(F.col("toxic") == flag).orderBy(F.xxhash64("lid"), "lid").limit(max_rows_per_label)
        picked = part if picked is None else picked.unionByName(part)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(picked, F.col("id") == F.col("lid"))

    def count(batches: Iterator[dict]) -> Iterator[dict]:
        seen = {True: Counter(), False: Counter()}
        for b in batches:
            for t, toxic in zip(b["text"], b["toxic"].to_pylist()):
                seen[toxic].update(features(t.as_py()))
        words = list({**seen[True], **seen[False]})
        yield {"word": words, "a": [seen[True][w] for w in words], "b": [seen[False][w] for w in words]}

    sampled = source.select("id", "toxic", "text")
    n = {r["toxic"]: r["count"] for r in sampled.groupBy("toxic").count().collect()}
    chosen: list[str] = []
    if n.get(True) and n.get(False):
        counts = arrow_pass(sampled, count, "word string, a long, b long").groupBy("word").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
        chosen = telling_words(counts, n[True], n[False], max_words=max_words)
    if not chosen:
        return OrdinalModel({}, tuple(10.0 + k for k in range(len(cuts) + 1)))
    wanted = frozenset(chosen)

    def words(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            yield {"id": b["id"].cast("int64"), "toxic": b["toxic"], "words": [sorted(features(t.as_py()) & wanted) for t in b["text"]]}

    rows = arrow_pass(sampled, words, "id long, toxic boolean, words array<string>").collect()
    rows.sort(key=lambda r: (r["id"], r["words"]))
    sets, toxic = [set(r["words"]) for r in rows], np.asarray([r["toxic"] for r in rows], bool)
    grade = grades_of(sets, toxic, chosen, cuts)
    x = np.asarray([[w in s for w in chosen] for s in sets], float)
    weights, thresholds = fit_ordinal(x, grade, len(cuts) + 2)
    return OrdinalModel(dict(zip(chosen, weights.tolist())), tuple(thresholds.tolist()))


def severity(docs: DataFrame, model: OrdinalModel, *, text_col: str = "text") -> DataFrame:
    """Every input row with ``severity`` (expected grade, double) added.

    Null and empty texts have no words and so the severity of a text without any telling word. Rows are judged one by one: repeated
    rows get the same answer; an empty table gives an empty one; other columns pass through, one called ``severity`` is replaced.
    """
    own = [c for c in docs.columns if c != "severity"]
    renamed = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(own)])
    text, shared = f"c{own.index(text_col)}", docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[dict]) -> Iterator[dict]:
        m = shared.value
        for b in batches:
            yield {**b, "severity": [m.expected(features(t.as_py())) for t in b[text]]}

    ddl = ", ".join([*[f"{f.name} {f.dataType.simpleString()}" for f in renamed.schema], "severity double"])
    return arrow_pass(renamed, score, ddl).toDF(*own, "severity")


def judge(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every input row with ``severity`` and ``rejected``: an expected grade of ``threshold`` or more."""
    scored = severity(docs, fit(docs, labels, id_col=id_col, text_col=text_col), text_col=text_col)
    return scored.withColumn("rejected", F.col("severity") >= threshold)
