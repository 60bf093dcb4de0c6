"""URL verdicts: longest-match rules first, then naive Bayes over host words and path tokens.

Hosts are names run together, so each part of a host is split into words by unigram Viterbi: the split of highest
probability under word counts of the pages themselves. A multinomial naive Bayes model over all tokens scores the
words. It is trained on all pages, those on hosts with a word from a short blocked list being its positive examples, so
that words which keep such company count against a host too. A host has such a word where separators bound it, or where the
split finds it under the pages' own counts; listed words get no counts of their own, so that ``downloads`` is not cut for ``ads``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlake.llm.common import arrow_pass
from cohortlake.sources.workspace import materialise

#: Verdict, host and path; a rule holds for the host and its subdomains and for paths that start with the path.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
BLOCKED_WORDS = ("adult", "ads", "bets", "casino", "escort", "pills", "poker", "porn", "spam", "viagra", "xxx")
#: Lower case of A to Z only; other letters stay as they are.
#: Letters of the longest word of the splitter: no name between two dots of a host is longer.
LONGEST_WORD = 63
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):  # the longest is asked first
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def word_counts(texts: DataFrame, text_col: str) -> DataFrame:
    """``word, n``: all words of two to ``LONGEST_WORD`` Latin letters over all texts, the vocabulary of the splitter."""
    word = F.explode(F.split(F.translate(F.col(text_col), UPPER, LOWER), "[^a-z]+"))
    return texts.select(word.alias("word")).where(F.length("word").between(2, LONGEST_WORD)).groupBy("word").agg(F.count("*").alias("n"))


def splitter(counts: dict[str, int], total: int) -> Callable[[str], tuple[str, ...]]:
    """Splits a name into words of highest joint unigram probability; ties go to the longer last word.

    ``counts`` has the vocabulary's words inside the names to be split, ``total`` is the sum of all its counts. A word outside the vocabulary costs ten times more for every letter, single letters included.
    """
    total = math.log(total + 1)
    letter = math.log(10)
    cost = {w: total - math.log(n) for w, n in counts.items()}
    longest = max(map(len, cost), default=0)

    def split(name: str) -> tuple[str, ...]:
        best, back = [0.0], [0]
        open_cost, open_at = math.inf, 0  # where an unknown word best starts; it costs the same for every letter
        for end in range(1, len(name) + 1):
            if best[end - 1] - letter * (end - 1) < open_cost:
                open_cost, open_at = best[end - 1] - letter * (end - 1), end - 1
            found = (open_cost + total + letter * end, open_at)
            for start in range(max(0, end - longest), end):
                known = cost.get(name[start:end])
                if known is not None:
                    found = min(found, (best[start] + known, start))
            best.append(found[0])
            back.append(found[1])
        words, end = [], len(name)
        while end:
            words.append(name[back[end] : end])
            end = back[end]
        return tuple(reversed(words))

    return split


def path_tokens(path: str) -> list[str]:
    """Tokens of the path; numbers are all one token."""
    return [f"/{'#' if p.isdigit() else p}" for p in re.split(r"[\W_]+", path.translate(str.maketrans(UPPER, LOWER))) if p]


def host_words(hosts: DataFrame, counts: DataFrame, blocked: Sequence[str]) -> DataFrame:
    """``host, token, marked``: the words of each host of a table of distinct ones, as often as they are in it.

    ``marked`` tells that the token's part of the name has a blocked word, bounded by separators or split off as a word that the
    counts have; what is left over beside another word, as in ``alpha+bets``, is no word.

    Each distinct part of a name meets the counts of its substrings of up to ``LONGEST_WORD`` letters, and is split with these
    alone; a part that is a blocked word is left whole. Substrings are rows and carry the part's number, so a part of any length
    is never copied for each of them.
    """
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    whole = frozenset(blocked)
    named = hosts.select("host", F.explode(F.split("host", "[^a-z]+")).alias("part")).where("part != ''")
    parts = materialise(named.select("part").distinct().withColumn("number", F.monotonically_increasing_id()), "parts")
    step = 1024
    pieces = f"transform(sequence(0, (length(part) - 1) div {step}), j -> substr(part, int(j * {step} + 1), {step + LONGEST_WORD - 1}))"
    tails = parts.select("number", F.explode(F.expr(pieces)).alias("piece"))
    tails = tails.select("number", F.explode(F.expr(f"transform(sequence(1, least(length(piece), {step})), i -> substr(piece, i, {LONGEST_WORD}))")).alias("tail"))
    inside = F.expr("transform(sequence(2, length(tail)), k -> substr(tail, 1, k))")
    known = tails.where(F.length("tail") >= 2).select("number", F.explode(inside).alias("word")).join(counts, "word")
    known = known.groupBy("number").agg(F.collect_set(F.struct("word", "n")).alias("known"))
    known = known.select("number", F.col("known.word").alias("words"), F.col("known.n").alias("ns"))

    def split(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            found, marked = [], []
            for part, words, ns in zip(b["part"].to_pylist(), b["words"].to_pylist(), b["ns"].to_pylist()):
                own = dict(zip(words or (), ns or ()))
                found.append([part] if part in whole else splitter(own, total)(part))
                marked.append(part in whole or any(t in whole and t in own for t in found[-1]))
            yield {"part": b["part"], "tokens": found, "marked": marked}

    done = materialise(arrow_pass(parts.join(known, "number", "left").select("part", "words", "ns"), split, "part string, tokens array<string>, marked boolean"), "splits")
    return named.join(done, "part").select("host", F.explode("tokens").alias("token"), "marked")


def scores(parts: DataFrame, counts: DataFrame, *, blocked: Sequence[str], smoothing: float = 0.1) -> DataFrame:
    """``host, path, score``: log odds of block per distinct host and path, from the counts of all tokens of all pages."""
    keys = materialise(parts.groupBy("host", "path").agg(F.count("*").alias("n")).withColumn("key", F.monotonically_increasing_id()), "urls")
    hosts = keys.groupBy("host").agg(F.sum("n").alias("n"))
    words = materialise(host_words(hosts.select("host"), counts, blocked), "host-words")
    marked = words.groupBy("host").agg(F.max("marked").alias("label"))
    labels = materialise(hosts.join(marked, "host", "left").select("host", "n", F.coalesce("label", F.lit(False)).alias("label")), "labels")

    def cut(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            yield {"key": b["key"], "n": b["n"], "label": b["label"], "tokens": [path_tokens(x) for x in b["path"].to_pylist()]}

    cuts = arrow_pass(keys.join(labels.select("host", "label"), "host").select("key", "n", "label", "path"), cut, "key long, n long, label boolean, tokens array<string>")
    paths = materialise(cuts.select("key", "n", "label", F.explode("tokens").alias("token")), "path-tokens")
    every = words.join(labels, "host").select("token", "n", "label").unionByName(paths.select("token", "n", "label"))

    def of(flag: bool):
        return F.coalesce(F.sum(F.when(F.col("label") == flag, F.col("n"))), F.lit(0))

    seen = materialise(every.groupBy("token").agg(of(True).alias("a"), of(False).alias("b")), "token-counts")
    rows = labels.agg(of(True), of(False)).first()
    n, a, b = seen.agg(F.count("*"), F.coalesce(F.sum("a"), F.lit(0)), F.coalesce(F.sum("b"), F.lit(0))).first()
    prior = math.log((rows[0] + 1) / (rows[1] + 1))
    spare = smoothing * max(1, n)
    odds = F.log((F.col("a") + smoothing) / (a + spare)) - F.log((F.col("b") + smoothing) / (b + spare))
    # decimals, so that sums don't depend on their order
    weights = seen.select("token", odds.cast("decimal(20,12)").alias("odds"), ((F.col("a") + F.col("b")) * 1000 >= a + b).alias("hot"))

    def summed(rows: DataFrame, key: str) -> DataFrame:
        """At most a thousand tokens are a thousandth of all or more; they are broadcast, so no task gets all rows of one."""
        hot = F.broadcast(weights.where("hot").select("token", F.col("odds").alias("hot_odds")))
        some = rows.join(hot, "token", "left")
        rest = some.where("hot_odds IS NULL").join(weights.where("NOT hot"), "token").select(key, "odds")
        return some.where("hot_odds IS NOT NULL").select(key, F.col("hot_odds").alias("odds")).unionByName(rest).groupBy(key).agg(F.sum("odds").alias(f"{key}_odds"))

    out = keys.join(summed(words, "host"), "host", "left").join(summed(paths.select("key", "token"), "key"), "key", "left")
    score = F.lit(prior) + F.coalesce(F.col("host_odds").cast("double"), F.lit(0.0)) + F.coalesce(F.col("key_odds").cast("double"), F.lit(0.0))
    return out.select("host", "path", score.alias("score"))


def judge(
    pages: DataFrame,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    text_col: str = "html",
    rules: Sequence[tuple[str, str, str]] = RULES,
    blocked: Sequence[str] = BLOCKED_WORDS,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` per row; ``score`` is the model's log odds that the page be blocked.

    The host runs from the first ``://`` to ``/``, ``?``, ``#`` or the end; the path from there to ``?``, ``#`` or the end.
    The longest rule that fits decides; else a score above 0 blocks. All words and tokens count, in Spark tables; what is
    broadcast is at most a thousand weights of the most frequent tokens.

    A null url, or one without ``://``, has an empty host and path and no tokens: the model allows it unless most pages
    are blocked. Repeated rows and null ids come back as they are; an empty table gives an empty one; other columns are ignored.
    """
    counts = materialise(word_counts(pages, text_col), "words")
    url = F.col(url_col)
    parts = pages.select(F.col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    scored = parts.join(scores(parts.select("host", "path"), counts, blocked=blocked), ["host", "path"])
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    by_model = F.when(F.col("score") > 0, "block").otherwise("allow")
    return scored.select(F.col("id").alias(id_col), "host", "path", rule.alias("rule"), F.coalesce(verdict, by_model).alias("verdict"), "score")
