"""Conversations brought to a legal order of turns, at the least cost of edits.

Legal orders of role initials are nothing, or an optional system turn and alternating pairs of user and assistant. Turns
are aligned to every feasible length of that string by Wagner-Fischer: since the alternating string of each length is the
end of the next, one table over (turns left, characters left) serves all lengths, and one more step serves those that begin
with a system turn. Ukkonen's band keeps the cells that an incumbent repair's cost allows. Among the cheapest alignments of
all lengths the backtraced audit that sorts first wins.

Conversations pass through tasks as sorted streams: first without their texts, for the audit, then with them, for the
repaired turns. A task holds two bytes a turn of the conversation it is in, and the text of one turn. Conversations of more
than ``LONG`` turns are aligned by the same costs over the position in the pattern instead of the length, in linear time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlake.llm.common import arrow_pass
from cohortlake.sources.workspace import materialise

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
NONE, BLANK, DUPLICATE, CUT = range(4)
#: Turns above which an alignment table (turns x characters) gives way to pattern positions.
LONG = 2048
SPACE = " \t\n\x0b\x0c\r"
ROLE = {"u": "user", "a": "assistant"}
AFTER = {"s": "u", "u": "a", "a": "u"}
LEGAL = {"su", "ua", "au"}
_FAR = 1 << 40


def _costs(initials: Sequence[str], faults: Sequence[int]) -> tuple[list[int], list[int], list[int]]:
    """What it costs to leave each turn as a user's, an assistant's and a system's; blank and repeated turns cannot stay."""
    stay = [_FAR if f in (BLANK, DUPLICATE) else TRUNCATED if f == CUT else 0 for f in faults]
    user = [c if i == "u" else c + REROLE for i, c in zip(initials, stay)]
    assistant = [c if i == "a" else c + REROLE for i, c in zip(initials, stay)]
    system = [c if i == "s" else _FAR for i, c in zip(initials, stay)]
    return user, assistant, system


def incumbent(initials: Sequence[str], faults: Sequence[int]) -> int:
    """The cost of one repair: every turn that may stay takes the next role of the pattern, or all are deleted."""
    user, assistant, _ = _costs(initials, faults)
    cost, turns = 0, 0
    for u, a in zip(user, assistant):
        c = a if turns % 2 else u
        cost += min(c, DELETE)
        turns += c <= DELETE
    return min(cost + INSERT * (turns % 2), DELETE * len(user))


def align(initials: Sequence[str], faults: Sequence[int]) -> tuple[int, str]:
    """Least cost and first-sorting audit, by banded tables over every feasible length."""
    n = len(initials)
    if n > LONG:
        return align_by_pattern(initials, faults)
    if not n:
        return 0, ""
    user, assistant, system = _costs(initials, faults)
    bound = incumbent(initials, faults)
    width = n + bound // INSERT + 1
    k = np.arange(width + 1)
    even = k % 2 == 0
    table = np.full((n + 1, width + 1), _FAR, np.int64)
    table[n, : bound // INSERT + 1] = INSERT * k[: bound // INSERT + 1]
    for i in range(n - 1, -1, -1):
        left = n - i
        lo, hi = max(0, left - bound // DELETE), min(width, left + bound // INSERT)
        row = table[i + 1] + DELETE
        row[1:] = np.minimum(row[1:], table[i + 1, :-1] + np.where(even[1:], user[i], assistant[i]))
        row = row[lo : hi + 1] - INSERT * k[lo : hi + 1]
        table[i, lo : hi + 1] = np.minimum.accumulate(row) + INSERT * k[lo : hi + 1]
    whole = [(int(table[0, j]), 0, -1, j) for j in range(0, width + 1, 2)]
    for i in range(n):
        if system[i] < _FAR:
            whole += [(DELETE * i + system[i] + int(table[i + 1, j]), i + 1, i, j) for j in range(2, width + 1, 2)]
    cost = min(w[0] for w in whole)
    cells = table.tolist()
    audits = [("D" * at + "K" if at >= 0 else "") + _trace(cells, initials, i, j) for c, i, at, j in whole if c == cost]
    return cost, min(audits)


def _trace(cells: list[list[int]], initials: Sequence[str], i: int, k: int) -> str:
    """The first-sorting path of least cost from a cell: D before I before K and R."""
    n, out = len(initials), []
    while i < n or k:
        here = cells[i][k]
        if i < n and cells[i + 1][k] + DELETE == here:
            out.append("D")
            i += 1
        elif k and cells[i][k - 1] + INSERT == here:
            out.append("I")
            k -= 1
        else:
            out.append("K" if initials[i] == ("a" if k % 2 else "u") else "R")
            i += 1
            k -= 1
    return "".join(out)


def align_by_pattern(initials: Sequence[str], faults: Sequence[int]) -> tuple[int, str]:
    """The same in linear time, over what may come next.

    Places: 0 a user's turn or the end, 1 an assistant's, 2 a user's (after a system turn), 3 the start. Backwards, each
    turn and place gets its least cost and its first-sorting edit of that cost; forwards, the edits are followed.
    """
    n = len(initials)
    edits = np.zeros((n + 1, 4), np.uint8)
    edits[n] = [0, ord("I"), ord("I"), 0]
    stay = {"s": 2, "u": 1, "a": 0}
    h = [0, INSERT, 2 * INSERT, 0]
    for i in range(n - 1, -1, -1):
        initial = initials[i]
        bad = faults[i] in (BLANK, DUPLICATE)
        rest = TRUNCATED if faults[i] == CUT else 0
        to_user = _FAR if bad else rest + (0 if initial == "u" else REROLE) + h[1]
        to_assistant = _FAR if bad else rest + (0 if initial == "a" else REROLE) + h[0]
        to_system = _FAR if bad or initial != "s" else rest + h[stay["s"]]
        take = [to_user, to_assistant, to_user, min(to_user, to_system)]
        base = [min(h[q] + DELETE, take[q]) for q in range(4)]
        new = [min(base[0], base[1] + INSERT), min(base[1], base[0] + INSERT), 0, 0]
        new[2], new[3] = min(base[2], new[1] + INSERT), min(base[3], new[1] + INSERT)
        for q in range(4):
            if h[q] + DELETE == new[q]:
                e = "D"
            elif new[0 if q == 1 else 1] + INSERT == new[q]:
                e = "I"
            else:
                system = q == 3 and to_system == new[q]
                e = "K" if system or initial == ("a" if q == 1 else "u") else "R"
            edits[i, q] = ord(e)
        h = new
    out, i, q = bytearray(), 0, 3
    while i < n or q in (1, 2):
        e = int(edits[i, q])
        out.append(e)
        if e != ord("D"):
            q = 2 if e == ord("K") and q == 3 and initials[i] == "s" else 0 if q == 1 else 1
        i += e != ord("I")
    return h[3], out.decode()


# -- on tables -------------------------------------------------------------------------------------


def damage(conversations: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, turn, role, text, copy, dropped`` with a fault in a quarter of the turns, dealt by their key's checksum.

    Of twenty parts, one each: dropped (kept as a row without role and text), emptied, without ``.!?``, told twice, given
    to the user. Null keys, roles and texts are one space.
    """
    space = F.lit(" ")
    conv, turn = F.col(f"`{conv_col}`"), F.col(f"`{turn_col}`")
    key = F.concat(F.coalesce(conv.cast("string"), space), F.lit(":"), F.coalesce(turn.cast("string"), space))
    fault = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce(F.col(f"`{role_col}`"), space), F.coalesce(F.col(f"`{text_col}`"), space)
    rows = conversations.select(conv.alias("conv_id"), turn.cast("long").alias("turn"), role.alias("role"), text.alias("text"), fault.alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    dropped = F.col("fault") == 0
    return rows.select(
        "conv_id", "turn",
        F.when(~dropped, F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))).alias("role"),
        F.when(~dropped, text).alias("text"),
        F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        dropped.alias("dropped"),
    )


def turns(conversations: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Undamaged turns in the same columns: null roles and texts are one space."""
    space = F.lit(" ")
    return conversations.select(
        F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`"), space).alias("role"), F.coalesce(F.col(f"`{text_col}`"), space).alias("text"),
        F.lit(0).alias("copy"), F.lit(False).alias("dropped"),
    )


#: Ascending, nulls first.
_ORDER = ("turn", "role", "digest", "copy")


def _faults(rows: DataFrame) -> DataFrame:
    """The rows without texts, sorted by conversation and turn, each with its first fault."""
    end = F.rtrim("text", F.lit(SPACE))
    narrow = rows.select(
        "conv_id", "turn", "role", "copy", "dropped", F.sha2("text", 256).alias("digest"),
        (F.length(end) == 0).alias("blank"), (~F.substring(end, -1, 1).isin(".", "!", "?")).alias("cut"),
    ).repartition("conv_id")
    told = F.row_number().over(Window.partitionBy("conv_id", "role", "digest").orderBy("turn", "copy")) > 1
    fault = F.when(F.col("blank"), BLANK).when(F.col("told"), DUPLICATE).when(F.col("cut"), CUT).otherwise(NONE)
    found = narrow.withColumn("told", told).withColumn("fault", fault)
    return found.sortWithinPartitions("conv_id", *_ORDER).select(
        "conv_id", "turn", "dropped", F.substring("role", 1, 1).alias("initial"), F.col("fault").cast("int").alias("fault")
    )


def _runs(batches: Iterator[dict], columns: Sequence[str]) -> Iterator[tuple[object, bool, list[list]]]:
    """Stretches of one conversation in a sorted stream: its id, whether it is new, and the columns' values."""
    before: object = batches  # no id
    for b in batches:
        ids = b["conv_id"].to_pylist()
        values = [b[c].to_pylist() for c in columns]
        at = 0
        while at < len(ids):
            to = at + 1
            while to < len(ids) and ids[to] == ids[at]:
                to += 1
            yield ids[at], ids[at] != before, [v[at:to] for v in values]
            before, at = ids[at], to


_MEASURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def audits(rows: DataFrame) -> DataFrame:
    """One row per conversation: its gaps, faults, illegal neighbours, least cost and audit."""
    faults = _faults(rows)

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        def judged(conv, seen: list[str], fault: bytearray, span: list) -> dict:
            initials = "".join(seen) if all(len(s) == 1 for s in seen) else seen
            cost, audit = align(initials, fault)
            first, last, distinct = span
            illegal = sum(1 for a, b in zip(seen, seen[1:]) if a + b not in LEGAL)
            counts = [fault.count(f) for f in (BLANK, DUPLICATE, CUT)]
            gaps = last - first + 1 - distinct if distinct else 0
            return dict(zip(("conv_id", *_MEASURES, "audit"), (conv, gaps, *counts, illegal, cost, audit)))

        def packed(out: list[dict]) -> dict:
            return {c: [r[c] for r in out] for c in out[0]}

        out: list[dict] = []
        state = None
        for conv, new, (turn, dropped, initial, fault) in _runs(batches, ("turn", "dropped", "initial", "fault")):
            if new:
                if state:
                    out.append(judged(*state))
                    if len(out) >= 2000:
                        yield packed(out)
                        out = []
                state = (conv, [], bytearray(), [None, None, 0])
            _, seen, faults_, span = state
            for t, d, i, f in zip(turn, dropped, initial, fault):
                if d:
                    continue
                seen.append(i)
                faults_.append(f)
                if t is not None and t != span[1]:
                    span[0] = t if span[0] is None else span[0]
                    span[1] = t
                    span[2] += 1
        if state:
            out.append(judged(*state))
        if out:
            yield packed(out)

    kind = rows.schema["conv_id"].dataType.simpleString()
    return arrow_pass(faults, run, f"conv_id {kind}, " + ", ".join(f"{m} long" for m in _MEASURES) + ", audit string")


def _told(rows: DataFrame, found: DataFrame) -> DataFrame:
    """A sorted stream of each conversation's audit followed by its turns."""
    told = rows.where(~F.col("dropped")).select(
        "conv_id", F.lit(1).alias("tag"), "turn", "role", F.sha2("text", 256).alias("digest"), "copy", "text"
    )
    heads = found.select(
        "conv_id", F.lit(0).alias("tag"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("digest"),
        F.lit(0).alias("copy"), F.col("audit").alias("text"),
    )
    return heads.unionByName(told).repartition("conv_id").sortWithinPartitions("conv_id", "tag", *_ORDER).select("conv_id", "tag", "role", "text")


class _Repair:
    """Follows an audit turn by turn."""

    def __init__(self, conv, audit: str):
        self.conv, self.audit, self.at, self.next = conv, audit, 0, "u"

    def inserts(self) -> Iterator[tuple[str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield ROLE[self.next], ""
            self.next = AFTER[self.next]

    def turn(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.next = AFTER[role[0]]
            yield role, text
        elif edit == "R":
            yield ROLE[self.next], text
            self.next = AFTER[self.next]


def _repairs(batches: Iterator[dict]) -> Iterator[tuple[object, Iterator[tuple[str, str]] | None]]:
    """(conversation, turns it now has) as they come, and (conversation, None) at its end."""
    now: _Repair | None = None
    for conv, new, (tag, role, text) in _runs(batches, ("tag", "role", "text")):
        if new:
            if now:
                yield now.conv, now.inserts()
                yield now.conv, None
            now = _Repair(conv, text[0])
            tag, role, text = tag[1:], role[1:], text[1:]
        for r, t in zip(role, text):
            yield conv, now.turn(r, t)
    if now:
        yield now.conv, now.inserts()
        yield now.conv, None


def repaired_turns(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``conv_id, place, role, text``: the turns after repair, in order from 0; inserted ones have an empty text."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        out: dict[str, list] = {c: [] for c in ("conv_id", "place", "role", "text")}
        place = 0
        for conv, made in _repairs(batches):
            if made is None:
                place = 0
            for role, text in made or ():
                for c, v in zip(out, (conv, place, role, text)):
                    out[c].append(v)
                place += 1
            if len(out["place"]) >= 1000:
                yield out
                out = {c: [] for c in out}
        if out["place"]:
            yield out

    kind = rows.schema["conv_id"].dataType.simpleString()
    return arrow_pass(_told(rows, found), run, f"conv_id {kind}, place long, role string, text string")


def digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256``: the digest of the repaired turns as ``role:text`` lines, taken as they stream by."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        ids, sums = [], []
        h, first = hashlib.sha256(), True
        for conv, made in _repairs(batches):
            if made is None:
                ids.append(conv)
                sums.append(h.hexdigest())
                h, first = hashlib.sha256(), True
                if len(ids) >= 2000:
                    yield {"conv_id": ids, "repaired_sha256": sums}
                    ids, sums = [], []
            for role, text in made or ():
                h.update(f"{'' if first else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
                first = False
        if ids:
            yield {"conv_id": ids, "repaired_sha256": sums}

    kind = rows.schema["conv_id"].dataType.simpleString()
    return arrow_pass(_told(rows, found), run, f"conv_id {kind}, repaired_sha256 string")


def repair(conversations: DataFrame, **columns) -> tuple[DataFrame, DataFrame]:
    """One row per conversation with its faults, cost and audit; and the repaired turns of all conversations.

    Turns come in order of ``turn``, nulls first, ties by role and text. A turn's first fault counts: blank (white space
    only), duplicate (role and text seen earlier in the conversation), truncated (last character that is not white space is
    none of ``.!?``). Keeping costs 0, a turn given to user or assistant 3, a deleted one 4, an inserted empty one 3; blank
    and duplicate turns go, truncated ones that stay cost 3 more. The cheapest edits whose role initials are legal are
    taken; of several the one whose audit, the edits' initials in order, sorts first.

    Null roles and texts are one space; rows with a null conversation are one conversation. A role counts by its first
    character, so an unknown or empty one has to be given to user or assistant or deleted. Repeated rows are duplicates.
    An empty table gives empty ones; other columns are not read. Long texts and conversations stream through their task.
    """
    rows = turns(conversations, **columns)
    found = materialise(audits(rows), "audits")
    return found, repaired_turns(rows, found)


def damaged_and_repaired(conversations: DataFrame, **columns) -> DataFrame:
    """Every conversation's measures, audit and digest of repaired turns, after :func:`damage`.

    A conversation that loses all rows has zeros, an empty audit and the empty string's digest.
    """
    rows = damage(conversations, **columns)
    found = materialise(audits(rows), "audits")
    sums = digests(rows, found)
    same = found["conv_id"].eqNullSafe(sums["conv_id"])
    return found.join(sums, same).select(found["conv_id"], *_MEASURES, "audit", "repaired_sha256")
