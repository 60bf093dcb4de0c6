"""Decontamination, filter audit and conversation repair against brute force, and on odd rows."""

from __future__ import annotations

import hashlib
import heapq
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from cohortlake.llm import conversation_repair as repair
from cohortlake.llm import decontamination as leaks
from cohortlake.llm import filter_audit

random.seed(11)
WORD = re.compile(leaks.WORD_PATTERN)


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t)) if t else []


# -- decontamination -------------------------------------------------------------------------------


def found_by_brute_force(text, items, window=10):
    w, hit, who = words(text), set(), set()
    for item, t in items:
        v = words(t)
        n = min(len(v), window)
        for k in range(len(v) - n + 1 if n else 0):
            for i in range(len(w) - n + 1):
                if w[i : i + n] == v[k : k + n]:
                    hit.update(range(i, i + n))
                    who.add(item)
    return len(w), len(hit), sorted(str(i) for i in who if i is not None)


def leak_tables():
    tokens = ["an", "bo", "été", "cu9", "中文", "de", "x"]
    say = lambda n: " ".join(random.choices(tokens, k=n))
    items = [(i, say(random.randint(10, 40))) for i in range(12)] + [(50, "an"), (51, say(3)), (52, say(9)), (52, say(4)), (53, ""), (54, None), (55, " .,"), (None, say(12)), (56, "zz " * 11)]
    docs = [(i, say(random.randint(0, 60))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "!?"), (None, items[0][1]), (103, items[1][1].upper() + "."), (103, items[1][1]), (103, items[1][1])]
    docs += [(104, "q " * 700 + items[2][1].replace(" ", ",\n") + " q" * 300 + " zz" * 25), (105, "Z" * 5000 + " an"), (106, "an" + "\x7f" + "bo`de")]
    return docs, items


DOC = "doc_id long, text string, item_id string, items string, words string, block int, k_id long"


def doc_frame(spark, docs):
    return spark.createDataFrame([(*d, "x", "y", "z", 1, 2) for d in docs], DOC)


@pytest.mark.parametrize("block_words", [500_000, 60])
def test_leaks(spark, block_words):
    docs, items = leak_tables()
    bench = spark.createDataFrame([(*i, "e") for i in items], "item_id long, text string, doc_id string")
    got = leaks.digest(doc_frame(spark, docs), bench, block_words=block_words).collect()
    want = []
    for i, t in docs:
        n, h, who = found_by_brute_force(t, items)
        want.append((i, n, h, len(who), hashlib.sha256(",".join(who).encode()).hexdigest(), h > 0))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_leaks_of_nothing(spark):
    docs, items = leak_tables()
    frame, bench = doc_frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")
    assert leaks.find(frame.where("false"), bench).count() == 0
    assert {r.n_hit for r in leaks.find(frame, bench.where("false")).collect()} == {0}


def test_colliding_words_are_told_apart(monkeypatch):
    docs, items = leak_tables()
    texts = [t.encode() for _, t in docs if t]
    real = leaks._slab_words

    def coarse(*of):
        s, e, h = real(*of)
        return s, e, h % np.uint64(modulus)

    for modulus in (3, 8):  # item words collide; words of no item collide with item words
        monkeypatch.setattr(leaks, "_slab_words", coarse)
        a = leaks.build([(str(i), words(t)) for i, t in items if t], 10)
        n, hit, _, who = leaks.judge(a, texts)
        want = [found_by_brute_force(t.decode(), [i for i in items if i[0] is not None]) for t in texts]
        assert list(zip(n, hit, map(sorted, who))) == want


def test_words_of_slabs_are_the_words_of_the_text():
    texts = [t or "" for _, t in leak_tables()[0]]
    raw = [t.encode() for t in texts]
    bounds = np.cumsum([0, *map(len, raw)])[:-1]
    data = np.frombuffer(b"".join(raw), np.uint8)
    whole = b"".join(raw)
    for slab in (1, 7, 64, 1 << 20):
        s, e, h = leaks.word_places(data, bounds, slab)
        assert [w for i, j in zip(s, e) for w in words(whole[i:j].decode())] == [w for t in texts for w in words(t)]
        assert len(s) == sum(len(words(t)) for t in texts)
        assert all(int(x) == leaks.word_hash(whole[i:j].lower()) for i, j, x in zip(s, e, h))


def test_decontaminate_cuts_and_drops(spark):
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id long, text string")
    told = "One, two three four five six seven eight nine TEN"
    docs = [(1, "Before all. " + told + ". " + "After, " * 30), (2, told), (3, None), (4, "as it  is")]
    got = dict(leaks.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect())
    assert got == {1: "Before all. . " + ("After, " * 30).strip(), 3: None, 4: "as it  is"}


# -- filter audit ----------------------------------------------------------------------------------


def audit_rows():
    say = lambda n: " ".join(random.choice(["ab", "Cd", "ef", "gh", "ij", "k"]) + str(random.randint(0, 300)) for _ in range(n))
    rows = [(i, say(random.choice([30, 250])), random.choice(["en", "de", None, ""])) for i in range(60)]
    rows += [(100 + i, "w " * 300, random.choice(["en", "de"])) for i in range(30)] + [(90, "w " * 300, "fr")]
    rows += [(200, None, "en"), (201, "", "en"), (202, None, None), (None, "w " * 300, "en"), (None, "lonely", "en"), (203, "twice", "en"), (203, "twice", "en"), (204, "twice", "de")]
    rows += [(210, "a|b " * 220, "en"), (211, "\U0001f600 " * 210 + "X" * 7, "en"), (212, "A" * 20000, "en")]
    return rows


LABELS = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 130, 2)] + [(203, 1, None), (203, None, 1), (None, 1, 1), (999, 1, 1), (200, None, None)]


def audit_by_brute_force(rows, labels):
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, x in labels if x == 1}
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    failed = []
    for i, t, p in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        checks = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
                  "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and least[t] < i}
        failed.append((p or "", {c for c, f in checks.items() if f}, i in good and i is not None, i in toxic and i is not None))
    out, shapley = [], Counter()
    for part in {f[0] for f in failed}:
        of = [f for f in failed if f[0] == part]
        for order in itertools.permutations("ABCDE"):
            left = of
            for step, c in enumerate(order, 1):
                gone = [f for f in left if c in f[1]]
                left = [f for f in left if c not in f[1]]
                fails = [f for f in of if c in f[1]]
                shapley[part, c] += len(gone)
                out.append((part, "".join(order), step, len(left), len(gone), len(fails) - len(gone), sum(f[1] == {c} for f in of),
                            sum(f[2] for f in gone), sum(f[3] for f in gone)))
    return sorted((*o, shapley[o[0], o[1][o[2] - 1]]) for o in out)


@pytest.mark.parametrize("cells", [None, 32768])
def test_filter_audit(spark, cells):
    rows = audit_rows()
    docs = spark.createDataFrame([(*r, 1, 2, "h", "n") for r in rows], "doc_id long, text string, lang string, id long, h1 int, part string, n string")
    labels = spark.createDataFrame([(*x, "t") for x in LABELS], "doc_id long, quality int, toxic int, text string")
    got = sorted(map(tuple, filter_audit.audit(docs, labels, cells=cells).collect()))
    assert got == audit_by_brute_force(rows, LABELS)
    assert filter_audit.audit(docs.where("false"), labels).count() == 0
    unlabelled = sorted(map(tuple, filter_audit.audit(docs, labels.where("false")).collect()))
    assert unlabelled == audit_by_brute_force(rows, [])


def test_texts_of_one_hash_stay_apart(spark, monkeypatch):
    from pyspark.sql import functions as F

    rows = audit_rows()
    monkeypatch.setattr(filter_audit, "_keys", lambda text: [(F.length(text) % 3).cast("long").alias("h1"), F.lit(0).cast("long").alias("h2")])
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    assert sorted(map(tuple, filter_audit.audit(docs, labels).collect())) == audit_by_brute_force(rows, LABELS)


def test_hot_texts_are_joined_apart(spark):
    rows = audit_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    narrow = filter_audit.narrow_rows(docs, id_col="doc_id", text_col="text", part_col="lang")
    columns = {"id_col": "doc_id", "text_col": "text", "part_col": "lang"}
    split = [sorted(map(tuple, filter_audit.repeat_rows(docs, narrow, hot_rows=h, **columns).collect())) for h in (1, 5, 1000)]
    assert split[0] == split[1] == split[2] and len(split[0]) == 30 + 2 + 1


def test_the_sketch_clears_most_texts(spark):
    docs = spark.createDataFrame([(i, f"text {i // 2 if i < 200 else i}") for i in range(4000)], "doc_id long, text string")
    rows = filter_audit.narrow_rows(docs.selectExpr("*", "'' as lang"), id_col="doc_id", text_col="text", part_col="lang")
    bits = filter_audit.repeated_cells(rows, 65536)
    left = filter_audit.possible_repeats(docs, bits, 65536, id_col="doc_id", text_col="text")
    assert {r.id for r in left.collect()} >= set(range(200)) and left.count() < 400


# -- conversation repair ---------------------------------------------------------------------------


def cheapest(initials, faults):
    """Every edit sequence, cheapest first and then by its initials, until one gives a legal order."""
    legal = re.compile(r"(s?(ua)+)?$")
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, made = heapq.heappop(heap)
        if (i, made) in done:
            continue
        done.add((i, made))
        if i == len(initials) and legal.match(made):
            return cost, audit
        if len(made) <= len(initials) + 2:
            for r in "ua":
                heapq.heappush(heap, (cost + 3, audit + "I", i, made + r))
        if i < len(initials):
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, made))
            if faults[i] not in (repair.BLANK, repair.DUPLICATE):
                rest = 3 if faults[i] == repair.CUT else 0
                if initials[i]:  # an empty role cannot stay
                    heapq.heappush(heap, (cost + rest, audit + "K", i + 1, made + initials[i]))
                for r in "ua":
                    heapq.heappush(heap, (cost + rest + 3, audit + "R", i + 1, made + r))


def cases(n, longest):
    for _ in range(n):
        k = random.randint(0, longest)
        yield [random.choice(["u", "a", "u", "a", "s", "", "x"]) for _ in range(k)], [random.choice([0, 0, 0, 1, 2, 3]) for _ in range(k)]


def test_alignment_is_the_cheapest_and_sorts_first():
    for initials, faults in cases(300, 6):
        assert repair.align(initials, faults) == repair.align_by_pattern(initials, faults) == cheapest(initials, faults)


def test_both_alignments_agree_on_longer_conversations():
    for initials, faults in cases(40, 120):
        assert repair.align(initials, faults) == repair.align_by_pattern(initials, faults)


def conversation_rows():
    say = lambda: random.choice(["Yes. No!", "cut off", " \n", "", "Why?", "Fine. \t", "Long " * 2000 + "end.", None])
    rows = [(c, t, random.choice(["user", "assistant", "system", "unknown", None, ""]), say()) for c in range(80) for t in random.sample(range(9), random.randint(1, 8))]
    rows += [(500, t % 700, ["user", "assistant"][t % 2], f"turn {t}.") for t in range(2100)]
    rows += [(None, 1, "user", "Who?"), (None, None, "assistant", "Me."), (501, None, "user", "A."), (501, 3, "user", "A."), (501, 3, "user", "A."), (501, 2, "assistant", None)]
    return rows + [(c, 0, "user", "x.") for c in range(600, 660)]


def repaired_by_brute_force(rows):
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((t, " " if r is None else r, " " if x is None else x))
    for c, turns in by.items():
        kept = []
        for t, r, x in turns:
            f = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
            x = "" if f == 1 else re.sub("[.!?]", "", x) if f == 2 else x
            kept += [(t, "user" if f == 4 else r, x)] * (0 if f == 0 else 2 if f == 3 else 1)
        kept.sort(key=lambda k: (k[0] is not None, k[0] or 0, k[1], hashlib.sha256(k[2].encode()).hexdigest()))
        seen, faults = set(), []
        for _, r, x in kept:
            end = x.rstrip(repair.SPACE)
            faults.append(repair.BLANK if not end else repair.DUPLICATE if (r, x) in seen else repair.CUT if end[-1] not in ".!?" else 0)
            seen.add((r, x))
        initials = [r[:1] for _, r, _ in kept]
        cost, audit = cheapest(initials, faults) if len(kept) < 9 else repair.align_by_pattern(initials, faults)
        lines, made, i = [], "", 0
        for e in audit:
            nxt = "u" if made[-1:] != "u" else "a"
            if e == "I":
                lines.append(("user" if nxt == "u" else "assistant") + ":")
                made += nxt
                continue
            _, r, x = kept[i]
            i += 1
            if e == "K":
                lines.append(f"{r}:{x}")
                made += r[0]
            elif e == "R":
                lines.append(("user" if nxt == "u" else "assistant") + ":" + x)
                made += nxt
        seen_turns = [t for t, _, _ in kept if t is not None]
        gaps = max(seen_turns) - min(seen_turns) + 1 - len(set(seen_turns)) if seen_turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        yield (c, gaps, *[faults.count(f) for f in (1, 2, 3)], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def test_repair(spark):
    rows = conversation_rows()
    frame = spark.createDataFrame([(*r, "c", "t", 1) for r in rows], "conv_id long, turn long, role string, text string, copy string, tag string, dropped int")
    got = sorted(map(tuple, repair.damaged_and_repaired(frame).collect()), key=repr)
    assert got == sorted(repaired_by_brute_force(rows), key=repr)
    assert any(g[7] == "" for g in got) and repair.damaged_and_repaired(frame.where("false")).count() == 0


def test_repaired_turns_are_legal(spark):
    rows = [r for r in conversation_rows() if r[0] != 500]
    found, turns = repair.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    made = defaultdict(list)
    for r in turns.collect():
        made[r.conv_id].append((r.place, r.role, r.text))
    assert found.count() == len({r[0] for r in rows})
    for turns in made.values():
        turns.sort()
        assert [p for p, _, _ in turns] == list(range(len(turns)))
        assert re.fullmatch("s?(ua)+", "".join(r[0] for _, r, _ in turns))
