import datetime as dt
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cohortlake.functions import space_filling
from cohortlake.operators import monitoring as mon
from cohortlake.sources import tables


def watched():
    rng = random.Random(5)
    rows = []
    for i in range(400):
        score = rng.choice([None, math.nan, 400.0, 500.0, 650.0])
        rows.append((rng.choice(["a", "b", None]), i % 3 == 0, score, rng.choice(["cut", "hold", None]), rng.choice([0, 1, None]), rng.choice([0.1, 0.3, None])))
    return rows + [("c", False, 650.0, "hold", None, None)]


SCHEMA = "month string, base boolean, `s.1` double, action string, target int, pd double"


def by_hand(rows):
    band = lambda s: "(missing)" if s is None or math.isnan(s) else str(1 + (s >= 500) + (s >= 600))
    cells, base, totals = {}, Counter(), Counter()
    for m, b, s, action, t, p in rows:
        for f, x in (("s.1", band(s)), ("action", action or "(missing)")):
            cells.setdefault((m, f, x), []).append((t, p))
            totals[m, f] += 1
            base[f, x] += bool(b)
    mean = lambda v: sum(v) / len(v) if v else None
    out = {}
    for m, f in totals:
        index = 0.0
        of = [(t, p) for (m2, f2, _), c in cells.items() if (m2, f2) == (m, f) for t, p in c]
        for g, x in {(f2, x) for _, f2, x in cells}:
            if g != f:
                continue
            c = cells.get((m, f, x), [])
            a, e = len(c) / totals[m, f], base[f, x] / sum(n for (g2, _), n in base.items() if g2 == f)
            psi = (max(a, 1e-6) - max(e, 1e-6)) * math.log(max(a, 1e-6) / max(e, 1e-6))
            index += psi
            out[m, f, x] = (len(c), a, e, psi, mean([t for t, _ in c if t is not None]), mean([p for _, p in c if p is not None]))
        out[m, f, None] = (totals[m, f], 1, 1, index, mean([t for t, _ in of if t is not None]), mean([p for _, p in of if p is not None]))
    return out


def test_monitoring(spark):
    rows = watched()
    df = spark.createDataFrame(rows, SCHEMA)
    got = mon.monitoring(df, "month", {"s.1": [500, 600]}, F.col("base"), categories=["action"]).collect()
    want = by_hand(rows)
    assert {r[:3] for r in got} == set(want) and len(got) == len(want)
    for r in got:
        for a, b in zip(r[3:], want[r[:3]]):
            assert a == b if b is None else a == pytest.approx(b, abs=1e-12), r


def test_monitoring_of_nothing(spark):
    df = spark.createDataFrame(watched(), SCHEMA)
    assert mon.monitoring(df.where("false"), "month", {"s.1": [500]}, F.col("base")).count() == 0
    no_base = mon.monitoring(df, "month", {"s.1": [500]}, F.lit(None).cast("boolean")).where("band IS NOT NULL")
    assert {r.base_share for r in no_base.collect()} == {0.0}


# -- layout on several columns ------------------------------------------------------------------------


def layout_rows(spark, n=20_000):
    rng = random.Random(1)
    rows = [(int(rng.paretovariate(0.7)), rng.choice("abcdefghijklmnop") * rng.randint(1, 9), dt.date(2000, 1, 1) + dt.timedelta(rng.randint(0, 900)), i) for i in range(n)]
    return spark.createDataFrame([*rows, (None, None, None, -1)], "skewed long, name string, day date, id long")


def ranges_of_files(spark, path, column):
    of = spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    return [(r.lo, r.hi) for r in of.collect() if r.lo is not None]


def test_files_prune_on_every_column(spark, tmp_path):
    df = layout_rows(spark)
    path = str(tmp_path / "z")
    tables.clustered_on_all(df, ["skewed", "name", "day"], partitions=64).write.parquet(path)
    back = spark.read.parquet(path)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)
    for column, values in {"skewed": [2, 9, 300], "name": ["a", "hh", "ppp"], "day": [dt.date(2000, 2, 1), dt.date(2001, 5, 5)]}.items():
        files = ranges_of_files(spark, path, column)
        for v in values:
            assert sum(lo <= v <= hi for lo, hi in files) <= len(files) / 2, (column, v)


def test_one_sort_order_prunes_only_its_first_column(spark, tmp_path):
    path = str(tmp_path / "sorted")
    tables.clustered(layout_rows(spark), ["day", "name"], partitions=64).write.parquet(path)
    files = ranges_of_files(spark, path, "name")
    assert sum(lo <= "hh" <= hi for lo, hi in files) > len(files) * 0.9


def test_parts_keep_the_order(spark):
    df = spark.createDataFrame([("",), ("a",), ("ab",), ("b",), ("é",), ("中",), (None,)], "t string")
    got = df.select("t", space_filling.as_number("t", df.schema["t"].dataType).alias("n")).collect()
    known = sorted([r for r in got if r.t is not None], key=lambda r: r.t.encode())
    assert [r.n for r in known] == sorted(r.n for r in known) and [r.n for r in got if r.t is None] == [None]
    nums = spark.createDataFrame([(float(v),) for v in (-1, 0, 0.5, 1, 7)] + [(None,), (math.nan,)], "v double")
    parts = {repr(r.v): r.p for r in nums.select("v", space_filling.part_of(F.col("v"), [0.0, 1.0]).alias("p")).collect()}
    assert parts == {"-1.0": 0, "0.0": 1, "0.5": 1, "1.0": 2, "7.0": 2, "None": 0, "nan": 2}
    with pytest.raises(ValueError):
        space_filling.interleaved(df, ["t"] * 11, bits=6)
