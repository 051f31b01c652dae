import hashlib
import random
from collections import defaultdict

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tessera.llm import sampling, splitting

TEXTS = ["", "short", "x" * 5000, "😀" * 900, ("A sentence here. " * 20 + "\n\n") * 30, "line of text without stops\n" * 300, "売上高は増加しました。" * 200, "word " * 3000, "a\n\n" * 2000]


@pytest.mark.parametrize("most, overlap", [(400, 50), (1000, 0), (64, 30), (100, 90), (333, 7)])
def test_pieces_lie_end_to_end(most, overlap):
    for t in TEXTS:
        data = t.encode()
        pieces, done, out = splitting.cut(data, most, overlap), 0, b""
        for k, (a, b) in enumerate(pieces):
            data[a:b].decode()
            assert b - a <= max(most, len(data) if len(pieces) == 1 and len(data) <= most else 0)
            if k:
                assert min(overlap, most // 2) - 3 <= done - a <= overlap and a <= done
            if overlap == 0 and k:
                assert a == done
            out += data[done:b]
            assert b > done or not data
            done = b
        assert out == data


@pytest.mark.parametrize("overlap", [0, 40])
def test_cuts_are_natural_where_they_can_be(overlap):
    for t in (TEXTS[4], TEXTS[5], TEXTS[7]):
        data = t.encode()
        for _, b in splitting.cut(data, 600, overlap)[:-1]:
            assert data[b - 1 : b] in (b" ", b"\n")
    lines = TEXTS[5].encode()
    assert all(lines[b - 1 : b] == b"\n" for _, b in splitting.cut(lines, 600, overlap)[:-1])


def test_an_edit_alters_only_near_pieces():
    r = random.Random(1)
    t = " ".join("".join(r.choice("abcdefgh") for _ in range(r.randrange(2, 9))) + r.choice(["", "", "", ".", ".\n"]) for _ in range(20_000))
    edited = t[:50_000] + " an insertion of some words" + t[50_000:]
    a, b = ([x.encode()[p:q] for p, q in splitting.cut(x.encode(), 2000)] for x in (t, edited))
    assert len(set(a) - set(b)) <= 6 and len(a) > 40


def test_rolling_hash_depends_on_the_window_only():
    import numpy as np

    data = np.frombuffer(bytes(random.Random(2).randrange(256) for _ in range(3000)), np.uint8)
    shifted = np.concatenate([np.zeros(777, np.uint8), data])
    assert (splitting.rolling_hash(data)[splitting.WINDOW :] == splitting.rolling_hash(shifted)[777 + splitting.WINDOW :]).all()


def test_limits_and_rows(spark):
    limits = [("10-K", 300, 20), ("EX-10", 100, 10), ("EX-1", 150, 0), ("OTHER", 200, 10)]
    data = [(1, " ex-10.1 ", "y " * 120, 7), (2, "EX-12", "y " * 120, 7), (3, None, "y " * 90, 7), (4, "10-k/a", None, 7), (5, "10-K", "", 7), (None, "S-1", "y " * 150, None), (6, "ex", "y " * 150, 1), (6, "ex", "y " * 150, 1)]
    df = spark.createDataFrame(data, "doc_id long, document_type string, text string, piece long")
    limit = splitting.limits_of(F.col("document_type"), limits)
    assert [r.m for r in df.select(limit["max_bytes"].alias("m")).collect()] == [100, 150, 200, 300, 300, 200, 200, 200]
    out = splitting.split(df, ["doc_id"], "text", limit).collect()
    assert {r.doc_id: r.pieces > 1 for r in out} == {1: True, 2: True, 3: False, 5: False, None: True, 6: True}
    assert sum(r.doc_id == 6 for r in out) == 2 * max(r.pieces for r in out if r.doc_id == 6)
    assert splitting.split(df.filter("false"), ["doc_id"], "text", limit, with_text=False).count() == 0
    none = splitting.limits_of(F.col("document_type"), limits[:1])
    assert splitting.split(df.filter("doc_id = 2"), ["doc_id"], "text", none).head().pieces == 1  # no limit applies
    with pytest.raises(ValueError):
        splitting.cut(b"x" * 99, 8)


TARGETS = "period_label string, first_year int, last_year int, form_type string, target_pct int, min_rows long, sample_size long, company_cap int"


def best(size, shares, least, wanted, available):
    """Places dealt one by one, as the rule says."""
    units = []
    for j, (s, m, w, n) in enumerate(zip(shares, least, wanted, available)):
        for k in range(1, n + 1):
            if k <= m:
                units.append((0, k / m, j))
            elif s > 0:
                units.append((1 if k <= w else 2, (2 * k - 1) / s, j))
    out = [0] * len(shares)
    for _, _, j in sorted(units)[:size]:
        out[j] += 1
    return out


def test_fitted_quotas(spark):
    r = random.Random(8)
    for _ in range(600):
        n = r.randrange(1, 7)
        size = r.choice([0, 1, 7, 40, 300])
        shares, least, available = [r.choice([0, 1, 5, 20, 33, 60]) for _ in range(n)], [r.choice([0, 1, 6, 50]) for _ in range(n)], [r.choice([0, 1, 3, 20, 200]) for _ in range(n)]
        wanted = [max(m, -(-s * size // 100)) for s, m in zip(shares, least)]
        got = sampling.fit(size, shares, least, wanted, available)
        assert got == best(size, shares, least, wanted, available)
        assert sum(got) <= size and all(q <= a for q, a in zip(got, available))
    assert sampling.fit(10, [33, 33, 34], [6, 6, 6], [6, 6, 6], [99, 99, 99]) == [4, 3, 3]  # minima that cannot all hold
    assert sampling.fit(100, [50, 50], [1, 1], [50, 50], [10, 500]) == [10, 90]  # what one cannot give is passed on
    assert sum(sampling.fit(10**9, [38, 27, 35], [9, 9, 9], [38 * 10**7, 27 * 10**7, 35 * 10**7], [10**12] * 3)) == 10**9


def test_sample_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(sampling, "TRIM_ROWS", 100)
    r = random.Random(3)
    items = [(f"i{k}", r.choice(["8-K", "8-K", "10-K", "10K", "8-K/A", "def 14a"]), "hot" if r.random() < 0.4 else f"c{r.randrange(30)}", r.randrange(1999, 2012)) for k in range(3000)]
    t = [("p", 2001, 2006, "8-K", 60, 1, 200, 9), ("p", 2001, 2006, "10-K", 30, 1, 200, 9), ("p", 2001, 2006, "DEF 14A", 10, 50, 200, 1), ("q", 2005, 2010, "8-k", 99, 1, 900, 20), ("q", 2005, 2010, "424B3", 1, 3, 900, 20), (None, 1, 2, "8-K", 1, 1, 1, 1)]
    t += [("free", 1999, 2012, "8-K", 50, 1, 100, None), ("free", 1999, 2012, "10-K", 50, 1, 100, 400)]
    df = spark.createDataFrame(items, "item string, category string, company string, year int").withColumn("cell", F.lit("clash")).withColumn("quota", F.lit("clash"))
    df = df.withColumn("category", sampling.category_key(F.col("category")))
    drawn, report = sampling.sample(df, spark.createDataFrame(t, TARGETS), bins=64)
    rep = {(x.period_label, x.form_type): x for x in report.collect()}
    sampled = defaultdict(set)
    for x in drawn.collect():
        sampled[x.period_label, x.form_type].add((x.item, x.company))
    assert len(rep) == 7
    key = lambda f: f.upper().replace("-", "").replace(" ", "")
    mark = lambda i: hashlib.md5(f"11|{i}".encode()).hexdigest()[:15]
    for p in ("p", "q", "free"):
        cells = sorted((x for x in t if x[0] == p), key=lambda x: key(x[3]))
        pools, counts = [], []
        for _, a, b, f, _, _, _, cap in cells:
            own = defaultdict(list)
            for i, c, company, year in items:
                if key(c) == key(f) and a <= year <= b:
                    own[company].append((mark(i), i, company))
            counts.append(sum(map(len, own.values())))
            pools.append(sorted(x for xs in own.values() for x in sorted(xs)[:cap]))
        wanted = [max(x[5], -(-x[4] * x[6] // 100)) for x in cells]
        quota = best(cells[0][6], [x[4] for x in cells], [x[5] for x in cells], wanted, [len(x) for x in pools])
        for x, pool, n, w, q in zip(cells, pools, counts, wanted, quota):
            y = rep[p, x[3]]
            assert (y.wanted, y.quota, y.seen, y.available, y.sampled, y.short, y.unmet) == (w, q, n, len(pool), q, len(pool) < w, max(0, w - q))
            assert sampled[p, x[3]] == {z[1:] for z in pool[:q]}
    again = sampling.sample(df.repartition(7), spark.createDataFrame(t, TARGETS), bins=64)[0]
    assert sorted(rows(again)) == sorted(rows(drawn))


def test_the_report_is_one_of_a_drawn_sample(spark):
    t = spark.createDataFrame([("p", 2000, 2010, "8-K", 100, 1, 10, 2)], TARGETS)
    df = spark.createDataFrame([(f"i{k}", "8K", "c", 2005) for k in range(9)], "item string, category string, company string, year int")
    short = sampling.sample(df, t)[1].filter("short").select("period_label", "form_type")
    plan = short._jdf.queryExecution().optimizedPlan().toString()
    assert "_rank" in plan and "_first" in plan and short.count() == 1  # the trimming is part of what tells the shortfalls


def test_empty_and_null_items(spark):
    t = spark.createDataFrame([("p", 2000, 2010, "8-K", 100, 1, 10, 2)], TARGETS)
    df = spark.createDataFrame([(None, "8K", "c", 2005), ("i", None, "c", 2005), ("j", "8K", None, 2005), ("k", "8K", "c", None), ("l", "8K", "c", 1990)], "item string, category string, company string, year int")
    drawn, report = sampling.sample(df, t)
    assert drawn.count() == 0 and report.select("available", "sampled", "short", "unmet").head() == (0, 0, True, 10)
    assert sampling.sample(df, t.filter("false"))[1].count() == 0
    nothing = spark.createDataFrame([("p", 2000, 2010, "8-K", None, None, None, None)], TARGETS)
    assert sampling.sample(df.withColumn("year", F.lit(2005)), nothing)[1].select("wanted", "sampled", "short").head() == (0, 0, False)
