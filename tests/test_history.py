import datetime as dt
import random
from itertools import groupby

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tessera.functions.codes import bracket_code, plain_cik, state_code, year_end
from tessera.operators import history
from tessera.operators.history import Conflict, HistoryStore, build_chains
from tessera.session import shared_dir

SCHEMA = "entity string, attribute string, at date, source string, value string, ends boolean"


def brute(changes):
    out = set()
    for (e, a), chain in groupby(sorted(c for c in changes if None not in c[:5]), key=lambda c: c[:2]):
        last, n, open_ = None, 0, None
        for c in chain:
            if c[4] != last:
                if open_:
                    out.add((*open_, c[2]))
                n += 1
                open_, last = (e, a, n, c[4], c[2]), c[4]
        out.add((*open_, None))
    return out


def corrected(batches):
    """All changes of all batches but those whose source says something else later."""
    last = {c[:2] + (c[3],): k for k, b in enumerate(batches) for c in b if c[3] is not None}
    return [c for k, b in enumerate(batches) for c in b if c[3] is None or last[c[:2] + (c[3],)] == k]


def random_changes(n, seed):
    r = random.Random(seed)
    days = [dt.date(2001, 1, 1) + dt.timedelta(days=k) for k in range(0, 4000, 7)]
    # one entity holds a third of all rows; some days have several values
    return [("hot" if r.random() < 0.33 else f"e{r.randrange(40)}", r.choice(["sic", "state"]), r.choice(days[:60]), f"f{k:05d}", r.choice("AAABC"), False) for k in range(n)]


def found(df):
    return {(r.entity, r.attribute, r.version, r.value, r.valid_from, r.valid_to) for r in df.collect()}


def test_chains_equal_brute_force(spark):
    changes = random_changes(1500, 1)
    assert found(build_chains(spark.createDataFrame(changes + changes[:200], SCHEMA))) == brute(changes)


def test_affected_chain_rebuild_equals_a_full_build(spark, monkeypatch):
    monkeypatch.setattr(history, "MERGE_BATCHES", 2)  # so that raw batches are merged as well
    changes = random_changes(600, 2)
    store = HistoryStore(spark, shared_dir(spark), buckets=4)
    r = random.Random(3)
    r.shuffle(changes)
    restated = [(*c[:2], c[2] + dt.timedelta(days=r.randrange(30)), c[3], r.choice("ABC"), False) for c in changes[100:350:3]]
    taken_back = [(*c[:2], None, c[3], None, False) for c in changes[350:420:4]]
    batches = [changes[:300], changes[300:420], [*changes[420:], *restated], taken_back]
    for part in batches:
        store.apply(spark.createDataFrame(part, SCHEMA))
    assert found(store.chains()) == brute(corrected(batches))
    before = store.manifest()
    store.apply(spark.createDataFrame([("e1", "sic", dt.date(2000, 1, 1), "late", "Z", False)], SCHEMA))
    after = store.manifest()
    assert sum(before["chains"][k] != after["chains"][k] for k in before["chains"]) == 1  # only the bucket touched is replaced
    assert ("e1", "sic", 1, "Z") in {x[:4] for x in found(store.chains())}
    want = found(store.chains())
    store.vacuum()
    assert found(store.chains()) == want and store.manifest() == after
    store.apply(spark.createDataFrame([], SCHEMA))
    assert found(store.chains()) == want


def test_a_correction_corrects(spark):
    store = HistoryStore(spark, shared_dir(spark), buckets=2)
    d = lambda k: dt.date(2021, 1, k)
    store.apply(spark.createDataFrame([("c", "sic", d(1), "f1", "100", False), ("c", "sic", d(2), "f2", "200", False)], SCHEMA))
    store.apply(spark.createDataFrame([("c", "sic", d(2), "f2", "100", False)], SCHEMA))
    assert found(store.chains()) == {("c", "sic", 1, "100", d(1), None)}
    store.apply(spark.createDataFrame([("c", "sic", d(3), "f1", "300", False)], SCHEMA))  # another date and value
    assert found(store.chains()) == {("c", "sic", 1, "100", d(2), d(3)), ("c", "sic", 2, "300", d(3), None)}
    store.apply(spark.createDataFrame([("c", "sic", None, "f1", None, False), ("c", "sic", None, "f2", None, False)], SCHEMA))
    assert found(store.chains()) == set() and store.manifest()["chains"] == {}


def test_of_two_writers_one_fails(spark, monkeypatch):
    path = shared_dir(spark)
    one, other = HistoryStore(spark, path, buckets=2), HistoryStore(spark, path, buckets=2)
    first, second = ("c", "sic", dt.date(2021, 1, 1), "f1", "100", False), ("c", "sic", dt.date(2021, 1, 2), "f2", "200", False)
    one.apply(spark.createDataFrame([first], SCHEMA))
    stale = other.manifest()
    one.apply(spark.createDataFrame([second], SCHEMA))
    monkeypatch.setattr(other, "manifest", lambda: stale)
    with pytest.raises(Conflict):
        other.apply(spark.createDataFrame([("c", "sic", dt.date(2021, 1, 3), "f3", "300", False)], SCHEMA))
    assert found(one.chains()) == brute([first, second])


def test_dated_changes(spark):
    d = lambda k: dt.date(2010, 1, k)
    changes = [
        ("c", "name", d(5), "f1", "OLD", True), ("c", "name", d(5), "f2", "OLDER", True), ("c", "name", d(9), "f2", "MID", True),
        ("c", "name", d(3), "f1", "OLD", None), ("c", "name", d(12), "f3", "NEW", None), ("gone", "name", d(7), "f9", "X", True),
    ]
    changes += [("only", "name", d(3), "f1", "A", None), ("only", "name", d(4), "f2", "B", None)]  # names seen to differ, but no date told
    want = {
        ("c", "name", 1, "OLD", None, d(5)), ("c", "name", 2, "MID", d(5), d(9)), ("c", "name", 3, "NEW", d(9), None),
        ("gone", "name", 1, "X", None, d(7)), ("gone", "name", 2, None, d(7), None), ("only", "name", 1, "B", None, None),
    }
    assert found(build_chains(spark.createDataFrame(changes, SCHEMA))) == want
    store = HistoryStore(spark, shared_dir(spark), buckets=2)  # the former names arrive late
    store.apply(spark.createDataFrame([c for c in changes if not c[5]], SCHEMA))
    store.apply(spark.createDataFrame([c for c in changes if c[5] and c[3] != "f2"], SCHEMA))
    store.apply(spark.createDataFrame([c for c in changes if c[3] == "f2"], SCHEMA))
    store.apply(spark.createDataFrame([c for c in changes if c[3] == "f1"], SCHEMA))
    assert found(store.chains()) == want


def test_nulls_ties_empty_and_other_columns(spark):
    d = dt.date(2010, 1, 1)
    changes = [(None, "a", d, "s", "v", False), ("e", None, d, "s", "v", False), ("e", "a", None, "s", "v", False), ("e", "a", d, "s", None, False), ("e", "a", d, None, "v", False), ("e", "a", d, "s", "v", False)]
    df = spark.createDataFrame(changes, SCHEMA).withColumn("bucket", F.lit(1)).withColumn("version", F.lit(9)).withColumn("batch", F.lit("x"))
    assert rows(build_chains(df).select("entity", "attribute", "version", "value")) == [("e", "a", 1, "v")]
    assert build_chains(df.filter("false")).count() == 0
    store = HistoryStore(spark, shared_dir(spark))
    assert store.chains().count() == 0
    store.apply(df)
    store.apply(df)
    assert rows(store.chains().select("entity", "attribute", "version", "value")) == [("e", "a", 1, "v")]


def test_values_that_return_on_one_day(spark):
    day, later = dt.date(2010, 1, 1), dt.date(2010, 2, 1)
    changes = [("c", "sic", day, f"f{k}", v, False) for k, v in enumerate("AABBA")] + [("c", "sic", later, "f7", "A", False)]
    changes += [("c", "name", day, f"f{k}", v, None) for k, v in enumerate("ABA")]
    once = found(build_chains(spark.createDataFrame(changes + changes[:3], SCHEMA)))
    assert {x for x in once if x[1] == "sic"} == brute(changes[:6]) and not any(x[4] == later for x in once)
    assert {x for x in once if x[1] == "name"} == {("c", "name", 1, "A", None, None)}
    store = HistoryStore(spark, shared_dir(spark), buckets=2)
    for part in (changes[::2], changes[1::2]):
        store.apply(spark.createDataFrame(part, SCHEMA))
    assert found(store.chains()) == once


def test_values_are_compared_by_meaning(spark):
    df = spark.createDataFrame(
        [("FARM CROPS[100]", "delaware", "12/31", " 0000020187"), ("0100", "DE ", "--12-31", "CIK 20187"), ("Farm Crops  [ 0100 ]", "De", "Dec 31", "20187"), ("[]", "XX", "0000", "N/A"), ("0000", None, "N/A", None), ("x", "", "1331", "000")],
        "sic string, st string, fy string, cik string",
    )
    out = rows(df.select(bracket_code(F.col("sic")), state_code(F.col("st")), year_end(F.col("fy")), plain_cik(F.col("cik"))))
    assert out == [("100", "DE", "1231", "20187")] * 3 + [(None, None, None, None)] * 3
