import datetime as dt
import random
import zoneinfo

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tessera.functions.timeparse import LONGEST, compile_shape, read_texts, shape_of
from tessera.functions.zones import utc_to_wall, wall_to_utc
from tessera.operators.timestamps import normal_values, with_normal_times


def instant(text):
    utc, fine, _, _ = read_texts([text])
    return str(np.datetime64(int(utc[0]), "s")) + "Z" if fine[0] else None


def date(text):
    _, _, day, fine = read_texts([text])
    return str(np.datetime64(int(day[0]), "D")) if fine[0] else None


@pytest.mark.parametrize(
    "text, want",
    [
        ("20060705185728", "2006-07-05T22:57:28Z"), ("  20180724213157 ", "2018-07-25T01:31:57Z"), ("201307081111", "2013-07-08T15:11:00Z"),
        ("2019-05-13 14:01:39", "2019-05-13T18:01:39Z"), ("2007-04-18T21:10:44Z", "2007-04-18T21:10:44Z"), ("2018-02-02T18:42:21.163Z", "2018-02-02T18:42:21Z"),
        ("2011-01-04T21:00:14-05:00", "2011-01-05T02:00:14Z"), ("2005-09-17T01:35:41+01:00", "2005-09-17T00:35:41Z"), ("2007-01-04T05:39:54+05:30", "2007-01-04T00:09:54Z"),
        ("Mon, 10 Dec 2001 19:37:57 EST", "2001-12-11T00:37:57Z"), ("02/27/2003 05:26:16 PM", "2003-02-27T22:26:16Z"), ("12/01/2005 12:15 AM", "2005-12-01T05:15:00Z"),
        ("1404815399", "2014-07-08T10:29:59Z"), ("1165508534691", "2006-12-07T16:22:14Z"), ("2018-10-12 18:16:28 CDT", "2018-10-12T23:16:28Z"), ("13-MAR-2016 02:35:34 ET", "2016-03-13T07:35:34Z"),
        ("<ACCEPTANCE-DATETIME>20020924153918", "2002-09-24T19:39:18Z"), ("2024-03-15T20:56:55.909264-04:00", "2024-03-16T00:56:55Z"),
        ("2015-11-01 01:30:00", "2015-11-01T05:30:00Z"), ("2015-03-08 02:30:00", "2015-03-08T07:30:00Z"), ("2006-04-02 02:30:00", "2006-04-02T07:30:00Z"),
        ("25:61", None), ("20041342996100", None), ("2011-02-30 10:00:00", None), ("", None), ("N/A", None), (None, None), ("2014-03-01", None), ("13/01/2005 13:15 PM", None), ("x" * 100_000, None),
        ("２０１４-03-01 10:00:00", None), ("2014-01-01 10:00:00 XYZ", None),
    ],
)
def test_instants(text, want):
    assert instant(text) == want


@pytest.mark.parametrize(
    "text, want",
    [
        ("20180202", "2018-02-02"), ("2010-09-17", "2010-09-17"), ("02/13/2017", "2017-02-13"), ("15-APR-2014", "2014-04-15"), ("2019-02-25T00:00:00", "2019-02-25"), ("2008-07-29T00:29:57Z", "2008-07-28"),
        ("2016/07/15", "2016-07-15"), ("29 Mar 2021", "2021-03-29"), ("2007-06-20T03:36:31+01:00", "2007-06-19"), ("2010-02-26 23:21:19 -0500", "2010-02-26"), ("6/15/15", "2015-06-15"), ("March 20, 2013", "2013-03-20"),
        ("September 4, 2004", "2004-09-04"), ("2/29/15", None), ("20231301", None), ("00000000", None), ("see header", None), ("-", None), (None, None), ("2012-02-29", "2012-02-29"), ("Smarch 1, 2004", None),
    ],
)
def test_dates(text, want):
    assert date(text) == want


def test_zone_tables_agree_with_the_zone_database():
    zone = zoneinfo.ZoneInfo("America/New_York")
    random.seed(1)
    for s in (random.randrange(0, 2_000_000_000) for _ in range(5000)):
        wall = dt.datetime(1970, 1, 1) + dt.timedelta(seconds=s)
        assert wall_to_utc(np.array([s]), "US/Eastern")[0] == int(wall.replace(tzinfo=zone, fold=0).timestamp())
        back = dt.datetime.fromtimestamp(s, zone).replace(tzinfo=None)
        assert utc_to_wall(np.array([s]), "US/Eastern")[0] == int((back - dt.datetime(1970, 1, 1)).total_seconds())


def test_a_shape_is_compiled_once():
    a = compile_shape(shape_of("2011-01-04T21:00:14Z"))
    assert a is compile_shape(shape_of("1999-12-31T23:59:59Z"))


def test_every_row_keeps_its_place_and_other_columns(spark):
    df = spark.createDataFrame([(1, "20180202", "x"), (2, None, "y"), (3, "junk", None), (4, "20180202", "z")], "id long, d string, day string")
    out = with_normal_times(df, [], ["d"]).orderBy("id")
    assert out.columns == ["id", "d", "day", "d_normal"]
    assert [r.d_normal for r in out.collect()] == ["2018-02-02", None, None, "2018-02-02"]


def test_repeated_rows_give_one_value(spark):
    df = spark.createDataFrame(
        [("a", 1, "2014-03-01 10:00:00", "20140301", 1), ("a", 2, "20140301100000", "03/01/2014", 2), ("a", 3, None, "junk", 3), (None, 1, "20140301100000", "20140301", 4), ("b", 1, "", None, 5)],
        "filing_id string, o int, acc string, filed string, field_name int",
    )
    assert sorted(rows(normal_values(df, "filing_id", "o", ["acc"], ["filed"]))) == [("a", "acc", "2014-03-01T15:00:00Z"), ("a", "filed", "2014-03-01")]
    assert rows(normal_values(df.filter("false"), "filing_id", "o", ["acc"], ["filed"])) == []


def test_the_session_zone_does_not_matter(spark):
    df = spark.createDataFrame([("20140301100000",)], "t string")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert with_normal_times(df, ["t"], []).select(F.col("t_normal")).head()[0] == "2014-03-01T15:00:00Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_long_values_are_read_or_are_none():
    from tessera.functions.timeparse import read_texts

    texts = [" " * 500 + "2014-01-24" + " " * 500, "<" + "X" * 300 + ">20140124", "Friday,   " + " " * 200 + "24 January 2014", "2014-01-24" + "0" * 100_000, "x" * 1_000_000, "< " * 50_000]
    _, _, day, fine = read_texts(texts)
    assert fine.tolist() == [True, True, fine[2], False, False, False] and day[0] == day[1] == 16094
