from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tessera.operators import relational as R
from tessera.sources import fetch as net
from tessera.sources import readers, tables, writers


def test_retries_and_waits():
    slept, answers = [], [net.Response(503, b"", "7"), net.Response(429), OSError("broken"), net.Response(200, b"x")]

    def transport(url):
        a = answers.pop(0)
        if isinstance(a, OSError):
            raise a
        return a

    assert net.get("u", transport, 3, net.Throttle(0.0), slept.append) == (net.Response(200, b"x"), "", 4) and slept == [7.0, 4.0, 8.0]
    answers[:] = [net.Response(503)] * 3
    assert net.get("u", transport, 2, net.Throttle(0.0), slept.append) == (None, "HTTP 503", 3)
    assert [net.retry_delay(k, a) for k, a in ((1, None), (9, None), (1, "soon"), (1, "1e9"), (1, "-3"))] == [2.0, 60.0, 2.0, 60.0, 0.0]
    now, waits = [0.0], []
    t = net.Throttle(0.15, lambda: now[0], waits.append)
    t.wait()
    now[0] = 0.05
    t.wait()
    now[0] = 9.0
    t.wait()
    assert [round(w, 6) for w in waits] == [0.1]


def test_fetched_files(spark, tmp_path):
    answer = lambda url: net.Response(200, url.encode()) if url.endswith("a") else net.Response(404)
    (tmp_path / "x").write_bytes(b"there")
    (tmp_path / "empty").write_bytes(b"")
    data = [("u/a", "raw/1.txt"), ("u/b", "raw/2.txt"), ("u/a", "x"), ("u/a", "empty"), (None, "n"), (" ", "n"), ("u/a", None)]
    df = spark.createDataFrame(data, "filing_url string, output_path string").withColumn("status", F.lit("clash"))
    got = {(r.output_path, r.status, r.bytes_written) for r in net.fetch(df, str(tmp_path), answer, interval=0.0, tasks=2).collect()}
    assert got == {("raw/1.txt", "downloaded", 3), ("raw/2.txt", "404", 0), ("x", "exists", 0), ("empty", "downloaded", 3)}
    assert (tmp_path / "raw/1.txt").read_bytes() == b"u/a" and not list(tmp_path.rglob("*.part"))
    with pytest.raises(OSError):
        net.fetch(df, str(tmp_path), answer, reserve=1 << 62)
    assert net.fetch(df.filter("false"), str(tmp_path), answer).count() == 0
    (tmp_path / "page").write_bytes(b"hello")
    assert net.UrlTransport()(f"file://{tmp_path}/page") == net.Response(200, b"hello")


def test_payloads_and_deletions(spark, tmp_path):
    df = spark.createDataFrame([("a/1.txt", b"one"), ("a/2.txt", None), (None, b"x")], "relpath string, content binary")
    assert [r[:2] for r in rows(writers.write_payloads(df, str(tmp_path)))] == [("a/1.txt", 3)]
    plan = spark.createDataFrame([("a/1.txt",), ("gone",), ("a",), (None,)], "relpath string")
    assert sorted(rows(writers.delete_files(plan, str(tmp_path))), key=str) == [("a", "dry_run", None), ("a/1.txt", "dry_run", 3), ("gone", "missing_before_delete", None)] and (tmp_path / "a/1.txt").exists()
    log = sorted(r[:2] for r in rows(writers.delete_files(plan, str(tmp_path), dry_run=False)))
    assert log == [("a", "delete_failed"), ("a", "delete_started"), ("a/1.txt", "delete_started"), ("a/1.txt", "deleted"), ("gone", "missing_before_delete")] and not (tmp_path / "a/1.txt").exists()
    for bad in ("/etc/x", "../x", "a/../../x"):
        with pytest.raises(Exception, match="not below"):
            writers.write_payloads(spark.createDataFrame([(bad, b"x")], "relpath string, content binary"), str(tmp_path)).collect()
    with pytest.raises(ValueError):
        writers.reset_stages(spark, str(tmp_path), ("../x",))


def test_exports_reports_and_parts(spark, tmp_path):
    df = spark.createDataFrame([("b", ' x, "q"\n'), ("a", None)], "k string, `v,w` string")
    writers.export_single(df.repartition(2), f"{tmp_path}/out.csv")
    writers.export_single(df.repartition(2), f"{tmp_path}/out.csv")
    assert Path(f"{tmp_path}/out.csv").read_text().startswith('k,"v,w"\n') and sorted(rows(readers.read_csv(spark, f"{tmp_path}/out.csv", "v,w"))) == [("a", None), ("b", ' x, "q"\n')]
    assert writers.report_json(df, "k").index('"a"') < writers.report_json(df, "k").index('"b"')
    (tmp_path / "p").mkdir()
    for n in ("part_2", "part_1"):
        (tmp_path / "p" / n).write_bytes(n.encode())
    assert rows(readers.part_names(spark, f"{tmp_path}/p")) == [("part_1", 6), ("part_2", 6)]
    last = readers.last_of(spark.createDataFrame([("x", 1, "a"), ("x", 2, None), (None, 3, "c")], "k string, n int, v string"), "k", "n")
    assert rows(last) == [("x", 2, None)]


def test_shards_and_totals(spark):
    files = spark.createDataFrame([(f"f{k:02d}", s) for k, s in enumerate([9, 9, 5, 4, 4, 1, None, 0])], "key string, bytes long").withColumn("turn_", F.lit(1))
    out = R.size_shards(files, 3, "key", "bytes")
    by = {r.shard: (r.n, r.b) for r in out.groupBy("shard").agg(F.count("*").alias("n"), F.sum("bytes").alias("b")).collect()}
    assert by == {0: (3, 10), 1: (3, 13), 2: (2, 9)} and out.count() == 8
    assert rows(R.shard_totals(out, "shard", "bytes")) == [(3, 32)] and R.size_shards(files.filter("false"), 3, "key", "bytes").count() == 0


def test_the_store_of_tables(spark, tmp_path):
    base = tables.create_tables(spark, str(tmp_path), "store_test")
    tables.create_tables(spark, str(tmp_path), "store_test")
    tables.save({"filing_items": spark.createDataFrame([("x", "f", 0)], "item_information string, filing_id string, ordinal int")}, base)
    assert rows(spark.table(f"{base}.filing_items")) == [("f", 0, "x")]
    spark.sql(f"DROP DATABASE {base} CASCADE")
