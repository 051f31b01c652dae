from test_submission import HEADER, doc

from tessera.streaming import incremental


def folder(root, names):
    (root / "2020" / "8-K").mkdir(parents=True, exist_ok=True)
    for n in names:
        (root / "2020" / "8-K" / f"{n}.txt").write_bytes(HEADER + doc(f"{n}\n".encode()))
    return str(root)


def test_a_batch_of_small_files_takes_few_tasks(spark, tmp_path):
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", "16m")
    raw, out, before = folder(tmp_path / "raw", range(64)), tmp_path / "out", own.conf.getAll
    incremental.stream_submissions(own, raw, str(out), str(tmp_path / "cp"), 50).awaitTermination()
    parts = {b.name: len(list(b.glob("part-*"))) for b in out.iterdir()}
    assert set(parts) == {"batch_id=0", "batch_id=1"} and max(parts.values()) <= own.sparkContext.defaultParallelism
    assert own.conf.getAll == before and incremental.current_state(own, str(out)).count() == 64


def test_streams_of_several_folders_share_what_they_write(spark, tmp_path):
    out = str(tmp_path / "out")
    start = lambda k: incremental.stream_submissions(spark, str(tmp_path / k), out, str(tmp_path / "cp" / k), 2, f"{k}_", 1)
    for names in (range(5), range(7)):
        for k in ("a", "b"):
            folder(tmp_path / k, [f"{k}{n}" for n in names if n >= 5 or len(names) == 5])
        incremental.await_all([start("a"), start("b")])
    batches = sorted(p.name for p in (tmp_path / "out").iterdir())
    assert batches == [f"batch_id={k}_{n}" for k in "ab" for n in range(4)]  # 2, 2, 1, then 2: none is read twice
    state = incremental.current_state(spark, out)
    assert sorted(r.source_relpath for r in state.collect()) == sorted(f"2020/8-K/{k}{n}.txt" for k in "ab" for n in range(7))
