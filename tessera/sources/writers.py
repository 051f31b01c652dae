"""Sinks. Spark's committers make each write atomic; nothing here touches its input but :func:`delete_files`, if told to."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Blanks around values belong to them.
CSV = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_manifest(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """CSV with header; refuses to replace what is there unless told to."""
    df.write.mode("overwrite" if overwrite else "errorifexists").csv(path, header=True, **CSV)


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").csv(path, header=True, **CSV)


def write_text_parts(df: DataFrame, path: str, overwrite: bool = True) -> None:
    """Compressed JSON lines."""
    df.write.mode("overwrite" if overwrite else "errorifexists").option("compression", "gzip").json(path)


def append_events(df: DataFrame, path: str) -> None:
    """JSON lines."""
    df.write.mode("append").json(path)


def write_table(df: DataFrame, path: str, partitions: tuple[str, ...] = ("form_type", "year")) -> None:
    """Parquet by form and year, so that scans of one form or year read nothing else."""
    df.repartition(*partitions).write.mode("overwrite").partitionBy(*partitions).parquet(path)


def export_single(df: DataFrame, path: str) -> None:
    """One CSV file with one header: the parts are written by all tasks and then appended in the order of their names, as a stream of
    bytes through the file system of the path, so neither a task nor the driver holds more than a block of them."""
    parts = f"{path}.parts"
    df.write.mode("overwrite").csv(parts, header=False, **CSV)
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    target, folder, done = (jvm.org.apache.hadoop.fs.Path(p) for p in (f"{path}.tmp", parts, path))
    fs = target.getFileSystem(conf)
    out = fs.create(target, True)
    try:
        out.write(bytearray((",".join(_quoted(c) for c in df.columns) + "\n").encode()))
        for name in sorted(s.getPath().getName() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-")):
            source = fs.open(jvm.org.apache.hadoop.fs.Path(f"{parts}/{name}"))
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, 1 << 20, False)
            source.close()
    finally:
        out.close()
    fs.delete(folder, True)
    fs.delete(done, True)
    fs.rename(target, done)


def _quoted(text: str) -> str:
    return '"' + text.replace('"', '""') + '"' if any(c in text for c in ',"\r\n') else text


def reset_stages(spark: SparkSession, root: str, stages: tuple[str, ...]) -> None:
    """Delete the outputs of the named stages below ``root``, nothing else; what is not there is passed over."""
    for stage in stages:
        if "/" in stage or stage in ("", ".", ".."):
            raise ValueError(f"{stage!r} is no stage")
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{stage}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def write_payloads(files: DataFrame, root: str) -> DataFrame:
    """Write (relpath, content) as files below ``root``, each under another name first and then renamed; (relpath, size_bytes, sha256).

    The result is written by an action on it; a task that is run again replaces the same files. Null contents write none. Paths that are
    absolute or hold ``..`` raise an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _file_system(root)
        for batch in batches:
            rows = []
            for name, data in zip(*(c.to_pylist() for c in batch.columns)):
                if name is None or data is None:
                    continue
                path = _below(base, name)
                fs.create_dir(path.rpartition("/")[0], recursive=True)
                part = f"{path}.{uuid.uuid4().hex}.part"
                with fs.open_output_stream(part) as f:
                    f.write(data)
                fs.move(part, path)
                rows.append((name, len(data), hashlib.sha256(data).hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 3, (pa.string(), pa.int64(), pa.string()))], ["relpath", "size_bytes", "sha256"])

    return files.select("relpath", F.col("content").cast("binary").alias("content")).mapInArrow(run, "relpath string, size_bytes long, sha256 string")


def delete_files(plan: DataFrame, root: str, dry_run: bool = True) -> DataFrame:
    """Delete the files of ``plan`` (relpath) below ``root``: (relpath, status, size_bytes) of every step, as a log keeps it.

    status is dry_run, or missing_before_delete, or delete_started followed by deleted or delete_failed. Files go with an action on the
    result: write it to the log once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _file_system(root)
        for batch in batches:
            rows = []
            for name in batch.column(0).to_pylist():
                path = _below(base, name)
                info = fs.get_file_info(path)
                if info.type == pa.fs.FileType.NotFound:
                    rows.append((name, "missing_before_delete", None))
                    continue
                size = info.size if info.type == pa.fs.FileType.File else None
                if dry_run:
                    rows.append((name, "dry_run", size))
                    continue
                rows.append((name, "delete_started", size))
                try:
                    fs.delete_file(path)
                    rows.append((name, "deleted", size))
                except OSError:
                    rows.append((name, "delete_failed", size))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 3, (pa.string(), pa.string(), pa.int64()))], ["relpath", "status", "size_bytes"])

    return plan.filter("relpath IS NOT NULL").select("relpath").mapInArrow(run, "relpath string, status string, size_bytes long")


def _file_system(root: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a path or URI, on an executor."""
    return pa.fs.FileSystem.from_uri(root if ":" in root.partition("/")[0] else f"file://{root}")


def _below(base: str, name: str) -> str:
    if name.startswith("/") or ".." in name.split("/") or "\\" in name:
        raise ValueError(f"{name!r} is not below the folder")
    return f"{base.rstrip('/')}/{name}"


def report_json(df: DataFrame, *order: str, limit: int = 10_000) -> str:
    """A small report (at most ``limit`` rows) as JSON text, its rows in ``order`` (else in that of all columns)."""
    rows = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("j"), *df.columns).orderBy(*(order or df.columns)).select("j").limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"a report of over {limit} rows is a table")
    return json.dumps([json.loads(r[0]) for r in rows], indent=2)
