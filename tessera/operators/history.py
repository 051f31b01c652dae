"""History of changing entity attributes, kept by affected-chain rebuild.

A chain is one entity's versions of one attribute. Raw changes are kept beside the chains. A batch of late or
corrected changes touches some entities: only their raw changes are rebuilt into intervals, and their chains are replaced
in one step, by a new version of the manifest. A reader sees the chains before or after, never a mixture, and a writer that dies
leaves the old state. Of two writers that began from the same version one fails (:class:`Conflict`) and applies its batch again.

A raw change is (entity, attribute, at, source, value, ends). ``source`` names the statement (a filing, a row of a register): a later
batch that has the same (entity, attribute, source) corrects it, in date and value; a null value or date takes it back. ``ends``
is false for a snapshot (the value was held on that day), true where the value was given up on that day (a former name), and null for a
snapshot of an attribute whose changes are dated by the latter only. An attribute is of one kind: snapshots, or dated changes.

Defined results: changes with null entity or attribute take no part, those with null date or value only take back what their
source said before; a null source is one statement of its own, never corrected; within a batch a source may say several things, all of
which count. A value equal to the one before starts no version, one that returns later does, also on the same day (changes of one day
are ordered by source, then value); repeated changes count once. Dated chains have one version before each date on which a value ended (of
several values the smallest) and one after the last, which shows the value of the last snapshot; without such a date they have one version.

Hot entities: exact repeats are dropped before a batch is written, a bucket they fill is split over tasks, corrections are told by a shuffle by source, and runs of equal values of one
day by a shuffle by day, before a chain meets in one task. So a chain's task has at most as many rows as there are days and changes of
value a day, however many sources tell them.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

KEYS = ["entity", "attribute"]
CHANGE_COLUMNS = [*KEYS, "at", "source", "value", "ends"]
CHAIN_COLUMNS = [*KEYS, "version", "valid_from", "valid_to", "value"]
#: Raw batches of a bucket that are merged into one when the next comes.
MERGE_BATCHES = 8


class Conflict(RuntimeError):
    """Another writer committed first; nothing of this batch is in force."""


def _snapshot_chains(raw: DataFrame) -> DataFrame:
    day = Window.partitionBy(*KEYS, "at").orderBy("source", "value")
    runs = raw.withColumn("_previous", F.lag("value").over(day)).filter("_previous IS NULL OR _previous <> value").drop("_previous")
    order = Window.partitionBy(*KEYS).orderBy("at", "source", "value")
    starts = runs.withColumn("_before", F.lag("value").over(order)).filter("_before IS NULL OR _before <> value")
    return starts.select(*KEYS, F.row_number().over(order).alias("version"), F.col("at").alias("valid_from"), F.lead("at").over(order).alias("valid_to"), "value")


def _dated_chains(raw: DataFrame) -> DataFrame:
    ended = raw.filter("ends").groupBy(*KEYS, "at").agg(F.min("value").alias("value"))
    last = raw.filter("ends IS NULL").groupBy(*KEYS).agg(F.max(F.struct("at", "source", "value")).alias("_last")).select(*KEYS, F.col("_last.value").alias("_now"))
    by_date = Window.partitionBy(*KEYS).orderBy("at")
    in_order = ended.withColumn("_next", F.lead("at").over(by_date)).withColumn("valid_from", F.lag("at").over(by_date)).withColumn("version", F.row_number().over(by_date))
    both = in_order.join(last, KEYS, "full")
    old = F.struct("version", "valid_from", F.col("at").alias("valid_to"), "value")
    now = F.struct((F.coalesce("version", F.lit(0)) + 1).alias("version"), F.col("at").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"), F.col("_now").alias("value"))
    versions = F.when(F.col("at").isNull(), F.array(now)).when(F.col("_next").isNull(), F.array(old, now)).otherwise(F.array(old))
    return both.select(*KEYS, F.explode(versions).alias("v")).select(*KEYS, "v.*")


def build_chains(changes: DataFrame) -> DataFrame:
    """(entity, attribute, version, valid_from, valid_to, value): the versions of all chains of uncorrected changes.

    ``valid_to`` is exclusive and null for the version in force; ``valid_from`` is null where a first version's begin is unknown.
    """
    real = changes.select(*CHANGE_COLUMNS).filter("entity IS NOT NULL AND attribute IS NOT NULL AND at IS NOT NULL AND value IS NOT NULL")
    return _snapshot_chains(real.filter("NOT ends")).unionByName(_dated_chains(real.filter("ends IS NULL OR ends")))


def standing(raw: DataFrame, batch: str = "batch") -> DataFrame:
    """The raw changes that no later batch corrects: per (entity, attribute, source) those of its last batch."""
    of_source = Window.partitionBy(*KEYS, "source")
    named = raw.filter("source IS NOT NULL").withColumn("_latest", F.max(batch).over(of_source)).filter(F.col(batch) == F.col("_latest")).drop("_latest")
    return named.unionByName(raw.filter("source IS NULL"))


class HistoryStore:
    """Chains and raw changes in a folder that all executors share.

    Layout: ``raw/<files>/bucket=k`` and ``chains/<files>/bucket=k``, entities hashed to ``buckets``; ``manifest/<n>.json`` is version n
    of the state: the raw files and the chain files of each bucket. A bucket is the unit of files that is replaced; within it only
    the chains of touched entities are rebuilt. Replaced files stay, for readers of older versions, until :meth:`vacuum`.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        #: As many as a shuffle has partitions: a bucket is then what one task writes. Fixed by the first batch.
        self.buckets = buckets or max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))

    # The manifest is a few bytes per bucket, read and written through Hadoop's file system of the path.
    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, path: str) -> list[str]:
        p, fs = self._fs(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def manifest(self) -> dict:
        """The latest state: version, buckets, batches (how many were applied), raw and chains by bucket."""
        versions = [n for n in self._names(f"{self.path}/manifest") if n.endswith(".json")]
        if not versions:
            return {"version": 0, "buckets": self.buckets, "batches": 0, "raw": {}, "chains": {}}
        p, fs = self._fs(f"{self.path}/manifest/{versions[-1]}")
        stream = fs.open(p)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, state: dict) -> None:
        """Version n+1 is renamed into place, which fails where it exists: the compare of optimistic concurrency."""
        tmp, fs = self._fs(f"{self.path}/manifest/{uuid.uuid4().hex}.tmp")
        stream = fs.create(tmp, True)
        stream.write(bytearray(json.dumps(state).encode()))
        stream.close()
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        context = hadoop.FileContext.getFileContext(tmp.toUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(tmp, self._fs(f"{self.path}/manifest/{state['version']:012d}.json")[0], self.spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0))
        except Py4JJavaError as e:
            fs.delete(tmp, False)
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                raise Conflict(f"version {state['version']} of {self.path} is taken") from None
            raise

    def _bucketed(self, df: DataFrame) -> DataFrame:
        return df.withColumn("bucket", F.pmod(F.xxhash64("entity"), F.lit(self.buckets)).cast("int"))

    def _write(self, df: DataFrame, kind: str) -> str:
        """Files per bucket, returns the folder's name. Small buckets share a task, a large one is split; rows are sorted by entity,
        so that the statistics of row groups tell them apart."""
        name = uuid.uuid4().hex
        df.hint("rebalance", "bucket").sortWithinPartitions("bucket", "entity").write.partitionBy("bucket").parquet(f"{self.path}/{kind}/{name}")
        return name

    def _hit(self, kind: str, name: str) -> list[str]:
        """The buckets a folder has files of."""
        return [n.removeprefix("bucket=") for n in self._names(f"{self.path}/{kind}/{name}") if n.startswith("bucket=")]

    def _read(self, kind: str, names: dict[str, list[str]]) -> DataFrame | None:
        """One scan of the folders of each bucket (bucket to names); null where there are none."""
        paths = sorted(f"{self.path}/{kind}/{n}/bucket={k}" for k, ns in names.items() for n in ns)
        if not paths:
            return None
        schema = "entity string, attribute string, at date, source string, value string, ends boolean, batch int" if kind == "raw" else "entity string, attribute string, version int, valid_from date, valid_to date, value string"
        return self.spark.read.schema(schema).parquet(*paths)

    def apply(self, changes: DataFrame) -> None:
        """Add a batch of raw changes and replace the chains of the entities it touches."""
        state = self.manifest()
        self.buckets = state["buckets"]
        number = state["batches"] + 1
        known = changes.select(*CHANGE_COLUMNS).filter("entity IS NOT NULL AND attribute IS NOT NULL").distinct()
        batch = self._write(self._bucketed(known.withColumn("batch", F.lit(number))), "raw")
        hit = self._hit("raw", batch)
        if not hit:
            return
        before = {k: state["raw"][k] for k in hit if k in state["raw"]}
        raw = {k: [*before.get(k, []), batch] for k in hit}
        if not before:
            chains = build_chains(self._read("raw", raw))
        else:
            touched = self._read("raw", {k: [batch] for k in hit}).select("entity").distinct()
            affected = self._read("raw", raw).join(touched, "entity", "left_semi")
            chains = build_chains(standing(affected))
            kept = self._read("chains", {k: [state["chains"][k]] for k in hit if k in state["chains"]})
            if kept is not None:
                chains = kept.join(touched, "entity", "left_anti").unionByName(chains)
        replaced = self._write(self._bucketed(chains.select(*CHAIN_COLUMNS)), "chains")
        full = {k: names for k, names in raw.items() if len(names) > MERGE_BATCHES}
        if full:
            merged = self._write(self._bucketed(standing(self._read("raw", full)).filter("at IS NOT NULL AND value IS NOT NULL")), "raw")
            there = set(self._hit("raw", merged))
            raw |= {k: [merged] if k in there else [] for k in full}
        there = set(self._hit("chains", replaced))  # a bucket whose changes were all taken back has no chains
        now = {k: v for k, v in state["chains"].items() if k not in hit} | {k: replaced for k in hit if k in there}
        self._commit({"version": state["version"] + 1, "buckets": self.buckets, "batches": number, "raw": state["raw"] | raw, "chains": now})

    def chains(self) -> DataFrame:
        """The chains in force."""
        df = self._read("chains", {k: [n] for k, n in self.manifest()["chains"].items()})
        if df is None:
            return self.spark.createDataFrame([], "entity string, attribute string, version int, valid_from date, valid_to date, value string")
        return df

    def vacuum(self) -> None:
        """Delete files and manifests that the latest version does not need. No writer or reader of older versions may be at work."""
        state = self.manifest()
        live = {"raw": {n for ns in state["raw"].values() for n in ns}, "chains": set(state["chains"].values()), "manifest": {f"{state['version']:012d}.json"}}
        for kind, names in live.items():
            for n in self._names(f"{self.path}/{kind}"):
                if n not in names:
                    p, fs = self._fs(f"{self.path}/{kind}/{n}")
                    fs.delete(p, True)
