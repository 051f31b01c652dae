"""Filters, memberships and aggregates over manifests and document tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.scalars import cik_any, cik_loose, cik_of_file, form_key, year_between

CIK_ALIASES = ("cik", "padded_cik", "sec_cik", "issuer_cik")


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    if missing := sorted(set(names) - set(df.columns)):
        raise ValueError(f"missing columns: {missing}")
    return df


def cik_column(df: DataFrame, aliases: tuple[str, ...] = CIK_ALIASES) -> str:
    """The first alias that is a column, whatever its case."""
    by_lower = {c.lower(): c for c in df.columns}
    for name in aliases:
        if name in by_lower:
            return by_lower[name]
    raise ValueError(f"none of {aliases} in {df.columns}")


def universe(*sources: DataFrame) -> DataFrame:
    """Distinct normalised company numbers of all sources (partial distinct before the shuffle)."""
    keys = [s.select(cik_any(F.col(f"`{cik_column(s)}`")).alias("cik")) for s in sources]
    out = keys[0]
    for k in keys[1:]:
        out = out.unionByName(k)
    return out.filter("cik <> ''").distinct()


def wanted_form(form: Column, forms: list[str], prefixes: tuple[str, ...] = ()) -> Column:
    f = form_key(form)
    test = f.isin(*forms)
    for p in prefixes:
        test = test | f.startswith(p)
    return test


def in_universe(df: DataFrame, keys: DataFrame, cik: Column, flag: str = "in_universe") -> DataFrame:
    """``df`` with 1 where its company is known, else 0. The right side is distinct, so no row doubles and a hot company
    is joined where it stands if the universe is under the broadcast threshold, else by AQE's skew join."""
    known = keys.select(F.col("cik").alias("_known")).distinct()
    return df.withColumn("_key", cik).join(known, F.col("_key") == F.col("_known"), "left").withColumn(flag, F.col("_known").isNotNull().cast("int")).drop("_key", "_known")


def manifest_reasons(manifest: DataFrame, keys: DataFrame, forms: list[str], years: tuple[int, int] | None = None) -> DataFrame:
    """Each row with ``reason``: form, year, cik or kept, in that order, in one pass. Without ``years`` the form is written in its normal way,
    with it the row stays as it is."""
    flagged = in_universe(manifest, keys, cik_loose(F.col("cik")), "_in")
    reason = F.when(~wanted_form(F.col("form_type"), forms), "form")
    if years:
        reason = reason.when(~year_between(F.col("date_filed"), *years), "year")
    told = flagged.withColumn("reason", reason.when(F.col("_in") == 0, "cik").otherwise("kept")).drop("_in")
    return told if years else told.withColumn("form_type", form_key(F.col("form_type")))


def reason_counts(reasons: DataFrame) -> DataFrame:
    return reasons.groupBy("reason").agg(F.count("*").alias("n"))


def purge_candidates(files: DataFrame, keys: DataFrame) -> DataFrame:
    """Files (year, file_name, size_bytes) with class unclassified, allowed or undesired."""
    flagged = in_universe(files, keys, cik_of_file(F.col("file_name")), "_in")
    return flagged.withColumn("class", F.when(cik_of_file(F.col("file_name")) == "", "unclassified").when(F.col("_in") == 1, "allowed").otherwise("undesired")).drop("_in")


def purge_report(classified: DataFrame, log: DataFrame | None = None) -> DataFrame:
    """Per year and in total (year null): files scanned, allowed, left untouched, undesired and their bytes, and what the log of
    deletions (year, status, size_bytes) tells: files and bytes deleted, failures."""
    bad = F.col("class") == "undesired"
    gone, failed = F.col("status") == "deleted", F.col("status").isin("missing_before_delete", "delete_failed")
    total = lambda test, what: F.coalesce(F.sum(F.when(test, F.col(what))), F.lit(0)).cast("bigint")
    rows = classified.select("year", "class", "size_bytes", F.lit(None).cast("string").alias("status"))
    if log is not None:
        rows = rows.unionByName(log.select("year", F.lit(None).cast("string").alias("class"), "size_bytes", "status"))
    return rows.rollup("year").agg(
        F.count("class").alias("filing_files_scanned"), F.count_if(F.col("class") == "allowed").alias("allowed_cik_files"), F.count_if(F.col("class") == "unclassified").alias("unclassified_files_left_untouched"),
        F.count_if(bad).alias("undesired_files"), total(bad, "size_bytes").alias("undesired_bytes"), F.count_if(gone).alias("deleted_files"), total(gone, "size_bytes").alias("deleted_bytes"), F.count_if(failed).alias("delete_failures"),
    )


def deletion_plan(classified: DataFrame, delete: bool = False) -> DataFrame:
    """What a purge would do, as a relation; nothing is deleted here."""
    return classified.filter("class = 'undesired'").withColumn("action", F.lit("delete" if delete else "dry_run"))


def permanent_failures(log: DataFrame) -> DataFrame:
    """URLs whose download failed for good."""
    return log.filter(F.col("status").isin("404", "410") & (F.trim("filing_url") != "")).select(F.trim("filing_url").alias("filing_url")).distinct()


def prescan(manifest: DataFrame, failures: DataFrame, existing: DataFrame) -> DataFrame:
    """Each manifest row as permanent, existing, zero_byte or pending; ``existing`` has output_path and size_bytes (one row per path)."""
    gone = failures.select(F.col("filing_url").alias("_gone")).distinct()
    there = existing.groupBy(F.col("output_path").alias("_path")).agg(F.max("size_bytes").alias("_size"))
    j = manifest.join(gone, F.trim("filing_url") == F.col("_gone"), "left").join(there, F.col("output_path") == F.col("_path"), "left")
    state = F.when(F.col("_gone").isNotNull(), "permanent").when(F.col("_size") > 0, "existing").when(F.col("_size") == 0, "zero_byte").otherwise("pending")
    return j.withColumn("state", state).withColumnRenamed("_size", "existing_bytes").drop("_gone", "_path")


def prescan_summary(scanned: DataFrame) -> DataFrame:
    """Counts per state and the bytes still to come, estimated from the mean size of all existing files."""
    pending = F.count_if(F.col("state").isin("pending", "zero_byte"))
    mean = F.avg(F.when(F.col("state") == "existing", F.col("existing_bytes")))
    return scanned.agg(
        F.count("*").alias("total_rows"), F.count_if(F.col("state") == "existing").alias("skip_existing"), F.count_if(F.col("state") == "permanent").alias("skip_permanent"),
        pending.alias("pending"), F.count_if(F.col("state") == "zero_byte").alias("zero_byte_existing"), F.floor(mean * pending).cast("bigint").alias("estimated_required_bytes"),
    )


def pending(left: DataFrame, done: DataFrame, on: list[str]) -> DataFrame:
    """Rows not done yet."""
    return left.join(done.select(*on).distinct(), on, "left_anti")


def needs_work(files: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Files whose size or modification time differ from the snapshot, or that it does not have."""
    same = ["source_relpath", "source_size_bytes", "source_mtime_ns"]
    return files.join(snapshot.select(*same), same, "left_anti")


def coverage(docs: DataFrame) -> DataFrame:
    """Documents per year, per year and form, and per year and company, from one scan; ``level`` tells which."""
    sets = docs.groupingSets([["year"], ["year", "form_type"], ["year", "cik"]], "year", "form_type", "cik").agg(F.count("*").alias("doc_count"), F.grouping("form_type").alias("_f"), F.grouping("cik").alias("_c"))
    level = F.when(F.col("_f") == 0, "year_form").when(F.col("_c") == 0, "year_company").otherwise("year")
    return sets.select(level.alias("level"), "year", "form_type", "cik", "doc_count")


def duplicate_keys(docs: DataFrame) -> DataFrame:
    """(cik, accession) that occur more than once; empty accessions do not count."""
    return docs.filter("accession <> ''").groupBy("cik", "accession").agg(F.count("*").alias("n")).filter("n > 1")


def length_stats(docs: DataFrame, group: str = "form_type", size: str = "n_words") -> DataFrame:
    """Count, mean and upper median per group.

    The median comes from the counts of distinct sizes and a running sum over them, so no group's values are gathered: a task
    holds one row per distinct size.
    """
    counts = docs.filter(F.col(size).isNotNull()).groupBy(group, size).agg(F.count("*").alias("_n"))
    w = Window.partitionBy(group)
    upto = counts.withColumn("_upto", F.sum("_n").over(w.orderBy(size).rowsBetween(Window.unboundedPreceding, 0))).withColumn("_all", F.sum("_n").over(w))
    middle = F.min(F.when(F.col("_upto") > F.floor(F.col("_all") / 2), F.col(size)))
    return upto.groupBy(group).agg(F.sum("_n").alias("docs"), (F.sum(F.col(size) * F.col("_n")) / F.sum("_n")).alias("avg_size"), middle.alias("median_size"))


def presence_histogram(sections: DataFrame, doc: str = "doc_id", name: str = "section_name") -> DataFrame:
    """How many documents have how many different sections."""
    per = sections.groupBy(doc).agg(F.countDistinct(name).alias("n_sections"))
    return per.groupBy("n_sections").agg(F.count("*").alias("doc_count"))


def weakest_year(year_counts: DataFrame, at_least: int, override: int | None = None) -> DataFrame:
    """The usable year with the fewest documents (the earliest of equals) and the target per year it sets."""
    usable = year_counts.filter(F.col("doc_count") >= at_least)
    target = F.least(F.col("doc_count"), F.lit(override)) if override else F.col("doc_count")
    return usable.orderBy("doc_count", "year").limit(1).select("year", "doc_count", target.alias("target_per_year"))


def weak_years(year_counts: DataFrame, target: DataFrame, most: int = 0) -> DataFrame:
    """Years under the target (a table of one row and column) and what they lack, capped if ``most`` is positive."""
    aim = target.select(target.columns[0]).limit(1).scalar()  # a subquery of one number
    lack = aim - F.col("doc_count")
    return year_counts.filter(F.col("doc_count") < aim).select("year", "doc_count", (F.least(lack, F.lit(most)) if most > 0 else lack).cast("bigint").alias("deficit"))


def years_covered(docs: DataFrame) -> DataFrame:
    """One row: the sorted distinct years."""
    return docs.filter("year IS NOT NULL").select("year").distinct().agg(F.array_sort(F.collect_list("year")).alias("years"))


def form_stats(docs: DataFrame, forms: tuple[str, ...], size: str = "n_words") -> DataFrame:
    """:func:`length_stats` of the given forms, with zeros for forms that have no document."""
    wanted = docs.sparkSession.createDataFrame([(f,) for f in forms], "form_type string")
    return wanted.join(length_stats(docs, "form_type", size), "form_type", "left").na.fill(0, ["docs", "avg_size", "median_size"])


def shard_totals(results: DataFrame, shard: str, *measures: str) -> DataFrame:
    """Sums of the measures over the shards' results, and how many shards there are."""
    return results.agg(F.count_distinct(shard).alias("shards"), *(F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures))


def size_shards(files: DataFrame, shards: int, key: str, size: str) -> DataFrame:
    """``files`` with shard and turn: the largest first, dealt out to and fro, so that the shards' sizes differ by no more than one file.

    Ranks are needed over the whole inventory (one row a file): they come from counts of the distinct sizes, so no task sorts all files.
    """
    counts = files.groupBy(F.coalesce(F.col(size), F.lit(0)).alias("_s")).agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy(F.desc("_s")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))  # one row per distinct size
    within = files.withColumn("_s", F.coalesce(F.col(size), F.lit(0))).withColumn("_in", F.row_number().over(Window.partitionBy("_s").orderBy(key)))
    place = F.col("_before") + F.col("_in") - 1
    turn = F.floor(place / shards)
    shard = F.when(turn % 2 == 0, place % shards).otherwise(shards - 1 - place % shards)
    return within.join(before.select("_s", "_before"), "_s").select(*files.columns, shard.cast("int").alias("shard"), turn.cast("bigint").alias("turn"))


def status_report(**counted: DataFrame) -> DataFrame:
    """(stage, status, n) over the status columns of several tables."""
    parts = [df.groupBy(F.lit(stage).alias("stage"), "status").agg(F.count("*").alias("n")) for stage, df in counted.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def first_by(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key by ``order``; blank keys dropped. An aggregation with partial combining, not a window."""
    rest = [c for c in df.columns if c != key]
    best = F.min_by(F.struct(*rest), F.struct(*order)).alias("_r")
    return df.filter(F.coalesce(F.trim(key), F.lit("")) != "").groupBy(key).agg(best).select(key, *(F.col(f"_r.{c}").alias(c) for c in rest))


