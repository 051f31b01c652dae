"""Sample matching target category proportions, from mergeable reservoirs.

Every item has a seeded hash as its priority. A reservoir of a cell (period, category) and group (company) holds the
``cap`` smallest priorities and the number of items seen; two reservoirs merge by keeping the smallest of both and adding the
numbers. One pass builds them per partition, before any shuffle; what is left (at most cap items per cell, group and partition) is
written, and a shuffle of it merges them. After the final counts each cell is trimmed uniformly to its feasible quota: the smallest
priorities, found by a histogram of priorities (``BINS`` bins per cell) and a ranking inside the one bin that is cut.

Quotas (:func:`fit`): the sample's places are dealt one by one: first the minima, all in proportion where they cannot all hold, then up
to the wanted numbers and, where categories are exhausted, on to the open ones, by highest averages of the target proportions.
So a sample never exceeds its size, and falls short of it only where every category with a share is exhausted.

Defined results: items with null key, category, group or year take no part; targets with null period or category are ignored, repeated
ones taken once; a null share, minimum or size is 0; a null cap is no cap: the reservoir is then the cell's, merged by the bins of the histogram,
so no company meets in one task. Periods may overlap (an item then stands in each); empty cells report available 0. An item of two
rows stands for two.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import stored

#: Bins of the priority histogram per cell.
BINS = 4096
#: Parts in which one company's reservoirs of all partitions are merged first.
MERGE_PARTS = 16
#: Rows a partition's reservoir gathers before it is trimmed again.
TRIM_ROWS = 200_000


def category_key(column: Column) -> Column:
    """Form types however spelled; an amendment (/A) stays another form."""
    return F.nullif(F.regexp_replace(F.upper(column), "[^A-Z0-9/]", ""), F.lit(""))


def seeded_priority(seed: int, item: Column) -> Column:
    """A number below 2**60 that sorts as if shuffled: the first 15 hex digits of an MD5."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), item.cast("string"))), 1, 15), 16, 10).cast("bigint")


def _trim(df: pd.DataFrame) -> pd.DataFrame:
    df = df.sort_values(["cell", "company", "priority", "item"], kind="stable")
    # An uncapped cell is one group, whatever the company.
    keys = [df["cell"], df["company"].where(df["capped"], "")]
    seen = df.groupby(keys, sort=False)["seen"].transform("sum").to_numpy()
    df = df.assign(seen=seen)
    order = df.sort_values(["priority", "item"], kind="stable")
    rank = order.groupby([order["cell"], order["company"].where(order["capped"], "")], sort=False).cumcount()
    rank = rank.reindex(df.index).to_numpy()
    # The first row of a reservoir carries its number of items.
    df = df.assign(seen=np.where(rank == 0, seen, 0))
    return df[rank < df["hold"].to_numpy()].reset_index(drop=True)


def _reservoirs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    kept: list[pd.DataFrame] = []
    rows, limit = 0, TRIM_ROWS
    for batch in batches:
        kept.append(batch)
        rows += len(batch)
        if rows > limit:
            kept = [_trim(pd.concat(kept, ignore_index=True))]
            rows = len(kept[0])
            limit = max(TRIM_ROWS, 2 * rows)  # what cannot be trimmed is not sorted again and again
    if kept:
        yield _trim(pd.concat(kept, ignore_index=True))


def _dealt(rest: int, units: list[tuple[int, int, float]], odd: bool) -> list[int]:
    """How many of ``rest`` places each entry (from, to, weight) gets of its units from+1..to, by smallest k/weight, or (2k-1)/weight if
    ``odd``; of equal ones the first entry's."""
    spans = [max(0, b - a) if w > 0 else 0 for a, b, w in units]
    if sum(spans) <= rest:
        return spans
    key = lambda k, w: (2 * k - 1) / w if odd else k / w

    def below(level: float) -> list[int]:
        """Units of each entry with a key up to the level."""
        out = []
        for (a, b, w), span in zip(units, spans):
            k = min(max(int((level * w + 1) / 2 if odd else level * w), a), b)
            while span and k < b and key(k + 1, w) <= level:
                k += 1
            while span and k > a and key(k, w) > level:
                k -= 1
            out.append(k - a if span else 0)
        return out

    lo, hi = 0.0, max(key(b, w) for (a, b, w), span in zip(units, spans) if span)
    while (mid := (lo + hi) / 2) not in (lo, hi):
        lo, hi = (mid, hi) if sum(below(mid)) <= rest else (lo, mid)
    got = below(lo)
    heap = [(key(a + n + 1, w), j) for j, ((a, b, w), n, span) in enumerate(zip(units, got, spans)) if n < span]
    heapq.heapify(heap)
    for _ in range(rest - sum(got)):
        _, j = heapq.heappop(heap)
        got[j] += 1
        a, _, w = units[j]
        if got[j] < spans[j]:
            heapq.heappush(heap, (key(a + got[j] + 1, w), j))
    return got


def fit(size: int, shares: list[int], least: list[int], wanted: list[int], available: list[int]) -> list[int]:
    """Feasible quotas of the categories of one sample: never more than there is of one, nor than ``size`` in all."""
    quota = [0] * len(shares)
    held = [min(m, n) for m, n in zip(least, available)]
    full = [min(max(w, h), n) for w, h, n in zip(wanted, held, available)]
    for upto, weights, odd in ((held, least, False), (full, shares, True), (available, shares, True)):
        more = _dealt(size - sum(quota), [(q, b, w) for q, b, w in zip(quota, upto, weights)], odd)
        quota = [q + m for q, m in zip(quota, more)]
    return quota


def target_cells(targets: DataFrame) -> DataFrame:
    """Per cell (period, category): wanted, the greater of the minimum and the share rounded up, and what else is asked of it."""
    real = targets.filter("period_label IS NOT NULL AND form_type IS NOT NULL")
    cells = real.groupBy("period_label", category_key(F.col("form_type")).alias("_category")).agg(
        F.min("form_type").alias("form_type"), F.max("first_year").alias("first_year"), F.max("last_year").alias("last_year"), F.coalesce(F.max("target_pct").cast("bigint"), F.lit(0)).alias("pct"),
        F.coalesce(F.max("min_rows").cast("bigint"), F.lit(0)).alias("least"), F.coalesce(F.max("sample_size").cast("bigint"), F.lit(0)).alias("sample_size"), F.max("company_cap").cast("bigint").alias("cap"),
    )
    up = F.floor((F.col("pct") * F.col("sample_size") + 99) / 100).cast("bigint")
    return cells.withColumn("wanted", F.greatest("least", up)).withColumn("cell", F.concat_ws("\x1f", "period_label", "_category"))


def _fitted(_key: tuple, period: pd.DataFrame) -> pd.DataFrame:
    period = period.sort_values("_category", ignore_index=True)
    columns = [period[c].astype("int64").tolist() for c in ("pct", "least", "wanted", "available")]
    return period[["cell"]].assign(quota=fit(int(period["sample_size"].max()), *columns))


def sample(items: DataFrame, targets: DataFrame, seed: int = 11, bins: int = BINS) -> tuple[DataFrame, DataFrame]:
    """(sample, report) of ``items`` (item, category, company, year), one row per item.

    sample: period_label, form_type, item, company. report: per cell wanted, quota, seen, available, sampled (counted in the sample), short
    (available < wanted: the category is exhausted) and unmet (how many of the wanted the sample lacks, for that or for want of places).
    """
    cells = target_cells(targets)
    real = items.select("item", "category", "company", "year").filter("item IS NOT NULL AND category IS NOT NULL AND company IS NOT NULL AND year IS NOT NULL")
    # The cells are a parameter table: below the broadcast threshold Catalyst ships them.
    inside = (F.col("_category") == F.col("category")) & F.col("year").between(F.col("first_year"), F.col("last_year"))
    placed = real.join(cells.select("cell", "_category", "first_year", "last_year", "cap", "sample_size"), inside).select(
        "cell", "company", F.col("item").cast("string").alias("item"), seeded_priority(seed, F.col("item")).alias("priority"), F.lit(1).cast("bigint").alias("seen"),
        F.col("cap").isNotNull().alias("capped"), F.greatest(F.least("cap", "sample_size"), F.lit(1)).alias("hold"),  # of one company no more can be drawn than the sample holds; one row carries the number
    )
    partial = stored(placed.mapInPandas(_reservoirs, placed.schema))
    # Merged in two steps: a company with items in every partition first meets in MERGE_PARTS parts.
    parts = Window.partitionBy("cell", "company", "_part").orderBy("priority", "item")
    some = partial.filter("capped").withColumn("_part", F.pmod(F.xxhash64("item", F.lit("part")), F.lit(MERGE_PARTS))).withColumn("_rank", F.row_number().over(parts)).filter(F.col("_rank") <= F.col("hold"))
    merged = some.withColumn("_rank", F.row_number().over(Window.partitionBy("cell", "company").orderBy("priority", "item"))).filter(F.col("_rank") <= F.col("hold"))
    held = ["cell", "company", "item", "priority"]
    capped = merged.select(*held).unionByName(partial.filter("NOT capped").select(*held)).withColumn("_bin", F.floor(F.col("priority") / 2.0**60 * bins).cast("int"))
    # What there is: of each company its items up to the cap.
    of_company = partial.filter("seen > 0").groupBy("cell", F.when(F.col("capped"), F.col("company")).alias("_group")).agg(F.sum("seen").alias("seen"))
    counts = of_company.join(cells.select("cell", "cap"), "cell").groupBy("cell").agg(F.sum("seen").alias("seen"), F.sum(F.least("seen", "cap")).alias("available"))
    counted = cells.join(counts, "cell", "left").na.fill(0, ["seen", "available"])
    # The few categories of one period meet in one group: numbers of a parameter table.
    quotas = counted.groupBy("period_label").applyInPandas(_fitted, "cell string, quota long")
    known = stored(counted.join(quotas, "cell"))
    histogram = capped.groupBy("cell", "_bin").agg(F.count("*").alias("_n"))
    along = Window.partitionBy("cell").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)  # at most BINS rows a cell
    firsts = histogram.withColumn("_first", F.coalesce(F.sum("_n").over(along), F.lit(0))).join(known.select("cell", "quota", "period_label", "form_type"), "cell").filter("_first < quota")
    # Whole bins below the cut, and the smallest priorities of the bin that is cut.
    ranked = capped.join(firsts, ["cell", "_bin"]).withColumn("_rank", F.row_number().over(Window.partitionBy("cell", "_bin").orderBy("priority", "item")))
    drawn = ranked.filter(F.col("_first") + F.col("_rank") <= F.col("quota"))
    # Cells and drawn items are counted together, so every report is one of a drawn sample.
    told = ["period_label", "form_type", "wanted", "quota", "seen", "available"]
    both = known.select("cell", *told, F.lit(0).alias("_drawn")).unionByName(drawn.select("cell", F.lit(1).alias("_drawn")), allowMissingColumns=True)
    report = both.groupBy("cell").agg(*(F.max(c).alias(c) for c in told), F.sum("_drawn").alias("sampled")).select(
        *told, "sampled", (F.col("available") < F.col("wanted")).alias("short"), F.greatest(F.col("wanted") - F.col("sampled"), F.lit(0)).alias("unmet")
    )
    return drawn.select("period_label", "form_type", "item", "company"), report
