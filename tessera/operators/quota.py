"""Quotas per form and reproducible sampling.

Ranks are needed in groups that may hold a third of all rows (a year's form, one company). No such group is sorted in one
task: :func:`hashed_rank` splits the seeded order of a group into bins, sums up their counts, and numbers rows only inside
a bin.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.scalars import FORM_ORDER, FORM_WEIGHTS, cik_any, form_key, seeded_order, strip
from tessera.operators.relational import first_by
from tessera.session import stored

#: A group's order is cut into so many bins: 16 to the power of the leading hex digits of its hash.
BIN_DIGITS = 2


def parse_weights(text: str | None, defaults: dict[str, float] = FORM_WEIGHTS) -> dict[str, float]:
    """``"10-K=0.5,8-K=0.5"`` over the defaults; unknown forms are ignored; the sum is made 1."""
    weights = dict(defaults)
    for part in (text or "").split(","):
        name, sep, value = part.partition("=")
        name = name.strip().upper().replace("_", " ")
        if sep and name in weights:
            weights[name] = float(value)
    total = sum(weights.values())
    if total <= 0:
        raise ValueError("form weights must have a positive sum")
    return {f: w / total for f, w in weights.items()}


def allocate(available: DataFrame, weights: dict[str, float], forms: tuple[str, ...] = FORM_ORDER) -> DataFrame:
    """(year, target, form_type, available) to the quota of each form.

    Each form first gets its rounded share (half to even) or what there is; what is missing to the target goes one by one to the
    forms in turn, the heaviest and fullest first. Turns are counted, not played: a form with s spare rows takes one
    in each of the first s turns, so what it has got after any number of turns is known.
    Rounded shares may add up to more than the target; they are not trimmed.
    """
    w = F.create_map(*(x for f in forms for x in (F.lit(f), F.lit(weights[f]))))
    place = F.create_map(*(x for k, f in enumerate(forms) for x in (F.lit(f), F.lit(k))))
    own = available.filter(F.col("form_type").isin(*forms)).withColumn("weight", w[F.col("form_type")]).withColumn("_order", place[F.col("form_type")])
    first = own.withColumn("_take", F.least(F.bround(F.col("target") * F.col("weight")).cast("bigint"), F.col("available")))
    year = Window.partitionBy("year")  # the few forms of one year
    turn = F.row_number().over(year.orderBy(F.desc("weight"), F.desc("available"), "_order"))
    spare = first.withColumn("_spare", F.col("available") - F.col("_take")).withColumn("_turn", turn).withColumn("_missing", F.greatest(F.col("target") - F.sum("_take").over(year), F.lit(0)))
    # Full turns played before the missing rows run out: the largest t with sum(least(spare, t)) <= missing.
    gathered = spare.withColumn("_spares", F.collect_list("_spare").over(year))
    after = lambda t: F.aggregate("_spares", F.lit(0).cast("bigint"), lambda acc, s: acc + F.least(s, t))
    # Candidates are the spares themselves and the level inside the segment that is cut.
    level = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0).cast("bigint")), F.col("_spares"))))
    below = F.array_max(F.filter(level, lambda t: after(t) <= F.col("_missing")))
    more = F.size(F.filter("_spares", lambda s: s > F.col("_below"))).cast("bigint")
    played = gathered.withColumn("_below", below).withColumn("_more", more)
    left = F.col("_missing") - after(F.col("_below"))
    turns = F.when(F.col("_more") > 0, F.floor(left / F.col("_more"))).otherwise(0).cast("bigint")
    rest = F.when(F.col("_more") > 0, left % F.col("_more")).otherwise(0)
    open_ = (F.col("_spare") > F.col("_below") + F.col("_turns")).cast("bigint")
    done = played.withColumn("_turns", turns).withColumn("_rest", rest).withColumn("_open", open_)
    ahead = F.sum("_open").over(year.orderBy("_turn").rowsBetween(Window.unboundedPreceding, 0))
    extra = F.least(F.col("_spare"), F.col("_below") + F.col("_turns")) + F.when((F.col("_open") == 1) & (F.col("_ahead") <= F.col("_rest")), 1).otherwise(0)
    return done.withColumn("_ahead", ahead).select("year", "target", "form_type", "available", (F.col("_take") + extra).cast("bigint").alias("quota"))


def hashed_rank(df: DataFrame, keys: list[str], mark: Column, tie: list[str], out: str = "rank") -> DataFrame:
    """``df`` with the position (from 1) of each row within ``keys`` in the order of ``mark`` (hex text), then ``tie``."""
    cols = df.columns
    binned = df.withColumn("_mark", mark).withColumn("_bin", F.substring("_mark", 1, BIN_DIGITS))
    counts = binned.groupBy(*keys, "_bin").agg(F.count("*").alias("_n"))
    # At most 16 ** BIN_DIGITS rows per group.
    along = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select(*(F.col(k).alias(f"_k{j}") for j, k in enumerate(keys)), F.col("_bin").alias("_b"), F.coalesce(F.sum("_n").over(along), F.lit(0)).alias("_first"))
    inside = binned.withColumn("_in", F.row_number().over(Window.partitionBy(*keys, "_bin").orderBy("_mark", *tie)))
    same = [F.col(k).eqNullSafe(F.col(f"_k{j}")) for j, k in enumerate(keys)]
    return inside.join(firsts, [*same, F.col("_bin") == F.col("_b")]).select(*cols, (F.col("_first") + F.col("_in")).cast("bigint").alias(out))


def cap_per_company(docs: DataFrame, cap: int, seed: int, key: str = "doc_id") -> DataFrame:
    """At most ``cap`` random documents per (year, form_type, cik).

    ``rank <= literal`` on a window is cut down in each partition before the shuffle (window group limit), so a company
    with a third of all rows sends ``cap`` rows per partition.
    """
    w = Window.partitionBy("year", "form_type", "cik").orderBy(seeded_order(seed, F.col(key)), key)
    return docs.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= cap).drop("_rank")


def draw(docs: DataFrame, quotas: DataFrame, seed: int, key: str = "doc_id") -> DataFrame:
    """A random sample of ``quota`` documents per (year, form_type)."""
    ranked = hashed_rank(docs, ["year", "form_type"], seeded_order(seed, F.col(key)), [key], "_rank")
    return ranked.join(quotas.select("year", "form_type", "quota"), ["year", "form_type"]).filter(F.col("_rank") <= F.col("quota")).drop("_rank", "quota")


def balanced(docs: DataFrame, targets: DataFrame, weights: dict[str, float], cap: int, seed: int, key: str = "doc_id") -> DataFrame:
    """The balanced set: quotas from what there is per year and form, the cap per company, then the draw.

    The quotas use uncapped availability, so a year may fall short after the cap. ``targets`` has year and target.
    """
    have = docs.groupBy("year", "form_type").agg(F.count("*").alias("available"))
    quotas = allocate(have.join(targets, "year"), weights)
    return draw(cap_per_company(docs, cap, seed, key), quotas, seed + 1, key)


def round_robin(rows: DataFrame, quotas: DataFrame, keys: list[str], seed: int, key: str) -> DataFrame:
    """Up to ``quota`` rows per ``keys``, one per company in turn: companies and their rows in seeded order."""
    own = stored(hashed_rank(rows, [*keys, "cik"], seeded_order(seed, F.col(key)), [key], "turn"))
    company = seeded_order(seed, F.col("cik"))
    # The turn leads the order: as fixed-width hex it can be binned like a hash, but turns are few, so its counts are.
    turns = own.groupBy(*keys, "turn").agg(F.count("*").alias("_n"))
    along = Window.partitionBy(*keys).orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    before = turns.select(*keys, "turn", F.coalesce(F.sum("_n").over(along), F.lit(0)).alias("_before")).join(quotas.select(*keys, "quota"), keys).filter("_before < quota")
    reached = own.join(before, [*keys, "turn"])
    ranked = hashed_rank(reached, [*keys, "turn"], company, ["cik"], "_rank")
    return ranked.filter(F.col("_before") + F.col("_rank") <= F.col("quota")).drop("_before", "_rank", "quota")


def top_up_candidates(manifest: DataFrame, weak: DataFrame, universe: DataFrame, paths: DataFrame, keys: DataFrame, forms: tuple[str, ...] = FORM_ORDER) -> DataFrame:
    """Manifest rows (cik, form_type, date_filed, output_path, accession, filing_url) that may fill the weak years: of a wanted form, a year
    of ``weak`` and a company of ``universe``, whose path is not in ``paths`` (rel_path) and whose (cik, accession) not in ``keys``.
    Paths are compared with slashes, company numbers without leading zeros."""
    rows = manifest.withColumn("form_type", form_key(F.col("form_type"))).withColumn("cik", cik_any(F.col("cik"))).withColumn("year", F.substring(strip(F.col("date_filed")), 1, 4)).withColumn("accession", F.coalesce(strip(F.col("accession")), F.lit("")))
    wanted = rows.filter(F.col("form_type").isin(*forms)).join(weak.select("year").distinct(), "year", "left_semi").join(universe.select("cik").distinct(), "cik", "left_semi")
    slashed = lambda c: strip(F.replace(F.coalesce(c, F.lit("")), F.lit("\\"), F.lit("/")))
    there = paths.select(slashed(F.col("rel_path")).alias("_path")).distinct()
    fresh = wanted.withColumn("_path", slashed(F.col("output_path"))).join(there, "_path", "left_anti").drop("_path")
    done = keys.filter("accession <> ''").select(cik_any(F.col("cik")).alias("cik"), "accession").distinct()
    return fresh.join(done, ["cik", "accession"], "left_anti")


def top_up(candidates: DataFrame, lack: DataFrame, weights: dict[str, float], seed: int, key: str, identity: tuple[str, ...] = ()) -> DataFrame:
    """Rows that fill the weak years: quotas per form, a diverse draw per form, then a diverse draw of the rest, each key once.

    ``lack`` has year and deficit; ``candidates`` have year, form_type, cik and the key (blank keys are dropped). What is left after the first
    draw is told by ``identity`` (such as cik, accession, url), else by the key.
    """
    candidates = stored(candidates)  # read for the counts, both draws and what is left
    have = candidates.groupBy("year", "form_type").agg(F.count("*").alias("available"))
    quotas = allocate(have.join(lack.select("year", F.col("deficit").alias("target")), "year"), weights)
    first = stored(round_robin(candidates, quotas, ["year", "form_type"], seed, key).drop("turn"))
    got = first.groupBy("year").agg(F.count("*").alias("_got"))
    still = lack.join(got, "year", "left").select("year", (F.col("deficit") - F.coalesce("_got", F.lit(0))).alias("quota")).filter("quota > 0")
    taken = first.select(*(F.col(c).alias(f"_{c}") for c in identity or (key,))).distinct()
    rest = candidates.join(taken, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in identity or (key,)], "left_anti")
    extra = round_robin(rest, still, ["year"], seed + 999, key).drop("turn")
    out = first.select(*candidates.columns).unionByName(extra.select(*candidates.columns))
    return first_by(out, key, [*(identity or ()), "year", "form_type", "cik"])
