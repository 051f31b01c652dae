"""Which address records denote the same place.

1. Exact copies are set aside: one representative (the smallest id) per distinct (street1, street2, city, state, postal_code).
2. Each is expanded into all plausible readings (:mod:`tessera.llm.addressing`: street and box, letters of directions, abbreviated
   names), one row each, and each reading into its spellings: street names with each one letter left out (words one edit or one swap apart
   share a form), cities likewise.
3. Component combinations are hashed and exploded: (number, street form, zip) and (number, either end of the street, zip) always; (number, street form, city), (number, street, city
   form) and (number, street form, state) are asked only by records without a zip, since two zips decide by themselves. The same
   again with the street left out, for two misspelled records.
4. An equi-join on any shared hash gives candidates. The house (or box) number is part of every hash; the numbers are compared
   again with their letters, fractions and ranges and conflicting ones rejected, as are conflicting zips, states, cities, directions and
   street types. The names of a pair are compared letter by letter (:func:`tessera.llm.addressing.spelled_alike`).
5. A record that leaves out the direction or the street type takes them from its neighbours: those of the same suite first, then
   the most frequent. Links whose completed forms conflict are dropped.
6. Links are closed by passing on the smallest id until no label changes, and pairs of one label are checked once more.

Places are buildings or boxes: suite, floor and addressee do not matter, but for step 5. Every hash holds the house number and the street,
so no group is larger than the spellings of one place and its look-alikes; the pairs of one place are the result itself.

Defined results: records without street and box are no place; null ids take no part; equal ids with different texts are told by the
smallest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.addressing import Place, deletions, read_places, spelled_alike
from tessera.session import stored

FIELDS = ["street1", "street2", "city", "state", "postal_code"]
_FORM = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("reading", T.IntegerType()), T.StructField("copies", T.LongType()), T.StructField("box", T.BooleanType())]
    + [T.StructField(c, T.StringType()) for c in Place._fields[1:]]
    + [T.StructField("told", T.ArrayType(T.LongType())), T.StructField("asked", T.ArrayType(T.LongType()))]
)
_KEPT = ["id", "reading", "copies", *Place._fields]


def _hashes(p: Place) -> tuple[list[int], list[int]]:
    """(told, asked): hashes under which others find this reading, and those it looks others up by."""

    def h(*parts: str) -> int:
        return xxhash.xxh64_intdigest("\x1f".join(parts).encode()) - (1 << 63)

    base = ("box" if p.box else "street", p.number)
    forms, towns = deletions(p.name), deletions(p.city) if p.city else []
    zips = [h(*base, f, "zip", p.zip5) for f in forms] if p.zip5 else []
    wider = [h(*base, f, "city", p.city) for f in forms] + [h(*base, p.name, "town", c) for c in towns] if p.city else []
    if p.state:
        wider += [h(*base, f, "state", p.state) for f in forms]
    if len(forms) > 1:  # a name that may be misspelled in both records: one end of it whole, or left out altogether
        if p.zip5:
            zips += [h(*base, "begin", p.name[:4], p.zip5), h(*base, "end", p.name[-4:], p.zip5), h(*base, "any", "zip", p.zip5)]
        wider += [h(*base, "any", "town", c) for c in towns]
        if p.state:
            wider.append(h(*base, "any", "state", p.state))
    return zips + wider, zips if p.zip5 else wider


@F.arrow_udf(T.BooleanType())
def _alike(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array([spelled_alike(x, y) for x, y in zip(a.to_pylist(), b.to_pylist())], pa.bool_())


@F.arrow_udf(T.BooleanType())
def _alike_in_chain(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array([spelled_alike(x, y, True) for x, y in zip(a.to_pylist(), b.to_pylist())], pa.bool_())


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    text, hashes = pa.string(), pa.list_(pa.int64())
    schema = pa.schema([("id", pa.int64()), ("reading", pa.int32()), ("copies", pa.int64()), ("box", pa.bool_()), *((c, text) for c in Place._fields[1:]), ("told", hashes), ("asked", hashes)])
    for batch in batches:
        rows = []
        for ident, copies, *texts in zip(*(c.to_pylist() for c in batch.columns)):
            rows += [(ident, k, copies, *p, *_hashes(p)) for k, p in enumerate(read_places(*texts))]
        columns = list(zip(*rows)) if rows else [[] for _ in schema]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def representatives(addresses: DataFrame, key: str = "address_id") -> DataFrame:
    """One row per distinct address: the smallest id and how many rows it stands for (combined before the shuffle)."""
    known = addresses.filter(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("id"), *FIELDS)
    return known.groupBy(*FIELDS).agg(F.min("id").alias("id"), F.count("*").alias("copies"))


def forms(reps: DataFrame) -> DataFrame:
    """One row per reading of each representative."""
    return reps.select("id", "copies", *FIELDS).mapInArrow(_read, _FORM)


def _agree(a: Column, b: Column) -> Column:
    return (a == b) | (a == "") | (b == "")


def _same_place(pairs: DataFrame, chained: bool = False) -> DataFrame:
    """The pairs (structs a, b) of the same number and no conflict of the parts that both tell."""
    c = lambda side, name: F.col(f"{side}.{name}")
    both = lambda name: _agree(c("a", name), c("b", name))
    same = lambda name: c("a", name) == c("b", name)
    far = 8 if chained else 4  # a swap counts twice
    near = lambda name: F.levenshtein(c("a", name), c("b", name), far) >= 0
    same_zip = same("zip5") & (c("a", "zip5") != "")
    # A town is told by the zip; without it the names have to agree but for an edit on either side.
    city = same_zip | both("city") | (F.levenshtein(c("a", "city"), c("b", "city"), 3) >= 0)
    free = pairs.filter(same("number") & same("box") & both("part") & both("direction") & both("kind") & both("zip5") & (same_zip | both("state")) & city & (same("name") | near("name")))
    # Only names that differ go through Python.
    alike = _alike_in_chain if chained else _alike
    a, b = (F.when(~same("name"), c(side, "name")).otherwise("") for side in "ab")
    return free.filter(alike(a, b))


def _packed(df: DataFrame, side: str) -> DataFrame:
    return df.select(F.col("id").alias(f"{side}_id"), F.col("reading").alias(f"{side}_reading"), F.struct(*_KEPT).alias(side))


def candidate_links(read: DataFrame) -> DataFrame:
    """(a, b) structs of readings of two records that share a hash and do not conflict, a.id < b.id."""
    told = read.select(F.col("id").alias("to"), F.col("reading").alias("to_reading"), F.explode("told").alias("hash"))
    asked = read.select(F.col("id").alias("by"), F.col("reading").alias("by_reading"), F.explode("asked").alias("hash"))
    first = F.col("to") < F.col("by")
    pairs = told.join(asked, "hash").filter(F.col("to") != F.col("by")).select(
        F.least("to", "by").alias("a_id"), F.when(first, F.col("to_reading")).otherwise(F.col("by_reading")).alias("a_reading"),
        F.greatest("to", "by").alias("b_id"), F.when(first, F.col("by_reading")).otherwise(F.col("to_reading")).alias("b_reading"),
    ).distinct()
    return _same_place(pairs.join(_packed(read, "a"), ["a_id", "a_reading"]).join(_packed(read, "b"), ["b_id", "b_reading"]).select("a", "b"))


def completed(read: DataFrame, links: DataFrame) -> DataFrame:
    """``read`` with left-out directions and types taken from the best neighbours."""
    both = links.select(F.col("a").alias("r"), F.col("b").alias("n")).unionByName(links.select(F.col("b").alias("r"), F.col("a").alias("n")))
    lacks = ((F.col("r.direction") == "") & (F.col("n.direction") != "")) | ((F.col("r.kind") == "") & (F.col("n.kind") != ""))
    own = lambda c: F.when(F.col(f"r.{c}") != "", F.col(f"r.{c}")).otherwise(F.col(f"n.{c}"))
    told = both.filter(lacks & ~F.col("r.box")).select(
        F.col("r.id").alias("id"), F.col("r.reading").alias("reading"), own("direction").alias("direction"), own("kind").alias("kind"),
        ((F.col("r.unit") != "") & (F.col("r.unit") == F.col("n.unit"))).cast("int").alias("unit"), F.col("n.copies").alias("copies"),
    )
    votes = told.groupBy("id", "reading", "direction", "kind").agg(F.max("unit").alias("unit"), F.count("*").alias("n"), F.sum("copies").alias("copies"))
    full = (F.col("direction") != "").cast("int") + (F.col("kind") != "").cast("int")
    best = votes.groupBy("id", "reading").agg(F.max_by(F.struct("direction", "kind"), F.struct("unit", full, "n", "copies", "direction", "kind")).alias("_best"))
    out = read.join(best, ["id", "reading"], "left")
    return out.withColumn("direction", F.coalesce("_best.direction", "direction")).withColumn("kind", F.coalesce("_best.kind", "kind")).drop("_best")


def labels(read: DataFrame, links: DataFrame) -> DataFrame:
    """(id, label): the smallest id of the component. Each round is written; places are nearly cliques, so there are few."""
    edges = links.select(F.col("a_id").alias("x"), F.col("b_id").alias("y"))
    edges = edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
    now = read.select("id").distinct().select("id", F.col("id").alias("label"))
    while True:
        heard = edges.join(now, edges["y"] == now["id"]).select(F.col("x").alias("id"), "label", F.lit(None).cast("bigint").alias("before"))
        told = now.select("id", "label", F.col("label").alias("before")).unionByName(heard)
        new = stored(told.groupBy("id").agg(F.min("label").alias("label"), F.max("before").alias("before")))
        now = new.select("id", "label")
        if new.filter("label <> before").isEmpty():
            return now


def place_pairs(addresses: DataFrame, key: str = "address_id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pairs, places, representatives): pairs (a_id, b_id) of representatives of one place; (id, label) of each place."""
    reps = representatives(addresses, key)
    read = stored(forms(reps))
    links = stored(candidate_links(read))
    full = stored(completed(read.drop("told", "asked"), links))
    ends = links.select(*(F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in "ab" for c in ("id", "reading")))
    whole = ends.join(_packed(full, "a"), ["a_id", "a_reading"]).join(_packed(full, "b"), ["b_id", "b_reading"])
    kept = stored(_same_place(whole.select("a", "b")).select(F.col("a.id").alias("a_id"), F.col("b.id").alias("b_id")).distinct())
    labelled = stored(full.join(labels(full, kept), "id"))
    one = lambda side: labelled.select("label", F.col("id").alias(f"{side}_id"), F.struct(*_KEPT).alias(side))
    pairs = _same_place(one("a").join(one("b"), "label").filter("a_id < b_id"), True).select("a_id", "b_id").distinct()
    return pairs, labelled.select("id", "label").distinct(), reps


def places(addresses: DataFrame, key: str = "address_id") -> DataFrame:
    """(key, place): the place of every row that tells one; exact copies share that of their representative."""
    _, labelled, reps = place_pairs(addresses, key)
    named = reps.join(labelled, "id")
    rows = addresses.filter(F.col(key).isNotNull()).select(key, *FIELDS).alias("r")
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"p.{c}")) for c in FIELDS]
    return rows.join(named.alias("p"), same).select(F.col(f"r.{key}").alias(key), F.col("p.label").alias("place"))
