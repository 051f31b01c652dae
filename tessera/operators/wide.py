"""Attribute-value rows into one wide row per entity, by positional stitching.

1. Cells: names are matched to the wanted columns by letters and digits only, values are read by the
   column's type, and per entity and column the lowest occurrence with a fitting value wins. This is a partial
   aggregation before the shuffle, so one entity with a third of all rows costs a task nothing.
2. Ranges: entities fall by hash into ranges, one for each ``RANGE_BYTES`` of the input as the optimizer estimates its size, so that no pass
   is spent on counting; a second shuffle sends each range to its own task (or, beyond ``MAX_TASKS`` ranges, several to one, in turn).
3. Stitching: per range, each attribute is written as one typed Arrow column whose slots are the positions of the range's
   entities, and the columns are put side by side by position. No join and no pivot over the entities.
4. Ordinals: the stitched ranges are written; their lengths, summed up, give each its first ordinal, and the position in the range the rest.

Defined results: an entity without any fitting cell has a row of nulls; null entities have none; a null occurrence
counts last; equal occurrences take the smallest value; wanted columns without name or type are ignored; rows whose name is not wanted only make the entity known.
Columns of the input other than the named ones are ignored, whatever their names. Within a range entities stand in the order of their bytes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.codes import bracket_code, name_key, real_text
from tessera.functions.timeparse import normal_date
from tessera.session import stored

#: Bytes of the input (as stored) of one range.
RANGE_BYTES = 8 << 20
#: Tasks of the stitching; more ranges than that share tasks and are stitched one after the other.
MAX_TASKS = 100_000
#: The first ordinals are two numbers a range; up to so many ranges (16 MB) they are broadcast, beyond that joined by shuffle.
BROADCAST_RANGES = 1_000_000
#: A column's types: how it is stored.
TYPES = {"string": T.StringType(), "bigint": T.LongType(), "date": T.DateType(), "code": T.StringType(), "digits": T.StringType()}
_NO_OCCURRENCE = 2**62


def cell_text(kind: Column, value: Column) -> Column:
    """The value as canonical text of its type, null where it does not fit.

    string: white space squeezed; bigint: digits, with thousands commas or not; date: any spelling that is a date; code: the number in
    brackets, else the bare number; digits: digits between blanks, dots, slashes and dashes. Placeholders fit nothing.
    """
    real = real_text(value)
    number = F.when(real.rlike(r"^[+-]?([0-9]+|[0-9]{1,3}(,[0-9]{3})+)$"), F.regexp_replace(real, "[,+]", "")).try_cast("bigint").cast("string")
    digits = F.when(real.rlike(r"^[0-9 ./-]*[0-9][0-9 ./-]*$"), F.regexp_replace(real, "[^0-9]", ""))
    # The Arrow evaluation sees every row, so it is given nulls for all but the dates.
    date = normal_date(F.when(kind == "date", value)).cast("string")
    return (
        F.when(kind == "string", real)
        .when(kind == "bigint", number)
        .when(kind == "date", date)
        .when(kind == "code", bracket_code(real))
        .when(kind == "digits", digits)
    )


def wanted_columns(spec: DataFrame) -> list[tuple[str, str]]:
    """(column_name, data_type) of the wide table in order; ``spec`` is a schema, read by the driver (at most 10,000 rows)."""
    rows = spec.select("column_name", "data_type").dropna().distinct().orderBy("column_name").limit(10_001).collect()
    if len(rows) > 10_000:
        raise ValueError("a wide table of over 10,000 columns is not supported")
    if len({r[0] for r in rows}) < len(rows):
        raise ValueError("a column of the wide table has two types")
    if unknown := {r[1] for r in rows} - set(TYPES):
        raise ValueError(f"unknown types: {sorted(unknown)}")
    return [(r[0], r[1]) for r in rows]


def winning_cells(eav: DataFrame, spec: DataFrame, columns: list[str], entity: str = "filing_id") -> DataFrame:
    """(entity, slot, cell): the winner of each cell; slot is null for the row that only makes the entity known."""
    slots = F.array(*(F.lit(c) for c in columns))
    names = spec.select(
        name_key(F.col("section")).alias("_section"), name_key(F.col("field_name")).alias("_field"),
        (F.array_position(slots, F.col("column_name")) - 1).cast("int").alias("slot"), F.col("data_type").alias("_kind"),
    ).distinct()
    rows = eav.filter(F.col(entity).isNotNull()).select(
        F.col(entity).alias("entity"), name_key(F.col("section")).alias("_section"), name_key(F.col("field_name")).alias("_field"),
        "field_value", F.coalesce(F.col("occurrence").cast("bigint"), F.lit(_NO_OCCURRENCE)).alias("_occurrence"),
    )
    # The names are a schema of a few rows: below the broadcast threshold Catalyst ships them, else it joins by shuffle.
    typed = rows.join(names, ["_section", "_field"], "left").withColumn("cell", cell_text(F.col("_kind"), F.col("field_value")))
    known = typed.withColumn("slot", F.when(F.col("cell").isNotNull(), F.col("slot")))
    best = F.min(F.struct("_occurrence", "cell"))
    return known.groupBy("entity", "slot").agg(best.alias("_best")).select("entity", "slot", "_best.cell")


def _stitched(key: int, rows: pa.Table, kinds: list[str], names: list[str]) -> pa.Table:
    """The wide rows of one range: its number, position, entity and the typed columns."""
    arrow = {"bigint": pa.int64(), "date": pa.date32()}
    coded = rows["entity"].combine_chunks().dictionary_encode()
    order = pc.array_sort_indices(coded.dictionary)
    n = len(order)
    place = pc.array_sort_indices(order)  # rank of each distinct entity: its position in this range
    at = place.take(coded.indices).to_numpy()
    slot, cell = rows["slot"].combine_chunks().fill_null(-1).to_numpy(), rows["cell"].combine_chunks()
    out = [pa.array(np.full(n, key, np.int32)), pa.array(np.arange(n)), coded.dictionary.take(order)]
    for k, kind in enumerate(kinds):
        own = np.flatnonzero(slot == k)
        where = np.full(n, -1)
        where[at[own]] = own
        column = cell.take(pa.array(where, mask=where < 0))
        out.append(column.cast(arrow[kind]) if kind in arrow else column)
    return pa.Table.from_arrays(out, names)


def _stitcher(kinds: list[str], names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now = None
        for batch in batches:  # sorted by range
            keys = batch.column(0).to_numpy()
            for a, b in pairwise([0, *(np.flatnonzero(np.diff(keys)) + 1), len(keys)]):
                if a == b:
                    continue
                if held and keys[a] != now:
                    yield from _stitched(now, pa.Table.from_batches(held), kinds, names).to_batches(10_000)
                    held = []
                now = int(keys[a])
                held.append(batch.slice(a, b - a))
        if held:
            yield from _stitched(now, pa.Table.from_batches(held), kinds, names).to_batches(10_000)

    return run


def _input_bytes(df: DataFrame) -> int:
    """The size the optimizer estimates, without a job; where it has no estimate, rows are counted."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return size if size < 1 << 60 else 100 * df.count()


def to_wide(eav: DataFrame, spec: DataFrame, entity: str = "filing_id", ranges: int | None = None) -> DataFrame:
    """One row per entity: ``entity_ordinal`` (from 0, without gaps), the entity and the typed columns of ``spec``.

    ``eav`` has the entity, section, field_name, field_value, occurrence; ``spec`` has section, field_name, column_name,
    data_type. An empty ``eav`` gives an empty table of the same schema. ``eav`` is read once.
    """
    wanted = wanted_columns(spec)
    columns, kinds = [c for c, _ in wanted], [k for _, k in wanted]
    if clash := {entity, "entity_ordinal"} & set(columns):
        raise ValueError(f"columns of the wide table clash with {sorted(clash)}")
    n = ranges or max(1, math.ceil(_input_bytes(eav) / RANGE_BYTES))
    key = F.pmod(F.xxhash64("entity"), F.lit(n)).cast("int").alias("range")
    cells = winning_cells(eav, spec, columns, entity).select(key, "entity", "slot", "cell")
    tasks = min(n, MAX_TASKS)
    in_place = cells.repartitionById(tasks, F.pmod("range", F.lit(tasks)).cast("int")).sortWithinPartitions("range")
    # Columns go by number until the end, so that no name of ``spec`` can clash with the two of the range.
    inner = T.StructType(
        [T.StructField("_range", T.IntegerType()), T.StructField("_position", T.LongType()), T.StructField("_entity", eav.schema[entity].dataType)]
        + [T.StructField(f"_c{k}", TYPES[kind]) for k, kind in enumerate(kinds)]
    )
    pieces = stored(in_place.mapInArrow(_stitcher(kinds, inner.names), inner))
    # One row per range: a running sum over them is the only thing that is not spread.
    running = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    firsts = pieces.groupBy("_range").agg(F.count("*").alias("_n")).select("_range", F.coalesce(F.sum("_n").over(running), F.lit(0)).alias("_first"))
    numbered = pieces.join(F.broadcast(firsts) if n <= BROADCAST_RANGES else firsts, "_range")
    return numbered.select((F.col("_first") + F.col("_position")).alias("entity_ordinal"), F.col("_entity").alias(entity), *(F.col(f"_c{k}").alias(c) for k, c in enumerate(columns)))


def wide_cells(wide: DataFrame, columns: list[str], entity: str = "filing_id") -> DataFrame:
    """The non-null cells of a wide table as (entity, column_name, cell_value)."""
    pairs = F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("cell_value")) for c in columns))
    cells = wide.select(entity, F.explode(F.filter(pairs, lambda p: p["cell_value"].isNotNull())).alias("cell"))
    return cells.select(entity, "cell.column_name", "cell.cell_value")
