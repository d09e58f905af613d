"""Chat formatting with cumulative-snapshot collapse (operator 4), DataFrame functions only.

A conversation that was logged again and again as it grew leaves rows that are
prefixes of a longer one. Every turn gets a hash of its position, role and
text; the running XOR of these is the rolling hash of each prefix. A
conversation goes if more conversations pass through its full hash than end
there (it prefixes a longer one), and equal conversations leave the smallest
conv_id. What remains is rendered.

The running position and XOR use nested levels (buckets of turn numbers, turn
numbers, slices of a hash among rows of one number, rows of a slice): what is
before a level's cell is summed over cells, so neither a conversation with a
third of all turns nor a turn number with as many rows comes to one task, and
rendering cuts conversations into parts of PART_TURNS turns.

Defined results: a null conv_id is one conversation of its own; a null turn
sorts first; null role or text differ from empty ones and render as empty;
repeated rows count once; turns of one number (or none) are ordered by a hash
of role and text; very long texts are hashed and rendered whole (a part is one
row of at most 2 GB); an empty table returns no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmart.llm.common import stored

BUCKET_TURNS = 1024
SLICE_BITS = 12  # of the hash that orders rows of one turn number
PART_TURNS = 64
HASHES = ("x1", "x2")
LEVELS = ("bucket", "turn", "slice")


def _with_before(rows: DataFrame, value: str, add, join, zero) -> DataFrame:
    """``rows`` with ``{value}_before``: the values of all rows of the conversation in earlier cells, level by level.

    ``add`` is the aggregate that adds values up, ``join`` adds two columns.
    """
    keys = ["conv_id", *LEVELS]
    cells = stored(rows.groupBy(*keys).agg(add(value).alias(value)), f"cells-{value}")
    total = zero
    out = cells.select(*keys)
    for depth in range(len(LEVELS), 0, -1):
        inner, outer = keys[:depth + 1], keys[:depth]
        before = Window.partitionBy(*outer).orderBy(inner[-1]).rowsBetween(Window.unboundedPreceding, -1)
        each = cells.groupBy(*inner).agg(add(value).alias("own")).select(
            *[F.col(k).alias(f"_{k}") for k in inner], F.coalesce(add("own").over(before), zero).alias(f"before_{depth}"))
        out = out.join(each, reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in inner])).drop(*[f"_{k}" for k in inner])
        total = join(total, F.col(f"before_{depth}"))
    cells = stored(out.select(*[F.col(k).alias(f"_{k}") for k in keys], total.alias(f"{value}_before")), f"before-{value}")
    return rows.join(cells, reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])).drop(*[f"_{k}" for k in keys])


def prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, pos (1, 2, ...), role, text and the rolling hash (x1, x2) up to each turn."""
    parts = ["conv_id", "turn", "role", "text"]
    rows = turns.select(*parts).groupBy(*parts).agg(F.lit(1).cast("long").alias("one")).select(
        *parts, "one", F.coalesce(F.floor(F.col("turn") / BUCKET_TURNS), F.lit(-1 << 40)).alias("bucket"),
        F.xxhash64("role", F.col("role").isNull(), "text", F.col("text").isNull()).alias("c1"),
        F.xxhash64(F.lit(7), "text", F.col("text").isNull(), "role", F.col("role").isNull()).alias("c2"))
    rows = stored(rows.withColumn("slice", F.shiftright("c1", 64 - SLICE_BITS)), "rows")
    cell = Window.partitionBy("conv_id", *LEVELS)
    zero = F.lit(0).cast("long")
    placed = _with_before(rows, "one", F.sum, Column.__add__, zero).withColumn(
        "pos", F.col("one_before") + F.row_number().over(cell.orderBy("c1", "c2")))
    placed = stored(placed.select("conv_id", *LEVELS, "pos", "role", "text",
                                  F.xxhash64("pos", "c1", "c2").alias("h1"),
                                  F.xxhash64(F.lit(3), "c2", "pos", "c1").alias("h2")), "turns")
    for h in ("h1", "h2"):
        placed = _with_before(placed, h, F.bit_xor, Column.bitwiseXOR, zero)
    upto = cell.orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return placed.select(
        "conv_id", "pos", "role", "text",
        *[F.bit_xor(h).over(upto).bitwiseXOR(F.col(f"{h}_before")).alias(x) for h, x in zip(("h1", "h2"), HASHES, strict=True)])


def maximal(rolled: DataFrame) -> DataFrame:
    """conv_id and n_turns of the conversations that prefix no other; of equal ones the smallest conv_id."""
    key = ["pos", *HASHES]
    ends = rolled.groupBy("conv_id").agg(F.max(F.struct(*key)).alias("end")).select("conv_id", "end.*")
    passing = rolled.groupBy(*key).agg(F.count("*").alias("passing"))
    ending = ends.groupBy(*key).agg(F.count("*").alias("ending"), F.min("conv_id").alias("first"))
    extended = ending.join(passing, key).where(F.col("passing") > F.col("ending")).select(*key)
    return ending.join(extended, key, "left_anti").select(F.col("first").alias("conv_id"), F.col("pos").alias("n_turns"))


def render(rolled: DataFrame, kept: DataFrame) -> DataFrame:
    """The kept conversations as chat text, in parts of PART_TURNS turns."""
    turn = F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), F.coalesce("text", F.lit("")),
                    F.lit("<|end|>\n"))
    kept = kept.withColumnRenamed("conv_id", "c")
    rows = rolled.join(kept, F.col("conv_id").eqNullSafe(F.col("c"))).select(
        "conv_id", "n_turns", "pos", turn.alias("said"), F.floor((F.col("pos") - 1) / PART_TURNS).alias("part"))
    said = F.sort_array(F.collect_list(F.struct("pos", "said")))
    return rows.groupBy("conv_id", "n_turns", "part").agg(said.alias("said")).select(
        "conv_id", "n_turns", "part", F.array_join("said.said", "").alias("rendered"))


def chat_format(turns: DataFrame) -> DataFrame:
    rolled = stored(prefixes(turns), "prefixes")
    return render(rolled, stored(maximal(rolled), "maximal"))
