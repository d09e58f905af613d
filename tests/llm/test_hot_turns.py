"""Conversations whose rows share a turn number, or have none."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickmart.llm import chat_format
from clickmart.llm.common import stored


def test_rows_without_a_turn_are_spread(spark):
    rows = [(1, None, "u", f"n{i}") for i in range(3000)] + [(1, 5, "u", f"five{i}") for i in range(2000)] + [(1, 6, "b", "six"), (1, 4, "b", None)]
    rows += [(2, t, r, x) for _, t, r, x in rows if t != 6] + [(3, 5000, "u", ""), (3, 7, None, "x"), (3, 7, None, "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"slice": F.lit(1), "one": F.lit("x")})
    rolled = stored(chat_format.prefixes(turns), "test")
    one = rolled.where("conv_id = 1").orderBy("pos").collect()
    assert [r["pos"] for r in one] == list(range(1, 5003))
    assert {r["text"] for r in one[:3000]} == {f"n{i}" for i in range(3000)} and one[3000]["text"] is None and one[-1]["text"] == "six"
    two = rolled.where("conv_id = 2").orderBy("pos").collect()
    assert [(r["x1"], r["x2"]) for r in two] == [(r["x1"], r["x2"]) for r in one[:-1]]
    assert len({(r["x1"], r["x2"]) for r in one}) == len(one)
    got = chat_format.chat_format(turns).groupBy("conv_id").agg(F.max("n_turns").alias("n"), F.count("*").alias("parts")).collect()
    assert {(r["conv_id"], r["n"], r["parts"]) for r in got} == {(1, 5002, 79), (3, 2, 1)}
