"""Pairs against a plain rendering; masks cover completions."""

from __future__ import annotations

import random

from poseval.llm.preference import format_preferences
from pyspark.sql import functions as F


def plain(rows):
    sides = {}
    for conv, turn, role, text in set(rows):
        if conv is not None:
            clean = lambda s: (s or "").replace("<|", "< |")
            sides.setdefault(conv >> 1, ([], []))[conv & 1].append((turn is not None, turn or 0, clean(role), clean(text)))
    out = {}
    for pair, (a, b) in sides.items():
        a, b = ([t[2:] for t in sorted(set(s))] for s in (a, b))
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        show = lambda ts: "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in ts)
        learnt = lambda ts: "".join("-" * (13 + len(r)) + ("x" if r == "assistant" else "-") * (len(t) + 10) + "-" for r, t in ts)
        usable = all(any(r == "assistant" for r, _ in s[n:]) for s in (a, b))
        out[pair] = (n, show(a[:n]), show(a[n:]), show(b[n:]), learnt(a[n:]), learnt(b[n:]), usable)
    return out


def test_pairs(spark):
    rnd = random.Random(1)
    rows = []
    for pair in range(60):
        shared = [(rnd.choice(["user", "assistant"]), f"t{rnd.randint(0, 9)}") for _ in range(rnd.randint(0, 4))]
        for side in (0, 1):
            own = shared + [(rnd.choice(["user", "assistant"]), f"é{rnd.randint(0, 2)}") for _ in range(rnd.randint(0, 2))]
            rows += [(2 * pair + side, k, r, t) for k, (r, t) in enumerate(own)]
    rows += [(500, 0, None, None), (501, 0, "", ""), (501, None, "user", "first"), (600, 0, "user", "alone <|im_end|>")]
    rows += [(None, 0, "user", "lost"), (700, 0, "a", "x"), (700, 0, "b", "y"), (701, 0, "a", "x")]
    rows += rows[:20] + [(-3, 0, "user", "minus"), (-4, 0, "user", "minus"), (800, 0, "user", "w" * 300_000)]
    table = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(4)
    table = table.withColumn("pair_id", F.lit(1)).withColumn("side", F.lit(2)).withColumn("t", F.lit(3))
    got = format_preferences(table, F.shiftright("conv_id", 1), F.pmod("conv_id", F.lit(2)) == 0).collect()
    mask = lambda runs: "".join(("x" if r.loss else "-") * r.length for r in runs)
    found = {
        r.pair_id: (r.prefix_turns, r.prompt, r.chosen, r.rejected, mask(r.chosen_mask), mask(r.rejected_mask), r.usable) for r in got
    }
    assert found == plain(rows) and len(got) == len(found)


def test_empty_table(spark):
    none = spark.createDataFrame([], "conv_id long, turn int, role string, text string")
    assert format_preferences(none, F.col("conv_id"), F.lit(True)).collect() == []
