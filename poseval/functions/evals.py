"""Choice of one evaluation per row from the nested ``evals`` array."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _deepest(evals: Column, first: bool) -> Column:
    """Greatest entry by (depth, position), its values riding behind."""

    def candidate(entry: Column, nth: Column) -> Column:
        pv = F.get(entry["pvs"], F.lit(0))
        found = F.struct(
            entry["depth"].cast("int").alias("depth"),
            (-nth if first else nth).alias("nth"),
            (F.size(entry["pvs"]) > 0).alias("usable"),
            pv["cp"].cast("int").alias("eval"),
            pv["mate"].cast("int").alias("mate"),
            *([pv["line"].alias("line")] if first else []),
        )
        return F.when(entry["depth"].isNotNull() & (F.size(entry["pvs"]) > 0), found) if first else found

    return F.array_max(F.transform(evals, candidate))


def best_eval_first(evals: Column) -> Column:
    """Struct with ``depth, usable, eval, mate, line`` of the deepest usable entry.

    Entries without depth or without any principal variation are skipped; the
    first of equally deep entries wins; NULL when nothing is usable.
    """
    return _deepest(evals, first=True)


def best_eval_last(evals: Column) -> Column:
    """Struct with ``depth, usable, eval, mate`` of the deepest entry, the last on ties.

    The entry is chosen before its variations are looked at: ``usable`` is
    false when it has none, and then the row has no evaluation.
    """
    return _deepest(evals, first=False)


def row_longest_depth(evals: Column) -> Column:
    return F.array_max(F.transform(evals, lambda e: e["depth"]))


def has_missing_field(fen: Column, evals: Column) -> Column:
    """A required field of the nested layout is absent (cp and mate may be)."""
    bad_pv = lambda pv: pv.isNull() | pv["line"].isNull()
    bad_entry = lambda e: (
        e.isNull()
        | e["knodes"].isNull()
        | e["depth"].isNull()
        | e["pvs"].isNull()
        | F.coalesce(F.exists(e["pvs"], bad_pv), F.lit(False))
    )
    return fen.isNull() | evals.isNull() | F.coalesce(F.exists(evals, bad_entry), F.lit(False))
