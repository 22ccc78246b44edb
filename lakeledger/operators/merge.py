"""Pulling back what people wrote into an export: a three-way merge.

The last export is the base; the target as it is now is one side (*theirs*), the
present rows of Silver the other (*ours*).  All are tables of texts with null as
'', as exports are (``export.stringify``).  The three are dealt to their keys
with one shuffle; each key's rows are compared cell by cell:

  same      neither side changed the cell
  ours      only Silver changed it: Silver's text
  theirs    only the target changed it: the target's text
  both      both sides changed it to the same text
  conflict  both changed it, to different texts: by ``prefer``

Columns of the target alone (notes, own categories) are never changed by Silver:
they are *theirs* where the target differs from the base.  A column that the
target lost is not brought back.  For rows:

  merged    in the target and in Silver
  ours      only in Silver: a new row
  theirs    only in the target: a row somebody wrote
  dropped   gone from one side and not changed by the other; it stays away
  conflict  gone from one side, changed by the other: by ``prefer``
  repeated  the key stands more than once on one side; nothing of it is merged
            and the target's rows stay

A null in a key is a value like others.  Empty sides are sides without rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS = ("item_id", "transaction_id", "version")
_SIDES = ("base", "theirs", "ours")


def _side(df: DataFrame, name: str, keys, columns: list[str]) -> DataFrame:
    cells = [(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) if c in df.columns
              else F.lit(None).cast("string")).alias(f"c{i}") for i, c in enumerate(columns)]
    return df.select(*[F.col(f"`{k}`").cast("string").alias(k) for k in keys], F.lit(name).alias("side"),
                     F.struct(F.lit(0).alias("in"), *cells).alias("cells"))


def _cell(i: int, column: str, own: bool, prefer: str) -> Column:
    """(column, class, base, theirs, ours, value) of one cell."""
    empty = F.lit("")
    base = F.coalesce(F.col(f"base.c{i}"), empty)
    theirs = F.coalesce(F.col(f"theirs.c{i}"), empty)
    ours = base if own else F.coalesce(F.col(f"ours.c{i}"), empty)
    kind = (F.when((theirs == ours) & (ours == base), "same").when(theirs == ours, "both")
            .when(ours == base, "theirs").when(theirs == base, "ours").otherwise("conflict"))
    value = F.when(kind == "ours", ours).when(kind == "conflict", ours if prefer == "ours" else theirs).otherwise(theirs)
    return F.struct(F.lit(column).alias("column"), kind.alias("class"), base.alias("base"), theirs.alias("theirs"),
                    ours.alias("ours"), value.alias("value"))


def three_way(base: DataFrame, theirs: DataFrame, ours: DataFrame, keys=KEYS, prefer: str = "theirs") -> DataFrame:
    """The keys, row_class and ``cells``, one struct for each column of the
    target; null for rows that are not merged cell by cell."""
    if prefer not in ("ours", "theirs"):
        raise ValueError("prefer is 'ours' or 'theirs'")
    columns = [c for c in theirs.columns if c not in keys]
    parts = [_side(df, name, keys, columns) for name, df in zip(_SIDES, (base, theirs, ours))]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    met = rows.groupBy(*keys).agg(
        *[F.max(F.when(F.col("side") == s, F.col("cells"))).alias(s) for s in _SIDES],
        *[F.count_if(F.col("side") == s).alias(f"n_{s}") for s in _SIDES])
    known = [i for i, c in enumerate(columns) if c in ours.columns]

    def differ(a: str, b: str) -> Column:
        out = F.lit(False)
        for i in known:
            out = out | (F.coalesce(F.col(f"{a}.c{i}"), F.lit("")) != F.coalesce(F.col(f"{b}.c{i}"), F.lit("")))
        return out

    b, t, o = (F.col(f"n_{s}") > 0 for s in _SIDES)
    lost = F.when(t, F.when(differ("theirs", "base"), "conflict").otherwise("dropped")).when(
        o, F.when(differ("ours", "base"), "conflict").otherwise("dropped")).otherwise("dropped")
    row_class = (F.when(F.greatest(*[F.col(f"n_{s}") for s in _SIDES]) > 1, "repeated").when(t & o, "merged")
                 .when(b, lost).when(t, "theirs").otherwise("ours"))
    cells = F.array(*[_cell(i, c, i not in known, prefer) for i, c in enumerate(columns)])
    return met.select(*keys, row_class.alias("row_class"), F.when(row_class == "merged", cells).alias("cells"),
                      "theirs", "ours", (t & (F.lit(prefer) == "theirs") | o & (F.lit(prefer) == "ours")).alias("__stays"))


def changed_cells(merged: DataFrame, keys=KEYS) -> DataFrame:
    """The keys, column, class, base, theirs, ours, value of each cell that a
    side changed."""
    return merged.select(*keys, F.explode(F.filter("cells", lambda c: c["class"] != "same")).alias("c")).select(*keys, "c.*")


def merged_rows(merged: DataFrame, theirs: DataFrame, keys=KEYS) -> DataFrame:
    """The target after the merge, in the target's columns."""
    columns = [c for c in theirs.columns if c not in keys]
    side = F.coalesce("theirs", "ours")  # a row of one side alone
    out = merged.where((F.col("row_class").isin("merged", "ours", "theirs"))
                       | ((F.col("row_class") == "conflict") & F.col("__stays"))).select(
        *keys, *[F.when(F.col("row_class") == "merged", F.col("cells")[i]["value"])
                 .otherwise(F.coalesce(side[f"c{i}"], F.lit(""))).alias(c) for i, c in enumerate(columns)])
    again = merged.where(F.col("row_class") == "repeated").select(F.struct(*keys).alias("__k"))
    kept = theirs.select(*[F.col(f"`{k}`").cast("string").alias(k) for k in keys], *[
        F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in columns])
    kept = kept.join(again, F.struct(*[F.col(k) for k in keys]) == F.col("__k"), "left_semi")
    return out.unionByName(kept).select(*theirs.columns)
