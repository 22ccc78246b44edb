import pytest

from lakeledger.operators import merge

KEYS = ["item_id", "transaction_id", "version"]


def side(spark, rows, cols):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in KEYS + cols))


def sides(spark):
    cols = ["name", "city"]
    base = [("i", "same", "1", "n", "c"), ("i", "ours", "1", "n", "c"), ("i", "theirs", "1", "n", "c"),
            ("i", "both", "1", "n", "c"), ("i", "conflict", "1", "n", None), (None, "null", None, "n", "c"),
            ("i", "t-gone", "1", "n", "c"), ("i", "t-gone-o-changed", "1", "n", "c"), ("i", "o-gone", "1", "n", "c"),
            ("i", "o-gone-t-changed", "1", "n", "c"), ("i", "gone", "1", "n", "c"), ("i", "twice", "1", "n", "c")]
    theirs = [("i", "same", "1", "n", "c", ""), ("i", "ours", "1", "n", "c", "note"), ("i", "theirs", "1", "N", "c", ""),
              ("i", "both", "1", "X", "c", None), ("i", "conflict", "1", "T", "", ""), (None, "null", None, "n2", "c", ""),
              ("i", "o-gone", "1", "n", "c", ""), ("i", "o-gone-t-changed", "1", "mine", "c", ""),
              ("i", "written", "1", "w", "c", "n"), ("i", "added twice", "1", "a", "c", ""),
              ("i", "twice", "1", "n", "c", "first"), ("i", "twice", "1", "n", "c", "second")]
    ours = [("i", "same", "1", "n", "c"), ("i", "ours", "1", "N", "c"), ("i", "theirs", "1", "n", "c"),
            ("i", "both", "1", "X", "c"), ("i", "conflict", "1", "O", None), (None, "null", None, "n", "d"),
            ("i", "t-gone", "1", "n", "c"), ("i", "t-gone-o-changed", "1", "n", "d"), ("i", "new", "1", "n", None),
            ("i", "added twice", "1", "b", "c"), ("i", "twice", "1", "changed", "c")]
    return side(spark, base, cols), side(spark, theirs, cols + ["notes"]), side(spark, ours, cols)


def test_rows_and_cells(spark):
    base, theirs, ours = sides(spark)
    merged = merge.three_way(base, theirs, ours)
    rows = {r.transaction_id: r.row_class for r in merged.collect()}
    assert rows == {"same": "merged", "ours": "merged", "theirs": "merged", "both": "merged", "conflict": "merged",
                    "null": "merged", "t-gone": "dropped", "t-gone-o-changed": "conflict", "o-gone": "dropped",
                    "o-gone-t-changed": "conflict", "gone": "dropped", "written": "theirs", "new": "ours",
                    "added twice": "merged", "twice": "repeated"}
    cells = {(r.transaction_id, r.column): (r["class"], r.base, r.theirs, r.ours, r.value)
             for r in merge.changed_cells(merged).collect()}
    assert cells == {
        ("ours", "name"): ("ours", "n", "n", "N", "N"), ("ours", "notes"): ("theirs", "", "note", "", "note"),
        ("theirs", "name"): ("theirs", "n", "N", "n", "N"), ("both", "name"): ("both", "n", "X", "X", "X"),
        ("conflict", "name"): ("conflict", "n", "T", "O", "T"),
        ("null", "name"): ("theirs", "n", "n2", "n", "n2"), ("null", "city"): ("ours", "c", "c", "d", "d"),
        ("added twice", "name"): ("conflict", "", "a", "b", "a"), ("added twice", "city"): ("both", "", "c", "c", "c")}


@pytest.mark.parametrize("prefer", ["theirs", "ours"])
def test_merged_rows(spark, prefer):
    base, theirs, ours = sides(spark)
    out = merge.merged_rows(merge.three_way(base, theirs, ours, prefer=prefer), theirs)
    assert out.columns == theirs.columns
    got = sorted((r.transaction_id, r.name, r.city, r.notes) for r in out.collect())
    mine = prefer == "theirs"
    want = [("added twice", "a" if mine else "b", "c", ""), ("both", "X", "c", ""), ("conflict", "T" if mine else "O", "", ""),
            ("new", "n", "", ""), ("null", "n2", "d", ""), ("ours", "N", "c", "note"), ("same", "n", "c", ""),
            ("theirs", "N", "c", ""), ("twice", "n", "c", "first"), ("twice", "n", "c", "second"), ("written", "w", "c", "n"),
            ("o-gone-t-changed", "mine", "c", "") if mine else ("t-gone-o-changed", "n", "d", "")]
    assert got == sorted(want)


def test_empty_sides_and_bad_preference(spark):
    base, theirs, ours = sides(spark)
    none = merge.merged_rows(merge.three_way(base.limit(0), theirs.limit(0), ours.limit(0)), theirs)
    assert none.count() == 0
    first = merge.merged_rows(merge.three_way(base.limit(0), theirs.limit(0), ours), theirs)
    assert first.count() == ours.count()
    with pytest.raises(ValueError):
        merge.three_way(base, theirs, ours, prefer="mine")
