import pytest

from lakeledger import schemas


def test_conform_adds_drops_orders_and_casts(spark):
    df = spark.createDataFrame([("x", "12.5", "junk", "extra")],
                               "item_id string, amount string, event_year string, other string")
    out = schemas.conform(df, schemas.BRONZE)
    assert out.columns == schemas.BRONZE.fieldNames()
    r = out.first()
    assert r.item_id == "x" and r.amount == 12.5 and r.event_year is None and r.run_id is None
    assert dict(out.dtypes)["event_year"] == "bigint"


def test_require_columns():
    class D:
        columns = ["item_id", "run_ts"]
    with pytest.raises(ValueError, match="event_id"):
        schemas.require_columns(D, {"item_id", "event_id"})
