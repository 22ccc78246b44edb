"""Budget alerts: the transaction with which a budget's spending first reaches
a share of its limit.

Budgets hold for a category (null: all) and from a day up to another, exclusive
(null: open).  They meet transactions in a binned interval join: a budget is
repeated for each month it touches, a transaction lies in one, and the equality
of category and month deals both out; the days are compared within.  Spending is
a running sum over each budget's transactions in their order, carried over the
borders of segments (``segments.running_sum``), so a budget of any size is cut.

Definitions: transactions without a day or an amount spend nothing and raise no
alert; a negative amount gives spending back, and the first time counts.
Transactions of one day follow in the order of their ids.  A limit of zero or
less is reached by the first transaction that makes the sum zero or more.
Budgets with the same id are the caller's error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeledger.operators import segments

#: Shares of the limit at which alerts are raised.
SHARES = (0.5, 0.8, 1.0)
_MONEY = "decimal(38,4)"


def _months(first, last):
    """All months from the one of ``first`` to the one of ``last``."""
    return F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("interval 1 month"))


def matched(transactions: DataFrame, budgets: DataFrame) -> DataFrame:
    """Each transaction (id, day, category, amount) with each budget (budget_id,
    category, valid_from, valid_to, budget_limit) that it counts in."""
    tx = transactions.where("day IS NOT NULL AND amount IS NOT NULL").select(
        "id", "day", F.col("category").alias("tx_category"), F.col("amount").cast("decimal(20,4)").alias("amount"),
        F.trunc("day", "month").alias("month"))
    span = tx.agg(F.min("day").alias("d0"), F.max("day").alias("d1")).first()
    b = budgets.select("budget_id", F.col("category").alias("b_category"), "valid_from", "valid_to", "budget_limit")
    # Open and far ends: no month outside the transactions' own is needed.
    first = F.greatest(F.coalesce("valid_from", F.lit(span.d0)), F.lit(span.d0))
    last = F.least(F.coalesce(F.date_sub("valid_to", 1), F.lit(span.d1)), F.lit(span.d1))
    b = b.where(first <= last).withColumn("b_month", F.explode(_months(first, last)))
    inside = ((F.col("day") >= F.coalesce("valid_from", "day"))
              & (F.col("valid_to").isNull() | (F.col("day") < F.col("valid_to"))))
    of_one = tx.join(b.where("b_category IS NOT NULL"),
                     (F.col("month") == F.col("b_month")) & (F.col("tx_category") == F.col("b_category")) & inside)
    of_all = tx.join(b.where("b_category IS NULL"), (F.col("month") == F.col("b_month")) & inside)
    return of_one.unionByName(of_all).select("budget_id", "budget_limit", "id", "day", "amount")


def spending(transactions: DataFrame, budgets: DataFrame, segment_rows: int = segments.SEGMENT_ROWS) -> DataFrame:
    """``matched`` rows with ``spent``, the budget's sum up to and with each."""
    rows = matched(transactions, budgets)
    return segments.running_sum(rows, ["budget_id"], [F.col("day"), F.col("id")], F.col("amount"), "spent", segment_rows)


def alerts(transactions: DataFrame, budgets: DataFrame, shares=SHARES,
           segment_rows: int = segments.SEGMENT_ROWS) -> DataFrame:
    """(budget_id, share, day, id, spent): for each budget and share of its limit
    that is reached, the first transaction that reaches it."""
    rows = spending(transactions, budgets, segment_rows).withColumn(
        "share", F.explode(F.array(*[F.lit(float(s)) for s in shares])))
    limit = (F.col("budget_limit").cast("decimal(20,4)") * F.col("share").cast("decimal(6,4)")).cast(_MONEY)
    hit = rows.where(F.col("spent") >= limit).groupBy("budget_id", "share").agg(
        F.min(F.struct("day", "id", "spent")).alias("at"))
    return hit.select("budget_id", "share", "at.day", "at.id", "at.spent")
