"""History kept in keyed state: versions as a feed, without rereading Bronze.

Each key's state holds its open version (its row, its place in the key's order)
and the events of unknown types after it.  An event behind them closes the open
version and opens the next: two rows of the feed.  An event that arrives late,
before something that was told already, moves the numbers of what follows; the
state is corrected, and the key's whole history is told again from Bronze.  The
state is in the stream's checkpoint and comes back with it after a restart.

A micro-batch is written once to the shared folder (running it again would ask
the state again), then its events go to a Bronze folder of their own and its
versions to one of the feed; a retry replaces both.  The history is the feed's
latest row of each key and version.

A key's events of one micro-batch are sorted in one task; ``max_files`` bounds
them.  Unknown types between two versions are kept in the state until the next
version comes.
"""

from __future__ import annotations

import bisect
import hashlib
import json
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import BooleanType, StructField, StructType

from lakeledger import schemas
from lakeledger.functions import scalars as S
from lakeledger.operators import bronze as B
from lakeledger.operators import silver as SV
from lakeledger.session import checkpoint_dir
from lakeledger.sources import tables as T
from lakeledger.streaming.streams import _triggered, page_stream

KEYS = ["item_id", "transaction_id"]
_OUT = ("item_id string, transaction_id string, kind string, row string, version long, valid_from_ts string, "
        "valid_to_ts string, is_current boolean, change_type string")
_RECORDS = f"array<struct<{', '.join(c.replace(' ', ': ') for c in _OUT.split(', ')[2:])}>>"
#: Records of a key in one text.
TOLD = 1000


def _order() -> Column:
    """The event's place in its key's order as a text: JSON of a list whose
    parts compare as those of the order, nulls first."""
    parts = [F.coalesce(F.unix_micros(F.try_to_timestamp("run_ts")).cast("string"), F.lit("")),
             F.coalesce(F.unix_micros(F.try_to_timestamp("ingested_at")).cast("string"), F.lit("")),
             F.coalesce("page_name", F.lit("")), F.col("type_ord").cast("string"), F.col("pos").cast("string"),
             F.coalesce("event_id", F.lit(""))]
    return F.to_json(F.array(*parts))


def _place(text: str) -> list:
    run, seen, page, kind, pos, event = json.loads(text)
    number = [(0, 0) if x == "" else (1, int(x)) for x in (run, seen)]
    return [*number, page, int(kind), int(pos), event]


class History:
    """The state of one key."""

    def __init__(self, text: str | None):
        got = json.loads(text) if text else {}
        self.base: int = got.get("base", 0)  # place of the open version
        self.open: dict | None = got.get("open")  # order, row, ts, type
        self.after: list = got.get("after", [])  # (order, ts) of unknown types behind it
        self.open_place = _place(self.open["order"]) if self.open is not None else None
        self.places = [_place(o) for o, _ in self.after]

    def dump(self) -> str:
        return json.dumps({"base": self.base, "open": self.open, "after": self.after})

    def take(self, at: list, event: dict, known: bool) -> tuple[bool, list[tuple]]:
        """Whether the event, whose place is ``at``, is late; versions that it
        ends: (version, open event, valid_to)."""
        if self.open is not None and at < self.open_place:
            self.base += 1
            return True, []
        k = bisect.bisect_right(self.places, at)
        late = k < len(self.after)
        if not known:
            self.after.insert(k, [event["order"], event["ts"]])
            self.places.insert(k, at)
            return late, []
        ended = [(self.base, self.open, event["ts"])] if self.open is not None else []
        self.base, self.open, self.after = self.base + k + 1, event, self.after[k:]
        self.open_place, self.places = at, self.places[k:]
        return late, ended

    def present(self) -> tuple | None:
        if self.open is None:
            return None
        return self.base, self.open, self.after[-1][1] if self.after else None


def _advance(known: tuple[str, ...]):
    def step(key: tuple, parts: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = [(_place(order), order, ts, kind, row) for p in parts
                for order, ts, kind, row in zip(*(p[c].tolist() for c in ("order", "ts", "kind", "row")))]
        rows.sort(key=lambda r: r[0])
        history = History(state.get[0] if state.exists else None)
        late, told = False, {}
        for at, order, ts, kind, row in rows:
            was_late, ended = history.take(at, {"order": order, "row": row, "ts": ts, "kind": kind}, kind in known)
            late = late or was_late
            told.update((v, (e, to, False)) for v, e, to in ended)
        if (now := history.present()) is not None:
            told[now[0]] = (now[1], now[2], now[2] is None)
        state.update((history.dump(),))
        out = [{"kind": "event", "row": r[4]} for r in rows]
        if late:
            out.append({"kind": "late"})
        else:
            out += [{"kind": "version", "row": e["row"], "version": v, "valid_from_ts": e["ts"], "valid_to_ts": to,
                     "is_current": current, "change_type": e["kind"]} for v, (e, to, current) in told.items()]
        # One text for many records: a frame of them for each key costs more than all else.
        texts = [json.dumps(out[i:i + TOLD]) for i in range(0, len(out), TOLD)]
        yield pd.DataFrame({"item_id": [key[0]] * len(texts), "transaction_id": [key[1]] * len(texts), "told": texts})
    return step


def _events(rows: DataFrame, built_at: str) -> DataFrame:
    known = rows.withColumns({k: SV._astype_str(k) for k in (*KEYS, "event_type")})
    return known.select(
        *KEYS, _order().alias("order"), F.coalesce(F.nullif("run_ts", F.lit("")), F.lit(built_at)).alias("ts"),
        S.normalize_type("event_type").alias("kind"),
        F.to_json(F.struct(*schemas.BRONZE.fieldNames()), {"ignoreNullFields": "false"}).alias("row"))


def _told(stage: DataFrame, built_at: str) -> DataFrame:
    """Rows of Silver from the version records of a batch."""
    row = F.from_json("row", schemas.BRONZE)
    h = stage.where("kind = 'version'").select(
        row.alias("r"), "valid_from_ts", "valid_to_ts", "is_current",
        F.col("change_type").isin(list(SV.BRONZE_SPEC.delete_types)).alias("is_deleted"), "change_type", "version")
    h = h.select("r.*", *[c for c in h.columns if c != "r"])
    return SV.silver_rows(h.withColumn("is_active", F.col("is_current") & ~F.col("is_deleted")), built_at)


def version_batch(spark: SparkSession, batch: DataFrame, batch_id: int, bronze_path: str, feed_path: str,
                  built_at: str) -> None:
    stage_path = f"{checkpoint_dir(spark).rstrip('/')}/versions-{hashlib.md5(feed_path.encode()).hexdigest()}-{batch_id}"
    batch.write.mode("overwrite").parquet(stage_path)
    stage = spark.read.schema(_OUT).parquet(stage_path)
    events = stage.where("kind = 'event'").select(F.from_json("row", schemas.BRONZE).alias("r")).select("r.*")
    B.append_bronze(events, bronze_path, batch_id + 1)
    feed = _told(stage, built_at).withColumn("whole", F.lit(False))
    late = stage.where("kind = 'late'").select(*KEYS)
    if not late.isEmpty():
        all_events = SV._keyed(B.read_bronze(spark, bronze_path)).join(late, KEYS, "left_semi")
        feed = feed.unionByName(SV.silver_from_bronze(all_events, built_at).withColumn("whole", F.lit(True)))
    feed.write.mode("overwrite").parquet(f"{feed_path.rstrip('/')}/batch_id={batch_id + 1}")
    T.remove(spark, stage_path)


def version_stream(rows: DataFrame, bronze_path: str, feed_path: str, checkpoint: str,
                   built_at: str | None = None, available_now: bool = True):
    """Streaming Bronze rows -> Bronze and the feed of versions; returns the
    query."""
    spark, built_at = rows.sparkSession, built_at or SV.now_iso()
    changes = _events(rows, built_at).groupBy(*KEYS).applyInPandasWithState(
        _advance(SV.BRONZE_SPEC.known_types), "item_id string, transaction_id string, told string", "state string",
        "append", GroupStateTimeout.NoTimeout)
    changes = changes.select(*KEYS, F.explode(F.from_json("told", _RECORDS)).alias("r")).select(*KEYS, "r.*")

    def each(batch: DataFrame, batch_id: int) -> None:
        version_batch(spark, batch, batch_id, bronze_path, feed_path, built_at)

    return _triggered(changes.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint),
                      available_now).start()


def page_versions(spark: SparkSession, root: str, bronze_path: str, feed_path: str, checkpoint: str,
                  now: str | None = None, built_at: str | None = None, prefix: str = "",
                  available_now: bool = True, max_files: int | None = None):
    """``version_stream`` of landed page files."""
    pages = page_stream(spark, root, "files", prefix, max_files)
    rows = B.explode_pages(pages, now or S.iso_text(F.current_timestamp()))
    return version_stream(rows, bronze_path, feed_path, checkpoint, built_at, available_now)


def read_history(spark: SparkSession, feed_path: str) -> DataFrame:
    """Silver out of the feed: of the rows told since a key was last told as a
    whole, the latest of each version."""
    columns = schemas.SILVER.fieldNames()
    feed = spark.read.schema(StructType([*schemas.SILVER.fields, StructField("whole", BooleanType())])).parquet(feed_path)  # batch_id: folders
    whole = feed.where("whole").groupBy(*KEYS).agg(F.max("batch_id").alias("since"))
    told = feed.join(whole, KEYS, "left").where(F.col("batch_id") >= F.coalesce("since", F.lit(0)))
    last = told.groupBy(*KEYS, "version").agg(F.max_by(F.struct(*columns), "batch_id").alias("r"))
    return last.select("r.*")
