"""The store of dated records: current rows and snapshots, published together.

Snapshots are laid out by date and by a bucket of the key. Current rows hold each key's identity with
its newest snapshot, by the same bucket, so the latest records are one scan without a join, one key
is one bucket, and a key's history is one small folder per date.

A save writes new folders for the (date, bucket) parts it touches and never changes old ones. Then it
publishes a manifest, one small file that names the folders of every part of both tables. Readers resolve
the newest manifest once, so they see the pair of tables of one save, whatever is being written or
has failed meanwhile. A bucket of one date is the work of one task: choose ``buckets`` so that it fits.
"""

from __future__ import annotations

import datetime
import json
import uuid
from collections.abc import Collection, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concord.operators.dedup import last_per_key
from concord.plans.files import delete, names, publish_text, read_text
from concord.session import stage

KEY = "share_class_figi"


def utc_date() -> datetime.date:
    return datetime.datetime.now(datetime.UTC).date()


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """New rows replace old ones with the same keys; within the batch the last wins.

    Both are ranked together, so there is one shuffle. Columns that ``old`` does not have
    only serve the order and are left out.
    """
    both = old.withColumn("_new", F.lit(0)).unionByName(
        new.withColumn("_new", F.lit(1)), allowMissingColumns=True
    )
    winners = last_per_key(both, [F.col(k) for k in keys], ["_new", *order])
    return winners.select(*old.columns)


MANIFESTS = "manifests"


@dataclass(frozen=True)
class View:
    """Both tables as one save left them."""

    store: Store
    version: int
    #: table -> partition folder -> version of the save that wrote it
    parts: dict[str, dict[str, int]]

    def _read(self, table: str, folders: Iterable[str], schema: T.StructType) -> DataFrame:
        root = f"{self.store.root}/{table}"
        paths = [f"{root}/version={self.parts[table][f]}/{f}" for f in folders]
        spark = self.store.spark
        if not paths:
            return spark.createDataFrame([], schema).drop("key_bucket")
        placed = T.StructType([*schema, T.StructField("version", T.LongType())])
        found = spark.read.schema(placed).option("basePath", root).parquet(*paths)
        return found.drop("version", "key_bucket")

    def _current(self, buckets: Iterable[int] | None = None) -> DataFrame:
        known = self.parts["current"]
        wanted = known if buckets is None else [f for b in buckets if (f := f"key_bucket={b}") in known]
        return self._read("current", wanted, self.store.current_schema)

    def snapshots(self, from_date=None, to_date=None, buckets: Collection[int] | None = None) -> DataFrame:
        """Snapshots of an inclusive range of dates; no folder of another date is opened."""
        low, high = str(from_date or ""), str(to_date or "9999-12-31")
        folders = []
        for folder in self.parts["snapshots"]:
            date, bucket = (part.partition("=")[2] for part in folder.split("/"))
            if low <= date <= high and (buckets is None or int(bucket) in buckets):
                folders.append(folder)
        return self._read("snapshots", folders, self.store.history_schema)

    def identities(self) -> DataFrame:
        return self._current().select(*self.store.identity_schema.names)

    def latest(self) -> DataFrame:
        """Each identity with its newest snapshot: a scan."""
        return self._current()

    def by_key(self, key, required: bool = False) -> DataFrame:
        """Latest row of one key, from its bucket alone. ``required`` makes an absent key an
        error (``LookupError``) instead of an empty frame."""
        found = self._current([self.store.bucket_of(key)]).filter(F.col(self.store.key) == F.lit(key))
        if required and found.isEmpty():
            raise LookupError(f"no record with key {key}")
        return found

    def history(self, key, from_date=None, to_date=None, required: bool = False) -> DataFrame:
        """All snapshots of one key in the date range, oldest first; ``required`` as in :meth:`by_key`."""
        one = self.by_key(key, required).select(*self.store.identity_schema.names)
        kept = self.snapshots(from_date, to_date, [self.store.bucket_of(key)]).filter(F.col(self.store.key) == F.lit(key))
        return one.join(kept, self.store.key).orderBy("snapshot_date")

    def dates(self) -> list[str]:
        """Dates with snapshots, from the manifest alone."""
        return sorted({f.split("/")[0].partition("=")[2] for f in self.parts["snapshots"]})


@dataclass(frozen=True)
class Store:
    """A store under ``root``. ``identity_schema`` and ``snapshot_schema`` hold ``key``.

    One writer saves at a time; a second one that saves meanwhile fails when it publishes.
    """

    spark: SparkSession
    root: str
    identity_schema: T.StructType
    snapshot_schema: T.StructType
    key: str = KEY
    buckets: int = 64

    def _facts(self) -> list[T.StructField]:
        """Columns of a snapshot besides its key and date."""
        return [f for f in self.snapshot_schema if f.name not in ("snapshot_date", self.key)]

    @property
    def current_schema(self) -> T.StructType:
        dated = [T.StructField("snapshot_date", T.DateType()), T.StructField("key_bucket", T.IntegerType())]
        return T.StructType([*self.identity_schema, *self._facts(), *dated])

    @property
    def history_schema(self) -> T.StructType:
        dated = [T.StructField("snapshot_date", T.DateType()), T.StructField("key_bucket", T.IntegerType())]
        return T.StructType([self.snapshot_schema[self.key], *self._facts(), *dated])

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def bucket_of(self, key) -> int:
        """The bucket of one key; the engine folds the expression, no job runs."""
        one = self.spark.createDataFrame([(key,)], T.StructType([self.identity_schema[self.key]]))
        return one.select(self._bucket()).first()[0]

    # --- reading

    def versions(self) -> list[int]:
        found = names(self.spark, f"{self.root}/{MANIFESTS}")
        return sorted(int(n[:-5]) for n in found if n.endswith(".json"))

    def view(self, version: int | None = None) -> View:
        """The tables at a version, the newest published one by default."""
        if version is None:
            version = max(self.versions(), default=0)
        if not version:
            return View(self, 0, {"current": {}, "snapshots": {}})
        text = read_text(self.spark, f"{self.root}/{MANIFESTS}/{version:012d}.json")
        return View(self, version, json.loads(text))

    def identities(self) -> DataFrame:
        return self.view().identities()

    def snapshots(self) -> DataFrame:
        return self.view().snapshots()

    def latest(self) -> DataFrame:
        return self.view().latest()

    def by_key(self, key, required: bool = False) -> DataFrame:
        return self.view().by_key(key, required)

    def history(self, key, from_date=None, to_date=None, required: bool = False) -> DataFrame:
        return self.view().history(key, from_date, to_date, required)

    def dates(self) -> DataFrame:
        """``snapshot_date`` of every date with snapshots, in a local frame."""
        days = [(datetime.date.fromisoformat(d),) for d in self.view().dates()]
        return self.spark.createDataFrame(days, "snapshot_date date")

    def count_snapshots(self) -> int:
        return len(self.view().dates())

    def is_stale(self, ttl_minutes: int = 1440) -> bool:
        """No snapshot, or the latest is before today; a TTL of zero switches it off."""
        if ttl_seconds(ttl_minutes) == 0:
            return False
        return max(self.view().dates(), default="") < str(utc_date())

    def ensure_fresh(self, refresh=None, ttl_minutes: int = 1440) -> bool:
        """Run the hook if the store is stale; tells whether it ran."""
        if refresh is None or not self.is_stale(ttl_minutes):
            return False
        refresh()
        return True

    def has_rows(self, table: str) -> bool:
        """The table exists and holds at least one row (no part is written without rows)."""
        return bool(self.view().parts[{"identities": "current", "snapshots": "snapshots"}[table]])

    # --- writing

    def save(
        self,
        batch: DataFrame,
        snapshot_date: datetime.date | str | None = None,
        order: tuple[str, ...] = (),
    ) -> None:
        """Upsert a batch. The date is the argument, else the batch's own
        ``snapshot_date`` column, else today (UTC).

        The batch is evaluated once, before anything is written, and the date is fixed once. A
        row without a date is an error, since its partition could not be merged. Both tables
        become visible together, or not at all.
        """
        if snapshot_date is None and "snapshot_date" not in batch.columns:
            snapshot_date = utc_date()
        if snapshot_date is not None:
            batch = batch.withColumn("snapshot_date", F.lit(str(snapshot_date)).cast("date"))
        tie = list(order)
        needed = [*self.identity_schema.names, *self.snapshot_schema.names, "snapshot_date", *tie]
        placed = batch.select(*dict.fromkeys(needed)).withColumn("key_bucket", self._bucket())
        batch = stage(placed, "save-batch")
        # one row per part of the store, not per record
        touched = [(r[0], r[1]) for r in batch.select("snapshot_date", "key_bucket").distinct().collect()]
        if any(date is None for date, _ in touched):
            raise ValueError("a row of the batch has no snapshot date")
        if not touched:
            return
        before = self.view()
        version = before.version + 1
        run = f"{version}{uuid.uuid4().int % 10**9:09d}"  # what a failed save of this version wrote stays apart
        parts = {
            "snapshots": [f"snapshot_date={date}/key_bucket={b}" for date, b in touched],
            "current": sorted({f"key_bucket={b}" for _, b in touched}),
        }
        old = {t: before._read(t, [f for f in parts[t] if f in before.parts[t]], getattr(self, f"{s}_schema")) for t, s in (("snapshots", "history"), ("current", "current"))}
        jobs = [
            ("snapshots", run, self._merged_snapshots(old["snapshots"], batch, tie), "snapshot_date", "key_bucket"),
            ("current", run, self._merged_current(old["current"], batch, tie), "key_bucket"),
        ]
        with ThreadPoolExecutor(len(jobs)) as pool:  # both write new folders, so neither waits for the other
            for written in [pool.submit(self._write, *job) for job in jobs]:
                written.result()
        after = {t: before.parts[t] | dict.fromkeys(parts[t], int(run)) for t in parts}
        publish_text(self.spark, f"{self.root}/{MANIFESTS}/{version:012d}.json", json.dumps(after))

    def _merged_snapshots(self, old: DataFrame, batch: DataFrame, tie: list[str]) -> DataFrame:
        """The touched parts after the save. Old and new rows of a part meet in one task by a single
        shuffle; the rank by key and the order within the file use the same sort."""
        names = [self.key, *[f.name for f in self._facts()], "snapshot_date", "key_bucket"]
        both = old.withColumns({"key_bucket": self._bucket(), "_new": F.lit(0)}).unionByName(
            batch.select(*dict.fromkeys([*names, *tie])).withColumn("_new", F.lit(1)), allowMissingColumns=True
        )
        dealt = both.repartition("snapshot_date", "key_bucket")
        keys = [F.col(c) for c in ("snapshot_date", "key_bucket", self.key)]
        return last_per_key(dealt, keys, ["_new", *tie]).select(*names)

    def _merged_current(self, old: DataFrame, batch: DataFrame, tie: list[str]) -> DataFrame:
        """Touched buckets after the save: the identity of the last save that has the key, with
        the facts of the newest date."""
        identity, facts = self.identity_schema.names, [f.name for f in self._facts()]
        names = dict.fromkeys([*identity, *facts, "snapshot_date", *tie, "key_bucket"])
        both = old.withColumns({"key_bucket": self._bucket(), "_new": F.lit(0)}).unionByName(
            batch.select(*names).withColumn("_new", F.lit(1)), allowMissingColumns=True
        )
        dealt = both.repartition("key_bucket")
        rest = [c for c in identity if c != self.key]
        merged = dealt.groupBy("key_bucket", self.key).agg(
            F.max_by(F.struct(F.lit(0).alias("_"), *rest), F.struct("_new", "snapshot_date", *tie)).alias("i"),
            F.max_by(F.struct("snapshot_date", *facts), F.struct("snapshot_date", "_new", *tie)).alias("f"),
        )
        columns = {self.key: F.col(self.key)} | {c: F.col(f"i.{c}") for c in rest} | {c: F.col(f"f.{c}") for c in facts}
        shown = [columns[c].alias(c) for c in [*identity, *facts]]
        return merged.select(*shown, F.col("f.snapshot_date").alias("snapshot_date"), "key_bucket")

    def _write(self, table: str, run: str, rows: DataFrame, *partition: str) -> None:
        # sorted by key, so that a lookup skips row groups by their min and max
        rows.sortWithinPartitions(*partition, self.key).write.partitionBy(*partition).parquet(f"{self.root}/{table}/version={run}")

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete the parts that the last ``keep`` manifests do not name, and the manifests before them.

        Readers that resolved an older version lose it; folders of failed saves go too, so do not
        run it beside a save. Returns what was deleted.
        """
        versions = self.versions()
        old, kept = versions[:-keep], versions[-keep:]

        def named(numbers: list[int]) -> set[str]:
            views = [self.view(n) for n in numbers]
            return {f"{t}/version={v}/{folder}" for w in views for t, parts in w.parts.items() for folder, v in parts.items()}

        used = named(kept)
        live = {"/".join(path.split("/")[:2]) for path in used}
        gone = [path for path in named(old) - used if "/".join(path.split("/")[:2]) in live]
        for t in ("current", "snapshots"):
            gone += [f"{t}/{n}" for n in names(self.spark, f"{self.root}/{t}") if f"{t}/{n}" not in live]
        gone += [f"{MANIFESTS}/{v:012d}.json" for v in old]
        for path in gone:
            delete(self.spark, f"{self.root}/{path}")
        return sorted(gone)


def latest(identities: DataFrame, snapshots: DataFrame, key: str = KEY) -> DataFrame:
    """Each identity with its newest snapshot."""
    newest = last_per_key(snapshots, F.col(key), ["snapshot_date"])
    return identities.join(newest, key, "inner")


def history(
    identities: DataFrame,
    snapshots: DataFrame,
    key: str = KEY,
    value=None,
    from_date=None,
    to_date=None,
) -> DataFrame:
    """Current identity with every snapshot in the inclusive date range, oldest first."""
    if value is not None:
        identities = identities.filter(F.col(key) == F.lit(value))
    kept = snapshots
    if from_date is not None:
        kept = kept.filter(F.col("snapshot_date") >= F.lit(str(from_date)).cast("date"))
    if to_date is not None:
        kept = kept.filter(F.col("snapshot_date") <= F.lit(str(to_date)).cast("date"))
    return identities.join(kept, key, "inner").orderBy("snapshot_date")


def count_dates(snapshots: DataFrame) -> DataFrame:
    return snapshots.agg(F.count_distinct("snapshot_date").alias("snapshot_dates"))


def staleness(snapshots: DataFrame, today: Column) -> DataFrame:
    newest = F.max("snapshot_date")
    return snapshots.agg(
        newest.alias("latest_date"), F.coalesce(newest < today, F.lit(True)).alias("stale")
    )


def ttl_seconds(minutes: int = 1440) -> int:
    """Seconds of a time-to-live in minutes; negative values are an error."""
    if minutes < 0:
        raise ValueError("the time-to-live cannot be negative")
    return minutes * 60


def unexpired(entries: DataFrame, now: Column, ttl: int) -> DataFrame:
    """Cache entries not older than the TTL (seconds); zero keeps all."""
    return entries if ttl == 0 else entries.filter(now - F.col("created_at") <= ttl)


def cache_put(entries: DataFrame | None, new: DataFrame, tie: list[str]) -> DataFrame:
    """Last write per ``(cache_name, key)`` wins; ``tie`` orders writes of one second."""
    known = entries if entries is not None else new.drop(*tie).limit(0)
    return upsert(known, new, ["cache_name", "key"], ["created_at", *tie])


def cache_get(entries: DataFrame, cache_name: str, now: Column, ttl: int, key=None) -> DataFrame:
    """Unexpired entries of one cache, or of one key in it."""
    hit = unexpired(entries, now, ttl).filter(F.col("cache_name") == cache_name)
    return hit if key is None else hit.filter(F.col("key") == key)
