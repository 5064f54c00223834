"""Identifications that are asked for once and used while they are fresh."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.operators.identify import any_identified, unique_lookup
from concord.plans.files import delete, names, publish_text, read_text
from concord.plans.store import unexpired
from concord.session import stage

KEYS = ["id_type", "id_value"]
ANSWER = "id_type string, id_value string, found_figi string, found_name string, found_symbol string"
ENTRY = f"{ANSWER}, created_at bigint"


@dataclass(frozen=True)
class CachedLookup:
    """Answers kept under ``root``, one per key, for ``ttl`` seconds (zero: for ever).

    ``ask`` takes the distinct queries that are not known (``id_type, id_value, security_type``) and gives a
    lookup. Entries are written to a new folder, which a small file then names, so a
    reader sees the entries before a save or after it.
    """

    spark: SparkSession
    root: str
    ask: Callable[[DataFrame], DataFrame]
    ttl: int = 7 * 24 * 3600

    def _versions(self) -> list[int]:
        return sorted(int(n[:-4]) for n in names(self.spark, self.root) if n.endswith(".txt"))

    def entries(self) -> DataFrame:
        versions = self._versions()
        if not versions:
            return self.spark.createDataFrame([], ENTRY)
        folder = read_text(self.spark, f"{self.root}/{versions[-1]:09d}.txt")
        return self.spark.read.schema(ENTRY).parquet(f"{self.root}/{folder}")

    def resolve(self, queries: DataFrame, now: Column) -> DataFrame:
        """The lookup for ``queries``: known answers, and new ones for the keys without.

        New answers are kept only if at least one id was found, and of them only those with an id, so
        a service that is down is asked again.
        """
        seconds = F.unix_seconds(now)
        known = unexpired(self.entries(), seconds, self.ttl)
        asked = stage(queries.join(known, KEYS, "left_anti"), "lookup-asked")
        known = known.select(*KEYS, "found_figi", "found_name", "found_symbol", "created_at")
        if asked.isEmpty():
            return known.drop("created_at")
        new = stage(unique_lookup(self.ask(asked)).withColumn("created_at", seconds), "lookup-answers")
        if any_identified(new):
            self._keep(known.unionByName(new.filter(F.col("found_figi").isNotNull())))
        return known.unionByName(new).drop("created_at")

    def _keep(self, entries: DataFrame) -> None:
        versions = self._versions()
        number = (versions[-1] if versions else 0) + 1
        folder = f"entries-{number:09d}"
        entries.write.mode("overwrite").parquet(f"{self.root}/{folder}")
        publish_text(self.spark, f"{self.root}/{number:09d}.txt", folder)
        for old in versions[:-1]:  # the one before stays for those who read it
            delete(self.spark, f"{self.root}/{old:09d}.txt")
            delete(self.spark, f"{self.root}/entries-{old:09d}")
