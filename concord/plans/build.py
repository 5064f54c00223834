"""The full build: landed feeds to canonical rows, and the seed job that stores them."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.operators.enrich import append_rows, find_quotes, lei_rows
from concord.operators.fx import to_usd
from concord.operators.golden import identifiers, merge
from concord.operators.identify import identify, no_lookup, queries_of
from concord.operators.validate import accepted, revalidated
from concord.plans.lookup import CachedLookup
from concord.plans.store import Store
from concord.schema import CANONICAL_SCHEMA, FINANCIAL_FIELDS, IDENTITY_FIELDS
from concord.session import stage
from concord.sources import feeds as discovery
from concord.sources.gates import feed_counts, require_rows
from concord.sources.reference import enrichment_rows, lei_fields, quote_fields, with_quote_keys

#: Enrichment rows follow all discovery rows in source order, in the order of the feeds.
FIRST_ENRICHMENT_RANK = 100


@dataclass(frozen=True)
class EnrichmentFeed:
    """A source asked once per group.

    ``find`` takes the groups' identifiers and gives at most one row per group that has a
    hit, with its ``share_class_figi``; ``fields(now)`` projects that row onto the record.
    """

    name: str
    find: Callable[[DataFrame], DataFrame]
    fields: Callable[[Column], Mapping[str, Column]]


def quote_feed(search: DataFrame, quotes: DataFrame) -> EnrichmentFeed:
    """Quotes found through the candidate search."""

    def find(ids: DataFrame) -> DataFrame:
        return with_quote_keys(find_quotes(ids, search, quotes).select("share_class_figi", "q"))

    return EnrichmentFeed("quotes", find, quote_fields)


def lei_feed(isin_lei: DataFrame) -> EnrichmentFeed:
    """Legal entity ids looked up by ISIN."""
    return EnrichmentFeed("lei", lambda ids: lei_rows(ids, isin_lei), lambda now: lei_fields())


@dataclass(frozen=True)
class Inputs:
    """Frames the build reads. Leaving an optional one out contributes no rows. ``lookup`` is a frame of
    answers, or a cache that asks for what it does not know."""

    raw: DataFrame
    rates: DataFrame
    lookup: DataFrame | CachedLookup | None = None
    enrichment: Sequence[EnrichmentFeed] = ()


def nested(flat: DataFrame, *extra: str) -> DataFrame:
    """Identity and financials as structs."""
    return flat.select(
        F.struct(*IDENTITY_FIELDS).alias("identity"),
        F.struct(*FINANCIAL_FIELDS).alias("financials"),
        *extra,
    )


def flattened(canonical: DataFrame) -> DataFrame:
    rest = [c for c in canonical.columns if c not in ("identity", "financials")]
    return canonical.select("identity.*", "financials.*", *rest)


def payloads(canonical: DataFrame) -> DataFrame:
    """Both halves as JSON text with nulls written out, for export."""
    options = {"ignoreNullFields": "false"}
    return canonical.select(
        F.col("identity.share_class_figi").alias("share_class_figi"),
        F.to_json("identity", options).alias("identity"),
        F.to_json("financials", options).alias("financials"),
        *[c for c in canonical.columns if c == "snapshot_date"],
    )


def from_payloads(rows: DataFrame) -> DataFrame:
    """Typed canonical rows from exported JSON text; quoted decimals are accepted."""
    identity, financials = CANONICAL_SCHEMA["identity"], CANONICAL_SCHEMA["financials"]
    return rows.select(
        F.from_json("identity", identity.dataType).alias("identity"),
        F.from_json("financials", financials.dataType).alias("financials"),
        *[c for c in rows.columns if c == "snapshot_date"],
    )


def identified_rows(inputs: Inputs, now: Column) -> DataFrame:
    """Validated rows in dollars with their global id; both steps observe their counts."""
    dollars = to_usd(accepted(inputs.raw), inputs.rates, counters="converted")
    if isinstance(inputs.lookup, CachedLookup):
        dollars = stage(dollars, "dollars")
        lookup = inputs.lookup.resolve(queries_of(dollars), now)
    else:
        lookup = no_lookup(dollars) if inputs.lookup is None else inputs.lookup
    return identify(dollars, lookup, counters="identified")


def enrichment_of(ids: DataFrame, inputs: Inputs, now: Column) -> list[DataFrame]:
    """At most one extra row per group and feed; a group without a hit stays as it is."""
    extra = []
    for rank, feed in enumerate(inputs.enrichment, FIRST_ENRICHMENT_RANK):
        rows = enrichment_rows(feed.find(ids), feed.fields(now), feed.name, rank)
        extra.append(to_usd(rows, inputs.rates))
    return extra


def build(inputs: Inputs, now: Column | None = None) -> DataFrame:
    """Canonical rows. The identified rows feed several passes, so they are staged once."""
    now = F.current_timestamp() if now is None else now
    rows = stage(identified_rows(inputs, now), "identified")
    extra = []
    if inputs.enrichment:
        ids = stage(identifiers(rows), "identifiers")
        extra = [stage(e, "enrichment") for e in enrichment_of(ids, inputs, now)]
    return nested(revalidated(merge(append_rows(rows, *extra))))


def read_inputs(spark: SparkSession, root: str, now: Column, **options) -> DataFrame:
    """Checked discovery rows under ``root``, staged; raises if all feeds are empty."""
    raw = discovery.read_discovery(spark, root, now, **options)
    names = [f.name for f in options.get("feeds", discovery.DISCOVERY_FEEDS)]
    registry = spark.createDataFrame([(n,) for n in names], "feed string")
    require_rows(feed_counts(raw, registry))
    return raw


def record_store(spark: SparkSession, root: str) -> Store:
    """Store of canonical records: key and identity columns, dated financial columns."""
    identity = CANONICAL_SCHEMA["identity"].dataType
    financials = CANONICAL_SCHEMA["financials"].dataType
    key = identity["share_class_figi"]
    snapshot = [key, *financials.fields, CANONICAL_SCHEMA["snapshot_date"]]
    return Store(spark, root, identity, type(identity)(snapshot))


def seed(
    spark: SparkSession,
    inputs: Inputs,
    store: Store,
    now: Column | None = None,
    snapshot_date: datetime.date | str | None = None,
) -> None:
    """Build and save one snapshot."""
    store.save(flattened(build(inputs, now)), snapshot_date)
