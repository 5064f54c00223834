"""Statistics over the store: coverage, key figures, coherence, cap tiers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concord.functions.display import display_date, display_usd
from concord.operators.ranks import upper_median
from concord.session import stage

# Cap tiers (name, lower bound inclusive, upper bound exclusive), the
# tolerance of the cap check, and the identity fields whose coverage is reported.
CAP_TIERS = (
    ("Mega (> $200B)", 200e9, None),
    ("Large ($10B–$200B)", 10e9, 200e9),
    ("Mid ($2B–$10B)", 2e9, 10e9),
    ("Small ($300M–$2B)", 300e6, 2e9),
    ("Micro (< $300M)", 0.0, 300e6),
)
CAP_TOLERANCE = 0.25
COVERAGE_FIELDS = ("isin", "cusip", "cik", "lei")
ALWAYS_PRESENT = ("name", "symbol", "share class figi")


def latest_slice(snapshots: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """Rows of the newest date. The date is a scalar subquery, so partitions of other
    dates are pruned when the query runs. ``dates`` (``snapshot_date``) saves looking for it."""
    newest = (snapshots if dates is None else dates).agg(F.max("snapshot_date")).scalar()
    return snapshots.filter(F.col("snapshot_date") == newest)


def percent(flag: Column) -> Column:
    """Whole percentage of rows for which the flag holds, zero for no rows."""
    return F.coalesce(F.round(100 * F.avg(flag.cast("int"))), F.lit(0)).cast("bigint")


def coverage(identities: DataFrame, fields: Sequence[str] = COVERAGE_FIELDS) -> DataFrame:
    """``field, populated``: share of all identities with the field, in one pass."""
    wide = identities.agg(*[percent(F.col(f).isNotNull()).alias(f) for f in fields])
    return wide.unpivot([], list(fields), "field", "populated")


def coverage_table(identities: DataFrame) -> DataFrame:
    """Coverage with the required fields, which are whole by definition."""
    fixed = F.explode(F.array(*[F.lit(f) for f in ALWAYS_PRESENT])).alias("field")
    spark = identities.sparkSession
    whole = spark.range(1).select(fixed, F.lit(100).cast("bigint").alias("populated"))
    return whole.unionByName(coverage(identities))


def ratio_percent(df: DataFrame, predicate: Column, required: Sequence[str]) -> Column:
    """Predicate share over rows that have every required field, as an aggregate."""
    full = F.lit(True)
    for f in required:
        full = full & df[f].isNotNull()
    return percent(F.when(full, predicate))


def in_range(price: Column, low: Column, high: Column) -> Column:
    """Price within its bounds, without tolerance."""
    return (low <= price) & (price <= high)


def cap_agrees(cap: Column, price: Column, shares: Column) -> Column:
    return F.abs(cap - price * shares) <= CAP_TOLERANCE * cap


def tier_histogram(
    df: DataFrame, cap: Column, tiers: Sequence[tuple[str, float, float | None]] = CAP_TIERS
) -> DataFrame:
    """Rows per tier, empty tiers included, in one pass."""

    def inside(low, high):
        return (cap >= low) if high is None else (cap >= low) & (cap < high)

    counts = [F.count_if(inside(lo, hi)).alias(name) for name, lo, hi in tiers]
    wide = df.agg(F.array(*counts).alias("counts"))
    names = F.array(*[F.lit(name) for name, _, _ in tiers])
    rows = wide.select(F.posexplode("counts").alias("tier_no", "n"), names.alias("names"))
    return rows.select("tier_no", F.get("names", F.col("tier_no")).alias("tier"), "n")


def cap_totals(df: DataFrame, cap: str) -> DataFrame:
    c = F.col(cap)
    return df.agg(
        F.coalesce(F.sum(c), F.lit(0)).alias("total"), F.coalesce(F.max(c), F.lit(0)).alias("largest")
    )


def cap_median(df: DataFrame, cap: str) -> DataFrame:
    """Upper median of a whole column, exact and without gathering it anywhere."""
    whole = df.select(F.lit(0).alias("_all"), cap)
    picked = upper_median(whole, ["_all"], cap).select(F.col("upper_median").alias("median"))
    return picked.groupBy().agg(F.coalesce(F.max("median"), F.lit(0)).alias("median"))


def distinct_values(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    return df.agg(*[F.count_distinct(f).alias(f) for f in fields])


def distinct_elements(df: DataFrame, array: str) -> DataFrame:
    elements = df.select(F.explode(array).alias("element"))
    return elements.agg(F.count_distinct("element").alias("elements"))


# Columns the key figures read when no mapping is given.
RECORD_COLUMNS = {
    "sector": "sector",
    "industry": "industry",
    "mics": "mics",
    "cap": "market_cap",
    "price": "last_price",
    "low": "fifty_two_week_min",
    "high": "fifty_two_week_max",
    "shares": "shares_outstanding",
}


CAP_FIGURES = {"aggregate": "total", "largest": "largest", "median": "median"}


def slice_figures(now: DataFrame, columns: Mapping[str, str] = RECORD_COLUMNS) -> DataFrame:
    """Totals, distinct values and coherence of a slice in one scan.

    A row is repeated for each of its venues; only its first copy counts in the sums.
    """
    c = columns
    each = now.select(
        *dict.fromkeys(c[n] for n in ("sector", "industry", "cap", "price", "low", "high", "shares")),
        F.posexplode_outer(c["mics"]).alias("_at", "_venue"),
    )
    first = F.coalesce(F.col("_at"), F.lit(0)) == 0
    cap, price = F.col(c["cap"]).cast("double"), F.col(c["price"]).cast("double")
    low, high = F.col(c["low"]).cast("double"), F.col(c["high"]).cast("double")
    shares = F.col(c["shares"]).cast("double")

    def share(flag: Column, *needed: str) -> Column:
        full = first
        for n in needed:
            full = full & F.col(c[n]).isNotNull()
        return percent(F.when(full, flag))

    return each.agg(
        F.coalesce(F.sum(F.when(first, F.col(c["cap"]))).cast("double"), F.lit(0.0)).alias("total"),
        F.coalesce(F.max(c["cap"]).cast("double"), F.lit(0.0)).alias("largest"),
        share(in_range(price, low, high), "price", "low", "high").alias("in_range_pct"),
        share(cap_agrees(cap, price, shares), "cap", "price", "shares").alias("cap_agrees_pct"),
        F.count_distinct(c["sector"]).alias("sectors"),
        F.count_distinct(c["industry"]).alias("industries"),
        F.count_distinct("_venue").alias("venues"),
    )


def key_figures(
    identities: DataFrame,
    snapshots: DataFrame,
    columns: Mapping[str, str] = RECORD_COLUMNS,
    dates: DataFrame | None = None,
) -> DataFrame:
    """One row with the headline figures.

    The newest slice is read once for all figures and once for the median. ``dates``
    (:meth:`concord.plans.store.Store.dates`) gives the dates without a look at the snapshots.
    """
    days = stage(snapshots.select("snapshot_date").distinct(), "report-dates") if dates is None else dates
    now = latest_slice(snapshots, days)
    figures = slice_figures(now, columns).select(
        identities.agg(F.count(F.lit(1))).scalar().alias("equities"),
        "sectors",
        "industries",
        "venues",
        days.agg(F.count_distinct("snapshot_date")).scalar().alias("snapshot_dates"),
        days.agg(display_date(F.min("snapshot_date"))).scalar().alias("history_since"),
        "total",
        "largest",
        cap_median(now, columns["cap"]).scalar().alias("median"),
        "in_range_pct",
        "cap_agrees_pct",
    )
    shown = {f"{n}_cap": display_usd(F.col(f)) for n, f in CAP_FIGURES.items()}
    return figures.withColumns(shown).drop(*CAP_FIGURES.values())
