"""One query per operator, over a folder of test tables.

Each function takes (spark, folder) and returns a DataFrame. Queries of sinks and merges
write to a new folder below the shared one, and return what they read back.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealscope import adapter
from dealscope import vocabulary as V
from dealscope.adapter import CONFIG
from dealscope.config import SalesConfig
from dealscope.functions import calendar, parsing
from dealscope.operators import changes, merge, normalize, state
from dealscope.operators.dedupe import merge_dedupe
from dealscope.plans import dashboard, jobs, upkeep
from dealscope.plans.activities import with_activity_category
from dealscope.plans.views import VIEWS, ViewLayer
from dealscope.schemas import ACTIVITIES, COMPANIES, CONTACTS, RAW_SCHEMAS
from dealscope.session import configure, fresh_path, size_shuffles
from dealscope.sources import catalog, curated, raw

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

SLIM_ACTIVITY = [
    "activity_id",
    "activity_type",
    "owner_id",
    "created_at",
    "last_modified_at",
    "dt",
]


def query(function: Query) -> Query:
    """Register a query under its function's name, with the session set up first."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        configure(spark)
        size_shuffles(spark, folder)
        return function(spark, folder)

    QUERIES[function.__name__] = run
    return function


def layer(spark: SparkSession, folder: str, config: SalesConfig = CONFIG) -> ViewLayer:
    return ViewLayer(spark, adapter.tables(spark, folder), config)


def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return layer(spark, folder).frame(name)



def _with_money(df: DataFrame, *columns: str, scale: int = 2) -> DataFrame:
    """Sums of doubles depend on the order of summation, so they are compared rounded."""
    return df.withColumns({c: F.col(c).cast(f"decimal(18,{scale})") for c in columns})


# --- views -------------------------------------------------------------------------------


def _register_views() -> None:
    rounded = {"deal_kpis_monthly": ["total_amount"]}
    for number, name in enumerate(VIEWS, 1):

        def run(spark: SparkSession, folder: str, name: str = name) -> DataFrame:
            return _with_money(view(spark, folder, name), *rounded.get(name, []))

        run.__name__ = f"v{number:02d}_{name}"
        query(run)


_register_views()


@query
def v17_activity_volume_last3weeks_strict_dt(spark, folder):
    strict = SalesConfig(
        as_of=CONFIG.as_of, owner_allow_list=CONFIG.owner_allow_list, strict_dt=True
    )
    return layer(spark, folder, strict).frame("activity_volume_by_owner_type_last3weeks_v3")


# --- calendar and categories -------------------------------------------------------------


@query
def c1_activity_category(spark, folder):
    return with_activity_category(adapter.activities(spark, folder)).select(
        "activity_id", "activity_type", "activity_category"
    )


@query
def c2_week_bounds(spark, folder):
    local_day = calendar.local_date(F.col("created_at"), CONFIG.zone)
    week = F.col("week_start")
    return (
        adapter.activities(spark, folder)
        .select(
            "activity_id",
            local_day.alias("local_day"),
            calendar.local_week(F.col("created_at"), CONFIG.zone).alias("week_start"),
        )
        .select(
            "activity_id",
            "local_day",
            calendar.latest_sunday(F.col("local_day")).alias("last_sunday"),
            week,
            calendar.week_end(week).alias("week_end"),
            calendar.short_week_label(week).alias("week_label"),
        )
    )


@query
def c3_month_spine(spark, folder):
    months = calendar.months_from_to(F.col("created_at"), F.col("closed_at"))
    return (
        view(spark, folder, "deals_latest")
        .select(F.explode(months).alias("month_start"))
        .groupBy("month_start")
        .agg(F.count(F.lit(1)).alias("open_deals"))
    )


@query
def c4_local_month_bounds(spark, folder):
    shifted = SalesConfig(as_of=CONFIG.as_of, month_bounds="shifted")
    month = calendar.cohort_month(F.col("created_at"), CONFIG)
    start, end = calendar.cohort_month_bounds(month, CONFIG.zone)
    return view(spark, folder, "deals_latest").select(
        "deal_id",
        month.alias("month"),
        start.alias("start_utc"),
        end.alias("end_utc"),
        calendar.cohort_month(F.col("created_at"), shifted).alias("shifted_month"),
    )


@query
def f01_timestamp_text(spark, folder):
    k = F.col("deal_id").cast("bigint")
    text = parsing.iso_text(F.col("created_at"))
    either = F.when(k % 2 == 0, text).otherwise(F.left(text, F.lit(10)))
    sometimes_junk = F.when(k % 3 == 0, "junk").otherwise(text)
    epoch = F.timestamp_seconds(F.lit(0))
    return view(spark, folder, "deals_latest").select(
        "deal_id",
        text.alias("created_text"),
        parsing.iso_to_utc(either).alias("created_again"),
        parsing.epoch_millis(sometimes_junk, epoch).alias("created_millis"),
    )


# --- normalizers -------------------------------------------------------------------------


def raw_objects(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    return raw.parse_raw_objects(getattr(adapter, f"raw_{kind}")(spark, folder), kind)


@query
def n01_normalize_deals(spark, folder):
    return normalize.normalize_deals(raw_objects(spark, folder, "deals"))


@query
def n02_stage_timestamps(spark, folder):
    columns = [
        normalize.stage_entered_at(V.STAGE_CODES[stage]).alias(name)
        for name, stage in V.STAGE_TIMES.items()
    ]
    return (
        raw_objects(spark, folder, "deals")
        .groupBy(F.col("id").alias("deal_id"), *columns)
        .agg(F.count(F.lit(1)).alias("versions"))
    )


@query
def n03_first_filled(spark, folder):
    source = normalize.first_filled_prop(V.DEAL_SOURCE_PROPERTIES)
    return (
        raw_objects(spark, folder, "deals")
        .groupBy(F.col("id").alias("deal_id"), source.alias("source"))
        .agg(F.count(F.lit(1)).alias("versions"))
    )


@query
def n04_first_associated_id(spark, folder):
    return (
        raw_objects(spark, folder, "deals")
        .select(
            F.col("id").alias("deal_id"),
            normalize.first_associated_id("companies").alias("company_id"),
            normalize.first_associated_id("contacts").alias("contact_id"),
        )
        .distinct()
    )


@query
def n05_parse_mixed_timestamp(spark, folder):
    times = ["created_at", "closed_at", "last_modified_at"]
    return raw_objects(spark, folder, "deals").select(
        F.col("id").alias("deal_id"),
        *[
            parsing.parse_mixed_timestamp(normalize.prop(V.DEAL_PROPERTIES[time])).alias(time)
            for time in times
        ],
    )


@query
def n06_normalize_activities(spark, folder):
    return normalize.normalize_activities(raw_objects(spark, folder, "activities"))


@query
def n07_map_specific_type(spark, folder):
    return raw_objects(spark, folder, "activities").select(
        F.col("id").alias("activity_id"),
        "object_type",
        normalize.activity_type().alias("activity_type"),
    )


@query
def n08_extract_metadata(spark, folder):
    return raw_objects(spark, folder, "activities").select(
        F.col("id").alias("activity_id"), *normalize.activity_metadata()
    )


@query
def n09_keep_dated_distinct(spark, folder):
    rows = normalize.normalize_activities(raw_objects(spark, folder, "activities"))
    doubled = rows.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    return normalize.keep_dated_distinct(doubled)


@query
def n10_normalize_contacts(spark, folder):
    return normalize.normalize_contacts(raw_objects(spark, folder, "contacts"))


@query
def n11_normalize_companies(spark, folder):
    return normalize.normalize_companies(raw_objects(spark, folder, "companies"))


@query
def n12_normalize_owners(spark, folder):
    return normalize.normalize_owners(raw_objects(spark, folder, "owners"))


@query
def n13_flatten_pipelines(spark, folder):
    return normalize.flatten_pipelines(raw_objects(spark, folder, "pipelines"))


@query
def n14_normalize_activities_alternate(spark, folder):
    return normalize.normalize_activities_alternate(raw_objects(spark, folder, "activities"))


@query
def n15_normalize_deals_compact(spark, folder):
    return normalize.normalize_deals_compact(raw_objects(spark, folder, "deals"))


@query
def n16_flatten_associations(spark, folder):
    results = raw_objects(spark, folder, "associations")
    pairs = normalize.flatten_associations(results, [F.desc_nulls_last(F.size("to"))])
    return normalize.explode_associations(pairs)


@query
def n17_partition_date(spark, folder):
    created = parsing.parse_mixed_timestamp(normalize.prop(V.DEAL_PROPERTIES["created_at"]))
    return (
        raw_objects(spark, folder, "deals")
        .groupBy(parsing.partition_date(created).alias("dt"))
        .agg(F.count(F.lit(1)).alias("deals"))
    )


# --- options of views --------------------------------------------------------------------


@query
def v05_integer_win_rate(spark, folder):
    config = replace(CONFIG, integer_rate=True)
    return _with_money(layer(spark, folder, config).frame("deal_kpis_monthly"), "total_amount")


@query
def v11_stepwise_percent(spark, folder):
    config = replace(CONFIG, stepwise_percent=True)
    return layer(spark, folder, config).frame("deal_cohort_closing_rates")


@query
def v13_shifted_months(spark, folder):
    config = replace(CONFIG, month_bounds="shifted")
    return layer(spark, folder, config).frame("deal_cohort_closing_rates_transposed")


def _narrow(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A view over a stored table of deals, that looks for the deals of its period first."""
    path = fresh_path(spark, "deals")
    adapter.deals(spark, folder).write.parquet(path)
    tables = {**adapter.tables(spark, folder), "deals": spark.read.parquet(path)}
    return ViewLayer(spark, tables, CONFIG, narrow_first=True).frame(name)


@query
def v09_narrow_first(spark, folder):
    return _narrow(spark, folder, "deal_kpis_weekly_last3_by_owner")


@query
def v12_narrow_first(spark, folder):
    return _narrow(spark, folder, "deal_cohort_closing_rates_by_owner")


@query
def v17_narrow_first(spark, folder):
    return _narrow(spark, folder, "activity_volume_by_owner_type_last3weeks_v3")


# --- incremental load --------------------------------------------------------------------


def _utc(*parts: int) -> datetime:
    return datetime(*parts, tzinfo=timezone.utc)


def _changed_deals(spark: SparkSession, folder: str) -> DataFrame:
    return changes.select_changes(
        adapter.deals(spark, folder),
        F.col("created_at"),
        F.col("last_modified_at"),
        changes.SyncWindow(True, _utc(2024, 1, 2), _utc(2023, 12, 20)),
        _utc(2024, 1, 24),
    )


@query
def i01_select_changes(spark, folder):
    return _changed_deals(spark, folder).select("deal_id", "last_modified_at", "change_set")


@query
def i02_latest_changes(spark, folder):
    newest = [F.desc_nulls_last("last_modified_at")]
    return changes.latest_changes(_changed_deals(spark, folder), ["deal_id"], newest).select(
        "deal_id", "deal_name", "last_modified_at"
    )


def _merged(spark: SparkSession, folder: str, **policy) -> DataFrame:
    """First and second versions of the deals as two inputs."""
    deals = adapter.deals(spark, folder)
    second = F.col("deal_name").endswith(" v2")
    merged = merge_dedupe([deals.filter(~second), deals.filter(second)], "deal_id", **policy)
    return merged.select("deal_id", "deal_name", "last_modified_at", "amount")


@query
def i03_merge_last_wins(spark, folder):
    return _merged(spark, folder)


@query
def i03_merge_greatest_timestamp(spark, folder):
    return _merged(spark, folder, timestamp=F.col("last_modified_at"))


@query
def i03_merge_resolver(spark, folder):
    """The longer name wins."""
    return _merged(spark, folder, resolver=F.length("deal_name"))


@query
def i03_merge_fold_hot_key(spark, folder):
    """Nearly all line items are versions of one key."""
    order = F.col("l_orderkey")
    rows = spark.read.parquet(f"{folder}/lineitem.parquet").select(
        F.when(order % 50 == 0, F.concat(F.lit("order "), order.cast("string")))
        .otherwise("hot")
        .alias("id"),
        F.col("l_returnflag").alias("first_flag"),
        F.col("l_returnflag").alias("flag"),
        F.when(F.col("l_linenumber") % 3 == 0, F.concat(F.lit("n"), order.cast("string")))
        .when(F.col("l_linenumber") % 3 == 1, "")
        .alias("note"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        "l_orderkey",
        "l_linenumber",
    )
    ways = {"first_flag": "first", "note": "last_filled", "quantity": "sum", "price": "max"}
    place = [F.col("l_orderkey"), F.col("l_linenumber"), F.col("price")]
    return merge_dedupe([rows], position=place, resolver=ways).drop("l_orderkey", "l_linenumber")


@query
def i04_merge_upsert(spark, folder):
    """Two of five activities are updated, one of them new; the rest is there before."""
    path = fresh_path(spark, "activities")
    rows = adapter.activities(spark, folder)
    k = F.col("activity_id").cast("bigint") % 5
    merge.full_load(rows.filter(k != 3), path)
    delta = rows.filter(k >= 3).withColumn("activity_type", F.lit("UPDATED"))
    older = delta.withColumn("last_modified_at", F.lit(_utc(2000, 1, 1)))
    newest = [F.desc_nulls_last("last_modified_at")]
    for _ in range(2):  # a repeated run changes nothing
        merge.merge_upsert(
            delta.unionByName(older).unionByName(delta), path, "activity_id", latest_first=newest
        )
    return curated.read_curated(spark, path, ACTIVITIES).select(*SLIM_ACTIVITY)


@query
def i04_merge_upsert_global_key(spark, folder):
    """Companies move to the partition of their modification date, leaving no copy behind."""
    path = fresh_path(spark, "companies")
    rows = adapter.companies(spark, folder)
    created_dt = parsing.partition_date(F.col("created_at"))
    before = rows.withColumn("last_modified_at", F.lit(None).cast("timestamp"))
    merge.full_load(before.withColumn("dt", created_dt), path)
    modified = rows.filter(F.col("last_modified_at").isNotNull())
    delta = modified.withColumn("name", F.concat("name", F.lit(" v2")))
    merge.merge_upsert(delta, path, "company_id", global_key=True)
    return curated.read_curated(spark, path, COMPANIES).select("company_id", "name", "dt")


@query
def i05_full_load(spark, folder):
    """A full load leaves nothing of what was there before."""
    path = fresh_path(spark, "activities")
    rows = adapter.activities(spark, folder)
    stale = rows.withColumn("dt", F.lit("2020-01-01"))
    merge.full_load(stale, path)
    merge.full_load(rows, path)
    return curated.read_curated(spark, path, ACTIVITIES).select(*SLIM_ACTIVITY)


@query
def i06_high_water_marks(spark, folder):
    deals = changes.high_water_marks(adapter.deals(spark, folder))
    activities = changes.high_water_marks(adapter.activities(spark, folder))
    return deals.withColumn("object_type", F.lit("deals")).unionByName(
        activities.withColumn("object_type", F.lit("activities"))
    )


@query
def i07_changed_since_mark(spark, folder):
    path = fresh_path(spark, "state")
    state.put_sync_state(
        spark,
        path,
        "activities",
        "2024-01-20T05:00:00+00:00",
        "2024-01-20T00:00:00.000Z",
        "2024-01-20T03:00:00.000Z",
    )
    window = changes.sync_window(state.get_sync_state(spark, path, "activities"), True)
    rows = adapter.activities(spark, folder)
    return changes.changed_since(
        rows, F.col("created_at"), F.col("last_modified_at"), window
    ).select("activity_id", "created_at", "last_modified_at")


@query
def i08_sync_state(spark, folder):
    """Marks of two tables; an empty run later keeps the marks of the first."""
    path = fresh_path(spark, "state")
    for name in ("contacts", "activities"):
        rows = getattr(adapter, name)(spark, folder)
        marks = changes.high_water_marks(rows).first()
        state.put_sync_state(
            spark,
            path,
            name,
            "2024-01-24T05:00:00+00:00",
            marks["max_created_at"],
            marks["max_modified_at"],
            marks["rows"],
        )
    state.put_sync_state(spark, path, "contacts", "2024-01-25T05:00:00+00:00")
    return state.read_sync_state(spark, path)


# --- sync jobs ---------------------------------------------------------------------------

_FULL_RUN, _NEXT_RUN = _utc(2024, 9, 1), _utc(2024, 9, 2)


# Objects in a landed file, so that compressed files are still read by many tasks.
_OBJECTS_PER_FILE = 50_000


def _land(lines: DataFrame, path: str) -> None:
    """Write the JSON texts of ``value`` to a landing folder."""
    (
        lines.select("value")
        .write.option("compression", "snappy")
        .option("maxRecordsPerFile", _OBJECTS_PER_FILE)
        .text(path)
    )


def _landed(spark: SparkSession, lines: DataFrame, kind: str) -> DataFrame:
    """Raw objects written as JSON lines and scanned again."""
    path = fresh_path(spark, f"raw-{kind}")
    _land(lines, path)
    return raw.read_raw_objects(spark, path, kind)


def _as_json(properties: Column, columns: list[str], **changed: Column) -> Column:
    """JSON text of a raw object with these properties."""
    rest = [changed.get(c, F.col(c)).alias(c) for c in columns if c != "properties"]
    return F.to_json(F.struct(*rest, properties.alias("properties")))


def _synced(
    spark: SparkSession, folder: str, kind: str, name: str | None, modified: str
) -> DataFrame:
    """A full run, then an incremental one over the same objects and later versions.

    Every tenth object has an outdated version as well, some are dated in the future, and
    every fifth is edited between the runs. Objects land as their texts are, changed versions
    are written anew; the later ones land beside those of the first run.
    """
    texts = getattr(adapter, f"raw_{kind}")
    number = F.col("id").cast("bigint")
    known = F.map_contains_key("properties", modified)
    columns = RAW_SCHEMAS[kind].names

    def version(time: str, text: str | None) -> Column:
        def changed(key, value):
            out = F.when(key == modified, F.lit(time))
            if name is not None and text is not None:
                out = out.when(key == name, F.lit(text))
            return out.otherwise(value)

        return _as_json(F.transform_values("properties", changed), columns)

    coming = (number % 97 == 1) & (number % 5 != 0)
    versions = [
        F.when(~(coming & known), F.col("value")),
        F.when(known & coming, version("2030-01-01T00:00:00Z", None)),
        F.when(known & (number % 10 == 0), version("2001-01-01T00:00:00Z", "outdated")),
    ]
    if kind == "activities":  # two types share ids
        task = _as_json(F.col("properties"), columns, object_type=F.lit("tasks"))
        versions.append(F.when((F.col("object_type") == "calls") & (number % 10 == 0), task))
    lines = texts(spark, folder).select("value")
    full = raw.parse_raw_objects(lines, kind, keep=["value"]).select(
        F.explode(F.array_compact(F.array(*versions))).alias("value")
    )
    fifth = texts(spark, folder, F.col("k") % 5 == 0).select("value")
    later = raw.parse_raw_objects(fifth, kind).filter(known).select(
        version("2024-09-01T12:00:00Z", "edited").alias("value")
    )
    path, marks = fresh_path(spark, kind), fresh_path(spark, "state")
    before = _landed(spark, full, kind)
    jobs.sync_table(kind, before, path, marks, _FULL_RUN)
    everything = before.unionByName(_landed(spark, later, kind))
    jobs.sync_table(kind, everything, path, marks, _NEXT_RUN)
    return spark.read.option("mergeSchema", True).parquet(path)


@query
def j01_sync_deals(spark, folder):
    found = _synced(spark, folder, "deals", "dealname", "hs_lastmodifieddate")
    return found.select("deal_id", "deal_name", "last_modified_at")


@query
def j02_sync_activities(spark, folder):
    found = _synced(spark, folder, "activities", None, "hs_lastmodifieddate")
    return found.select("object_type", "activity_id", "last_modified_at")


@query
def j03_sync_contacts(spark, folder):
    found = _synced(spark, folder, "contacts", "lastname", "lastmodifieddate")
    return found.select("contact_id", "lastname", "last_modified_at")


@query
def j04_sync_companies(spark, folder):
    found = _synced(spark, folder, "companies", "name", "hs_lastmodifieddate")
    return found.select("company_id", "name", F.col("dt").cast("string").alias("dt"))


@query
def j05_sync_owners(spark, folder):
    """Every second owner comes in two versions."""
    rows = raw_objects(spark, folder, "owners")
    newer = rows.filter(F.col("id").cast("bigint") % 2 == 0).withColumns(
        {
            "firstName": F.lit("New"),
            "lastName": F.lit(""),
            "updatedAt": F.lit("2024-01-03T00:00:00.000Z"),
        }
    )
    path = fresh_path(spark, "owners")
    both = newer.unionByName(rows).select(F.to_json(F.struct("*")).alias("value"))
    jobs.sync_owners(_landed(spark, both, "owners"), path)
    return curated.read_curated(spark, path).select("owner_id", "owner_name")


@query
def j06_monthly_kpis_kept_up(spark, folder):
    """Deals from two landing dates, the second with new amounts; their KPIs from kept parts."""
    columns = RAW_SCHEMAS["deals"].names
    new = {"amount": "77.5", V.DEAL_PROPERTIES["last_modified_at"]: "2024-09-01T12:00:00Z"}

    def changed(key, value):
        out = value
        for name, text in new.items():
            out = F.when(key == name, F.lit(text)).otherwise(out)
        return out

    first = adapter.raw_deals(spark, folder)
    fifth = adapter.raw_deals(spark, folder, F.col("k") % 5 == 0)
    later = raw.parse_raw_objects(fifth, "deals").select(
        _as_json(F.transform_values("properties", changed), columns).alias("value")
    )
    landing = fresh_path(spark, "raw-deals")
    path, marks, parts = (fresh_path(spark, name) for name in ("deals", "state", "monthly"))
    runs = [("2024-08-31", first, _FULL_RUN), ("2024-09-02", later, _NEXT_RUN)]
    for landed, lines, now in runs:
        _land(lines, f"{landing}/landed={landed}")
        jobs.sync_landed("deals", spark, landing, path, marks, now, monthly_path=parts)
    owners = adapter.tables(spark, folder)["owners"]
    owners = owners() if callable(owners) else owners
    kept = upkeep.deal_kpis_monthly_kept(upkeep.read_monthly(spark, parts), owners, CONFIG)
    return _with_money(kept, "total_amount")


# --- sources and sinks -------------------------------------------------------------------


@query
def s01_read_raw_objects(spark, folder):
    path = fresh_path(spark, "raw-deals")
    adapter.raw_deals(spark, folder).write.text(path)
    return (
        raw.read_raw_objects(spark, path, "deals")
        .groupBy(
            "id",
            normalize.prop(V.DEAL_PROPERTIES["deal_stage"]).alias("deal_stage"),
            normalize.prop(V.DEAL_PROPERTIES["amount"]).alias("amount"),
        )
        .agg(F.count(F.lit(1)).alias("versions"))
    )


@query
def s01_read_landed_since(spark, folder):
    """Raw contacts of one landing date, from a folder with two."""
    path = fresh_path(spark, "raw-contacts")
    rows = adapter.raw_contacts(spark, folder)
    even = F.get_json_object("value", "$.id").cast("bigint") % 2 == 0
    day = F.when(even, "2024-01-02").otherwise("2024-01-01")
    rows.withColumn("landed", day).write.partitionBy("landed").text(path)
    found = raw.read_raw_objects(spark, path, "contacts", landed_since="2024-01-02")
    return found.select("id", normalize.prop("lastname").alias("lastname"))


@query
def s02_read_curated(spark, folder):
    path = fresh_path(spark, "activities")
    curated.overwrite_dataset(adapter.activities(spark, folder), path)
    return (
        curated.read_curated(spark, path, ACTIVITIES)
        .filter(F.col("dt").between("2024-01-08", "2024-01-14"))
        .select(*SLIM_ACTIVITY)
    )


@query
def s03_append_snapshot(spark, folder):
    path = fresh_path(spark, "contacts")
    contacts = adapter.contacts(spark, folder).drop("dt")
    for day in ("2024-02-01", "2024-02-02", "2024-02-02"):
        curated.append_snapshot(contacts, path, day)
    return (
        curated.read_curated(spark, path, CONTACTS)
        .groupBy("dt")
        .agg(
            F.count(F.lit(1)).alias("rows"), F.count_distinct("contact_id").alias("contacts")
        )
    )


@query
def s04_overwrite_partitions(spark, folder):
    path = fresh_path(spark, "activities")
    rows = adapter.activities(spark, folder)
    curated.overwrite_dataset(rows, path)
    late = rows.filter(F.col("dt") >= "2024-01-25")
    curated.overwrite_partitions(late.withColumn("activity_type", F.lit("REPLACED")), path)
    return (
        curated.read_curated(spark, path, ACTIVITIES)
        .groupBy("dt", "activity_type")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


@query
def s05_replace_snapshot(spark, folder):
    path = fresh_path(spark, "owners")
    owners = adapter.owners(spark, folder)
    curated.replace_snapshot(owners.withColumn("owner_name", F.lit("old")), path)
    curated.replace_snapshot(owners, path)
    return curated.read_curated(spark, path, owners.schema).select("owner_id", "owner_name")


@query
def s06_stage_snapshot(spark, folder):
    """Two runs leave one copy of each stage."""
    path = fresh_path(spark, "stage")
    pipelines = raw_objects(spark, folder, "pipelines")
    jobs.sync_stages(pipelines, path)
    jobs.sync_stages(pipelines, path)
    return curated.read_curated(spark, path)


@query
def s07_register_table(spark, folder):
    """A table gets new partitions and a new column on its second registration."""
    path = fresh_path(spark, "activities")
    name = "activities_" + path.rsplit("-", 1)[1]
    rows = adapter.activities(spark, folder).select(*SLIM_ACTIVITY)
    early = F.col("dt") < "2024-01-16"
    curated.overwrite_partitions(rows.filter(early), path)
    catalog.register_table(spark, name, path, rows.schema)
    later = rows.filter(~early).withColumn("region", F.lit("south"))
    curated.overwrite_partitions(later, path)
    catalog.register_table(spark, name, path, later.schema)
    return spark.sql(
        f"""SELECT dt, count(*) AS rows, count(DISTINCT owner_id) AS owners,
          count(region) AS with_region FROM {name} GROUP BY dt"""
    )


@query
def s08_view_layer(spark, folder):
    """SQL over registered views, with the deals deduplicated once for both."""
    views = layer(spark, folder)
    views.materialize("deals_latest")
    views.register("deals_latest", "deal_kpis_monthly_v2")
    return spark.sql(
        """SELECT m.month_start, m.opportunities_created, m.closed_won,
          coalesce(n.deals, 0) AS deals_created
        FROM deal_kpis_monthly_v2 m LEFT JOIN (
          SELECT trunc(from_utc_timestamp(created_at, 'America/Montevideo'), 'month') AS month,
            count(*) AS deals
          FROM deals_latest GROUP BY 1) n ON n.month = m.month_start"""
    )


# --- dashboard datasets ------------------------------------------------------------------


def _per_deal(spark: SparkSession, folder: str) -> DataFrame:
    return view(spark, folder, "deal_stage_durations_per_deal")


def _count():
    return F.count(F.lit(1))


@query
def d01_agg_dataset(spark, folder):
    measures = [
        *[dashboard.measure("amount", name) for name in ["SUM", "MIN", "MAX", "COUNT"]],
        *[dashboard.measure("sales_cycle_days", name) for name in ["AVERAGE", "DISTINCT_COUNT"]],
    ]
    found = dashboard.agg_dataset(_per_deal(spark, folder), ["owner_name", "is_won"], measures)
    return _with_money(found, "amount_sum")


@query
def d01_percentile_measure(spark, folder):
    measures = [
        dashboard.percentile_measure("amount", 90),
        _count().alias("deals"),
        dashboard.percentile_measure("sales_cycle_days", 50, "median_days"),
    ]
    found = dashboard.agg_dataset(_per_deal(spark, folder), ["is_won"], measures)
    return _with_money(found, "amount_p90", "median_days", scale=4)


@query
def d02_date_granularity(spark, folder):
    quarter = dashboard.date_granularity("created_at", "QUARTER")
    measures = [_count().alias("deals"), dashboard.measure("amount", "SUM")]
    found = dashboard.agg_dataset(_per_deal(spark, folder), [quarter], measures)
    return _with_money(found, "amount_sum")


@query
def d03_calculated_field(spark, folder):
    deals = dashboard.calculated_field(
        _per_deal(spark, folder), "days_after_op", "{sales_cycle_days} - {created_to_op_days}"
    )
    measures = [
        dashboard.measure("days_after_op", "SUM", "days_after_op"),
        dashboard.calculated_measure("sum({sales_cycle_days}) / count(1)", "cycle_share"),
    ]
    return _with_money(dashboard.agg_dataset(deals, ["owner_id"], measures), "cycle_share", scale=6)


@query
def d04_category_filter(spark, folder):
    names = ["Supplier#000000001", "Supplier#000000002", "110"]
    kept = dashboard.category_filter(
        _per_deal(spark, folder), "owner_name", "CONTAINS", names, dashboard.ALL_VALUES
    )
    return kept.select("deal_id", "owner_name")


@query
def d04_single_value(spark, folder):
    kept = dashboard.category_filter(
        _per_deal(spark, folder), "owner_name", "CONTAINS", "00001", dashboard.NON_NULLS_ONLY
    )
    return kept.select("deal_id", "owner_name")


@query
def d05_numeric_equality_filter(spark, folder):
    kept = dashboard.numeric_equality_filter(
        _per_deal(spark, folder), "prep_to_sent_days", "EQUALS", 5
    )
    return kept.select("deal_id", "prep_to_sent_days")


@query
def d05_aggregated_filter(spark, folder):
    """Owners by deals, of those with exactly one won deal."""
    return dashboard.aggregated_filter(
        _per_deal(spark, folder),
        ["owner_name"],
        [_count().alias("deals")],
        F.count_if("is_won"),
        "DOES_NOT_EQUAL",
        50,
    )


@query
def d05_percentile_filter(spark, folder):
    """Owners by deals, of those whose deals take three days to become an opportunity in the median."""
    return dashboard.aggregated_filter(
        _per_deal(spark, folder),
        ["owner_name"],
        [_count().alias("deals")],
        dashboard.percentile_measure("created_to_op_days", 50),
        "EQUALS",
        3,
    )


@query
def d06_excluded_period(spark, folder):
    """Months from June 2020 on, without the two that end in January 2021."""
    kept = dashboard.time_range_filter(
        _per_deal(spark, folder),
        "created_at",
        minimum=_utc(2020, 6, 1),
        grain="MONTH",
        exclude_last=(2, "MONTH"),
        until=_utc(2021, 1, 15),
    )
    return kept.select("deal_id", "created_at")


@query
def d06_time_range_filter(spark, folder):
    kept = dashboard.time_range_filter(
        _per_deal(spark, folder),
        "closed_won_at",
        minimum=_utc(2023, 6, 1),
        include_minimum=False,
        null_option=dashboard.ALL_VALUES,
    )
    return kept.select("deal_id", "closed_won_at")


@query
def d07_row_sort(spark, folder):
    measures = [_count().alias("deals"), dashboard.measure("amount", "SUM", "amount")]
    found = dashboard.agg_dataset(_per_deal(spark, folder), ["owner_name"], measures)
    return dashboard.row_sort(
        _with_money(found, "amount"), ("amount", "DESC"), ("owner_name", "ASC")
    )


@query
def d08_unaggregated_table(spark, folder):
    formats = {"created_at": "dd/MM/yyyy", "closed_won_at": "dd/MM/yyyy"}
    columns = ["deal_id", "owner_name", "created_at", "closed_won_at"]
    return dashboard.unaggregated_table(_per_deal(spark, folder), columns, formats, "not won")


def _latest_amounts(spark: SparkSession, folder: str) -> DataFrame:
    latest = view(spark, folder, "deals_latest")
    return latest.withColumn("amount", parsing.number(F.col("amount")))


@query
def d09_heat_map(spark, folder):
    measures = [_count().alias("deals"), dashboard.measure("amount", "SUM")]
    cells = dashboard.heat_map(_latest_amounts(spark, folder), ["source"], "deal_stage", measures)
    return _with_money(cells, "amount_sum")


@query
def d09_pivot(spark, folder):
    stages = ["closedwon", "closedlost", "appointmentscheduled"]
    matrix = dashboard.heat_map(
        _latest_amounts(spark, folder), ["source"], "deal_stage", [_count()], stages
    )
    return matrix.fillna(0, stages)


@query
def d09_open_pivot(spark, folder):
    """The two most frequent groups have a column each, the rest one together."""
    k = F.col("deal_id").cast("bigint")
    rare = F.when(k % 40 != 9, F.concat(F.lit("rare "), (k % 7).cast("string")))
    group = F.when(k % 10 < 5, "half").when(k % 10 < 8, "third").otherwise(rare)
    deals = view(spark, folder, "deals_latest").withColumn("group", group)
    return dashboard.open_pivot(deals, ["deal_stage"], "group", "deal_id", "COUNT", 2)


@query
def d10_box_plot(spark, folder):
    found = dashboard.box_plot(_per_deal(spark, folder), ["is_won"], "amount")
    return _with_money(
        found, "minimum", "first_quartile", "median", "third_quartile", "maximum", scale=4
    )


@query
def d11_kpi_target(spark, folder):
    return dashboard.kpi_target(_per_deal(spark, folder), F.count_if("is_won"), _count())


@query
def d11_kpi_trend(spark, folder):
    return dashboard.kpi_trend(
        _per_deal(spark, folder), F.count_if("is_won"), _count(), "created_at", "YEAR"
    )


@query
def d12_quartile_band(spark, folder):
    totals = dashboard.agg_dataset(
        _per_deal(spark, folder),
        ["owner_name"],
        [_count().alias("deals"), dashboard.measure("sales_cycle_days", "SUM", "days")],
    )
    return dashboard.quartile_band(totals, "days")


@query
def d13_hierarchy_rollup(spark, folder):
    return dashboard.hierarchy_rollup(
        view(spark, folder, "deals_latest"), ["deal_stage", "source"], [_count().alias("deals")]
    )


@query
def d14_scatter_points(spark, folder):
    return dashboard.scatter_points(
        _per_deal(spark, folder), ["owner_name"], _count(), dashboard.measure("sales_cycle_days", "AVERAGE")
    )


@query
def d14_raw_points(spark, folder):
    points = dashboard.scatter_points(
        _per_deal(spark, folder), ["deal_id"], F.col("sales_cycle_days"), F.col("amount"), False
    )
    return _with_money(points, "y")
