"""Every operator as a query over the given tables, next to the SQL that must give the same rows.

A query is a function of (session, data folder); its SQL runs in DuckDB on the same files.
"""

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from orderlake import fixtures, schemas
from orderlake.fixtures import MANY_FILES, sales_sql_duckdb, scratch_dir, table
from orderlake.functions.parsing import parse_int
from orderlake.functions.paths import archive_key, content_checksum, iso_utc, landing_name
from orderlake.lake import Lake, tidy_session
from orderlake.operators import ledger as L
from orderlake.operators.bronze import add_lineage, conform_columns
from orderlake.operators.checks import duplicate_orders, layer_counts
from orderlake.operators.latest import ORDERING, latest_per_order
from orderlake.operators.metrics import load_metrics, refresh_metrics, refresh_report
from orderlake.operators.split import quarantine, valid_order
from orderlake.operators.typed import flag_and_impute_region, typed_orders
from orderlake.plans.admission import admit_folder
from orderlake.plans.ingest import bronze_rows, load_reports, widest_header, write_manifest
from orderlake.plans.silver import refresh, silver_current
from orderlake.sinks.tables import (
    append_bronze,
    append_ledger,
    create_tables,
    overwrite_quarantine,
    overwrite_silver,
    publish_tables,
)
from orderlake.sources.csv import match_headers, read_csv
from orderlake.sources.events import landing_keys
from orderlake.sources.landing import describe_files, filter_landing_keys, scan_landing
from orderlake.sources.tables import between_dates, read_bronze, read_layers, read_ledger, read_silver
from orderlake.streaming.ingest import run_ingest, start_event_ingest, start_ingest, start_listing_ingest

QUERIES = {}
ORACLES = {}

AS_OF = "2026-03-01 00:00:00"
AS_OF_SQL = f"timestamp '{AS_OF}'"
DATA = ", ".join(schemas.DATA_COLUMNS)
BUCKET = "lake-bucket"


def query(sql: str, name: str | None = None):
    """Register a query under its function's name, or another where an operator has that name."""

    def register(function):
        QUERIES[name or function.__name__] = function
        ORACLES[name or function.__name__] = sql
        return function

    return register


def as_of():
    return F.lit(AS_OF).cast("timestamp")


def stored_bronze(spark: SparkSession, sf_dir: str) -> Lake:
    """A new lake whose bronze table holds the sales rows."""
    lake = Lake(scratch_dir(spark))
    append_bronze(fixtures.bronze(spark, sf_dir), lake, "first")
    return lake


# ---- SQL side: the layers as named subqueries ---------------------------------------------------

NO_ORDER = "(order_id is null or trim(order_id) = '')"
NO_REGION = "(region is null or trim(region) = '')"
INT_SQL = r"""case when regexp_full_match({0}, '\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]*)\s*')
 then try_cast(concat(regexp_extract({0}, '^\s*([+-]?)([0-9]*)', 1), '0',
                      regexp_extract({0}, '^\s*([+-]?)([0-9]*)', 2)) as int) end"""
DATE_SQL = "cast(try_strptime({0}, '%m/%d/%Y') as date)"


def typed_sql(source: str) -> str:
    return f"""select region, country, item_type, sales_channel, order_priority,
 {DATE_SQL.format('order_date')} as order_date, order_id, {DATE_SQL.format('ship_date')} as ship_date,
 {INT_SQL.format('units_sold')} as units_sold, try_cast(unit_price as double) as unit_price,
 try_cast(unit_cost as double) as unit_cost, try_cast(total_revenue as double) as total_revenue,
 try_cast(total_cost as double) as total_cost, try_cast(total_profit as double) as total_profit,
 cast(year({DATE_SQL.format('order_date')}) as int) as order_year, region_is_synthetic,
 _ingested_at, _source_file, {AS_OF_SQL} as _transformed_at from {source}"""


def layers_sql(source_file: str = fixtures.FEW_FILES) -> str:
    newest = ", ".join(f"{name} desc nulls last" for name in ORDERING)
    return f"""with bronze as (
 select *, sha256(_source_file) as _checksum_sha256 from ({sales_sql_duckdb(source_file)})),
valid as (select * from bronze where not {NO_ORDER}),
imputed as (select * replace (case when {NO_REGION} then 'UNKNOWN' else trim(region) end as region),
  {NO_REGION} as region_is_synthetic from valid),
ranked as (select *, row_number() over (partition by order_id order by {newest}) as rn from valid),
latest as (select * exclude (rn) from ranked where rn = 1),
cleaned as (select * replace (case when {NO_REGION} then 'UNKNOWN' else trim(region) end as region),
  {NO_REGION} as region_is_synthetic from latest),
silver as ({typed_sql('cleaned')}),
quarantine as (select {DATA}, _ingested_at, _source_file, 'missing_order_id' as _quarantine_reason,
  {AS_OF_SQL} as _quarantined_at from bronze where {NO_ORDER})
"""


# ---- bronze -------------------------------------------------------------------------------------


@query(layers_sql() + "select * from bronze")
def sales_bronze(spark, sf_dir) -> DataFrame:
    """Header rename, fixed column order, lineage columns."""
    rows = fixtures.sales(spark, sf_dir)
    raw = rows.select(
        *[F.col(name).alias(header) for header, name in schemas.HEADER_MAP.items()],
        F.lit("x").alias("Not Wanted"), "_ingested_at", "_source_file",
    )
    data = conform_columns(raw, ["_ingested_at", "_source_file"])
    source = F.col("_source_file")
    return add_lineage(data, source, F.sha2(source, 256), F.col("_ingested_at"))


@query(
    layers_sql()
    + "select * exclude (_ingested_at, _checksum_sha256)"
    + " replace (cast(null as varchar) as region, cast(null as varchar) as total_profit) from bronze"
)
def missing_columns_filled(spark, sf_dir) -> DataFrame:
    """One column absent, one under a name of another case: both are NULL."""
    rows = fixtures.sales(spark, sf_dir)
    headers = {header: name for header, name in schemas.HEADER_MAP.items() if header != "Total Profit"}
    raw = rows.select(
        *[F.col(name).alias("region" if header == "Region" else header)
          for header, name in headers.items()],
        "_source_file",
    )
    return conform_columns(raw, ["_source_file"])


@query(layers_sql() + f"select {DATA} from bronze")
def csv_scan(spark, sf_dir) -> DataFrame:
    """A folder of plain CSV files with header."""
    path = f"{scratch_dir(spark)}/csv"
    rows = fixtures.sales(spark, sf_dir)
    (
        rows.select(*[F.col(name).alias(header) for header, name in schemas.HEADER_MAP.items()])
        .write.option("header", "true")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .csv(path)
    )
    return conform_columns(read_csv(spark, path))


@query(
    layers_sql()
    + f"""select _source_file, count(*) as row_count,
 cast(count_if({NO_REGION}) as bigint) as missing_region,
 cast(count_if({NO_ORDER}) as bigint) as missing_order_id from bronze group by _source_file""",
    name="load_metrics",
)
def load_report(spark, sf_dir) -> DataFrame:
    """Load metrics per source file."""
    return load_metrics(fixtures.bronze(spark, sf_dir))


# ---- split, silver, quarantine ------------------------------------------------------------------


@query(layers_sql() + "select * from quarantine")
def quarantine_rows(spark, sf_dir) -> DataFrame:
    return quarantine(fixtures.bronze(spark, sf_dir), as_of())


@query(layers_sql() + "select * from valid")
def valid_rows(spark, sf_dir) -> DataFrame:
    return valid_order(fixtures.bronze(spark, sf_dir))


@query(layers_sql() + "select * from imputed")
def region_imputed(spark, sf_dir) -> DataFrame:
    return flag_and_impute_region(valid_order(fixtures.bronze(spark, sf_dir)))


@query(layers_sql() + typed_sql("imputed"), name="typed_orders")
def typed_rows(spark, sf_dir) -> DataFrame:
    """Typed projection of all valid rows, before deduplication."""
    return typed_orders(
        flag_and_impute_region(valid_order(fixtures.bronze(spark, sf_dir))), as_of()
    )


# Texts an integer cast meets, made of every order: plain, signed, spaced, with a fraction, broken.
NUMBER_TEXTS = """select o_orderkey, concat(
 case o_orderkey % 5 when 0 then '' when 1 then '+' when 2 then '-' when 3 then ' ' else '--' end,
 cast(o_orderkey * (case when o_orderkey % 3 = 0 then 1 else 1000003 end) as varchar(20)),
 case o_orderkey % 7 when 0 then '' when 1 then '.' when 2 then '.75' when 3 then ' '
  when 4 then 'e3' when 5 then '.1.2' else 'd' end) as number_text from {orders}"""


@query(
    f"select o_orderkey, number_text, {INT_SQL.format('number_text')} as number"
    f" from ({NUMBER_TEXTS.format(orders='orders')})"
)
def integer_texts(spark, sf_dir) -> DataFrame:
    texts = spark.sql(NUMBER_TEXTS.format(orders="{orders}"), orders=table(spark, sf_dir, "orders"))
    return texts.withColumn("number", parse_int("number_text"))


@query(layers_sql() + "select * from latest", name="latest_per_order")
def latest_rows(spark, sf_dir) -> DataFrame:
    return latest_per_order(valid_order(fixtures.bronze(spark, sf_dir)))


@query(layers_sql() + "select * from silver", name="silver_current")
def silver_rows(spark, sf_dir) -> DataFrame:
    """The flagship: typed, one row per order."""
    return silver_current(fixtures.bronze(spark, sf_dir), as_of())


REPORT_SQL = f"""select raw_count, raw_count - quarantine_count as clean_count,
 raw_count - quarantine_count - silver_count as duplicate_count, silver_count, quarantine_count,
 synthetic_region_count from (
 select (select count(*) from bronze) as raw_count, (select count(*) from quarantine) as quarantine_count,
 (select count(*) from silver) as silver_count,
 (select count(*) from valid where {NO_REGION}) as synthetic_region_count)"""


@query(layers_sql() + REPORT_SQL, name="refresh_report")
def refresh_counts(spark, sf_dir) -> DataFrame:
    bronze = fixtures.bronze(spark, sf_dir)
    return refresh_report(refresh_metrics(bronze), silver_current(bronze))


@query(layers_sql() + REPORT_SQL)
def stored_refresh(spark, sf_dir) -> DataFrame:
    """The whole refresh on stored tables; its report."""
    return refresh(spark, stored_bronze(spark, sf_dir), "once", as_of()).drop("silver_run_id")


# ---- checks -------------------------------------------------------------------------------------

LAYER_COUNTS_SQL = """select 'bronze' as layer, count(*) as "rows" from bronze
 union all select 'silver', count(*) from silver union all select 'quarantine', count(*) from quarantine"""


@query(layers_sql() + LAYER_COUNTS_SQL, name="layer_counts")
def layer_sizes(spark, sf_dir) -> DataFrame:
    bronze = fixtures.bronze(spark, sf_dir)
    return layer_counts(bronze, silver_current(bronze), quarantine(bronze))


@query(layers_sql() + LAYER_COUNTS_SQL)
def layer_sizes_in_sql(spark, sf_dir) -> DataFrame:
    """Catalog tables over a refreshed lake, read with SQL; the three counts outlive the database."""
    lake = stored_bronze(spark, sf_dir)
    database = os.path.basename(lake.root).replace("-", "_")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{lake.root}/{database}.db'")
    create_tables(spark, lake, database)
    refresh(spark, lake, "once", as_of())
    publish_tables(spark, database)
    layers = ("bronze", "silver", "quarantine")
    counts = spark.sql(
        " UNION ALL ".join(
            f"SELECT '{name}' AS layer, COUNT(*) AS rows FROM {database}.sales_{name}" for name in layers
        )
    )
    result = spark.createDataFrame(counts.collect(), counts.schema)
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return result


DUPLICATES_SQL = "select order_id, count(*) as duplicate_count from {0} group by order_id having count(*) > 1"


@query(layers_sql() + DUPLICATES_SQL.format("bronze"))
def duplicate_orders_bronze(spark, sf_dir) -> DataFrame:
    return duplicate_orders(fixtures.bronze(spark, sf_dir))


@query(layers_sql() + DUPLICATES_SQL.format("silver"))
def duplicate_orders_silver(spark, sf_dir) -> DataFrame:
    """No row, or silver is broken."""
    return duplicate_orders(silver_current(fixtures.bronze(spark, sf_dir)))


# ---- sinks --------------------------------------------------------------------------------------


@query(
    layers_sql()
    + "select * from silver where order_date between date '1995-03-01' and date '1996-09-30'"
)
def silver_year_slice(spark, sf_dir) -> DataFrame:
    """Stored silver, two dates; Spark reads the folders of two years."""
    lake = Lake(scratch_dir(spark))
    overwrite_silver(silver_current(fixtures.bronze(spark, sf_dir), as_of()), lake)
    return between_dates(read_silver(spark, lake), "1995-03-01", "1996-09-30")


@query(layers_sql() + "select * from silver where order_year >= 1995")
def overwrite_static(spark, sf_dir) -> DataFrame:
    """A smaller silver over a larger one: nothing of the larger one may stay."""
    lake = Lake(scratch_dir(spark))
    silver = silver_current(fixtures.bronze(spark, sf_dir), as_of())
    overwrite_silver(silver, lake)
    overwrite_silver(silver.filter("order_year >= 1995"), lake)
    return read_silver(spark, lake)


THIRD = "cast(substring(coalesce(total_revenue, '0'), length(coalesce(total_revenue, '0')), 1) as int) % 3"


def third(bronze: DataFrame, number: int) -> DataFrame:
    """A third of the rows; rows of one order, and such that tie, are in several of them."""
    return bronze.filter(F.expr(THIRD) == number)


@query(layers_sql() + "select * from silver")
def incremental_refresh(spark, sf_dir) -> DataFrame:
    """Silver after three batches, each with a refresh of its own that reads the new rows only."""
    lake = Lake(scratch_dir(spark))
    bronze = fixtures.stored(fixtures.bronze(spark, sf_dir))
    for number in range(3):
        append_bronze(third(bronze, number), lake, f"batch-{number}")
        refresh(spark, lake, f"run-{number}", as_of())
    return read_silver(spark, lake)


@query(layers_sql() + REPORT_SQL)
def incremental_report(spark, sf_dir) -> DataFrame:
    """The counts that the last of three refreshes reports."""
    lake = Lake(scratch_dir(spark))
    bronze = fixtures.stored(fixtures.bronze(spark, sf_dir))
    for number in range(3):
        append_bronze(third(bronze, number), lake, f"batch-{number}")
        report = refresh(spark, lake, f"run-{number}", as_of())
    return report.drop("silver_run_id")


@query(
    layers_sql()
    + f"select *, (select count(*) from quarantine where {THIRD} = 0) as quarantine_then,"
    + " (select count(*) from quarantine) as quarantine_now from quarantine where " + f"{THIRD} = 0"
)
def snapshot_reader(spark, sf_dir) -> DataFrame:
    """Rows that a reader has taken up before another refresh, and reads after it; with the sizes of both."""
    lake = Lake(scratch_dir(spark))
    bronze = fixtures.bronze(spark, sf_dir)
    append_bronze(third(bronze, 0), lake, "first")
    refresh(spark, lake, "first", as_of())
    _, then = read_layers(spark, lake)
    append_bronze(bronze.filter(F.expr(THIRD) != 0), lake, "second")
    refresh(spark, lake, "second", as_of())
    _, now = read_layers(spark, lake)
    sizes = then.agg(F.count("*").alias("quarantine_then")).crossJoin(now.agg(F.count("*").alias("quarantine_now")))
    return then.crossJoin(sizes)


@query(layers_sql() + "select * from bronze union all select * from bronze")
def append_replay(spark, sf_dir) -> DataFrame:
    """Two batches, the first of them written twice."""
    bronze = fixtures.stored(fixtures.bronze(spark, sf_dir))
    lake = Lake(scratch_dir(spark))
    for batch in ("first", "first", "second"):
        append_bronze(bronze, lake, batch)
    return read_bronze(spark, lake)


# ---- files, checksums, ledger -------------------------------------------------------------------

FILES_SQL = """files as (select doc_id, key as path, key as landing_key,
 timestamp '2026-02-01 00:00:00' + ((doc_id % 100) * interval '1' second) as landed_at,
 cast(strlen(text) as bigint) as size_bytes, sha256(text) as checksum_sha256
 from (select *, concat('landing/ingest_date=2026-02-', lpad(cast(doc_id % 28 + 1 as varchar), 2, '0'),
  '/doc_', cast(doc_id as varchar), '.zip') as key from documents))"""
FIRSTS_SQL = (
    FILES_SQL
    + """, marked as (select *, row_number() over
 (partition by checksum_sha256 order by landed_at, path) = 1 as is_first_copy from files)"""
)
# A ledger made of the documents: five of six are registered, under one of five states.
REGISTERED_STATUS = """case doc_id % 6 when 0 then 'uploaded' when 1 then 'processing'
 when 2 then 'bronze_loaded' when 3 then 'completed' when 4 then 'failed' end"""
STATE_SQL = f""", state as (select checksum_sha256, arg_max(status, doc_id) as status from
 (select checksum_sha256, doc_id, {REGISTERED_STATUS} as status from files)
 where status is not null group by checksum_sha256)"""


def files_and_state(spark, sf_dir):
    files = fixtures.document_files(table(spark, sf_dir, "documents"))
    known = files.withColumn("state", F.expr(REGISTERED_STATUS)).filter("state IS NOT NULL")
    events = L.ledger_events(known, "put", F.col("doc_id"), status=F.col("state"))
    return files, L.current_state(events)


@query("select doc_id, sha256(text) as checksum_sha256 from documents")
def content_checksums(spark, sf_dir) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", content_checksum("text").alias("checksum_sha256"))


@query("with " + FIRSTS_SQL + " select * from marked")
def content_dedup(spark, sf_dir) -> DataFrame:
    """Files with a mark on the first copy of each content."""
    return L.mark_first_copies(fixtures.document_files(table(spark, sf_dir, "documents")))


@query(
    "with " + FIRSTS_SQL + STATE_SQL
    + """ select m.* exclude (is_first_copy), case when not is_first_copy then 'skipped_duplicate'
 when status in ('uploaded', 'processing', 'bronze_loaded', 'completed') then 'skipped_duplicate'
 else 'uploaded' end as decision from marked m left join state s using (checksum_sha256)"""
)
def admission_decisions(spark, sf_dir) -> DataFrame:
    return L.admit(*files_and_state(spark, sf_dir))


@query(
    "with " + FIRSTS_SQL + STATE_SQL
    + """ select m.* exclude (is_first_copy) from marked m left join state s using (checksum_sha256)
 where is_first_copy and (status is null or status = 'failed')"""
)
def admitted_files(spark, sf_dir) -> DataFrame:
    return L.accepted(*files_and_state(spark, sf_dir))


@query(
    "with " + FIRSTS_SQL + STATE_SQL
    + """ select m.* exclude (is_first_copy), case when not is_first_copy or status = 'completed' then 'SKIPPED'
 when status = 'bronze_loaded' then 'RECOVERED' else 'PROCESS' end as action
 from marked m left join state s using (checksum_sha256)"""
)
def ingest_actions(spark, sf_dir) -> DataFrame:
    return L.plan_ingest(*files_and_state(spark, sf_dir))


# Ledger events made of the orders: a customer is a content, an order one event about it.
ORDER_TEXT = "cast(o_orderkey as varchar(20))"
EVENT_COLUMNS = [
    "o_orderkey as seq",
    "case when o_orderkey % 11 = 0 then 'put' else 'set' end as op",
    "case o_orderstatus when 'F' then 'completed' when 'O' then 'processing' end as status",
    f"case when o_orderkey % 3 = 0 then concat('landing/', {ORDER_TEXT}, '.zip') end as landing_key",
    f"case when o_orderkey % 5 = 0 then concat('t', {ORDER_TEXT}) end as uploaded_at",
    "case when o_orderkey % 7 = 0 then o_orderkey end as size_bytes",
    f"case when o_orderkey % 4 = 1 then concat('p', {ORDER_TEXT}) end as processing_started_at",
    f"case when o_orderkey % 4 = 2 then concat('b', {ORDER_TEXT}) end as bronze_loaded_at",
    "case when o_orderkey % 4 = 2 then o_orderkey * 2 end as bronze_row_count",
    f"case when o_orderkey % 4 = 3 then concat('c', {ORDER_TEXT}) end as completed_at",
    f"case when o_orderkey % 4 = 3 then concat('archive/', {ORDER_TEXT}) end as archive_key",
    f"case when o_orderkey % 4 = 3 then concat('run', {ORDER_TEXT}) end as silver_run_id",
]
EVENTS_SQL = (
    "select sha256(cast(o_custkey as varchar)) as checksum_sha256, "
    + ", ".join(EVENT_COLUMNS)
    + " from orders"
)


def state_sql(events: str) -> str:
    """Last value per attribute since the last put, from a table `events`."""
    values = ", ".join(
        f"arg_max({name}, seq) filter ({name} is not null and seq >= coalesce(last_put, 0)) as {name}"
        for name in schemas.LEDGER_ATTRIBUTES.names
    )
    return f"""select checksum_sha256, {values} from (select *, max(case when op = 'put' then seq end)
 over (partition by checksum_sha256) as last_put from {events}) group by checksum_sha256"""


@query(state_sql(f"({EVENTS_SQL})"))
def ledger_current(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    checksum = "sha2(cast(o_custkey as string), 256) as checksum_sha256"
    return L.current_state(orders.selectExpr(checksum, *EVENT_COLUMNS))


def _null(*names):
    return ", ".join(f"null as {name}" for name in names)


ISO_SQL = "concat(strftime({0}, '%Y-%m-%dT%H:%M:%S'), '.000000+00:00')"
ARCHIVE_SQL = """concat('archive/ingest_date=', {0}, '/', checksum_sha256[1:12], '_',
 regexp_extract(landing_key, '[^/]*$'))"""
DATE_OF_KEY = "regexp_extract(landing_key, 'ingest_date=([^/]*)', 1)"
TRANSITIONS_SQL = f"""transitions as (
 select doc_id * 4 + 1 as seq, 'put' as op, checksum_sha256, 'uploaded' as status, landing_key,
  {ISO_SQL.format('landed_at')} as uploaded_at, size_bytes, {_null('processing_started_at', 'bronze_loaded_at')},
  cast(null as bigint) as bronze_row_count, {_null('completed_at', 'archive_key', 'silver_run_id')} from files
 union all select doc_id * 4 + 2, 'set', checksum_sha256, 'processing', landing_key, null, null,
  {ISO_SQL.format("landed_at + interval '1' minute")}, null, null, null, null, null from files
 union all select doc_id * 4 + 3, 'set', checksum_sha256, 'bronze_loaded', landing_key, null, null, null,
  {ISO_SQL.format("landed_at + interval '2' minute")}, size_bytes, null, null, null from files
 union all select doc_id * 4 + 4, 'set', checksum_sha256, 'completed', null, null, null, null, null, null,
  {ISO_SQL.format("landed_at + interval '3' minute")}, {ARCHIVE_SQL.format(DATE_OF_KEY)},
  concat('run-', cast(doc_id as varchar)) from files)"""


def transitions(spark, sf_dir):
    """All four events of every document file; copies of a content write to the same item."""
    files = fixtures.document_files(table(spark, sf_dir, "documents")).withColumn(
        "row_count", F.col("size_bytes")
    )

    def seq(step):
        return F.col("doc_id") * 4 + step

    def at(minutes):
        return iso_utc(F.timestamp_add("MINUTE", F.lit(minutes), "landed_at"))

    key = archive_key("landing_key", "checksum_sha256", as_of())
    run = F.concat(F.lit("run-"), F.col("doc_id").cast("string"))
    steps = [
        L.register_uploads(files, seq(1), at(0)),
        L.mark_processing(files, seq(2), at(1)),
        L.mark_bronze_loaded(files, seq(3), at(2)),
        L.mark_completed(files, seq(4), at(3), key, run),
    ]
    return steps[0].unionByName(steps[1]).unionByName(steps[2]).unionByName(steps[3])


@query("with " + FILES_SQL + ", " + TRANSITIONS_SQL + " select * from transitions")
def ledger_transitions(spark, sf_dir) -> DataFrame:
    return transitions(spark, sf_dir)


@query(
    "with " + FILES_SQL + ", " + TRANSITIONS_SQL
    + f""", state as ({state_sql('transitions')}) select checksum_sha256 as checksum, status,
 landing_key as landing, archive_key as archive, bronze_row_count as "rows" from state"""
)
def ledger_list(spark, sf_dir) -> DataFrame:
    return L.ledger_listing(L.current_state(transitions(spark, sf_dir)))


@query(
    "with " + FILES_SQL
    + f""", keyed as (select * replace (case when doc_id % 3 = 0
  then concat('landing/doc_', cast(doc_id as varchar), '.zip') else landing_key end as landing_key) from files)
 select doc_id, landing_key, {ARCHIVE_SQL.format(
     f"case when contains(landing_key, '/ingest_date=') then {DATE_OF_KEY} else '2026-03-01' end")} as archive_key,
 concat('landing/ingest_date=', strftime(landed_at, '%Y-%m-%d'), '/sales_',
  strftime(landed_at, '%Y%m%dT%H%M%SZ'), '.zip') as landing_name from keyed"""
)
def archive_paths(spark, sf_dir) -> DataFrame:
    """Archive keys of landing keys with and without a date, and names for new files."""
    files = fixtures.document_files(table(spark, sf_dir, "documents"))
    undated = F.concat(F.lit("landing/doc_"), F.col("doc_id").cast("string"), F.lit(".zip"))
    keyed = files.withColumn(
        "landing_key", F.when(F.col("doc_id") % 3 == 0, undated).otherwise(F.col("landing_key"))
    )
    return keyed.select(
        "doc_id",
        "landing_key",
        archive_key("landing_key", "checksum_sha256", as_of()).alias("archive_key"),
        landing_name(F.col("landed_at")).alias("landing_name"),
    )


KEYS_SQL = """select doc_id, concat(
 case doc_id % 5 when 0 then 'landing/' when 1 then 'landing/ingest_date=2026-01-01/' when 2 then 'Landing/'
  when 3 then 'other/landing/' else 'landing/a b/' end, 'doc_', cast(doc_id as varchar(20)),
 case doc_id % 7 when 0 then '.zip' when 1 then '.ZIP' when 2 then '.Zip' when 3 then '.zip.txt'
  when 4 then 'zip' when 5 then '.csv' else '.zIP' end) as landing_key from {documents}"""


@query(
    f"select * from ({KEYS_SQL.format(documents='documents')})"
    " where starts_with(landing_key, 'landing/') and ends_with(lower(landing_key), '.zip')",
    name="landing_keys",
)
def landing_zip_keys(spark, sf_dir) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return filter_landing_keys(spark.sql(KEYS_SQL.format(documents="{documents}"), documents=documents))


# Storage notifications made of the events: three shapes, foreign buckets and sources, null and
# empty keys, nothing at all; keys with escapes, right and wrong ones.
NOTICE_KEY = """concat(case when user_id % 9 = 0 then 'other/' else 'landing/' end, event_type, '+',
 case user_id % 4 when 0 then 'a%20b' when 1 then 'caf%C3%A9' when 2 then '100%' else 'x%2By' end, '_',
 cast(event_id as varchar(20)),
 case when user_id % 5 = 0 then '.ZIP' when user_id % 11 = 0 then '.txt' else '.zip' end)"""
RECORD = """concat('"Records": [{"eventSource": "aws:s3", "s3": {"object": {"key": "', key, '"}}}, {"eventSource": "x"}]}')"""
DETAIL = """concat('"detail": {"bucket": {"name": "lake-bucket"}, "object": {"key": "', key, '"}}}')"""
NOTICE = f"""case event_id % 10
 when 0 then concat('{{"landing_key": "', key, '"}}')
 when 1 then concat('{{"source": "aws.s3", "detail-type": "Object ', case when (event_id - event_id % 10) % 30 = 0 then 'Deleted' else 'Created' end, '", ', {DETAIL})
 when 2 then concat('{{', {RECORD})
 when 3 then concat('{{"detail": {{"bucket": {{"name": "other"}}, "object": {{"key": "', key, '"}}}}}}')
 when 4 then concat('{{"Records": [{{"eventSource": "aws:sns", "s3": {{"object": {{"key": "', key, '"}}}}}}]}}')
 when 5 then concat('{{"landing_key": null, ', {DETAIL})
 when 6 then concat('{{"detail": {{}}, ', {RECORD})
 when 7 then '{{}}'
 when 8 then concat('{{"landing_key": "", ', {RECORD})
 else concat('{{"detail": {{"bucket": {{"name": "lake-bucket"}}, "object": {{"key": ""}}}}, ', {RECORD}) end"""
KEY_OF_NOTICE_SQL = """case when json_exists(event, '$.landing_key') then event->>'$.landing_key'
 when event->>'$.detail.bucket.name' = 'lake-bucket' and event->>'$.detail.object.key' <> ''
   and coalesce(event->>'$."detail-type"', 'Object Created') = 'Object Created' then event->>'$.detail.object.key'
 when event->>'$.Records[0].eventSource' = 'aws:s3' then event->>'$.Records[0].s3.object.key' end"""


@query(
    f"""with notices as (select event_id, {NOTICE} as event from (select event_id, {NOTICE_KEY} as key from events)),
 decoded as (select event_id, event, url_decode(replace({KEY_OF_NOTICE_SQL}, '+', ' ')) as landing_key from notices)
 select * from decoded where starts_with(landing_key, 'landing/') and ends_with(lower(landing_key), '.zip')""",
    name="event_keys",
)
def notified_keys(spark, sf_dir) -> DataFrame:
    events = fixtures.spread(table(spark, sf_dir, "events"))
    keyed = events.selectExpr("event_id", f"{NOTICE_KEY} as key")
    return landing_keys(keyed.selectExpr("event_id", f"{NOTICE} as event"), BUCKET)


# ---- ZIP files and the stream -------------------------------------------------------------------

MANY_SALES_SQL = f"select {DATA}, _source_file from ({sales_sql_duckdb(MANY_FILES)})"


@query(MANY_SALES_SQL)
def zip_roundtrip(spark, sf_dir) -> DataFrame:
    """Sales rows -> ZIPs -> checksums, headers, lines -> the same rows."""
    lake = Lake(scratch_dir(spark))
    fixtures.land_sales(spark, sf_dir, lake.root)
    manifest = write_manifest(scan_landing(spark, lake), lake, "once")
    rows = bronze_rows(match_headers(manifest, widest_header(manifest)), as_of())
    return rows.select(*schemas.DATA_COLUMNS, "_source_file")


@query(MANY_SALES_SQL)
def stream_ingest(spark, sf_dir) -> DataFrame:
    """Two runs of the stream; before the second every ZIP lands again under another name, and
    must not be loaded again."""
    root = scratch_dir(spark)
    lake = Lake(f"{root}/lake")
    fixtures.land_sales(spark, sf_dir, lake.root)
    run_ingest(spark, lake, archive=False)
    fixtures.land_copies(describe_files(scan_landing(spark, lake), lake), lake)
    run_ingest(spark, lake, archive=False)
    return read_bronze(spark, lake).select(*schemas.DATA_COLUMNS, "_source_file")


@query(layers_sql(MANY_FILES) + "select * exclude (_transformed_at) from silver")
def stream_recovery(spark, sf_dir) -> DataFrame:
    """Bronze was loaded and marked, then the run stopped: the next run refreshes silver and
    completes the files, but loads nothing."""
    root = scratch_dir(spark)
    lake = Lake(f"{root}/lake")
    work = tidy_session(spark)
    rows = fixtures.sales(work, sf_dir, MANY_FILES)
    append_bronze(rows.withColumn("_checksum_sha256", F.lit("earlier")), lake, "earlier")
    # The ZIPs are made of the stored rows, which are joined once.
    fixtures.write_zips(fixtures.to_csv_lines(read_bronze(work, lake)), lake.root).count()
    loaded = write_manifest(scan_landing(spark, lake), lake, "earlier").withColumn(
        "row_count", F.lit(0)
    )
    append_ledger(L.mark_bronze_loaded(loaded, F.lit(1), iso_utc(as_of())), lake, 1)
    start_ingest(spark, lake, f"{root}/checkpoint", archive=False).awaitTermination()
    return read_silver(spark, lake).drop("_transformed_at")


def land_hidden(spark: SparkSession, sf_dir: str, lake: Lake) -> None:
    """The sales ZIPs, a quarter of them under hidden names."""
    mark = F.when(F.col("_source_file").endswith("1.zip"), "/_sales_").when(
        F.col("_source_file").endswith("2.zip"), "/.sales_"
    )
    hidden = F.replace("_source_file", F.lit("/sales_"), F.coalesce(mark, F.lit("/sales_")))
    rows = fixtures.sales(spark, sf_dir, MANY_FILES).withColumn("_source_file", hidden)
    fixtures.write_zips(fixtures.to_csv_lines(rows), lake.root).count()


HIDDEN_SQL = """regexp_replace(_source_file, '/sales_', case when ends_with(_source_file, '1.zip') then '/_sales_'
 when ends_with(_source_file, '2.zip') then '/.sales_' else '/sales_' end)"""


@query(f"select {DATA}, {HIDDEN_SQL} as _source_file, 0::bigint as left_in_landing from ({MANY_SALES_SQL})")
def listing_stream(spark, sf_dir) -> DataFrame:
    """Bronze rows after the first round of an endless stream over the landing folder, and how many files it left."""
    root = scratch_dir(spark)
    lake = Lake(f"{root}/lake")
    land_hidden(spark, sf_dir, lake)
    stream = start_listing_ingest(spark, lake, f"{root}/checkpoint", "1 hour", max_files=50)
    try:
        while stream.isActive and not stream.recentProgress:
            stream.awaitTermination(1)
    finally:
        stream.stop()
    if stream.exception():
        raise stream.exception()
    left = scan_landing(spark, lake).count()
    rows = read_bronze(spark, lake).select(*schemas.DATA_COLUMNS, "_source_file")
    return rows.withColumn("left_in_landing", F.lit(left).cast("bigint"))


@query(f"select distinct regexp_replace(_source_file, '/sales_', case when ends_with(_source_file, '1.zip') then '/_sales_'"
       f" when ends_with(_source_file, '2.zip') then '/.sales_' else '/sales_' end) as landing_key from ({MANY_SALES_SQL})")
def landing_scan_names(spark, sf_dir) -> DataFrame:
    """Landed files, some under names that Spark's own file sources leave out."""
    lake = Lake(scratch_dir(spark))
    land_hidden(spark, sf_dir, lake)
    return describe_files(scan_landing(spark, lake), lake).select("landing_key")


@query(" union all ".join([f"select {DATA}, _source_file from ({MANY_SALES_SQL})"] * 3))
def replaced_file(spark, sf_dir) -> DataFrame:
    """Every file is replaced under its name by one with each line twice, and both are loaded."""
    lake = Lake(scratch_dir(spark))
    fixtures.land_sales(spark, sf_dir, lake.root)
    run_ingest(spark, lake, archive=False)
    fixtures.double_lines(describe_files(scan_landing(spark, lake), lake), lake.root)
    run_ingest(spark, lake, archive=False)
    return read_bronze(spark, lake).select(*schemas.DATA_COLUMNS, "_source_file")


@query(f"""select _source_file as landing_key, case when ends_with(_source_file, '_3.zip') then 'FAILURE' else 'SUCCESS' end as outcome,
 case when not ends_with(_source_file, '_3.zip') then count(*) end as row_count from ({MANY_SALES_SQL}) group by 1, 2""")
def stream_bad_files(spark, sf_dir) -> DataFrame:
    """An eighth of the ZIPs is damaged inside; the stream loads the others and says so of each."""
    root = scratch_dir(spark)
    lake = Lake(f"{root}/lake")
    fixtures.land_sales(spark, sf_dir, lake.root)
    landed = describe_files(scan_landing(spark, lake), lake)
    fixtures.damage_zips(landed.filter(F.col("landing_key").endswith("_3.zip")), lake.root)
    start_ingest(spark, lake, f"{root}/checkpoint", archive=False, refresh_each_batch=False).awaitTermination()
    return load_reports(spark, lake).select("landing_key", "outcome", "row_count")


@query(f"""select distinct 'archive/' || split_part(_source_file, '/', 2) || '/' || split_part(_source_file, '/', 3) as archived,
 true as in_ledger, 0::bigint as left_in_landing from ({MANY_SALES_SQL})""")
def archived_files(spark, sf_dir) -> DataFrame:
    """Files below the archive folder without the checksum in their name, whether the ledger names them, and
    how many files are left in the landing folder."""
    lake = Lake(scratch_dir(spark))
    fixtures.land_sales(spark, sf_dir, lake.root)
    run_ingest(spark, lake)
    left = scan_landing(spark, lake).count()
    listed = scan_landing(spark, lake, lake.archive).select(
        F.substring_index("path", f"{lake.root}/", -1).alias("archive_key")
    )
    named = L.current_state(read_ledger(spark, lake), ["archive_key"]).select("archive_key", F.lit(True).alias("named"))
    return listed.join(named, "archive_key", "left").select(
        F.regexp_replace("archive_key", "/[0-9a-f]{12}_", "/").alias("archived"),
        F.coalesce("named", F.lit(False)).alias("in_ledger"),
        F.lit(left).cast("bigint").alias("left_in_landing"),
    )


@query(f"select {DATA}, _source_file from ({MANY_SALES_SQL}) where not ends_with(_source_file, '_5.zip')")
def event_ingest(spark, sf_dir) -> DataFrame:
    """Bronze rows after a stream of notifications, each twice; those of an eighth of the files tell of a deletion."""
    root = scratch_dir(spark)
    lake = Lake(f"{root}/lake")
    fixtures.land_sales(spark, sf_dir, lake.root)
    key = F.col("landing_key")
    kind = F.when(key.endswith("_5.zip"), "Object Deleted").otherwise("Object Created")
    detail = F.struct(
        F.struct(F.lit(BUCKET).alias("name")).alias("bucket"), F.struct(key.alias("key")).alias("object")
    )
    notice = F.to_json(F.struct(kind.alias("detail-type"), F.lit("aws.s3").alias("source"), detail.alias("detail")))
    notices = describe_files(scan_landing(spark, lake), lake).select(notice.alias("event"))
    notices.union(notices).write.parquet(f"{root}/events")
    events = spark.readStream.schema("event STRING").parquet(f"{root}/events")
    start_event_ingest(events, lake, BUCKET, f"{root}/checkpoint", refresh_each_batch=False).awaitTermination()
    return read_bronze(spark, lake).select(*schemas.DATA_COLUMNS, "_source_file")


@query(MANY_SALES_SQL)
def stream_new_checkpoint(spark, sf_dir) -> DataFrame:
    """A batch wrote its bronze rows and was cut off before the ledger; a stream on another checkpoint loads
    the files, and each row is there once."""
    root = scratch_dir(spark)
    lake = Lake(f"{root}/lake")
    fixtures.land_sales(spark, sf_dir, lake.root)
    manifest = write_manifest(scan_landing(spark, lake), lake, "lost")
    append_ledger(L.mark_processing(manifest, F.lit(1), iso_utc(as_of())), lake, 1)
    append_bronze(bronze_rows(match_headers(manifest, widest_header(manifest)), as_of()), lake, "lost")
    start_ingest(spark, lake, f"{root}/checkpoint", archive=False, refresh_each_batch=False).awaitTermination()
    return read_bronze(spark, lake).select(*schemas.DATA_COLUMNS, "_source_file")


@query(f"select {DATA}, true as was_uploaded from ({MANY_SALES_SQL})")
def admit_and_land(spark, sf_dir) -> DataFrame:
    """Offered ZIPs are admitted, landed and registered, offered once more to no effect, then ingested; a row
    says whether its file had its `uploaded` item."""
    root = scratch_dir(spark)
    lake = Lake(f"{root}/lake")
    fixtures.write_zips(fixtures.to_csv_lines(fixtures.sales(spark, sf_dir, MANY_FILES)), f"{root}/offered").count()
    for _ in range(2):
        admit_folder(spark, lake, f"{root}/offered")
    puts = read_ledger(spark, lake).filter("op = 'put'").groupBy("landing_key").agg(F.count("*").alias("n"))
    run_ingest(spark, lake, archive=False)
    bronze = read_bronze(spark, lake)
    return bronze.join(puts, bronze["_source_file"] == puts["landing_key"], "left").select(
        *schemas.DATA_COLUMNS, (F.coalesce("n", F.lit(0)) == 1).alias("was_uploaded")
    )
