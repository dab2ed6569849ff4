"""The query catalogue: every operator run on the given tables, with its SQL oracle.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the whole tables.
Maps and arrays are returned flattened (joined text, counts, one row per entry) so
results can be compared value by value with the DuckDB statement of the same name.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.functions import lineage
from obslake.operators.fold import explode_attributes, map_to_wide, with_smart_attributes
from obslake.operators.merge import duplicate_keys, merge_frames
from obslake.operators.metrics import DAILY_RULES, PERIOD_RULES, broken_rules, daily_metrics, daily_rollup, period_metrics
from obslake.operators.resolve import precedence_rank, resolve_records, trusted_minus_conflicts
from obslake.operators.validate import typed_columns, validate_rows, with_diagnostics
from obslake.plans import sql as S
from obslake.plans.pipeline import (
    collapse_quarantine,
    quarantine_contract,
    run_gold,
    run_silver,
    silver_pass,
    trusted_contract,
    trusted_from,
)
from obslake.sources import views
from obslake.sources.snapshot import read_table, replace_path, replace_view, upsert_path, upsert_table
from obslake.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

PERIOD = (date.fromisoformat(S.PERIOD_START), date.fromisoformat(S.PERIOD_END))


def register(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def wrap(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn

    return wrap


def joined(column: str) -> F.Column:
    return F.array_join(F.col(column), ",")


# ---------------------------------------------------------------- Gold metrics (OBS)


@register("period_metrics", f"WITH {S.OBS} {S.period_sql('obs')}")
def q_period_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return period_metrics(views.observations(spark, sf_dir), *PERIOD)


@register(
    "period_ranking",
    f"WITH {S.OBS}, p AS ({S.period_sql('obs')}) SELECT * FROM p ORDER BY failures_per_million_drive_days DESC",
)
def q_period_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q_period_metrics(spark, sf_dir).orderBy(F.col("failures_per_million_drive_days").desc())


@register("daily_metrics", f"WITH {S.OBS} {S.daily_sql('obs')}")
def q_daily_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_metrics(views.observations(spark, sf_dir))


@register(
    "daily_rollup",
    f"""WITH {S.OBS}, d AS ({S.daily_sql('obs')})
SELECT model, CAST(SUM(failures) AS BIGINT) AS failures, CAST(SUM(drive_days) AS BIGINT) AS drive_days
FROM d GROUP BY model""",
)
def q_daily_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_rollup(q_daily_metrics(spark, sf_dir))


_DAILY_COLUMNS = ["date", "model", "active_drives", "failures", "drive_days"]
_PERIOD_COLUMNS = ["model", "unique_drives_observed", "failed_drives", "total_drive_days"]


def _named(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*columns, F.array_join(F.array_sort("broken"), "; ").alias("broken"))


@register("guard_daily", f"WITH {S.OBS}, d AS ({S.daily_sql('obs')}), {S.broken_sql('d', _DAILY_COLUMNS, S.DAILY_CHECKS)}")
def q_guard_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Metrics over unresolved observations: a drive seen twice on a day can fail twice.
    return _named(broken_rules(q_daily_metrics(spark, sf_dir), DAILY_RULES), _DAILY_COLUMNS)


#: Damage of one period row by its drive-days: each rule is broken by some model, some rows break two.
_DAMAGE = {
    "unique_drives_observed": "CASE total_drive_days % 7 WHEN 0 THEN 0 WHEN 1 THEN NULL ELSE unique_drives_observed END",
    "failed_drives": "CASE total_drive_days % 7 WHEN 2 THEN unique_drives_observed + 1 WHEN 3 THEN -failed_drives - 1 ELSE failed_drives END",
    "failures_per_million_drive_days": "CASE total_drive_days % 7 WHEN 4 THEN NULL ELSE failures_per_million_drive_days END",
    "total_drive_days": "CASE total_drive_days % 7 WHEN 5 THEN 0 ELSE total_drive_days END",
}


@register(
    "guard_period",
    f"""WITH {S.OBS}, p AS ({S.period_sql('obs')}),
q AS (SELECT * REPLACE ({', '.join(f'{sql} AS {c}' for c, sql in _DAMAGE.items())}) FROM p),
{S.broken_sql('q', _PERIOD_COLUMNS, S.PERIOD_CHECKS)}""",
)
def q_guard_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules that damaged period rows break."""
    damaged = q_period_metrics(spark, sf_dir).withColumns({c: F.expr(sql) for c, sql in _DAMAGE.items()})
    return _named(broken_rules(damaged, PERIOD_RULES), _PERIOD_COLUMNS)


@register(
    "guard_unique_key",
    """SELECT l_orderkey, l_linenumber, COUNT(*) AS occurrences FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""",
)
def q_guard_unique_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(views.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


# ---------------------------------------------------------------- validation (BRZ)


@register(
    "validate_typed",
    f"""WITH {S.DIAGNOSED}
SELECT t_date AS date, t_serial AS serial_number, model, t_capacity AS capacity_bytes, t_failure AS failure,
       source_file, source_revision FROM diag""",
)
def q_validate_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed_columns(views.bronze_table(spark, sf_dir)).select(
        "date", "serial_number", "model", "capacity_bytes", "failure", "source_file", "source_revision"
    )


@register(
    "validate_reasons",
    f"""WITH {S.DIAGNOSED}
SELECT source_file, source_revision, t_serial AS serial_number, array_to_string(reasons, ',') AS reasons,
       CAST(len(reasons) AS INTEGER) AS n_reasons FROM diag""",
)
def q_validate_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_diagnostics(views.bronze_table(spark, sf_dir)).select(
        "source_file",
        "source_revision",
        "serial_number",
        joined("rejection_reasons").alias("reasons"),
        F.size("rejection_reasons").alias("n_reasons"),
    )


@register(
    "validate_accepted",
    f"""WITH {S.DIAGNOSED}
SELECT t_date AS date, t_serial AS serial_number, model, t_capacity AS capacity_bytes, t_failure AS failure,
       source_file, source_quarter, source_revision FROM diag WHERE len(reasons) = 0""",
)
def q_validate_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate_rows(views.bronze_table(spark, sf_dir)).accepted.select(
        "date", "serial_number", "model", "capacity_bytes", "failure", "source_file", "source_quarter", "source_revision"
    )


@register(
    "validate_rejected",
    f"""WITH {S.DIAGNOSED}
SELECT quarantine_id, source_file, source_revision, t_date AS date, t_serial AS serial_number,
       t_capacity AS capacity_bytes, t_failure AS failure, array_to_string(reasons, ',') AS rejection_reasons
FROM diag WHERE len(reasons) > 0""",
)
def q_validate_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate_rows(views.bronze_table(spark, sf_dir)).rejected.select(
        "quarantine_id",
        "source_file",
        "source_revision",
        "date",
        "serial_number",
        "capacity_bytes",
        "failure",
        joined("rejection_reasons").alias("rejection_reasons"),
    )


@register(
    "quarantine_evidence",
    f"WITH {S.DIAGNOSED} SELECT source_file, source_revision, raw_record FROM diag WHERE len(reasons) > 0",
)
def q_quarantine_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate_rows(views.bronze_table(spark, sf_dir)).rejected.select("source_file", "source_revision", "raw_record")


@register(
    "quarantine_id",
    f"""WITH {S.DIAGNOSED}
SELECT quarantine_id, COUNT(*) AS occurrences FROM diag WHERE len(reasons) > 0 GROUP BY quarantine_id""",
)
def q_quarantine_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = validate_rows(views.bronze_table(spark, sf_dir)).rejected
    return collapse_quarantine(rejected).select("quarantine_id", "occurrences")


@register(
    "quarantine_union",
    f"""WITH {S.SILVER}
SELECT quarantine_id, source_file, source_quarter, source_revision, raw_record,
       array_to_string(reasons, ',') AS rejection_reasons FROM collapsed""",
)
def q_quarantine_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    quarantine = quarantine_contract(silver_pass(views.bronze_table(spark, sf_dir)).rejected)
    return quarantine.select(
        "quarantine_id",
        "source_file",
        "source_quarter",
        "source_revision",
        "raw_record",
        joined("rejection_reasons").alias("rejection_reasons"),
    )


@register(
    "rejection_summary",
    f"""WITH {S.SILVER}
SELECT array_to_string(reasons, ',') AS rejection_reasons, COUNT(*) AS rejected_rows
FROM collapsed GROUP BY reasons ORDER BY rejected_rows DESC""",
)
def q_rejection_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    quarantine = quarantine_contract(silver_pass(views.bronze_table(spark, sf_dir)).rejected)
    return (
        quarantine.groupBy("rejection_reasons")
        .agg(F.count(F.lit(1)).alias("rejected_rows"))
        .select(joined("rejection_reasons").alias("rejection_reasons"), "rejected_rows")
        .orderBy(F.col("rejected_rows").desc())
    )


# ---------------------------------------------------------------- readings map (BRZ)


def _folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_smart_attributes(views.bronze_table(spark, sf_dir))


@register(
    "wide_to_map",
    f"""WITH {S.DIAGNOSED}
SELECT source_file, serial_number, array_to_string(attribute_ids, ',') AS attribute_ids,
       CAST(len(attribute_ids) AS INTEGER) AS n_attributes FROM diag""",
)
def q_wide_to_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _folded(spark, sf_dir).select(
        "source_file",
        "serial_number",
        F.array_join(F.map_keys("smart_attributes"), ",").alias("attribute_ids"),
        F.size("smart_attributes").alias("n_attributes"),
    )


def _exploded_sql() -> str:
    parts = [
        f"SELECT source_file, serial_number, '{a}' AS attribute, r_{a}_raw AS raw, r_{a}_normalized AS normalized "
        f"FROM diag WHERE r_{a}_raw IS NOT NULL OR r_{a}_normalized IS NOT NULL"
        for a in views.SMART_IDS
    ]
    return f"WITH {S.DIAGNOSED} " + " UNION ALL ".join(parts)


@register("map_exploded", _exploded_sql())
def q_map_exploded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_attributes(_folded(spark, sf_dir), ["source_file", "serial_number"])


@register(
    "quality_warnings",
    f"""WITH {S.DIAGNOSED}
SELECT source_file, serial_number, array_to_string(warnings, ',') AS quality_warnings,
       CAST(len(warnings) AS INTEGER) AS n_warnings FROM diag""",
)
def q_quality_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _folded(spark, sf_dir).select(
        "source_file",
        "serial_number",
        joined("quality_warnings").alias("quality_warnings"),
        F.size("quality_warnings").alias("n_warnings"),
    )


@register(
    "map_to_wide",
    f"""WITH {S.DIAGNOSED}
SELECT source_file, serial_number, r_5_raw AS smart_5_raw, r_187_raw AS smart_187_raw,
       r_197_raw AS smart_197_raw, r_197_normalized AS smart_197_normalized FROM diag""",
)
def q_map_to_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = map_to_wide(_folded(spark, sf_dir), ["5", "187", "197"])
    return wide.select(
        "source_file", "serial_number", "smart_5_raw", "smart_187_raw", "smart_197_raw", "smart_197_normalized"
    )


# ---------------------------------------------------------------- resolution


@register(
    "resolve_rank",
    f"""WITH {S.EVT}
SELECT date, serial_number, value_cents, source_revision, source_file,
       sha256({S.json_object(['date', 'serial_number', 'value_cents'])}) AS business_hash,
       CAST(DENSE_RANK() OVER (PARTITION BY date, serial_number ORDER BY source_revision DESC NULLS LAST,
            file_modification_time DESC NULLS LAST, source_file DESC NULLS LAST) AS INTEGER) AS precedence_rank
FROM evt""",
)
def q_resolve_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = precedence_rank(views.event_observations(spark, sf_dir))
    return ranked.select(
        "date",
        "serial_number",
        "value_cents",
        "source_revision",
        "source_file",
        F.col("_business_hash").alias("business_hash"),
        F.col("_precedence_rank").alias("precedence_rank"),
    )


_OBS_BUSINESS = ["capacity_bytes", "date", "failure", "model", "serial_number"]
_OBS_EVIDENCE = sorted(_OBS_BUSINESS + ["source_file", "source_revision"])


@register(
    "resolve_trusted",
    f"""WITH {S.OBS}, {S.resolved_sql('obs', _OBS_BUSINESS, 'o')}
SELECT DISTINCT date, serial_number, model, capacity_bytes, failure, source_file, source_revision
FROM o_top WHERE versions = 1""",
)
def q_resolve_trusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = resolve_records(views.observations(spark, sf_dir)).trusted
    return trusted.drop("file_modification_time")


@register(
    "resolve_conflicts",
    f"""WITH {S.OBS}, {S.resolved_sql('obs', _OBS_BUSINESS, 'o')}
SELECT {S.quarantine_id('source_file', 'source_revision', S.json_object(_OBS_EVIDENCE))} AS quarantine_id,
       date, serial_number, failure, source_file, source_revision,
       'UNRESOLVED_DUPLICATE' AS rejection_reasons
FROM o_top WHERE versions > 1""",
)
def q_resolve_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = scratch_path(spark, "conflict-keys")
    conflicts = resolve_records(views.observations(spark, sf_dir), stage=stage).conflicts
    return conflicts.select(
        "quarantine_id",
        "date",
        "serial_number",
        "failure",
        "source_file",
        "source_revision",
        joined("rejection_reasons").alias("rejection_reasons"),
    )


def _trusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trusted rows alone: one branch, so judged rows are not written."""
    return trusted_from(views.bronze_table(spark, sf_dir), scratch_path(spark, "repeated-keys"))


_EVT_BUSINESS = ["date", "serial_number", "value_cents"]
_EVT_EVIDENCE = sorted(_EVT_BUSINESS + ["source_file", "source_revision"])


@register(
    "resolve_trusted_events",
    f"""WITH {S.EVT}, {S.resolved_sql('evt', _EVT_BUSINESS, 'e')}
SELECT DISTINCT date, serial_number, value_cents, source_file, source_revision FROM e_top WHERE versions = 1""",
)
def q_resolve_trusted_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve_records(views.event_observations(spark, sf_dir)).trusted.drop("file_modification_time")


@register(
    "resolve_conflicts_events",
    f"""WITH {S.EVT}, {S.resolved_sql('evt', _EVT_BUSINESS, 'e')}
SELECT {S.quarantine_id('source_file', 'source_revision', S.json_object(_EVT_EVIDENCE))} AS quarantine_id,
       date, serial_number, value_cents, source_file, source_revision FROM e_top WHERE versions > 1""",
)
def q_resolve_conflicts_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = scratch_path(spark, "conflict-keys")
    conflicts = resolve_records(views.event_observations(spark, sf_dir), stage=stage).conflicts
    return conflicts.select("quarantine_id", "date", "serial_number", "value_cents", "source_file", "source_revision")


@register(
    "resolve_invalid_newer",
    f"""WITH {S.SILVER}
SELECT t_date AS date, t_serial AS serial_number, source_revision, t_failure AS failure FROM trusted""",
)
def q_resolve_invalid_newer(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = _trusted(spark, sf_dir)
    return trusted.select("date", "serial_number", "source_revision", "failure")


@register(
    "trusted_minus_conflicts",
    f"""WITH {S.EVT}, early AS (SELECT * FROM evt WHERE source_revision < 12),
{S.resolved_sql('early', _EVT_BUSINESS, 'a')}, {S.resolved_sql('evt', _EVT_BUSINESS, 'b')},
first_run AS (SELECT DISTINCT date, serial_number, value_cents, source_file, source_revision FROM a_top
              WHERE versions = 1),
second_run AS (SELECT DISTINCT date, serial_number, value_cents, source_file, source_revision FROM b_top
               WHERE versions = 1),
published AS (
  SELECT * FROM first_run f WHERE NOT EXISTS (
    SELECT 1 FROM second_run s WHERE s.date IS NOT DISTINCT FROM f.date
                                 AND s.serial_number IS NOT DISTINCT FROM f.serial_number)
  UNION ALL SELECT * FROM second_run)
SELECT * FROM published p WHERE NOT EXISTS (
  SELECT 1 FROM b_top c WHERE c.versions > 1 AND c.date IS NOT DISTINCT FROM p.date
                          AND c.serial_number IS NOT DISTINCT FROM p.serial_number)""",
)
def q_trusted_minus_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.event_observations(spark, sf_dir)
    keys = ["date", "serial_number"]
    first_run = resolve_records(events.filter(F.col("source_revision") < 12)).trusted
    second_run = resolve_records(events)
    published = merge_frames(first_run, second_run.trusted, keys)
    return trusted_minus_conflicts(published, second_run.conflicts, keys).drop("file_modification_time")


# ---------------------------------------------------------------- publishing (BRZ, orders)

_TRUSTED_VIEW = """
SELECT t_date AS date, t_serial AS serial_number, model, t_capacity AS capacity_bytes, t_failure AS failure,
       CAST(len(attribute_ids) AS INTEGER) AS n_smart_attributes,
       array_to_string(attribute_ids, ',') AS smart_attribute_ids,
       array_to_string(warnings, ',') AS quality_warnings,
       source_file, source_quarter, source_revision, _rescued_data
FROM trusted"""


def _trusted_flat(trusted: DataFrame) -> DataFrame:
    return trusted.select(
        "date",
        "serial_number",
        "model",
        "capacity_bytes",
        "failure",
        F.size("smart_attributes").alias("n_smart_attributes"),
        F.array_join(F.map_keys("smart_attributes"), ",").alias("smart_attribute_ids"),
        joined("quality_warnings").alias("quality_warnings"),
        "source_file",
        "source_quarter",
        "source_revision",
        "_rescued_data",
    )


@register("publish_projection", f"WITH {S.SILVER} {_TRUSTED_VIEW}")
def q_publish_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trusted_flat(trusted_contract(_trusted(spark, sf_dir)))


@register(
    "trusted_head",
    f"WITH {S.SILVER}, flat AS ({_TRUSTED_VIEW}) SELECT * FROM flat ORDER BY date, serial_number LIMIT 20",
)
def q_trusted_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trusted_flat(trusted_contract(_trusted(spark, sf_dir))).orderBy("date", "serial_number").limit(20)


_ORDERS_SQL = """
target AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS order_date,
                  CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS priority_key
           FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
source AS (SELECT o_orderkey, o_custkey,
                  CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
                  o_totalprice, CAST(o_orderdate AS DATE) AS order_date,
                  CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS priority_key
           FROM orders WHERE o_orderdate >= TIMESTAMP '1997-07-01')"""


def _orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Initial load (before 1998) and a later batch that corrects the overlap months."""
    orders = views.table(spark, sf_dir, "orders")
    cutoff, overlap = F.lit("1998-01-01").cast("timestamp_ntz"), F.lit("1997-07-01").cast("timestamp_ntz")
    priority = F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None)).otherwise(F.col("o_orderpriority"))
    common = [F.col("o_orderdate").cast("date").alias("order_date"), priority.alias("priority_key")]
    target = orders.filter(F.col("o_orderdate") < cutoff).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", *common
    )
    source = orders.filter(F.col("o_orderdate") >= overlap).select(
        "o_orderkey",
        "o_custkey",
        F.when(F.col("o_orderdate") < cutoff, F.lit("F")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        "o_totalprice",
        *common,
    )
    return target, source


def _upsert_sql(keys: list[str]) -> str:
    match = " AND ".join(f"s.{k} IS NOT DISTINCT FROM t.{k}" for k in keys)
    return f"""WITH {_ORDERS_SQL}
SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM source s WHERE {match})
UNION ALL SELECT * FROM source"""


@register("upsert_insert_update", _upsert_sql(["o_orderkey"]))
def q_upsert_insert_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = _orders(spark, sf_dir)
    return merge_frames(target, source, ["o_orderkey"])


@register("upsert_replay", _upsert_sql(["o_orderkey"]))
def q_upsert_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = _orders(spark, sf_dir)
    once = merge_frames(target, source, ["o_orderkey"])
    return merge_frames(once, source, ["o_orderkey"])


@register("upsert_null_safe_key", _upsert_sql(["o_orderkey", "priority_key"]))
def q_upsert_null_safe_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = _orders(spark, sf_dir)
    return merge_frames(target, source, ["o_orderkey", "priority_key"])


def _orders_by_year(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The two loads with the year of the order, which never changes, as partition."""
    target, source = _orders(spark, sf_dir)
    return tuple(df.withColumn("order_year", F.year("order_date")) for df in (target, source))


def _by_year_sql(extra: str = "") -> str:
    return f"""WITH {_ORDERS_SQL}, merged AS (
SELECT *{', CAST(NULL AS VARCHAR) AS corrected' if extra else ''} FROM target t WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s.o_orderkey = t.o_orderkey)
UNION ALL SELECT *{extra} FROM source)
SELECT *, CAST(year(order_date) AS INTEGER) AS order_year FROM merged"""


_YEAR_KEYS = ("o_orderkey", "order_year")


@register("upsert_path_update", _by_year_sql())
def q_upsert_path_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partitioned path: the later batch rewrites the years that it touches."""
    path = scratch_path(spark, "orders")
    for rows in _orders_by_year(spark, sf_dir):
        upsert_path(spark, rows, path, _YEAR_KEYS, ("order_year",))
    return read_table(spark, path)


@register("upsert_path_replay", _upsert_sql(["o_orderkey"]))
def q_upsert_path_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A path without partitions; the later batch comes twice."""
    path = scratch_path(spark, "orders")
    target, source = _orders(spark, sf_dir)
    for rows in (target, source, source):
        upsert_path(spark, rows, path, ["o_orderkey"])
    return read_table(spark, path)


@register("upsert_path_new_column", _by_year_sql(", CASE WHEN order_date < DATE '1998-01-01' THEN 'yes' ELSE 'no' END AS corrected"))
def q_upsert_path_new_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The later batch has a column that the table did not have."""
    path = scratch_path(spark, "orders")
    target, source = _orders_by_year(spark, sf_dir)
    upsert_path(spark, target, path, _YEAR_KEYS, ("order_year",))
    corrected = F.when(F.col("order_date") < "1998-01-01", "yes").otherwise("no")
    upsert_path(spark, source.withColumn("corrected", corrected), path, _YEAR_KEYS, ("order_year",))
    return read_table(spark, path)


@register("upsert_table_partitions", _by_year_sql(", CASE WHEN order_date < DATE '1998-01-01' THEN 'yes' ELSE 'no' END AS corrected"))
def q_upsert_table_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of the session catalog: created, upserted with a new column, and upserted once more."""
    location = scratch_path(spark, "orders-table")
    name = f"orders_{location[-12:]}"
    target, source = _orders_by_year(spark, sf_dir)
    corrected = F.when(F.col("order_date") < "1998-01-01", "yes").otherwise("no")
    for rows in (target, source.withColumn("corrected", corrected), source.withColumn("corrected", corrected)):
        upsert_table(spark, rows, name, _YEAR_KEYS, ("order_year",), location)
    return spark.table(name)


@register("replace_table_view", f"WITH {S.OBS} {S.daily_sql('obs')}")
def q_replace_table_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view of the session catalog that is pointed from one snapshot, with other columns, to the next."""
    location = scratch_path(spark, "daily-table")
    name = f"daily_{location[-12:]}"
    daily = daily_metrics(views.observations(spark, sf_dir))
    replace_view(daily.select("date", "model").where("date < '1995-01-01'"), name, location=location)
    replace_view(daily, name, location=location)
    return spark.table(name)


@register("publish_replace", f"WITH {S.OBS} {S.daily_sql('obs')}")
def q_publish_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "gold-daily")
    daily = daily_metrics(views.observations(spark, sf_dir))
    replace_path(spark, daily, path)
    replace_path(spark, daily, path)
    return read_table(spark, path)


# ---------------------------------------------------------------- lineage (events paths)


def _good_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.table(spark, sf_dir, "events")
    path = F.concat(
        F.lit("/landing/release=2024-Q"),
        F.quarter("ts").cast("string"),
        F.lit("-r"),
        (F.hour("ts") % 3 + 1).cast("string"),
        F.lit("/"),
        F.col("event_type"),
        F.lit(".csv"),
    )
    return events.select("event_id", path.alias("source_file"))


_GOOD_PATHS_SQL = """paths AS (SELECT event_id, '/landing/release=2024-Q' || quarter(ts) || '-r' || (hour(ts) % 3 + 1)
                     || '/' || event_type || '.csv' AS source_file FROM events)"""
_SEGMENTS = "list_filter(string_split(source_file, '/'), lambda s: regexp_full_match(s, 'release=(\\d{4}-Q[1-4])-r([1-9]\\d*)'))"


@register(
    "lineage_columns",
    f"""WITH {_GOOD_PATHS_SQL}
SELECT event_id, source_file,
       regexp_extract({_SEGMENTS}[1], '^release=(\\d{{4}}-Q[1-4])-r([1-9]\\d*)$', 1) AS source_quarter,
       CAST(regexp_extract({_SEGMENTS}[1], '^release=(\\d{{4}}-Q[1-4])-r([1-9]\\d*)$', 2) AS INTEGER)
         AS source_revision
FROM paths""",
)
def q_lineage_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    from obslake.sources.landing import with_lineage

    return with_lineage(_good_paths(spark, sf_dir)).select(
        "event_id", "source_file", "source_quarter", "source_revision"
    )


_BAD_PATH = """CASE event_type
  WHEN 'view' THEN '/landing/release=2024-Q1-r1/'
  WHEN 'click' THEN '/landing/release=2024-Q5-r1/'
  WHEN 'error' THEN '/landing/'
  WHEN 'signup' THEN '/landing/release=2024-Q1-r0/'
  ELSE '/landing/release=2024-Q1-r1/release=2024-Q1-r2/' END || event_type || '-' || user_id || '.csv'"""


@register(
    "lineage_bad_path",
    f"""WITH paths AS (SELECT event_id, {_BAD_PATH} AS source_file FROM events)
SELECT event_id, source_file, CAST(len({_SEGMENTS}) AS INTEGER) AS release_matches,
       len({_SEGMENTS}) = 1 AS release_valid,
       CASE WHEN len({_SEGMENTS}) <> 1 THEN 'Source path must contain release=YYYY-QN-rN: ' || source_file END
         AS error_message
FROM paths""",
)
def q_lineage_bad_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.table(spark, sf_dir, "events")
    prefix = (
        F.when(F.col("event_type") == "view", F.lit("/landing/release=2024-Q1-r1/"))
        .when(F.col("event_type") == "click", F.lit("/landing/release=2024-Q5-r1/"))
        .when(F.col("event_type") == "error", F.lit("/landing/"))
        .when(F.col("event_type") == "signup", F.lit("/landing/release=2024-Q1-r0/"))
        .otherwise(F.lit("/landing/release=2024-Q1-r1/release=2024-Q1-r2/"))
    )
    path = F.concat(prefix, F.col("event_type"), F.lit("-"), F.col("user_id").cast("string"), F.lit(".csv"))
    paths = events.select("event_id", path.alias("source_file"))
    source = F.col("source_file")
    valid = lineage.release_is_valid(source)
    return paths.select(
        "event_id",
        "source_file",
        lineage.release_match_count(source).alias("release_matches"),
        valid.alias("release_valid"),
        F.when(~valid, lineage.invalid_path_message(source)).alias("error_message"),
    )


# ---------------------------------------------------------------- run counters (BRZ)


@register(
    "run_summary",
    f"""WITH {S.SILVER},
day AS (SELECT DISTINCT t_date, model FROM trusted),
models AS (SELECT DISTINCT model FROM trusted WHERE t_date BETWEEN DATE '{S.PERIOD_START}' AND DATE '{S.PERIOD_END}')
SELECT 'bronze_rows' AS counter, COUNT(*) AS value FROM brz
UNION ALL SELECT 'valid_rows', COUNT(*) FROM diag WHERE len(reasons) = 0
UNION ALL SELECT 'invalid_rows', COUNT(*) FROM diag WHERE len(reasons) > 0
UNION ALL SELECT 'warned_rows', COUNT(*) FROM diag WHERE len(warnings) > 0
UNION ALL SELECT 'trusted_rows', COUNT(*) FROM trusted
UNION ALL SELECT 'quarantine_rows', COUNT(*) FROM collapsed
UNION ALL SELECT 'silver_rows', COUNT(*) FROM trusted
UNION ALL SELECT 'daily_rows', COUNT(*) FROM day
UNION ALL SELECT 'period_rows', COUNT(*) FROM models""",
)
def q_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts that a Silver and a Gold run observe while they write."""
    base = scratch_path(spark, "run-summary")
    counts = run_silver(spark, views.bronze_table(spark, sf_dir), f"{base}/trusted", f"{base}/quarantine", trusted_partitions=())
    silver = read_table(spark, f"{base}/trusted")
    counts |= run_gold(spark, silver, f"{base}/daily", f"{base}/period", *PERIOD)
    return spark.createDataFrame(sorted(counts.items()), "counter string, value long")
