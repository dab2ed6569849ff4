"""DuckDB SQL twins of the pipeline, written independently of the Spark code.

They are used as correctness oracles: each Spark query in the catalogue has an SQL
statement computing the same rows with plain SQL constructs (COUNT DISTINCT, window
ranks, NOT EXISTS) rather than the plans the library uses.
"""

from __future__ import annotations

from obslake.sources.views import BRONZE_TEXT_SQL, EVENT_OBSERVATIONS_SQL, OBSERVATIONS_SQL, SMART_IDS

PERIOD_START = "1995-01-01"
PERIOD_END = "2001-12-31"

BRONZE_COLUMNS = (
    ["date", "serial_number", "model", "capacity_bytes", "failure"]
    + [f"smart_{a}_{k}" for a in SMART_IDS for k in ("normalized", "raw")]
    + ["source_file", "source_quarter", "source_revision", "file_modification_time", "_rescued_data", "ingested_at"]
)
EVIDENCE_COLUMNS = sorted(c for c in BRONZE_COLUMNS if c not in ("file_modification_time", "ingested_at"))
INTEGER_TEXT = r"'^\s*[+-]?[0-9]+\s*$'"


def json_object(columns: list[str], prefix: str = "") -> str:
    return "json_object(" + ", ".join(f"'{c}', {prefix}{c}" for c in columns) + ")"


def safe_bigint(expr: str) -> str:
    return f"CASE WHEN regexp_matches({expr}, {INTEGER_TEXT}) THEN TRY_CAST({expr} AS BIGINT) END"


def safe_int(expr: str) -> str:
    return f"CASE WHEN regexp_matches({expr}, {INTEGER_TEXT}) THEN TRY_CAST({expr} AS INTEGER) END"


def quarantine_id(file: str, revision: str, raw: str) -> str:
    return (
        f"sha256(concat_ws(chr(31), coalesce({file}, '<null>'), "
        f"coalesce(CAST({revision} AS VARCHAR), '<null>'), {raw}))"
    )


def _readings() -> tuple[str, str, str]:
    """Typed readings, the attribute id list and the warning list over ``smart_*`` text."""
    typed, present, warnings = [], [], []
    for a in SMART_IDS:
        for k in ("raw", "normalized"):
            typed.append(f"{safe_bigint(f'smart_{a}_{k}')} AS r_{a}_{k}")
            warnings.append(
                f"CASE WHEN smart_{a}_{k} IS NOT NULL AND trim(smart_{a}_{k}) <> '' "
                f"AND {safe_bigint(f'smart_{a}_{k}')} IS NULL THEN 'INVALID_SMART_{a}_{k.upper()}' END"
            )
        present.append(
            f"CASE WHEN {safe_bigint(f'smart_{a}_raw')} IS NOT NULL "
            f"OR {safe_bigint(f'smart_{a}_normalized')} IS NOT NULL THEN '{a}' END"
        )
    ids = "list_filter([" + ", ".join(present) + "], lambda x: x IS NOT NULL)"
    warns = "list_filter([" + ", ".join(warnings) + "], lambda x: x IS NOT NULL)"
    return ", ".join(typed), ids, warns


_TYPED_READINGS, _ATTRIBUTE_IDS, _WARNINGS = _readings()

# Bronze text -> diagnosed rows with typed values, reasons, raw evidence, fold results.
DIAGNOSED = f"""
brz AS ({BRONZE_TEXT_SQL}),
typed AS (
  SELECT *,
         TRY_CAST(date AS DATE) AS t_date,
         trim(serial_number) AS t_serial,
         {safe_bigint('capacity_bytes')} AS t_capacity,
         {safe_int('failure')} AS t_failure,
         {json_object(EVIDENCE_COLUMNS)} AS raw_record,
         {_TYPED_READINGS},
         {_ATTRIBUTE_IDS} AS attribute_ids,
         {_WARNINGS} AS warnings
  FROM brz),
diag AS (
  SELECT *,
         list_filter([CASE WHEN t_date IS NULL THEN 'INVALID_DATE' END,
                      CASE WHEN t_serial IS NULL OR t_serial = '' THEN 'MISSING_SERIAL_NUMBER' END,
                      CASE WHEN t_failure IS NULL OR t_failure NOT IN (0, 1) THEN 'INVALID_FAILURE_FLAG' END,
                      CASE WHEN t_capacity IS NULL OR t_capacity <= 0 THEN 'INVALID_CAPACITY_BYTES' END],
                     lambda x: x IS NOT NULL) AS reasons,
         {quarantine_id('source_file', 'source_revision', 'raw_record')} AS quarantine_id
  FROM typed)
"""

_CONTENT = (
    "json_object('capacity_bytes', t_capacity, 'date', t_date, 'failure', t_failure, 'model', model, "
    "'serial_number', t_serial, 'warnings', warnings, 'quarter', source_quarter, 'rescued', _rescued_data, "
    + ", ".join(f"'r_{a}_{k}', r_{a}_{k}" for a in SMART_IDS for k in ("raw", "normalized"))
    + ")"
)

# Accepted bronze rows resolved by precedence: trusted (agreeing top rows) and conflicts.
SILVER = (
    DIAGNOSED
    + f""",
accepted AS (SELECT * FROM diag WHERE len(reasons) = 0),
ranked AS (
  SELECT *, {_CONTENT} AS content,
         DENSE_RANK() OVER (PARTITION BY t_date, t_serial ORDER BY source_revision DESC NULLS LAST,
                            file_modification_time DESC NULLS LAST, source_file DESC NULLS LAST) AS rk
  FROM accepted),
verdict AS (SELECT t_date, t_serial, COUNT(DISTINCT content) AS versions FROM ranked WHERE rk = 1 GROUP BY ALL),
top AS (SELECT r.*, v.versions FROM ranked r JOIN verdict v USING (t_date, t_serial) WHERE r.rk = 1),
trusted AS (SELECT DISTINCT ON (t_date, t_serial) * FROM top WHERE versions = 1),
conflicts AS (SELECT * FROM top WHERE versions > 1),
quarantine AS (
  SELECT quarantine_id, source_file, source_quarter, source_revision, raw_record, reasons FROM diag WHERE len(reasons) > 0
  UNION ALL
  SELECT quarantine_id, source_file, source_quarter, source_revision, raw_record, ['UNRESOLVED_DUPLICATE'] FROM conflicts),
collapsed AS (SELECT DISTINCT * FROM quarantine)
"""
)

OBS = f"obs AS ({OBSERVATIONS_SQL})"
EVT = f"evt AS ({EVENT_OBSERVATIONS_SQL})"


def period_sql(source: str) -> str:
    return f"""
SELECT DATE '{PERIOD_START}' AS period_start, DATE '{PERIOD_END}' AS period_end, model,
       COUNT(DISTINCT serial_number) AS unique_drives_observed,
       COUNT(DISTINCT CASE WHEN failure = 1 THEN serial_number END) AS failed_drives,
       COUNT(*) AS total_drive_days,
       CAST(COUNT(DISTINCT CASE WHEN failure = 1 THEN serial_number END) AS DOUBLE)
         / NULLIF(CAST(COUNT(DISTINCT serial_number) AS DOUBLE), 0) * 100.0 AS naive_failed_drive_percentage,
       CAST(COUNT(DISTINCT CASE WHEN failure = 1 THEN serial_number END) AS DOUBLE)
         / NULLIF(CAST(COUNT(*) AS DOUBLE), 0) * 1000000.0 AS failures_per_million_drive_days
FROM {source}
WHERE date BETWEEN DATE '{PERIOD_START}' AND DATE '{PERIOD_END}'
GROUP BY model"""


def daily_sql(source: str) -> str:
    return f"""
SELECT date, model, COUNT(DISTINCT serial_number) AS active_drives,
       CAST(SUM(CAST(failure AS BIGINT)) AS BIGINT) AS failures,
       COUNT(DISTINCT serial_number) AS drive_days
FROM {source} GROUP BY date, model"""


def resolved_sql(source: str, business: list[str], name: str) -> str:
    """CTEs ``{name}_top`` (rank-1 rows with version count) for a typed source."""
    return f"""
{name}_ranked AS (
  SELECT *, {json_object(business)} AS content,
         DENSE_RANK() OVER (PARTITION BY date, serial_number ORDER BY source_revision DESC NULLS LAST,
                            file_modification_time DESC NULLS LAST, source_file DESC NULLS LAST) AS rk
  FROM {source}),
{name}_verdict AS (SELECT date, serial_number, COUNT(DISTINCT content) AS versions
                   FROM {name}_ranked WHERE rk = 1 GROUP BY date, serial_number),
{name}_top AS (SELECT r.*, v.versions FROM {name}_ranked r JOIN {name}_verdict v USING (date, serial_number)
               WHERE r.rk = 1)"""


#: (rule, what holds for a sound row), said apart from the library's rules.
DAILY_CHECKS = {
    "failures lie between 0 and active drives": "sign(failures) + 1 > 0 AND greatest(failures, active_drives) = active_drives",
    "drive-days are counted": "drive_days = abs(drive_days)",
}
PERIOD_CHECKS = {
    "failed drives lie between 0 and drives seen": "sign(failed_drives) + 1 > 0 AND unique_drives_observed - failed_drives >= 0",
    "some drive is seen": "sign(unique_drives_observed) = 1",
    "some drive-day is seen": "sign(total_drive_days) = 1",
    "both rates exist": "isfinite(naive_failed_drive_percentage + failures_per_million_drive_days)",
}


def broken_sql(source: str, columns: list[str], checks: dict[str, str]) -> str:
    """CTEs and the final statement that name the checks which rows of ``source`` do not pass."""
    each = " UNION ALL ".join(
        f"SELECT *, '{rule}' AS rule FROM {source} WHERE NOT coalesce({holds}, false)" for rule, holds in checks.items()
    )
    listed = ", ".join(columns)
    return f"""failing AS ({each})
SELECT {listed}, string_agg(rule, '; ' ORDER BY rule) AS broken FROM failing GROUP BY {listed}"""
