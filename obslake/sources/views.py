"""Observation views derived from the given tables, each with its DuckDB SQL twin.

* ``observations`` (OBS): ``lineitem`` joined to ``part``. A drive is a part, its
  model the brand, a day the ship date, a failure a returned line; the line number
  plays the source revision, and one landing file per day and revision holds it.
* ``event_observations`` (EVT): ``events``. A drive is a user and a day the event
  date; precedence is the hour, then the event type as file name; the business
  value is the event value in cents.
* ``bronze_text`` (BRZ): OBS as landing text, every value a string, with wide
  reading columns and deterministic damage, as a Bronze table would hold it.

The joins carry no broadcast hint: Spark broadcasts ``part`` only when its size,
known from the file statistics or measured at run time by adaptive execution, is
under the broadcast threshold, and otherwise shuffles both sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Bytes of a row group of the written Bronze table.
ROW_GROUP_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read as it is."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _release_path(day: Column, revision: Column) -> Column:
    return F.concat(
        F.lit("/landing/release="),
        F.year(day).cast("string"),
        F.lit("-Q"),
        F.quarter(day).cast("string"),
        F.lit("-r"),
        revision.cast("string"),
        F.lit("/"),
        day.cast("string"),
        F.lit(".csv"),
    )


def _release_path_sql(day: str, revision: str) -> str:
    return (
        f"'/landing/release=' || year({day}) || '-Q' || quarter({day}) || '-r' || {revision} "
        f"|| '/' || CAST({day} AS VARCHAR) || '.csv'"
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OBS."""
    items = table(spark, sf_dir, "lineitem").select("l_partkey", "l_linenumber", "l_returnflag", "l_shipdate")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    day = F.col("l_shipdate").cast("date")
    return items.join(parts, items.l_partkey == parts.p_partkey).select(
        day.alias("date"),
        F.col("l_partkey").alias("serial_number"),
        F.col("p_brand").alias("model"),
        (F.col("p_size").cast("bigint") * F.lit(250_000_000_000)).alias("capacity_bytes"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("failure"),
        _release_path(day, F.col("l_linenumber")).alias("source_file"),
        F.col("l_linenumber").alias("source_revision"),
        (F.col("l_shipdate") + F.make_dt_interval(hours=F.col("l_linenumber"))).alias("file_modification_time"),
    )


OBSERVATIONS_SQL = f"""
SELECT CAST(l_shipdate AS DATE) AS date,
       l_partkey AS serial_number,
       p_brand AS model,
       CAST(p_size AS BIGINT) * 250000000000 AS capacity_bytes,
       CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS failure,
       {_release_path_sql('CAST(l_shipdate AS DATE)', 'l_linenumber')} AS source_file,
       l_linenumber AS source_revision,
       l_shipdate + to_hours(l_linenumber) AS file_modification_time
FROM lineitem JOIN part ON l_partkey = p_partkey
"""


def event_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("ts").cast("date").alias("date"),
        F.col("user_id").alias("serial_number"),
        F.round(F.col("value") * 100).cast("bigint").alias("value_cents"),
        F.hour("ts").alias("source_revision"),
        F.lit(None).cast("timestamp").alias("file_modification_time"),
        F.col("event_type").alias("source_file"),
    )


EVENT_OBSERVATIONS_SQL = """
SELECT CAST(ts AS DATE) AS date,
       user_id AS serial_number,
       CAST(round(value * 100) AS BIGINT) AS value_cents,
       CAST(hour(ts) AS INTEGER) AS source_revision,
       CAST(NULL AS TIMESTAMP) AS file_modification_time,
       event_type AS source_file
FROM events
"""

# Wide readings of BRZ: (attribute id, raw SQL, normalized SQL); the Spark side is in
# smart_readings(). Blank text, null and "not-a-number" appear on purpose.
SMART_READINGS_SQL = (
    ("1", "CAST(l_suppkey AS VARCHAR)", "'100'"),
    ("5", "CAST(CAST(round(l_quantity) AS BIGINT) AS VARCHAR)", "'100'"),
    ("9", "CAST(l_orderkey AS VARCHAR)", "CAST(100 - l_linenumber AS VARCHAR)"),
    ("187", "CASE WHEN l_discount = 0 THEN '' ELSE CAST(CAST(round(l_discount * 100) AS BIGINT) AS VARCHAR) END", "'100'"),
    ("197", "CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'not-a-number' ELSE '0' END", "'100'"),
    (
        "198",
        "CASE WHEN l_tax > 0.05 THEN '1' END",
        "CASE WHEN l_tax > 0.05 THEN CAST(CAST(round(l_tax * 100) AS BIGINT) AS VARCHAR) ELSE ' ' END",
    ),
)
SMART_IDS = tuple(a for a, _, _ in SMART_READINGS_SQL)


def _text(c: Column) -> Column:
    return c.cast("bigint").cast("string")


def smart_readings() -> list[tuple[str, Column, Column]]:
    """(attribute id, raw text, normalized text) as Spark columns over lineitem."""
    tax, discount = F.col("l_tax"), F.col("l_discount")
    return [
        ("1", _text(F.col("l_suppkey")), F.lit("100")),
        ("5", _text(F.round("l_quantity")), F.lit("100")),
        ("9", _text(F.col("l_orderkey")), _text(F.lit(100) - F.col("l_linenumber"))),
        ("187", F.when(discount == 0, F.lit("")).otherwise(_text(F.round(discount * 100))), F.lit("100")),
        (
            "197",
            F.when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"), F.lit("not-a-number")).otherwise(
                F.lit("0")
            ),
            F.lit("100"),
        ),
        ("198", F.when(tax > 0.05, F.lit("1")), F.when(tax > 0.05, _text(F.round(tax * 100))).otherwise(F.lit(" "))),
    ]


def bronze_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_quantity",
        "l_discount",
        "l_tax",
        "l_returnflag",
        "l_linestatus",
        "l_shipdate",
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    day = F.col("l_shipdate").cast("date")
    serial = F.concat(F.lit("SN-"), F.col("l_partkey").cast("string"))
    key = F.col("l_orderkey")
    readings = []
    for attribute, raw, normalized in smart_readings():
        readings.append(normalized.alias(f"smart_{attribute}_normalized"))
        readings.append(raw.alias(f"smart_{attribute}_raw"))
    return items.join(parts, items.l_partkey == parts.p_partkey).select(
        F.when(key % 97 == 0, F.lit("not-a-date")).otherwise(day.cast("string")).alias("date"),
        F.when(key % 89 == 0, F.lit("  "))
        .when(key % 7 == 0, F.concat(F.lit(" "), serial, F.lit(" ")))
        .otherwise(serial)
        .alias("serial_number"),
        F.col("p_brand").alias("model"),
        F.when(key % 83 == 0, F.lit("unknown"))
        .when(key % 79 == 0, F.lit("0"))
        .otherwise((F.col("p_size").cast("bigint") * F.lit(250_000_000_000)).cast("string"))
        .alias("capacity_bytes"),
        F.when(key % 71 == 0, F.lit("2"))
        .when(F.col("l_returnflag") == "R", F.lit("1"))
        .otherwise(F.lit("0"))
        .alias("failure"),
        *readings,
        _release_path(day, F.col("l_linenumber")).alias("source_file"),
        F.concat(F.year(day).cast("string"), F.lit("-Q"), F.quarter(day).cast("string")).alias("source_quarter"),
        F.col("l_linenumber").alias("source_revision"),
        (F.col("l_shipdate") + F.make_dt_interval(hours=F.col("l_linenumber"))).alias("file_modification_time"),
        F.lit(None).cast("string").alias("_rescued_data"),
        F.current_timestamp().alias("ingested_at"),
    )


def _bronze_sql() -> str:
    readings = []
    for attribute, raw_sql, normalized_sql in SMART_READINGS_SQL:
        readings.append(f"{normalized_sql} AS smart_{attribute}_normalized")
        readings.append(f"{raw_sql} AS smart_{attribute}_raw")
    day = "CAST(l_shipdate AS DATE)"
    return f"""
SELECT CASE WHEN l_orderkey % 97 = 0 THEN 'not-a-date' ELSE CAST({day} AS VARCHAR) END AS date,
       CASE WHEN l_orderkey % 89 = 0 THEN '  '
            WHEN l_orderkey % 7 = 0 THEN ' SN-' || l_partkey || ' '
            ELSE 'SN-' || l_partkey END AS serial_number,
       p_brand AS model,
       CASE WHEN l_orderkey % 83 = 0 THEN 'unknown'
            WHEN l_orderkey % 79 = 0 THEN '0'
            ELSE CAST(CAST(p_size AS BIGINT) * 250000000000 AS VARCHAR) END AS capacity_bytes,
       CASE WHEN l_orderkey % 71 = 0 THEN '2' WHEN l_returnflag = 'R' THEN '1' ELSE '0' END AS failure,
       {', '.join(readings)},
       {_release_path_sql(day, 'l_linenumber')} AS source_file,
       year({day}) || '-Q' || quarter({day}) AS source_quarter,
       l_linenumber AS source_revision,
       l_shipdate + to_hours(l_linenumber) AS file_modification_time,
       CAST(NULL AS VARCHAR) AS _rescued_data,
       CAST(current_timestamp AS TIMESTAMP) AS ingested_at
FROM lineitem JOIN part ON l_partkey = p_partkey
"""


BRONZE_TEXT_SQL = _bronze_sql()


def bronze_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BRZ as a written Bronze table in the shared folder, as the ingest job leaves it.

    It is derived once per version of the source files and of the view definition
    (source paths, sizes and modification times and the view's SQL name the folder;
    the Spark and SQL definitions change together); the folder becomes visible by rename after
    the write commits, so a failed or concurrent derivation is never read half done.
    """
    import hashlib
    import inspect
    import uuid

    from obslake.session import shared_dir

    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    stamp = []
    for name in ("lineitem", "part"):
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        status = path.getFileSystem(conf).getFileStatus(path)
        stamp.append(f"{status.getPath()}:{status.getLen()}:{status.getModificationTime()}")
    # The definition is part of the name, so a changed view never reuses old rows.
    stamp.append(BRONZE_TEXT_SQL)
    stamp.append("".join(map(inspect.getsource, (bronze_text, smart_readings, _release_path, _text, table))))
    key = hashlib.sha256("|".join(stamp).encode()).hexdigest()[:16]
    final = f"{shared_dir(spark)}/obslake/bronze-text/{key}"
    final_path = jvm.org.apache.hadoop.fs.Path(final)
    fs = final_path.getFileSystem(conf)
    if not fs.exists(final_path):
        staging = f"{final}.staging-{uuid.uuid4().hex}"
        # Written where the rows are made: as text a row is six times as wide as in Parquet, so it is neither
        # moved nor sorted. Row groups are small, so that readers share even a few files evenly.
        bronze_text(spark, sf_dir).write.mode("overwrite").option("parquet.block.size", ROW_GROUP_BYTES).parquet(staging)
        if not fs.rename(jvm.org.apache.hadoop.fs.Path(staging), final_path) and not fs.exists(final_path):
            raise RuntimeError(f"could not publish {final}")
    return spark.read.parquet(final)
