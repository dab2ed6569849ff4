"""Catalogue entries that go through files: landing CSV, streaming Bronze, its schema and counts.

Landing files are written by Spark from the Bronze text view of the given tables into a fresh folder
below the shared folder and ingested from there. File names are Spark's, so results carry the
release folder instead; everything else is compared with the view's SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.plans.catalogue import register
from obslake.schemas import RESCUED_COLUMN
from obslake.session import scratch_path
from obslake.sources import views
from obslake.sources.landing import write_landing
from obslake.streaming.bronze import read_bronze, run_bronze

IDENTITY = ["date", "serial_number", "model", "capacity_bytes", "failure"]


def _readings(*attributes: str) -> list[str]:
    return [f"smart_{a}_{k}" for a in attributes for k in ("normalized", "raw")]


EARLY_COLUMNS = IDENTITY + _readings("1", "5", "9")
LATE_COLUMNS = EARLY_COLUMNS + _readings("187", "197", "198")
RELEASE_SQL = "'release=' || source_quarter || '-r' || source_revision AS release_folder, source_quarter, source_revision"


def landing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze text with the release that each row lands in, and whether it comes in the first wave."""
    brz = views.bronze_table(spark, sf_dir)
    release = F.concat(F.col("source_quarter"), F.lit("-r"), F.col("source_revision").cast("string"))
    return brz.select(*LATE_COLUMNS, release.alias("release"), (F.col("source_quarter") < "1998").alias("early"))


class Landing:
    """A fresh landing folder with its Bronze table and checkpoint."""

    def __init__(self, spark: SparkSession, purpose: str):
        base = scratch_path(spark, purpose)
        self.spark, self.files, self.bronze, self.checkpoint = spark, f"{base}/landing", f"{base}/bronze", f"{base}/checkpoint"

    def add(self, rows: DataFrame, columns: list[str]) -> None:
        write_landing(rows.select(*columns, "release"), self.files)

    def ingest(self) -> list:
        return run_bronze(self.spark, self.files, self.bronze, self.checkpoint, query_name=None)

    def rows(self) -> DataFrame:
        folder = F.regexp_extract("source_file", "/(release=[^/]*)/", 1).alias("release_folder")
        return read_bronze(self.spark, self.bronze).select(*LATE_COLUMNS, RESCUED_COLUMN, folder, "source_quarter", "source_revision")


@register(
    "ingest_incremental",
    f"WITH brz AS ({views.BRONZE_TEXT_SQL}) SELECT {', '.join(LATE_COLUMNS)}, CAST(NULL AS VARCHAR) AS _rescued_data, {RELEASE_SQL} FROM brz",
)
def q_ingest_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two waves of files, and a rerun that finds nothing new."""
    landing, rows = Landing(spark, "ingest-incremental"), landing_rows(spark, sf_dir)
    for wave in (rows.filter("early"), rows.filter("NOT early")):
        landing.add(wave, LATE_COLUMNS)
        landing.ingest()
    landing.ingest()
    return landing.rows()


def _drift_sql() -> str:
    late = [f"CASE WHEN source_quarter >= '1998' THEN {c} END AS {c}" for c in LATE_COLUMNS if c not in EARLY_COLUMNS]
    return f"""WITH brz AS ({views.BRONZE_TEXT_SQL})
SELECT {', '.join(EARLY_COLUMNS + late)}, CAST(NULL AS VARCHAR) AS _rescued_data, {RELEASE_SQL} FROM brz"""


@register("ingest_schema_drift", _drift_sql())
def q_ingest_schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Early files without the later readings, and later ones with all columns in another order.

    Some of the later files are ingested together with the early ones, the rest by a run that finds
    the wider schema in the log.
    """
    landing, rows = Landing(spark, "ingest-drift"), landing_rows(spark, sf_dir)
    landing.add(rows.filter("early"), EARLY_COLUMNS)
    landing.add(rows.filter("NOT early AND release LIKE '%Q1%'"), LATE_COLUMNS[::-1])
    landing.ingest()
    landing.add(rows.filter("NOT early AND release NOT LIKE '%Q1%'"), LATE_COLUMNS[::-1])
    landing.ingest()
    return landing.rows()


def _rescued_sql() -> str:
    cut = [f"CASE WHEN CAST(smart_9_raw AS BIGINT) % 103 <> 0 OR CAST(smart_9_raw AS BIGINT) % 101 = 0 THEN {c} END AS {c}" for c in LATE_COLUMNS[-2:]]
    return f"""WITH brz AS ({views.BRONZE_TEXT_SQL})
SELECT {', '.join(LATE_COLUMNS[:-2] + cut)},
       CASE WHEN CAST(smart_9_raw AS BIGINT) % 101 = 0 THEN '{{"_c17":"EXTRA"}}'
            WHEN CAST(smart_9_raw AS BIGINT) % 103 = 0 THEN NULL
            WHEN CAST(smart_9_raw AS BIGINT) % 107 = 0 THEN '{{"_c17":"x, \\"y\\"","_c18":"","_c19":"z"}}' END AS _rescued_data,
       {RELEASE_SQL} FROM brz"""


@register("ingest_rescued", _rescued_sql())
def q_ingest_rescued(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with surplus fields (one, or three of which one is quoted) and lines that lack fields."""
    landing = Landing(spark, "ingest-rescued")
    key = F.col("smart_9_raw").cast("bigint")

    def field(name: str) -> Column:
        return F.when(F.col(name) == "", '""').otherwise(F.coalesce(name, F.lit("")))

    fields = [field(c) for c in LATE_COLUMNS]
    line = (
        F.when(key % 101 == 0, F.concat_ws(",", *fields, F.lit("EXTRA")))
        .when(key % 103 == 0, F.concat_ws(",", *fields[:-2]))
        .when(key % 107 == 0, F.concat_ws(",", *fields, F.lit('"x, ""y""",,z')))
        .otherwise(F.concat_ws(",", *fields))
    )
    lines = landing_rows(spark, sf_dir).select(line.alias(",".join(LATE_COLUMNS)), "release")
    # One column whose name is the header line, written without quotes by a separator that no line has.
    plain = lines.hint("rebalance", "release").write.partitionBy("release").option("header", "true")
    plain.option("sep", "\u0001").option("quote", "").csv(landing.files)
    landing.ingest()
    return landing.rows()


@register(
    "ingest_batches",
    f"""WITH brz AS ({views.BRONZE_TEXT_SQL})
SELECT CASE WHEN source_quarter < '1998' THEN 1 ELSE 2 END AS wave, CAST(COUNT(*) AS BIGINT) AS rows,
       CAST(0 AS BIGINT) AS rescued_rows,
       CASE WHEN source_quarter < '1998' THEN {len(EARLY_COLUMNS)} ELSE {len(LATE_COLUMNS)} END AS columns, true AS timed
FROM brz GROUP BY ALL""",
)
def q_ingest_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the batches of two waves did: rows, rescued rows, columns known, and that each was timed."""
    landing, rows = Landing(spark, "ingest-batches"), landing_rows(spark, sf_dir)
    done = []
    for number, (wave, columns) in enumerate(((rows.filter("early"), EARLY_COLUMNS), (rows.filter("NOT early"), LATE_COLUMNS)), 1):
        landing.add(wave, columns)
        done += [(number, b.rows, b.rescued_rows, b.columns, b.duration_ms > 0) for b in landing.ingest()]
    done += [(3, b.rows, b.rescued_rows, b.columns, True) for b in landing.ingest()]
    batches = spark.createDataFrame(done, "wave int, rows long, rescued_rows long, columns int, timed boolean")
    sums = [F.sum(c).alias(c) for c in ("rows", "rescued_rows")]
    return batches.groupBy("wave").agg(*sums, F.max("columns").alias("columns"), F.bool_and("timed").alias("timed"))
