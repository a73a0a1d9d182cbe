"""Writing a run: master, audit, run log, exports.

Every attempt at a run writes to a folder of its own, which nothing overwrites. Its success row in the run log, written
last, carries that folder and is what makes readers use it. An attempt that fails, or whose driver dies, leaves the
results of the attempts before it as they were, also if it repeats a run.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from arrears_mart.functions.campaigns import account_campaign_key, campaign_year, normalise_campaign
from arrears_mart.functions.dates import display_date, run_clock
from arrears_mart.operators.audit import stamp_audit
from arrears_mart.plans.result import MasterResult
from arrears_mart.schemas import ACCOUNT_KEY, ACCOUNT_KEY_EXPORTED, EXPORTED_DATES, RUN_COUNTS, RUN_LOG_SCHEMA
from arrears_mart.stages import remove_paths

PROCESS_NAME = "MASTER_ACCOUNTS"
OPEN, SUCCESS, FAILURE = "EN_PROCESO", "EXITO", "ERROR"
_COUNTS = RUN_COUNTS


def new_attempt(root: str, run_id: int, buckets: int = 0) -> str:
    """A folder no other attempt has; its name says into how many buckets its master is dealt (0: none)."""
    return f"{root}/runs/run-{run_id}-b{buckets}-{uuid.uuid4().hex}"


def buckets_of(attempt: str) -> int:
    """The number of buckets that an attempt's name states."""
    found = re.search(r"/run-\d+-b(\d+)-[0-9a-f]+$", attempt)
    return int(found.group(1)) if found else 0


def write_master(base: DataFrame, attempt: str) -> None:
    """Write a master, dealt by account into the buckets that the attempt's name states, rows sorted by account.

    One task writes one bucket. Later joins on the account read the buckets as they are (`master_by_account`), and readers
    of one account skip row groups.
    """
    buckets = buckets_of(attempt)
    if not buckets:
        base.sortWithinPartitions("NO_DAMA").write.parquet(f"{attempt}/master")
        return
    spark, table = base.sparkSession, f"writing_{uuid.uuid4().hex}"
    dealt = base.repartition(buckets, "NO_DAMA").write.bucketBy(buckets, "NO_DAMA").sortBy("NO_DAMA")
    try:
        dealt.option("path", f"{attempt}/master").saveAsTable(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")  # the files stay


def write_audit(audit: DataFrame, attempt: str, run_id: int, moment: dt.datetime) -> None:
    stamp_audit(audit, run_id, run_clock(moment)).write.parquet(f"{attempt}/audit")


def read_audit(spark: SparkSession, root: str) -> DataFrame:
    """The audit rows of every run, from its latest successful attempt. There is one folder per run to look up."""
    paths = [f"{r.RUTA}/audit" for r in _successes(spark, root).select("RUTA").collect()]
    if not paths:
        raise ValueError(f"no successful run under {root}")
    return spark.read.parquet(*paths)


def log_row(
    spark: SparkSession,
    run_id: int,
    status: str,
    started: dt.datetime,
    ended: dt.datetime | None = None,
    metrics: DataFrame | None = None,
    message: str | None = None,
    attempt: str | None = None,
) -> DataFrame:
    """One run-log row; counts come from the one-row `metrics` frame."""
    counts = metrics if metrics is not None else spark.range(1).select(*[F.lit(None).alias(c) for c in _COUNTS])
    values = {
        "ID_EJECUCION": F.lit(run_id),
        "PROCESO": F.lit(PROCESS_NAME),
        "FECHA_INICIO": run_clock(started),
        "FECHA_FIN": run_clock(ended) if ended else F.lit(None),
        "ESTATUS": F.lit(status),
        "MENSAJE": F.lit(message),
        "RUTA": F.lit(attempt),
    }
    if status == SUCCESS and message is None:
        values["MENSAJE"] = F.format_string(
            "Proceso completado. Consolidados=%d, Incidencias=%d.", "REG_CONSOLIDADOS", "REG_CON_ERROR"
        )
    return counts.select(*[values.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in RUN_LOG_SCHEMA])


def append_log(row: DataFrame, root: str) -> None:
    row.coalesce(1).write.mode("append").parquet(f"{root}/run_log")


def read_run_log(spark: SparkSession, root: str) -> DataFrame:
    """The last row written for each run: closed rows win over open ones, later ends over earlier ones."""
    rows = spark.read.schema(RUN_LOG_SCHEMA).parquet(f"{root}/run_log")
    last = F.max(F.struct("FECHA_FIN", *[f for f in RUN_LOG_SCHEMA.fieldNames() if f != "FECHA_FIN"])).alias("_r")
    return rows.groupBy(F.col("ID_EJECUCION").alias("_id")).agg(last).select(*[f"_r.{f}" for f in RUN_LOG_SCHEMA.fieldNames()])


def _successes(spark: SparkSession, root: str) -> DataFrame:
    """(ID_EJECUCION, RUTA): the latest successful attempt of each run, whatever later attempts came to."""
    done = spark.read.schema(RUN_LOG_SCHEMA).parquet(f"{root}/run_log").filter(F.col("ESTATUS") == SUCCESS)
    last = F.max(F.struct("FECHA_FIN", "RUTA")).alias("_r")
    return done.groupBy("ID_EJECUCION").agg(last).select("ID_EJECUCION", "_r.RUTA")


def _current(spark: SparkSession, root: str) -> Row:
    return _successes(spark, root).agg(F.max(F.struct("ID_EJECUCION", "RUTA")).alias("r")).first().r


def current_run(spark: SparkSession, root: str) -> int | None:
    """The newest run with a successful attempt."""
    found = _current(spark, root)
    return found.ID_EJECUCION if found else None


def master_path(spark: SparkSession, root: str) -> str:
    """Where the master of the newest successful run is."""
    found = _current(spark, root)
    if found is None:
        raise ValueError(f"no successful run under {root}")
    return f"{found.RUTA}/master"


def read_master(spark: SparkSession, root: str) -> DataFrame:
    """The master of the newest successful run."""
    return spark.read.parquet(master_path(spark, root))


def master_by_account(spark: SparkSession, root: str) -> DataFrame:
    """The master of the newest successful run as its buckets, so that joins and groups by account do not exchange it.

    The buckets are known to a catalogue table named after the attempt, which is made if it is not there.
    """
    found = _current(spark, root)
    if found is None:
        raise ValueError(f"no successful run under {root}")
    if not buckets_of(found.RUTA):
        return spark.read.parquet(f"{found.RUTA}/master")
    table = f"master_{found.RUTA.rsplit('-', 1)[1]}"
    if not spark.catalog.tableExists(table):
        point_table(spark, table, f"{found.RUTA}/master", buckets_of(found.RUTA))
    return spark.table(table)


def point_table(spark: SparkSession, table: str, path: str, buckets: int = 0) -> None:
    """Make a catalogue table show the files under `path`, leaving earlier runs in place.

    A table of buckets is made anew, since their number may change; only its entry goes, the files stay.
    """
    if buckets:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
        dealt = f"CLUSTERED BY (NO_DAMA) SORTED BY (NO_DAMA) INTO {buckets} BUCKETS"
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {dealt} LOCATION '{path}'")
        return
    if not spark.catalog.tableExists(table):
        spark.catalog.createTable(table, path, "parquet")
        return
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    spark.catalog.refreshTable(table)


def publish_run(
    spark: SparkSession,
    build: Callable[[], MasterResult],
    root: str,
    run_id: int,
    started: dt.datetime,
    clock: Callable[[], dt.datetime] = dt.datetime.now,
    table: str | None = None,
    buckets: int | None = None,
) -> MasterResult:
    """Run `build` and write its results; the run log gets a row at the start and one at the end, also on failure.

    A failure row names the step that failed. The success row comes last of what can fail the run; a catalogue table
    that cannot be pointed at the master afterwards raises, and the run stays successful. Stage tables of the build go
    after success. The master is dealt into `buckets` by account, as many as there are shuffle partitions by default.
    """
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions")) if buckets is None else buckets
    attempt, step = new_attempt(root, run_id, buckets), "inicio"
    append_log(log_row(spark, run_id, OPEN, started, attempt=attempt), root)
    try:
        step = "construir base maestra"
        result = build()
        if result.status != SUCCESS:
            message = f"ERROR en {step}: {'; '.join(result.errors)}"
            append_log(log_row(spark, run_id, FAILURE, started, clock(), result.metrics, message, attempt), root)
            return result
        step = "escribir base maestra"
        write_master(result.base, attempt)
        step = "escribir auditoria"
        write_audit(result.audit, attempt, run_id, started)
        step = "contar resultados"
        append_log(log_row(spark, run_id, SUCCESS, started, clock(), result.metrics, attempt=attempt), root)
    except Exception as error:
        message = f"ERROR en {step}: {error}"
        append_log(log_row(spark, run_id, FAILURE, started, clock(), message=message, attempt=attempt), root)
        raise
    if table:
        point_table(spark, table, f"{attempt}/master", buckets)
    published = dataclasses.replace(result, base=spark.read.parquet(f"{attempt}/master"), audit=spark.read.parquet(f"{attempt}/audit"))
    counts = read_run_log(spark, root).filter(F.col("ID_EJECUCION") == run_id).select(*_COUNTS)
    remove_paths(spark, result.stages)
    return dataclasses.replace(published, metrics=counts, stages=[])


def export_view(master: DataFrame) -> DataFrame:
    """The master as people see it: dates as DD/MM/YYYY text and the account key under its display name."""
    dates = {c: display_date(F.col(c)) for c in EXPORTED_DATES if c in master.columns}
    return master.withColumns(dates).withColumnRenamed(ACCOUNT_KEY, ACCOUNT_KEY_EXPORTED)


def write_csv(df: DataFrame, path: str) -> None:
    """UTF-8 CSV files with a header; outer whitespace of values is kept."""
    df.write.mode("overwrite").csv(
        path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )


REPORT = ("MASTER", "AUDITORIA_RECHAZOS", "BITACORA")
_POINTER_SCHEMA = "MOMENTO timestamp_ntz, CARPETA string"


def write_report(
    master: DataFrame, audit: DataFrame, run_log: DataFrame, path: str, clock: Callable[[], dt.datetime] = dt.datetime.now
) -> None:
    """Master, audit and run log as the three tables of one report.

    All three go to a folder of their own; a pointer, written last, makes readers use it. If one of them fails, the report
    that was there stays.
    """
    folder = f"{path}/reports/{uuid.uuid4().hex}"
    for name, table in zip(REPORT, (export_view(master), audit, run_log)):
        write_csv(table, f"{folder}/{name}")
    pointer = master.sparkSession.createDataFrame([(clock(), folder)], _POINTER_SCHEMA)
    pointer.coalesce(1).write.mode("append").parquet(f"{path}/current")


def report_folder(spark: SparkSession, path: str) -> str:
    """Where the newest whole report is."""
    pointers = spark.read.schema(_POINTER_SCHEMA).parquet(f"{path}/current")
    return pointers.agg(F.max(F.struct("MOMENTO", "CARPETA")).alias("r")).first().r.CARPETA


def read_report(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The three tables of the newest whole report, all of them text."""
    folder = report_folder(spark, path)
    return {name: spark.read.csv(f"{folder}/{name}", header=True, escape='"') for name in REPORT}


def reference_year(portfolio: DataFrame, run_year: int) -> int:
    """The latest year among portfolio campaigns that carry one, else the run year."""
    return portfolio.agg(F.max(campaign_year(F.col("CAMPANA_SALDO")))).first()[0] or run_year


def with_account_key(arrears: DataFrame, year: int) -> DataFrame:
    """Arrears rows with the key the master has; null if there is no account or campaign column."""
    if not {"NO_DAMA", "CAMPANA_SALDO"} <= set(arrears.columns):
        return arrears.withColumn(ACCOUNT_KEY_EXPORTED, F.lit(None).cast("string"))
    campaign = normalise_campaign(F.col("CAMPANA_SALDO"), year)
    return arrears.withColumn(ACCOUNT_KEY_EXPORTED, account_campaign_key(F.col("NO_DAMA"), campaign))
