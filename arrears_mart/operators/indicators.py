"""Summaries and filtered views of the master, audit and run-log tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrears_mart.schemas import AGE_LABELS_CAMPAIGN

QUICK_VIEW_COLUMNS = (
    "NO_DAMA NOMBRE_COMPLETO ZONA ID_COBRADOR CAMPANA_SALDO SALDO_DAMA PAGOS_DAMA SALDO_FINAL "
    "SALDO_ACTUALIZADO DIAS_MORA TEMPORALIDAD NUMERO_GESTIONES STATUS_GESTION FECHA_PROMESA"
).split()


def money_sum(column: str) -> Column:
    """A sum wide enough for any number of rows."""
    return F.sum(column).cast(T.DecimalType(38, 2))


def row_count(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def select_rows(
    master: DataFrame, zones: Sequence[str] = (), collectors: Sequence[str] = (), ages: Sequence[str] = ()
) -> DataFrame:
    """Rows in the chosen zones, collectors and ages; an empty choice filters nothing."""
    for column, chosen in (("ZONA", zones), ("ID_COBRADOR", collectors), ("TEMPORALIDAD", ages)):
        if chosen:
            master = master.filter(F.col(column).isin(list(chosen)))
    return master


def distinct_values(master: DataFrame, column: str) -> DataFrame:
    return master.select(column).na.drop().distinct().orderBy(column)


def totals(master: DataFrame) -> DataFrame:
    return master.agg(
        money_sum("SALDO_ACTUALIZADO").alias("SALDO_ACTUALIZADO"),
        money_sum("PAGOS_DAMA").alias("PAGOS_DAMA"),
        F.avg("DIAS_MORA").alias("DIAS_MORA_PROMEDIO"),
    )


def balance_by_age(master: DataFrame) -> DataFrame:
    """Balance per age label in label order; labels without accounts do not appear."""
    position = F.array_position(F.lit(list(AGE_LABELS_CAMPAIGN)), F.col("TEMPORALIDAD"))
    known = master.filter(F.col("TEMPORALIDAD").isin(*AGE_LABELS_CAMPAIGN))
    summed = known.groupBy("TEMPORALIDAD").agg(money_sum("SALDO_ACTUALIZADO").alias("SALDO_ACTUALIZADO"))
    return summed.orderBy(position)


def balance_by_zone(master: DataFrame) -> DataFrame:
    known = master.filter(F.col("ZONA").isNotNull())
    summed = known.groupBy("ZONA").agg(money_sum("SALDO_ACTUALIZADO").alias("SALDO_ACTUALIZADO"))
    return summed.orderBy(F.desc("SALDO_ACTUALIZADO"), "ZONA")


def by_collector(master: DataFrame) -> DataFrame:
    """Accounts and balance per collector; accounts without one form a group of their own."""
    summed = master.groupBy("ID_COBRADOR").agg(
        F.count("NO_DAMA").alias("REGISTROS"), money_sum("SALDO_ACTUALIZADO").alias("SALDO_ACTUALIZADO")
    )
    return summed.orderBy(F.desc("SALDO_ACTUALIZADO"), "ID_COBRADOR")


def by_campaign(master: DataFrame) -> DataFrame:
    known = master.filter(F.col("CAMPANA_SALDO").isNotNull())
    return known.groupBy("CAMPANA_SALDO").agg(row_count("EN_BASE")).orderBy(F.desc("CAMPANA_SALDO"))


def audit_by_campaign(audit: DataFrame) -> DataFrame:
    known = audit.filter(F.col("CAMPANA_SALDO").isNotNull())
    return known.groupBy("CAMPANA_SALDO", "MOTIVO").agg(row_count("TOTAL")).orderBy("CAMPANA_SALDO", "MOTIVO")


def find_campaign(master: DataFrame, audit: DataFrame, campaign: str) -> DataFrame:
    """Where the rows of one campaign are: in the master, or in the audit under some motive."""
    wanted = F.col("CAMPANA_SALDO") == campaign
    kept = master.filter(wanted).agg(F.lit("EN_BASE").alias("LUGAR"), row_count("TOTAL"))
    audited = audit.filter(wanted).groupBy(F.col("MOTIVO").alias("LUGAR")).agg(row_count("TOTAL"))
    return kept.unionByName(audited)


def audit_summary(audit: DataFrame) -> DataFrame:
    return audit.groupBy("MOTIVO", "NIVEL").agg(row_count("TOTAL")).orderBy(F.desc("TOTAL"), "MOTIVO")


def age_distribution(master: DataFrame) -> DataFrame:
    """Accounts and final balance per age label, youngest first (rules by days)."""
    grouped = master.groupBy("TEMPORALIDAD").agg(
        row_count("CUENTAS"), money_sum("SALDO_FINAL").alias("SALDO_FINAL"), F.min("DIAS_MORA").alias("_from")
    )
    return grouped.orderBy("_from").drop("_from")


def repeated_keys(master: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; none are expected."""
    return master.groupBy(*keys).agg(row_count("REPETICIONES")).filter("REPETICIONES > 1")


def has_unique_keys(master: DataFrame, keys: Sequence[str]) -> bool:
    return repeated_keys(master, keys).isEmpty()


def quick_view(master: DataFrame) -> DataFrame:
    return master.select(*QUICK_VIEW_COLUMNS).orderBy("NO_DAMA")


def latest_run(rows: DataFrame, run_log: DataFrame) -> DataFrame:
    """Rows of the newest run in the log."""
    newest = run_log.agg(F.max("ID_EJECUCION")).scalar()
    return rows.filter(F.col("ID_EJECUCION") == newest)


def latest_audit(audit: DataFrame, run_log: DataFrame, motive: str | None = None) -> DataFrame:
    """Audit rows of the newest run, all of them or those of one motive."""
    chosen = audit if motive is None else audit.filter(F.col("MOTIVO") == motive)
    return latest_run(chosen, run_log)


def newest_run(run_log: DataFrame) -> DataFrame:
    return run_log.orderBy(F.desc("ID_EJECUCION")).limit(1)


def failed_runs(run_log: DataFrame) -> DataFrame:
    return run_log.filter(F.col("ESTATUS") == "ERROR").orderBy(F.desc("ID_EJECUCION"))


def joined_names(df: DataFrame, group: Sequence[str], name: str, joined: str, separator: str = ", ") -> DataFrame:
    """The names of each group in order as one text; missing names are left out, and a group without any has none.

    Equal names of a group are put together first, by all tasks, so that a group costs its different names and not its
    rows; each name stands as often as it occurs.
    """
    counted = df.groupBy(*group, name).agg(row_count("_n"))
    each = F.array_join(F.array_repeat(F.col(name).cast("string"), F.col("_n").cast("int")), separator)
    return counted.withColumn("_each", each).groupBy(*group).agg(
        F.expr(f"listagg(if(`{name}` is null, null, _each), '{separator}') within group (order by `{name}`)").alias(joined)
    )
