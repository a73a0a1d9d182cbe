"""Audit rows: what was rejected, excluded or flagged, and why."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears_mart.functions.text import has_text
from arrears_mart.operators.unique import grouped_rows, rows_not_kept
from arrears_mart.schemas import AUDIT_COLUMNS, CLOCK

# Steps, motives and levels of the audit table.
STEP_DUPLICATES, STEP_EXPIRY, STEP_CHECKS = "PASO1_TMP_CARTERA", "DEPURACION", "VALIDACIONES"
DUPLICATE, EXPIRED = "NO_DAMA_DUPLICADO", "VIGENCIA_VENCIDA"
NO_COLLECTOR, OVERPAID, NEGATIVE = "ZONA_SIN_COBRADOR", "CUENTA_LIQUIDADA_SOBREPAGO", "SALDO_NEGATIVO"
LEVELS = {
    DUPLICATE: "RECHAZO",
    EXPIRED: "EXCLUIDO",
    NO_COLLECTOR: "ADVERTENCIA",
    OVERPAID: "ADVERTENCIA",
    NEGATIVE: "ADVERTENCIA",
}
DUPLICATE_TEXT_CAMPAIGN = "Registro duplicado descartado; se conservo el mas reciente."
DUPLICATE_TEXT_DAYS = "Registro duplicado descartado; se conservo el mas reciente por NO_DAMA."
EXPIRED_TEXT = "FECHA_FINAL_VIGENCIA vencida; cuenta fuera de la cartera activa."
NO_COLLECTOR_TEXT = "La zona no tiene cobrador asignado en ZONAS_ASIGNADAS."
OVERPAID_TEXT = "Pago mayor al adeudo; deuda liquidada, saldo mostrado como 0."
NEGATIVE_TEXT = "SALDO_FINAL negativo = "

WHO = ("NO_DAMA", "CAMPANA_SALDO", "ZONA")


def duplicate_audit(grouped: DataFrame, text: str) -> DataFrame:
    """One audit row per portfolio row that was not kept; `grouped` is `grouped_rows` of the portfolio by `WHO`."""
    return rows_not_kept(grouped, WHO).select(*_audit_row(STEP_DUPLICATES, DUPLICATE, F.lit(text)))


def duplicates_by_order(portfolio: DataFrame, order: Sequence[str], text: str, arrival: str | None = None) -> DataFrame:
    """The same rows from the portfolio itself, which is read once."""
    return duplicate_audit(grouped_rows(portfolio, ["NO_DAMA"], WHO, order, arrival=arrival), text)


def _audit_row(step: str, motive: str, detail: Column) -> list[Column]:
    values = {"PASO": F.lit(step), "MOTIVO": F.lit(motive), "NIVEL": F.lit(LEVELS[motive]), "DETALLE": detail}
    return [values.get(c, F.col(c)).alias(c) for c in AUDIT_COLUMNS]


def finding(condition: Column, step: str, motive: str, detail: Column) -> Column:
    """The audit row of one check as a struct, null where the check is fine."""
    return F.when(condition, F.struct(*_audit_row(step, motive, detail)))


def findings_audit(df: DataFrame, findings: Sequence[Column]) -> DataFrame:
    """All findings of all checks in one pass over `df`."""
    found = F.filter(F.array(*findings), lambda f: f.isNotNull())
    return df.select(F.explode(found).alias("_f")).select("_f.*")


def without_collector() -> Column:
    return ~has_text(F.col("ID_COBRADOR"))


def expired_finding(excluded: Column) -> Column:
    return finding(excluded, STEP_EXPIRY, EXPIRED, F.lit(EXPIRED_TEXT))


def no_collector_finding(kept: Column) -> Column:
    return finding(kept & without_collector(), STEP_CHECKS, NO_COLLECTOR, F.lit(NO_COLLECTOR_TEXT))


def overpaid_finding(kept: Column, overpaid: Column) -> Column:
    return finding(kept & overpaid, STEP_CHECKS, OVERPAID, F.lit(OVERPAID_TEXT))


def negative_finding() -> Column:
    balance = F.col("SALDO_FINAL")
    detail = F.concat(F.lit(NEGATIVE_TEXT), balance.cast("string"))
    return finding(balance < 0, STEP_CHECKS, NEGATIVE, detail)


def stamp_audit(audit: DataFrame, run_id: int, moment: Column) -> DataFrame:
    """Audit rows with the run they belong to."""
    run = F.lit(run_id).cast("bigint").alias("ID_EJECUCION")
    return audit.select(run, moment.cast(CLOCK).alias("FECHA_HORA"), *AUDIT_COLUMNS)
