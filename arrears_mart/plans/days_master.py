"""Master build with age by days overdue: balances as reported, nothing appended, nothing dropped."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from arrears_mart.functions.balances import final_balance
from arrears_mart.functions.dates import age_by_days, days_overdue, run_clock
from arrears_mart.functions.text import closing_code, has_text, join_parts
from arrears_mart.operators import audit as A
from arrears_mart.operators import enrich as E
from arrears_mart.operators.metrics import counted, match_flags, matches, run_totals
from arrears_mart.plans.campaign_master import accounts_and_duplicates
from arrears_mart.plans.result import MasterResult, missing_error, stopped
from arrears_mart.schemas import (
    ARREARS,
    ARREARS_COPIED,
    BALANCES,
    CLIENTS,
    CONTACTS,
    DAYS_MASTER_COLUMNS,
    PORTFOLIO,
    RUN_COUNTS,
    ZONES,
    columns_of,
)
from arrears_mart.sources.tables import typed_sources
from arrears_mart.stages import stage_table


def client_shape(row: dict[str, Column]) -> dict[str, Column]:
    name = join_parts(row["NOMBRE"], row["APELLIDO_PATERNO"], row["APELLIDO_MATERNO"])
    street = join_parts(row["CALLE"], row["NUMERO_EXTERIOR"], row["NUMERO_INTERIOR"])
    return row | {"NOMBRE_COMPLETO": name, "DIRECCION_COMPLETA": street}


def arrears_shape(row: dict[str, Column]) -> dict[str, Column]:
    copied = {c: row[c] for c in ARREARS_COPIED}
    return copied | {"PRECIERRE": closing_code(row["PRECIERRE_1"], row["PRECIERRE_2"])}


def enrich_by_days(
    latest: DataFrame, sources: dict[str, DataFrame], run_ts: dt.datetime, arrival: str | None = None
) -> DataFrame:
    """Latest accounts with every column of the master by days, and which sources matched."""
    # The balance join is on (account, campaign), so it goes first, while the rows are narrow.
    joined = E.join_balance_by_campaign(latest, sources[BALANCES], arrival)
    joined = E.join_clients(joined, sources[CLIENTS], arrival, client_shape)
    joined = E.join_arrears(joined, sources[ARREARS], arrival, arrears_shape)
    joined = E.join_contacts(joined, sources[CONTACTS], False, arrival)
    joined = E.join_zones(joined, sources[ZONES], arrival)
    days = days_overdue(F.col("FECHA_FACTURA"), run_ts.date())
    columns = {
        **{c: F.col(f"CLI.{c}") for c in columns_of(CLIENTS) if c != "NO_DAMA"},
        **{c: F.col(f"MORA.{c}") for c in (*ARREARS_COPIED, "PRECIERRE")},
        **{c: F.col(f"GES.{c}") for c in E.LAST_CONTACT},
        **{c: F.col(f"ZON.{c}") for c in columns_of(ZONES) if c != "ZONA"},
        "NOMBRE_COMPLETO": F.coalesce(F.col("CLI.NOMBRE_COMPLETO"), F.lit("")),
        "DIRECCION_COMPLETA": F.coalesce(F.col("CLI.DIRECCION_COMPLETA"), F.lit("")),
        "SALDO_FINAL": final_balance(F.col("SALDO_DAMA"), F.col("PAGOS_DAMA")),
        "DIAS_MORA": days,
        "TEMPORALIDAD": age_by_days(days),
        "FECHA_ACTUALIZACION": run_clock(run_ts),
    }
    flags = [c.alias(n) for n, c in match_flags().items()]
    return joined.select(*[columns.get(c, F.col(c)).alias(c) for c in DAYS_MASTER_COLUMNS], *flags)


def build_days_master(
    spark: SparkSession,
    sources: dict[str, DataFrame],
    run_ts: dt.datetime,
    arrival: str | None = None,
    write_stages: bool = True,
    step_counts: dict[str, Observation] | None = None,
) -> MasterResult:
    """Build the master by day rules; see `build_campaign_master` for the arguments. Nothing is written without stages."""
    error = missing_error(sources)
    if error:
        return stopped(spark, error)
    typed = typed_sources(sources, arrival)
    portfolio, stages = typed[PORTFOLIO], []
    write = (lambda name: lambda df: stage_table(df, name, stages)) if write_stages else lambda name: None
    latest, duplicates = accounts_and_duplicates(portfolio, A.DUPLICATE_TEXT_DAYS, arrival, write("portfolio"), step_counts)
    enriched = enrich_by_days(latest, typed, run_ts, arrival)
    if write_stages:
        enriched = counted(enriched, "PASO2_COMPLETAS", step_counts)
    aggregates = {
        "REG_CONSOLIDADOS": F.count(F.lit(1)),
        "_unassigned": F.count_if(A.without_collector()),
        "_negative": F.count_if(F.col("SALDO_FINAL") < 0),
        **matches(F.lit(True)),
    }
    enriched, totals = run_totals(enriched, aggregates, write("base"))
    base = enriched.select(*DAYS_MASTER_COLUMNS)
    read = portfolio.agg(F.struct(F.count(F.lit(1)).alias("all"), F.count_if(has_text(F.col("NO_DAMA"))).alias("usable"))).scalar()
    none = F.lit(0).cast("bigint")
    flagged = read["usable"] - F.col("REG_CONSOLIDADOS") + F.col("_unassigned") + F.col("_negative")
    metrics = totals.withColumns(
        {"REG_PROCESADOS": read["all"], "REG_NUEVOS_MORAS": none, "REG_EXCLUIDOS_VIGENCIA": none, "REG_CON_ERROR": flagged}
    )
    audit = duplicates.unionByName(A.findings_audit(base, [A.no_collector_finding(F.lit(True)), A.negative_finding()]))
    return MasterResult(base, audit, metrics.select(*RUN_COUNTS), stages=stages)
