"""Master build with age by campaign: arrears accounts appended, gaps filled, balances restated, expired rows out."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from arrears_mart.functions.addresses import split_address
from arrears_mart.functions.balances import collector, is_expired, is_overpaid, payments, updated_balance
from arrears_mart.functions.campaigns import (
    account_campaign_key,
    age_by_campaign,
    normal_of_digits,
    year_of_digits,
)
from arrears_mart.functions.dates import days_overdue, run_clock
from arrears_mart.functions.text import blank_to_null, closing_code, digits_only, has_text, join_words
from arrears_mart.operators import audit as A
from arrears_mart.operators import enrich as E
from arrears_mart.operators.metrics import counted, match_flags, matches, run_totals
from arrears_mart.operators.unique import grouped_rows, kept_rows, latest_per_key
from arrears_mart.plans.result import MasterResult, missing_error, stopped
from arrears_mart.schemas import (
    ACCOUNT_KEY,
    ARREARS,
    ARREARS_COPIED,
    BALANCES,
    CAMPAIGN_MASTER_COLUMNS,
    CLIENTS,
    CONTACTS,
    PORTFOLIO,
    RUN_COUNTS,
    ZONES,
    columns_of,
)
from arrears_mart.sources.tables import typed_sources
from arrears_mart.stages import stage_table

LATEST_FIRST = ("FECHA_FACTURA", "FECHA_FINAL_VIGENCIA", "FECHA_CARGA")
# Columns the arrears row completes, and those only the parts of its free-text address complete.
_FROM_ARREARS = (
    "TELEFONO_CASA TELEFONO_CELULAR DIGITO_DAMA SEGMENTO ESTADO_PROCESO POBLACION ESTADO COLONIA CODIGO_POSTAL"
).split()
_FROM_ADDRESS = ("CALLE", "NUMERO_EXTERIOR", "NUMERO_INTERIOR")
_CLIENT_COLUMNS = (*_FROM_ARREARS, *_FROM_ADDRESS)


def portfolio_facts(portfolio: DataFrame, run_year: int) -> DataFrame:
    """One row: rows with a usable key, and the latest year among campaigns that carry one (else the run year)."""
    year = F.max(year_of_digits(F.col("_digits")).try_cast("bigint"))
    return _with_digits(portfolio).agg(
        F.count_if(has_text(F.col("NO_DAMA"))).alias("REG_PROCESADOS"),
        F.coalesce(year, F.lit(run_year).cast("bigint")).alias("ANIO"),
    )


def with_normal_campaign(df: DataFrame, reference_year: int) -> DataFrame:
    normal = normal_of_digits(F.col("_digits"), reference_year)
    return _with_digits(df).withColumn("CAMPANA_SALDO", normal).drop("_digits")


def _with_digits(df: DataFrame) -> DataFrame:
    """A column of its own for the digits, so that their regular expression runs once per row."""
    return df.withColumn("_digits", digits_only(F.col("CAMPANA_SALDO")))


def latest_accounts(portfolio: DataFrame, arrival: str | None = None) -> DataFrame:
    """The latest portfolio row of each account."""
    payload = _others(PORTFOLIO, "NO_DAMA")
    return latest_per_key(E.keyed(portfolio), ["NO_DAMA"], LATEST_FIRST, payload, E.arrival_in(portfolio, arrival))


def grouped_portfolio(portfolio: DataFrame, arrival: str | None = None) -> DataFrame:
    """The portfolio reduced to what both the kept accounts and the audit of the others need (`grouped_rows`)."""
    payload = _others(PORTFOLIO, "NO_DAMA")
    return grouped_rows(E.keyed(portfolio), ["NO_DAMA"], A.WHO, LATEST_FIRST, payload, E.arrival_in(portfolio, arrival))


def accounts_and_duplicates(
    portfolio: DataFrame,
    text: str,
    arrival: str | None,
    write: Callable[[DataFrame], DataFrame] | None,
    step_counts: dict[str, Observation] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The latest row of each account, and the audit of the others.

    With `write`, which stores a frame, one full reading of the portfolio serves both; without, each reads it once. Then
    `step_counts` gets the number of accounts.
    """
    if write is None:
        order = E.arrival_in(portfolio, arrival)
        return latest_accounts(portfolio, arrival), A.duplicates_by_order(E.keyed(portfolio), LATEST_FIRST, text, order)
    grouped = write(counted(grouped_portfolio(portfolio, arrival), "PASO1_CUENTAS", step_counts, F.count_if(F.col("_kept"))))
    return kept_rows(grouped, ["NO_DAMA"], _others(PORTFOLIO, "NO_DAMA")), A.duplicate_audit(grouped, text)


def all_accounts(latest: DataFrame, arrears: DataFrame, run_ts: dt.datetime, arrival: str | None = None) -> DataFrame:
    """Latest portfolio rows and the accounts only arrears has."""
    extras = E.accounts_only_in_arrears(latest, arrears, arrival)
    return E.append_new_accounts(latest, extras, run_clock(run_ts))


def client_shape(row: dict[str, Column]) -> dict[str, Column]:
    """Full name and the other client columns, blank text as missing."""
    name = join_words(row["NOMBRE"], row["APELLIDO_PATERNO"], row["APELLIDO_MATERNO"])
    rest = [c for c in _CLIENT_COLUMNS if c not in ("SEGMENTO", "ESTADO_PROCESO")]
    return {"NOMBRE_COMPLETO": F.nullif(name, F.lit(""))} | {c: blank_to_null(row[c]) for c in rest}


def arrears_shape(row: dict[str, Column]) -> dict[str, Column]:
    """What an arrears row says about the client, from its columns or its free-text address, and what is copied."""
    parts = split_address(row["DOMICILIO"])
    shape = {c: F.coalesce(blank_to_null(row[c]), parts.get(c)) if c in parts else blank_to_null(row[c]) for c in _FROM_ARREARS}
    shape |= {c: parts[c] for c in _FROM_ADDRESS}
    shape |= {"NOMBRE_COMPLETO": blank_to_null(row["NOMBRE"]), "DOMICILIO": blank_to_null(row["DOMICILIO"])}
    shape |= {"PRECIERRE": closing_code(row["PRECIERRE_1"], row["PRECIERRE_2"]), "SALDO_DAMA": row["SALDO_DAMA"]}
    return shape | {c: row[c] for c in ARREARS_COPIED}


def fill_gaps(df: DataFrame) -> DataFrame:
    """Client data first, then what the arrears row says; nothing is overwritten.

    Takes the joined structs apart, so this is where rows get wide.
    """

    def of(struct: str, *names: str) -> dict[str, Column]:
        return {n: F.col(f"{struct}.{n}") for n in names}

    own = {c: blank_to_null(F.col(c)) for c in ("SEGMENTO", "ESTADO_PROCESO")} | {"SALDO_DAMA": F.col("SALDO_DAMA")}
    own |= of("CLI", *[c for c in (*_CLIENT_COLUMNS, "NOMBRE_COMPLETO") if c not in own])
    filled = {c: F.coalesce(mine, F.col(f"MORA.{c}")) for c, mine in own.items()}
    filled |= of("MORA", "PRECIERRE", "DOMICILIO", *ARREARS_COPIED)
    filled |= of("GES", *E.LAST_CONTACT) | of("ZON", "REGION", "DIVISION", "RUTA")
    filled["FECHA_ULTIMA_LLAMADA"] = F.col("GES.FECHA_ULTIMA_LLAMADA").cast("date")
    filled["COBRADOR_ZONA"] = F.col("ZON.ID_COBRADOR")
    filled |= match_flags()
    kept = [c for c in df.columns if c not in filled and c not in ("CLI", "MORA", "GES", "ZON")]
    wide = df.select(*kept, *[c.alias(n) for n, c in filled.items()])
    street = F.nullif(join_words(*[F.col(c) for c in _FROM_ADDRESS]), F.lit(""))
    return wide.withColumn("DIRECCION_COMPLETA", F.coalesce(street, F.col("DOMICILIO"))).drop("DOMICILIO")


def _others(source: str, key: str) -> list[str]:
    return [c for c in columns_of(source) if c != key]


def add_indicators(df: DataFrame, newest: Column, run_ts: dt.datetime) -> DataFrame:
    """Age, collector, balances, payments, keys, and whether the account is out or overpaid."""
    debt, paid, reported = F.col("SALDO_DAMA"), F.col("PAGOS_DAMA"), F.col("S")
    aged = df.withColumn("TEMPORALIDAD", age_by_campaign(F.col("CAMPANA_SALDO"), newest))
    stated = aged.withColumns(
        {
            "DIAS_MORA": days_overdue(F.col("FECHA_FACTURA"), run_ts.date()),
            "ID_COBRADOR": collector(F.col("TEMPORALIDAD"), F.col("ID_COBRADOR"), F.col("COBRADOR_ZONA")),
            "SALDO_ACTUALIZADO": updated_balance(debt, paid, reported),
            "PAGOS_DAMA": payments(debt, paid, reported),
            "SOBREPAGO": is_overpaid(reported),
            "FECHA_ACTUALIZACION": run_clock(run_ts),
            ACCOUNT_KEY: account_campaign_key(F.col("NO_DAMA"), F.col("CAMPANA_SALDO")),
        }
    )
    run_date = F.lit(run_ts.date())
    out = is_expired(F.col("FECHA_FINAL_VIGENCIA"), run_date, F.col("TEMPORALIDAD"), F.col("PAGOS_DAMA"))
    return stated.withColumn("EXCLUIDA", out).select(*CAMPAIGN_MASTER_COLUMNS, "SOBREPAGO", "EXCLUIDA", *match_flags())


def enrich_accounts(
    accounts: DataFrame,
    sources: dict[str, DataFrame],
    newest: Column,
    run_ts: dt.datetime,
    postal_codes: DataFrame | None = None,
    arrival: str | None = None,
) -> DataFrame:
    """All accounts with every master column, plus the flags `SOBREPAGO` and `EXCLUIDA` and which sources matched.

    The joins on the account come first and share one partitioning of the accounts; the lookups follow. Each adds a
    struct, so the rows stay narrow until `fill_gaps`.
    """
    joined = E.join_clients(accounts, sources[CLIENTS], arrival, client_shape)
    joined = E.join_arrears(joined, sources[ARREARS], arrival, arrears_shape)
    joined = E.join_contacts(joined, sources[CONTACTS], True, arrival)
    joined = E.join_balance_by_campaign_digits(joined, sources[BALANCES], arrival)
    joined = E.join_zones(joined, sources[ZONES], arrival)
    placed = E.fill_place_by_postal_code(fill_gaps(joined), postal_codes, arrival)
    return add_indicators(placed, newest, run_ts)


def run_aggregates() -> dict[str, Column]:
    """What the run counts need of the enriched accounts, all of it in one pass."""
    kept = ~F.col("EXCLUIDA")
    return {
        "REG_CONSOLIDADOS": F.count_if(kept),
        "REG_NUEVOS_MORAS": F.count_if(kept & (F.col("CARTERA_MORAS") == "NUEVA")),
        "REG_EXCLUIDOS_VIGENCIA": F.count_if(F.col("EXCLUIDA")),
        "_latest": F.count_if(F.col("CARTERA_MORAS") == ""),
        "_unassigned": F.count_if(kept & A.without_collector()),
        "_overpaid": F.count_if(kept & F.col("SOBREPAGO")),
        **matches(kept),
    }


def run_counts(totals: DataFrame, processed: int) -> DataFrame:
    """One row of run counts from one row of `run_aggregates`."""
    flagged = F.lit(processed) - F.col("_latest") + F.col("REG_EXCLUIDOS_VIGENCIA") + F.col("_unassigned") + F.col("_overpaid")
    counts = totals.withColumns({"REG_PROCESADOS": F.lit(processed).cast("bigint"), "REG_CON_ERROR": flagged})
    return counts.select(*RUN_COUNTS)


def build_campaign_master(
    spark: SparkSession,
    sources: dict[str, DataFrame],
    run_ts: dt.datetime,
    postal_codes: DataFrame | None = None,
    arrival: str | None = None,
    write_stages: bool = True,
    step_counts: dict[str, Observation] | None = None,
) -> MasterResult:
    """Build the master by campaign rules.

    `postal_codes` are catalogue rows, not necessarily unique; without them towns and states stay as they are.
    `arrival` names a numeric column with the file order of the rows; sources that have it use it to break ties.
    The account list is always written once, because its newest campaign, observed meanwhile, must be known before any
    account gets its age. With `write_stages` the reduced portfolio and the enriched accounts are written once as well and
    master and audit read them back; the run counts are observed while the enriched accounts are written. Turn it off when
    only one of these is wanted. With `step_counts` the rows of each stage table are counted while it is written:
    `step_counts["PASO1_CUENTAS"].get["FILAS"]`.
    """
    error = missing_error(sources)
    if error:
        return stopped(spark, error)
    typed = typed_sources(sources, arrival)
    facts = portfolio_facts(typed[PORTFOLIO], run_ts.year).first()
    if facts["REG_PROCESADOS"] == 0:
        columns = ", ".join(sources[PORTFOLIO].columns) or "(ninguna)"
        return stopped(spark, f"{PORTFOLIO} no tiene filas con NO_DAMA. Columnas detectadas: {columns}.")
    for name in (PORTFOLIO, ARREARS, BALANCES):
        typed[name] = with_normal_campaign(typed[name], facts["ANIO"])

    stages: list[str] = []
    write = (lambda name: lambda df: stage_table(df, name, stages)) if write_stages else lambda name: None
    latest, duplicates = accounts_and_duplicates(typed[PORTFOLIO], A.DUPLICATE_TEXT_CAMPAIGN, arrival, write("portfolio"))
    accounts = counted(all_accounts(latest, typed[ARREARS], run_ts, arrival), "PASO1_CUENTAS", step_counts)
    accounts, newest = E.with_newest_campaign(accounts, lambda df: stage_table(df, "accounts", stages))
    enriched = enrich_accounts(accounts, typed, newest, run_ts, postal_codes, arrival)
    if write_stages:
        enriched = counted(enriched, "PASO2_COMPLETAS", step_counts)
    enriched, totals = run_totals(enriched, run_aggregates(), write("enriched"))

    kept, out = ~F.col("EXCLUIDA"), F.col("EXCLUIDA")
    checks = [A.expired_finding(out), A.no_collector_finding(kept), A.overpaid_finding(kept, F.col("SOBREPAGO"))]
    return MasterResult(
        base=enriched.filter(kept).select(*CAMPAIGN_MASTER_COLUMNS),
        audit=duplicates.unionByName(A.findings_audit(enriched, checks)),
        metrics=run_counts(totals, facts["REG_PROCESADOS"]),
        stages=stages,
    )
