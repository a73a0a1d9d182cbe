"""One query per operator over the test tables; the SQL of the same rule stands beside it."""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears_mart.functions import addresses, balances, campaigns, dates, text
from arrears_mart.operators import audit as A
from arrears_mart.operators import enrich as E
from arrears_mart.operators import indicators as I
from arrears_mart.operators import metrics as M
from arrears_mart.operators.unique import first_per_key
from arrears_mart.plans import campaign_master as C
from arrears_mart.plans.days_master import build_days_master
from arrears_mart.plans.result import MasterResult
from arrears_mart.registry import oracle as O
from arrears_mart.registry.fixtures import (
    ARRIVAL,
    RUN_TS,
    fixture,
    fixture_postal_codes,
    fixture_sources,
    table,
)
from arrears_mart.schemas import (
    ARREARS,
    BALANCES,
    CAMPAIGN_MASTER_COLUMNS,
    CLIENTS,
    CONTACTS,
    PORTFOLIO,
    SOURCE_SCHEMAS,
    ZONES,
    columns_of,
)
from arrears_mart.sinks import publish as K
from arrears_mart.sources import checks, headers, tables
from arrears_mart.stages import new_stage_path, stage_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

_ZONE_CHOICE, _AGE_CHOICE = ["Z01", "Z02", "Z03"], ["Mora 1", "Mora 2"]
_REFERENCE_YEAR = 2001


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and the SQL that must give the same rows."""

    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = O.sql(sql)
        return run

    return register


def campaign_result(spark: SparkSession, folder: str, write_stages: bool = False) -> MasterResult:
    postal = fixture_postal_codes(spark, folder)
    return C.build_campaign_master(spark, fixture_sources(spark, folder), RUN_TS, postal, ARRIVAL, write_stages)


def days_result(spark: SparkSession, folder: str, write_stages: bool = False) -> MasterResult:
    return build_days_master(spark, fixture_sources(spark, folder), RUN_TS, ARRIVAL, write_stages)


def typed(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return tables.typed_sources(fixture_sources(spark, folder), ARRIVAL)


def normal(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Typed sources with campaigns in their normal form."""
    sources = typed(spark, folder)
    year = C.portfolio_facts(sources[PORTFOLIO], RUN_TS.year).first()["ANIO"]
    return sources | {n: C.with_normal_campaign(sources[n], year) for n in (PORTFOLIO, ARREARS, BALANCES)}


def latest(spark: SparkSession, folder: str) -> DataFrame:
    return C.latest_accounts(normal(spark, folder)[PORTFOLIO], ARRIVAL)


def accounts(spark: SparkSession, folder: str) -> DataFrame:
    sources = normal(spark, folder)
    return C.all_accounts(C.latest_accounts(sources[PORTFOLIO], ARRIVAL), sources[ARREARS], RUN_TS, ARRIVAL)


def dated_accounts(spark: SparkSession, folder: str) -> tuple[DataFrame, Column]:
    """The stored account list and its newest campaign."""
    return E.with_newest_campaign(accounts(spark, folder), lambda df: stage_table(df, "accounts"))


def messy(spark: SparkSession, folder: str) -> DataFrame:
    return fixture(spark, folder, "fx_messy")


# ---- sources -------------------------------------------------------------------------------------------------


def _as_csv(spark: SparkSession, df: DataFrame, name: str) -> str:
    path = new_stage_path(spark, name)
    K.write_csv(df, path)
    return path


@query(
    "s1_csv_text",
    "select ORD||'' as ORD, case when STATUS_GESTION='view' then null else STATUS_GESTION end as STATUS_GESTION, "
    "NO_DAMA, case when ORD%4=0 then COMENTARIO||chr(10)||'\"sigue\", igual' else COMENTARIO end as COMENTARIO from fx_arabela",
)
def s1(spark, folder):
    """Two files with different column orders, and comments with a line break, a quote and a comma."""
    contacts = fixture(spark, folder, "fx_arabela").select("ORD", "STATUS_GESTION", "NO_DAMA", "COMENTARIO")
    status = F.when(F.col("STATUS_GESTION") == "view", "n/a").otherwise(F.col("STATUS_GESTION"))
    longer = F.concat("COMENTARIO", F.lit('\n"sigue", igual'))
    comment = F.when(F.col("ORD") % 4 == 0, longer).otherwise(F.col("COMENTARIO"))
    written = contacts.withColumns({"STATUS_GESTION": status, "COMENTARIO": comment}).withColumnRenamed("NO_DAMA", "No. Dama")
    path = new_stage_path(spark, "contacts")
    for part, columns in ((0, written.columns), (1, written.columns[::-1])):
        K.write_csv(written.where(F.col("ORD") % 2 == part).select(*[F.col(f"`{c}`") for c in columns]), f"{path}/{part}")
    return tables.read_csv_text(spark, f"{path}/*")


_SOURCE_VIEWS = {
    PORTFOLIO: "fx_cartera",
    CLIENTS: "fx_clientes",
    ZONES: "fx_zonas",
    ARREARS: "fx_mora",
    CONTACTS: "fx_arabela",
    BALANCES: "fx_saldos",
}


@query(
    "s2_sources_by_name",
    " union all ".join(
        f"select '{n}' as FUENTE, count(*) as FILAS, count(distinct {'ZONA' if n == ZONES else 'NO_DAMA'}) as CLAVES from {v}"
        for n, v in _SOURCE_VIEWS.items()
    ),
)
def s2(spark, folder):
    root = new_stage_path(spark, "sources")
    for name, view in _SOURCE_VIEWS.items():
        fixture(spark, folder, view).write.parquet(f"{root}/{name}.parquet")
    found = tables.read_sources(spark, root, file_format="parquet")
    counted = [
        df.agg(F.lit(n).alias("FUENTE"), I.row_count("FILAS"), F.countDistinct("ZONA" if n == ZONES else "NO_DAMA").alias("CLAVES"))
        for n, df in found.items()
    ]
    return functools.reduce(DataFrame.unionByName, counted)


@query(
    "s3_typed_staging",
    "select NO_DAMA, ID_COBRADOR, ZONA, CAMPANA_SALDO, FECHA_FACTURA, FECHA_INICIAL_VIGENCIA, FECHA_FINAL_VIGENCIA, SEGMENTO, "
    "ESTADO_PROCESO, SALDO_DAMA, PAGOS_DAMA, FECHA_CARGA from fx_cartera",
)
def s3(spark, folder):
    portfolio = fixture(spark, folder, "fx_cartera").drop("ORD")
    as_text = portfolio.select(*[F.col(c).cast("string").alias(c) for c in portfolio.columns])
    return tables.typed_scan(as_text, SOURCE_SCHEMAS[PORTFOLIO])


@query(
    "s4_phase2_payments",
    "select lpad(cast(o_custkey as varchar),7,'0') as NO_DAMA, cast(null as varchar) as CAMPANA_SALDO, "
    "cast(o_orderdate as date) as FECHA_PAGO, cast(o_orderkey%1000 as decimal(18,2)) as MONTO_PAGO, o_orderpriority as REFERENCIA from orders",
)
def s4_payments(spark, folder):
    rows = table(spark, folder, "orders").select(
        F.lpad(F.col("o_custkey").cast("string"), 7, "0").alias("NO_DAMA"),
        F.date_format("o_orderdate", "d/M/yyyy").alias("FECHA_PAGO"),
        (F.col("o_orderkey") % 1000).cast("string").alias("MONTO_PAGO"),
        F.col("o_orderpriority").alias("REFERENCIA"),
    )
    return tables.phase2_scan(rows, "PAGOS_MORAS")


@query(
    "s4_phase2_visits",
    "select cast(user_id as varchar) as NO_DAMA, date_trunc('second',ts) as FECHA_VISITA, event_type as RESULTADO_VISITA, "
    "cast(null as varchar) as ID_COBRADOR, cast(null as varchar) as GEOLOCALIZACION from events",
)
def s4_visits(spark, folder):
    rows = table(spark, folder, "events").select(
        F.col("user_id").alias("NO_DAMA"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("FECHA_VISITA"),
        F.col("event_type").alias("RESULTADO_VISITA"),
    )
    return tables.phase2_scan(rows, "REPORTE_VISITAS")


@query(
    "s4_phase2_reminders",
    "select cast(user_id as varchar) as NO_DAMA, ts as FECHA_REMINDER, event_type as CANAL, "
    "cast(null as varchar) as RESULTADO_REMINDER from events",
)
def s4_reminders(spark, folder):
    rows = table(spark, folder, "events").select(
        F.col("user_id").alias("NO_DAMA"), F.col("ts").alias("FECHA_REMINDER"), F.col("event_type").alias("CANAL")
    )
    return tables.phase2_scan(rows, "REPORTE_REMINDER")


@query("s5_postal_catalogue", "select CODIGO as CODIGO_POSTAL, POBLACION, ESTADO from cp_rn where rn=1")
def s5(spark, folder):
    return E.postal_catalogue(fixture_postal_codes(spark, folder), ARRIVAL)


@query("s6_drop_empty_rows", "select T1, T2, CAMP from fx_messy where T1 is not null or T2 is not null or CAMP is not null")
def s6(spark, folder):
    return tables.drop_empty_rows(messy(spark, folder).select("T1", "T2", "CAMP"))


# ---- projections and filters ---------------------------------------------------------------------------------


@query("p1_header_names", "select NO_DAMA, CAMPANA_SALDO, SALDO_ACTUALIZADO, ORD as ORDEN_DE_LLEGADA from fx_saldos")
def p1(spark, folder):
    named = fixture(spark, folder, "fx_saldos").toDF("Núm. Dama", "Campaña", "saldo actualizado", " Orden de  llegada ")
    return headers.normalise_headers(named)


@query(
    "p2_mapping",
    "select ORD, c.c2 as CAMPANA_SALDO, trim(NO_DAMA) as NO_DAMA, 'x' as ZONA_VIEJA from "
    "(select ORD, NO_DAMA, CAMPANA_SALDO, 'C-'||CAMPANA_SALDO as c2 from fx_saldos) c",
)
def p2(spark, folder):
    rows = fixture(spark, folder, "fx_saldos").select(
        "ORD",
        F.concat(F.lit(" "), "NO_DAMA", F.lit(".0")).alias("CUENTA"),
        "CAMPANA_SALDO",
        F.concat(F.lit("C-"), "CAMPANA_SALDO").alias("CAMPANA_NUEVA"),
        F.lit("x").alias("ZONA_VIEJA"),
    )
    mapping = {"NO_DAMA": "CUENTA", "CAMPANA_SALDO": "CAMPANA_NUEVA", "ZONA": "NO_EXISTE", "RUTA": None}
    return headers.apply_mapping(rows, mapping)


@query(
    "p3_clean_keys",
    "select ORD, regexp_replace(trim(LLAVE),'[.]0+$','') as NO_DAMA, trim(T1) as ZONA, trim(CAMP) as CAMPANA_SALDO from fx_messy",
)
def p3(spark, folder):
    keys = [F.col("LLAVE").alias("NO_DAMA"), F.col("T1").alias("ZONA"), F.col("CAMP").alias("CAMPANA_SALDO")]
    return headers.clean_keys(messy(spark, folder).select("ORD", *keys))


@query(
    "p4_missing_columns",
    "select * replace (cast(null as varchar) as COLONIA, cast(null as varchar) as ESTADO) from fx_clientes",
)
def p4(spark, folder):
    given = fixture(spark, folder, "fx_clientes").drop("COLONIA", "ESTADO")
    return headers.ensure_columns(given, SOURCE_SCHEMAS[CLIENTS])


@query("p6_usable_key", "select ORD, trim(T1) as T1 from fx_messy where trim(T1)<>''")
def p6(spark, folder):
    return E.keyed(messy(spark, folder).select("ORD", "T1"), "T1")


@query("p7_choose_rows", "select * from m1 where ZONA in ('Z01','Z02','Z03') and TEMPORALIDAD in ('Mora 1','Mora 2')")
def p7(spark, folder):
    return I.select_rows(campaign_result(spark, folder).base, zones=_ZONE_CHOICE, ages=_AGE_CHOICE)


@query("p8_filter_values", "select distinct ID_COBRADOR from m1 where ID_COBRADOR is not null order by 1")
def p8(spark, folder):
    return I.distinct_values(campaign_result(spark, folder).base, "ID_COBRADOR")


@query(
    "p9_latest_audit",
    "select * from fx_audit where MOTIVO='SALDO_NEGATIVO' and ID_EJECUCION=(select max(ID_EJECUCION) from fx_runs)",
)
def p9(spark, folder):
    audit, runs = fixture(spark, folder, "fx_audit"), fixture(spark, folder, "fx_runs")
    return I.latest_audit(audit, runs, "SALDO_NEGATIVO")


@query(
    "p10_diagnostics",
    "select 'SALDOS_ACTUALIZADOS' as FUENTE, count(*) as FILAS, 'NO_DAMA,SALDO_ACTUALIZADO' as COLUMNAS, "
    "'CAMPANA_SALDO' as CLAVES_FALTANTES, 'CAMPANA_SALDO' as CLAVES_SIN_DATOS from fx_saldos",
)
def p10(spark, folder):
    return checks.diagnose(fixture(spark, folder, "fx_saldos").select("NO_DAMA", "SALDO_ACTUALIZADO"), BALANCES)


@query("p13_expired", "select NO_DAMA, CAMPANA_SALDO, EXCLUIDA from enriched")
def p13(spark, folder):
    sources = normal(spark, folder)
    postal = fixture_postal_codes(spark, folder)
    stored, newest = dated_accounts(spark, folder)
    rows = C.enrich_accounts(stored, sources, newest, RUN_TS, postal, ARRIVAL)
    return rows.select("NO_DAMA", "CAMPANA_SALDO", "EXCLUIDA")


@query("p14_quick_view", f"select {', '.join(I.QUICK_VIEW_COLUMNS)} from m2 order by NO_DAMA")
def p14(spark, folder):
    return I.quick_view(days_result(spark, folder).base)


_EXPORT_SQL = (
    "select * replace ("
    + ", ".join(f"strftime({c},'%d/%m/%Y') as {c}" for c in K.EXPORTED_DATES)
    + ") rename (LLAVE_DAMA_CAMPANA as \"LLAVE_DAMA_CAMPAÑA\") from m1"
)


@query("p15_export_dates", _EXPORT_SQL)
def p15(spark, folder):
    return K.export_view(campaign_result(spark, folder).base)


# ---- joins ---------------------------------------------------------------------------------------------------


@query(
    "j1_clients",
    "select a.NO_DAMA, DIGITO_DAMA, NOMBRE, CODIGO_POSTAL from cart_rn a left join fx_clientes c on c.NO_DAMA=a.NO_DAMA where a.rn=1",
)
def j1(spark, folder):
    joined = E.join_clients(latest(spark, folder), typed(spark, folder)[CLIENTS], ARRIVAL)
    return joined.select("NO_DAMA", "CLI.DIGITO_DAMA", "CLI.NOMBRE", "CLI.CODIGO_POSTAL")


_J2_SQL = "select a.NO_DAMA, a.ZONA, REGION, DIVISION, RUTA, z.ID_COBRADOR from cart_rn a left join fx_zonas z on z.ZONA=a.ZONA where a.rn=1"


def _zones(spark: SparkSession, folder: str, **options) -> DataFrame:
    joined = E.join_zones(latest(spark, folder), typed(spark, folder)[ZONES], ARRIVAL, **options)
    return joined.select("NO_DAMA", "ZONA", "ZON.REGION", "ZON.DIVISION", "ZON.RUTA", "ZON.ID_COBRADOR")


@query("j2_zones", _J2_SQL)
def j2(spark, folder):
    return _zones(spark, folder)


@query("j2_zones_salted", _J2_SQL)
def j2_salted(spark, folder):
    return _zones(spark, folder, broadcast_bytes=0)


@query(
    "j3_arrears",
    "select a.NO_DAMA, m.CAMP as M_CAMPANA_SALDO, m.NOMBRE as M_NOMBRE, m.SALDO_DAMA as M_SALDO_DAMA, a.SALDO_DAMA from cart_rn a "
    "left join (select m.*, row_number() over (partition by NO_DAMA order by ORD) as r from mora_n m) m on m.NO_DAMA=a.NO_DAMA and r=1 where a.rn=1",
)
def j3(spark, folder):
    joined = E.join_arrears(latest(spark, folder), normal(spark, folder)[ARREARS], ARRIVAL)
    added = [F.col(f"MORA.{c}").alias(f"M_{c}") for c in ("CAMPANA_SALDO", "NOMBRE", "SALDO_DAMA")]
    return joined.select("NO_DAMA", "SALDO_DAMA", *added)


@query(
    "j4_latest_contact",
    "select a.NO_DAMA, l.STATUS_GESTION, l.COMENTARIO from cart_rn a left join calls_rn l on l.NO_DAMA=a.NO_DAMA and l.rn=1 where a.rn=1",
)
def j4(spark, folder):
    joined = E.join_contacts(latest(spark, folder), typed(spark, folder)[CONTACTS], True, ARRIVAL)
    return joined.select("NO_DAMA", "GES.STATUS_GESTION", "GES.COMENTARIO")


@query(
    "j5_contact_counts",
    "select a.NO_DAMA, coalesce(n.N,0) as NUMERO_GESTIONES, n.ULT as FECHA_ULTIMA_LLAMADA from cart_rn a "
    "left join calls_n n on n.NO_DAMA=a.NO_DAMA where a.rn=1",
)
def j5(spark, folder):
    joined = E.join_contacts(latest(spark, folder), typed(spark, folder)[CONTACTS], True, ARRIVAL)
    return joined.select("NO_DAMA", "NUMERO_GESTIONES", "GES.FECHA_ULTIMA_LLAMADA")


@query(
    "j6_balance_by_camp2",
    "select a.NO_DAMA, a.CAMPANA_SALDO, s.SALDO_ACTUALIZADO as S from acc a left join sal_rn s on s.NO_DAMA=a.NO_DAMA "
    "and s.C2=right(a.CAMPANA_SALDO,2) and s.rn=1",
)
def j6(spark, folder):
    joined = E.join_balance_by_campaign_digits(accounts(spark, folder), normal(spark, folder)[BALANCES], ARRIVAL)
    return joined.select("NO_DAMA", "CAMPANA_SALDO", "S")


@query(
    "j7_balance_exact",
    "select a.NO_DAMA, a.CAMP as CAMPANA_SALDO, s.SALDO_ACTUALIZADO from cart_rn a left join exact_rn s on s.NO_DAMA=a.NO_DAMA "
    "and s.CAMPANA_SALDO=a.CAMP and s.rn=1 where a.rn=1",
)
def j7(spark, folder):
    joined = E.join_balance_by_campaign(latest(spark, folder), typed(spark, folder)[BALANCES], ARRIVAL)
    return joined.select("NO_DAMA", "CAMPANA_SALDO", "SALDO_ACTUALIZADO")


@query("j8_new_accounts", "select NO_DAMA, ZONA, CAMP as CAMPANA_SALDO from missing_rn where rn=1")
def j8(spark, folder):
    return E.accounts_only_in_arrears(latest(spark, folder), normal(spark, folder)[ARREARS], ARRIVAL)


@query("j9_newest_run_rows", "select * from fx_audit where ID_EJECUCION=(select max(ID_EJECUCION) from fx_runs)")
def j9(spark, folder):
    return I.latest_run(fixture(spark, folder, "fx_audit"), fixture(spark, folder, "fx_runs"))


_COVERAGE_SQL = " union all ".join(
    f"select '{n}' as FUENTE, cast(count(*) as bigint) as CRUZARON, "
    f"100.0*count(*)/greatest((select count(*) from m1),1)::double as PORCENTAJE from m1 where {k} in (select {k} from {v} where {k} is not null)"
    for n, k, v in (
        (CLIENTS, "NO_DAMA", "fx_clientes"),
        (ZONES, "ZONA", "fx_zonas"),
        (ARREARS, "NO_DAMA", "fx_mora"),
        (CONTACTS, "NO_DAMA", "fx_arabela"),
    )
)


@query("j10_coverage", _COVERAGE_SQL)
def j10(spark, folder):
    return M.coverage_of_run(campaign_result(spark, folder).metrics)


@query(
    "j11_postal_lookup",
    f"select m.ORD, p.POBLACION, p.ESTADO from fx_messy m left join cp_rn p on p.rn=1 and length({O.digits('m.CP')})>=5 "
    f"and p.CODIGO=right({O.digits('m.CP')},5)",
)
def j11(spark, folder):
    rows = messy(spark, folder).select("ORD", F.col("CP").alias("CODIGO_POSTAL"), F.col("ORD").alias("NO_DAMA"))
    unknown = rows.withColumns({c: F.lit(None).cast("string") for c in ("POBLACION", "ESTADO")})
    filled = E.fill_place_by_postal_code(unknown, fixture_postal_codes(spark, folder), ARRIVAL)
    return filled.select("ORD", "POBLACION", "ESTADO")


@query("j12_newest_on_each_row", "select NO_DAMA, CAMPANA_SALDO, (select n from newest) as NUEVA from acc")
def j12(spark, folder):
    rows, newest = dated_accounts(spark, folder)
    return rows.select("NO_DAMA", "CAMPANA_SALDO", newest.alias("NUEVA"))


# ---- one row per key -----------------------------------------------------------------------------------------


@query(
    "w1_latest_per_key",
    "select NO_DAMA, ID_COBRADOR, ZONA, CAMP as CAMPANA_SALDO, FECHA_FACTURA, FECHA_INICIAL_VIGENCIA, FECHA_FINAL_VIGENCIA, SEGMENTO, "
    "ESTADO_PROCESO, SALDO_DAMA, PAGOS_DAMA, FECHA_CARGA from cart_rn where rn=1",
)
def w1(spark, folder):
    return latest(spark, folder).select(*columns_of(PORTFOLIO))


@query(
    "w2_latest_contact",
    "select c.NO_DAMA, STATUS_GESTION, MOTIVO_NO_COBRO, DICTAMINACION, COMENTARIO, "
    "FECHA_PROMESA, ULT as FECHA_ULTIMA_LLAMADA, N as NUMERO_GESTIONES "
    "from calls_rn c join calls_n n on n.NO_DAMA=c.NO_DAMA where rn=1",
)
def w2(spark, folder):
    summary = E.contact_summary(typed(spark, folder)[CONTACTS], True, ARRIVAL)
    return summary.select("NO_DAMA", "GES.FECHA_ULTIMA_LLAMADA", *[f"GES.{c}" for c in E.LAST_CONTACT], "NUMERO_GESTIONES")


@query("w3_discarded", O.DUPLICATE)
def w3(spark, folder):
    portfolio = E.keyed(normal(spark, folder)[PORTFOLIO])
    return A.duplicates_by_order(portfolio, C.LATEST_FIRST, A.DUPLICATE_TEXT_CAMPAIGN, ARRIVAL)


@query("a1_first_arrears", "select NO_DAMA, NOMBRE, DOMICILIO, ORD from mora_rn where rn=1")
def a1_arrears(spark, folder):
    return first_per_key(fixture(spark, folder, "fx_mora"), ["NO_DAMA"], ["NOMBRE", "DOMICILIO", "ORD"], ARRIVAL)


@query("a1_first_balance", "select NO_DAMA, CAMPANA_SALDO, SALDO_ACTUALIZADO from exact_rn where rn=1")
def a1_balance(spark, folder):
    keys = ["NO_DAMA", "CAMPANA_SALDO"]
    return first_per_key(fixture(spark, folder, "fx_saldos"), keys, ["SALDO_ACTUALIZADO"], ARRIVAL)


# ---- aggregates ----------------------------------------------------------------------------------------------


@query("g1_contacts_per_account", "select NO_DAMA, N as NUMERO_GESTIONES from contacts_n")
def g1(spark, folder):
    return E.contact_summary(typed(spark, folder)[CONTACTS], True, ARRIVAL).select("NO_DAMA", "NUMERO_GESTIONES")


@query("g2_latest_call", "select NO_DAMA, ULT as FECHA_ULTIMA_LLAMADA from calls_n")
def g2(spark, folder):
    return E.contact_summary(typed(spark, folder)[CONTACTS], True, ARRIVAL).select("NO_DAMA", "GES.FECHA_ULTIMA_LLAMADA")


def _sum(column: str) -> str:
    return f"cast(sum({column}) as decimal(38,2)) as {column}"


@query("g3_balance_by_age", f"select TEMPORALIDAD, {_sum('SALDO_ACTUALIZADO')} from m1 where TEMPORALIDAD is not null group by 1")
def g3(spark, folder):
    return I.balance_by_age(campaign_result(spark, folder).base)


@query("g4_balance_by_zone", f"select ZONA, {_sum('SALDO_ACTUALIZADO')} from m1 where ZONA is not null group by 1")
def g4(spark, folder):
    return I.balance_by_zone(campaign_result(spark, folder).base)


@query("g5_by_collector", f"select ID_COBRADOR, count(NO_DAMA) as REGISTROS, {_sum('SALDO_ACTUALIZADO')} from m1 group by 1")
def g5(spark, folder):
    return I.by_collector(campaign_result(spark, folder).base)


@query(
    "g6_totals",
    f"select {_sum('SALDO_ACTUALIZADO')}, {_sum('PAGOS_DAMA')}, avg(DIAS_MORA) as DIAS_MORA_PROMEDIO from m1",
)
def g6(spark, folder):
    return I.totals(campaign_result(spark, folder).base)


@query("g7_by_campaign", "select CAMPANA_SALDO, count(*) as EN_BASE from m1 where CAMPANA_SALDO is not null group by 1")
def g7(spark, folder):
    return I.by_campaign(campaign_result(spark, folder).base)


@query(
    "g7_find_campaign",
    "select 'EN_BASE' as LUGAR, count(*) as TOTAL from m1 where CAMPANA_SALDO='200107' "
    "union all select MOTIVO, count(*) from m1_audit where CAMPANA_SALDO='200107' group by 1",
)
def g7_find(spark, folder):
    result = campaign_result(spark, folder, write_stages=True)
    return I.find_campaign(result.base, result.audit, "200107")


@query("g8_audit_by_campaign", "select CAMPANA_SALDO, MOTIVO, count(*) as TOTAL from m1_audit where CAMPANA_SALDO is not null group by 1,2")
def g8(spark, folder):
    return I.audit_by_campaign(campaign_result(spark, folder).audit)


@query("g9_audit_summary", "select MOTIVO, NIVEL, count(*) as TOTAL from m1_audit group by 1,2")
def g9(spark, folder):
    return I.audit_summary(campaign_result(spark, folder).audit)


@query(
    "g9_audit_summary_latest",
    "select MOTIVO, NIVEL, count(*) as TOTAL from fx_audit where ID_EJECUCION=(select max(ID_EJECUCION) from fx_runs) group by 1,2",
)
def g9_latest(spark, folder):
    return I.audit_summary(I.latest_run(fixture(spark, folder, "fx_audit"), fixture(spark, folder, "fx_runs")))


@query("g10_by_age_days", f"select TEMPORALIDAD, count(*) as CUENTAS, {_sum('SALDO_FINAL')} from m2 group by 1")
def g10(spark, folder):
    return I.age_distribution(days_result(spark, folder).base)


@query("g11_repeated_keys", "select NO_DAMA, count(*) as REPETICIONES from fx_cartera group by 1 having count(*)>1")
def g11(spark, folder):
    return I.repeated_keys(fixture(spark, folder, "fx_cartera"), ["NO_DAMA"])


@query("g11_repeated_in_master", "select NO_DAMA, CAMPANA_SALDO, count(*) as REPETICIONES from m1 group by 1,2 having count(*)>1")
def g11_master(spark, folder):
    return I.repeated_keys(campaign_result(spark, folder).base, ["NO_DAMA", "CAMPANA_SALDO"])


def _matched(master: str) -> str:
    """The master rows whose key each covered source has."""
    return ", ".join(
        f"(select count(*) from {master} where {k} in (select {k} from {v} where {k} is not null)) as {c}"
        for k, v, c in (
            ("NO_DAMA", "fx_clientes", "CRUCE_CLIENTES"),
            ("ZONA", "fx_zonas", "CRUCE_ZONAS"),
            ("NO_DAMA", "fx_mora", "CRUCE_MORA"),
            ("NO_DAMA", "fx_arabela", "CRUCE_GESTIONES"),
        )
    )


@query(
    "g12_metrics",
    "select (select count(*) from cart) as REG_PROCESADOS, (select count(*) from m1) as REG_CONSOLIDADOS, "
    "(select count(*) from m1 where CARTERA_MORAS='NUEVA') as REG_NUEVOS_MORAS, "
    "(select count(*) from enriched where EXCLUIDA) as REG_EXCLUIDOS_VIGENCIA, (select count(*) from m1_audit) as REG_CON_ERROR, "
    + _matched("m1"),
)
def g12(spark, folder):
    return campaign_result(spark, folder).metrics


@query(
    "g12_metrics_days",
    "select (select count(*) from fx_cartera) as REG_PROCESADOS, (select count(*) from m2) as REG_CONSOLIDADOS, "
    "cast(0 as bigint) as REG_NUEVOS_MORAS, cast(0 as bigint) as REG_EXCLUIDOS_VIGENCIA, (select count(*) from m2_audit) as REG_CON_ERROR, "
    + _matched("m2"),
)
def g12_days(spark, folder):
    return days_result(spark, folder).metrics


@query("g13_reference_year", "select (select count(*) from cart) as REG_PROCESADOS, y as ANIO from ref")
def g13(spark, folder):
    return C.portfolio_facts(typed(spark, folder)[PORTFOLIO], RUN_TS.year)


@query("g14_newest_campaign", "select n as NUEVA from newest")
def g14(spark, folder):
    return E.newest_campaign(accounts(spark, folder))


@query("g15_joined_names", "select REGION, string_agg(ZONA, ', ' order by ZONA) as ZONAS from fx_zonas group by 1")
def g15(spark, folder):
    return I.joined_names(fixture(spark, folder, "fx_zonas"), ["REGION"], "ZONA", "ZONAS")


@query("o3_newest_run", "select * from fx_runs order by ID_EJECUCION desc limit 1")
def o3(spark, folder):
    return I.newest_run(fixture(spark, folder, "fx_runs"))


@query("o4_failed_runs", "select * from fx_runs where ESTATUS='ERROR'")
def o4(spark, folder):
    return I.failed_runs(fixture(spark, folder, "fx_runs"))


@query("u1_with_new_accounts", "select COB as ID_COBRADOR, * exclude (COB) from acc")
def u1(spark, folder):
    return accounts(spark, folder)


@query("u2_audit_union", "select * from m2_audit")
def u2(spark, folder):
    return days_result(spark, folder).audit


# ---- column functions ----------------------------------------------------------------------------------------


def messy_query(name: str, sql: str, columns: Callable[[], dict[str, Column]]) -> None:
    """Register a query that applies column functions to the messy text table."""

    def run(spark, folder):
        return messy(spark, folder).select("ORD", *[c.alias(n) for n, c in columns().items()])

    query(name, f"select ORD, {sql} from fx_messy")(run)


def _debt() -> Column:
    return text.parse_money(F.col("MONTO"))


def _paid() -> Column:
    return F.lit(300)


def _reported() -> Column:
    return F.when(F.col("ORD") % 3 == 0, (F.col("ORD") % 700 - 200).cast("decimal(18,2)"))


_DEBT, _PAID, _REPORTED = "try_cast(trim(MONTO) as decimal(18,2))", "300", "case when ORD%3=0 then ORD%700-200 end"
_CAMP = O.digits("CAMP")
_CAMP_YEAR = f"case when length({_CAMP})>=5 then left({_CAMP},length({_CAMP})-2) else '{_REFERENCE_YEAR}' end"

messy_query("f1_clean_key", "regexp_replace(trim(LLAVE),'[.]0+$','') as K", lambda: {"K": text.clean_key(F.col("LLAVE"))})
messy_query("f2_blank_to_null", "case when trim(T1)<>'' then T1 end as T", lambda: {"T": text.blank_to_null(F.col("T1"))})
messy_query(
    "f3_join_words",
    f"{O.words('T1', 'T2', 'CAMP')} as T",
    lambda: {"T": text.join_words(F.col("T1"), F.col("T2"), F.col("CAMP"))},
)
messy_query("f4_digits_only", f"{_CAMP} as D", lambda: {"D": text.digits_only(F.col("CAMP"))})
messy_query("f5_campaign_number", f"try_cast({_CAMP} as bigint) as N", lambda: {"N": campaigns.campaign_number(F.col("CAMP"))})
messy_query("f6_campaign_last2", f"coalesce(right({_CAMP},2),'') as C2", lambda: {"C2": campaigns.campaign_last2(F.col("CAMP"))})
messy_query(
    "f7_campaign",
    f"case when {_CAMP}<>'' then {_CAMP_YEAR}||lpad(right({_CAMP},2),2,'0') end as C",
    lambda: {"C": campaigns.normalise_campaign(F.col("CAMP"), _REFERENCE_YEAR)},
)
messy_query(
    "f8_account_key",
    f"trim(LLAVE)||'-'||coalesce(right({_CAMP},2),'') as K",
    lambda: {"K": campaigns.account_campaign_key(F.col("LLAVE"), F.col("CAMP"))},
)
messy_query(
    "f10_age_days",
    f"{O.overdue_label(O.overdue('DIA'))} as T",
    lambda: {"T": dates.age_by_days(dates.days_overdue(F.col("DIA"), RUN_TS.date()))},
)
messy_query(
    "f11_days_overdue",
    f"{O.overdue('DIA')} as D",
    lambda: {"D": dates.days_overdue(F.col("DIA"), RUN_TS.date())},
)
messy_query(
    "f12_final_balance",
    f"cast(coalesce({_DEBT},0)-{_PAID} as decimal(18,2)) as S",
    lambda: {"S": balances.final_balance(_debt(), _paid())},
)
messy_query(
    "f13_balance",
    f"cast(greatest(coalesce({_REPORTED},coalesce({_DEBT},0)-{_PAID}),0) as decimal(18,2)) as S",
    lambda: {"S": balances.updated_balance(_debt(), _paid(), _reported())},
)
messy_query(
    "f14_payments",
    f"cast(case when {_REPORTED} is null then {_PAID} else greatest(coalesce({_DEBT},0)-greatest({_REPORTED},0),0) end as decimal(18,2)) as P",
    lambda: {"P": balances.payments(_debt(), _paid(), _reported())},
)
messy_query("f15_overpaid", f"coalesce({_REPORTED}<0,false) as X", lambda: {"X": balances.is_overpaid(_reported())})
messy_query(
    "f16_first_present",
    "coalesce(case when trim(T1)<>'' then T1 end, case when trim(T2)<>'' then T2 end, CAMP) as T",
    lambda: {"T": text.first_present(F.col("T1"), F.col("T2"), F.col("CAMP"))},
)
messy_query(
    "f17_closing_code",
    "coalesce(nullif(trim(T2),''),nullif(trim(T1),'')) as P",
    lambda: {"P": text.closing_code(F.col("T1"), F.col("T2"))},
)
messy_query("f19_date_in_note", f"{O.day_in_note('NOTA')} as D", lambda: {"D": dates.date_in_parentheses(F.col("NOTA"))})
messy_query(
    "f20_call_date",
    f"coalesce(cast({O.day_in_note('NOTA')} as timestamp),cast(DIA as timestamp)) as L",
    lambda: {"L": dates.call_clock(F.col("NOTA"), F.col("DIA"))},
)
messy_query(
    "f21_postal_code",
    f"case when length({O.digits('CP')})>=5 then right({O.digits('CP')},5) end as C",
    lambda: {"C": addresses.postal_code(F.col("CP"))},
)
messy_query(
    "f23_parsed_values",
    f"{_DEBT} as M, case when regexp_matches(trim(FECHA),'^\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}$') "
    "then cast(try_strptime(trim(FECHA),'%d/%m/%Y') as date) else try_cast(try_cast(trim(FECHA) as timestamp) as date) end as D",
    lambda: {"M": _debt(), "D": dates.parse_date(F.col("FECHA"))},
)
messy_query("f24_run_time", f"{O.RUN_TS} as FECHA_ACTUALIZACION", lambda: {"FECHA_ACTUALIZACION": dates.run_clock(RUN_TS)})


@query("f9_age_campaign", f"select NO_DAMA, CAMPANA_SALDO, {O.age('CAMPANA_SALDO', '(select n from newest)')} as TEMPORALIDAD from acc")
def f9(spark, folder):
    rows, newest = dated_accounts(spark, folder)
    age = campaigns.age_by_campaign(F.col("CAMPANA_SALDO"), newest)
    return rows.select("NO_DAMA", "CAMPANA_SALDO", age.alias("TEMPORALIDAD"))


@query(
    "f18_collector",
    f"select a.NO_DAMA, a.CAMPANA_SALDO, case when {O.age('a.CAMPANA_SALDO', '(select n from newest)')}='Inactivas' "
    "then coalesce(a.COB,z.ID_COBRADOR) else coalesce(z.ID_COBRADOR,a.COB) end as ID_COBRADOR "
    "from acc a left join fx_zonas z on z.ZONA=a.ZONA",
)
def f18(spark, folder):
    rows, newest = dated_accounts(spark, folder)
    age = campaigns.age_by_campaign(F.col("CAMPANA_SALDO"), newest)
    zoned = E.join_zones(rows, typed(spark, folder)[ZONES], ARRIVAL)
    who = balances.collector(age, F.col("ID_COBRADOR"), F.col("ZON.ID_COBRADOR"))
    return zoned.select("NO_DAMA", "CAMPANA_SALDO", who.alias("ID_COBRADOR"))


@query(
    "f22_address",
    f"select ORD, {O.address('DOMICILIO')} from fx_mora",
)
def f22(spark, folder):
    parts = addresses.split_address(F.col("DOMICILIO"))
    return fixture(spark, folder, "fx_mora").select("ORD", *[c.alias(f"A_{n}") for n, c in parts.items()])


@query(
    "g16_step_counts",
    "select 'PASO1_CUENTAS' as PASO, count(*) as FILAS from acc union all select 'PASO2_COMPLETAS', count(*) from enriched",
)
def g16(spark, folder):
    counts = {}
    postal, sources = fixture_postal_codes(spark, folder), fixture_sources(spark, folder)
    C.build_campaign_master(spark, sources, RUN_TS, postal, ARRIVAL, write_stages=True, step_counts=counts)
    return spark.createDataFrame([(step, seen.get["FILAS"]) for step, seen in counts.items()], "PASO string, FILAS bigint")


# ---- validations ---------------------------------------------------------------------------------------------


def _motive(result: MasterResult, motive: str) -> DataFrame:
    return result.audit.filter(F.col("MOTIVO") == motive)


@query("v1_duplicates", O.DAYS_DUPLICATE)
def v1(spark, folder):
    return _motive(days_result(spark, folder), A.DUPLICATE)


@query("v2_expired", O.EXPIRED)
def v2(spark, folder):
    return _motive(campaign_result(spark, folder), A.EXPIRED)


@query("v3_no_collector", O.NO_COLLECTOR)
def v3(spark, folder):
    return _motive(campaign_result(spark, folder), A.NO_COLLECTOR)


@query("v3_no_collector_days", O.DAYS_NO_COLLECTOR)
def v3_days(spark, folder):
    return _motive(days_result(spark, folder), A.NO_COLLECTOR)


@query("v4_overpaid", O.OVERPAID)
def v4(spark, folder):
    return _motive(campaign_result(spark, folder), A.OVERPAID)


@query("v5_negative", O.NEGATIVE)
def v5(spark, folder):
    return _motive(days_result(spark, folder), A.NEGATIVE)


# ---- builds --------------------------------------------------------------------------------------------------


@query("m1_master_campaign", "select * from m1")
def m1(spark, folder):
    return campaign_result(spark, folder).base


@query("m1_audit", "select * from m1_audit")
def m1_audit(spark, folder):
    return campaign_result(spark, folder).audit


@query("m2_master_days", "select * from m2")
def m2(spark, folder):
    return days_result(spark, folder).base


# ---- sinks ---------------------------------------------------------------------------------------------------

_RUN_ID = 7


def _ended() -> dt.datetime:
    return RUN_TS + dt.timedelta(minutes=5)


def published(spark: SparkSession, folder: str) -> str:
    """Publish one run by campaign rules into a folder of its own."""
    root = new_stage_path(spark, "published")
    K.publish_run(spark, lambda: campaign_result(spark, folder, True), root, _RUN_ID, RUN_TS, _ended)
    return root


@query("k1_published_master", "select * from m1")
def k1(spark, folder):
    return K.read_master(spark, published(spark, folder))


_BY_CONTACTS = (
    "select m.NO_DAMA, count(*) as FILAS, max(n.N) as GESTIONES from m1 m left join contacts_n n on n.NO_DAMA=m.NO_DAMA group by 1"
)


@query("k1_master_by_account", _BY_CONTACTS)
def k1_by_account(spark, folder):
    """The published master joined and grouped by account, which exchanges the contacts but not the master."""
    master = K.master_by_account(spark, published(spark, folder))
    return E.master_with_contacts(master, fixture(spark, folder, "fx_arabela"))


@query("k2_published_audit", f"select cast({_RUN_ID} as bigint) as ID_EJECUCION, {O.RUN_TS} as FECHA_HORA, * from m1_audit")
def k2(spark, folder):
    return K.read_audit(spark, published(spark, folder))


@query(
    "k3_run_log",
    f"select cast({_RUN_ID} as bigint) as ID_EJECUCION, '{K.PROCESS_NAME}' as PROCESO, {O.RUN_TS} as FECHA_INICIO, "
    "timestamp '2001-08-01 06:05:00' as FECHA_FIN, 'EXITO' as ESTATUS, (select count(*) from cart) as REG_PROCESADOS, "
    "(select count(*) from m1) as REG_CONSOLIDADOS, (select count(*) from m1 where CARTERA_MORAS='NUEVA') as REG_NUEVOS_MORAS, "
    "(select count(*) from enriched where EXCLUIDA) as REG_EXCLUIDOS_VIGENCIA, (select count(*) from m1_audit) as REG_CON_ERROR, "
    "'Proceso completado. Consolidados='||(select count(*) from m1)||', Incidencias='||(select count(*) from m1_audit)||'.' as MENSAJE, "
    + _matched("m1"),
)
def k3(spark, folder):
    return K.read_run_log(spark, published(spark, folder)).drop("RUTA")  # a new folder each time


def _csv_text(sql: str, columns: tuple[str, ...]) -> str:
    """What a CSV file keeps of a table: text, with empty text read back as missing."""
    return "select " + ", ".join(f'nullif(cast("{c}" as varchar),\'\') as "{c}"' for c in columns) + f" from ({sql}) t"


_EXPORTED = tuple(K.ACCOUNT_KEY_EXPORTED if c == K.ACCOUNT_KEY else c for c in CAMPAIGN_MASTER_COLUMNS)


@query("k4_master_csv", _csv_text(_EXPORT_SQL, _EXPORTED))
def k4(spark, folder):
    path = new_stage_path(spark, "master-csv")
    K.write_csv(K.export_view(campaign_result(spark, folder).base), path)
    return spark.read.csv(path, header=True, escape='"')


@query("k5_report_audit", _csv_text("select * from m1_audit", A.AUDIT_COLUMNS))
def k5(spark, folder):
    result = campaign_result(spark, folder, write_stages=True)
    path = new_stage_path(spark, "report")
    log = K.log_row(spark, _RUN_ID, K.SUCCESS, RUN_TS, _ended(), result.metrics)
    K.write_report(result.base, result.audit, log, path)
    return K.read_report(spark, path)["AUDITORIA_RECHAZOS"]


_LOG_SHOWN = ("ID_EJECUCION", "PROCESO", "ESTATUS", "REG_PROCESADOS", "REG_CONSOLIDADOS", "REG_CON_ERROR", "MENSAJE")


def _as_rows(name: str, sql: str, columns: tuple[str, ...]) -> str:
    listed = ", ".join(f'"{c}"' for c in columns)
    return f"select '{name}' as TABLA, concat_ws('|', {listed}) as FILA from ({_csv_text(sql, columns)}) r"


@query(
    "k5_report",
    " union all ".join(
        [
            _as_rows("MASTER", _EXPORT_SQL, _EXPORTED),
            _as_rows("AUDITORIA_RECHAZOS", "select * from m1_audit", A.AUDIT_COLUMNS),
            _as_rows(
                "BITACORA",
                f"select {_RUN_ID} as ID_EJECUCION, '{K.PROCESS_NAME}' as PROCESO, 'EXITO' as ESTATUS, (select count(*) from cart) as REG_PROCESADOS, "
                "(select count(*) from m1) as REG_CONSOLIDADOS, (select count(*) from m1_audit) as REG_CON_ERROR, "
                "'Proceso completado. Consolidados='||(select count(*) from m1)||', Incidencias='||(select count(*) from m1_audit)||'.' as MENSAJE",
                _LOG_SHOWN,
            ),
        ]
    ),
)
def k5_all(spark, folder):
    """Every row of all three tables of a report that was written twice, as one text."""
    result = campaign_result(spark, folder, write_stages=True)
    path = new_stage_path(spark, "report")
    log = K.log_row(spark, _RUN_ID, K.SUCCESS, RUN_TS, _ended(), result.metrics)
    K.write_report(result.base.limit(1), result.audit.limit(1), log, path, lambda: RUN_TS)
    K.write_report(result.base, result.audit, log, path, _ended)
    found = K.read_report(spark, path)
    shown = {"MASTER": _EXPORTED, "AUDITORIA_RECHAZOS": A.AUDIT_COLUMNS, "BITACORA": _LOG_SHOWN}
    rows = [found[n].select(F.lit(n).alias("TABLA"), F.concat_ws("|", *columns).alias("FILA")) for n, columns in shown.items()]
    return functools.reduce(DataFrame.unionByName, rows)


@query(
    "k6_arrears_key_export",
    f"select NO_DAMA, CAMPANA_SALDO, NOMBRE, trim(NO_DAMA)||'-'||right({O.campaign('CAMPANA_SALDO')},2) as \"{K.ACCOUNT_KEY_EXPORTED}\" from fx_mora",
)
def k6(spark, folder):
    arrears = fixture(spark, folder, "fx_mora").select("NO_DAMA", "CAMPANA_SALDO", "NOMBRE")
    year = K.reference_year(fixture(spark, folder, "fx_cartera"), RUN_TS.year)
    path = new_stage_path(spark, "arrears-csv")
    K.write_csv(K.with_account_key(arrears, year), path)
    return spark.read.csv(path, header=True, escape='"')
