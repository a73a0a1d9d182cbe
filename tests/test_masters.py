"""The two builds over the sample rows, with results worked out by hand."""

import datetime as dt
import random

import pytest
import sample
from pyspark.sql import functions as F

from arrears_mart import schemas
from arrears_mart.operators import indicators, metrics
from arrears_mart.plans.campaign_master import build_campaign_master
from arrears_mart.plans.days_master import build_days_master
from arrears_mart.sources.tables import read_sources


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    return read_sources(spark, sample.write(tmp_path_factory.mktemp("sample")))


def at(day):
    return dt.datetime.fromisoformat(day) + dt.timedelta(hours=6)


def campaign(spark, sources, day, **options):
    return build_campaign_master(spark, sources, at(day), **options)


@pytest.mark.parametrize("write_stages", [True, False])
@pytest.mark.parametrize(
    ("day", "counts", "motives"),
    [
        ("2026-04-15", (6, 5, 0, 0, 3), {"NO_DAMA_DUPLICADO": ["7102"], "ZONA_SIN_COBRADOR": ["7103"], "CUENTA_LIQUIDADA_SOBREPAGO": ["7104"]}),
        ("2026-07-01", (6, 3, 0, 2, 4), {"NO_DAMA_DUPLICADO": ["7102"], "VIGENCIA_VENCIDA": ["7101", "7104"], "ZONA_SIN_COBRADOR": ["7103"]}),
        ("2026-08-01", (6, 2, 0, 3, 5), {"NO_DAMA_DUPLICADO": ["7102"], "VIGENCIA_VENCIDA": ["7101", "7102", "7104"], "ZONA_SIN_COBRADOR": ["7103"]}),
    ],
)
def test_campaign_counts_and_audit(spark, sources, day, counts, motives, write_stages):
    result = campaign(spark, sources, day, write_stages=write_stages)
    assert tuple(result.metrics.first())[:5] == counts
    assert result.base.count() == counts[1]
    found = {}
    for row in result.audit.collect():
        found.setdefault(row.MOTIVO, []).append(row.NO_DAMA)
    assert {m: sorted(a) for m, a in found.items()} == motives


def test_campaign_values(spark, sources):
    base = {r.NO_DAMA: r for r in campaign(spark, sources, "2026-04-15").base.collect()}
    columns = ("TEMPORALIDAD", "ID_COBRADOR", "SALDO_DAMA", "PAGOS_DAMA", "SALDO_ACTUALIZADO", "CAMPANA_SALDO", "PRECIERRE")
    assert {k: tuple(r[c] if not hasattr(r[c], "quantize") else float(r[c]) for c in columns) for k, r in base.items()} == {
        "7101": ("Mora 1", "COB-11", 2400.0, 775.0, 1625.0, "202605", "P1-7101"),
        "7102": ("Inactivas", "COB-11", 1330.0, 140.0, 1190.0, "202606", "P2-7102"),
        "7103": ("Mora 1", None, 945.0, 0.0, 945.0, "202605", None),
        "7104": ("Mora 1", "COB-22", 360.0, 360.0, 0.0, "202605", None),
        "7105": ("Mora 1", "COB-22", 3100.0, 0.0, 3100.0, "202605", None),
    }
    first = base["7101"]
    assert (first.NUMERO_GESTIONES, first.STATUS_GESTION, first.FECHA_PROMESA) == (4, "ACUERDO", dt.date(2026, 7, 20))
    assert (first.FECHA_ULTIMA_LLAMADA, first.LLAVE_DAMA_CAMPANA) == (dt.date(2026, 6, 22), "7101-05")
    assert (first.NOMBRE_COMPLETO, first.DIRECCION_COMPLETA) == ("ELENA ROJAS VEGA", "Olmo Viejo 17 4")
    assert base["7105"].NUMERO_GESTIONES == 0
    assert list(first.asDict()) == list(schemas.CAMPAIGN_MASTER_COLUMNS)


def test_days_since_invoice(spark, sources):
    base = build_days_master(spark, sources, at("2026-07-01")).base
    assert {r.NO_DAMA: (r.DIAS_MORA, r.TEMPORALIDAD) for r in base.collect()} == {
        "7101": (140, "121-150"),
        "7102": (50, "31-60"),
        "7103": (167, "151-180"),
        "7104": (90, "61-90"),
        "7105": (264, "181+"),
    }


@pytest.mark.parametrize("day", ["2026-04-15", "2026-08-01"])
def test_days_counts_and_audit(spark, sources, day):
    result = build_days_master(spark, sources, at(day))
    assert tuple(result.metrics.first())[:5] == (6, 5, 0, 0, 3)
    audit = {(r.MOTIVO, r.NO_DAMA): r.DETALLE for r in result.audit.collect()}
    assert set(audit) == {("NO_DAMA_DUPLICADO", "7102"), ("ZONA_SIN_COBRADOR", "7103"), ("SALDO_NEGATIVO", "7104")}
    assert audit["SALDO_NEGATIVO", "7104"] == "SALDO_FINAL negativo = -155.00"
    assert result.base.columns == list(schemas.DAYS_MASTER_COLUMNS)
    assert indicators.has_unique_keys(result.base, ["NO_DAMA"])


def test_arrears_accounts_are_appended_once(spark, sources):
    arrears = spark.createDataFrame(
        [
            ("7101", "5", "Z02", None),  # campaign 05 of account 7101 is there already
            ("7101", "202504", "Z02", "NORTE No 8 Int b COL SOL CP 45680"),
            ("7101", "202604", "Z01", None),  # same account and digits: the first row wins
            ("0009", "202607", "Z01", "LUNA S/N 44100 X"),
            ("0009", None, "Z01", None),
            (" ", "202607", "Z01", None),
        ],
        "NO_DAMA string, CAMPANA_SALDO string, ZONA string, DOMICILIO string",
    ).withColumn("ORD", F.monotonically_increasing_id())
    postal = spark.createDataFrame([("45680", "El Salto", "Jalisco"), ("7300", "Lagos", "Altos")], schemas.POSTAL_SCHEMA)
    changed = sources | {schemas.ARREARS: arrears.coalesce(1)}
    result = campaign(spark, changed, "2026-04-15", postal_codes=postal, arrival="ORD")
    new = {(r.NO_DAMA, r.CAMPANA_SALDO): r for r in result.base.filter("CARTERA_MORAS = 'NUEVA'").collect()}
    assert set(new) == {("7101", "202504"), ("0009", "202607")}
    assert result.metrics.first().REG_NUEVOS_MORAS == 2
    added = new["0009", "202607"]
    assert (added.TEMPORALIDAD, added.CALLE, added.CODIGO_POSTAL, added.POBLACION) == ("Inactivas", "LUNA S/N", "44100", None)
    assert (added.FECHA_CARGA, added.FECHA_FACTURA, added.DIAS_MORA) == (at("2026-04-15"), None, None)
    # The client's own data stays; only gaps are filled from the arrears row of the account, which is its first one.
    assert (new["7101", "202504"].COLONIA, new["7101", "202504"].CODIGO_POSTAL) == ("Lomas", "07300")
    older = {r.NO_DAMA: r.TEMPORALIDAD for r in result.base.filter("CARTERA_MORAS = ''").collect()}
    assert (older["7102"], older["7101"]) == ("Mora 1", "Mora 2")


def test_town_and_state_come_from_the_postal_code(spark, sources):
    clients = sources[schemas.CLIENTS].withColumns({"POBLACION": F.lit(" "), "ESTADO": F.lit(None).cast("string")})
    postal = spark.createDataFrame([("7300", "LAGOS", "ALTOS"), (" 31200 ", "VALLE", "NORTE"), ("7300", "AAA", "AAA")], schemas.POSTAL_SCHEMA)
    base = campaign(spark, sources | {schemas.CLIENTS: clients}, "2026-04-15", postal_codes=postal).base
    found = {r.NO_DAMA: (r.POBLACION, r.ESTADO) for r in base.collect()}
    assert (found["7101"], found["7103"], found["7102"]) == (("LAGOS", "ALTOS"), ("VALLE", "NORTE"), (None, None))


def test_missing_source_stops_the_build(spark, sources):
    partial = {k: v for k, v in sources.items() if k not in (schemas.ZONES, schemas.BALANCES)}
    for build in (build_campaign_master, build_days_master):
        result = build(spark, partial, at("2026-04-15"))
        assert result.status == "ERROR"
        assert result.errors == ["Tablas fuente faltantes: ZONAS_ASIGNADAS, SALDOS_ACTUALIZADOS"]


def test_portfolio_without_keys_stops_the_build(spark, sources):
    empty = sources[schemas.PORTFOLIO].withColumn("NO_DAMA", F.lit(" "))
    result = campaign(spark, sources | {schemas.PORTFOLIO: empty}, "2026-04-15")
    assert result.status == "ERROR"
    assert "NO_DAMA" in result.errors[0]
    assert tuple(result.metrics.first()) == (0,) * 9


def test_row_order_and_partitions_do_not_matter(spark, sources):
    def shuffled(seed):
        out = {}
        for name, df in sources.items():
            rows = df.union(df).collect() if name != schemas.PORTFOLIO else df.collect()
            random.Random(seed).shuffle(rows)
            out[name] = spark.createDataFrame(rows, df.schema).repartition(1 + seed)
        return out

    first, second = (campaign(spark, shuffled(seed), "2026-07-01") for seed in (1, 4))
    for a, b in ((first.base, second.base), (first.audit, second.audit)):
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_coverage(spark, sources):
    result = campaign(spark, sources, "2026-04-15")
    for covered in (metrics.coverage(result.base, sources), metrics.coverage_of_run(result.metrics)):
        assert {r.FUENTE: (r.CRUZARON, r.PORCENTAJE) for r in covered.collect()} == {
            "CLIENTES": (5, 100.0),
            "ZONAS_ASIGNADAS": (4, 80.0),
            "CARTERA_MORA": (3, 60.0),
            "LAYOUT_ARABELA": (3, 60.0),
        }


@pytest.mark.parametrize("build", [build_campaign_master, build_days_master])
def test_runs_report_coverage_and_the_client_alarm(spark, sources, build):
    result = build(spark, sources, at("2026-04-15"))
    row = result.metrics.first()
    assert (row.CRUCE_CLIENTES, row.CRUCE_ZONAS, row.CRUCE_MORA, row.CRUCE_GESTIONES) == (5, 4, 3, 3)
    assert not result.clients_unmatched()
    strangers = sources[schemas.CLIENTS].withColumn("NO_DAMA", F.lit("x"))
    keyless = sources[schemas.ZONES].withColumnRenamed("ZONA", "TERRITORIO")
    odd = build(spark, sources | {schemas.CLIENTS: strangers, schemas.ZONES: keyless}, at("2026-04-15"))
    assert odd.clients_unmatched()
    assert (odd.metrics.first().CRUCE_CLIENTES, odd.metrics.first().CRUCE_ZONAS) == (0, 0)


@pytest.mark.parametrize("build", [build_campaign_master, build_days_master])
def test_steps_are_counted_on_request(spark, sources, build):
    seen = {}
    build(spark, sources, at("2026-04-15"), step_counts=seen)
    assert {step: count.get["FILAS"] for step, count in seen.items()} == {"PASO1_CUENTAS": 5, "PASO2_COMPLETAS": 5}


def test_days_names_keep_inner_blanks(spark, sources):
    clients = sources[schemas.CLIENTS].withColumn("NOMBRE", F.lit("  ANA   MARIA "))
    changed = sources | {schemas.CLIENTS: clients}
    days = build_days_master(spark, changed, at("2026-04-15")).base.filter("NO_DAMA = '7101'").first()
    campaigns = campaign(spark, changed, "2026-04-15").base.filter("NO_DAMA = '7101'").first()
    assert (days.NOMBRE_COMPLETO, campaigns.NOMBRE_COMPLETO) == ("ANA   MARIA ROJAS VEGA", "ANA MARIA ROJAS VEGA")


def test_summaries_are_ordered(spark):
    master = spark.createDataFrame(
        [("Z2", "K1", "Mora 2", "202605", 5), ("Z1", "K2", "Inactivas", "202606", 9), ("Z2", "K1", "Mora 1", "202605", 1), ("Z3", None, "Mora 3", "202604", 9)],
        "ZONA string, ID_COBRADOR string, TEMPORALIDAD string, CAMPANA_SALDO string, n int",
    ).withColumns({c: F.col("n").cast("decimal(18,2)") for c in ("SALDO_ACTUALIZADO", "PAGOS_DAMA", "SALDO_DAMA", "SALDO_FINAL")})
    master = master.withColumns({"DIAS_MORA": F.lit(3), "NO_DAMA": F.lit("1")}).repartition(3)
    assert [r.TEMPORALIDAD for r in indicators.balance_by_age(master).collect()] == ["Inactivas", "Mora 1", "Mora 2", "Mora 3"]
    assert [r.ZONA for r in indicators.balance_by_zone(master).collect()] == ["Z1", "Z3", "Z2"]
    assert [r.ZONA for r in indicators.distinct_values(master, "ZONA").collect()] == ["Z1", "Z2", "Z3"]
    assert [r.ID_COBRADOR for r in indicators.by_collector(master).collect()] == [None, "K2", "K1"]
    assert [r.CAMPANA_SALDO for r in indicators.by_campaign(master).collect()] == ["202606", "202605", "202604"]
    days = master.withColumn("DIAS_MORA", F.length("TEMPORALIDAD") * F.when(F.col("ZONA") == "Z2", 9).otherwise(1))
    assert [r.TEMPORALIDAD for r in indicators.age_distribution(days).collect()][:2] == ["Mora 3", "Inactivas"]
    wide = master.withColumns({c: F.lit(None) for c in indicators.QUICK_VIEW_COLUMNS if c not in master.columns})
    accounts = wide.withColumn("NO_DAMA", F.concat("TEMPORALIDAD", "ZONA"))
    assert [r.NO_DAMA for r in indicators.quick_view(accounts).collect()] == ["InactivasZ1", "Mora 1Z2", "Mora 2Z2", "Mora 3Z3"]
    audit = spark.createDataFrame([("B", "x", "202602"), ("A", "x", "202601"), ("B", "x", "202601"), ("C", "x", "202601")], "MOTIVO string, NIVEL string, CAMPANA_SALDO string").repartition(3)
    assert [r.MOTIVO for r in indicators.audit_summary(audit).collect()] == ["B", "A", "C"]
    assert [(r.CAMPANA_SALDO, r.MOTIVO) for r in indicators.audit_by_campaign(audit).collect()] == [("202601", "A"), ("202601", "B"), ("202601", "C"), ("202602", "B")]


def test_sums_may_exceed_a_single_value(spark):
    rows = spark.range(40).select(F.lit("9999999999999999.99").cast("decimal(18,2)").alias("SALDO_ACTUALIZADO"), F.lit("Z").alias("ZONA"))
    assert indicators.balance_by_zone(rows).first().SALDO_ACTUALIZADO == 40 * rows.first().SALDO_ACTUALIZADO


def test_invariants_of_the_test_tables(spark):
    from arrears_mart.registry.fixtures import ARRIVAL, RUN_TS, fixture_postal_codes, fixture_sources

    folder = "/root/testdata/sf0.001"
    inputs = fixture_sources(spark, folder)
    result = build_campaign_master(spark, inputs, RUN_TS, fixture_postal_codes(spark, folder), ARRIVAL)
    portfolio, counts = inputs[schemas.PORTFOLIO], result.metrics.first()
    keys = portfolio.select("NO_DAMA").distinct().count()
    audit = {r.MOTIVO: r.TOTAL for r in indicators.audit_summary(result.audit).collect()}
    assert audit["NO_DAMA_DUPLICADO"] == portfolio.count() - keys
    assert audit["VIGENCIA_VENCIDA"] == counts.REG_EXCLUIDOS_VIGENCIA
    assert sum(audit.values()) == counts.REG_CON_ERROR
    assert result.base.filter("SALDO_ACTUALIZADO < 0 or PAGOS_DAMA < 0").isEmpty()
    assert indicators.has_unique_keys(result.base, ["NO_DAMA", "CAMPANA_SALDO"])


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _stored(spark, sources, folder):
    """The sources as Parquet tables, whose scans a plan names."""
    for name, df in sources.items():
        df.write.parquet(f"{folder}/{name}")
    return {name: spark.read.parquet(f"{folder}/{name}") for name in sources}


@pytest.mark.parametrize("build", [build_campaign_master, build_days_master])
def test_a_run_reads_each_source_once(spark, sources, build, tmp_path):
    stored = _stored(spark, sources, str(tmp_path))
    result = build(spark, stored, at("2026-04-15"))
    # What is left to read are the stage tables; the day rules count all portfolio rows, by the key alone.
    for frame in (result.base, result.audit, result.metrics):
        plan = _plan(frame)
        assert not any(f"{tmp_path}/{name}" in plan for name in sources if name != schemas.PORTFOLIO)
        assert plan.count(f"{tmp_path}/{schemas.PORTFOLIO}") <= (build is build_days_master and frame is result.metrics)
    alone = build(spark, stored, at("2026-04-15"), write_stages=False)
    assert alone.metrics.first() == result.metrics.first()
    for name in (schemas.CLIENTS, schemas.CONTACTS, schemas.BALANCES):  # coverage reads no source of its own
        assert _plan(alone.metrics).count(f"{tmp_path}/{name}") <= 1


def test_the_account_list_is_planned_once(spark, sources, tmp_path):
    stored = _stored(spark, sources, str(tmp_path))
    plan = _plan(campaign(spark, stored, "2026-04-15", write_stages=False).base)
    assert f"{tmp_path}/{schemas.PORTFOLIO}" not in plan and plan.count("accounts-") == 1


def test_names_are_joined_in_order(spark):
    rows = [("a", "z"), ("a", None), ("a", "b"), ("a", "b"), ("n", None), (None, "q"), ("a", "ñ"), ("a", "")]
    found = indicators.joined_names(spark.createDataFrame(rows, "g string, v string").repartition(4), ["g"], "v", "names", "; ")
    assert {r.g: r.names for r in found.collect()} == {"a": "; b; b; z; ñ", "n": None, None: "q"}
