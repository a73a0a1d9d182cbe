import datetime as dt

import pytest
import sample
from pyspark.sql import functions as F

from arrears_mart import schemas
from arrears_mart.operators import enrich, indicators
from arrears_mart.plans.days_master import build_days_master
from arrears_mart.plans.result import stopped
from arrears_mart.sinks import publish as K
from arrears_mart.sources.tables import read_sources

START = dt.datetime(2026, 7, 1, 6)


def end():
    return dt.datetime(2026, 7, 1, 6, 4)


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    return read_sources(spark, sample.write(tmp_path_factory.mktemp("publish")))


def run(spark, sources, root, run_id):
    return K.publish_run(spark, lambda: build_days_master(spark, sources, START), root, run_id, START, end)


def test_runs_replace_the_master_and_add_to_audit_and_log(spark, sources, tmp_path):
    root = str(tmp_path)
    run(spark, sources, root, 1)
    run(spark, sources, root, 2)
    run(spark, sources, root, 2)  # repeating a run changes nothing
    assert K.read_master(spark, root).count() == 5
    audit, log = K.read_audit(spark, root), K.read_run_log(spark, root)
    assert {(r.ID_EJECUCION, r.MOTIVO) for r in audit.collect()} == {(i, m) for i in (1, 2) for m in ("NO_DAMA_DUPLICADO", "ZONA_SIN_COBRADOR", "SALDO_NEGATIVO")}
    assert audit.count() == 6
    row = indicators.newest_run(log).first()
    assert (row.ID_EJECUCION, row.ESTATUS, row.REG_PROCESADOS, row.REG_CONSOLIDADOS, row.REG_CON_ERROR) == (2, "EXITO", 6, 5, 3)
    assert (row.FECHA_INICIO, row.FECHA_FIN, row.MENSAJE) == (START, end(), "Proceso completado. Consolidados=5, Incidencias=3.")
    assert [r.NO_DAMA for r in indicators.latest_audit(audit, log, "SALDO_NEGATIVO").collect()] == ["7104"]
    assert indicators.latest_audit(audit, log).count() == 3


def test_a_failed_run_leaves_the_last_master_in_place(spark, sources, tmp_path):
    root = str(tmp_path)
    run(spark, sources, root, 1)

    def broken():
        raise RuntimeError("no space")

    with pytest.raises(RuntimeError):
        K.publish_run(spark, broken, root, 2, START, end)
    K.publish_run(spark, lambda: stopped(spark, "nothing to read"), root, 3, START, end)
    assert K.current_run(spark, root) == 1
    assert K.read_master(spark, root).count() == 5
    failed = indicators.failed_runs(K.read_run_log(spark, root)).collect()
    assert [(r.ID_EJECUCION, r.MENSAJE) for r in failed] == [(3, "ERROR en construir base maestra: nothing to read"), (2, "ERROR en construir base maestra: no space")]


def test_no_successful_run(spark, sources, tmp_path):
    K.append_log(K.log_row(spark, 1, K.OPEN, START), str(tmp_path))
    with pytest.raises(ValueError, match="no successful run"):
        K.read_master(spark, str(tmp_path))


def test_a_failed_or_lost_repeat_leaves_the_run_readable(spark, sources, tmp_path):
    root = str(tmp_path)
    run(spark, sources, root, 1)

    def breaks_while_writing():
        result = build_days_master(spark, sources, START)
        result.audit = result.audit.withColumn("NIVEL", F.raise_error(F.lit("disk is full")).cast("string"))
        return result

    with pytest.raises(Exception, match="disk is full"):
        K.publish_run(spark, breaks_while_writing, root, 1, START, end)
    # A driver that dies leaves an open row and a part of a folder.
    lost = K.new_attempt(root, 1)
    K.append_log(K.log_row(spark, 1, K.OPEN, START, attempt=lost), root)
    spark.range(1).write.parquet(f"{lost}/master")
    assert K.current_run(spark, root) == 1
    assert K.read_master(spark, root).count() == 5
    assert K.read_audit(spark, root).count() == 3
    log = spark.read.schema(K.RUN_LOG_SCHEMA).parquet(f"{root}/run_log")
    assert log.filter("ESTATUS = 'ERROR'").first().MENSAJE.startswith("ERROR en escribir auditoria: ")


def test_a_table_is_pointed_at_the_newest_run(spark, sources, tmp_path):
    root = str(tmp_path)
    for run_id in (1, 2):
        K.publish_run(spark, lambda: build_days_master(spark, sources, START), root, run_id, START, end, table="published_master")
    assert spark.table("published_master").count() == 5
    assert "run-2-" in spark.table("published_master").inputFiles()[0]
    spark.sql("drop table published_master")


def test_a_table_that_cannot_be_pointed_does_not_undo_the_run(spark, sources, tmp_path):
    root = str(tmp_path)
    with pytest.raises(Exception):
        K.publish_run(spark, lambda: build_days_master(spark, sources, START), root, 1, START, end, table="no such name!")
    assert K.current_run(spark, root) == 1


def test_stages_go_after_success(spark, sources, tmp_path):
    made = build_days_master(spark, sources, START)
    assert made.stages and not build_days_master(spark, sources, START, write_stages=False).stages
    published = K.publish_run(spark, lambda: made, str(tmp_path), 1, START, end)
    assert published.stages == [] and published.base.count() == 5 and published.metrics.first().REG_CONSOLIDADOS == 5
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(made.stages[0])


def test_exports(spark, sources, tmp_path):
    result = build_days_master(spark, sources, START)
    log = K.log_row(spark, 1, K.SUCCESS, START, end(), result.metrics)
    K.write_report(result.base, result.audit, log, str(tmp_path / "report"))
    report = K.read_report(spark, str(tmp_path / "report"))
    master = report["MASTER"]
    first = master.filter("NO_DAMA = '7101'").first()
    assert (first.FECHA_FACTURA, first.FECHA_PROMESA, first.SALDO_FINAL) == ("11/02/2026", "20/07/2026", "1750.00")
    assert report["AUDITORIA_RECHAZOS"].count() == 3
    assert report["BITACORA"].first().REG_CON_ERROR == "3"
    # A report whose last table cannot be written leaves the one before it in place.
    broken = log.withColumn("MENSAJE", F.raise_error(F.lit("disk is full")).cast("string"))
    with pytest.raises(Exception, match="disk is full"):
        K.write_report(result.base.limit(1), result.audit.limit(1), broken, str(tmp_path / "report"))
    assert {n: t.count() for n, t in K.read_report(spark, str(tmp_path / "report")).items()} == {"MASTER": 5, "AUDITORIA_RECHAZOS": 3, "BITACORA": 1}
    K.write_report(result.base.limit(2), result.audit, log, str(tmp_path / "report"))
    assert K.read_report(spark, str(tmp_path / "report"))["MASTER"].count() == 2


def test_a_master_in_buckets_is_not_exchanged(spark, sources, tmp_path):
    root = str(tmp_path)
    K.publish_run(spark, lambda: build_days_master(spark, sources, START), root, 1, START, end, buckets=4)
    assert sorted(map(str, K.master_by_account(spark, root).collect())) == sorted(map(str, K.read_master(spark, root).collect()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        contacts = sources[schemas.CONTACTS].coalesce(1)
        joined = enrich.master_with_contacts(K.master_by_account(spark, root), contacts)
        wanted = enrich.master_with_contacts(K.read_master(spark, root), contacts)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        # The contacts are exchanged for the join, the buckets of the master are read as they are.
        assert plan.count("Exchange hashpartitioning") == wanted._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") - 1
        assert "Bucketed: true" in plan and "SelectedBucketsCount: 4 out of 4" in plan
        assert sorted(map(tuple, joined.collect()), key=str) == sorted(map(tuple, wanted.collect()), key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    K.publish_run(spark, lambda: build_days_master(spark, sources, START), root, 2, START, end, buckets=0)
    assert K.master_by_account(spark, root).count() == 5


def test_csv_keeps_spaces_and_accents(spark, tmp_path):
    df = spark.createDataFrame([(" ñ, \"x\" ", "a\\b")], ["A", "B"])
    K.write_csv(df, str(tmp_path / "c"))
    assert spark.read.csv(str(tmp_path / "c"), header=True, escape='"').collect() == df.collect()


def test_account_key_uses_the_normal_campaign(spark):
    arrears = spark.createDataFrame([("7663231", "9"), ("7665522", "202512"), ("1", None)], ["NO_DAMA", "CAMPANA_SALDO"])
    keys = [r[K.ACCOUNT_KEY_EXPORTED] for r in K.with_account_key(arrears, 2026).collect()]
    assert keys == ["7663231-09", "7665522-12", "1-"]
    assert K.with_account_key(arrears.drop("CAMPANA_SALDO"), 2026).first()[K.ACCOUNT_KEY_EXPORTED] is None
