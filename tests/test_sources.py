import csv
import datetime as dt
from decimal import Decimal

import pytest
import sample
from pyspark.sql import functions as F

from arrears_mart import schemas
from arrears_mart.sources import checks, headers, quoted, tables


def test_headers_are_tidied_and_known_spellings_recognised():
    given = ["No. Dama", "NUM DAMA", "Campaña", "CAMPAÑA_SALDO", "id zona", "Gestor", "D.V.", " Fecha de  Alta ", "Tel-Casa", "﻿NoDama"]
    wanted = ["NO_DAMA", "NO_DAMA", "CAMPANA_SALDO", "CAMPANA_SALDO", "ZONA", "ID_COBRADOR", "DIGITO_DAMA", "FECHA_DE_ALTA", "TEL_CASA", "NO_DAMA"]
    assert [headers.normal_header(h) for h in given] == wanted


def test_two_headers_with_one_meaning_are_refused(spark):
    with pytest.raises(ValueError, match="NO_DAMA"):
        headers.normalise_headers(spark.createDataFrame([("1", "2")], ["No. Dama", "NODAMA"]))


def test_csv_is_text_with_null_words_as_null(spark, tmp_path):
    (tmp_path / "x.csv").write_text('No. Dama,Campaña,NOTA\n 0012.0 ,C2026-05,"a, ""b"" "\n7,NA,null\n,,\n', encoding="utf-8")
    df = tables.read_csv_text(spark, str(tmp_path / "x.csv"))
    assert df.columns == ["NO_DAMA", "CAMPANA_SALDO", "NOTA"]
    assert {f.dataType.simpleString() for f in df.schema} == {"string"}
    assert [tuple(r) for r in df.collect()] == [("0012", "C2026-05", 'a, "b" '), ("7", None, None), (None, None, None)]
    assert tables.drop_empty_rows(df).count() == 2


def test_csv_files_are_read_by_their_own_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('NO_DAMA,ZONA,NOTA\n1,Z1,"line one\nline, two"\n2\n', encoding="utf-8")
    (tmp_path / "b.csv").write_text("Zona,No. Dama\nZ9,9\n", encoding="utf-8")
    rows = {r.NO_DAMA: (r.ZONA, r.NOTA) for r in tables.read_csv_text(spark, str(tmp_path)).collect()}
    assert rows == {"1": ("Z1", "line one\nline, two"), "2": (None, None), "9": ("Z9", None)}


def test_csv_rows_that_are_too_long_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("NO_DAMA,ZONA\n1,Z1\n2,Z2,more\n", encoding="utf-8")
    df = tables.read_csv_text(spark, str(tmp_path / "a.csv"))
    with pytest.raises(Exception, match="more fields than its header"):
        df.select("NO_DAMA").collect()


def test_options_reach_the_reader(spark, tmp_path):
    folder = sample.write(tmp_path)
    assert tables.read_sources(spark, folder, multi_line=False)[schemas.PORTFOLIO].count() == 6


def test_sources_that_are_not_there_are_left_out(spark, tmp_path):
    folder = sample.write(tmp_path)
    (tmp_path / "ZONAS_ASIGNADAS.csv").unlink()
    found = tables.read_sources(spark, folder)
    assert list(found) == [n for n in schemas.MANDATORY_SOURCES if n != schemas.ZONES]
    assert checks.missing_sources(found, schemas.MANDATORY_SOURCES) == [schemas.ZONES]
    assert found[schemas.PORTFOLIO].count() == 6


def test_typed_scan_parses_and_completes(spark):
    raw = spark.createDataFrame([("1", "12.5", "2026-06-01", "5/6/2026 08:30"), ("2", "x", "y", None)], ["NO_DAMA", "SALDO_DAMA", "FECHA_FACTURA", "FECHA_CARGA"])
    typed = tables.typed_scan(raw, schemas.SOURCE_SCHEMAS[schemas.PORTFOLIO])
    assert typed.schema.simpleString() == schemas.SOURCE_SCHEMAS[schemas.PORTFOLIO].simpleString()
    first, second = sorted(typed.collect(), key=lambda r: r.NO_DAMA)
    assert (first.SALDO_DAMA, first.FECHA_FACTURA, first.FECHA_CARGA) == (Decimal("12.50"), dt.date(2026, 6, 1), dt.datetime(2026, 6, 5, 8, 30))
    assert (second.SALDO_DAMA, second.FECHA_FACTURA, second.FECHA_CARGA, second.ZONA) == (None,) * 4
    again = tables.typed_scan(typed, schemas.SOURCE_SCHEMAS[schemas.PORTFOLIO])
    assert again.schema == typed.schema


@pytest.mark.parametrize("name", schemas.PHASE2_SCHEMAS)
def test_phase2_tables_are_only_typed(spark, name):
    schema = schemas.PHASE2_SCHEMAS[name]
    empty = spark.createDataFrame([], ", ".join(f"{c} string" for c in schema.fieldNames()))
    assert tables.phase2_scan(empty, name).schema.simpleString() == schema.simpleString()


def test_mapping_is_applied_in_order(spark):
    df = spark.createDataFrame([(" 1.0 ", "old", "9")], ["CUENTA", "NO_DAMA", "ZONA"])
    assert headers.apply_mapping(df, {"NO_DAMA": "CUENTA"}).collect()[0].asDict() == {"NO_DAMA": "1", "ZONA": "9"}
    # The second choice names a column that the first one replaced, so it finds nothing.
    swapped = headers.apply_mapping(df, {"NO_DAMA": "CUENTA", "ZONA": "CUENTA"})
    assert swapped.collect()[0].asDict() == {"NO_DAMA": "1", "ZONA": "9"}
    # The second choice takes the column the first one has just named.
    chained = headers.apply_mapping(df, {"NO_DAMA": "CUENTA", "RUTA": "NO_DAMA"})
    assert chained.collect()[0].asDict() == {"RUTA": " 1.0 ", "ZONA": "9"}
    same = headers.apply_mapping(df, {"NO_DAMA": None, "ZONA": "ZONA", "RUTA": "missing"})
    assert same.columns == df.columns


def test_mappings_are_saved_and_loaded(spark, tmp_path):
    saved = {"CLIENTES": {"NO_DAMA": "CUENTA", "NOMBRE": None, "CALLE": "gone"}, "ZONAS_ASIGNADAS": {"ZONA": "PLAZA"}}
    headers.save_mappings(spark, saved, str(tmp_path / "m"))
    frames = {"CLIENTES": spark.createDataFrame([("1",)], ["CUENTA"])}
    assert headers.load_mappings(spark, str(tmp_path / "m"), frames) == {"CLIENTES": {"NO_DAMA": "CUENTA", "NOMBRE": None}}


def test_load_time_cannot_be_mapped():
    assert "FECHA_CARGA" not in schemas.mappable_columns(schemas.PORTFOLIO)
    assert len(schemas.CAMPAIGN_MASTER_COLUMNS) == 52
    assert len(schemas.DAYS_MASTER_COLUMNS) == 46


def test_diagnosis_names_missing_and_empty_keys(spark):
    df = spark.createDataFrame([(None, "x"), (None, "y")], "NO_DAMA string, SALDO_ACTUALIZADO string")
    row = checks.diagnose(df, schemas.BALANCES).first()
    assert (row.FILAS, row.CLAVES_FALTANTES, row.CLAVES_SIN_DATOS) == (2, "CAMPANA_SALDO", "CAMPANA_SALDO,NO_DAMA")


def test_missing_tables_are_reported_by_name(spark):
    spark.createDataFrame([("1",)], ["a"]).createOrReplaceTempView("is_there")
    assert checks.missing_tables(spark, ["is_there", "not_there"]) == ["not_there"]
    with pytest.raises(ValueError, match="faltantes: not_there, nor_this"):
        checks.require_tables(spark, ["not_there", "is_there", "nor_this"])


def test_usable_key(spark):
    df = spark.createDataFrame([(" ",), (None,)], "NO_DAMA string")
    assert not checks.has_usable_key(df)
    assert checks.has_usable_key(df.union(df.select(F.lit("1"))))


def _quoted_file(folder, rows=4000):
    """A file whose fields hold line breaks, quotes, commas and carriage returns before line feeds, and what it says."""
    import random

    rng = random.Random(3)
    bits = ["x", "line\n", '"', ",", "\r\n", "ñandú", " ", "\n\n", "words and words"]
    wanted = [(str(i), "".join(rng.choices(bits, k=rng.randrange(12))), f"Z{i % 7}") for i in range(rows)]
    wanted[rows // 2] = ("long", "many lines\n" * 3000, "Z")  # longer than a byte range
    with open(folder / "q.csv", "w", encoding="utf-8", newline="") as out:
        csv.writer(out, quoting=csv.QUOTE_MINIMAL, lineterminator="\r\n").writerows([("NO_DAMA", "NOTA", "ZONA"), *wanted])
    return str(folder / "q.csv"), wanted


def test_one_quoted_file_is_cut_by_many_tasks(spark, tmp_path):
    path, wanted = _quoted_file(tmp_path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        facts = quoted.range_facts(spark, path)
        cut = quoted.records(spark, [path], facts)
        assert quoted.physical_lines(spark, path).rdd.getNumPartitions() > 8
        assert quoted._open_ranges(facts).count() > 1
        assert cut.count() == len(wanted)
        found = tables.read_csv_text(spark, path)
        one_task = tables.read_csv_text(spark, path, multi_line=True)
        assert one_task.rdd.getNumPartitions() == 1 < found.rdd.getNumPartitions()
        rows = sorted(map(tuple, found.collect()), key=str)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    one_feed = lambda r: tuple(v and v.replace("\r\n", "\n") for v in r)  # noqa: E731  # Spark's reader turns them into line feeds
    assert sorted(map(one_feed, rows), key=str) == sorted(map(tuple, one_task.collect()), key=str)
    assert {r[0] for r in rows} == {w[0] for w in wanted}
    assert {r[0]: r[1] for r in rows if r[1] and r[1].strip()} == {w[0]: w[1] for w in wanted if w[1].strip()}


def test_records_are_cut_alike_whichever_way_ranges_are_matched(spark, tmp_path, monkeypatch):
    path, wanted = _quoted_file(tmp_path, 300)
    facts = quoted.range_facts(spark, path)
    monkeypatch.setattr(quoted, "BROADCAST_BYTES", -1)
    assert quoted.records(spark, [path], facts).count() == len(wanted)


def test_quoted_files_of_two_headers_are_cut_where_their_own_read_cuts_them(spark, tmp_path):
    """Spark sizes byte ranges by all files of a read: the folder and one header's files are cut at other places."""
    folder = tmp_path / "both"
    folder.mkdir()
    _, wanted = _quoted_file(folder, 1500)
    _, more = _quoted_file(tmp_path, 6000)
    more = [("b" + d, n, z) for d, n, z in more]
    with open(folder / "r.csv", "w", encoding="utf-8", newline="") as out:  # more rows, the columns the other way round
        csv.writer(out, lineterminator="\r\n").writerows([("ZONA", "NOTA", "NO_DAMA"), *[w[::-1] for w in more]])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        rows = tables.read_csv_text(spark, str(folder)).select("NO_DAMA", "NOTA").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    assert sorted(r[0] for r in rows) == sorted(w[0] for w in [*wanted, *more])
    assert {r[0]: r[1] for r in rows if r[1] and r[1].strip()} == {w[0]: w[1] for w in [*wanted, *more] if w[1].strip()}


def test_quotes_that_cannot_be_counted(spark, tmp_path):
    (tmp_path / "a.csv").write_text('NO_DAMA,NOTA\n1,5" pipe\n2,fine\n', encoding="utf-8")  # an odd number: one task
    assert sorted(map(tuple, tables.read_csv_text(spark, str(tmp_path / "a.csv")).collect())) == [("1", '5" pipe'), ("2", "fine")]
    (tmp_path / "b.csv").write_text('NO_DAMA,NOTA\n1,5" pipe\n2,6" pipe\n', encoding="utf-8")
    with pytest.raises(Exception, match="not doubled"):
        tables.read_csv_text(spark, str(tmp_path / "b.csv")).collect()
    assert tables.read_csv_text(spark, str(tmp_path / "b.csv"), multi_line=True).count() == 2
    (tmp_path / "c.csv").write_bytes(b'NO_DAMA,NOTA\r1,"a\rb"\r2,c\r')
    assert sorted(r.NO_DAMA for r in tables.read_csv_text(spark, str(tmp_path / "c.csv")).collect()) == ["1", "2"]
    (tmp_path / "d.csv").write_text('"NO\nDAMA",ZONA\n1,"x\ny"\n', encoding="utf-8")  # a header of two lines
    assert [tuple(r) for r in tables.read_csv_text(spark, str(tmp_path / "d.csv")).collect()] == [("1", "x\ny")]
    (tmp_path / "e.csv").write_text("", encoding="utf-8")
    assert tables.read_csv_text(spark, str(tmp_path / "e.csv")).columns == []


def _jobs(spark, action):
    """The number of Spark jobs that an action runs."""
    group = f"jobs-{id(action)}"
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        action()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_headers_of_many_files_take_no_more_jobs(spark, tmp_path):
    for n in (4, 50):
        folder = tmp_path / str(n)
        folder.mkdir()
        for i in range(n):
            names = "NO_DAMA,ZONA" if i % 2 else "Zona,No. Dama"
            (folder / f"{i}.csv").write_text(f'{names}\n{i},"{i}"\n', encoding="utf-8")
    few = _jobs(spark, lambda: tables.read_csv_text(spark, str(tmp_path / "4")))
    many = _jobs(spark, lambda: tables.read_csv_text(spark, str(tmp_path / "50")))
    assert 0 < few <= many <= few + 6  # Spark lists more than 32 files by a job of its own
    found = tables.read_csv_text(spark, str(tmp_path / "50"))
    assert sorted(found.columns) == ["NO_DAMA", "ZONA"] and found.count() == 50


def test_header_names_as_the_reader_gives_them(spark, tmp_path):
    (tmp_path / "a.csv").write_text('A,,a,"b ""c"""\n1,2,3,4\n', encoding="utf-8")
    facts = quoted.file_facts(quoted.range_facts(spark, str(tmp_path / "a.csv")))
    assert [f.header for f in facts] == [tuple(spark.read.csv(str(tmp_path / "a.csv"), header=True, escape='"').columns)]


def test_rows_without_a_value_are_dropped(spark, tmp_path):
    folder = sample.write(tmp_path)
    path = tmp_path / "CLIENTES.csv"
    lines = path.read_text(encoding="utf-8").splitlines()
    before = tables.read_sources(spark, folder)[schemas.CLIENTS].count()
    path.write_text("\n".join([*lines, "," * lines[0].count(",")]) + "\n", encoding="utf-8")
    assert tables.read_sources(spark, folder)[schemas.CLIENTS].count() == before
    tables.read_csv_text(spark, str(path)).write.parquet(str(tmp_path / "p" / "CLIENTES.parquet"))
    assert tables.read_sources(spark, str(tmp_path / "p"), file_format="parquet")[schemas.CLIENTS].count() == before
