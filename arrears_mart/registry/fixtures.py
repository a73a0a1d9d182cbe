"""Source frames derived from the test tables, as SQL that Spark and DuckDB both run.

`ORD` is the file order of a row. `{orders}` and the like stand for the test tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from arrears_mart.schemas import ARREARS, BALANCES, CLIENTS, CONTACTS, PORTFOLIO, ZONES

RUN_TS = dt.datetime(2001, 8, 1, 6, 0, 0)
ARRIVAL = "ORD"

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

FIXTURES: dict[str, str] = {
    "fx_cartera": """
select lpad(cast(o_custkey as string),7,'0') as NO_DAMA,
 case when o_orderkey%3=0 then concat('CB-',cast(o_orderkey%17 as string)) end as ID_COBRADOR,
 case when o_orderkey%23<>0 then concat('Z',lpad(cast(c_nationkey as string),2,'0')) end as ZONA,
 case when o_orderkey%10=0 and year(o_orderdate)=2001 then cast(month(o_orderdate) as string)
  else concat('C',cast(year(o_orderdate) as string),'-',lpad(cast(month(o_orderdate) as string),2,'0')) end as CAMPANA_SALDO,
 cast(o_orderdate as date) as FECHA_FACTURA, cast(o_orderdate as date) as FECHA_INICIAL_VIGENCIA,
 case when o_orderkey%7<>0 then cast(o_orderdate + interval '20' day as date) end as FECHA_FINAL_VIGENCIA,
 c_mktsegment as SEGMENTO, o_orderstatus as ESTADO_PROCESO, cast(o_totalprice as decimal(18,2)) as SALDO_DAMA,
 cast(case o_orderkey%4 when 0 then 0 when 1 then 100 when 2 then cast(o_totalprice as decimal(18,2))+50
  else cast(o_totalprice as decimal(18,2))-10 end as decimal(18,2)) as PAGOS_DAMA,
 case when o_orderkey%5<>0 then cast(cast(o_orderdate as date) + interval '40' day as timestamp) end as FECHA_CARGA,
 o_orderkey as ORD from {orders} join {customer} on o_custkey=c_custkey""",
    # A ninth of the clients has a key that no account has.
    "fx_clientes": """
select case when c_custkey%9=0 then concat('X',lpad(cast(c_custkey as string),6,'0'))
  else lpad(cast(c_custkey as string),7,'0') end as NO_DAMA,
 case when c_custkey%7<>0 then cast(c_custkey%10 as string) end as DIGITO_DAMA, c_name as NOMBRE,
 c_mktsegment as APELLIDO_PATERNO,
 case when c_custkey%4=0 then '  ' else concat('M',cast(c_custkey%50 as string)) end as APELLIDO_MATERNO,
 case when c_custkey%5<>0 then concat('Calle ',cast(c_custkey%90 as string)) end as CALLE,
 case when c_custkey%5<>0 then cast(c_custkey%300 as string) end as NUMERO_EXTERIOR,
 case when c_custkey%8=0 then 'B' end as NUMERO_INTERIOR,
 case when c_custkey%3=0 then concat('Colonia ',cast(c_custkey%40 as string)) when c_custkey%3=1 then ' ' end as COLONIA,
 case when c_custkey%6<>0 then lpad(cast(c_custkey as string),5,'0') end as CODIGO_POSTAL,
 case when c_custkey%4=1 then concat('Villa ',cast(c_custkey%30 as string)) when c_custkey%4=2 then '' end as POBLACION,
 case when c_custkey%5=1 then concat('Estado ',cast(c_custkey%20 as string)) end as ESTADO,
 case when c_custkey%3<>1 then concat('55',cast(c_custkey as string)) end as TELEFONO_CASA,
 case when c_custkey%4<>0 then concat('33',cast(c_custkey as string)) end as TELEFONO_CELULAR
 from {customer}""",
    # The last nations' zones have a name that no account has.
    "fx_zonas": """
select concat(case when n_nationkey<22 then 'Z' else 'Y' end,lpad(cast(n_nationkey as string),2,'0')) as ZONA, r_name as REGION,
 concat('DIV-',cast(n_nationkey%4 as string)) as DIVISION, concat('RUTA-',cast(n_nationkey%7 as string)) as RUTA,
 k as ID_COBRADOR
 from {nation} join {region} on n_regionkey=r_regionkey
 left join (select s_nationkey, concat('COB-',cast(min(s_suppkey) as string)) as k from {supplier} group by s_nationkey) s
  on s_nationkey=n_nationkey""",
    # A row for each order: the account's own arrears, accounts that only arrears have, and rows without a key.
    "fx_mora": """
select case when o_orderkey%6=1 and year(o_orderdate)=2001 and o_orderkey%60<>1 then lpad(cast(o_custkey as string),7,'0')
  when o_orderkey%6=1 and year(o_orderdate)=2001 then concat('N',lpad(cast(o_custkey as string),6,'0'))
  when o_orderkey%10=3 then concat('M',lpad(cast(o_custkey as string),6,'0')) when o_orderkey%2=0 then ' ' end as NO_DAMA,
 concat(cast(year(o_orderdate) as string),lpad(cast(month(o_orderdate) as string),2,'0')) as CAMPANA_SALDO,
 concat('Z',lpad(cast(o_custkey%25 as string),2,'0')) as ZONA, concat('Titular ',cast(o_custkey as string)) as NOMBRE,
 cast(o_totalprice as decimal(18,2)) as SALDO_DAMA,
 case o_orderkey%5
  when 0 then concat('LOMA SUR No ',cast(o_orderkey%99+1 as string),' Int c FRACC GALAXIA CP ',lpad(cast(o_orderkey%99999 as string),5,'0'))
  when 1 then concat('Av Sol no. ',cast(o_orderkey%50+1 as string),'-A COL REAL C.P. ',lpad(cast(o_orderkey%99999 as string),5,'0'))
  when 2 then concat('PRIVADA LUNA S/N ',lpad(cast(o_orderkey%99999 as string),5,'0'),' CENTRO')
  when 3 then 'SIN NUMERO' end as DOMICILIO,
 case when o_orderkey%4=1 then concat('PC1-',cast(o_orderkey as string)) end as PRECIERRE_1,
 case when o_orderkey%3=0 then concat('PC2-',cast(o_orderkey as string)) when o_orderkey%3=1 then ' ' end as PRECIERRE_2,
 case when o_orderkey%4<>2 then cast(o_orderkey%10 as string) end as DIGITO_DAMA,
 case when o_orderkey%5<>1 then concat('SEG-',cast(o_orderkey%3 as string)) end as SEGMENTO,
 case when o_orderkey%7<>1 then concat('EST-',cast(o_orderkey%4 as string)) else ' ' end as ESTADO_PROCESO,
 case when o_orderkey%4=3 then concat('Barrio ',cast(o_orderkey%9 as string)) when o_orderkey%4=1 then ' ' end as COLONIA,
 case when o_orderkey%8=1 then lpad(cast(o_orderkey%99999 as string),5,'0') end as CODIGO_POSTAL,
 case when o_orderkey%9=1 then concat('Pueblo ',cast(o_orderkey%9 as string)) end as POBLACION,
 case when o_orderkey%9<4 then concat('Edo ',cast(o_orderkey%9 as string)) end as ESTADO,
 case when o_orderkey%5<3 then concat('81',cast(o_orderkey as string)) else '' end as TELEFONO_CASA,
 case when o_orderkey%5>1 then concat('82',cast(o_orderkey as string)) end as TELEFONO_CELULAR,
 case when o_orderkey%7<5 then concat('S',cast(o_orderkey%7 as string)) end as ID_SITUACION,
 case when o_orderkey%7<4 then concat('SITUACION ',cast(o_orderkey%7 as string)) end as DESC_SITUACION,
 case when o_orderkey%8<5 then concat('C',cast(o_orderkey%8 as string)) end as ID_SITUACION_CIE,
 case when o_orderkey%8<4 then concat('CIERRE ',cast(o_orderkey%8 as string)) end as DESC_SITUACION_CIE,
 case when o_orderkey%3<2 then 'TITULAR' end as TIPO_NOMBRAMIENTO,
 case when o_orderkey%9<6 then concat(cast(o_orderkey%90 as string),'.5,-99.1') end as GEOLOCALIZACION,
 case when o_orderkey%11<7 then concat('REA-',cast(o_orderkey as string)) end as REACTIVACION,
 case when o_orderkey%13<6 then concat('CAN-',cast(o_orderkey as string)) end as CANCELACION,
 case when o_orderkey%10<8 then concat('ORD-',cast(o_orderkey as string)) end as PRIMERA_ORDEN,
 o_orderkey as ORD from {orders}""",
    "fx_arabela": """
select lpad(cast(user_id as string),7,'0') as NO_DAMA, ts as FECHA_GESTION, event_type as STATUS_GESTION,
 case when event_id%3=0 then concat(cast(event_id as string),' (',cast(day(ts) as string),
   case event_id%2 when 0 then '-' else '.' end,cast(month(ts) as string),
   case event_id%2 when 0 then '-' else '.' end,cast(year(ts) as string),') NO CONTESTAN')
  when event_id%3=1 then 'sin fecha (n/a)' end as COMENTARIO,
 case when event_id%4=1 then 'NO PAGA' end as MOTIVO_NO_COBRO, case when event_id%5=2 then 'SEGUIMIENTO' end as DICTAMINACION,
 case when event_id%3<2 then cast(cast(ts as date) + interval '9' day as date) end as FECHA_PROMESA,
 event_id as ORD from {events}""",
    # Odd and older orders have a key that no account has.
    "fx_saldos": """
select case when o_orderkey%2=0 and year(o_orderdate)>=2000 then lpad(cast(o_custkey as string),7,'0')
  else concat('S',lpad(cast(o_custkey as string),6,'0')) end as NO_DAMA,
 concat(cast(year(o_orderdate) as string),lpad(cast(month(o_orderdate) as string),2,'0')) as CAMPANA_SALDO,
 cast(case o_orderkey%8 when 0 then -5 when 2 then 0 when 4 then cast(o_totalprice as decimal(18,2)) else 250 end
  as decimal(18,2)) as SALDO_ACTUALIZADO,
 o_orderkey as ORD from {orders}""",
    # Codes repeat every 50 suppliers and some have fewer than five characters.
    "fx_cp": """
select cast((s_suppkey%50)*13 as string) as CODIGO_POSTAL, s_name as POBLACION, n_name as ESTADO, s_suppkey as ORD
 from {supplier} join {nation} on s_nationkey=n_nationkey""",
    # Messy text of every kind the column functions clean.
    "fx_messy": """
select o_orderkey as ORD,
 concat(' ',cast(o_custkey as string),case o_orderkey%3 when 0 then '.0 ' when 1 then '.000' else '' end) as LLAVE,
 case o_orderkey%5 when 0 then '   ' when 1 then concat('  Av  ',cast(o_orderkey%7 as string)) when 2 then ''
  when 3 then o_orderpriority end as T1,
 case o_orderkey%4 when 0 then ' ' when 1 then '  B  2 ' when 2 then o_orderstatus end as T2,
 case o_orderkey%7 when 0 then '9' when 1 then '13' when 2 then concat('C',cast(year(o_orderdate) as string),'-05')
  when 3 then 'CAMPANA 13' when 4 then 'abc' when 5 then cast(year(o_orderdate) as string) end as CAMP,
 case o_orderkey%4 when 0 then concat(' ',cast(o_orderkey%9000 as string),'.50 ') when 1 then 'n/d'
  when 2 then concat('-',cast(o_orderkey%90 as string)) end as MONTO,
 case o_orderkey%6
  when 0 then concat(cast(year(o_orderdate) as string),'-',lpad(cast(month(o_orderdate) as string),2,'0'),'-',lpad(cast(day(o_orderdate) as string),2,'0'))
  when 1 then concat(cast(day(o_orderdate) as string),'/',cast(month(o_orderdate) as string),'/',cast(year(o_orderdate) as string))
  when 2 then '2001-02-30' when 3 then 'sin fecha'
  when 4 then concat(cast(year(o_orderdate) as string),'-',lpad(cast(month(o_orderdate) as string),2,'0'),'-',lpad(cast(day(o_orderdate) as string),2,'0'),' 09:30')
  end as FECHA,
 case o_orderkey%5 when 0 then concat('CP ',lpad(cast(o_orderkey%99999 as string),5,'0')) when 1 then cast(o_orderkey%999 as string)
  when 2 then concat('06',lpad(cast(o_orderkey%99999 as string),5,'0')) when 3 then 's/n' end as CP,
 case o_orderkey%5 when 0 then concat('llamada (',cast(day(o_orderdate) as string),'/',cast(month(o_orderdate) as string),'/',substr(cast(year(o_orderdate) as string),3,2),')')
  when 1 then concat('x ( ',cast(day(o_orderdate) as string),'.',cast(month(o_orderdate) as string),'.',cast(year(o_orderdate) as string),' ) y (1/1/1999)')
  when 2 then '(31/2/2001)' when 3 then '(5-5-201)' end as NOTA,
 cast(o_orderdate as date) as DIA, o_orderpriority as PRIORIDAD
 from {orders}""",
    # One run per order year, and audit rows of those runs.
    "fx_runs": """
select cast(year(o_orderdate) as bigint) as ID_EJECUCION,
 case when year(o_orderdate)%3=0 then 'ERROR' else 'EXITO' end as ESTATUS, count(*) as REG_PROCESADOS
 from {orders} group by year(o_orderdate)""",
    "fx_audit": """
select cast(year(o_orderdate) as bigint) as ID_EJECUCION,
 case o_orderkey%3 when 0 then 'ZONA_SIN_COBRADOR' when 1 then 'SALDO_NEGATIVO' else 'NO_DAMA_DUPLICADO' end as MOTIVO,
 case when o_orderkey%3=2 then 'RECHAZO' else 'ADVERTENCIA' end as NIVEL,
 lpad(cast(o_custkey as string),7,'0') as NO_DAMA, o_orderkey as ORD from {orders}""",
}
_SOURCE_FIXTURES = {
    PORTFOLIO: "fx_cartera",
    CLIENTS: "fx_clientes",
    ZONES: "fx_zonas",
    ARREARS: "fx_mora",
    CONTACTS: "fx_arabela",
    BALANCES: "fx_saldos",
}


_schemas: dict[str, T.StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A test table; its schema is inferred once per path."""
    path = f"{folder.rstrip('/')}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def fixtures(spark: SparkSession, folder: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """Frames for `names`; each test table they need is opened once."""
    needed = [t for t in TABLES if any(f"{{{t}}}" in FIXTURES[n] for n in names)]
    tables = {t: table(spark, folder, t) for t in needed}
    return {n: spark.sql(FIXTURES[n], **{t: df for t, df in tables.items() if f"{{{t}}}" in FIXTURES[n]}) for n in names}


def fixture(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return fixtures(spark, folder, [name])[name]


def fixture_sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    frames = fixtures(spark, folder, list(_SOURCE_FIXTURES.values()))
    return {source: frames[name] for source, name in _SOURCE_FIXTURES.items()}


def fixture_postal_codes(spark: SparkSession, folder: str) -> DataFrame:
    return fixture(spark, folder, "fx_cp")
