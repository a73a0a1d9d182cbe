"""The rules of each query in plain SQL, written apart from the Spark code and run by DuckDB."""

from __future__ import annotations

import re

from arrears_mart.registry.fixtures import FIXTURES, TABLES

RUN_DATE = "date '2001-08-01'"
RUN_TS = "timestamp '2001-08-01 06:00:00'"

_CTES: dict[str, str] = {name: sql.format(**{t: t for t in TABLES}) for name, sql in FIXTURES.items()}


def digits(x: str) -> str:
    return f"regexp_replace({x},'[^0-9]','','g')"


def campaign(x: str) -> str:
    d = digits(x)
    year = f"case when length({d})>=5 then left({d},length({d})-2) else cast((select y from ref) as varchar) end"
    return f"case when {d}<>'' then {year}||lpad(right({d},2),2,'0') end"


def text(x: str) -> str:
    return f"case when trim({x})<>'' then {x} end"


def words(*xs: str) -> str:
    return "trim(regexp_replace(concat_ws(' '," + ",".join(f"nullif(trim({x}),'')" for x in xs) + r"),'\s+',' ','g'))"


def parts(*xs: str) -> str:
    """Joined without touching the blanks inside a text."""
    return "concat_ws(' '," + ",".join(f"nullif(trim({x}),'')" for x in xs) + ")"


def rank(cte: str, keys: str, order: str) -> str:
    return f"select *, row_number() over (partition by {keys} order by {order}) as rn from {cte}"


def day_in_note(x: str) -> str:
    found = rf"regexp_extract({x},'\(\s*(\d{{1,2}}[/\-.]\d{{1,2}}[/\-.]\d{{2,4}})\s*\)',1)"
    slashed = f"replace(replace({found},'-','/'),'.','/')"
    long_year = rf"case when regexp_matches({slashed},'/\d{{4}}$') then cast(try_strptime({slashed},'%d/%m/%Y') as date) end"
    short_year = rf"case when regexp_matches({slashed},'/\d{{2}}$') then cast(try_strptime({slashed},'%d/%m/%y') as date) end"
    return f"coalesce({long_year},{short_year})"


def overdue_label(days: str) -> str:
    return (
        f"case when {days} is null then null when {days}<=30 then '0-30' when {days}<=60 then '31-60' "
        f"when {days}<=90 then '61-90' when {days}<=120 then '91-120' when {days}<=150 then '121-150' "
        f"when {days}<=180 then '151-180' else '181+' end"
    )


def overdue(day: str) -> str:
    return f"cast(date_diff('day',{day},{RUN_DATE}) as integer)"


def age(camp: str, newest: str) -> str:
    gap = f"({newest}-try_cast({digits(camp)} as bigint))"
    return (
        f"case when {gap}=0 then 'Inactivas' when {gap}=1 then 'Mora 1' when {gap}=2 then 'Mora 2' "
        f"when {gap}>=3 then 'Mora 3' end"
    )


CP_LABEL, NUM_LABEL, INT_LABEL = r"(?i)\bC\.?\s*P\.?\s*", r"(?i)\bNo\.?\s+", r"(?i)\bInt\.?\s+"


def address(x: str) -> str:
    t = f"trim(coalesce({x},''))"
    numbered = rf"regexp_matches({t},'{NUM_LABEL}\d')"

    def cut(value: str) -> str:
        labelled = rf"regexp_replace({value},'{CP_LABEL}\d{{5}}.*$','')"
        return rf"regexp_replace({labelled},'\b\d{{5}}\b.*$','')"

    rest = rf"regexp_replace({t},'(?i)^.*?\bNo\.?\s+\d\S*\s*','')"
    rest = rf"regexp_replace({rest},'{INT_LABEL}\S+\s*','','g')"
    street = rf"regexp_extract({t},'(?i)^(.*?)\s+No\.?\s+\d',1)"
    return (
        f"nullif(trim(case when {numbered} then {street} else {cut(t)} end),'') as A_CALLE, "
        rf"nullif(regexp_extract({t},'{NUM_LABEL}(\d\S*)',1),'') as A_NUMERO_EXTERIOR, "
        rf"nullif(regexp_extract({t},'{INT_LABEL}(\S+)',1),'') as A_NUMERO_INTERIOR, "
        f"nullif(trim(case when {numbered} then {cut(rest)} end),'') as A_COLONIA, "
        rf"coalesce(nullif(regexp_extract({t},'{CP_LABEL}(\d{{5}})\b',1),''),nullif(regexp_extract({t},'\b(\d{{5}})\b',1),'')) as A_CODIGO_POSTAL"
    )


PADDED = "case when length(trim(CODIGO_POSTAL))<5 then lpad(trim(CODIGO_POSTAL),5,'0') else trim(CODIGO_POSTAL) end"
_PORTFOLIO_COLUMNS = (
    "FECHA_FACTURA, FECHA_INICIAL_VIGENCIA, FECHA_FINAL_VIGENCIA, SEGMENTO, ESTADO_PROCESO, SALDO_DAMA, PAGOS_DAMA"
)
_SITUATION = "ID_SITUACION DESC_SITUACION ID_SITUACION_CIE DESC_SITUACION_CIE TIPO_NOMBRAMIENTO"
_CLOSING = "PRIMERA_ORDEN REACTIVACION CANCELACION GEOLOCALIZACION"


def of(alias: str, names: str) -> str:
    return ", ".join(f"{alias}.{n}" for n in names.split())


def filled(names: str) -> str:
    """The client's value, else the arrears row's."""
    return ", ".join(f"coalesce({text(f'c.{n}')}, {text(f'm.{n}')}) as {n}" for n in names.split())



_CTES |= {
    "ref": f"select max(cast(left(d,length(d)-2) as bigint)) as y from (select {digits('CAMPANA_SALDO')} as d from fx_cartera) t where length(d)>=5",
    "cart": f"select *, {campaign('CAMPANA_SALDO')} as CAMP from fx_cartera where trim(NO_DAMA)<>''",
    "cart_rn": rank("cart", "NO_DAMA", "FECHA_FACTURA desc nulls last, FECHA_FINAL_VIGENCIA desc nulls last, FECHA_CARGA desc nulls last, ORD"),
    "mora_n": f"select *, {campaign('CAMPANA_SALDO')} as CAMP from fx_mora where trim(NO_DAMA)<>''",
    "missing_rn": rank(
        "(select * from mora_n m where CAMP is not null and not exists (select 1 from cart_rn c where c.rn=1 "
        "and c.NO_DAMA=m.NO_DAMA and coalesce(right(c.CAMP,2),'')=right(m.CAMP,2)))",
        "NO_DAMA, right(CAMP,2)",
        "ORD",
    ),
    "acc": f"select NO_DAMA, ID_COBRADOR as COB, ZONA, CAMP as CAMPANA_SALDO, {_PORTFOLIO_COLUMNS}, '' as CARTERA_MORAS, "
    "FECHA_CARGA from cart_rn where rn=1 "
    "union all select NO_DAMA, null, ZONA, CAMP, null, null, null, null, null, null, null, 'NUEVA', "
    f"{RUN_TS} from missing_rn where rn=1",
    "mora_rn": rank("fx_mora", "NO_DAMA", "ORD"),
    "mora1": f"select *, {address('DOMICILIO')} from mora_rn where rn=1",
    "calls": f"select *, coalesce(cast({day_in_note('COMENTARIO')} as timestamp),FECHA_GESTION) as LLAMADA from fx_arabela",
    "calls_rn": rank("calls", "NO_DAMA", "LLAMADA desc nulls last, ORD"),
    "calls_n": "select NO_DAMA, count(*) as N, max(LLAMADA) as ULT from calls group by NO_DAMA",
    "sal_rn": rank(
        f"(select *, right({campaign('CAMPANA_SALDO')},2) as C2 from fx_saldos)", "NO_DAMA, C2", "ORD"
    ),
    "cp_rn": rank(f"(select {PADDED} as CODIGO, POBLACION, ESTADO, ORD from fx_cp)", "CODIGO", "ORD"),
    "newest": f"select max(try_cast({digits('CAMPANA_SALDO')} as bigint)) as n from acc",
    "filled": f"""select z.REGION, z.DIVISION, a.ZONA, z.RUTA, z.ID_COBRADOR as ZCOB, a.COB, a.NO_DAMA,
 {filled('DIGITO_DAMA POBLACION ESTADO TELEFONO_CASA TELEFONO_CELULAR')},
 coalesce(nullif({words('c.NOMBRE', 'c.APELLIDO_PATERNO', 'c.APELLIDO_MATERNO')},''), {text('m.NOMBRE')}) as NOMBRE_COMPLETO,
 coalesce({text('c.CALLE')}, m.A_CALLE) as CALLE,
 coalesce({text('c.NUMERO_EXTERIOR')}, m.A_NUMERO_EXTERIOR) as NUMERO_EXTERIOR,
 coalesce({text('c.NUMERO_INTERIOR')}, m.A_NUMERO_INTERIOR) as NUMERO_INTERIOR, m.DOMICILIO,
 coalesce({text('c.COLONIA')}, {text('m.COLONIA')}, m.A_COLONIA) as COLONIA,
 coalesce({text('c.CODIGO_POSTAL')}, {text('m.CODIGO_POSTAL')}, m.A_CODIGO_POSTAL) as CODIGO_POSTAL,
 a.CAMPANA_SALDO, a.FECHA_FACTURA, a.FECHA_INICIAL_VIGENCIA, a.FECHA_FINAL_VIGENCIA,
 coalesce({text('a.SEGMENTO')}, {text('m.SEGMENTO')}) as SEGMENTO,
 coalesce({text('a.ESTADO_PROCESO')}, {text('m.ESTADO_PROCESO')}) as ESTADO_PROCESO, {of('m', _SITUATION)}, {of('m', _CLOSING)},
 l.MOTIVO_NO_COBRO, l.DICTAMINACION, l.FECHA_PROMESA, coalesce(a.SALDO_DAMA, m.SALDO_DAMA) as DEUDA, a.PAGOS_DAMA as PAGADO,
 s.SALDO_ACTUALIZADO as S, {age('a.CAMPANA_SALDO', '(select n from newest)')} as TEMPORALIDAD,
 {overdue('a.FECHA_FACTURA')} as DIAS_MORA, l.STATUS_GESTION, l.COMENTARIO, cast(n.ULT as date) as FECHA_ULTIMA_LLAMADA,
 coalesce(n.N,0) as NUMERO_GESTIONES, m.PRECIERRE_1, m.PRECIERRE_2, a.CARTERA_MORAS, a.FECHA_CARGA
 from acc a left join fx_clientes c on c.NO_DAMA=a.NO_DAMA left join fx_zonas z on z.ZONA=a.ZONA
 left join mora1 m on m.NO_DAMA=a.NO_DAMA left join calls_rn l on l.NO_DAMA=a.NO_DAMA and l.rn=1
 left join calls_n n on n.NO_DAMA=a.NO_DAMA
 left join sal_rn s on s.NO_DAMA=a.NO_DAMA and s.C2=right(a.CAMPANA_SALDO,2) and s.rn=1""",
    "restated": f"""select f.*,
 cast(case when S is null then greatest(coalesce(DEUDA,0)-coalesce(PAGADO,0),0) else greatest(S,0) end as decimal(18,2)) as SALDO,
 cast(case when S is null then coalesce(PAGADO,0) else greatest(coalesce(DEUDA,0)-greatest(S,0),0) end as decimal(18,2)) as PAGOS,
 case when TEMPORALIDAD='Inactivas' then coalesce({text('COB')},{text('ZCOB')}) else coalesce({text('ZCOB')},{text('COB')}) end as ID_COBRADOR,
 p.POBLACION as CP_POBLACION, p.ESTADO as CP_ESTADO, coalesce(S<0,false) as SOBREPAGO
 from filled f left join cp_rn p on p.rn=1 and length({digits('f.CODIGO_POSTAL')})>=5 and p.CODIGO=right({digits('f.CODIGO_POSTAL')},5)""",
    "enriched": f"""select REGION, DIVISION, ZONA, RUTA, ID_COBRADOR, NO_DAMA, DIGITO_DAMA, NOMBRE_COMPLETO, CALLE, NUMERO_EXTERIOR,
 NUMERO_INTERIOR, coalesce(nullif({words('CALLE', 'NUMERO_EXTERIOR', 'NUMERO_INTERIOR')},''), {text('DOMICILIO')}) as DIRECCION_COMPLETA,
 COLONIA, CODIGO_POSTAL, coalesce(POBLACION, CP_POBLACION) as POBLACION, coalesce(ESTADO, CP_ESTADO) as ESTADO,
 TELEFONO_CASA, TELEFONO_CELULAR, CAMPANA_SALDO, FECHA_FACTURA,
 FECHA_INICIAL_VIGENCIA, FECHA_FINAL_VIGENCIA, SEGMENTO, ESTADO_PROCESO, DEUDA as SALDO_DAMA, PAGOS as PAGOS_DAMA,
 SALDO as SALDO_ACTUALIZADO, TEMPORALIDAD, DIAS_MORA, {', '.join(_SITUATION.split())}, {', '.join(_CLOSING.split())},
 MOTIVO_NO_COBRO, DICTAMINACION, STATUS_GESTION, COMENTARIO, FECHA_ULTIMA_LLAMADA,
 NUMERO_GESTIONES, FECHA_PROMESA, coalesce(nullif(trim(PRECIERRE_2),''),nullif(trim(PRECIERRE_1),'')) as PRECIERRE,
 PRECIERRE_1, PRECIERRE_2, NO_DAMA||'-'||right(CAMPANA_SALDO,2) as LLAVE_DAMA_CAMPANA, CARTERA_MORAS, FECHA_CARGA,
 {RUN_TS} as FECHA_ACTUALIZACION, SOBREPAGO,
 case when FECHA_FINAL_VIGENCIA is null or FECHA_FINAL_VIGENCIA>={RUN_DATE} then false
  when TEMPORALIDAD='Mora 1' and PAGOS<=0 then false else true end as EXCLUIDA from restated""",
    "m1": "select * exclude (SOBREPAGO, EXCLUIDA) from enriched where not EXCLUIDA",
}


def audit(step: str, motive: str, level: str, detail: str, source: str, camp: str = "CAMPANA_SALDO") -> str:
    return (
        f"select '{step}' as PASO, '{motive}' as MOTIVO, '{level}' as NIVEL, NO_DAMA, {camp} as CAMPANA_SALDO, ZONA, "
        f"{detail} as DETALLE from {source}"
    )


DUPLICATE = audit(
    "PASO1_TMP_CARTERA",
    "NO_DAMA_DUPLICADO",
    "RECHAZO",
    "'Registro duplicado descartado; se conservo el mas reciente.'",
    "cart_rn where rn>1",
    "CAMP",
)
EXPIRED = audit(
    "DEPURACION",
    "VIGENCIA_VENCIDA",
    "EXCLUIDO",
    "'FECHA_FINAL_VIGENCIA vencida; cuenta fuera de la cartera activa.'",
    "enriched where EXCLUIDA",
)
UNASSIGNED = "'La zona no tiene cobrador asignado en ZONAS_ASIGNADAS.'"
NO_COLLECTOR = audit(
    "VALIDACIONES",
    "ZONA_SIN_COBRADOR",
    "ADVERTENCIA",
    UNASSIGNED,
    "enriched where not EXCLUIDA and coalesce(trim(ID_COBRADOR),'')=''",
)
OVERPAID = audit(
    "VALIDACIONES",
    "CUENTA_LIQUIDADA_SOBREPAGO",
    "ADVERTENCIA",
    "'Pago mayor al adeudo; deuda liquidada, saldo mostrado como 0.'",
    "enriched where not EXCLUIDA and SOBREPAGO",
)
DAYS_DUPLICATE = audit(
    "PASO1_TMP_CARTERA",
    "NO_DAMA_DUPLICADO",
    "RECHAZO",
    "'Registro duplicado descartado; se conservo el mas reciente por NO_DAMA.'",
    "cart_rn where rn>1",
)
DAYS_NO_COLLECTOR = audit(
    "VALIDACIONES", "ZONA_SIN_COBRADOR", "ADVERTENCIA", UNASSIGNED, "m2 where coalesce(trim(ID_COBRADOR),'')=''"
)
NEGATIVE = audit(
    "VALIDACIONES",
    "SALDO_NEGATIVO",
    "ADVERTENCIA",
    "'SALDO_FINAL negativo = '||cast(SALDO_FINAL as varchar)",
    "m2 where SALDO_FINAL<0",
)

_CTES |= {
    "m1_audit": " union all ".join([DUPLICATE, EXPIRED, NO_COLLECTOR, OVERPAID]),
    "contacts_rn": rank("fx_arabela", "NO_DAMA", "FECHA_GESTION desc nulls last, ORD"),
    "contacts_n": "select NO_DAMA, count(*) as N from fx_arabela group by NO_DAMA",
    "exact_rn": rank("fx_saldos", "NO_DAMA, CAMPANA_SALDO", "ORD"),
    "m2": f"""select z.REGION, z.DIVISION, t.ZONA, z.RUTA, z.ID_COBRADOR, t.NO_DAMA, c.DIGITO_DAMA,
 {parts('c.NOMBRE', 'c.APELLIDO_PATERNO', 'c.APELLIDO_MATERNO')} as NOMBRE_COMPLETO,
 {parts('c.CALLE', 'c.NUMERO_EXTERIOR', 'c.NUMERO_INTERIOR')} as DIRECCION_COMPLETA, c.COLONIA, c.CODIGO_POSTAL,
 c.POBLACION, c.ESTADO, c.TELEFONO_CASA, c.TELEFONO_CELULAR, t.CAMPANA_SALDO, t.FECHA_FACTURA, t.FECHA_INICIAL_VIGENCIA,
 t.FECHA_FINAL_VIGENCIA, t.SEGMENTO, t.ESTADO_PROCESO, t.SALDO_DAMA, t.PAGOS_DAMA, s.SALDO_ACTUALIZADO,
 cast(coalesce(t.SALDO_DAMA,0)-coalesce(t.PAGOS_DAMA,0) as decimal(18,2)) as SALDO_FINAL,
 {overdue_label(overdue('t.FECHA_FACTURA'))} as TEMPORALIDAD, {overdue('t.FECHA_FACTURA')} as DIAS_MORA,
 {of('m', _SITUATION)}, {of('m', _CLOSING)}, l.MOTIVO_NO_COBRO, l.DICTAMINACION, l.STATUS_GESTION,
 coalesce(n.N,0) as NUMERO_GESTIONES, l.FECHA_PROMESA,
 coalesce(nullif(trim(m.PRECIERRE_2),''),nullif(trim(m.PRECIERRE_1),'')) as PRECIERRE, m.PRECIERRE_1, m.PRECIERRE_2,
 t.FECHA_CARGA, {RUN_TS} as FECHA_ACTUALIZACION
 from cart_rn t left join fx_clientes c on c.NO_DAMA=t.NO_DAMA left join fx_zonas z on z.ZONA=t.ZONA
 left join mora_rn m on m.NO_DAMA=t.NO_DAMA and m.rn=1 left join contacts_rn l on l.NO_DAMA=t.NO_DAMA and l.rn=1
 left join contacts_n n on n.NO_DAMA=t.NO_DAMA
 left join exact_rn s on s.NO_DAMA=t.NO_DAMA and s.CAMPANA_SALDO=t.CAMPANA_SALDO and s.rn=1 where t.rn=1""",
    "m2_audit": " union all ".join([DAYS_DUPLICATE, DAYS_NO_COLLECTOR, NEGATIVE]),
}


def sql(select: str) -> str:
    """`select` with the common table expressions it needs, in dependency order."""
    needed: dict[str, None] = {}

    def visit(fragment: str) -> None:
        for name in _CTES:
            if name not in needed and re.search(rf"\b{name}\b", fragment):
                visit(_CTES[name])
                needed[name] = None

    visit(select)
    parts = ",\n".join(f"{name} as ({_CTES[name]})" for name in needed)
    return f"with {parts}\n{select}" if parts else select
