"""Joins that add client, zone, arrears, contact and balance data to the accounts."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from arrears_mart.functions.addresses import pad_postal_code, postal_code
from arrears_mart.functions.campaigns import campaign_last2, campaign_number
from arrears_mart.functions.dates import call_clock
from arrears_mart.functions.text import first_present, has_text, strip
from arrears_mart.operators.lookups import BROADCAST_BYTES, lookup_join
from arrears_mart.operators.unique import first_per_key, latest_row_per_key, ranked_row
from arrears_mart.schemas import ARREARS, CLIENTS, CLOCK, POSTAL_SCHEMA, ZONES, columns_of

Shape = Callable[[dict[str, Column]], dict[str, Column]]
LAST_CONTACT = ("STATUS_GESTION", "MOTIVO_NO_COBRO", "DICTAMINACION", "COMENTARIO", "FECHA_PROMESA")


def keyed(df: DataFrame, key: str = "NO_DAMA") -> DataFrame:
    """Rows with a usable key, the key without outer whitespace.

    `coalesce` tells the optimiser that the key is never null. Otherwise a join adds a null check for one reader of
    the rows only, and just readers with the same plan share one shuffle.
    """
    return df.filter(has_text(F.col(key))).withColumn(key, F.coalesce(strip(F.col(key)), F.lit("")))


def arrival_in(df: DataFrame, arrival: str | None) -> str | None:
    return arrival if arrival in df.columns else None


def _others(source: str, key: str) -> list[str]:
    return [c for c in columns_of(source) if c != key]


def _reshaped(unique: DataFrame, name: str, shape: Shape | None) -> DataFrame:
    """The struct `name` with the fields a build wants, worked out once per kept row and before the join."""
    if shape is None:
        return unique
    row = {f.name: F.col(f"{name}.{f.name}") for f in unique.schema[name].dataType}
    return unique.withColumn(name, F.struct(*[c.alias(n) for n, c in shape(row).items()]))


def join_clients(
    df: DataFrame, clients: DataFrame, arrival: str | None = None, shape: Shape | None = None
) -> DataFrame:
    """The client of the account, as struct `CLI`."""
    columns = _others(CLIENTS, "NO_DAMA")
    unique = latest_row_per_key(keyed(clients), ["NO_DAMA"], (), columns, arrival_in(clients, arrival), "CLI")
    return df.join(_reshaped(unique, "CLI", shape), "NO_DAMA", "left")


def join_zones(
    df: DataFrame, zones: DataFrame, arrival: str | None = None, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Region, division, route and collector of the zone, as struct `ZON`; no zone matches nothing."""
    usable = zones.filter(F.col("ZONA").isNotNull())
    unique = latest_row_per_key(usable, ["ZONA"], (), _others(ZONES, "ZONA"), arrival_in(zones, arrival), "ZON")
    return lookup_join(df, unique, "ZONA", "NO_DAMA", broadcast_bytes, measure=usable)


def join_arrears(
    df: DataFrame, arrears: DataFrame, arrival: str | None = None, shape: Shape | None = None
) -> DataFrame:
    """The first arrears row of the account, whatever its campaign, as struct `MORA`."""
    columns = _others(ARREARS, "NO_DAMA")
    unique = latest_row_per_key(keyed(arrears), ["NO_DAMA"], (), columns, arrival_in(arrears, arrival), "MORA")
    return df.join(_reshaped(unique, "MORA", shape), "NO_DAMA", "left")


def contact_summary(
    contacts: DataFrame, by_comment_date: bool, arrival: str | None = None, columns: Sequence[str] = LAST_CONTACT
) -> DataFrame:
    """One row per account: the latest contact, with the time of the call, as struct `GES`, and how many there are."""
    when = F.col("FECHA_GESTION").cast(CLOCK)
    if by_comment_date:
        when = call_clock(F.col("COMENTARIO"), when)
    dated = keyed(contacts).withColumn("FECHA_ULTIMA_LLAMADA", when)
    row = ranked_row(["FECHA_ULTIMA_LLAMADA"], columns, arrival_in(contacts, arrival))
    ranked = dated.select("NO_DAMA", row.alias("_row"))
    return ranked.groupBy("NO_DAMA").agg(F.max("_row").alias("GES"), F.count("_row").alias("NUMERO_GESTIONES"))


def join_contacts(
    df: DataFrame, contacts: DataFrame, by_comment_date: bool, arrival: str | None = None
) -> DataFrame:
    """Latest contact and contact count in one join; no contact counts as zero."""
    joined = df.join(contact_summary(contacts, by_comment_date, arrival), "NO_DAMA", "left")
    return joined.withColumn("NUMERO_GESTIONES", F.coalesce("NUMERO_GESTIONES", F.lit(0)))


def master_with_contacts(master: DataFrame, contacts: DataFrame) -> DataFrame:
    """Per account of a master its rows, and how many contacts it has had (null: none)."""
    made = keyed(contacts).groupBy("NO_DAMA").agg(F.count(F.lit(1)).alias("GESTIONES"))
    accounts = master.groupBy("NO_DAMA").agg(F.count(F.lit(1)).alias("FILAS"))
    return accounts.join(made, "NO_DAMA", "left").select("NO_DAMA", "FILAS", "GESTIONES")


def balances_by_account(balances: DataFrame, arrival: str | None = None) -> DataFrame:
    """One row per account with a map from the last two campaign digits to the reported balance.

    The map has at most 111 entries, as many as there are values of two digits or fewer.
    """
    coded = keyed(balances).withColumn("_c2", campaign_last2(F.col("CAMPANA_SALDO")))
    unique = first_per_key(coded, ["NO_DAMA", "_c2"], ["SALDO_ACTUALIZADO"], arrival_in(balances, arrival))
    entries = F.collect_list(F.struct("_c2", "SALDO_ACTUALIZADO"))
    return unique.groupBy("NO_DAMA").agg(F.map_from_entries(entries).alias("_reported"))


def join_balance_by_campaign_digits(df: DataFrame, balances: DataFrame, arrival: str | None = None) -> DataFrame:
    """Reported balance of (account, last two campaign digits), as `S`.

    Joining on the account alone keeps the partitioning the other account joins use.
    """
    joined = df.join(balances_by_account(balances, arrival), "NO_DAMA", "left")
    reported = F.try_element_at("_reported", campaign_last2(F.col("CAMPANA_SALDO")))
    return joined.withColumn("S", reported).drop("_reported")


def join_balance_by_campaign(df: DataFrame, balances: DataFrame, arrival: str | None = None) -> DataFrame:
    """`SALDO_ACTUALIZADO` of the same account and the same campaign text."""
    keys = ["NO_DAMA", "CAMPANA_SALDO"]
    usable = keyed(balances).filter(F.col("CAMPANA_SALDO").isNotNull())
    unique = first_per_key(usable, keys, ["SALDO_ACTUALIZADO"], arrival_in(balances, arrival))
    return df.join(unique, keys, "left")


def accounts_only_in_arrears(accounts: DataFrame, arrears: DataFrame, arrival: str | None = None) -> DataFrame:
    """First arrears row of each (account, last two campaign digits) the accounts do not have yet.

    Campaigns are in their normal form, where a missing one is null.

    Arrears rows are made unique before the anti join, so copies of one row never meet in one task.
    """
    pair = ["NO_DAMA", "_c2"]
    coded = keyed(arrears).withColumn("_c2", campaign_last2(F.col("CAMPANA_SALDO"))).filter("_c2 != ''")
    unique = first_per_key(coded, pair, ["ZONA", "CAMPANA_SALDO"], arrival_in(arrears, arrival))
    known = accounts.select("NO_DAMA", campaign_last2(F.col("CAMPANA_SALDO")).alias("_c2"))
    return unique.join(known, pair, "left_anti").select("NO_DAMA", "ZONA", "CAMPANA_SALDO")


def append_new_accounts(accounts: DataFrame, extras: DataFrame, loaded: Column) -> DataFrame:
    """Accounts plus those only in arrears, the latter marked and loaded at run time, other columns null."""
    marked = accounts.withColumn("CARTERA_MORAS", F.lit(""))
    new = extras.select("*", F.lit("NUEVA").alias("CARTERA_MORAS"), loaded.alias("FECHA_CARGA"))
    return marked.unionByName(new, allowMissingColumns=True)


def postal_catalogue(rows: DataFrame, arrival: str | None = None) -> DataFrame:
    """Postal code, town and state, codes padded to five characters and each listed once."""
    coded = rows.withColumn("CODIGO_POSTAL", pad_postal_code(F.col("CODIGO_POSTAL")))
    known = coded.filter(F.col("CODIGO_POSTAL").isNotNull())
    return first_per_key(known, ["CODIGO_POSTAL"], ["POBLACION", "ESTADO"], arrival_in(rows, arrival))


def newest_campaign(accounts: DataFrame) -> DataFrame:
    """One row: the newest campaign of all accounts."""
    return accounts.agg(_newest().alias("NUEVA"))


def _newest() -> Column:
    return F.max(campaign_number(F.col("CAMPANA_SALDO")))


def with_newest_campaign(accounts: DataFrame, write: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, Column]:
    """The accounts, stored by `write`, and their newest campaign, which is observed while they are written.

    The newest campaign must be known before any row gets its age. A subquery would plan the account list a second time.
    """
    seen = Observation(f"newest-{uuid.uuid4().hex}")
    stored = write(accounts.observe(seen, _newest().alias("NUEVA")))
    return stored, F.lit(seen.get["NUEVA"]).cast("bigint")


def fill_place_by_postal_code(
    df: DataFrame, postal_codes: DataFrame | None, arrival: str | None = None, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Town and state of the postal code where they are missing; without a catalogue nothing changes."""
    if postal_codes is None:
        return df
    rows = postal_codes.select(*POSTAL_SCHEMA.fieldNames())
    catalogue = postal_catalogue(postal_codes, arrival_in(postal_codes, arrival))
    unique = catalogue.select(F.col("CODIGO_POSTAL").alias("_code"), F.struct("POBLACION", "ESTADO").alias("CP"))
    coded = df.withColumn("_code", postal_code(F.col("CODIGO_POSTAL")))
    joined = lookup_join(coded, unique, "_code", "NO_DAMA", broadcast_bytes, measure=rows)
    filled = {c: first_present(F.col(c), F.col(f"CP.{c}")) for c in ("POBLACION", "ESTADO")}
    return joined.withColumns(filled).drop("_code", "CP")
