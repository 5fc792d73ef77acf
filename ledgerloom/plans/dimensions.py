"""Dimensions of partners, prospects and leaders."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fixed
from ledgerloom.functions.labels import class_of
from ledgerloom.operators import hierarchy
from ledgerloom.operators import maintenance as m

PARTNER_WATCH = (
    "fecha_vigencia_membresia", "saldo_organizacion", "saldo_personal",
    "socios_directos", "socios_directos_plan", "id_rango_actual",
)
# the two status columns follow but do not trigger (Q2)
PARTNER_UPDATE = m.Update(
    ("id_socio",), PARTNER_WATCH, ("estatus_membresia_funcion", "estatus", *PARTNER_WATCH)
)
PROSPECT_UPDATE = m.Update(("id_prospecto",), ("id_socio", "tipo", "id_socio_padre"))
LEADER_UPDATE = m.Update(("id_socio",), ("id_platinum", "nombre_platinum", "region"))


def membership_state(code: Column) -> Column:
    """Two-way label of the membership validity code; a missing code is inactive."""
    return F.when(code.isin(*fixed.VALID_MEMBERSHIPS), fixed.ACTIVE).otherwise(fixed.INACTIVE)


def partners_source(
    socios: DataFrame, ranks: DataFrame, info: DataFrame, countries: DataFrame
) -> DataFrame:
    """Partner with rank figures and country.  `socios` carries the validity code (Q1)."""
    countries = countries.select("pais", F.col("nombre").alias("nombre_pais"))
    places = info.select("socio", "pais").join(countries, "pais", "left")
    return (
        socios.join(ranks, "socio", "left")
        .join(places, "socio", "left")
        .select(
            F.col("socio").alias("id_socio"),
            "nombre",
            F.col("apellido_pat").alias("apellido_paterno"),
            F.col("apellido_mat").alias("apellido_materno"),
            "email",
            "estatus",
            F.col("padre").alias("id_padre"),
            F.col("rango").alias("id_rango_actual"),
            "fecha_ingreso",
            "fecha_vigencia_membresia",
            F.col("pais").alias("id_pais"),
            "nombre_pais",
            membership_state(F.col("estatus_membresia")).alias("estatus_membresia_funcion"),
            "saldo_organizacion",
            "saldo_personal",
            F.col("directos").alias("socios_directos"),
            F.col("directos_plan").alias("socios_directos_plan"),
        )
    )


def partners_new(
    socios: DataFrame, ranks: DataFrame, info: DataFrame, countries: DataFrame, dim_socios: DataFrame
) -> DataFrame:
    """D1."""
    return m.new_rows(dim_socios, partners_source(socios, ranks, info, countries), ["id_socio"])


def partners_update_source(socios: DataFrame, ranks: DataFrame) -> DataFrame:
    return socios.join(ranks, "socio", "left").select(
        F.col("socio").alias("id_socio"),
        membership_state(F.col("estatus_membresia")).alias("estatus_membresia_funcion"),
        "estatus",
        "fecha_vigencia_membresia",
        F.col("rango").alias("id_rango_actual"),
        "saldo_organizacion",
        "saldo_personal",
        F.col("directos").alias("socios_directos"),
        F.col("directos_plan").alias("socios_directos_plan"),
    )


def partners_changed(socios: DataFrame, ranks: DataFrame, dim_socios: DataFrame) -> DataFrame:
    """D2."""
    return PARTNER_UPDATE.state(dim_socios, partners_update_source(socios, ranks))


def prospects_source(prospects: DataFrame, info: DataFrame, countries: DataFrame) -> DataFrame:
    countries = countries.select("pais", F.col("nombre").alias("nombre_pais"))
    details = info.join(countries, "pais", "left")
    return prospects.join(details, "prospecto", "left").select(
        F.col("prospecto").alias("id_prospecto"),
        "tipo",
        "nombre",
        "apellido_pat",
        "apellido_mat",
        F.col("padre").alias("id_socio_padre"),
        F.col("cultura").alias("lenguaje"),
        F.col("nuevo_socio").alias("id_socio"),
        F.col("int_formacion").alias("interes_formacion"),
        F.col("int_ahorro").alias("interes_ahorro"),
        F.col("int_networking").alias("interes_networking"),
        F.col("int_emprendimiento").alias("interes_emprendimiento"),
        "pais",
        "genero",
        "nombre_pais",
        F.col("fecha_insert").alias("fecha_registro"),
    )


def prospects_new(
    prospects: DataFrame, info: DataFrame, countries: DataFrame, dim_prospectos: DataFrame
) -> DataFrame:
    """D3."""
    return m.new_rows(dim_prospectos, prospects_source(prospects, info, countries), ["id_prospecto"])


def prospects_update_source(prospects: DataFrame, info: DataFrame) -> DataFrame:
    """Prospects without info are inserted by D3 but never updated (Q28)."""
    return prospects.join(info.select("prospecto"), "prospecto", "left_semi").select(
        F.col("prospecto").alias("id_prospecto"),
        F.col("nuevo_socio").alias("id_socio"),
        "tipo",
        F.col("padre").alias("id_socio_padre"),
    )


def prospects_changed(prospects: DataFrame, info: DataFrame, dim_prospectos: DataFrame) -> DataFrame:
    """D4."""
    return PROSPECT_UPDATE.state(dim_prospectos, prospects_update_source(prospects, info))


def qualified_partners(
    rank_rows: DataFrame, ranks: DataFrame, info: DataFrame, allowed: Iterable[tuple[int, int]]
) -> DataFrame:
    """Partners who may be a leader: an allowed (rank, version) that the rank table knows, and
    explicitly not blacklisted (a missing flag disqualifies)."""
    pairs = F.lit(False)
    for rank, version in allowed:
        pairs = pairs | ((F.col("rango") == rank) & (F.col("version") == version))
    return (
        rank_rows.where(pairs)
        .join(ranks.where(pairs).select("rango", "version"), ["rango", "version"], "left_semi")
        .join(info.where("lista_negra IS FALSE").select("socio"), "socio", "left_semi")
        .select("socio")
    )


def leaders_source(
    socios: DataFrame,
    rank_rows: DataFrame,
    ranks: DataFrame,
    info: DataFrame,
    allowed: Iterable[tuple[int, int]],
    regions: Mapping[str, Sequence[int]],
) -> DataFrame:
    """Nearest qualified leader above each active partner (H1), and the region of that leader."""
    leaders = hierarchy.nearest_ancestor(
        socios, qualified_partners(rank_rows, ranks, info, allowed), "socio", "padre"
    )
    active = socios.where(F.col("estatus").isin(*fixed.ACTIVE_PARTNERS)).select("socio")
    found = active.join(leaders.withColumnRenamed("node", "socio"), "socio", "left")
    names = socios.select(F.col("socio").alias("hit"), F.col("nombre").alias("nombre_platinum"))
    return found.join(names, "hit", "left").select(
        F.col("socio").alias("id_socio"),
        F.col("hit").alias("id_platinum"),
        "nombre_platinum",
        class_of(F.col("hit"), regions, fixed.NO_REGION).alias("region"),
    )


def leaders_new(source: DataFrame, dim_primerplatinum: DataFrame) -> DataFrame:
    """D5; `source` is `leaders_source`, built once for D5 and D6."""
    order = [F.col(c).asc_nulls_last() for c in LEADER_UPDATE.watch]
    return m.new_rows_first(dim_primerplatinum, source, ["id_socio"], order)


def leaders_changed(source: DataFrame, dim_primerplatinum: DataFrame) -> DataFrame:
    """D6."""
    return LEADER_UPDATE.state(dim_primerplatinum, source)
