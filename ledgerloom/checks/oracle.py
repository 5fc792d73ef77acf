"""SQL that recomputes every registered query for the checking database.

Written independently of the jobs: rule tables where the jobs chain conditions, windows where
they aggregate twice, recursion where they double pointers, `NOT EXISTS` where they anti join.
"""

from __future__ import annotations

from ledgerloom import fixed_values as fixed
from ledgerloom.checks import parameters as p
from ledgerloom.checks.standins import with_standins

ORACLE: dict[str, str] = {}

RUN = f"TIMESTAMP '{p.RUN_TS}'"


def _check(name: str, tables: str, body: str, doubles: str = "", bigints: str = "") -> None:
    """Register `body`; decimal columns come out as doubles, wide integers as BIGINT."""
    casts = [f"CAST({c} AS DOUBLE) AS {c}" for c in doubles.split()]
    casts += [f"CAST({c} AS BIGINT) AS {c}" for c in bigints.split()]
    if casts:
        body = f"SELECT * REPLACE ({', '.join(casts)}) FROM (\n{body}\n) AS answer"
    ORACLE[name] = with_standins(tables.split(), body)


def _quoted(value) -> str:
    return "NULL" if value is None else "'" + str(value).replace("'", "''") + "'"


def _listed(values) -> str:
    return ", ".join(str(v) for v in values)


def _lookup(code: str, labels: dict) -> str:
    """Label of a code as a scalar subquery on a small rule table."""
    rows = ", ".join(f"({key}, {_quoted(label)})" for key, label in labels.items())
    return f"(SELECT l FROM (VALUES {rows}) AS names(k, l) WHERE k = {code})"


def _method(rules) -> str:
    """Payment label: the rule with the lowest number among those that fit."""
    rows = []
    for number, (methods, entity, condition, label) in enumerate(rules):
        for method in methods:
            rows.append(
                f"({number}, {method}, {'NULL' if entity is None else entity}, "
                f"{_quoted(condition)}, {_quoted(label)})"
            )
    return f"""COALESCE((
        SELECT arg_min(r.label, r.n) FROM (VALUES {', '.join(rows)}) AS r(n, method, entity, need, label)
        WHERE r.method = c.forma_pago AND (r.entity IS NULL OR r.entity = c.entidad_pago)
          AND (r.need = '' OR (r.need = 'trx' AND LOWER(c.referencia) LIKE 'trx-%')
               OR r.need = 'ref3=' || c.referencia3
               OR (r.need = 'house' AND COALESCE(c.referencia2, '{p.HOUSE_ACCOUNT}') = '{p.HOUSE_ACCOUNT}')
               OR (r.need = 'ref2' AND c.referencia2 IS NOT NULL))), 'x')"""


STATUS = _lookup("c.estatus", fixed.PURCHASE_STATUS)


def _missing(source: str, target: str, keys: str) -> str:
    """Source rows whose key the target lacks, NULL equal to NULL."""
    same = " AND ".join(f"old.{k} IS NOT DISTINCT FROM new.{k}" for k in keys.split())
    return f"SELECT new.* FROM ({source}) AS new WHERE NOT EXISTS (SELECT 1 FROM {target} AS old WHERE {same})"


def _updated(
    target: str, source: str, key: str, columns: str, watch: str, assign: str = "", form: dict | None = None
) -> str:
    """Target with the `assign` columns of matching, differing source rows."""
    form = form or {}
    moved = (assign or watch).split()

    def shape(side: str, column: str) -> str:
        return form.get(column, "{}").format(f"{side}.{column}")

    differ = " OR ".join(f"{shape('t', c)} IS DISTINCT FROM {shape('s', c)}" for c in watch.split())
    hit = f"s.{key} IS NOT NULL AND ({differ})"
    shown = [f"CASE WHEN {hit} THEN s.{c} ELSE t.{c} END AS {c}" if c in moved else f"t.{c}" for c in columns.split()]
    return f"SELECT {', '.join(shown)} FROM {target} AS t LEFT JOIN ({source}) AS s ON t.{key} = s.{key}"


def _merged(target: str, source: str, key: str, columns: str, touch: str) -> str:
    """Target rows not in the source, updated rows with the touch time, and inserted rows."""
    names = [c for c in columns.split() if c != touch]
    new = ", ".join(f"s.{c}" for c in names)
    return f"""
        SELECT {', '.join(names)}, {touch} FROM {target} WHERE {key} NOT IN (SELECT {key} FROM ({source}) AS k)
        UNION ALL
        SELECT {new}, CASE WHEN s.{key} IN (SELECT {key} FROM {target}) THEN {RUN} END FROM ({source}) AS s"""


# --- purchase facts -------------------------------------------------------------------------

FACT_DOUBLES = "precio precio_btc cotiza_btc cotiza_btc2 monto_pagado monto_pagado_btc monto_complementario"


def _fact(item: int, rules, product: str) -> str:
    return f"""
        SELECT c.compra AS id_compra, c.socio AS id_socio, c.prospecto AS id_prospecto, c.fecha_pago,
               {_method(rules)} AS forma_pago, {STATUS} AS estatus,
               (SELECT o.nombre FROM promociones o WHERE o.promocion = c.promocion) AS promocion,
               plan.nombre AS tipo_plan, plan.nombre AS tipo_smartpack, {product} AS tipo_producto,
               c.precio, c.moneda, c.precio_btc, c.cotiza_btc, c.cotiza_btc2, c.monto_pagado,
               c.monto_pagado_btc, c.fue_insuficiente AS pago_insuficiente, c.es_excedido AS pago_excedido,
               c.avance_pago, c.es_complementario AS complemento, c.complemento_de AS id_complemento,
               c.monto_complementario
        FROM compras c LEFT JOIN productos plan ON plan.producto = c.tipo_item
        WHERE c.estatus = 6 AND c.es_complementario IS NULL AND c.tipo_item = {item}"""


ANNUITIES = _fact(5, fixed.ANNUITY_METHODS, "'Mantenimiento'")
MEMBERSHIPS = _fact(
    1,
    fixed.MEMBERSHIP_METHODS,
    "COALESCE(IF(c.socio IS NULL, NULL, 'Membresia Zero'), IF(c.prospecto IS NULL, NULL, 'Membresia'))",
)
_check("annuities", "compras productos promociones", ANNUITIES, FACT_DOUBLES)
_check("memberships", "compras productos promociones", MEMBERSHIPS, FACT_DOUBLES)

PREV_COMPRAS = (
    "id_compra id_socio pago_insuficiente pago_excedido complemento id_complemento monto_complementario estatus"
)
FALSE_FORM = dict.fromkeys(("pago_insuficiente", "pago_excedido", "complemento"), "COALESCE({}, FALSE)")
for _name, _item in (("annuities_changed", 5), ("memberships_changed", 1)):
    _check(
        _name,
        "compras prev_compras",
        _updated(
            "prev_compras",
            f"""SELECT c.compra AS id_compra, COALESCE(c.fue_insuficiente, FALSE) AS pago_insuficiente,
                       COALESCE(c.es_excedido, FALSE) AS pago_excedido,
                       COALESCE(c.es_complementario, FALSE) AS complemento,
                       c.complemento_de AS id_complemento, c.monto_complementario, {STATUS} AS estatus
                FROM compras c WHERE c.tipo_item = {_item}""",
            "id_compra",
            PREV_COMPRAS,
            "pago_insuficiente pago_excedido complemento id_complemento monto_complementario estatus",
            form=FALSE_FORM,
        ),
        "monto_complementario",
    )

for _name, _item, _rules in (
    ("membership_labels_open", 1, fixed.MEMBERSHIP_METHODS_OPEN),
    ("annuity_labels_open", 5, fixed.ANNUITY_METHODS_OPEN),
):
    _check(
        _name,
        "compras",
        f"""SELECT c.compra AS id_compra, {_method(_rules)} AS forma_pago, {STATUS} AS estatus
            FROM compras c WHERE c.tipo_item = {_item}""",
    )

SALES_COLUMNS = (
    "id_compra, id_socio, id_producto, nombre_producto, activo, cerrado, capital_inicial, moneda, capital, "
    "saldo, fecha_compra, fecha_inicio, fecha_cierre, estatus, plazo_forzoso, plan_base, precio, tipo_pago"
)
_check(
    "sales_year_replace",
    "socio_productos compras productos prev_ventas",
    f"""
    SELECT {SALES_COLUMNS} FROM prev_ventas WHERE fecha_compra IS NULL OR YEAR(fecha_compra) < {p.YEAR}
    UNION ALL
    SELECT o.compra, o.socio, o.producto, (SELECT n.nombre FROM productos n WHERE n.producto = c.item),
           o.activo, o.cerrado, o.capital_inicial, o.moneda, o.capital, o.saldo, o.fecha_compra,
           o.fecha_inicio, o.fecha_cierre, o.estatus, o.plazo_forzoso, o.plan_base, c.precio,
           {_method(fixed.SALES_METHODS)}
    FROM socio_productos o LEFT JOIN compras c USING (compra)
    WHERE o.fecha_compra >= DATE '{p.YEAR_START}' AND o.plan_base IS NULL
      AND NOT (o.compra IN ({_listed(p.EXCLUDED_PURCHASES)}))""",
    "capital_inicial capital saldo precio",
)

# --- aggregates -----------------------------------------------------------------------------

for _name, _fact_sql in (("agg_monthly_paid", ANNUITIES), ("agg_monthly_paid_b", MEMBERSHIPS)):
    _check(
        _name,
        "compras productos promociones",
        f"""SELECT MAKE_DATE(YEAR(fecha_pago), MONTH(fecha_pago), 1) AS mes, COUNT(*) AS total_pagos,
                   SUM(precio) AS total_ingresos
            FROM ({_fact_sql}) AS f
            WHERE estatus = 'Pagado' AND CAST(fecha_pago AS DATE) >= DATE '{p.SINCE}'
              AND CAST(fecha_pago AS DATE) <= DATE '{p.AS_OF}'
            GROUP BY YEAR(fecha_pago), MONTH(fecha_pago)""",
        "total_ingresos",
    )

_patterns = ", ".join(f"({n}, {_quoted(a.lower())}, {_quoted(b)})" for n, (a, b) in enumerate(p.NAME_PATTERNS))
BUCKETS = f"""
    SELECT nombre, COUNT(*) AS cantidad, SUM(precio) AS valor_total, fecha FROM (
        SELECT COALESCE((SELECT arg_min(b, n) FROM (VALUES {_patterns}) AS rules(n, pattern, b)
                         WHERE LOWER(q.nombre) LIKE pattern), 'OTROS') AS nombre,
               v.precio, CAST(v.fecha_compra AS DATE) AS fecha
        FROM ventas v LEFT JOIN productos q ON q.producto = v.id_producto) AS named
    GROUP BY nombre, fecha"""
_check(
    "plan_bucket_daily", "ventas productos prev_agg", _missing(BUCKETS, "prev_agg", "nombre fecha"), "valor_total"
)
_check(  # the patterns written out, not taken from the package
    "plan_bucket_names",
    "ventas plan_catalogue",
    """SELECT CASE WHEN c.nombre ILIKE '%plan select%' THEN 'PLAN SELECT'
                   WHEN c.nombre ILIKE '%select24%' THEN 'SELECT24'
                   WHEN c.nombre ILIKE '%select36%' THEN 'SELECT36'
                   WHEN c.nombre ILIKE '%select%' THEN 'SELECT'
                   WHEN c.nombre ILIKE '%pa%' THEN 'PA / PA24' ELSE 'OTROS' END AS nombre,
              COUNT(*) AS cantidad, SUM(v.precio) AS valor_total, CAST(v.fecha_compra AS DATE) AS fecha
       FROM ventas v LEFT JOIN plan_catalogue c ON c.id_producto = v.id_producto GROUP BY 1, 4""",
    "valor_total",
)
_check(
    "plan_bucket_refresh",
    "ventas productos prev_agg",
    f"""SELECT * FROM ({BUCKETS}) AS fresh
        UNION ALL
        SELECT nombre, cantidad, valor_total, fecha FROM prev_agg AS old
        WHERE NOT EXISTS (SELECT 1 FROM ({BUCKETS}) AS f WHERE f.nombre = old.nombre AND f.fecha = old.fecha)""",
    "valor_total",
)
_check(
    "payment_type_daily",
    "pagos enumeracion prev_agg_bonos",
    _missing(
        """SELECT kind.nombre, COUNT(*) AS cantidad, SUM(pay.monto) AS valor_total,
                  CAST(pay.fecha_pagado AS DATE) AS fecha
           FROM pagos pay JOIN enumeracion kind ON kind.codigo = pay.tipo AND kind.categoria = 'TipoPago'
           WHERE pay.estatus = 1 GROUP BY kind.nombre, CAST(pay.fecha_pagado AS DATE)""",
        "prev_agg_bonos",
        "nombre fecha",
    ),
    "valor_total",
)

# --- AUM and contracts ----------------------------------------------------------------------

OPEN_PRODUCTS = """
    SELECT MAX(CAST(o.fecha_compra AS DATE)) AS {}, SUM(o.saldo) AS saldo_total_productos,
           SUM(o.capital) AS capital_inicial_total_productos
    FROM socio_productos o JOIN socios s ON s.socio = o.socio AND (s.estatus = 1 OR s.estatus = 2)
    WHERE NOT o.cerrado AND o.producto NOT BETWEEN 280 AND 282"""
_doubles = "saldo_total_productos capital_inicial_total_productos"
_check("aum_open_products", "socio_productos socios", OPEN_PRODUCTS.format("fecha_ultimo_plan"), _doubles)
_check("report_aum_products", "socio_productos socios", OPEN_PRODUCTS.format("max"), _doubles)
PENDING = """
    SELECT MAX(CAST(fecha_pago AS DATE)) AS {}, SUM(monto) AS {} FROM pagos
    WHERE tipo NOT BETWEEN 18 AND 20 AND estatus = 0"""
_check("pending_total", "pagos", PENDING.format("fecha_ultimo_bono", "bonos_a_pagar"), "bonos_a_pagar")
_check("report_aum_pending", "pagos", PENDING.format("max", "sum"), "sum")

_contracts = ", ".join(f"({c}, {_quoted(n)}, {_quoted(v)}, {y})" for c, n, v, y in fixed.SELECT_CONTRACTS)
CONTRACTS = f"""
    SELECT CAST(MAX(CAST(o.fecha_compra AS DATE)) + TO_YEARS(k.plazo) AS DATE) AS {{day}}, k.nombre AS {{name}},
           {{value}} AS valor_contrato, COUNT(*) AS cantidad_de_select,
           CAST(TRANSLATE(k.valor, '$,', '') AS DOUBLE) * COUNT(*) AS valor_total
    FROM socio_productos o JOIN (VALUES {_contracts}) AS k(producto, nombre, valor, plazo) USING (producto)
         JOIN socios s ON s.socio = o.socio
    WHERE NOT o.cerrado AND s.estatus BETWEEN 1 AND 2
    GROUP BY k.nombre, k.valor, k.plazo"""
_number = "CAST(TRANSLATE(k.valor, '$,', '') AS DOUBLE)"
for _name, _parts in {
    "select_contracts": {"day": "fecha_compra", "name": "nombre", "value": _number},
    "select_contracts_text": {"day": "fecha_ultimo_pago", "name": "tipo_select", "value": _number},
    "report_aum_contracts": {"day": "fecha_compra", "name": "nombre", "value": "k.valor"},
}.items():
    _check(_name, "socio_productos socios", CONTRACTS.format(**_parts))

_bonus_names = ", ".join(f"({k}, {_quoted(v)})" for k, v in fixed.SELECT_BONUSES.items())
BONUSES = f"""
    SELECT k.nombre AS {{}}, {{}} SUM(pay.monto) AS {{}}
    FROM pagos pay JOIN (VALUES {_bonus_names}) AS k(tipo, nombre) USING (tipo)
    WHERE pay.estatus = 1 AND EXISTS (
        SELECT 1 FROM socio_productos o WHERE o.socio = pay.socio AND o.producto BETWEEN 280 AND 285)
    GROUP BY k.nombre, tipo"""
_check("bonus_paid_by_type", "pagos socio_productos", BONUSES.format("tipo_bono", "", "total"), "total")
_check("report_aum_contract_bonuses", "pagos socio_productos", BONUSES.format("nombre_bono", "tipo,", "sum"), "sum")

# --- history --------------------------------------------------------------------------------

_seen = "SELECT *, ROW_NUMBER() OVER (PARTITION BY id_socio ORDER BY fecha_registro DESC NULLS FIRST) AS age FROM {}"
STATUS_CHANGES = f"""
    SELECT s.socio AS id_socio, s.estatus, s.fecha_ingreso, s.fecha_vigencia_membresia, {RUN} AS fecha_registro
    FROM socios s LEFT JOIN ({_seen.format("prev_hist_membresias")}) AS h ON h.id_socio = s.socio AND h.age = 1
    WHERE h.id_socio IS NULL
       OR (h.estatus, h.fecha_vigencia_membresia) IS DISTINCT FROM (s.estatus, s.fecha_vigencia_membresia)"""
_check("hist_status", "socios prev_hist_membresias", STATUS_CHANGES)
_check(
    "append_change_history",
    "socios prev_hist_membresias",
    f"SELECT * FROM prev_hist_membresias UNION ALL {STATUS_CHANGES}",
)
_check(
    "hist_rank",
    "v_socio_rangos_defi prev_hist_rangos",
    f"""SELECT r.socio AS id_socio, r.rango AS id_rango, {RUN} AS fecha_registro
        FROM v_socio_rangos_defi r
             LEFT JOIN ({_seen.format("prev_hist_rangos")}) AS h ON h.id_socio = r.socio AND h.age = 1
        WHERE r.rango <> 0 AND COALESCE(h.id_rango, -1) <> r.rango""",
)

# --- dimensions -----------------------------------------------------------------------------

ACTIVE = "IF(COALESCE(s.estatus_membresia, 0) IN (1, 2, 3, 7), 'Activo', 'Inactivo')"
_check(
    "partners_enriched",
    "socios v_socio_rangos_defi socio_info paises prev_dim_socios",
    _missing(
        f"""SELECT s.socio AS id_socio, s.nombre, s.apellido_pat AS apellido_paterno,
                   s.apellido_mat AS apellido_materno, s.email, s.estatus, s.padre AS id_padre,
                   r.rango AS id_rango_actual, s.fecha_ingreso, s.fecha_vigencia_membresia,
                   i.pais AS id_pais, k.nombre AS nombre_pais, {ACTIVE} AS estatus_membresia_funcion,
                   r.saldo_organizacion, r.saldo_personal, r.directos AS socios_directos,
                   r.directos_plan AS socios_directos_plan
            FROM socios s LEFT JOIN v_socio_rangos_defi r USING (socio) LEFT JOIN socio_info i USING (socio)
                 LEFT JOIN paises k ON k.pais = i.pais""",
        "prev_dim_socios",
        "id_socio",
    ),
    "saldo_organizacion saldo_personal",
)
_watch = (
    "fecha_vigencia_membresia saldo_organizacion saldo_personal socios_directos socios_directos_plan id_rango_actual"
)
_check(
    "partners_changed",
    "socios v_socio_rangos_defi prev_dim_socios",
    _updated(
        "prev_dim_socios",
        f"""SELECT s.socio AS id_socio, s.estatus, s.fecha_vigencia_membresia, r.rango AS id_rango_actual,
                   {ACTIVE} AS estatus_membresia_funcion, r.saldo_organizacion, r.saldo_personal,
                   r.directos AS socios_directos, r.directos_plan AS socios_directos_plan
            FROM socios s LEFT JOIN v_socio_rangos_defi r USING (socio)""",
        "id_socio",
        "id_socio nombre apellido_paterno apellido_materno email estatus id_padre id_rango_actual fecha_ingreso "
        "fecha_vigencia_membresia id_pais nombre_pais estatus_membresia_funcion saldo_organizacion saldo_personal "
        "socios_directos socios_directos_plan",
        _watch,
        f"{_watch} estatus estatus_membresia_funcion",
    ),
    "saldo_organizacion saldo_personal",
)
_check(
    "prospects_new",
    "prospectos prospecto_info paises prev_dim_prospectos",
    _missing(
        """SELECT q.prospecto AS id_prospecto, q.tipo, q.nombre, q.apellido_pat, q.apellido_mat,
                  q.padre AS id_socio_padre, q.cultura AS lenguaje, q.nuevo_socio AS id_socio,
                  d.int_formacion AS interes_formacion, d.int_ahorro AS interes_ahorro,
                  d.int_networking AS interes_networking, d.int_emprendimiento AS interes_emprendimiento,
                  d.pais, d.genero, k.nombre AS nombre_pais, q.fecha_insert AS fecha_registro
           FROM prospectos q LEFT JOIN prospecto_info d ON d.prospecto = q.prospecto
                LEFT JOIN paises k ON k.pais = d.pais""",
        "prev_dim_prospectos",
        "id_prospecto",
    ),
)
_check(
    "prospects_changed",
    "prospectos prospecto_info prev_dim_prospectos",
    _updated(
        "prev_dim_prospectos",
        """SELECT prospecto AS id_prospecto, tipo, padre AS id_socio_padre, nuevo_socio AS id_socio
           FROM prospectos WHERE prospecto IN (SELECT prospecto FROM prospecto_info)""",
        "id_prospecto",
        "id_prospecto tipo nombre apellido_pat apellido_mat id_socio_padre lenguaje id_socio fecha_registro",
        "id_socio tipo id_socio_padre",
    ),
)

_pairs = " OR ".join(f"(v.rango, v.version) = ({a}, {b})" for a, b in p.LEADER_RANKS)
ANCESTORS = f"""
    SELECT s.socio AS node, near.hit FROM socios s LEFT JOIN (
        WITH RECURSIVE walk(socio, above, steps) AS (
            SELECT socio, padre, 1 FROM socios WHERE padre IS NOT NULL
            UNION ALL
            SELECT w.socio, up.padre, w.steps + 1 FROM walk w JOIN socios up ON up.socio = w.above
            WHERE up.padre IS NOT NULL)
        SELECT walk.socio, arg_min(walk.above, walk.steps) AS hit FROM walk
        WHERE walk.above IN (
            SELECT v.socio FROM v_socio_rangos v
                 JOIN rangos known ON known.rango = v.rango AND known.version = v.version
                 JOIN socio_info i ON i.socio = v.socio AND i.lista_negra = FALSE
            WHERE {_pairs})
          AND walk.above IN (SELECT socio FROM socios)
        GROUP BY walk.socio) AS near ON near.socio = s.socio"""
_tree = "socios v_socio_rangos rangos socio_info"
_check("nearest_ancestor", _tree, ANCESTORS)
_regions = ", ".join(f"({i}, {_quoted(name)})" for name, ids in p.REGIONS.items() for i in ids)
LEADERS = f"""
    SELECT s.socio AS id_socio, a.hit AS id_platinum, boss.nombre AS nombre_platinum,
           COALESCE((SELECT region FROM (VALUES {_regions}) AS places(id, region) WHERE id = a.hit), 'Sin Region')
               AS region
    FROM ({ANCESTORS}) AS a JOIN socios s ON s.socio = a.node LEFT JOIN socios boss ON boss.socio = a.hit
    WHERE s.estatus IN (1, 2)"""
_check("first_leader", f"{_tree} prev_primerplatinum", _missing(LEADERS, "prev_primerplatinum", "id_socio"))
_check(
    "first_leader_changed",
    f"{_tree} prev_primerplatinum",
    _updated(
        "prev_primerplatinum", LEADERS, "id_socio", "id_socio id_platinum nombre_platinum region",
        "id_platinum nombre_platinum region",
    ),
)

_goal = "CASE MONTH(fecha) " + " ".join(f"WHEN {n} THEN g.{c}" for n, c in enumerate(fixed.GOAL_MONTHS, 1)) + " END"
for _name, _table, _when, _measure, _joined in (
    ("goals_members", "socios", "x.fecha_ingreso", "COUNT(*)", "x.socio"),
    ("goals_sales", "ventas", "x.fecha_compra", "SUM(x.precio)", "x.id_socio"),
):
    _check(
        _name,
        f"primerplatinum_simple {_table} objetivos",
        f"""SELECT fecha, id_platinum, nombre_platinum, region, total_real, {_goal} AS total_objetivo FROM (
                SELECT CAST(DATE_TRUNC('month', {_when}) AS DATE) AS fecha, id_platinum, nombre_platinum, region,
                       {_measure} AS total_real
                FROM primerplatinum_simple pl JOIN {_table} x ON pl.id_socio = {_joined}
                WHERE YEAR({_when}) = {p.YEAR} GROUP BY ALL) AS m
            LEFT JOIN objetivos g ON g.id_socio_platinum = m.id_platinum""",
        "total_objetivo" if _name == "goals_members" else "total_real total_objetivo",
    )

# --- payments -------------------------------------------------------------------------------

WITHDRAWALS = """
    SELECT pago AS id_retiro, socio AS id_socio, tipo, monto, monto_pagado_btc AS monto_pagado_cripto,
           cotiza_btc AS cotiza_cripto, estatus, fecha AS fecha_solicitud, fecha_pago AS fecha_pago_estimada,
           fecha_pagado AS fecha_pago, fecha_cancelacion, defi FROM pagos WHERE tipo = 0"""
_amounts = "monto monto_pagado_cripto cotiza_cripto"
_check(
    "withdrawals_new",
    "pagos prev_retiros",
    _missing(f"{WITHDRAWALS} AND NOT socio = {p.EXCLUDED_PARTNER}", "prev_retiros", "id_retiro"),
    _amounts,
)
_check(
    "withdrawals_changed",
    "pagos prev_retiros",
    _updated(
        "prev_retiros", WITHDRAWALS, "id_retiro",
        "id_retiro id_socio tipo monto monto_pagado_cripto cotiza_cripto estatus fecha_solicitud "
        "fecha_pago_estimada fecha_pago fecha_cancelacion defi",
        "fecha_pago fecha_cancelacion fecha_pago_estimada",
        "estatus fecha_solicitud fecha_pago fecha_pago_estimada fecha_cancelacion",
    ),
    _amounts,
)


def _bonus(id_name: str, rows: str) -> str:
    days = {
        "fecha_solicitud": "fecha",
        "fecha_pago_estimada": "fecha_pago",
        "fecha_pagado": "fecha_pagado",
        "fecha_cancelacion": "fecha_cancelacion",
    }
    shown = ", ".join(
        f"CAST(x.{source} AS DATE) AS {name}, CAST(x.{source} AS DATE) AS fk_{name}" for name, source in days.items()
    )
    return f"""SELECT x.pago AS {id_name}, x.socio AS id_socio, x.monto, x.monto_pagado_btc AS monto_pagado_cripto,
                      x.cotiza_btc AS cotiza_cripto, x.estatus, {shown}, x.defi,
                      IF(COALESCE(x.mtd_dsp, 0) = 2, 'CNKT', 'BTC') AS moneda,
                      CAST(x.pago_tx AS INTEGER) AS pago_tx FROM {rows}"""


MASTER = _bonus("id_masterbonus", "pagos x WHERE x.tipo = 4")
PAID = _bonus(
    "id_retiro",
    "pagos x WHERE x.estatus = 1 AND x.tipo IN (SELECT codigo FROM enumeracion WHERE categoria = 'TipoPago')",
)
_bonus_dates = "fecha_solicitud fecha_pago_estimada fecha_pagado fecha_cancelacion"
_bonus_columns = (
    "id_socio monto monto_pagado_cripto cotiza_cripto estatus fecha_solicitud fk_fecha_solicitud "
    "fecha_pago_estimada fk_fecha_pago_estimada fecha_pagado fk_fecha_pagado fecha_cancelacion "
    "fk_fecha_cancelacion defi moneda pago_tx"
)
_bonus_assign = f"estatus {_bonus_dates} {' '.join('fk_' + d for d in _bonus_dates.split())} defi"
for _stem, _source, _key, _prev, _tables in (
    ("masterbonus", MASTER, "id_masterbonus", "prev_masterbonus", "pagos prev_masterbonus"),
    ("bonuses", PAID, "id_retiro", "prev_bonos", "pagos enumeracion prev_bonos"),
):
    _days = ", ".join(f"CAST({d} AS DATE) AS {d}" for d in _bonus_dates.split())
    _check(f"{_stem}_new", _tables, _missing(_source, _prev, _key), _amounts)
    _check(
        f"{_stem}_changed",
        _tables,
        _updated(
            f"(SELECT * REPLACE ({_days}) FROM {_prev})", _source, _key, f"{_key} {_bonus_columns}",
            f"estatus {_bonus_dates}", _bonus_assign,
        ),
        _amounts,
    )

# --- records --------------------------------------------------------------------------------

_classes = [f"({_quoted(w)}, 'compra')" for w in p.BUY_WALLETS] + [f"({_quoted(w)}, 'pago')" for w in p.PAY_WALLETS]
_check(
    "wallet_class",
    "",
    f"""SELECT 'W' || user_id AS wallet_id, event_type AS coin,
               IF(event_type = 'click', 0, value) AS saldo, COALESCE(k.tipo, 'otro') AS tipo
        FROM events LEFT JOIN (VALUES {', '.join(_classes)}) AS k(id, tipo) ON k.id = 'W' || user_id""",
    "saldo",
)
TRANSFERS = """
    SELECT 'W' || user_id AS wallet_id, event_type AS tipo, IF(event_type = 'error', NULL, 'BTC') AS moneda,
           value AS monto, 'k' || event_id AS kft_id FROM events"""
_check("internal_transfers_new", "prev_transacciones", _missing(TRANSFERS, "prev_transacciones", "kft_id"), "monto")
PURCHASES = """
    SELECT o.o_orderkey AS id_compra, 'addr ' || o.o_custkey AS address,
           CAST(o.o_totalprice AS DECIMAL(20,2)) AS cantidad,
           CASE WHEN o.o_orderpriority <> '5-LOW' THEN CAST(o.o_totalprice AS DECIMAL(20,2)) END AS monto_recibido,
           o.o_orderstatus AS status,
           CASE WHEN o.o_orderstatus <> 'P' AND o.o_orderpriority <> '5-LOW' THEN o.o_orderdate END AS fecha_pago,
           CASE WHEN o.o_orderstatus = 'F' THEN 'BTC' END AS coin, ref.o_orderkey AS complemento_de,
           CASE WHEN o.o_orderpriority <> '1-URGENT' THEN CAST(o.o_totalprice AS DECIMAL(20,2)) END AS usd,
           'W' || o.o_custkey AS wallet
    FROM orders o LEFT JOIN orders ref ON ref.o_orderkey = o.o_custkey AND o.o_custkey % 10 <= 1"""
_check(
    "json_purchases",
    "prev_compras_planes",
    _missing(PURCHASES, "prev_compras_planes", "id_compra"),
    "cantidad monto_recibido usd",
)
_check(
    "records_created_between",
    "",
    f"""SELECT o_orderkey AS id_compra, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS fecha_pago
        FROM orders WHERE o_orderdate > DATE '{p.SINCE}' AND o_orderdate < DATE '{p.YEAR_END}'
          AND (o_orderpriority <> '5-LOW' OR o_orderstatus = 'P')""",
)
_text_form = "LOWER(TRIM(COALESCE({}, '')))"
_cents = "ROUND({}, 2)"
_check(
    "json_purchases_changed",
    "prev_compras_planes",
    _updated(
        "prev_compras_planes", PURCHASES, "id_compra",
        "id_compra address cantidad monto_recibido status fecha_pago coin complemento_de usd wallet",
        "address cantidad monto_recibido status fecha_pago coin complemento_de usd wallet",
        form={
            **dict.fromkeys(("address", "status", "coin", "wallet"), _text_form),
            **dict.fromkeys(("cantidad", "monto_recibido", "usd"), _cents),
            "fecha_pago": "DATE_TRUNC('second', {})",
        },
    ),
    "cantidad monto_recibido usd",
)
PAYOUTS = """
    SELECT event_id AS pago_tx, CAST(value AS DECIMAL(20,2)) AS amount, event_type AS asset, 'BTC' AS coin,
           64000.25 AS cotizacion, 'Done' AS estatus, 'TX' || event_id AS id_tx,
           IF(event_type = 'error', NULL, 'W' || user_id) AS id_wallet, ts AS created_at,
           CAST(NULL AS VARCHAR) AS address, CAST(value AS DECIMAL(38,9)) AS amount_crypto, 'usd' AS moneda,
           IF(event_type = 'click', NULL, user_id) AS socio FROM events"""
_check(
    "json_payouts",
    "prev_pagos_planes",
    _missing(PAYOUTS, "prev_pagos_planes", "pago_tx"),
    "amount cotizacion amount_crypto",
)
_check(
    "json_payouts_changed",
    "prev_pagos_planes",
    _updated(
        "prev_pagos_planes", PAYOUTS, "pago_tx",
        "pago_tx amount asset coin cotizacion estatus id_tx id_wallet created_at address amount_crypto moneda socio",
        "amount asset coin cotizacion estatus id_tx id_wallet amount_crypto",
        form={
            **dict.fromkeys(("asset", "coin", "estatus", "id_tx", "id_wallet"), _text_form),
            **dict.fromkeys(("amount", "cotizacion", "amount_crypto"), _cents),
        },
    ),
    "amount cotizacion amount_crypto",
)

# --- KPIs -----------------------------------------------------------------------------------

_check(
    "client_liabilities",
    "socio_productos socios pagos",
    """SELECT id_socio, pasivo_productos, pasivo_pagos_pendientes,
              pasivo_productos - pasivo_pagos_pendientes AS liabilities FROM (
           SELECT o.socio AS id_socio, SUM(o.saldo) AS pasivo_productos,
                  COALESCE((SELECT SUM(w.monto) FROM pagos w
                            WHERE w.socio = o.socio AND w.tipo = 0 AND w.estatus = 0), 0) AS pasivo_pagos_pendientes
           FROM socio_productos o
           WHERE NOT o.cerrado AND o.producto NOT BETWEEN 280 AND 282
             AND EXISTS (SELECT 1 FROM socios s WHERE s.socio = o.socio AND s.estatus IN (2, 1))
           GROUP BY o.socio) AS sums""",
    "pasivo_productos pasivo_pagos_pendientes liabilities",
)
_check(
    "client_paid_pct",
    "pagos",
    f"""SELECT pend.socio AS id_socio, pend.total AS pasivo_pagos_pendientes,
               COALESCE(done.total, 0) AS pasivo_pagos_realizados,
               CAST(COALESCE(done.total, 0) AS DOUBLE) * 100 / CAST(NULLIF(pend.total, 0) AS DOUBLE)
                   AS porcentajes_pago
        FROM (SELECT socio, SUM(monto) AS total FROM pagos WHERE estatus = 0 GROUP BY socio) AS pend
             LEFT JOIN (SELECT socio, SUM(monto) AS total FROM pagos WHERE estatus = 1 GROUP BY socio) AS done
             ON done.socio = pend.socio
        WHERE pend.socio NOT IN ({_listed(p.EXCLUDED_PARTNERS)})""",
    "pasivo_pagos_pendientes pasivo_pagos_realizados",
)


def _percent(part: str, whole: str) -> str:
    """Two half-up decimals of `100 * part / whole`, in whole numbers until the end."""
    return f"CAST((20000 * CAST({part} AS BIGINT) + {whole}) // (2 * {whole}) AS DOUBLE) / 100"


_check(
    "repurchase_monthly",
    "compras",
    f"""SELECT mes, total_compras, primeras_compras, total_compras - primeras_compras AS recompras,
               {_percent('(total_compras - primeras_compras)', 'total_compras')} AS pct_recompra FROM (
            SELECT CAST(DATE_TRUNC('month', fecha_pago) AS DATE) AS mes, COUNT(*) AS total_compras,
                   SUM(IF(nth = 1, 1, 0)) AS primeras_compras
            FROM (SELECT fecha_pago, ROW_NUMBER() OVER (PARTITION BY socio ORDER BY fecha_pago, compra) AS nth
                  FROM compras
                  WHERE estatus = 6 AND tipo_item NOT IN (1, 3, 5)
                    AND CAST(fecha_pago AS DATE) >= DATE '{p.YEAR_START}') AS numbered
            GROUP BY 1) AS months""",
    bigints="primeras_compras recompras",
)
_check(
    "retention_monthly",
    "vencimientos fact_anualidades",
    f"""SELECT mes_venc, retenido, abandono, recuperado, total_mes,
               {_percent('retenido', 'total_mes')} AS pct_retencion,
               {_percent('abandono', 'total_mes')} AS pct_abandono,
               {_percent('recuperado', 'total_mes')} AS pct_recuperacion FROM (
            SELECT CAST(DATE_TRUNC('month', due.pago_anualidad) AS DATE) AS mes_venc,
                   COUNT(DISTINCT CASE WHEN last.paid <= due.pago_anualidad THEN due.id_socio END) AS retenido,
                   COUNT(DISTINCT CASE WHEN last.paid IS NULL THEN due.id_socio END) AS abandono,
                   COUNT(DISTINCT CASE WHEN last.paid IS NOT NULL
                         AND NOT COALESCE(last.paid <= due.pago_anualidad, FALSE) THEN due.id_socio END) AS recuperado,
                   COUNT(DISTINCT due.id_socio) AS total_mes
            FROM vencimientos due LEFT JOIN (
                SELECT id_socio, MAX(CAST(fecha_pago AS DATE)) AS paid FROM fact_anualidades
                WHERE YEAR(fecha_pago) = {p.YEAR} GROUP BY id_socio) AS last ON last.id_socio = due.id_socio
            GROUP BY 1) AS months""",
)
_check(
    "daily_balance",
    "compras socio_productos",
    f"""SELECT day.fecha, anualidades, membresias, venta_planes, bonos_y_comisiones, masterbonos, retiros,
               anualidades + membresias + venta_planes - bonos_y_comisiones - masterbonos - retiros AS total FROM (
            SELECT cal.fecha, COALESCE(i.a, 0) AS anualidades, COALESCE(i.m, 0) AS membresias,
                   COALESCE(i.v, 0) AS venta_planes, COALESCE(e.b, 0) AS bonos_y_comisiones,
                   COALESCE(e.m, 0) AS masterbonos, COALESCE(e.r, 0) AS retiros
            FROM (SELECT CAST(UNNEST(GENERATE_SERIES(DATE '{p.YEAR_START}', DATE '{p.YEAR_END}', INTERVAL 1 DAY))
                         AS DATE) AS fecha) AS cal
                 LEFT JOIN (
                     SELECT CAST(fecha_pago AS DATE) AS fecha, SUM(monto_pagado) FILTER (tipo_item = 5) AS a,
                            SUM(monto_pagado) FILTER (tipo_item = 1) AS m,
                            SUM(monto_pagado) FILTER (tipo_item <> 1 AND tipo_item <> 5) AS v
                     FROM compras WHERE estatus = 6 GROUP BY 1) AS i ON i.fecha = cal.fecha
                 LEFT JOIN (
                     SELECT CAST(fecha_compra AS DATE) AS fecha, CAST(0 AS DECIMAL(19,2)) AS b,
                            SUM(saldo) FILTER (NOT cerrado) AS m, SUM(saldo) FILTER (cerrado) AS r
                     FROM socio_productos WHERE activo GROUP BY 1) AS e ON e.fecha = cal.fecha) AS day""",
    "anualidades membresias venta_planes bonos_y_comisiones masterbonos retiros total",
)
_onchain = ", ".join(f"({k}, {_quoted(v)})" for k, v in fixed.ONCHAIN_METHODS.items())
_check(
    "reconcile_sales",
    "compras prev_conciliacion_ventas",
    _merged(
        "prev_conciliacion_ventas",
        f"""SELECT c.compra, c.socio, c.prospecto, c.tipo_item, c.item, c.item2, k.nombre AS forma_pago, c.promocion,
                   c.wallet_destino, c.precio, c.moneda, c.precio_btc, c.cotiza_btc, c.monto_pagado,
                   c.monto_pagado_btc, c.fue_insuficiente, c.es_complementario, c.complemento_de, c.fecha_pago,
                   c.fecha_insert, c.referencia2, c.referencia3, c.referencia,
                   COALESCE({_lookup('c.tipo_item', fixed.RECONCILED_PRODUCTS)}, 'Planes') AS nombre_del_producto
            FROM compras c JOIN (VALUES {_onchain}) AS k(codigo, nombre) ON k.codigo = c.forma_pago
            WHERE c.estatus = 6""",
        "compra",
        "compra socio prospecto tipo_item item item2 forma_pago promocion wallet_destino precio moneda precio_btc "
        "cotiza_btc monto_pagado monto_pagado_btc fue_insuficiente es_complementario complemento_de fecha_pago "
        "fecha_insert referencia2 referencia3 referencia nombre_del_producto fecha_registro",
        "fecha_registro",
    ),
    "precio precio_btc cotiza_btc monto_pagado monto_pagado_btc",
)
_check(
    "reconcile_payments",
    "pagos_transacciones prev_conciliacion_pagos",
    _merged(
        "prev_conciliacion_pagos",
        f"""SELECT pago_tx, socio, CASE WHEN monto >= 1 THEN monto END AS monto,
                   CAST(fecha_pagado AS DATE) AS fecha_pagado, wallet, monto_pagado_btc,
                   CASE WHEN monto >= 2 THEN cotiza_btc END AS cotiza_btc, mensaje
            FROM pagos_transacciones
            WHERE estatus = 1 AND CONTAINS(UPPER(mensaje), '{p.KEYWORD}')""",
        "pago_tx",
        "pago_tx socio monto fecha_pagado wallet monto_pagado_btc cotiza_btc mensaje fecha_registro",
        "fecha_registro",
    ),
    "monto monto_pagado_btc cotiza_btc",
)

# --- table maintenance ----------------------------------------------------------------------

_check(
    "insert_new",
    "cur_orders prev_orders",
    f"SELECT * FROM prev_orders UNION ALL {_missing('SELECT * FROM cur_orders', 'prev_orders', 'socio dia')}",
    "precio",
)
_check(
    "insert_or_ignore",
    "cur_orders prev_orders",
    """SELECT * FROM prev_orders
       UNION ALL
       SELECT socio, dia, compra, precio FROM cur_orders WHERE socio IS NULL OR dia IS NULL
       UNION ALL
       SELECT socio, dia, MIN(compra), arg_min(precio, compra) FROM cur_orders
       WHERE socio IS NOT NULL AND dia IS NOT NULL
         AND (socio, dia) NOT IN (SELECT (socio, dia) FROM prev_orders WHERE socio IS NOT NULL AND dia IS NOT NULL)
       GROUP BY socio, dia""",
    "precio",
)
_lines = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"
_check(
    "insert_new_first",
    "",
    f"""SELECT {_lines} FROM lineitem WHERE l_extendedprice > 90000
        UNION ALL
        SELECT l_orderkey, l_linenumber, one.a, one.b, one.c, one.d FROM (
            SELECT l_orderkey, l_linenumber, BOOL_OR(l_extendedprice > 90000) AS known,
                   MIN({{'a': l_partkey, 'b': l_suppkey, 'c': l_quantity, 'd': l_extendedprice}}) AS one
            FROM lineitem GROUP BY l_orderkey, l_linenumber) AS firsts
        WHERE NOT known""",
)
_customer = "c_custkey c_name c_nationkey c_acctbal c_mktsegment"
_check(
    "diff_update",
    "prev_customer cur_customer",
    _updated(
        "prev_customer", "SELECT * FROM cur_customer", "c_custkey", _customer, "c_acctbal",
        "c_acctbal c_mktsegment",
    ),
    "c_acctbal",
)
_check(
    "diff_update_tolerant",
    "prev_part_noise cur_part_noise",
    _updated(
        "prev_part_noise", "SELECT * FROM cur_part_noise", "producto", "producto nombre nota precio",
        "nombre nota precio", form={"nombre": _text_form, "nota": _text_form, "precio": _cents},
    ),
    "precio",
)
_check(
    "upsert",
    "prev_part cur_part",
    _merged("prev_part", "SELECT * FROM cur_part", "producto", "producto nombre precio fecha_registro", "fecha_registro"),
    "precio",
)
_check("replace_all", "cur_customer", "SELECT * FROM cur_customer", "c_acctbal")
_check("replace_keep_old", "prev_customer", "SELECT * FROM prev_customer", "c_acctbal")
_check("replace_when_filled", "cur_customer", "SELECT * FROM cur_customer", "c_acctbal")
_span = f"dia >= DATE '{p.YEAR_START}' AND dia < DATE '{p.YEAR_END}'"
_check(
    "replace_range",
    "prev_orders cur_orders",
    f"""SELECT * FROM prev_orders WHERE dia IS NULL OR NOT ({_span})
        UNION ALL SELECT * FROM cur_orders WHERE {_span}""",
    "precio",
)
_check(
    "append_snapshot",
    "prev_transacciones",
    f"SELECT * FROM prev_transacciones UNION ALL {TRANSFERS}",
    "monto",
)

# --- reports --------------------------------------------------------------------------------

FULL_NAME = "TRIM(s.nombre) || ' ' || TRIM(s.apellido_pat) || ' ' || TRIM(s.apellido_mat)"
_check(
    "report_active_partners",
    "socios",
    f"""SELECT socio, fecha_ingreso FROM socios
        WHERE (estatus = 1 OR estatus = 2) AND socio <> {p.EXCLUDED_PARTNER}""",
)
ALONE = "c.estatus = 6 AND c.es_complementario IS NULL AND c.tipo_item = "
_check(
    "report_maintenance_gateway",
    "compras socios",
    f"""SELECT c.socio, {FULL_NAME} AS nombre_socio, 'COMPLETADA' AS estatus_compra,
               'MANTENIMIENTO' AS tipo_de_producto, 'OPENPAY' AS plataforma_cobro, c.precio, c.moneda,
               c.referencia AS id_transaccion, CAST(c.fecha_insert AS DATE) AS fecha_de_pago, c.observaciones
        FROM compras c LEFT JOIN socios s ON s.socio = c.socio WHERE {ALONE} 5 AND c.forma_pago = 2""",
    "precio",
)
_check(
    "report_courses",
    "learning_compras learning_curso socios",
    f"""SELECT c.socio, {FULL_NAME} AS nombre_socio, k.nombre AS nombre_curso, 'COMPLETADA' AS estatus_compra,
               IF(c.forma_pago = 2, 'OPENPAY', 'No identificado') AS plataforma_cobro, c.precio, c.moneda,
               c.referencia AS id_transaccion, k.ponentes, IFNULL(c.fecha_pago, c.fecha_pagado) AS fecha_de_pago,
               c.observaciones
        FROM learning_compras c LEFT JOIN learning_curso k ON k.id_curso = c.item
             LEFT JOIN socios s ON s.socio = c.socio
        WHERE (c.estatus = 4 OR c.estatus = 6) AND c.precio <> 0""",
    "precio",
)
_prices = ", ".join(f"({k}, {_quoted(v)})" for k, v in p.CARD_ITEM_PRICES.items())
_check(
    "report_memberships",
    "compras prospectos socios",
    f"""SELECT s.socio, {FULL_NAME} AS nombre, 'COMPLETADA' AS estatus_compra,
               COALESCE(k.clase, 'No identificado') AS tipo_de_producto, 'OPENPAY' AS plataforma_cobro, c.moneda,
               c.monto_pagado, c.hash AS id_transaccion, CAST(c.fecha_insert AS DATE) AS fecha_insert,
               c.fecha_pago AS fecha_de_pago, c.observaciones
        FROM compras c LEFT JOIN prospectos q ON q.prospecto = c.prospecto
             LEFT JOIN socios s ON s.socio = q.nuevo_socio
             LEFT JOIN (VALUES {_prices}) AS k(precio, clase) ON k.precio = c.precio
        WHERE {ALONE} 1 AND c.forma_pago = 2 AND c.socio IS NULL""",
    "monto_pagado",
)
BTC = "LPAD(FORMAT('{{:,.9f}}', CAST({} AS DOUBLE)), 18, ' ')"
GATEWAY = f"""c.referencia AS id_transaccion,
    COALESCE({_lookup('c.forma_pago', fixed.GATEWAY_METHODS)}, 'X') AS plataforma, c.forma_pago, c.monto_pagado,
    IF(c.monto_pagado_btc = 0, '0', {BTC.format('c.monto_pagado_btc')}) AS btc, c.monto_pagado_btc,
    CAST(c.fecha_insert AS DATE) AS fecha_pago"""
_check(
    "report_maintenance_all",
    "compras",
    f"SELECT c.socio, {GATEWAY} FROM compras c WHERE {ALONE} 5",
    "monto_pagado monto_pagado_btc",
)
_check(
    "report_memberships_all",
    "compras prospectos socios",
    f"""SELECT s.socio, {GATEWAY} FROM compras c, prospectos q, socios s
        WHERE q.prospecto = c.prospecto AND s.socio = q.nuevo_socio AND {ALONE} 1""",
    "monto_pagado monto_pagado_btc",
)
_paid_kind = "pagos x JOIN enumeracion k ON k.codigo = x.tipo AND k.categoria = 'TipoPago'"
_check(
    "report_bonus_daily",
    "pagos enumeracion",
    f"""SELECT COUNT(*) AS numero, k.nombre, x.tipo, SUM(x.monto) AS total,
               CAST(x.fecha_pagado AS DATE) AS fecha_pagado FROM {_paid_kind}
        WHERE x.estatus = 1 AND x.tipo IN ({_listed(fixed.REPORTED_BONUS_TYPES)})
        GROUP BY k.nombre, x.tipo, CAST(x.fecha_pagado AS DATE)""",
    "total",
)
_check(
    "report_bonus_tiers",
    "pagos enumeracion",
    f"""SELECT COUNT(*) AS numero,
               COALESCE({_lookup('x.monto', fixed.MASTER_BONUS_TIERS)}, 'MASTER BONUS NO IDENTIFICADO') AS nivel,
               x.monto, k.nombre, x.tipo, SUM(x.monto) AS total, CAST(x.fecha_pagado AS DATE) AS fecha_pagado
        FROM {_paid_kind} WHERE x.estatus = 1 AND x.tipo = 4 AND x.monto <> 0
        GROUP BY x.monto, k.nombre, x.tipo, CAST(x.fecha_pagado AS DATE)""",
    "monto total",
)
FLOWS = """
    SELECT usd, {} AS btc, fecha_pagado FROM (
        SELECT SUM(monto) AS usd, SUM(monto_pagado_btc) AS cripto, CAST(fecha_pagado AS DATE) AS fecha_pagado
        FROM pagos_transacciones WHERE estatus BETWEEN 0 AND 1 GROUP BY 3) AS days"""
# a day without crypto shows no digit before the point
_shown = f"IF(cripto < 1, LPAD('.000000000', 18, ' '), {BTC.format('cripto')})"
_check("report_inflows", "pagos_transacciones", FLOWS.format(_shown), "usd")
_check("report_outflows", "pagos_transacciones", FLOWS.format(f"IF(cripto = 0, '0', {_shown})"), "usd")

# --- run log --------------------------------------------------------------------------------

_steps = (
    ("fact_retiros", "insertar_retiros",
     _missing(f"{WITHDRAWALS} AND NOT socio = {p.EXCLUDED_PARTNER}", "prev_retiros", "id_retiro")),
    ("fact_masterbonus", "insertar_masterbonus", _missing(MASTER, "prev_masterbonus", "id_masterbonus")),
    ("fact_anualidades", "insertar_anualidades", ANNUITIES),
)
_check(
    "run_log",
    "pagos prev_retiros prev_masterbonus compras productos promociones",
    " UNION ALL ".join(
        f"""SELECT 'success' AS estatus, '{table}' AS tabla, '{process}' AS proceso,
                   (SELECT COUNT(*) FROM ({rows}) AS r) AS registros_insertados, 'No error' AS error_text"""
        for table, process, rows in _steps
    ),
)
