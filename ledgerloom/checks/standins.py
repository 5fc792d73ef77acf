"""Stand-ins for the operational and warehouse tables, derived from the test tables.

Each entry is one `SELECT` in the SQL both Spark and the checking database understand, over whole
test tables or over other stand-ins (`{name}`).  The jobs read the result like any other table;
the checking SQL gets the same text as a common table expression.

`prev_*` entries are earlier states of target tables: what a run before some day would have left,
with a natural part of the rows out of date.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.sources.tables import read_folder

BASE = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
    "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string",
}

HOUSE_ACCOUNT = "000111222333444555"  # invented

STANDINS: dict[str, str] = {
    # --- partners ---------------------------------------------------------------------
    "socios": """
        SELECT c_custkey AS socio, '  ' || c_name || ' ' AS nombre, c_mktsegment AS apellido_pat,
               CASE WHEN c_acctbal >= 0 THEN 'N' || CAST(c_nationkey AS STRING) || ' ' END AS apellido_mat,
               c_name || '@example.org' AS email,
               CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN 2
                    WHEN 'HOUSEHOLD' THEN 3 WHEN 'AUTOMOBILE' THEN 0 END AS estatus,
               CASE WHEN c_acctbal >= 0 THEN c_nationkey % 9 END AS estatus_membresia,
               CASE WHEN c_custkey > 0 THEN CAST(FLOOR(c_custkey / 3) AS BIGINT) END AS padre,
               DATE '1996-10-01' + CAST(c_custkey % 600 AS INTEGER) AS fecha_ingreso,
               CASE WHEN c_acctbal >= 0 THEN DATE '1998-01-01' + CAST(c_nationkey * 7 AS INTEGER)
                    END AS fecha_vigencia_membresia
        FROM {customer}""",
    "v_socio_rangos_defi": """
        SELECT c_custkey AS socio, c_nationkey AS rango,
               CAST(c_acctbal AS DECIMAL(19,2)) + 500 AS saldo_organizacion,
               CAST(c_acctbal AS DECIMAL(19,2)) AS saldo_personal,
               c_nationkey % 4 AS directos, c_nationkey % 3 AS directos_plan
        FROM {customer} WHERE c_mktsegment <> 'FURNITURE'""",
    "v_socio_rangos": """
        SELECT c_custkey AS socio,
               CASE WHEN c_acctbal > 8500 THEN 18 WHEN c_acctbal > 7000 THEN 19
                    ELSE c_nationkey % 18 END AS rango,
               CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 2 ELSE 1 END AS version
        FROM {customer}""",
    "rangos": "SELECT n_nationkey AS rango, 1 AS version, n_name AS nombre FROM {nation}",
    "socio_info": """
        SELECT c_custkey AS socio, CAST(c_nationkey AS BIGINT) AS pais,
               CASE WHEN c_acctbal < 0 THEN TRUE WHEN c_mktsegment <> 'AUTOMOBILE' THEN FALSE
                    END AS lista_negra
        FROM {customer} WHERE c_mktsegment <> 'BUILDING' OR c_acctbal > 2000""",
    "paises": """
        SELECT CAST(n_nationkey AS BIGINT) AS pais, n_name AS nombre FROM {nation}
        WHERE n_regionkey <> 4""",
    "prospectos": """
        SELECT c_custkey AS prospecto, c_nationkey % 3 AS tipo, c_name AS nombre,
               c_mktsegment AS apellido_pat, CAST(NULL AS STRING) AS apellido_mat,
               c_name || '@example.org' AS email, CAST(c_nationkey AS BIGINT) AS padre,
               CASE WHEN c_nationkey < 12 THEN 'es' ELSE 'en' END AS cultura,
               CASE WHEN c_acctbal > 0 THEN c_custkey END AS nuevo_socio,
               DATE '1997-01-01' + CAST(c_custkey % 400 AS INTEGER) AS fecha_insert
        FROM {customer}""",
    "prospecto_info": """
        SELECT c_custkey AS prospecto, c_nationkey % 2 AS int_formacion, c_nationkey % 3 AS int_ahorro,
               c_nationkey % 4 AS int_networking, c_nationkey % 5 AS int_emprendimiento,
               CAST(c_nationkey AS BIGINT) AS pais,
               CASE WHEN c_mktsegment = 'BUILDING' THEN 'F' ELSE 'M' END AS genero
        FROM {customer} WHERE c_mktsegment <> 'MACHINERY'""",
    # --- purchases --------------------------------------------------------------------
    "compras": f"""
        SELECT o_orderkey AS compra,
               CASE WHEN o_orderpriority <> '3-MEDIUM' THEN o_custkey END AS socio,
               CASE WHEN o_totalprice < 400000 THEN o_custkey END AS prospecto,
               CAST(o_orderkey % 7 AS INTEGER) AS tipo_item, o_custkey AS item, o_custkey + 1 AS item2,
               CASE WHEN o_orderstatus <> 'P' THEN 6
                    WHEN o_orderpriority <> '1-URGENT' THEN CAST(o_custkey % 10 - 2 AS INTEGER)
                    END AS estatus,
               CASE WHEN o_totalprice < 100000 THEN 2
                    ELSE CAST(CAST(FLOOR(o_totalprice) AS BIGINT) % 14 AS INTEGER) END AS forma_pago,
               CASE WHEN o_custkey % 11 > 0 THEN CAST(1 + o_custkey % 3 AS INTEGER) END AS entidad_pago,
               CASE WHEN o_orderpriority = '2-HIGH' THEN 'trx-' ELSE 'REF-' END
                   || CAST(o_orderkey AS STRING) AS referencia,
               CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '{HOUSE_ACCOUNT}'
                    WHEN o_orderpriority <> '5-LOW' THEN 'ACC-' || CAST(o_custkey AS STRING)
                    END AS referencia2,
               CASE o_custkey % 5 WHEN 0 THEN 'BTC' WHEN 1 THEN 'CNKT_POL' WHEN 2 THEN 'USDT_TRON'
                    END AS referencia3,
               CASE WHEN o_custkey % 4 > 0 THEN CAST(o_custkey % 4 AS BIGINT) END AS promocion,
               CASE o_orderpriority WHEN '1-URGENT' THEN CAST(795.00 AS DECIMAL(19,2))
                    WHEN '3-MEDIUM' THEN CAST(995.00 AS DECIMAL(19,2))
                    ELSE CAST(o_totalprice AS DECIMAL(19,2)) END AS precio,
               CASE WHEN o_orderstatus = 'F' THEN 'USD' ELSE 'MXN' END AS moneda,
               CAST(CAST(o_totalprice AS DECIMAL(19,2)) AS DECIMAL(38,9)) AS precio_btc,
               CAST(64000.25 AS DECIMAL(38,9)) AS cotiza_btc, CAST(NULL AS DECIMAL(38,9)) AS cotiza_btc2,
               CAST(o_totalprice AS DECIMAL(19,2)) AS monto_pagado,
               CASE WHEN o_orderstatus = 'O' THEN CAST(0 AS DECIMAL(38,9))
                    ELSE CAST(CAST(o_totalprice AS DECIMAL(19,2)) AS DECIMAL(38,9)) END AS monto_pagado_btc,
               CASE o_orderpriority WHEN '1-URGENT' THEN TRUE WHEN '2-HIGH' THEN FALSE
                    END AS fue_insuficiente,
               CASE WHEN o_totalprice > 400000 THEN TRUE END AS es_excedido,
               CASE WHEN o_custkey % 10 = 0 THEN TRUE END AS es_complementario,
               CAST(100 AS INTEGER) AS avance_pago,
               CASE WHEN o_custkey % 10 = 0 THEN o_custkey END AS complemento_de,
               CASE WHEN o_custkey % 10 = 0 THEN CAST(o_totalprice AS DECIMAL(19,2)) END AS monto_complementario,
               'W' || CAST(o_custkey % 20 AS STRING) AS wallet_destino,
               'H' || CAST(o_orderkey AS STRING) AS hash, o_orderpriority AS observaciones,
               o_orderdate AS fecha_pago, o_orderdate AS fecha_insert
        FROM {{orders}}""",
    "compras_texto": """
        SELECT compra, socio, prospecto, tipo_item, item, item2, estatus, forma_pago, promocion,
               wallet_destino, moneda, precio_btc, cotiza_btc, monto_pagado_btc, fue_insuficiente,
               es_complementario, complemento_de, fecha_pago, fecha_insert, referencia, referencia2,
               referencia3,
               CASE WHEN precio < 1000 THEN '$' || CAST(precio AS STRING)
                    ELSE '$' || SUBSTR(CAST(precio AS STRING), 1, LENGTH(CAST(precio AS STRING)) - 6) || ','
                         || SUBSTR(CAST(precio AS STRING), LENGTH(CAST(precio AS STRING)) - 5) END AS precio,
               '$' || CAST(monto_pagado AS STRING) AS monto_pagado
        FROM {compras}""",
    "productos": "SELECT p_partkey AS producto, p_name AS nombre FROM {part}",
    "plan_catalogue": """
        SELECT p_partkey AS id_producto,
               CASE p_partkey % 7 WHEN 0 THEN 'Plan Select ' || p_name WHEN 1 THEN 'select24 ' || p_name
                    WHEN 2 THEN p_name || ' Select36' WHEN 3 THEN 'SELECT 5x' WHEN 4 THEN 'Pa24'
                    WHEN 5 THEN p_name END AS nombre
        FROM {part}""",
    "promociones": """
        SELECT CAST(r_regionkey AS BIGINT) AS promocion, r_name AS nombre FROM {region}
        WHERE r_regionkey <> 3""",
    "socio_productos": """
        SELECT l_orderkey AS compra, l_suppkey AS socio, l_partkey AS producto,
               l_linestatus = 'O' AS activo,
               CASE l_returnflag WHEN 'N' THEN FALSE WHEN 'R' THEN TRUE END AS cerrado,
               CAST(l_extendedprice AS DECIMAL(19,2)) AS capital_inicial,
               CAST(l_extendedprice AS DECIMAL(19,2)) AS capital,
               CAST(CAST(l_extendedprice AS DECIMAL(19,2)) - CAST(l_quantity AS DECIMAL(19,2)) AS DECIMAL(19,2)) AS saldo,
               'USD' AS moneda, l_shipdate AS fecha_compra, l_shipdate AS fecha_inicio,
               CASE WHEN l_returnflag = 'R' THEN l_shipdate END AS fecha_cierre,
               l_linenumber AS estatus, l_linenumber > 3 AS plazo_forzoso,
               CASE WHEN l_linenumber < 3 THEN l_partkey END AS plan_base
        FROM {lineitem}""",
    "learning_compras": """
        SELECT o_custkey AS socio, o_orderkey AS item,
               CASE o_orderstatus WHEN 'F' THEN 4 WHEN 'O' THEN 6 ELSE -1 END AS estatus,
               CAST(1 + o_custkey % 2 AS INTEGER) AS forma_pago,
               CASE WHEN o_orderpriority = '5-LOW' THEN CAST(0 AS DECIMAL(19,2))
                    ELSE CAST(o_totalprice AS DECIMAL(19,2)) END AS precio,
               'USD' AS moneda, 'L' || CAST(o_orderkey AS STRING) AS referencia,
               CASE WHEN o_orderpriority <> '2-HIGH' THEN o_orderdate END AS fecha_pago,
               o_orderdate + INTERVAL '1' DAY AS fecha_pagado, o_orderpriority AS observaciones
        FROM {orders}""",
    "learning_curso": "SELECT p_partkey AS id_curso, p_name AS nombre, p_brand AS ponentes FROM {part}",
    # --- payments ---------------------------------------------------------------------
    "pagos": """
        SELECT event_id AS pago, user_id AS socio,
               CASE event_type WHEN 'purchase' THEN 0 WHEN 'signup' THEN 4
                    WHEN 'click' THEN CASE WHEN value > 20 THEN 18 ELSE 19 END
                    WHEN 'view' THEN 5 ELSE 7 END AS tipo,
               CASE WHEN event_type <> 'signup' OR value >= 20 THEN CAST(value AS DECIMAL(19,2))
                    WHEN value < 5 THEN CAST(500 AS DECIMAL(19,2))
                    WHEN value < 10 THEN CAST(1500 AS DECIMAL(19,2))
                    ELSE CAST(45000 AS DECIMAL(19,2)) END AS monto,
               CAST(CAST(value AS DECIMAL(19,2)) AS DECIMAL(38,9)) AS monto_pagado_btc,
               CAST(64000.25 AS DECIMAL(38,9)) AS cotiza_btc,
               CAST(CAST(CAST(value AS DECIMAL(19,2)) * 100 AS BIGINT) % 3 AS INTEGER) AS estatus,
               ts AS fecha, ts + INTERVAL '1' DAY AS fecha_pago,
               CASE WHEN CAST(CAST(value AS DECIMAL(19,2)) * 100 AS BIGINT) % 3 = 1
                    THEN ts + INTERVAL '2' DAY END AS fecha_pagado,
               CASE WHEN CAST(CAST(value AS DECIMAL(19,2)) * 100 AS BIGINT) % 3 = 2
                    THEN ts + INTERVAL '3' DAY END AS fecha_cancelacion,
               ts AS fecha_insert, event_type = 'click' OR event_type = 'view' AS defi,
               CASE WHEN event_id % 4 < 3 THEN CAST(event_id % 4 AS INTEGER) END AS mtd_dsp,
               CASE WHEN event_type <> 'error' THEN CAST(event_id AS STRING) END AS pago_tx
        FROM {events}""",
    "enumeracion": """
        SELECT n_nationkey AS codigo,
               CASE WHEN n_nationkey = 7 THEN 'Otra' ELSE 'TipoPago' END AS categoria,
               'Tipo ' || n_name AS nombre
        FROM {nation}""",
    "pagos_transacciones": """
        SELECT event_id AS pago_tx, user_id AS socio, CAST(value AS DECIMAL(19,2)) AS monto,
               ts AS fecha_pagado, 'W' || CAST(user_id AS STRING) AS wallet,
               CASE WHEN CAST(ts AS DATE) = DATE '2024-01-05' THEN CAST(0 AS DECIMAL(38,9))
                    ELSE CAST(CAST(value AS DECIMAL(19,2)) AS DECIMAL(38,9)) END AS monto_pagado_btc,
               CAST(64000.25 AS DECIMAL(38,9)) AS cotiza_btc,
               event_type || ' ' || props AS mensaje,
               CASE event_type WHEN 'error' THEN 2 WHEN 'view' THEN 0 ELSE 1 END AS estatus
        FROM {events}""",
    "pagos_transacciones_texto": """
        SELECT pago_tx, socio, CASE WHEN monto < 1 THEN '' ELSE '$' || CAST(monto AS STRING) END AS monto,
               fecha_pagado, wallet, CAST(monto_pagado_btc AS STRING) AS monto_pagado_btc,
               CASE WHEN monto < 2 THEN '' ELSE '64,000.25' END AS cotiza_btc, mensaje, estatus
        FROM {pagos_transacciones}""",
    # --- goals and dues ---------------------------------------------------------------
    "objetivos": """
        SELECT c_custkey AS id_socio_platinum,
               CAST(c_nationkey + 1 AS DECIMAL(19,2)) AS enero, CAST(c_nationkey + 2 AS DECIMAL(19,2)) AS febrero,
               CAST(c_nationkey + 3 AS DECIMAL(19,2)) AS marzo, CAST(c_nationkey + 4 AS DECIMAL(19,2)) AS abril,
               CAST(c_nationkey + 5 AS DECIMAL(19,2)) AS mayo, CAST(c_nationkey + 6 AS DECIMAL(19,2)) AS junio,
               CAST(c_nationkey + 7 AS DECIMAL(19,2)) AS julio, CAST(c_nationkey + 8 AS DECIMAL(19,2)) AS agosto,
               CAST(c_nationkey + 9 AS DECIMAL(19,2)) AS septiembre, CAST(NULL AS DECIMAL(19,2)) AS octubre,
               CAST(c_nationkey + 11 AS DECIMAL(19,2)) AS noviembre, CAST(c_nationkey + 12 AS DECIMAL(19,2)) AS diciembre
        FROM {customer} WHERE c_mktsegment <> 'BUILDING'""",
    "primerplatinum_simple": """
        SELECT c_custkey AS id_socio, CASE WHEN c_acctbal >= 0 THEN CAST(c_nationkey AS BIGINT) END AS id_platinum,
               CASE WHEN c_acctbal >= 0 THEN n_name END AS nombre_platinum, r_name AS region
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
             JOIN {region} ON n_regionkey = r_regionkey""",
    "vencimientos": """
        SELECT c_custkey AS id_socio,
               CASE WHEN c_acctbal >= 0 THEN DATE '1997-01-01' + CAST(c_custkey % 365 AS INTEGER)
                    END AS pago_anualidad
        FROM {customer}""",
    "ventas": """
        SELECT compra AS id_compra, socio AS id_socio, producto AS id_producto, capital AS precio,
               fecha_compra
        FROM {socio_productos} WHERE plan_base IS NULL""",
    # --- facts read by later jobs -------------------------------------------------------
    "fact_anualidades": """
        SELECT compra AS id_compra, socio AS id_socio, fecha_pago,
               CASE estatus WHEN 6 THEN 'Pagado' WHEN 5 THEN 'Expirado' ELSE 'Pendiente' END AS estatus,
               precio
        FROM {compras}""",
    # --- earlier states of targets ------------------------------------------------------
    "prev_dim_socios": """
        SELECT s.socio AS id_socio, s.nombre, s.apellido_pat AS apellido_paterno,
               s.apellido_mat AS apellido_materno, s.email,
               CASE WHEN s.estatus = 1 THEN 3 ELSE s.estatus END AS estatus, s.padre AS id_padre,
               CASE WHEN r.rango = 5 THEN NULL WHEN r.rango = 6 THEN 7 ELSE r.rango END AS id_rango_actual,
               s.fecha_ingreso,
               CASE WHEN s.estatus = 3 THEN DATE '1998-01-01' ELSE s.fecha_vigencia_membresia END
                   AS fecha_vigencia_membresia,
               CAST(NULL AS BIGINT) AS id_pais, CAST(NULL AS STRING) AS nombre_pais,
               'Inactivo' AS estatus_membresia_funcion,
               CASE WHEN r.saldo_personal > 9000 THEN r.saldo_organizacion - 1 ELSE r.saldo_organizacion END
                   AS saldo_organizacion,
               r.saldo_personal, r.directos AS socios_directos, r.directos_plan AS socios_directos_plan
        FROM {socios} s LEFT JOIN {v_socio_rangos_defi} r ON s.socio = r.socio
        WHERE s.fecha_ingreso < DATE '1998-01-01'""",
    "prev_dim_prospectos": """
        SELECT prospecto AS id_prospecto, CASE WHEN cultura = 'es' THEN tipo ELSE 0 END AS tipo, nombre,
               apellido_pat, apellido_mat, padre AS id_socio_padre, cultura AS lenguaje,
               CASE WHEN fecha_insert < DATE '1997-06-01' THEN nuevo_socio END AS id_socio,
               fecha_insert AS fecha_registro
        FROM {prospectos} WHERE fecha_insert < DATE '1997-09-01'""",
    "prev_primerplatinum": """
        SELECT socio AS id_socio, padre AS id_platinum, nombre AS nombre_platinum, 'Norte' AS region
        FROM {socios} WHERE fecha_ingreso < DATE '1997-06-01' AND estatus IN (1, 2, 3)""",
    "prev_retiros": """
        SELECT pago AS id_retiro, socio AS id_socio, tipo, monto, monto_pagado_btc AS monto_pagado_cripto,
               cotiza_btc AS cotiza_cripto, 0 AS estatus, fecha AS fecha_solicitud,
               CASE WHEN monto > 30 THEN fecha ELSE fecha_pago END AS fecha_pago_estimada,
               CASE WHEN monto > 5 THEN fecha_pagado END AS fecha_pago, fecha_cancelacion, defi
        FROM {pagos} WHERE tipo = 0 AND CAST(fecha AS DATE) < DATE '2024-01-20'""",
    "prev_masterbonus": """
        SELECT pago AS id_masterbonus, socio AS id_socio, monto, monto_pagado_btc AS monto_pagado_cripto,
               cotiza_btc AS cotiza_cripto,
               CASE WHEN monto > 100 THEN estatus ELSE 0 END AS estatus,
               CAST(fecha AS DATE) AS fecha_solicitud, CAST(fecha AS DATE) AS fk_fecha_solicitud,
               CAST(fecha_pago AS DATE) AS fecha_pago_estimada, CAST(fecha_pago AS DATE) AS fk_fecha_pago_estimada,
               CAST(fecha AS DATE) AS fecha_pagado, CAST(fecha AS DATE) AS fk_fecha_pagado,
               CAST(fecha_cancelacion AS DATE) AS fecha_cancelacion,
               CAST(fecha_cancelacion AS DATE) AS fk_fecha_cancelacion,
               NOT defi AS defi, 'BTC' AS moneda, CAST(pago AS INTEGER) AS pago_tx
        FROM {pagos} WHERE tipo = 4 AND CAST(fecha AS DATE) < DATE '2024-01-20'""",
    "prev_bonos": """
        SELECT pago AS id_retiro, socio AS id_socio, monto, monto_pagado_btc AS monto_pagado_cripto,
               cotiza_btc AS cotiza_cripto, estatus, fecha AS fecha_solicitud,
               CAST(fecha AS DATE) AS fk_fecha_solicitud,
               fecha_pago AS fecha_pago_estimada, CAST(fecha_pago AS DATE) AS fk_fecha_pago_estimada,
               CASE WHEN mtd_dsp = 2 THEN fecha_pagado END AS fecha_pagado,
               CAST(fecha_pagado AS DATE) AS fk_fecha_pagado,
               fecha_cancelacion, CAST(fecha_cancelacion AS DATE) AS fk_fecha_cancelacion,
               defi, 'BTC' AS moneda, CAST(pago AS INTEGER) AS pago_tx
        FROM {pagos} WHERE CAST(fecha AS DATE) < DATE '2024-01-20'""",
    "prev_ventas": """
        SELECT compra AS id_compra, socio AS id_socio, producto AS id_producto, 'antes' AS nombre_producto,
               activo, cerrado, capital_inicial, moneda, capital, saldo,
               CASE WHEN estatus < 7 THEN fecha_compra END AS fecha_compra, fecha_inicio,
               fecha_cierre, estatus, plazo_forzoso, plan_base, capital AS precio, 'x' AS tipo_pago
        FROM {socio_productos} WHERE plan_base IS NULL AND CAST(fecha_compra AS DATE) < DATE '1997-07-01'""",
    "prev_compras": """
        SELECT compra AS id_compra, socio AS id_socio, fue_insuficiente AS pago_insuficiente,
               CASE WHEN moneda = 'USD' THEN es_excedido END AS pago_excedido,
               CASE WHEN moneda = 'USD' THEN es_complementario ELSE FALSE END AS complemento,
               complemento_de AS id_complemento,
               CASE WHEN fue_insuficiente THEN 0 ELSE monto_complementario END AS monto_complementario,
               CASE WHEN estatus = 6 THEN 'Pagado' ELSE 'Pendiente' END AS estatus
        FROM {compras} WHERE CAST(fecha_pago AS DATE) < DATE '2000-01-01'""",
    "prev_agg": """
        SELECT 'OTROS' AS nombre, CAST(COUNT(*) AS BIGINT) AS cantidad,
               CAST(SUM(CAST(precio AS DECIMAL(19,2))) AS DECIMAL(29,2)) AS valor_total,
               CAST(fecha_compra AS DATE) AS fecha
        FROM {ventas} WHERE CAST(fecha_compra AS DATE) < DATE '1998-01-01'
        GROUP BY CAST(fecha_compra AS DATE)""",
    "prev_agg_bonos": """
        SELECT 'Tipo NATION_5' AS nombre, CAST(COUNT(*) AS BIGINT) AS cantidad,
               CAST(SUM(monto) AS DECIMAL(29,2)) AS valor_total, CAST(fecha_pagado AS DATE) AS fecha
        FROM {pagos} WHERE CAST(fecha AS DATE) < DATE '2024-01-10' GROUP BY CAST(fecha_pagado AS DATE)""",
    "prev_hist_membresias": """
        SELECT socio AS id_socio, estatus, fecha_ingreso, fecha_vigencia_membresia,
               TIMESTAMP '1997-01-01 00:00:00' AS fecha_registro
        FROM {socios} WHERE fecha_ingreso < DATE '1998-01-01'
        UNION ALL
        SELECT socio, CASE WHEN padre < 100 THEN 9 ELSE estatus END, fecha_ingreso,
               fecha_vigencia_membresia,
               CASE WHEN estatus = 2 THEN NULL ELSE TIMESTAMP '1996-01-01 00:00:00' END
        FROM {socios} WHERE fecha_ingreso < DATE '1997-06-01'""",
    "prev_hist_rangos": """
        SELECT socio AS id_socio, CASE WHEN rango < 20 THEN rango WHEN rango < 22 THEN 1 END AS id_rango,
               TIMESTAMP '1997-01-01 00:00:00' AS fecha_registro
        FROM {v_socio_rangos_defi} WHERE saldo_personal > 1000
        UNION ALL
        SELECT socio, 3, TIMESTAMP '1996-01-01 00:00:00' FROM {v_socio_rangos_defi}
        WHERE saldo_personal > 5000""",
    "prev_conciliacion_ventas": """
        SELECT compra, socio, prospecto, tipo_item, item, item2, 'antes' AS forma_pago, promocion,
               wallet_destino, CAST(0 AS DECIMAL(19,2)) AS precio, moneda, precio_btc, cotiza_btc,
               CAST(0 AS DECIMAL(19,2)) AS monto_pagado, monto_pagado_btc, fue_insuficiente,
               es_complementario, complemento_de, fecha_pago, fecha_insert, referencia2, referencia3,
               referencia, 'antes' AS nombre_del_producto, fecha_insert AS fecha_registro
        FROM {compras} WHERE CAST(fecha_pago AS DATE) < DATE '1998-01-01'""",
    "prev_conciliacion_pagos": """
        SELECT pago_tx, socio, CAST(0 AS DECIMAL(19,2)) AS monto, CAST(fecha_pagado AS DATE) AS fecha_pagado,
               wallet, monto_pagado_btc, cotiza_btc, 'antes' AS mensaje, fecha_pagado AS fecha_registro
        FROM {pagos_transacciones} WHERE CAST(fecha_pagado AS DATE) < DATE '2024-01-15'""",
    "prev_transacciones": """
        SELECT 'W' || CAST(user_id AS STRING) AS wallet_id, event_type AS tipo, 'BTC' AS moneda,
               CAST(value AS DECIMAL(38,9)) AS monto, 'k' || CAST(event_id AS STRING) AS kft_id
        FROM {events} WHERE CAST(ts AS DATE) < DATE '2024-01-15'""",
    "prev_compras_planes": """
        SELECT o_orderkey AS id_compra, '  ADDR ' || CAST(o_custkey AS STRING) AS address,
               CAST(CAST(o_totalprice AS DECIMAL(19,2)) + CASE WHEN o_orderpriority = '1-URGENT'
                    THEN 0.004 WHEN o_orderpriority = '2-HIGH' THEN 0.01 ELSE 0 END AS DECIMAL(20,3)) AS cantidad,
               CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_totalprice AS DECIMAL(20,2)) END AS monto_recibido,
               LOWER(o_orderstatus) AS status, o_orderdate AS fecha_pago,
               CASE WHEN o_orderstatus = 'F' THEN 'BTC' ELSE '' END AS coin,
               CASE WHEN o_custkey % 10 < 2 THEN o_custkey END AS complemento_de,
               CAST(o_totalprice AS DECIMAL(20,2)) AS usd, 'antes' AS wallet
        FROM {orders} WHERE CAST(o_orderdate AS DATE) < DATE '1999-01-01'""",
    "prev_pagos_planes": """
        SELECT event_id AS pago_tx,
               CAST(CAST(value AS DECIMAL(19,2)) + CASE WHEN event_type = 'view' THEN 0.004
                    WHEN event_type = 'click' THEN 0.01 ELSE 0 END AS DECIMAL(20,3)) AS amount,
               UPPER(event_type) AS asset, ' btc ' AS coin, CAST(64000.25 AS DECIMAL(20,2)) AS cotizacion,
               'done' AS estatus, 'tx' || CAST(event_id AS STRING) AS id_tx,
               CASE WHEN event_type = 'error' THEN '' ELSE 'W' || CAST(user_id AS STRING) END AS id_wallet,
               ts AS created_at, CAST(NULL AS STRING) AS address,
               CAST(value AS DECIMAL(38,9)) AS amount_crypto, 'usd' AS moneda, user_id AS socio
        FROM {events} WHERE CAST(ts AS DATE) < DATE '2024-01-15'""",
    "prev_customer": """
        SELECT c_custkey, c_name, c_nationkey,
               CASE WHEN c_mktsegment = 'BUILDING' THEN CAST(NULL AS DECIMAL(19,2))
                    WHEN c_mktsegment = 'MACHINERY' THEN CAST(c_acctbal + 1 AS DECIMAL(19,2))
                    ELSE CAST(c_acctbal AS DECIMAL(19,2)) END AS c_acctbal,
               CASE WHEN c_acctbal > 5000 THEN 'OLD' ELSE c_mktsegment END AS c_mktsegment
        FROM {customer} WHERE c_nationkey < 20""",
    "cur_customer": """
        SELECT c_custkey, c_name, c_nationkey,
               CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN CAST(NULL AS DECIMAL(19,2))
                    ELSE CAST(c_acctbal AS DECIMAL(19,2)) END AS c_acctbal, c_mktsegment
        FROM {customer}""",
    "cur_orders": """
        SELECT CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS socio,
               CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS dia,
               o_orderkey AS compra, CAST(o_totalprice AS DECIMAL(19,2)) AS precio
        FROM {orders}""",
    "prev_orders": """
        SELECT socio, dia, compra, precio FROM {cur_orders}
        WHERE precio < 250000 AND (socio IS NOT NULL OR dia < DATE '1998-01-01' OR dia IS NULL)""",
    "prev_part": """
        SELECT p_partkey AS producto, p_name AS nombre, CAST(p_retailprice AS DECIMAL(19,2)) AS precio,
               CAST(NULL AS TIMESTAMP) AS fecha_registro
        FROM {part} WHERE p_size <= 30""",
    "cur_part": """
        SELECT p_partkey AS producto, p_brand AS nombre, CAST(p_retailprice + 1 AS DECIMAL(19,2)) AS precio
        FROM {part} WHERE p_size >= 20""",
    "prev_part_noise": """
        SELECT p_partkey AS producto,
               CASE WHEN p_type = 'ECONOMY' THEN ' ' || UPPER(p_name) || ' ' WHEN p_type = 'LARGE' THEN p_name || 's'
                    ELSE p_name END AS nombre,
               CASE WHEN p_type = 'SMALL' THEN CAST(NULL AS STRING) ELSE '' END AS nota,
               CAST(CAST(p_retailprice AS DECIMAL(19,2)) + CASE WHEN p_type = 'PROMO' THEN 0.004
                    WHEN p_type = 'MEDIUM' THEN 0.01 ELSE 0 END AS DECIMAL(20,3)) AS precio
        FROM {part}""",
    "cur_part_noise": """
        SELECT p_partkey AS producto, p_name AS nombre, '' AS nota,
               CAST(CAST(p_retailprice AS DECIMAL(19,2)) AS DECIMAL(20,3)) AS precio
        FROM {part}""",
}


def needs(name: str) -> list[str]:
    """The tables a stand-in reads."""
    fields = (field for _, field, _, _ in string.Formatter().parse(STANDINS[name]) if field)
    return list(dict.fromkeys(fields))


class Tables:
    """Test tables and stand-ins of one folder as DataFrames: `tables("compras")`.

    Each is built once, so a query that reads a table twice shares its scan and exchanges.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder
        self.built: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        if name not in self.built:
            if name in BASE:
                self.built[name] = read_folder(self.spark, self.folder, name, BASE[name])
            else:
                self.built[name] = self.spark.sql(STANDINS[name], **{n: self(n) for n in needs(name)})
        return self.built[name]


def with_standins(names: list[str], body: str) -> str:
    """`body` preceded by the stand-ins it reads, as common table expressions."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name not in BASE and name not in ordered:
            for needed in needs(name):
                visit(needed)
            ordered.append(name)

    for name in names:
        visit(name)
    plain = {name: name for name in (*BASE, *STANDINS)}
    ctes = [f"{name} AS ({STANDINS[name].format(**plain)})" for name in ordered]
    return f"WITH {', '.join(ctes)}\n{body}" if ctes else body
