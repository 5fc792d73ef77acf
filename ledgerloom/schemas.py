"""Column types of the warehouse tables."""

from __future__ import annotations

_BONUS = (
    "id_socio BIGINT, monto DECIMAL(19,2), monto_pagado_cripto DECIMAL(38,9), cotiza_cripto DECIMAL(38,9), "
    "estatus INT, fecha_solicitud DATE, fk_fecha_solicitud DATE, fecha_pago_estimada DATE, "
    "fk_fecha_pago_estimada DATE, fecha_pagado DATE, fk_fecha_pagado DATE, fecha_cancelacion DATE, "
    "fk_fecha_cancelacion DATE, defi BOOLEAN, moneda STRING, pago_tx INT"
)
_PURCHASE = (
    "id_compra BIGINT, id_socio BIGINT, id_prospecto BIGINT, fecha_pago TIMESTAMP, forma_pago STRING, "
    "estatus STRING, promocion STRING, tipo_plan STRING, tipo_smartpack STRING, tipo_producto STRING, "
    "precio DECIMAL(19,2), moneda STRING, precio_btc DECIMAL(38,9), cotiza_btc DECIMAL(38,9), "
    "cotiza_btc2 DECIMAL(38,9), monto_pagado DECIMAL(19,2), monto_pagado_btc DECIMAL(38,9), "
    "pago_insuficiente BOOLEAN, pago_excedido BOOLEAN, avance_pago INT, complemento BOOLEAN, "
    "id_complemento BIGINT, monto_complementario DECIMAL(19,2)"
)
_MONTH = "mes DATE, total_pagos BIGINT, total_ingresos DECIMAL(38,2)"
_LANDED = (
    "sin_id BIGINT, _landed STRUCT<landed: STRUCT<at: TIMESTAMP, file: STRING, block: BIGINT, line: BIGINT>, "
    "_place: INT>"
)
_BUCKET = "nombre STRING, cantidad BIGINT, valor_total DECIMAL(38,2), fecha DATE"

_STATUS = (
    "id_socio BIGINT, estatus INT, fecha_ingreso TIMESTAMP, fecha_vigencia_membresia DATE, "
    "fecha_registro TIMESTAMP"
)
_RANK = "id_socio BIGINT, id_rango INT, fecha_registro TIMESTAMP"

WAREHOUSE: dict[str, str] = {
    "dim_socios": "id_socio BIGINT, nombre STRING, apellido_paterno STRING, apellido_materno STRING, email STRING, "
    "estatus INT, id_padre BIGINT, id_rango_actual INT, fecha_ingreso TIMESTAMP, fecha_vigencia_membresia DATE, "
    "id_pais BIGINT, nombre_pais STRING, estatus_membresia_funcion STRING, saldo_organizacion DECIMAL(19,2), "
    "saldo_personal DECIMAL(19,2), socios_directos INT, socios_directos_plan INT",
    "dim_prospectos": "id_prospecto BIGINT, tipo INT, nombre STRING, apellido_pat STRING, apellido_mat STRING, "
    "id_socio_padre BIGINT, lenguaje STRING, id_socio BIGINT, interes_formacion INT, interes_ahorro INT, "
    "interes_networking INT, interes_emprendimiento INT, pais BIGINT, genero STRING, nombre_pais STRING, "
    "fecha_registro TIMESTAMP",
    "dim_primerplatinum": "id_socio BIGINT, id_platinum BIGINT, nombre_platinum STRING, region STRING",
    "dim_metas_socios": "fecha DATE, id_platinum BIGINT, nombre_platinum STRING, region STRING, "
    "total_real BIGINT, total_objetivo DECIMAL(19,2)",
    "dim_metas_planes": "fecha DATE, id_platinum BIGINT, nombre_platinum STRING, region STRING, "
    "total_real DECIMAL(38,2), total_objetivo DECIMAL(19,2)",
    "fact_wallets": "wallet_id STRING, coin STRING, saldo DECIMAL(38,9), tipo STRING",
    "fact_retiros": "id_retiro BIGINT, id_socio BIGINT, tipo INT, monto DECIMAL(19,2), "
    "monto_pagado_cripto DECIMAL(38,9), cotiza_cripto DECIMAL(38,9), estatus INT, fecha_solicitud TIMESTAMP, "
    "fecha_pago_estimada TIMESTAMP, fecha_pago TIMESTAMP, fecha_cancelacion TIMESTAMP, defi BOOLEAN",
    "fact_ventas": "id_compra BIGINT, id_socio BIGINT, id_producto BIGINT, nombre_producto STRING, activo BOOLEAN, "
    "cerrado BOOLEAN, capital_inicial DECIMAL(19,2), moneda STRING, capital DECIMAL(19,2), saldo DECIMAL(19,2), "
    "fecha_compra TIMESTAMP, fecha_inicio TIMESTAMP, fecha_cierre TIMESTAMP, estatus INT, plazo_forzoso BOOLEAN, "
    "plan_base BIGINT, precio DECIMAL(19,2), tipo_pago STRING, anio INT",
    "fact_masterbonus": f"id_masterbonus BIGINT, {_BONUS}",
    "fact_bonos_comisiones": f"id_retiro BIGINT, {_BONUS}",
    "fact_anualidades": _PURCHASE,
    "fact_membresias": _PURCHASE,
    "fact_transacciones_internas": "wallet_id STRING, tipo STRING, moneda STRING, monto DECIMAL(38,9), "
    "kft_id STRING",
    "fact_kft_compras_planes": "id_compra BIGINT, address STRING, cantidad DECIMAL(20,2), "
    "monto_recibido DECIMAL(20,2), status STRING, fecha_pago TIMESTAMP, coin STRING, complemento_de BIGINT, "
    "usd DECIMAL(20,2), wallet STRING",
    "fact_kft_pagos_planes": "pago_tx BIGINT, amount DECIMAL(20,2), asset STRING, coin STRING, "
    "cotizacion DECIMAL(20,2), estatus STRING, id_tx STRING, id_wallet STRING, created_at TIMESTAMP, "
    "address STRING, amount_crypto DECIMAL(38,9), moneda STRING, socio BIGINT",
    "fact_planes_adicionales_selected": "fecha_compra DATE, nombre STRING, valor_contrato DECIMAL(18,2), "
    "cantidad_de_select BIGINT, valor_total DECIMAL(38,2)",
    "fact_cliente_liabilities": "id_socio BIGINT, pasivo_productos DECIMAL(38,2), "
    "pasivo_pagos_pendientes DECIMAL(38,2), liabilities DECIMAL(38,2), fecha_insert TIMESTAMP",
    "fact_cliente_porcentajes_pago": "id_socio BIGINT, pasivo_pagos_pendientes DECIMAL(38,2), "
    "pasivo_pagos_realizados DECIMAL(38,2), porcentajes_pago DOUBLE, fecha_insert TIMESTAMP",
    "fact_recompra_planes": "mes DATE, total_compras BIGINT, primeras_compras BIGINT, recompras BIGINT, "
    "pct_recompra DECIMAL(22,2), fecha_insert TIMESTAMP",
    "fact_porcentajes_anualidades": "mes_venc DATE, retenido BIGINT, abandono BIGINT, recuperado BIGINT, "
    "total_mes BIGINT, pct_retencion DECIMAL(22,2), pct_abandono DECIMAL(22,2), "
    "pct_recuperacion DECIMAL(22,2), fecha_insert TIMESTAMP",
    "fact_balance": "fecha DATE, anualidades DECIMAL(38,2), membresias DECIMAL(38,2), venta_planes DECIMAL(38,2), "
    "bonos_y_comisiones DECIMAL(38,2), masterbonos DECIMAL(38,2), retiros DECIMAL(38,2), total DECIMAL(38,2), "
    "fecha_insert TIMESTAMP",
    "fact_conciliacion_ventas": "compra BIGINT, socio BIGINT, prospecto BIGINT, tipo_item INT, item BIGINT, "
    "item2 BIGINT, forma_pago STRING, promocion BIGINT, wallet_destino STRING, precio DECIMAL(19,2), "
    "moneda STRING, precio_btc DECIMAL(38,9), cotiza_btc DECIMAL(38,9), monto_pagado DECIMAL(19,2), "
    "monto_pagado_btc DECIMAL(38,9), fue_insuficiente BOOLEAN, es_complementario BOOLEAN, "
    "complemento_de BIGINT, fecha_pago TIMESTAMP, fecha_insert TIMESTAMP, referencia2 STRING, "
    "referencia3 STRING, referencia STRING, nombre_del_producto STRING, fecha_registro TIMESTAMP",
    "fact_conciliacion_pagos": "pago_tx BIGINT, socio BIGINT, monto DECIMAL(19,2), fecha_pagado DATE, "
    "wallet STRING, monto_pagado_btc DECIMAL(38,9), cotiza_btc DECIMAL(38,9), mensaje STRING, "
    "fecha_registro TIMESTAMP",
    "hist_membresias": _STATUS,
    "hist_rangos": _RANK,
    "agg_fact_anualidades": _MONTH,
    "agg_fact_membresias": _MONTH,
    "agg_planes": _BUCKET,
    "agg_bonos": _BUCKET,
    "aum_pass": "fecha_ultimo_plan DATE, saldo_total_productos DECIMAL(38,2), "
    "capital_inicial_total_productos DECIMAL(38,2)",
    "aum_bonos": "fecha_ultimo_bono DATE, bonos_a_pagar DECIMAL(38,2)",
    "aum_bonos_select": "fecha_ultimo_pago DATE, tipo_select STRING, valor_contrato DECIMAL(18,2), "
    "cantidad_de_select BIGINT, valor_total DECIMAL(38,2)",
    "aum_bonos_select_actual": "tipo_bono STRING, total DECIMAL(38,2)",
    "migration_logs": "estatus STRING, tabla STRING, proceso STRING, registros_insertados BIGINT, "
    "error_text STRING, fecha_registro TIMESTAMP",
    "parciales_planes": "id_producto BIGINT, fecha DATE, n BIGINT, valor DECIMAL(38,2), anio INT",
    # the last version of each landed record, as text, so that filters see what the endpoint holds now
    "estado_compras_planes": f"_id STRING, id_compra STRING, address STRING, cantidad STRING, Monto_recibido STRING, "
    f"status STRING, Fecha_pago STRING, coin STRING, complemento_de STRING, USD STRING, wallet STRING, "
    f"`Created Date` STRING, {_LANDED}",
    "estado_pagos_planes": f"id_pago STRING, amount STRING, Asset STRING, coin STRING, cotizacion STRING, "
    f"status STRING, id_tx STRING, id_wallet STRING, `Created Date` STRING, address STRING, amount_cripto STRING, "
    f"moneda STRING, socio STRING, {_LANDED}",
    "rejected_pages": "origen STRING, payload STRING, fecha_registro TIMESTAMP",
}

# Facts that grow by ascending ids and are updated in place: partitioned by blocks of the id, so that
# an update rewrites the blocks it changes, mostly the latest.  The block follows from the key.
BLOCK = "tramo"
BLOCK_SIZE = 50_000_000
BLOCKED = {
    "fact_retiros": "id_retiro",
    "fact_masterbonus": "id_masterbonus",
    "fact_bonos_comisiones": "id_retiro",
    "fact_kft_compras_planes": "id_compra",
    "fact_kft_pagos_planes": "pago_tx",
}
#: Tables that keep the last version of each landed record, by the pages they come from, and their id,
#: a text that ends in a number; its block is -1 where it does not.
RECORD_STATES = {
    "purchase_pages": ("estado_compras_planes", "id_compra"),
    "payout_pages": ("estado_pagos_planes", "id_pago"),
}
#: History logs, written run by run, and the tables that keep the last record of each key beside them.
RUN = "corrida"
HISTORY_STATES = {"hist_membresias": "estado_membresias", "hist_rangos": "estado_rangos"}
for _log, _state in HISTORY_STATES.items():
    WAREHOUSE[_state] = WAREHOUSE[_log]
    WAREHOUSE[_log] += f", {RUN} STRING"

_STATES = [*[table for table, _ in RECORD_STATES.values()], *HISTORY_STATES.values()]
for _table in [*BLOCKED, *_STATES]:
    WAREHOUSE[_table] += f", {BLOCK} BIGINT"

PARTITIONED = {
    "fact_ventas": "anio",
    "parciales_planes": "anio",
    **dict.fromkeys([*BLOCKED, *_STATES], BLOCK),
    **dict.fromkeys(HISTORY_STATES, RUN),
}
