"""Codes, labels, names and patterns that results must carry as they are.

Nothing here identifies a person, a wallet or a bank account; those are parameters of the
jobs that need them.
"""

from __future__ import annotations

from decimal import Decimal

# Purchase status codes and their labels.
PURCHASE_STATUS = {
    -2: "Estatus manual de cambio",
    -1: "Cancelado en Flexbit",
    0: "Creado",
    1: "Pendiente",
    2: "En proceso",
    3: "Pago incompleto",
    4: "Transitorio se dispara un proceso que realiza desarrollo",
    5: "Expirado",
    6: "Pagado",
}
PAID_PURCHASE = 6
PAID_LABEL = "Pagado"
UNKNOWN_LABEL = "No identificado"

# Payment-method labels.  Each rule is (methods, entity, condition, label); the
# first rule that fits wins.  Conditions: "" none; "trx" the first reference starts with the
# transfer prefix; "ref3=..." the third reference equals the text; "house" the second reference
# is missing or is the house account; "ref2" the second reference is present.
TRANSFER_PREFIX = "TRX-%"
UNKNOWN_METHOD = "x"
MEMBERSHIP_METHODS_OPEN = (
    ((1,), None, "", "BTC"),
    ((2,), 1, "", "FIAT - OpenPay"),
    ((2,), 2, "", "FIAT - Banorte"),
    ((3,), None, "trx", "FLEXPAY - TRX_CNKT_POL"),
    ((3,), None, "ref3=BTC", "FLEXPAY - BTC"),
    ((3,), None, "ref3=CNKT_POL", "FLEXPAY - CNKT_POL"),
    ((3,), None, "ref3=USDT_TRON", "FLEXPAY - USDT_TRON"),
    ((0,), None, "", "Bono único"),
    ((6,), None, "", "Transferencia"),
    ((4,), None, "", "Polygon - CNKT"),
    ((5,), None, "", "Polygon - BTC"),
    ((7,), None, "", "Polygon - USDT"),
    ((8,), None, "", "FIAT - STRIPE"),
)
MEMBERSHIP_METHODS = MEMBERSHIP_METHODS_OPEN + (
    ((10,), None, "", "LINK PAGO - OPENPAY"),
    ((11,), None, "", "LINK PAGO - PAYONEER"),
    ((6, 9), 1, "ref2", "FIAT - TRX - STP"),
    ((12,), None, "", "Polygon - CNKT+"),
)
SALES_METHODS_OPEN = (
    ((1,), None, "", "BTC"),
    ((2,), 1, "", "FIAT - OpenPay"),
    ((2,), 2, "", "FIAT - Banorte"),
    ((3,), None, "trx", "FLEXPAY - TRX_CNKT"),
    ((3,), None, "ref3=BTC", "FLEXPAY - BTC"),
    ((3,), None, "ref3=CNKT_POL", "FLEXPAY - CNKT_POL"),
    ((3,), None, "ref3=USDT_TRON", "FLEXPAY - USDT_TRON"),
    ((0,), None, "", "Bono único"),
    ((6,), 1, "house", "FIAT - TRX - BBVA"),
    ((6,), 1, "ref2", "FIAT - TRX - STP"),
    ((4,), None, "", "Polygon - CNKT"),
    ((5,), None, "", "Polygon - BTC"),
    ((7,), None, "", "Polygon - USDT"),
    ((8,), None, "", "FIAT - STRIPE"),
)
ANNUITY_METHODS_OPEN = SALES_METHODS_OPEN + (((10,), None, "", "LINK PAGO - OPENPAY"),)
ANNUITY_METHODS = ANNUITY_METHODS_OPEN + (
    ((6, 9), 1, "ref2", "FIAT - TRX - STP"),
    ((12,), None, "", "Polygon - CNKT+"),
)
SALES_METHODS = SALES_METHODS_OPEN + (
    ((6, 9), 1, "ref2", "FIAT - TRX - STP"),
    ((12,), None, "", "Polygon - CNKT+"),
)
ONCHAIN_METHODS = {4: "Polygon - CNKT", 5: "Polygon - BTC", 7: "Polygon - USDT"}
GATEWAY_METHODS = {1: "BTC", 2: "OPENPAY"}
GATEWAY_UNKNOWN = "X"
CARD_METHOD = 2
CARD_GATEWAY = "OPENPAY"

# Item types of a purchase and the product classes named after them.
MEMBERSHIP_ITEM = 1
ANNUITY_ITEM = 5
NON_PLAN_ITEMS = (1, 3, 5)
MEMBERSHIP_OF_PARTNER = "Membresia Zero"
MEMBERSHIP_OF_PROSPECT = "Membresia"
ANNUITY_PRODUCT = "Mantenimiento"
RECONCILED_PRODUCTS = {5: "Mantenimiento", 1: "Membresia"}
RECONCILED_OTHER = "Planes"

# Report labels.
COMPLETED, RETURNED = "COMPLETADA", "DEVOLUCIÓN"
MAINTENANCE_PRODUCT = "MANTENIMIENTO"
MEMBERSHIP_PRICES = {
    Decimal("795.00"): "MEMBRESIA BASIC",
    Decimal("995.00"): "MEMBRESIA PREMIUM",
}

# Partner status codes, membership status codes and their two labels.
ACTIVE_PARTNERS = (1, 2)
VALID_MEMBERSHIPS = (1, 2, 3, 7)
ACTIVE, INACTIVE = "Activo", "Inactivo"
NO_REGION = "Sin Region"

# Payment types, statuses, coins, and the category of payment types.
WITHDRAWAL_TYPE = 0
MASTER_BONUS_TYPE = 4
PENDING_PAYMENT, PAID_PAYMENT = 0, 1
PAYMENT_CATEGORY = "TipoPago"
COIN_BY_METHOD = {2: "CNKT"}
OTHER_COIN = "BTC"
PENDING_BONUS_EXCLUDED = (18, 19, 20)
REPORTED_BONUS_TYPES = (0, 1, 2, 3, 5, 6, 7, 8, 11, 12, 13, 14, 15, 18, 19, 20, 22)
MASTER_BONUS_TIERS = {
    Decimal("500.00"): "MASTER BONUS JUNIOR",
    Decimal("1500.00"): "MASTER BONUS SENIOR",
    Decimal("5000.00"): "MASTER BONUS TRAINER",
    Decimal("10000.00"): "MASTER BONUS MANAGER",
    Decimal("20000.00"): "MASTER BONUS ELITE",
    Decimal("45000.00"): "MASTER BONUS SUPERIOR",
    Decimal("100000.00"): "MASTER BONUS PLATINUM",
}
MASTER_BONUS_OTHER = "MASTER BONUS NO IDENTIFICADO"
REPORTED_TRANSFER_STATUS = (1, 0)

# Contract products (product, name, shown value, years to the last payment).
SELECT_CONTRACTS = (
    (280, "Select 3x", "$60,000.00", 1),
    (281, "Select 4x", "$80,000.00", 1),
    (282, "Select 5x", "$100,000.00", 1),
    (283, "Select 8x", "$160,000.00", 2),
    (284, "Select 9x", "$180,000.00", 2),
    (285, "Select 10x", "$200,000.00", 2),
)
PASS_EXCLUDED_PRODUCTS = (280, 281, 282)
SELECT_BONUSES = {
    18: "Bono Select 3x",
    19: "Bono Select 4x",
    20: "Bono Select 5x",
    28: "Bono Select 8x",
    29: "Bono Select 9x",
    30: "Bono Select 10x",
}

# Plan buckets by name pattern; the first pattern that fits wins.
PLAN_BUCKETS = (
    ("%PLAN SELECT%", "PLAN SELECT"),
    ("%SELECT24%", "SELECT24"),
    ("%SELECT36%", "SELECT36"),
    ("%SELECT%", "SELECT"),
    ("%PA%", "PA / PA24"),
)
PLAN_BUCKET_OTHER = "OTROS"

# Month columns of the goal tables, January first.
GOAL_MONTHS = (
    "enero", "febrero", "marzo", "abril", "mayo", "junio",
    "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre",
)

# Wallet classes, retention states, prefix of payout ids.
WALLET_BUYS, WALLET_PAYS, WALLET_OTHER = "compra", "pago", "otro"
PAYOUT_PREFIX = "PA"
