"""Invented parameter values of the registered queries."""

from __future__ import annotations

import datetime as dt

from ledgerloom.checks.standins import HOUSE_ACCOUNT  # noqa: F401

YEAR = 1997
YEAR_START, YEAR_END = dt.date(1997, 1, 1), dt.date(1997, 12, 31)
SINCE, AS_OF = dt.date(1996, 1, 1), dt.date(2001, 12, 31)
EVENTS_START, EVENTS_END = dt.date(2024, 1, 1), dt.date(2024, 2, 2)
RUN_TS = "2024-06-30 12:00:00"
EXCLUDED_PARTNER = 3
EXCLUDED_PARTNERS = (1, 7)
EXCLUDED_PURCHASES = (11, 12)
LEADER_RANKS = ((18, 1), (19, 1))
REGIONS = {"Norte": (1, 2, 3, 4, 5, 6), "Centro": tuple(range(7, 40)), "Sur": (41, 42)}
KEYWORD = "CLICK"
BUY_WALLETS = ("W1", "W2", "W3", "W50")
PAY_WALLETS = ("W4", "W60")
NAME_PATTERNS = (
    ("%RED WIDGET%", "RED WIDGET"),
    ("%WIDGET%", "WIDGET"),
    ("%RING", "RING"),
    ("hot%", "HOT"),
    ("%PL%", "PL"),
)
CARD_ITEM_PRICES = {"795.00": "MEMBRESIA BASIC", "995.00": "MEMBRESIA PREMIUM"}
