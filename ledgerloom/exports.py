"""The fourteen finance reports by name, and writing them to a folder."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame

from ledgerloom.plans import reports
from ledgerloom.sources.reports import write_report

Sources = Mapping[str, DataFrame]

REPORTS: dict[str, Callable[[Sources], DataFrame]] = {
    "active_partners": lambda s: reports.active_partners(s["socios"]),
    "maintenance_gateway": lambda s: reports.maintenance_gateway(s["compras"], s["socios"]),
    "courses": lambda s: reports.courses(s["learning_compras"], s["learning_curso"], s["socios"]),
    "memberships_gateway": lambda s: reports.memberships_gateway(
        s["compras"], s["prospectos"], s["socios"]
    ),
    "maintenance_all": lambda s: reports.maintenance_all(s["compras"]),
    "memberships_all": lambda s: reports.memberships_all(s["compras"], s["prospectos"], s["socios"]),
    "bonus_daily": lambda s: reports.bonus_daily(s["pagos"], s["enum"]),
    "bonus_tiers": lambda s: reports.bonus_tiers(s["pagos"], s["enum"]),
    "inflows": lambda s: reports.inflows(s["pagos_transacciones"]),
    "outflows": lambda s: reports.outflows(s["pagos_transacciones"]),
    "aum_products": lambda s: reports.aum_products(s["socio_productos"], s["socios"]),
    "aum_pending": lambda s: reports.aum_pending(s["pagos"]),
    "aum_contracts": lambda s: reports.aum_contracts(s["socio_productos"], s["socios"]),
    "aum_contract_bonuses": lambda s: reports.aum_contract_bonuses(s["pagos"], s["socio_productos"]),
}


def export(
    sources: Sources,
    folder: str,
    kind: str = "csv",
    names: Sequence[str] | None = None,
    excluded_partners: Sequence[int] = (),
) -> None:
    """Write the reports (or the named ones), each to `folder/<name>`.

    `excluded_partners` are left out of the list of active partners.
    """
    for name in REPORTS if names is None else names:
        if name == "active_partners":
            report = reports.active_partners(sources["socios"], excluded_partners)
        else:
            report = REPORTS[name](sources)
        write_report(report, f"{folder}/{name}", kind)
