"""Label columns: payment methods, statuses, products and buckets.

All of them are first-match `CASE` chains built from short fixed tables, so they stay inside
whole-stage code generation and need no join.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fixed


def first_match(cases: Iterable[tuple[Column, Column | object]], otherwise: object = None) -> Column:
    """Value of the first condition that holds; `otherwise` when none does."""
    chain = F.when(F.lit(False), None)
    for condition, value in cases:
        chain = chain.when(condition, value)
    return chain.otherwise(otherwise)


def label_of(code: Column, labels: Mapping, otherwise: object = None) -> Column:
    """Label by exact code."""
    return first_match(((code == F.lit(key), label) for key, label in labels.items()), otherwise)


def class_of(code: Column, groups: Mapping[str, Iterable], otherwise: object = None) -> Column:
    """Name of the first id list that holds the code."""
    return first_match(((code.isin(*ids), name) for name, ids in groups.items() if ids), otherwise)


def bucket_of(name: Column, patterns: Iterable[tuple[str, str]], otherwise: str) -> Column:
    """First case-insensitive pattern the name fits."""
    return first_match(((name.ilike(pattern), bucket) for pattern, bucket in patterns), otherwise)


def payment_method(rules: Iterable[tuple], house_account: str, otherwise: str | None = "x") -> Column:
    """Label of the payment method from method, entity and the three references."""
    reference, second, third = F.col("referencia"), F.col("referencia2"), F.col("referencia3")
    extra = {
        "": F.lit(True),
        "trx": reference.ilike(fixed.TRANSFER_PREFIX),
        "house": second.isNull() | (second == F.lit(house_account)),
        "ref2": second.isNotNull(),
    }

    def fits(methods: tuple, entity: int | None, condition: str) -> Column:
        test = F.col("forma_pago").isin(*methods)
        if entity is not None:
            test = test & (F.col("entidad_pago") == entity)
        if condition.startswith("ref3="):
            return test & (third == F.lit(condition.removeprefix("ref3=")))
        return test & extra[condition] if condition else test

    return first_match(((fits(m, e, c), label) for m, e, c, label in rules), otherwise)


def purchase_status(code: Column) -> Column:
    """Status label, NULL for unknown codes."""
    return label_of(code, fixed.PURCHASE_STATUS)


def coin(method: Column) -> Column:
    """Coin a payment was sent in; the default also covers a missing method."""
    return label_of(method, fixed.COIN_BY_METHOD, fixed.OTHER_COIN)


def full_name(prefix: str = "") -> Column:
    """Trimmed name parts; NULL as soon as one part is missing."""
    parts = [F.trim(F.col(prefix + p)) for p in ("nombre", "apellido_pat", "apellido_mat")]
    return F.concat(parts[0], F.lit(" "), parts[1], F.lit(" "), parts[2])
