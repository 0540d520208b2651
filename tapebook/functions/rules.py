"""Business rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label -> (open-market flag, class).
TRADE_RULES = {
    "P - Purchase": (1, "OPEN_MARKET"),
    "S - Sale": (1, "OPEN_MARKET"),
    "S - Sale+OE": (0, "OPTION_EXERCISE"),
    "F - Tax": (0, "OTHER"),
}


def _by_label(label: Column, index: int) -> Column:
    pairs = [F.lit(v) for k, rule in TRADE_RULES.items() for v in (k, rule[index])]
    return F.try_element_at(F.create_map(*pairs), label)


def open_market_flag(label: Column) -> Column:
    """1 or 0 for the known labels, NULL otherwise."""
    return _by_label(label, 0).cast("int")


def classification(label: Column) -> Column:
    """Class of a known label; OTHER for an unknown one, UNKNOWN for none."""
    return F.when(label.isNull(), "UNKNOWN").otherwise(F.coalesce(_by_label(label, 1), F.lit("OTHER")))


def trade_value(price: Column, qty: Column) -> Column:
    return price * qty


def marks_amendment(flags: Column) -> Column:
    """Does a newly inserted row retire its predecessors? Upper-case ``A`` only."""
    return F.coalesce(F.contains(flags, F.lit("A")), F.lit(False))


def counts_as_amendment(flags: Column) -> Column:
    """Is a stored row an amendment for reconciliation? ``A`` in either case."""
    return F.coalesce(flags.ilike("%A%"), F.lit(False))


def status_after_failure(status: Column) -> Column:
    """Retired symbols stay retired, blank ones go on watch, others keep their status."""
    return F.when(status.isNull() | (status == ""), "WATCH").otherwise(status)


def status_after_success(status: Column) -> Column:
    return F.coalesce(status, F.lit("ACTIVE"))


def exclusion_in_force(as_of: Column, active: str = "is_active", expires: str = "expires_at") -> Column:
    return (F.col(active) == 1) & (F.col(expires).isNull() | (F.col(expires) > as_of))
