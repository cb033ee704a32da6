"""Scalar column functions (F1-F12 of the survey)."""

from .expressions import (
    MONEY,
    aggregate_identifier,
    bit64_text,
    cents_to_money,
    day,
    identifier_hex,
    money,
    money_cents,
)

__all__ = [
    "MONEY",
    "aggregate_identifier",
    "bit64_text",
    "cents_to_money",
    "day",
    "identifier_hex",
    "money",
    "money_cents",
]
