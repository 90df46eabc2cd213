"""Vocabulary that the builders and the currency operators share."""

from __future__ import annotations

# The pivot of all currency conversions; indexes loaded when none are asked for.
PIVOT_CURRENCY = "CNY"
DEFAULT_INDEXES = ("SEC024342013", "SEC023059609", "SEC023392778", "SEC024022199", "SEC045336986")
