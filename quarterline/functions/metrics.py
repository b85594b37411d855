"""Metric vocabulary shared by every module."""

from __future__ import annotations

# The four core metrics and their reporting concepts, in order.
CORE_METRICS = ["revenue", "gross_profit", "operating_income", "net_income"]
CONCEPT_OF_METRIC = {
    "revenue": "RevenueFromContractWithCustomerExcludingAssessedTax",
    "gross_profit": "GrossProfit",
    "operating_income": "OperatingIncomeLoss",
    "net_income": "NetIncomeLoss",
}
# Metrics whose derived fourth quarter may not be negative.
NON_NEGATIVE_METRICS = ["revenue", "gross_profit"]

# Margin columns and the numerator each one uses.
MARGINS = {
    "gross_margin_pct": "gross_profit",
    "operating_margin_pct": "operating_income",
    "net_margin_pct": "net_income",
}
