"""Alert rules, severities and gauge levels as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Rule names, thresholds and labels, in the order in which rules are reported.
RULES = {
    "SHUTDOWN": "status = 'SHUTDOWN'",
    "LOW_FLOW_OVERHEAT": "flow_rate < 60 AND motor_temperature > 120 AND NOT isnan(motor_temperature)",
    "HIGH_VIBRATION_CURRENT": "vibration > 12 AND motor_current > 75 AND NOT isnan(vibration) AND NOT isnan(motor_current)",
    "HIGH_TUBING_LOW_FLOW": "tubing_pressure > 900 AND flow_rate < 60 AND NOT isnan(tubing_pressure)",
    "GAS_SLUG_SIMULATION": "scenario = 'gas_slug'",
}
LABELS = {
    "SHUTDOWN": "pump shutdown",
    "LOW_FLOW_OVERHEAT": "low flow + motor overheating",
    "HIGH_VIBRATION_CURRENT": "high vibration + elevated current",
    "HIGH_TUBING_LOW_FLOW": "high tubing pressure + low flow",
    "GAS_SLUG_SIMULATION": "gas-slug simulation",
}
COOLDOWN = 300_000_000


def holds(rule: str) -> Column:
    """Whether a rule holds for a row; a null or NaN reading never triggers."""
    return F.coalesce(F.expr(RULES[rule]), F.lit(False))


def triggered() -> Column:
    """Array of the names of the rules that hold, in the fixed order."""
    return F.array_compact(F.array(*[F.when(holds(r), F.lit(r)) for r in RULES]))


def severity(rules: Column) -> Column:
    """normal without rules; critical for a shutdown or two rules and more; else warning."""
    return F.when(F.size(rules) == 0, "normal").when(F.array_contains(rules, "SHUTDOWN") | (F.size(rules) >= 2), "critical").otherwise("warning")


def shown_severity(low_flow_scenario: bool = True) -> Column:
    """The severity that a latest state is shown with, if no finding is stored; its first matching case holds."""
    c = F.when(holds("SHUTDOWN") | holds("LOW_FLOW_OVERHEAT") | holds("HIGH_VIBRATION_CURRENT"), "critical").when(F.col("flow_rate") < 60, "warning")
    return (c.when(F.col("scenario") == "low_flow", "warning") if low_flow_scenario else c).otherwise("normal")


def level(value: Column, warn: float | None, critical: float | None, below: bool = False, reach: bool = True) -> Column:
    """normal, warning or critical of a gauge; unknown for null and NaN. `below`: low values are bad; else a limit is broken when reached, or (reach=False) exceeded."""
    over = lambda limit: value < limit if below else value >= limit if reach else value > limit
    out = F.when(value.isNull() | F.isnan(value), "unknown")
    if critical is not None:
        out = out.when(over(critical), "critical")
    if warn is not None:
        out = out.when(over(warn), "warning")
    return out.otherwise("normal")
