"""Small scalar rules shared by the operators."""

from __future__ import annotations

import math
import re
from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

PASS, WARN, BREACH, NOT_EVALUATED = "PASS", "WARN", "BREACH", "NOT_EVALUATED"
SEVERITY = {PASS: "INFO", WARN: "WARNING", BREACH: "ERROR", NOT_EVALUATED: "INFO"}

LOGIT_EPSILON = 1e-7
ZONED_TIME = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?\s*(Z|[+-]\d{2}:?\d{2})$"


def status(observed: Column, warn: Column, breach: Column) -> Column:
    """Inclusive thresholds; a NULL observation is not evaluated."""
    return (
        F.when(observed.isNull(), F.lit(NOT_EVALUATED))
        .when(observed >= breach, F.lit(BREACH))
        .when(observed >= warn, F.lit(WARN))
        .otherwise(F.lit(PASS))
    )


def severity(status_column: Column) -> Column:
    out = F.lit("INFO")
    for name in (WARN, BREACH):
        out = F.when(status_column == name, F.lit(SEVERITY[name])).otherwise(out)
    return out


def severity_rank(status_column: Column) -> Column:
    return F.when(status_column == BREACH, 2).when(status_column == WARN, 1).otherwise(0)


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))


def clip(number: Column, low: float, high: float) -> Column:
    """Bounded number; NULL and NaN give NULL, never a bound."""
    known = number.isNotNull() & ~F.isnan(number)
    return F.when(known, F.greatest(F.least(number, F.lit(high)), F.lit(low)))


def logit(probability: Column, epsilon: float = LOGIT_EPSILON) -> Column:
    clipped = clip(probability, epsilon, 1.0 - epsilon)
    return F.ln(clipped / (F.lit(1.0) - clipped))


def round_half_even(value: float) -> int:
    return int(round(value))


def zoned_timestamp(text: Column) -> Column:
    """ISO-8601 text with an explicit zone to a timestamp; anything else is NULL."""
    return F.when(text.rlike(ZONED_TIME), F.try_to_timestamp(F.regexp_replace(text, r"\s+$", "")))


def utc_time(text: str) -> datetime:
    """Driver-side form of :func:`zoned_timestamp` for window arguments; raises instead."""
    if not isinstance(text, str) or not re.match(ZONED_TIME, text.strip()):
        raise ValueError(f"not an ISO-8601 time with a zone: {text!r}")
    parsed = datetime.fromisoformat(text.strip().replace("Z", "+00:00"))
    return parsed.astimezone(timezone.utc)


def even_probabilities(parts: int) -> list[float]:
    """Inner probabilities of ``parts`` equal shares: 1/parts, 2/parts, ..."""
    step = 1.0 / parts
    return [i * step for i in range(1, parts)]


def evenly_spaced(count: int) -> list[float]:
    """``count`` probabilities from 0 to 1, both ends included."""
    if count == 1:
        return [0.0]
    step = 1.0 / (count - 1)
    return [i * step for i in range(count - 1)] + [1.0]


def require_probability(value: float, name: str) -> float:
    number = float(value)
    if not math.isfinite(number) or not 0.0 <= number <= 1.0:
        raise ValueError(f"{name} must be finite and between 0 and 1")
    return number


def require_cost(value: float, name: str) -> float:
    number = float(value)
    if not math.isfinite(number) or number < 0:
        raise ValueError(f"{name} must be finite and not negative")
    return number
