"""Category and status expressions built from rule lists."""

from __future__ import annotations

import operator

from pyspark.sql import Column, functions as F

from skygauge import lookups as L

_COMPARE = {"<": operator.lt, "<=": operator.le, "=": operator.eq, ">=": operator.ge, ">": operator.gt}


def classify(value: Column | str, rules: L.Rules, default: str | None = L.UNKNOWN) -> Column:
    """Label of the first rule that holds, else ``default`` (also for NULL)."""
    value = F.col(value) if isinstance(value, str) else value
    label = F
    for name, comparison, bound in rules:
        label = label.when(_COMPARE[comparison](value, F.lit(float(bound))), F.lit(name))
    return label.otherwise(F.lit(default))


def region_class(name: Column | str) -> Column:
    """Region class of a stored governorate name."""
    name = F.col(name) if isinstance(name, str) else name
    label = F
    for region, members in L.REGION_CLASSES.items():
        label = label.when(name.isin(*members), F.lit(region))
    return label.otherwise(F.lit(L.OTHER_REGION))


def status_rules(metric: str) -> L.Rules:
    """The status steps of a metric as rules: the highest bound reached wins."""
    base, steps = L.STATUS_STEPS[metric]
    descending = tuple((colour, ">=", bound) for colour, bound in reversed(steps))
    return descending + ((base, "<", steps[0][1]),)


def status(value: Column | str, metric: str) -> Column:
    """Dashboard status colour; NULL without a value."""
    return classify(value, status_rules(metric), default=None)


def season(month: Column) -> Column:
    label = F
    for name, months in L.SEASONS.items():
        label = label.when(month.isin(*months), F.lit(name))
    return label
