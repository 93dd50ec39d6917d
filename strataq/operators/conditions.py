"""Conditions stated in the text of rules."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from strataq.functions.text import SPACE

# Fixed values: (pattern, parameter, operator, value, unit); a number is a group of the pattern, None is null.
_UNITS = "(ft|m|mi/h|m/s|mph)?"
RULES = [
    (r"\b([a-zA-Z_]+)\s*(>|>=|<|<=|=)\s*(\d+\.?\d*)\s*(ft|m|mi/h|m/s|mph|Hz|%)?", 1, 2, 3, 4),
    (rf"(?:greater than or equal to|equal to or greater than)\s+(\d+\.?\d*)\s*{_UNITS}", "", ">=", 1, 2),
    (rf"(?:less than or equal to|equal to or less than)\s+(\d+\.?\d*)\s*{_UNITS}", "", "<=", 1, 2),
    (rf"greater than\s+(\d+\.?\d*)\s*{_UNITS}", "", ">", 1, 2),
    (rf"less than\s+(\d+\.?\d*)\s*{_UNITS}", "", "<", 1, 2),
    (r"Risk\s+Category\s+(I{1,3}V?|IV)", "risk_category", "==", 1, None),
    (r"Exposure\s+(B|C|D)\b", "exposure_category", "==", 1, None),
    (r"low-rise\s+building", "building_type", "==", "low-rise", None),
    (r"(enclosed|partially enclosed|partially open|open)\s+building", "enclosure", "==", 1, None),
    (r"(flexible|rigid)\s+(?:building|structure)", "flexibility", "==", 1, None),
    (r"hurricane-prone\s+region", "location", "in", "hurricane-prone regions", None),
    (r"wind-borne\s+debris\s+region", "location", "in", "wind-borne debris regions", None),
]
_NUMERIC = 5  # the first rules give numbers


def parse_conditions(text: Column, rules: list[tuple] = RULES, numeric: int = _NUMERIC) -> Column:
    """array<struct<parameter, operator, value_num, value_str, unit>>, each once, in rule order.

    Units are read as the rules list them, the first alternative that fits: ``mph``
    after a number gives ``m``.
    """

    def of(pattern: str, slots: tuple, number: bool) -> Column:
        pattern = pattern.replace(r"\s", SPACE)  # every kind of space, the non-breaking one too

        def slot(m: Column, s) -> Column:
            if s is None:
                return F.lit(None).cast("string")
            return F.nullif(F.regexp_extract(m, pattern, s), F.lit("")) if isinstance(s, int) else F.lit(s)

        def made(m: Column) -> Column:
            parameter, operator, value, unit = (slot(m, s) for s in slots)
            return F.struct(
                parameter.alias("parameter"),
                F.when(operator == "=", "==").otherwise(operator).alias("operator"),
                (value.cast("double") if number else F.lit(None).cast("double")).alias("value_num"),
                (F.lit(None).cast("string") if number else value).alias("value_str"),
                unit.alias("unit"),
            )

        # A word begins after anything but a letter, digit or underscore of any alphabet.
        found = re.sub(r"^\\b", r"(?<![\\p{L}\\p{N}_])", pattern)
        return F.transform(F.regexp_extract_all(text, F.lit(found), F.lit(0)), made)

    return F.array_distinct(F.concat(*(of(r[0], r[1:], i < numeric) for i, r in enumerate(rules))))
