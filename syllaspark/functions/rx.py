"""Regular-expression rules on string columns, all in the JVM.

Patterns are read with Unicode classes, so that Norwegian letters are letters and a
no-break space is white space.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

_FLAGS = re.compile(r"\(\?([a-z]+)\)")


@dataclass(frozen=True)
class Rule:
    """Replace matches of a pattern; ``once`` stops after the first one."""

    pattern: str
    put: str = ""
    once: bool = False


def _parts(pattern: str) -> tuple[str, str]:
    lead = _FLAGS.match(pattern)
    return (lead[1] if lead else "", pattern[lead.end() :] if lead else pattern)


def replace_all(text: Column, pattern: str, put: str = "") -> Column:
    flags, body = _parts(pattern)
    return F.regexp_replace(text, f"(?{flags}U){body}", put)


def replace_first(text: Column, pattern: str, put: str = "") -> Column:
    """Only the first match: what comes before it is captured and put back."""
    flags, body = _parts(pattern)
    moved = re.sub(r"\$(\d)", lambda m: f"${int(m[1]) + 1}", put)
    return F.regexp_replace(text, f"(?{flags}U)\\A([\\s\\S]*?)(?:{body})", "$1" + moved)


def apply(text: Column, rules: list[Rule]) -> Column:
    for rule in rules:
        text = (replace_first if rule.once else replace_all)(text, rule.pattern, rule.put)
    return text


def trim(text: Column) -> Column:
    """Without Unicode white space at either end."""
    return F.regexp_replace(text, r"(?U)\A\s+|\s+\z", "")


def squish(text: Column) -> Column:
    """Runs of white space become one space; none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def blank_to_null(text: Column) -> Column:
    """The text, evaluated once; null where it is empty."""
    return F.nullif(text, F.lit(""))


def matches(text: Column, pattern: str) -> Column:
    flags, body = _parts(pattern)
    return text.rlike(f"(?{flags}U){body}")


def extract(text: Column, pattern: str, group: int) -> Column:
    """A group of the first match; null where there is none."""
    flags, body = _parts(pattern)
    return F.nullif(F.regexp_extract(text, f"(?{flags}U){body}", group), F.lit(""))
