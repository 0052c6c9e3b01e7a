"""User agent -> device label ``"{family} {brand} {model}"``.

The rule base is ours (the per-row parser library of the original is not
reproduced).  Rules are compiled into one CASE expression: it runs map-side
inside whole-stage codegen, needs no shuffle, no join and no state, so it is
the same in batch and in streaming, and a hot agent costs nothing extra.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Device rules, first match wins.
# (regex, family, brand, model); "{1}" is the regex's first group.
DEVICE_RULES: list[tuple[str, str, str, str]] = [
    ("iPad", "iPad", "Apple", "iPad"),
    ("iPhone", "iPhone", "Apple", "iPhone"),
    ("(?i)(bot|crawler|spider)", "Spider", "Spider", "Desktop"),
    ("Android [0-9.]+; (SM-[A-Z0-9]+)", "Samsung {1}", "Samsung", "{1}"),
    ("Android [0-9.]+; Pixel ([0-9]+[a-z]?(?: (?:Pro|XL|Fold))*)", "Pixel {1}", "Google", "Pixel {1}"),
    ("Android", "Generic Smartphone", "Generic", "Smartphone"),
    ("Macintosh", "Mac", "Apple", "Mac"),
]
# Python prints missing parts as None.
UNKNOWN_DEVICE = "Other None None"


def _template(text: str, ua: Column, pattern: str) -> Column:
    if "{1}" not in text:
        return F.lit(text)
    pieces = text.split("{1}")
    group = F.regexp_extract(ua, pattern, 1)
    out: list[Column] = [F.lit(pieces[0])]
    for p in pieces[1:]:
        out += [group, F.lit(p)]
    return F.concat(*out)


def device_label(c, rules: list[tuple[str, str, str, str]] | None = None) -> Column:
    """Label of the first matching rule; no match -> ``Other None None``; NULL -> NULL."""
    ua = F.col(c) if isinstance(c, str) else c
    rules = DEVICE_RULES if rules is None else rules
    expr = F.when(ua.isNull(), F.lit(None).cast("string"))
    for pattern, family, brand, model in rules:
        label = F.concat_ws(" ", _template(family, ua, pattern),
                            _template(brand, ua, pattern), _template(model, ua, pattern))
        expr = expr.when(ua.rlike(pattern), label)
    return expr.otherwise(F.lit(UNKNOWN_DEVICE))
