"""Scalar column expressions.  All are built-in Spark expressions, so they
compile into the surrounding whole-stage-codegen span; none is a Python UDF.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the reference's rules for identical results.
# Target standardisation: checked in this order on the lower-cased text;
# the first keyword found decides; nothing found -> "!pass".
TARGET_RULES: list[tuple[tuple[str, ...], str]] = [
    (("fail",), "!pass"),
    (("with",), "!pass"),
    (("not",), "!pass"),
    (("inconclusive",), "!pass"),
    (("pass",), "pass"),
]
TARGET_DEFAULT = "!pass"

# Address -> country keywords, checked in this order; nothing found -> null.
COUNTRY_RULES: list[tuple[tuple[str, ...], str]] = [
    (("china", "hefei", "dongtai", "yiwu", "zhejiang", "henan", "jiangsu", "anhui",
      "ningbo", "shanghai", "hebei"), "china"),
    (("singapore",), "singapore"),
    (("france",), "france"),
    (("germany",), "germany"),
    (("netherland",), "netherland"),
    (("spain",), "spain"),
    (("vietnam",), "vietnam"),
    (("emirates",), "uae"),
    (("india",), "india"),
    (("australia",), "australia"),
    (("yemen",), "yemen"),
    (("thailand",), "thailand"),
    (("malaysia",), "malaysia"),
]
# ---------------------------------------------------------------------------


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def map_values(col: str | Column, groups: Mapping[str, Sequence[str]]) -> Column:
    """Bucket categories: members of ``groups[label]`` become ``label``;
    other values (and null) pass through unchanged."""
    c = _c(col)
    out = None
    for label, members in groups.items():
        cond = c.isin(list(members))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return c if out is None else out.otherwise(c)


def none_to_pass(col: str | Column, token: str = "None", replacement: str = "pass") -> Column:
    """The string ``"None"`` becomes ``"pass"``; a real null is left alone."""
    c = _c(col)
    return F.when(c == F.lit(token), F.lit(replacement)).otherwise(c)


def rule_classify(col: str | Column, rules: Sequence[tuple[Sequence[str], str]],
                  default: str | None, lower: bool = True) -> Column:
    """Ordered substring rules: the first rule with a keyword contained in the
    (lower-cased) text gives the outcome; otherwise ``default``.  Null in ->
    null out.  Substring semantics on purpose ("not" matches inside "noted")."""
    c = _c(col).cast(T.StringType())

    def classify(text: Column) -> Column:
        out = F.when(text.isNull(), F.lit(None).cast(T.StringType()))
        for keywords, outcome in rules:
            cond = None
            for k in keywords:
                hit = text.contains(k)
                cond = hit if cond is None else (cond | hit)
            out = out.when(cond, F.lit(outcome))
        return out.otherwise(F.lit(default).cast(T.StringType()))

    # the lambda variable binds the lower-cased text once, not once a keyword
    return F.transform(F.array(F.lower(c) if lower else c), classify)[0]


def classify_target(col: str | Column) -> Column:
    """Final-result standardisation to ``pass`` / ``!pass`` (null stays null)."""
    return rule_classify(col, TARGET_RULES, TARGET_DEFAULT)


def keyword_country(col: str | Column) -> Column:
    """Address text -> country by the keyword table; null when nothing matches."""
    return rule_classify(col, COUNTRY_RULES, None)


def whitelist_other(col: str | Column, whitelist: Sequence, other: str = "other") -> Column:
    """Values outside ``whitelist`` become ``other`` (null stays null)."""
    c = _c(col)
    return (F.when(c.isNull(), F.lit(None).cast(T.StringType()))
            .when(c.isin(list(whitelist)), c.cast(T.StringType()))
            .otherwise(F.lit(other)))


def zero_guard(col: str | Column) -> Column:
    """A zero denominator becomes 1 (so the shares become 0, not NaN)."""
    c = _c(col)
    return F.when(c == 0, F.lit(1)).otherwise(c)


def parse_list_literal(col: str | Column) -> Column:
    """``"['Major', 'Minor']"`` -> array; a plain value -> one-element array;
    null -> null.  Spark's JSON reader accepts single-quoted strings."""
    c = _c(col)
    return (F.when(c.isNull(), F.lit(None).cast(T.ArrayType(T.StringType())))
            .when(F.trim(c).startswith("["), F.from_json(c, T.ArrayType(T.StringType())))
            .otherwise(F.array(c)))
