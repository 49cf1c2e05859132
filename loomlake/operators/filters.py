"""Row filters, compiled from a declarative mapping to one boolean column."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomlake.functions.text import CHINESE, number, script_share, strip

_COMPARE = {
    ">=": lambda a, b: a >= b,
    ">": lambda a, b: a > b,
    "<=": lambda a, b: a <= b,
    "<": lambda a, b: a < b,
    "=": lambda a, b: a == b,
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
}
#: The columns that may hold a quality score, the older names of settings, and settings that filter nothing.
SCORES = ("score", "int_score", "quality_score", "edu_score")
OLDER = {"min_chars": "min_length", "max_chars": "max_length"}
KNOWN = {"min_length", "max_length", "min_chinese_ratio", "type", "min_ratio", "min_script_ratio", "script", "allowed_languages", "language_column", "min_quality_score", "quality_columns", "quality_column", "field", "op", "value"}
IDLE = {"add_eos", "prefer_high_score"}

#: Named filters: a function of the row's column names that gives a boolean column.
REGISTRY: dict[str, Callable[[Sequence[str]], Column]] = {}


def register(name: str):
    """Decorator that adds a named filter."""

    def add(f: Callable[[Sequence[str]], Column]):
        REGISTRY[name] = f
        return f

    return add


@register("fineweb_edu")
def _educational(columns: Sequence[str]) -> Column:
    # Fixed value: scores from 2 on
    return F.coalesce(F.col("int_score").cast("double"), F.lit(0.0)) >= 2 if "int_score" in columns else F.lit(False)


@register("chinese")
def _chinese(columns: Sequence[str]) -> Column:
    # 100 characters, a share of 0.15
    return (F.length("text") >= 100) & (script_share(F.col("text")) >= 0.15) if "text" in columns else F.lit(False)


def first_existing(names: Sequence[str], columns: Sequence[str]) -> Column | None:
    """The first of the named columns that is neither null nor the empty text, as text."""
    have = [F.nullif(F.col(c).cast("string"), F.lit("")) for c in names if c in columns]
    return F.coalesce(*have) if have else None


def quality_at_least(least: float, names: Sequence[str], columns: Sequence[str]) -> Column:
    """Whether the first score that exists is a number not below `least`; NaN is not below anything."""
    text = first_existing(names, columns)
    return F.lit(False) if text is None else F.coalesce(number(text) >= float(least), F.lit(False))


def compare(column: Column, op: str, value: Any) -> Column:
    """A comparison as numbers where both sides are numbers, else as texts; null never passes, NaN only `!=`."""
    if op not in _COMPARE:
        raise ValueError(f"unknown comparison {op!r}")
    held = _COMPARE[op]
    text = column.cast("string")
    try:
        expected = float(value)
    except (TypeError, ValueError):
        return F.coalesce(held(text, F.lit(None if value is None else str(value))), F.lit(False))
    found = number(text)
    # NaN differs from everything and has no order
    as_number = F.when(F.isnan(found), F.lit(op == "!=")).otherwise(held(found, F.lit(expected)))
    # a text that is no number differs from every number and cannot be ordered
    return F.when(text.isNull(), F.lit(False)).when(found.isNotNull(), as_number).otherwise(F.lit(op == "!="))


def merged(config: Mapping[str, Any], named: Mapping[str, Mapping[str, Any]] | None = None, name: str | None = None) -> dict[str, Any]:
    """Filter settings: those that a recipe has under a name, overlaid by the inline ones, older names resolved."""
    both = {**((named or {}).get(name) or {} if name else {}), **config}
    for old, new in OLDER.items():
        if old in both:
            both.setdefault(new, both[old])
    return {k: v for k, v in both.items() if k not in OLDER}


def compiled(config: Mapping[str, Any], text: Column, columns: Sequence[str], name: str | None = None, named: Mapping[str, Mapping[str, Any]] | None = None) -> Column:
    """The conjunction of all filters of config, and of the filter registered or configured as `name`, for rows with these columns."""
    settings = merged(config, named, name)
    if unknown := set(settings) - KNOWN - IDLE:
        raise ValueError(f"unknown filter settings {sorted(unknown)}")
    if name and name not in REGISTRY and name not in (named or {}):
        raise ValueError(f"unknown filter {name!r}")
    parts = [REGISTRY[name](columns)] if name in REGISTRY else []
    if settings.get("min_length") is not None:
        parts.append(F.length(text) >= int(settings["min_length"]))
    if settings.get("max_length") is not None:
        parts.append(F.length(text) <= int(settings["max_length"]))
    share = settings.get("min_chinese_ratio")
    if share is None and settings.get("type") == "chinese":
        share = settings.get("min_ratio")
    if share is not None:
        parts.append(script_share(text) >= float(share))
    if settings.get("min_script_ratio") is not None:
        parts.append(script_share(text, settings.get("script") or CHINESE) >= float(settings["min_script_ratio"]))
    if settings.get("allowed_languages"):
        column = settings.get("language_column", "language")
        parts.append(F.col(column).isin(list(settings["allowed_languages"])) if column in columns else F.lit(False))
    if settings.get("min_quality_score") is not None:
        names = settings.get("quality_columns") or settings.get("quality_column") or SCORES
        parts.append(quality_at_least(settings["min_quality_score"], [names] if isinstance(names, str) else names, columns))
    if "field" in settings:
        there = settings["field"] in columns
        compare(F.lit(""), op := settings.get("op", "=="), None)  # an unknown comparison raises even where the column is missing
        parts.append(compare(F.col(settings["field"]), op, settings.get("value")) if there else F.lit(False))
    return reduce(lambda a, b: a & b, [F.coalesce(p, F.lit(False)) for p in parts], F.lit(True))


def long_enough(text: Column, least: int = 50) -> Column:
    """Whether a text without white space at its ends has `least` characters."""
    return F.coalesce(F.length(strip(text)) >= least, F.lit(False))


def accepted(config: Mapping[str, Any], text: Column, columns: Sequence[str], name: str | None = None, named: Mapping | None = None, mode: str = "two_stage", least: int = 50) -> Column:
    """Which rows a run takes: texts that pass all filters, and in the one-stage mode have `least` characters when stripped."""
    if mode not in ("one_stage", "two_stage"):
        raise ValueError(f"unknown mode {mode!r}")
    kept = F.coalesce(text != "", F.lit(False)) & compiled(config, text, columns, name, named)
    return kept & long_enough(text, least) if mode == "one_stage" else kept
