"""Custom score functions over the text score."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeseek.errors import QueryError
from treeseek.functions import dates, geo
from treeseek.operators.filters import clause, conjunction
from treeseek.operators.relevance import DECIMALS

SCORE_MODES = ("multiply", "first", "sum", "avg", "max", "min")
BOOST_MODES = ("multiply", "replace", "sum", "avg", "max", "min")

# Modifiers of a field value.
MODIFIERS = {
    "none": lambda v: v,
    "log": F.log10,
    "log1p": lambda v: F.log10(v + 1),
    "log2p": lambda v: F.log10(v + 2),
    "ln": F.log,
    "ln1p": lambda v: F.log(v + 1),
    "ln2p": lambda v: F.log(v + 2),
    "square": lambda v: v * v,
    "sqrt": F.sqrt,
    "reciprocal": lambda v: 1 / v,
}


def _field_value(spec: Mapping) -> Column:
    name = spec.get("modifier", "none")
    if name not in MODIFIERS:
        raise QueryError(f"unknown modifier {name!r}")
    stored = F.col(spec["field"]).cast("double")
    if "missing" in spec:
        stored = F.coalesce(stored, F.lit(float(spec["missing"])))
    return MODIFIERS[name](stored * float(spec.get("factor", 1.0)))


def _decay(kind: str, spec: Mapping) -> Column:
    """gauss / exp / linear by distance from an origin; missing values score 1."""
    name, options = next(iter((k, v) for k, v in spec.items() if isinstance(v, Mapping)))
    floor = float(options.get("decay", 0.5))
    if options.get("kind") == "geo":
        away = geo.distance_m(F.col(f"{name}.lat"), F.col(f"{name}.lon"), options["origin"])
        scale, offset = geo.metres(options["scale"]), geo.metres(options.get("offset", 0))
    elif options.get("kind") == "date":
        origin = options.get("origin", "now")
        at = dates.relative(origin) if dates.is_relative(origin) else F.lit(origin).cast("timestamp")
        away = F.abs(F.unix_micros(F.col(name)) - F.unix_micros(at)) / 1e6
        scale, offset = float(options["scale"]), float(options.get("offset", 0))
    else:
        away = F.abs(F.col(name).cast("double") - float(options["origin"]))
        scale, offset = float(options["scale"]), float(options.get("offset", 0))
    beyond = F.greatest(F.lit(0.0), away - offset)
    if kind == "gauss":
        value = F.exp(beyond * beyond * (math.log(floor) / (scale * scale)))
    elif kind == "exp":
        value = F.exp(beyond * (math.log(floor) / scale))
    else:
        reach = scale / (1.0 - floor)
        value = F.greatest(F.lit(0.0), (reach - beyond) / reach)
    return F.coalesce(value, F.lit(1.0))


def _one(df: DataFrame, spec: Mapping) -> tuple[Column, Column, float]:
    """(does it apply, its value without weight, its weight)."""
    known = {"filter", "weight", "score", "field_value_factor", "gauss", "exp", "linear"}
    unknown = set(spec) - known
    if unknown:
        raise QueryError(f"unknown score function parts: {sorted(unknown)}")
    chosen = spec.get("filter")
    if chosen is None:
        applies = F.lit(True)
    elif isinstance(chosen, Column):
        applies = chosen
    else:
        applies = conjunction(clause(df, k, o) for k, o in chosen.items())
    raw = F.lit(1.0)
    if "score" in spec:
        raw = spec["score"].cast("double")
    elif "field_value_factor" in spec:
        raw = _field_value(spec["field_value_factor"])
    else:
        for kind in ("gauss", "exp", "linear"):
            if kind in spec:
                raw = _decay(kind, spec[kind])
    return F.coalesce(applies, F.lit(False)), raw, float(spec.get("weight", 1.0))


def combined(df: DataFrame, functions: Sequence[Mapping], score_mode: str) -> Column:
    """The function score; 1 where no function applies."""
    if score_mode not in SCORE_MODES:
        raise QueryError(f"unknown score mode {score_mode!r}")
    parts = [_one(df, f) for f in functions]
    values = [F.when(applies, raw * weight) for applies, raw, weight in parts]
    if score_mode == "first":
        result = F.coalesce(*values)
    elif score_mode == "max":
        result = F.greatest(*values) if len(values) > 1 else values[0]
    elif score_mode == "min":
        result = F.least(*values) if len(values) > 1 else values[0]
    else:
        applies_any = reduce(lambda a, b: a | b, [p[0] for p in parts])
        if score_mode == "multiply":
            folded = reduce(lambda a, b: a * b, [F.coalesce(v, F.lit(1.0)) for v in values])
        else:
            folded = reduce(lambda a, b: a + b, [F.coalesce(v, F.lit(0.0)) for v in values])
            if score_mode == "avg":
                weights = [F.when(p[0], F.lit(p[2])).otherwise(0.0) for p in parts]
                folded = folded / reduce(lambda a, b: a + b, weights)
        result = F.when(applies_any, folded)
    return F.coalesce(result, F.lit(1.0))


def boosted(base: Column, function: Column, boost_mode: str) -> Column:
    modes = {
        "multiply": base * function,
        "replace": function,
        "sum": base + function,
        "avg": (base + function) / 2,
        "max": F.greatest(base, function),
        "min": F.least(base, function),
    }
    if boost_mode not in modes:
        raise QueryError(f"unknown boost mode {boost_mode!r}")
    return modes[boost_mode]


def apply(
    scored: DataFrame,
    functions: Sequence[Mapping],
    score_mode: str = "multiply",
    boost_mode: str = "multiply",
    max_boost: float | None = None,
    min_score: float | None = None,
) -> DataFrame:
    """New scores; without functions nothing changes, a minimum included."""
    if score_mode not in SCORE_MODES:
        raise QueryError(f"unknown score mode {score_mode!r}")
    if boost_mode not in BOOST_MODES:
        raise QueryError(f"unknown boost mode {boost_mode!r}")
    if not functions:
        return scored
    function = combined(scored, functions, score_mode)
    if max_boost is not None:
        function = F.least(function, F.lit(float(max_boost)))
    result = scored.withColumn("score", F.round(boosted(F.col("score"), function, boost_mode), DECIMALS))
    return result if min_score is None else result.where(F.col("score") >= float(min_score))
