"""From a cohort to a training table: what is fitted is plain data, and applying it is one projection on any rows.

The recipe is JSON, so that it can be kept with a run, and transforms batches and streams alike.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as E
from ..operators import decorrelate, encode
from ..operators.cohort import TARGET

VERSION = 2


@dataclass(frozen=True)
class Options:
    encode: encode.Knobs = encode.Knobs()
    cluster: decorrelate.Knobs = decorrelate.Knobs()
    action: str = "describe"
    least_values: int = 20
    indicators: bool = False
    impute: bool = False
    prefer: tuple[str, ...] = ()
    durations: tuple[str, ...] = ()
    proxy_correlation: float = 0.95
    proxy_shared: int = 8


@dataclass
class Recipe:
    inputs: dict[str, str]
    numeric: list[str] = field(default_factory=list)
    positive: list[str] = field(default_factory=list)
    encoders: list[dict] = field(default_factory=list)
    clusters: dict = field(default_factory=dict)
    dropped: list[dict] = field(default_factory=list)
    indicators: dict[str, str] = field(default_factory=dict)
    medians: dict[str, float] = field(default_factory=dict)
    output: list[str] = field(default_factory=list)
    notes: list[str] = field(default_factory=list)
    missing_is_category: bool = False
    version: int = VERSION

    def dumps(self) -> str:
        return json.dumps(asdict(self), sort_keys=True, allow_nan=False)

    @classmethod
    def loads(cls, text: str) -> Recipe:
        state = json.loads(text)
        if state.get("version") != VERSION:
            raise ValueError(f"recipe version {state.get('version')}, this reads {VERSION}")
        return cls(**state)

    def _encoded(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        knobs = encode.Knobs(missing_is_category=self.missing_is_category)
        there = dict(df.dtypes)
        rows = df.withColumns({c: F.lit(None).cast(t) for c, t in self.inputs.items() if c not in there}) if set(self.inputs) - set(there) else df
        kinds = dict(rows.dtypes)
        out: dict[str, Column] = {c: encode.numeric(E.c(c), kinds[c], c in self.positive) for c in self.numeric}
        for state in self.encoders:
            out |= encode.applied(state, knobs)
        return rows.select(*(E.c(k) for k in keep), *(x.alias(n) for n, x in out.items()))

    def _finished(self, encoded: DataFrame, keep: Sequence[str]) -> DataFrame:
        rows = decorrelate.transform(encoded, decorrelate.Fitted(**self.clusters)) if self.clusters else encoded
        # Indicators are read before anything is filled in.
        flags = {n: E.c(c).isNull().cast("int") for c, n in self.indicators.items()}
        columns = [(F.coalesce(E.c(c).cast("double"), F.lit(self.medians[c])) if c in self.medians else E.c(c)).alias(c) for c in self.output if c not in flags]
        return rows.select(*(E.c(k) for k in keep), *columns, *(flags[n].alias(n) for n in self.output if n in flags))

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """The recipe's columns after those of `keep`. Columns that rows lack come out as for empty cells."""
        return self._finished(self._encoded(df, keep), keep)

    def missing_inputs(self, df: DataFrame) -> list[str]:
        return sorted(set(self.inputs) - set(df.columns))


def fit(df: DataFrame, predictors: Sequence[str], options: Options = Options(), orders: dict[str, list[str]] | None = None, site: str | None = None) -> Recipe:
    """df has _target. Routing, encoders, numbers, duplicates, clusters; of all that comes out, sparse and constant columns
    go; then indicators, medians, and notes on what is nearly the target."""
    kinds = dict(df.dtypes)
    recipe = Recipe({c: kinds[c] for c in predictors}, missing_is_category=options.encode.missing_is_category)
    taken: set[str] = set(predictors)
    ordinal = {c: o for c, o in (orders or {}).items() if c in predictors}
    categorical = [c for c in predictors if kinds[c] in ("string", "boolean") and c not in ordinal]
    low, high = df.agg(F.min(E.c(TARGET)), F.max(E.c(TARGET))).first()
    varied = low is not None and low != high
    for c, (choice, why) in encode.route(df, categorical, options.encode).items():
        if choice == "skip":
            recipe.dropped.append({"column": c, "stage": "routing", "reason": why})
        elif choice == "binary":
            recipe.encoders.append(encode.fit_binary(df, c, taken, options.encode))
        elif choice == "one_hot":
            recipe.encoders.append(encode.fit_one_hot(df, c, taken, options.encode))
        elif choice == "target" and varied:
            recipe.encoders.append(encode.fit_target(df, c, TARGET, taken, options.encode))
        elif choice == "target" and options.encode.target_encoding_fallback == "stop":
            raise ValueError(f"{c}: the target is the same in all rows, so nothing can be encoded by it")
        else:
            recipe.encoders.append(encode.fit_hashed(df, c, taken, options.encode))
    recipe.encoders += [encode.fit_ordinal(c, o, taken) for c, o in ordinal.items()]
    numeric = [c for c in predictors if c not in categorical and c not in ordinal and not kinds[c].startswith(("timestamp", "date", "array", "map", "struct"))]
    recipe.dropped += [{"column": c, "stage": "type", "reason": f"{kinds[c]} isn't a number or a category"} for c in predictors if c not in categorical and c not in ordinal and c not in numeric]
    recipe.positive = [c for c in options.durations if c in numeric]
    recipe.numeric = numeric

    values = recipe._encoded(df, [TARGET]).cache()
    rest = list(numeric)
    if len(rest) > 1:
        p = decorrelate.correlations(values, rest, options.cluster)
        twins = decorrelate.duplicates(p, options.prefer, options.cluster.duplicate_r2, options.cluster.least_shared)
        recipe.dropped += [{"column": c, "stage": "duplicate", "reason": f"the same as {k}"} for c, k in twins.items()]
        rest = [c for c in rest if c not in twins]
    if numeric:
        fitted = decorrelate.fit(values, rest, options.action, options.cluster, options.prefer, site=None)
        recipe.clusters = asdict(fitted)
        rest = decorrelate.transform(values.select(*(E.c(c) for c in rest)), fitted).columns
    encoded = [n for e in recipe.encoders for n in e["output"]]
    finished = decorrelate.transform(values, decorrelate.Fitted(**recipe.clusters)) if recipe.clusters else values

    made = [*rest, *encoded]
    present = finished.agg(F.count(F.lit(1)), *(F.count(E.c(c)) for c in made)).first() if made else (0,)
    thin = [c for c, n in zip(made, present[1:]) if n < options.least_values]
    flat = encode.near_constant(finished, [c for c in made if c not in thin])
    recipe.dropped += [{"column": c, "stage": "sparse", "reason": f"under {options.least_values} values"} for c in thin] + [{"column": c, "stage": "constant", "reason": "hardly varies"} for c in flat]
    final, encoded = ([c for c in xs if c not in thin and c not in flat] for xs in (rest, encoded))
    if made and not final and not encoded:
        values.unpersist()
        raise ValueError("every predictor was dropped: " + "; ".join(f"{d['column']}: {d['reason']}" for d in recipe.dropped))
    if options.indicators:
        everything = [*final, *encoded]
        recipe.indicators = {c: encode.unique_name(f"{encode.sanitised(c)}_missing", taken) for c in everything if present[1 + made.index(c)] < present[0]}
    if options.impute and (everything := [*final, *encoded]):
        middle = finished.agg(*(F.percentile(E.c(c), F.lit(0.5)).alias(f"m{k}") for k, c in enumerate(everything))).first()
        recipe.medians = {c: float(middle[k]) for k, c in enumerate(everything) if middle[k] is not None}
    if (everything := [*final, *encoded]) and options.proxy_correlation > 0:
        pair = decorrelate.S.pearson(finished, [TARGET, *everything])
        recipe.notes += [f"{c} is nearly the target" for k, c in enumerate(everything, 1) if pair.n[0, k] >= options.proxy_shared and abs(pair.r[0, k]) >= options.proxy_correlation]
    recipe.output = [*final, *encoded, *recipe.indicators.values()]
    values.unpersist()
    return recipe


def crossfit_transform(recipe: Recipe, df: DataFrame, keep: Sequence[str], fold: str, weight: float = 10.0, chronological: bool = False) -> DataFrame:
    """transform() of the training rows, with target means that leave out each row's own fold."""
    targets = [e for e in recipe.encoders if e["encoder"] == "target"]
    rows = df
    for e in targets:
        rows = encode.crossfitted(rows, e["column"], TARGET, fold, f"_cf_{e['output'][0]}", weight, chronological, encode.Knobs(missing_is_category=recipe.missing_is_category))
    extra = [f"_cf_{e['output'][0]}" for e in targets]
    encoded = recipe._encoded(rows, [*keep, *extra])
    swapped = encoded.withColumns({e["output"][0]: E.c(f"_cf_{e['output'][0]}") for e in targets}).drop(*extra) if targets else encoded
    return recipe._finished(swapped, keep)


class TaskTransformer(Estimator):
    """A pipeline stage that fits a recipe on the rows it is given, so that each fold of a validation refits it."""

    @keyword_only
    def __init__(self, *, predictors: Sequence[str] = (), options: Options = Options(), keep: Sequence[str] = ()) -> None:
        super().__init__()
        self.predictors, self.options, self.keep = list(predictors), options, list(keep)

    def _fit(self, dataset: DataFrame) -> TaskModel:
        return TaskModel(fit(dataset, self.predictors, self.options), self.keep)


class TaskModel(Model):
    def __init__(self, recipe: Recipe, keep: Sequence[str] = ()) -> None:
        super().__init__()
        self.recipe, self.keep = recipe, list(keep)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.recipe.transform(dataset, self.keep)
