"""Document templates as aggregate ``Column`` builders.

A template turns the indicator rows of ONE geography into its ``values`` list.
Each builder returns an aggregate expression to be used inside
``groupBy(document, geography).agg(...)``; a group holds one geography's years,
so it is bounded by the calendar.  Order never depends on row order: rows are
collected as structs whose leading fields are the sort keys and sorted with
``array_sort``.

A value object is ``{value, ratio, date}``; ``ratio`` is NULL when the series
has no ratio column or the ratio is missing, and ``to_json`` then omits it
(a ratio of 0 is kept).
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoindicators.keys import Keys

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def _value_type(schema: T.StructType, series: Sequence[str]) -> str:
    """Common type of the series values: long, double, or (for non-numeric values) their own type."""
    types = [schema[s].dataType for s in series if s in schema.fieldNames()]
    if types and not all(isinstance(t, NUMERIC) for t in types):
        return types[0].simpleString()
    fractional = any(isinstance(t, (T.DoubleType, T.FloatType, T.DecimalType)) for t in types)
    return "double" if fractional else "long"


def _ratio_type(schema: T.StructType, series: Sequence[str]) -> str:
    """Ratios are doubles; non-numeric ratio columns keep their own type."""
    for s in series:
        name = f"{s}_ratio"
        if name in schema.fieldNames() and not isinstance(schema[name].dataType, NUMERIC):
            return schema[name].dataType.simpleString()
    return "double"


def _ratio(schema: T.StructType, s: str, rt: str = "double") -> Column:
    name = f"{s}_ratio"
    if name in schema.fieldNames():
        return F.col(name).cast(rt)
    return F.lit(None).cast(rt)


class Template:
    """Base: ``values(schema, series, keys)`` -> aggregate Column.

    ``no_rows``: the values of a geography without rows are defined (empty lists)."""

    no_rows = True

    def values(self, schema: T.StructType, series: Sequence, keys: Keys = Keys()) -> Column:
        raise NotImplementedError

    def published(self, values: Column) -> Column:
        """The values as published (identity unless the JSON form is not a typed list)."""
        return values


class TemplateA(Template):
    """Flat list, series-major then year: ``[{value, ratio?, date}, ...]``."""

    def values(self, schema, series, keys=Keys()):
        vt, rt = _value_type(schema, series), _ratio_type(schema, series)
        items = [
            F.struct(F.lit(i).alias("_s"), F.col(keys.date).alias("_d"),
                     F.col(s).cast(vt).alias("value"), _ratio(schema, s, rt).alias("ratio"),
                     F.col(keys.date).alias("date"))
            for i, s in enumerate(series)
        ]
        ordered = F.array_sort(F.flatten(F.collect_list(F.array(*items))))
        return F.transform(ordered, lambda x: F.struct(x["value"].alias("value"), x["ratio"].alias("ratio"),
                                                       x["date"].alias("date")))


class TemplateB(TemplateA):
    pass


class TemplateJ(TemplateA):
    pass


def _sorted_rows(schema, columns: Sequence[str], keys: Keys) -> Column:
    fields = [F.col(keys.date).alias("_d")]
    for c in columns:
        if c in schema.fieldNames():
            fields.append(F.col(c).alias(c))
    return F.array_sort(F.collect_list(F.struct(*fields)))


class TemplateC(Template):
    """List of lists: one ``[{value, ratio?, date}, ...]`` per series."""

    def values(self, schema, series, keys=Keys()):
        vt, rt = _value_type(schema, series), _ratio_type(schema, series)
        cols = [c for s in series for c in (s, f"{s}_ratio")]
        rows = _sorted_rows(schema, cols, keys)

        def per_series(s):
            has_ratio = f"{s}_ratio" in schema.fieldNames()
            return F.transform(rows, lambda x: F.struct(
                x[s].cast(vt).alias("value"),
                (x[f"{s}_ratio"].cast(rt) if has_ratio else F.lit(None).cast(rt)).alias("ratio"),
                x["_d"].alias("date")))

        return F.array(*[per_series(s) for s in series])


class TemplateH(Template):
    """Per series (a list of measure columns) the per-year objects holding only
    the non-null measures; objects with nothing but a date are dropped."""

    def values(self, schema, series, keys=Keys()):
        every = []
        for group in series:
            for c in group:
                if c not in every:
                    every.append(c)
        rows = _sorted_rows(schema, every, keys)
        numeric = {c: ("double" if isinstance(schema[c].dataType, (T.DoubleType, T.FloatType)) else "long")
                   for c in every}

        def per_series(group):
            if not group:
                return F.filter(F.transform(rows, lambda x: F.struct(x["_d"].alias("date"), *[
                    F.lit(None).cast(numeric[c]).alias(c) for c in every])), lambda o: F.lit(False))

            def obj(x):
                return F.struct(x["_d"].alias("date"), *[
                    (x[c] if c in group else F.lit(None)).cast(numeric[c]).alias(c) for c in every])
            objs = F.transform(rows, obj)
            return F.filter(objs, lambda o: reduce(lambda a, b: a | b, [o[c].isNotNull() for c in group]))

        return F.array(*[per_series(g) for g in series])


def _keep_numeric_double(schema: T.StructType, name: str) -> Column:
    t = schema[name].dataType
    return F.col(name).cast("double") if isinstance(t, NUMERIC) else F.col(name)


class TemplateK(Template):
    """Flat, series-major: ``{districtRatio, osloRatio}`` from ``<s>_ratio_district``/``<s>_ratio_oslo``."""

    def values(self, schema, series, keys=Keys()):
        items = [
            F.struct(F.lit(i).alias("_s"), F.col(keys.date).alias("_d"),
                     _keep_numeric_double(schema, f"{s}_ratio_district").alias("districtRatio"),
                     _keep_numeric_double(schema, f"{s}_ratio_oslo").alias("osloRatio"))
            for i, s in enumerate(series)
        ]
        ordered = F.array_sort(F.flatten(F.collect_list(F.array(*items))))
        return F.transform(ordered, lambda x: F.struct(x["districtRatio"].alias("districtRatio"),
                                                       x["osloRatio"].alias("osloRatio")))


class TemplateG(Template):
    """``[*status values at the newest year, [history...], date]``.

    The list is heterogeneous, so Spark keeps it typed as
    ``struct<status: array<double>, history: array<double>, date>`` and
    ``as_json_array`` renders the published form.  The history column must hold
    an ``array<struct<date, value>>`` (see ``operators.change.growth_history``).
    The status values come from the geography's row at its newest year; exactly one
    such row is required.
    """

    no_rows = False

    def __init__(self, history_column: str = "history"):
        self.history_column = history_column

    def values(self, schema, series, keys=Keys()):
        rows = F.array_sort(F.collect_list(F.struct(
            F.col(keys.date).alias("_d"), *[F.col(s).cast("double").alias(f"s{i}") for i, s in enumerate(series)],
            F.transform(F.col(self.history_column), lambda h: h["value"].cast("double")).alias("h"))))
        newest = F.filter(rows, lambda x: x["_d"] == F.array_max(F.transform(rows, lambda y: y["_d"])))
        row = F.when(F.size(newest) == 1, F.get(newest, 0)).otherwise(
            F.raise_error(F.lit("Template G needs exactly one row at the newest year")))
        return F.struct(F.array(*[row[f"s{i}"] for i in range(len(series))]).alias("status"),
                        F.get(F.filter(F.transform(rows, lambda x: x["h"]), lambda h: h.isNotNull()), 0).alias("history"),
                        row["_d"].alias("date"))

    def published(self, values: Column) -> Column:
        # a VARIANT holding the heterogeneous list; to_json writes it verbatim
        return F.parse_json(as_json_array(values))


def as_json_array(g: Column) -> Column:
    """Render a TemplateG struct as the published heterogeneous JSON list."""
    return F.concat(
        F.lit("["),
        F.regexp_replace(F.regexp_replace(F.to_json(g["status"]), r"^\[", ""), r"\]$", ""),
        F.lit(","), F.to_json(g["history"]), F.lit(","), g["date"].cast("string"), F.lit("]"),
    )


class TemplateE(Template):
    """Age pyramid: per age ``{age, mann, kvinne, value = mann + kvinne, ratio = value / total, date}``.

    Rows are one per (geography, age) with the two gender counts as columns
    ``men`` / ``women`` (see ``operators.pivot.pivot_sum``); ``total`` is the
    geography's population over all its rows, also of ages that ``ages`` doesn't list.
    Exactly one year per geography is required, and both genders: ``present`` names two columns
    that count the source rows of each gender.  The ``series`` argument is unused (the ages come
    from the rows).
    """

    no_rows = False

    def __init__(self, age: str = "age", men: str = "mann", women: str = "kvinne", ages: Sequence | None = None,
                 present: Sequence[str] | None = None):
        self.age, self.men, self.women, self.ages, self.present = age, men, women, ages, present

    def values(self, schema, series, keys=Keys()):
        rows = F.array_sort(F.collect_list(F.struct(
            F.col(self.age).alias("age"), F.coalesce(F.col(self.men), F.lit(0)).alias("mann"),
            F.coalesce(F.col(self.women), F.lit(0)).alias("kvinne"), F.col(keys.date).alias("date"))))
        total = F.aggregate(rows, F.lit(0).cast("double"), lambda acc, x: acc + x["mann"] + x["kvinne"])
        if self.ages is not None:
            # every listed age appears, in list order; ages without rows count 0
            by_age = F.map_from_entries(F.transform(rows, lambda x: F.struct(x["age"], x)))
            year = F.max(F.col(keys.date))
            zero = F.lit(0).cast(schema[self.men].dataType)
            rows = F.transform(F.array(*[F.lit(a) for a in self.ages]), lambda a: F.coalesce(
                F.try_element_at(by_age, a),
                F.struct(a.alias("age"), zero.alias("mann"), zero.alias("kvinne"), year.alias("date"))))
        years = F.collect_set(F.col(keys.date))
        out = F.transform(rows, lambda x: F.struct(
            x["age"].alias("age"), x["mann"].alias("mann"), x["kvinne"].alias("kvinne"),
            (x["mann"] + x["kvinne"]).alias("value"),
            F.try_divide(x["mann"] + x["kvinne"], total).alias("ratio"), x["date"].alias("date")))
        checked = F.when(F.size(years) != 1, F.raise_error(F.lit("Template E needs exactly one year")))
        for c in self.present or ():
            checked = checked.when(F.coalesce(F.sum(c), F.lit(0)) == 0, F.raise_error(F.lit(f"Template E needs both genders: no {c}")))
        return checked.otherwise(out)


class TemplateFlow(Template):
    """Moves per year: ``[{year, immigration: [...], emigration: [...]}, ...]``.

    Rows are one per (geography, year, age group); ``series`` maps the six
    measures: ``{"in": (between, within, to_from_city), "out": (...)}``; each
    list holds ``{alder, mellomBydeler, innenforBydelen, tilFraOslo}`` per age
    group in age-group order.  ``status=True`` gives only the newest year's object.
    """

    def __init__(self, age_group: str = "age_group", status: bool = False):
        self.age_group, self.status = age_group, status

    def values(self, schema, series, keys=Keys()):
        inn, out = series["in"], series["out"]
        rows = F.array_sort(F.collect_list(F.struct(
            F.col(keys.date).alias("_d"), F.col(self.age_group).alias("_a"),
            *[F.col(c).alias(f"i{i}") for i, c in enumerate(inn)],
            *[F.col(c).alias(f"o{i}") for i, c in enumerate(out)])))
        years = F.array_distinct(F.transform(rows, lambda x: x["_d"]))

        def side(year, p):
            return F.transform(F.filter(rows, lambda x: x["_d"] == year), lambda x: F.struct(
                x["_a"].alias("alder"), x[f"{p}0"].alias("mellomBydeler"), x[f"{p}1"].alias("innenforBydelen"),
                x[f"{p}2"].alias("tilFraOslo")))

        per_year = F.transform(years, lambda y: F.struct(y.alias("year"), side(y, "i").alias("immigration"),
                                                         side(y, "o").alias("emigration")))
        return F.try_element_at(per_year, F.lit(-1)) if self.status else per_year


TEMPLATES = {"a": TemplateA, "b": TemplateB, "c": TemplateC, "e": TemplateE, "flow": TemplateFlow,
             "h": TemplateH, "j": TemplateJ, "k": TemplateK}
