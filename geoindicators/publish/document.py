"""Document assembly: one nested document per district plus the city document.

Membership rules (which rows feed which entry of which document):

* district document ``d`` (every residential district present in the data):
  one entry per sub-district of ``d`` (ordered by id), the district entry
  (rows of ``d`` without a sub-district, ``avgRow``) and the city entry
  (``totalRow``), the last one repeated in every district document;
* city document: one entry per district at the district level (rows whose
  sub-district name is null), minus the non-residential districts, the city
  entry last.

Everything is a grouped aggregation over entry membership rows; an entry group
holds one geography's years and a document group one district's entries, so no
group grows with the data.  The single city entry shared by all district
documents is a scalar subquery: computed once, no join.
"""

from __future__ import annotations

import datetime
import json
from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoindicators.functions.nulls import round_numeric
from geoindicators.keys import Keys
from geoindicators.operators.filters import not_in_keep_null
from geoindicators.publish.templates import Template
from geoindicators.publish.validate import assert_finite, assert_ratios, series_columns
from geoindicators.session import materialize

DEFAULT_HELP = "Dette er en beskrivelse for hvordan dataene leses"

# entry kinds, in their order inside a document
SUB, DISTRICT, CITY = 0, 1, 2


@dataclass
class Metadata:
    heading: str
    series: list = field(default_factory=list)
    published_date: str = field(default_factory=lambda: str(datetime.date.today()))
    help: str = DEFAULT_HELP
    scope: str = "bydel"

    def series_column(self) -> Column:
        """The series list as a VARIANT: entries may mix types (a subheading can be
        text or ``false``) and ``to_json`` renders it verbatim."""
        series = [s if isinstance(s, dict) else {"heading": str(s), "subheading": ""} for s in self.series]
        return F.parse_json(F.lit(json.dumps(series, ensure_ascii=False)))

    def column(self, scope: str | None = None, scale: Column | None = None) -> Column:
        series_col = self.series_column()
        # without a scale the published metadata holds an empty list
        scale_col = scale if scale is not None else F.parse_json(F.lit("[]"))
        return F.struct(
            F.lit(self.heading).alias("heading"),
            series_col.alias("series"),
            F.lit(self.published_date).alias("publishedDate"),
            F.lit(self.help).alias("help"),
            F.lit(scope or self.scope).alias("scope"),
            scale_col.alias("scale"),
        )


def entry_rows(df: DataFrame, keys: Keys = Keys()) -> DataFrame:
    """Membership rows: every indicator row tagged with (doc_id, kind, geo_id, geo_name)."""
    k = keys
    did, sid = F.col(k.district_id), F.col(k.sub_id)
    excluded = [*k.non_residential, k.city_id]
    residential = did.isNotNull() & ~did.isin(excluded)
    subs = (df.filter(residential & sid.isNotNull())
            .withColumns({"_doc": did, "_kind": F.lit(SUB), "_geo": sid, "_name": F.col(k.sub_name)}))
    districts = (df.filter(residential & sid.isNull())
                 .withColumns({"_doc": did, "_kind": F.lit(DISTRICT), "_geo": did,
                               "_name": F.col(k.district_name)}))
    city_doc = (df.filter(F.col(k.sub_name).isNull() & did.isNotNull()
                          & not_in_keep_null(k.district_id, k.non_residential))
                .withColumns({"_doc": F.lit(k.city_id),
                              "_kind": F.when(did == F.lit(k.city_id), F.lit(CITY)).otherwise(F.lit(DISTRICT)),
                              "_geo": did,
                              "_name": F.when(did == F.lit(k.city_id), F.lit(k.city_name))
                              .otherwise(F.col(k.district_name))}))
    return subs.unionByName(districts).unionByName(city_doc)


def _entry(values: Column, geo: Column, name: Column, avg_row: Column, total_row: Column) -> Column:
    return F.struct(geo.alias("id"), name.alias("geography"), values.alias("values"),
                    avg_row.alias("avgRow"), total_row.alias("totalRow"))


def _by_kind_then_id(a: Column, b: Column) -> Column:
    """Entry order (sub-districts by id, district, city); compares only the sort keys,
    so entries holding VARIANT values sort too."""
    return (F.when(a["_k"] < b["_k"], -1).when(a["_k"] > b["_k"], 1)
            .when(a["_g"] < b["_g"], -1).when(a["_g"] > b["_g"], 1).otherwise(0))


def _checked_name(name_col: str) -> Column:
    names = F.collect_set(F.col(name_col))
    return F.when(F.size(names) > 1, F.raise_error(F.lit("Multiple names for one geography id"))) \
        .otherwise(F.get(names, 0))


def build_documents(df: DataFrame, template: Template, series: Sequence, metadata: Metadata,
                    keys: Keys = Keys(), scale: DataFrame | None = None, rounding: bool = True,
                    materialize_rows: bool = True, published_form: bool = False,
                    on_invalid: str = "error") -> DataFrame:
    """Documents ``(id, district, data: array<entry>, meta)``; entry = (id, geography, values, avgRow, totalRow).

    Every residential district of the data has a document that closes with the district's own entry
    (without values if the data holds only its sub-districts) and the city's.  ``on_invalid`` says what
    happens to non-finite numbers and to ratios whose denominator was zero: ``"error"`` fails,
    ``"null"`` publishes the value without them.

    The indicator rows are read by several membership passes and a scalar
    subquery; ``materialize_rows`` checkpoints them first so the work that
    produced them runs once.
    """
    k = keys
    rows = assert_ratios(assert_finite(df, on_invalid=on_invalid), series_columns(series), on_invalid)
    rows = round_numeric(rows, exclude=k.all()) if rounding else rows
    if materialize_rows:
        rows = materialize(rows)
    schema = rows.schema
    values = template.values(schema, series, k)
    if published_form:
        values = template.published(values)
    members = entry_rows(rows, k)
    entries = (
        members.groupBy("_doc", "_kind", "_geo")
        .agg(values.alias("_values"), _checked_name("_name").alias("_name"),
             F.max(k.district_name).alias("_dname"))
    )
    is_city_doc = F.col("_doc") == F.lit(k.city_id)
    entry = _entry(F.col("_values"), F.col("_geo"), F.col("_name"),
                   (F.col("_kind") == F.lit(DISTRICT)) & ~is_city_doc,
                   F.col("_kind") == F.lit(CITY))
    docs = (
        entries.groupBy("_doc")
        .agg(F.array_sort(F.collect_list(F.struct(F.col("_kind").alias("_k"), F.col("_geo").alias("_g"),
                                                  entry.alias("_e"))), _by_kind_then_id).alias("_entries"),
             F.max("_dname").alias("_district"))
    )
    # a district that has sub-district rows only: its own entry has the template's values of no rows
    if template.no_rows:
        no_values = rows.filter(F.lit(False)).agg(values.alias("v")).scalar()
        own_entry = _entry(no_values, F.col("_doc"), F.col("_district"), F.lit(True), F.lit(False))
    else:
        own_entry = F.when(F.lit(True), F.raise_error(F.concat(F.lit("No district rows: "), F.col("_doc")))).cast(
            entries.select(entry.alias("e")).schema["e"].dataType)
    own = F.struct(F.lit(DISTRICT).alias("_k"), F.col("_doc").alias("_g"), own_entry.alias("_e"))
    has_own = is_city_doc | F.exists("_entries", lambda x: x["_k"] == F.lit(DISTRICT))
    docs = docs.withColumn("_entries", F.when(has_own, F.col("_entries")).otherwise(F.concat(F.col("_entries"), F.array(own))))
    # the city entry that closes every district document: one value, computed once
    city_rows = rows.filter(F.col(k.district_id) == F.lit(k.city_id))
    city_entry = city_rows.agg(
        _entry(values, F.lit(k.city_id), F.lit(k.city_name), F.lit(False), F.lit(True)).alias("e")
    ).scalar()
    scale_col = scale.select(F.struct(*scale.columns)).scalar() if scale is not None else None
    data = F.transform(F.col("_entries"), lambda x: x["_e"])
    return docs.select(
        F.col("_doc").alias("id"),
        F.when(is_city_doc, F.lit(k.city_name)).otherwise(F.col("_district")).alias("district"),
        F.when(is_city_doc, data).otherwise(F.concat(data, F.array(city_entry))).alias("data"),
        F.when(is_city_doc, metadata.column("oslo i alt", scale_col)).otherwise(metadata.column(None, scale_col))
        .alias("meta"),
    )


def flatten_values(docs: DataFrame, value_fields: Sequence[str] = ("value", "ratio", "date")) -> DataFrame:
    """One row per (document, entry, value): for comparing documents as tables."""
    entries = docs.select(F.col("id").alias("doc_id"), F.posexplode("data").alias("entry_pos", "e"))
    vals = entries.select(
        "doc_id", F.col("e.id").alias("geo_id"), F.col("e.geography").alias("geography"),
        F.col("e.avgRow").alias("avg_row"), F.col("e.totalRow").alias("total_row"),
        F.posexplode_outer("e.values").alias("ordinal", "v"))
    return vals.select("doc_id", "geo_id", "geography", "avg_row", "total_row",
                       F.col("ordinal").cast("long").alias("ordinal"),
                       *[F.col(f"v.{f}").alias(f) for f in value_fields])


def to_json_documents(docs: DataFrame) -> DataFrame:
    """(name, json): name = id, else district; the published text of each document."""
    return docs.select(F.coalesce(F.col("id"), F.col("district")).alias("name"),
                       F.to_json(F.struct(*docs.columns)).alias("json"))


def top_n_documents(df: DataFrame, category: str, data_points: Sequence[str], ranking: DataFrame,
                    metadata: Metadata, keys: Keys = Keys(), status: bool = True, rank_col: str = "rank") -> DataFrame:
    """Top-N documents: per district, one entry per top category in rank order.

    ``ranking`` holds (district_id, category, rank) - e.g. from
    ``operators.topn.top_n_categories``.  Status entries are
    ``{geography, values: [{date, value, ratio} per data point]}`` for the newest
    row; historic entries hold a year-ordered list per data point.
    Meta carries only series and heading.
    """
    k = keys
    rows = round_numeric(df, exclude=k.all())
    ranked = rows.join(ranking.select(k.district_id, category, rank_col), [k.district_id, category])

    def obj(dp: str) -> Column:
        return F.struct(F.col(k.date).alias("date"), F.col(dp).cast("double").alias("value"),
                        F.col(f"{dp}_ratio").cast("double").alias("ratio"))

    if status:
        values = F.max_by(F.array(*[obj(dp) for dp in data_points]), F.col(k.date))
    else:
        sorted_rows = F.array_sort(F.collect_list(F.struct(F.col(k.date).alias("_d"),
                                                           *[obj(dp).alias(f"v{i}") for i, dp in enumerate(data_points)])))
        def field(i: int):
            return lambda x: x[f"v{i}"]
        values = F.array(*[F.transform(sorted_rows, field(i)) for i in range(len(data_points))])
    entries = (ranked.groupBy(k.district_id, category, rank_col)
               .agg(values.alias("_values"), F.max(k.district_name).alias("_dname")))
    meta = F.struct(metadata.series_column().alias("series"), F.lit(metadata.heading).alias("heading"))
    docs = entries.groupBy(k.district_id).agg(
        F.array_sort(F.collect_list(F.struct(F.col(rank_col).alias("_r"), F.struct(
            F.col(category).alias("geography"), F.col("_values").alias("values")).alias("_e")))).alias("_entries"),
        F.max("_dname").alias("district"))
    return docs.select(F.col(k.district_id).alias("id"), "district",
                       F.transform("_entries", lambda x: x["_e"]).alias("data"), meta.alias("meta"))
