"""Datasets declared as small specifications.

A dataset names its landing sources, the normaliser of each (raw snapshot ->
canonical rows, see ``sources.normalise``), a ``prepare`` step (pivot, derive,
roll up, ratios) and its published variants.  A variant picks the year
alignment (latest common year or all common years), the template, the series and
the chart metadata.  ``run`` turns raw inputs into the documents of one variant,
``run_all`` into those of all variants.  Both write the indicator rows (small: years x
geographies) to the checkpoint folder as soon as they are called, so the facts are
read once however many variants, alignments and template passes follow.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoindicators.geo.dim import Geography
from geoindicators.keys import OSLO_KEYS, Keys
from geoindicators.operators import align
from geoindicators.operators.scale import scale_min_max
from geoindicators.publish import document as doc
from geoindicators.publish.observe import Watch, invalid, unresolved
from geoindicators.publish.templates import Template
from geoindicators.session import materialize

STATUS, HISTORIC = "status", "historic"


@dataclass
class Variant:
    template: Template
    values: Sequence                     # series columns handed to the template
    heading: str
    series: list = field(default_factory=list)   # chart series metadata
    align: str | None = STATUS           # STATUS, HISTORIC or None (prepare aligns itself)
    scale: str | None = None             # column whose min/max goes into the metadata
    scale_after_align: bool = False
    drop_null: str | None = None         # drop rows where this column is null (after alignment)
    top_n: dict | None = None            # top-N documents: {"category", "n", "data_points"}


@dataclass
class DatasetSpec:
    name: str
    sources: Sequence[str]
    normalisers: Mapping[str, Callable[[DataFrame, Geography], DataFrame]]
    prepare: Callable[..., DataFrame]    # (inputs: dict[str, DataFrame], variant: str) -> indicator rows
    variants: Mapping[str, Variant]
    keys: Keys = OSLO_KEYS
    # the rows a variant shares with others: same key, same rows (default: all variants share them)
    rows_key: Callable[[str], object] = lambda variant: None
    # computed once from the inputs and handed to ``prepare`` in their place as {"base": rows}
    base: Callable[[dict], DataFrame] | None = None
    intermediate: bool = True            # whether a run keeps the normalised sources

    def variant(self, name: str) -> Variant:
        if name not in self.variants:
            raise ValueError(f"Unknown dataset type: {name!r} (known: {sorted(self.variants)})")
        return self.variants[name]


def normalise(spec: DatasetSpec, raw: Mapping[str, DataFrame], geo: Geography) -> dict[str, DataFrame]:
    missing = [s for s in spec.sources if s not in raw]
    if missing:
        raise ValueError(f"{spec.name}: missing sources {missing}")
    return {s: spec.normalisers[s](raw[s], geo) for s in spec.sources}


def indicator_rows(spec: DatasetSpec, variant_name: str, raw: Mapping[str, DataFrame], geo: Geography) -> DataFrame:
    """The rows a variant publishes, before alignment and templating (for inspection)."""
    spec.variant(variant_name)
    return _rows(spec, normalise(spec, raw, geo), variant_name)


def _rows(spec: DatasetSpec, inputs: dict[str, DataFrame], variant_name: str) -> DataFrame:
    if spec.base is not None:
        inputs = {"base": inputs["base"] if "base" in inputs else materialize(spec.base(inputs))}
    return spec.prepare(inputs, variant_name)


def run_all(spec: DatasetSpec, raw: Mapping[str, DataFrame], geo: Geography, published_date: str | None = None,
            published_form: bool = False, variants: Sequence[str] | None = None,
            on_invalid: str = "error", watch: Watch | None = None) -> dict[str, DataFrame]:
    """Documents of several variants (default: all): the sources are normalised, joined and rolled up once
    for all variants that share their rows.

    A ``watch`` observes the sources' rows as read and as resolved (what is missing there was rejected) and the indicator rows'
    invalid numbers in the same passes."""
    if watch is not None:
        raw = {**raw, **{s: watch.on(raw[s], f"read {s}", rows=F.count(F.lit(1))) for s in spec.sources if s in raw}}
    inputs = normalise(spec, raw, geo)
    if watch is not None:  # what a normaliser has left out is the difference of both counts
        inputs = {s: watch.on(df, f"source {s}", **unresolved(df, spec.keys)) for s, df in inputs.items()}
    if spec.base is not None:
        inputs = {"base": materialize(spec.base(inputs))}
    shared: dict = {}
    out = {}
    for name in variants if variants is not None else spec.variants:
        spec.variant(name)
        key = spec.rows_key(name)
        if key not in shared:
            rows = _rows(spec, inputs, name)
            shared[key] = materialize(rows if watch is None else watch.on(rows, f"indicators {len(shared)}", **invalid(rows, spec.keys)))
        out[name] = documents(spec, name, shared[key], published_date, published_form, on_invalid)
    return out


def run(spec: DatasetSpec, variant_name: str, raw: Mapping[str, DataFrame], geo: Geography,
        published_date: str | None = None, published_form: bool = False, on_invalid: str = "error") -> DataFrame:
    """Documents of one variant: (id, district, data, meta).

    ``published_form`` renders template values that are heterogeneous lists in
    the published JSON (template G) in that form instead of as typed structs.
    """
    return run_all(spec, raw, geo, published_date, published_form, [variant_name], on_invalid)[variant_name]


def documents(spec: DatasetSpec, variant_name: str, rows: DataFrame, published_date: str | None = None,
              published_form: bool = False, on_invalid: str = "error") -> DataFrame:
    """Documents of one variant from the dataset's (materialized) indicator rows."""
    v = spec.variant(variant_name)
    k = spec.keys
    scale_df = None
    if v.scale and not v.scale_after_align:
        scale_df = _scale(rows, v.scale, k)
    if v.align == STATUS:
        [rows] = align.status(rows, date=k.date)
    elif v.align == HISTORIC:
        [rows] = align.historic(rows, date=k.date)
    if v.scale and v.scale_after_align:
        scale_df = _scale(rows, v.scale, k)
    if v.drop_null:
        rows = rows.filter(F.col(v.drop_null).isNotNull())
    meta = doc.Metadata(heading=v.heading, series=list(v.series),
                        **({"published_date": published_date} if published_date else {}))
    if v.top_n:
        from geoindicators.operators.topn import top_n_categories
        cat, n = v.top_n["category"], v.top_n["n"]
        ranking = top_n_categories(rows, cat, v.top_n.get("rank_by", "total"), n, k)
        return doc.top_n_documents(rows, cat, list(v.values), ranking, meta, k, status=v.align == STATUS)
    values = v.values if isinstance(v.values, Mapping) else list(v.values)
    return doc.build_documents(rows, v.template, values, meta, k, scale=scale_df, materialize_rows=False,
                               published_form=published_form, on_invalid=on_invalid)


def _scale(rows: DataFrame, column: str, keys: Keys) -> DataFrame:
    mm = scale_min_max(rows, column, keys)
    return mm.select(F.array("value_min", "value_max").alias("value"), F.array("ratio_min", "ratio_max").alias("ratio"))
