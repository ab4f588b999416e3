import json
import os
import time

import pytest
from pyspark.sql import functions as F

from geoindicators.keys import Keys
from geoindicators.operators import rollup
from geoindicators.publish import commit
from geoindicators.publish import document as doc
from geoindicators.publish.templates import TemplateA
from geoindicators.publish.validate import assert_finite
from geoindicators.sources import sinks, snapshots
from geoindicators.streaming import arrivals


def _write(path, text, mtime=None):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    if mtime is not None:
        os.utime(path, (mtime, mtime))


def test_resolve_input_newest_and_missing(spark, tmp_path):
    d = tmp_path / "landing"
    d.mkdir()
    _write(d / "a.csv", "aar;x\n2020;1\n", time.time() - 100)
    _write(d / "b.csv", "aar;x\n2021;2\n", time.time())
    assert snapshots.resolve_input(spark, str(d), "*.csv").endswith("b.csv")
    empty = tmp_path / "empty"
    empty.mkdir()
    with pytest.raises(snapshots.NoSnapshotError):
        snapshots.resolve_input(spark, str(empty), "*.csv")


def test_read_snapshot_keeps_ids_as_strings_and_renames_year(spark, tmp_path):
    p = tmp_path / "s.csv"
    _write(p, "aar;delbydel_id;bydel_id;v\n2020;0101;01;1.5\n2020;;01;NaN\n")
    df = snapshots.read_snapshot(spark, str(p), schema="aar int, delbydel_id string, bydel_id string, v double")
    rows = df.orderBy("delbydel_id").collect()
    assert df.columns[0] == "date"
    assert [(r.delbydel_id, r.bydel_id, r.v) for r in rows] == [(None, "01", None), ("0101", "01", 1.5)]


def test_write_intermediate_and_documents(spark, tmp_path):
    df = spark.createDataFrame([(2020, "01", "Bydel A", "0101", "Grønland", 3, 1)],
                               "date int, district_id string, district_name string, sub_id string, sub_name string, "
                               "a long, b long")
    sinks.write_intermediate(df, str(tmp_path / "silver"))
    assert spark.read.parquet(str(tmp_path / "silver")).first().sub_name == "Grønland"
    sinks.write_intermediate(df, str(tmp_path / "silver-csv"), "csv", partition_by=())
    back = spark.read.option("sep", ";").option("header", True).csv(str(tmp_path / "silver-csv"))
    assert back.first().sub_name == "Grønland"
    r = rollup.add_ratios(rollup.aggregate(df, "sum", Keys()), ["a"], ["a", "b"])
    docs = doc.build_documents(r, TemplateA(), ["a"], doc.Metadata("H", [], "2020-01-01"), Keys())
    sinks.write_documents(docs, str(tmp_path / "gold"))
    names = sorted(p for p in os.listdir(tmp_path / "gold") if p.startswith("name="))
    assert names == ["name=00", "name=01"]
    got = {r.name: json.loads(r.json) for r in sinks.read_documents(spark, str(tmp_path / "gold")).collect()}
    assert got["01"]["data"][0]["geography"] == "Grønland"
    assert got["01"]["data"][0]["values"] == [{"value": 3, "ratio": 0.75, "date": 2020}]


def test_non_finite_values_are_rejected(spark):
    df = spark.createDataFrame([(1.0,), (float("inf"),)], "x double")
    with pytest.raises(Exception, match="Out of range"):
        assert_finite(df).collect()
    assert [r.x for r in assert_finite(df, on_invalid="null").collect()] == [1.0, None]


def test_arrivals_recompute_dependents(spark, tmp_path):
    landing = tmp_path / "landing"
    (landing / "dodsrater").mkdir(parents=True)
    _write(landing / "dodsrater" / "2024.csv", "aar;Bydel;v\n2024;Alna;1.0\n2024;Ullern;2.0\n")
    seen = []

    def on_arrival(source, deps, batch, batch_id):
        seen.append((source, deps, batch.count()))

    schema = "aar int, Bydel string, v double"
    ckpt = str(tmp_path / "ckpt")
    arrivals.run_available(spark, str(landing), {"dodsrater": schema}, on_arrival, checkpoint_root=ckpt)
    assert seen == [("dodsrater", ["levekaar_dodsrate"], 2)]
    # nothing new: no recompute; a new file: one more batch with just its rows
    arrivals.run_available(spark, str(landing), {"dodsrater": schema}, on_arrival, checkpoint_root=ckpt)
    assert len(seen) == 1
    _write(landing / "dodsrater" / "2025.csv", "aar;Bydel;v\n2025;Alna;1.5\n")
    arrivals.run_available(spark, str(landing), {"dodsrater": schema}, on_arrival, checkpoint_root=ckpt)
    assert seen[-1] == ("dodsrater", ["levekaar_dodsrate"], 1)


def _land(landing, source, columns, name="2024.csv"):
    from tests.dataset_fixtures import rows
    _, data = rows(source)
    src = landing / source
    src.mkdir(parents=True, exist_ok=True)
    _write(src / name, ";".join(columns) + "\n" + "\n".join(";".join("" if v is None else str(v) for v in r) for r in data) + "\n")


def _columns(source):
    import re

    from tests.dataset_fixtures import rows
    return [q or p for q, p in re.findall(r"(?:`([^`]+)`|(\w+)) (?:int|double|string|long)", rows(source)[0])]


def test_layout_publish_reads_text_and_keeps_intermediate_per_dataset(spark, tmp_path):
    from geoindicators.datasets.runner import Layout, publish
    from geoindicators.geo.oslo import oslo_geography

    landing = tmp_path / "landing"
    _land(landing, "neets", _columns("neets"))
    layout = Layout(str(landing), str(tmp_path / "intermediate"), str(tmp_path / "published"))
    geo = oslo_geography(spark)
    out = publish(spark, layout, "neets", "status", geo, "2024-01-01", write_intermediate=True)
    docs = {r.name: json.loads(r.json) for r in sinks.read_documents(spark, out).collect()}
    assert set(docs) == {"00", "01", "03"}
    kept = spark.read.parquet(str(tmp_path / "intermediate" / "neets" / "neets"))
    assert dict(kept.dtypes)["antall"] == "bigint" and dict(kept.dtypes)["andel"] == "double"


def test_both_sources_of_a_dataset_landing_together_publish_it_once(spark, tmp_path):
    from geoindicators.streaming.arrivals import dependents, recompute_available

    landing = tmp_path / "landing"
    sources = ["flytting-fra-etter-alder", "flytting-til-etter-alder"]
    for s in sources:
        _land(landing, s, _columns(s))
    schemas = {s: ", ".join(f"`{c}` string" for c in _columns(s)) for s in sources}
    published = []
    root = str(tmp_path / "state")
    got = recompute_available(spark, str(landing), schemas, published.append, root)
    assert got == published == sorted(set(dependents()[sources[0]]) | set(dependents()[sources[1]]))
    assert len(published) == len(set(published))
    assert recompute_available(spark, str(landing), schemas, published.append, root) == []
    # a publish that fails is done again
    _land(landing, sources[0], _columns(sources[0]), "2025.csv")

    def fail(name):
        raise RuntimeError(name)
    with pytest.raises(RuntimeError):
        recompute_available(spark, str(landing), schemas, fail, root)
    assert recompute_available(spark, str(landing), schemas, published.append, root) == sorted(dependents()[sources[0]])


def test_arrivals_need_a_known_source_and_a_lasting_folder(spark, tmp_path, monkeypatch):
    with pytest.raises(ValueError, match="No dataset reads"):
        arrivals.watch(spark, str(tmp_path), {"nope": "a int"}, lambda *a: None, checkpoint_root=str(tmp_path / "c"))
    monkeypatch.setattr(arrivals, "TEMPORARY", {"/"})   # as if the session's folder were a temporary one
    with pytest.raises(ValueError, match="lasting"):
        arrivals.watch(spark, str(tmp_path), {"neets": "a int"}, lambda *a: None)


def test_snapshot_ids_keep_leading_zeros_without_a_schema(spark, tmp_path):
    p = tmp_path / "s.csv"
    _write(p, "aar;delbydel_id;bydel_id;v\n2020;0101;01;1.5\n")
    r = snapshots.read_snapshot(spark, str(p)).first()
    assert (r.delbydel_id, r.bydel_id, r.date) == ("0101", "01", "2020")
    r = snapshots.read_snapshot(spark, str(p), schema="aar int, delbydel_id int, bydel_id int, v double").first()
    assert (r.delbydel_id, r.bydel_id, r.v) == ("0101", "01", 1.5)


def _one_district(spark, rows):
    return spark.createDataFrame(rows, "date int, district_id string, district_name string, sub_id string, sub_name string, a long, a_ratio double")


def test_district_with_sub_rows_only_has_its_own_entry(spark):
    df = _one_district(spark, [(2020, "01", "Bydel A", "0101", "S", 3, 0.5), (2020, "00", "Oslo i alt", None, None, 3, 0.5)])
    docs = doc.build_documents(df, TemplateA(), ["a"], doc.Metadata("H", [], "2020-01-01"), Keys())
    d = {r.name: json.loads(r.json) for r in doc.to_json_documents(docs).collect()}["01"]
    assert d["district"] == "Bydel A" and d["meta"]["scale"] == []
    assert [(e["id"], e["geography"], e["values"] == [], e["avgRow"], e["totalRow"]) for e in d["data"]] == [
        ("0101", "S", False, False, False), ("01", "Bydel A", True, True, False), ("00", "Oslo i alt", False, False, True)]


def test_zero_denominator_is_not_published_silently(spark):
    df = _one_district(spark, [(2020, "01", "NaN", None, None, 3, None), (2020, "00", "Oslo i alt", None, None, 3, 0.5)])
    meta = doc.Metadata("H", [], "2020-01-01")
    with pytest.raises(Exception, match="Out of range float value in a_ratio"):
        doc.build_documents(df, TemplateA(), ["a"], meta, Keys(), materialize_rows=False).collect()
    docs = doc.build_documents(df, TemplateA(), ["a"], meta, Keys(), on_invalid="null")
    assert {r.name: json.loads(r.json) for r in doc.to_json_documents(docs).collect()}["01"]["district"] == "NaN"


def test_template_g_published_form(spark):
    from geoindicators.operators import change
    from geoindicators.publish.templates import TemplateG
    df = spark.createDataFrame([(y, "01", "A", "0101", "S", 10 + y - 2018) for y in range(2018, 2021)],
                               "date int, district_id string, district_name string, sub_id string, sub_name string, "
                               "population long")
    r = rollup.aggregate(df, "sum", Keys())
    hist = change.growth_history(r, "population", 10, Keys())
    from geoindicators.operators.joins import join_on
    latest = join_on(r.filter("date = 2020"), hist, ["district_id", "sub_id"], "left", null_safe=["sub_id"])
    docs = doc.build_documents(latest, TemplateG(), ["population"], doc.Metadata("H", [], "2020-01-01"), Keys(),
                               published_form=True)
    got = {r.name: json.loads(r.json) for r in doc.to_json_documents(docs).collect()}
    assert got["01"]["data"][0]["values"] == [12.0, [10.0, 11.0, 12.0], 2020]


def _some_documents(spark, value, ids=("01", "St. Hans å+b"), bad=False):
    df = spark.createDataFrame([(i, f"Bydel {i}", value) for i in ids], "id string, district string, v double")
    return df.withColumn("v", F.when(F.lit(bad), F.raise_error(F.lit("no good"))).otherwise(F.col("v")))


def test_committed_versions_appear_at_once_and_failures_leave_the_old_one(spark, tmp_path):
    root = str(tmp_path / "published" / "neets")
    assert commit.current_version(spark, root) is None
    with pytest.raises(FileNotFoundError):
        commit.published_dir(spark, root, "status")
    out = commit.publish_documents({"status": _some_documents(spark, 1.0), "historisk": _some_documents(spark, 2.0)}, root)
    assert out["status"] == commit.published_dir(spark, root, "status")
    assert sorted(f for f in os.listdir(out["status"]) if not f.startswith(".")) == ["01.json", "St. Hans å+b.json"]
    with open(f"{out['status']}/St. Hans å+b.json", encoding="utf-8") as f:
        assert json.load(f) == {"id": "St. Hans å+b", "district": "Bydel St. Hans å+b", "v": 1.0}

    def now(variant):
        got = sinks.read_documents(spark, commit.published_dir(spark, root, variant)).collect()
        return {r.name: json.loads(r.json)["v"] for r in got}

    assert now("status") == {"01": 1.0, "St. Hans å+b": 1.0}
    for broken in (_some_documents(spark, 3.0, bad=True), _some_documents(spark, 3.0, ("a/b",)), _some_documents(spark, 3.0, ("01", "01"))):
        with pytest.raises(Exception):
            commit.publish_documents({"status": _some_documents(spark, 3.0), "historisk": broken}, root)
        assert now("status")["01"] == 1.0 and now("historisk")["01"] == 2.0  # no variant of a failed run shows
        assert len(os.listdir(f"{root}/_versions")) == 1
    commit.publish_documents({"status": _some_documents(spark, 4.0, ("01",))}, root)
    assert now("status") == {"01": 4.0} and now("historisk")["01"] == 2.0  # not part of the run: carried over
    for v in (5.0, 6.0):
        commit.publish_documents({"status": _some_documents(spark, v)}, root)
    assert len(os.listdir(f"{root}/_versions")) == 3 and now("status")["01"] == 6.0 and now("historisk")["01"] == 2.0


def test_publishing_returns_what_it_counted(spark, tmp_path):
    from geoindicators.datasets.runner import Layout, publish_dataset
    from geoindicators.geo.oslo import oslo_geography

    landing = tmp_path / "landing"
    _land(landing, "neets", _columns("neets"))
    path = landing / "neets" / "2024.csv"
    text = path.read_text(encoding="utf-8")
    last = text.strip().splitlines()[-1].split(";")
    names = text.splitlines()[0].split(";")
    i = next(n for n, c in enumerate(names) if "eografi" in c or "ydel" in c)
    last[i] = "Ingensteds"
    _write(path, text + ";".join(last) + "\n")
    out = publish_dataset(spark, Layout(str(landing), str(tmp_path / "i"), str(tmp_path / "p")), "neets", oslo_geography(spark), "2024-01-01")
    n = len(text.strip().splitlines())
    assert out.counts["read neets"] == {"rows": n}
    source = out.counts["source neets"]  # the row without a known place is rejected
    assert source["rows"] == n - 1 and source["no_district"] == 0 and source["no_sub_district"] == 9
    found = out.counts["indicators 0"]
    assert found["rows"] > 0 and found["non_finite"] == 0 and found["extra_names"] == 0
    assert all(os.path.exists(f"{d}/00.json") for d in out.values())


def test_observed_counts_of_invalid_rows(spark):
    from geoindicators.publish.observe import Watch, invalid
    df = spark.createDataFrame([("01", "A", 1.0, None), ("01", "B", float("nan"), 0.5), ("02", "C", None, None), (None, "X", float("inf"), 1.0)],
                               "district_id string, district_name string, a double, a_ratio double")
    watch = Watch()
    seen = watch.on(df, "x", **invalid(df, Keys()))
    unused = watch.on(df, "never run", n=F.count(F.lit(1)))
    assert unused.columns == df.columns
    assert seen.count() == 4
    assert watch.counts() == {"x": {"rows": 4, "non_finite": 2, "no_ratio": 1, "extra_names": 1}}
    with pytest.raises(ValueError):
        watch.on(df, "x", n=F.count(F.lit(1)))
