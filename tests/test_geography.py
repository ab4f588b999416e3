import pytest

from geoindicators.geo import resolve as R
from geoindicators.geo.oslo import oslo_geography
from geoindicators.keys import Keys


@pytest.fixture(scope="module")
def geo(spark):
    return oslo_geography(spark)


def _one(spark, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}")


def _resolved(df):
    r = df.first()
    return r.district_id, r.sub_id


def test_district_by_id(spark, geo):
    assert _resolved(R.district_by_id(_one(spark, "01"), "v", geo)) == ("01", None)
    assert R.district_by_id(_one(spark, "01"), "v", geo).first().district_name == "Bydel Gamle Oslo"
    assert _resolved(R.district_by_id(_one(spark, 1, "int"), "v", geo)) == (None, None)
    assert R.district_by_id(_one(spark, "00"), "v", geo).first().district_name == "Oslo i alt"
    assert _resolved(R.district_by_id(_one(spark, "42"), "v", geo)) == (None, None)


@pytest.mark.parametrize("name,expected", [
    ("Bydel Gamle Oslo", "01"), ("Gamle Oslo", "01"), ("BYDEL SAGENE", "03"), ("  Bydel Frogner  ", "05"),
    ("Bydel St. Hanshaugen", "04"), ("Bydel St.Hanshaugen", "04"), ("Bydel St Hanshaugen", "04"),
    ("Sentrum", "16"), ("Marka", "17"), ("Uoppgitt", "99"), ("Finnes ikke", None)])
def test_district_by_name(spark, geo, name, expected):
    assert R.district_by_name(_one(spark, name), "v", geo).first().district_id == expected


@pytest.mark.parametrize("value,dtype,expected", [("0101", "string", "0101"), (101, "int", "0101"),
                                                  (101.0, "double", "0101"), (9998, "int", None)])
def test_sub_by_id(spark, geo, value, dtype, expected):
    df = R.resolve_sub_id_with_fallback(_one(spark, value, dtype), "v", None, geo)
    r = df.first()
    assert r.sub_id == expected
    if expected:
        assert r.sub_name == "Lodalen" and r.district_id == "01"


@pytest.mark.parametrize("name,expected", [("Grønland", "0102"), ("BJØLSEN", "0303"), ("  Kampen  ", "0105"),
                                           ("Finnes ikke", None)])
def test_sub_by_name(spark, geo, name, expected):
    assert R.resolve_sub_name_with_fallback(_one(spark, name), "v", "v", geo).first().sub_id == expected


@pytest.mark.parametrize("value,dtype,expected", [("011", "string", "0101"), (11, "int", "0101"),
                                                  ("000", "string", None), ("999", "string", "9901")])
def test_legacy_id(spark, geo, value, dtype, expected):
    assert R.sub_by_legacy_id(_one(spark, value, dtype), "v", geo).first().sub_id == expected


def test_sub_district_wins_over_district(spark, geo):
    # "Sagene" is a sub-district and (with the prefix) a district
    r = R.resolve_one_column(_one(spark, "Sagene"), "v", geo).first()
    assert (r.sub_id, r.district_id) == ("0302", "03")


def test_labelled_and_codes(spark, geo):
    vals = spark.createDataFrame([("Oslo i alt",), ("Uoppgitt",), ("Delbydel Lodalen",), ("Bydel Alna",)], "v string")
    got = [(r.district_id, r.sub_id) for r in R.resolve_labelled(vals, "v", geo).collect()]
    assert got == [("00", None), ("99", None), ("01", "0101"), ("12", None)]
    sub_only = [(r.district_id, r.sub_id) for r in R.resolve_labelled(vals, "v", geo, sub_keeps_district=False).collect()]
    assert sub_only[2] == (None, "0101")
    codes = spark.createDataFrame([(100000,), (30101,), (30199,), (101,), (5,)], "v int")
    got = [(r.district_id, r.district_name, r.sub_id) for r in R.resolve_single_code(codes, "v", geo).collect()]
    assert got == [("00", "Oslo i alt", None), ("01", "Bydel Gamle Oslo", None),
                   ("99", "Uten registrert adresse", None), ("01", "Bydel Gamle Oslo", "0101"), (None, None, None)]


def test_district_id_for_name_errors_on_miss(spark, geo):
    ok = R.district_id_for_name(_one(spark, "Gamle Oslo"), "v", geo).first().district_id
    assert ok == "01"
    with pytest.raises(Exception, match="Unknown district"):
        R.district_id_for_name(_one(spark, "Atlantis"), "v", geo).collect()


def test_integrity(spark, geo):
    r = geo.integrity().first().asDict()
    assert all(v == 0 for v in r.values()), r


def test_add_district_id(spark, geo):
    df = spark.createDataFrame([("030101",), ("0301",)], "id string")
    out = [r.district for r in R.add_district_id(df, "id", geo).collect()]
    assert out == ["01"]


def _all_resolved(spark, geo):
    text = ["Sagene", "  kampen ", "101", "0101", "101.0", "10000", "30105", "30199", "Bydel Alna", "Frogner", "Oslo i alt", "Delbydel Lodalen", "Uoppgitt",
            "NaN", "1e2", "+101", "", " ", "Finnes ikke", None, "999", "district:01", "٣"]
    df = spark.createDataFrame([(t, u) for t in text for u in ("Gamle Oslo", None, "Bydel Sagene")], "v string, w string")
    k = Keys()
    ways = [R.district_by_id(df, "v", geo, k), R.district_by_name(df, "v", geo, k), R.sub_by_legacy_id(df, "v", geo, k),
            R.resolve_sub_id_with_fallback(df, "v", "w", geo, k, default_city=True), R.resolve_sub_name_with_fallback(df, "v", "w", geo, k),
            R.resolve_sub_name_district_column(df, "v", "w", geo, k), R.resolve_one_column(df, "v", geo, k), R.resolve_labelled(df, "v", geo, k),
            R.resolve_labelled(df, "v", geo, k, sub_keeps_district=False), R.resolve_code_and_sub_id(df, "v", "v", geo, k),
            R.resolve_code_and_sub_id(df, "v", "v", geo, k, id_from_code=True), R.resolve_single_code(df, "v", geo, k), R.resolve_mixed(df, "v", geo, k),
            R.resolve_names_parent_id(df, "w", "v", geo, k), R.district_id_for_name(df, "w", geo)]
    return [sorted(map(tuple, d.collect()), key=str) for d in ways]


def test_dictionary_and_joins_resolve_alike(spark, geo, monkeypatch):
    from geoindicators.geo import dim
    known = _all_resolved(spark, geo)
    assert geo.dictionary() is not None
    monkeypatch.setattr(dim, "MAX_ROWS", 3)  # a dimension over the bound is joined
    large = oslo_geography(spark)
    assert large.dictionary() is None
    assert _all_resolved(spark, large) == known


def test_dictionary_of_tables_equals_one_of_lists(spark, geo):
    from geoindicators.geo.dim import Geography
    tables = Geography(geo.districts, geo.subs, geo.district_aliases, geo.sub_aliases, geo.legacy)
    assert geo.local_rows is not None and tables.local_rows is None
    rows = [sorted(d.dictionary().table.collect(), key=str) for d in (geo, tables)]
    assert rows[0] == rows[1] and len(rows[0]) > 300


def test_a_key_with_two_meanings_is_an_error(spark):
    from geoindicators.geo.dim import from_tables
    geo = from_tables(spark, [("01", "A"), ("02", "B")], [], [("x", "01"), ("x", "02")], [], [])
    with pytest.raises(ValueError, match="more than one place"):
        R.district_by_name(_one(spark, "x"), "v", geo)
    with pytest.raises(ValueError, match="duplicate_district_aliases"):
        geo.check()
    assert from_tables(spark, [], [], [], [], []).dictionary().keys == 0
    empty = from_tables(spark, [], [], [], [], [])
    assert _resolved(R.resolve_mixed(_one(spark, "x"), "v", empty)) == (None, None)
