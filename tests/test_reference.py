import pytest

from escrutinio.operators import reference as R
from escrutinio.operators.upsert import upsert_latest
from escrutinio.sources import tables

PROVINCES = [
    (2, "02", "Beta", None, "r1", 4, 40.0, -3.0, 600, "ES-B"),
    (1, "01", "Alfa", "Alpha", "r1", 3, 41.0, -2.0, 399, "ES-A"),
    (3, "03", "Alfa", None, "r2", 5, 42.0, -1.0, 1, "ES-C"),
    (4, "04", "Orphan", None, "none", 9, 43.0, 0.0, 0, "ES-D"),
]
REGIONS = [("r1", "One", None, 4, "ES-1"), ("r2", "Two", None, 5, "ES-2"), ("r3", "Three", None, 6, "ES-3")]


def model(spark):
    provincias = spark.createDataFrame(
        PROVINCES,
        "id bigint, codigo_provincia string, nombre string, nombre_alternativo string, codigo_comunidad string,"
        " total_diputados bigint, latitud double, longitud double, habitantes bigint, iso_3166_2_prov string",
    )
    comunidades = spark.createDataFrame(
        REGIONS,
        "codigo_comunidad string, nombre string, nombre_alternativo string, numero_senadores bigint,"
        " iso_3166_2_ccaa string",
    )
    return R.regions_model(comunidades), R.provinces_model(provincias)


def test_region_seats(spark):
    rows = {r["region_code"]: (r["total_seats"], r["province_count"]) for r in R.region_seats(*model(spark)).collect()}
    assert rows == {"r1": (7, 2), "r2": (5, 1), "r3": (0, 0)}


def test_region_tree(spark):
    rows = {r["region_code"]: r for r in R.region_tree(*model(spark)).collect()}
    assert [p["province_name"] for p in rows["r1"]["provinces"]] == ["Alfa", "Beta"]
    assert rows["r1"]["provinces"][0]["province_alternative_name"] == "Alpha"
    assert rows["r3"]["provinces"] == [] and rows["r3"]["chunk"] == 0


def test_seats_by_province_leaves_orphans_out(spark):
    rows = R.seats_by_province(*model(spark)).collect()
    assert sorted(map(tuple, rows)) == [("Alfa", 3), ("Alfa", 5), ("Beta", 4)]


def test_lookup_of_a_repeated_name_takes_the_last(spark):
    votes = spark.createDataFrame([("1", "Alfa"), ("2", "Beta"), ("3", "Nowhere")], "id string, province_name string")
    found = R.province_lookup(votes, R.province_lookup_table(*model(spark))).collect()
    assert {r["id"]: (r["autonomic_region_name"], r["autonomic_region_iso_code"]) for r in found} == {
        "1": ("Two", "ES-2"),
        "2": ("One", "ES-1"),
        "3": (None, None),
    }


def test_population_weights_truncate_and_are_at_least_one(spark):
    weighted = R.population_weights(model(spark)[1])
    assert {r["id"]: r["weight"] for r in weighted.collect()} == {1: 399, 2: 600, 3: 1, 4: 1}
    assert R.weight_expansion(weighted).count() == 1001


def test_political_parties(spark):
    parties = R.political_parties(spark)
    assert parties.count() == 10 and parties.agg({"popularity": "sum"}).first()[0] == 18_600


def test_reference_from_files(spark, tmp_path):
    regions, provinces = model(spark)
    back = {v: k for k, v in R.PROVINCE_COLUMNS.items()}
    provinces.withColumnsRenamed(back).write.parquet(str(tmp_path / "p"))
    back = {v: k for k, v in R.REGION_COLUMNS.items()}
    regions.withColumnsRenamed(back).write.parquet(str(tmp_path / "r"))
    again = tables.reference_from_files(spark, str(tmp_path / "r"), str(tmp_path / "p"))
    assert sorted(map(tuple, again[1].collect())) == sorted(map(tuple, provinces.collect()))
    assert sorted(map(tuple, again[0].collect()), key=str) == sorted(map(tuple, regions.collect()), key=str)


def test_seats_from_rows(spark):
    assert tables.seats_from_rows(spark, [("Alfa", 3)]).collect() == [("Alfa", 3)]


SERVED = "k string, at bigint, v bigint"


def test_upsert_replaces_inserts_and_deletes(spark):
    current = spark.createDataFrame([("a", 1, 1), ("b", 1, 2), ("c", 9, 3), ("d", 5, 4)], SERVED)
    changes = spark.createDataFrame(
        [("a", 2, 10), ("a", 3, 11), ("b", 2, None), ("c", 8, 30), ("d", 5, 40), ("e", 1, 5), ("f", 1, None)], SERVED
    )
    rows = upsert_latest(current, changes, "k", ["at"], "v").collect()
    assert sorted(map(tuple, rows)) == [("a", 3, 11), ("c", 9, 3), ("d", 5, 40), ("e", 1, 5)]


def test_upsert_of_one_hot_key(spark):
    current = spark.createDataFrame([], SERVED)
    changes = spark.range(1000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE string(id) END AS k", "id AS at", "id AS v")
    rows = {r["k"]: r["v"] for r in upsert_latest(current, changes, "k", ["at"], "v").collect()}
    assert rows["hot"] == 999 and len(rows) == 667


def test_a_deletion_wins_a_tie(spark):
    current = spark.createDataFrame([("a", 0, 1)], "k string, s int, v int")
    changes = spark.createDataFrame([("a", 1, 7), ("a", 1, None)], "k string, s int, v int")
    assert upsert_latest(current, changes, "k", ["s"], "v").collect() == []
    with pytest.raises(ValueError, match="order"):
        upsert_latest(current, changes, "k", ["clock"], "v")
