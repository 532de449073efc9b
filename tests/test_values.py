"""Fixed tables entry by entry, published control points, ranks against plain windows."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from earshot.functions import geo
from earshot.functions import scalars as S
from earshot.operators import changes, coverage, grid, population, ranks, recommend
from earshot.plans import registry
from tests.conftest import SF

CLUTTER = """
landuse residential residential 6
landuse industrial industrial 8
landuse commercial commercial 7
landuse retail commercial 7
landuse forest forest 10
landuse farmland farmland 1
landuse farmyard farmyard 3
landuse meadow open_green 1.5
landuse grass open_green 1.5
landuse orchard orchard 4
landuse vineyard orchard 4
landuse cemetery open_green 1.5
landuse quarry industrial 8
landuse railway industrial 8
landuse construction construction 5
landuse military restricted 5
landuse allotments open_green 1.5
natural wood forest 10
natural scrub scrub 5
natural grassland open_green 1.5
natural heath scrub 5
natural wetland wetland 2
natural water water 0
natural bare_rock bare 0.5
natural sand bare 0.5
natural beach bare 0.5
leisure park open_green 1.5
leisure garden open_green 1.5
leisure golf_course open_green 1.5
leisure sports_centre open_green 1.5
leisure pitch open_green 1.5
leisure nature_reserve open_green 1.5
amenity parking parking 1
amenity school public 5
amenity university public 5
amenity hospital public 5
landuse recreation_ground - -
amenity kindergarten - -
""".split("\n")[1:-1]

# type, default floors, class, confidence, floor area for each person at a destination (0: none)
BUILDINGS = """
house 2 single_family high 0
detached 2 single_family high 0
bungalow 1 single_family high 0
farm 2 single_family high 0
farmhouse 2 single_family high 0
semidetached_house 2 semi_detached high 0
terrace 2 terrace high 0
apartments 3 multi_family high 0
residential 3 multi_family high 0
dormitory 3 dormitory high 25
yes 1.5 generic_yes medium 0
garage 1 non_occupied_fallback low 0
garages 1 non_occupied_fallback low 0
shed 1 non_occupied_fallback low 0
roof 1 non_occupied_fallback low 0
greenhouse 1 non_occupied_fallback low 0
outbuilding 1 non_occupied_fallback low 0
farm_auxiliary 1 non_occupied_fallback low 0
allotment_house 1 non_occupied_fallback low 0
sty 1 non_occupied_fallback low 0
barn 1 non_occupied_fallback low 0
carport 1 non_occupied_fallback low 0
school 3 destination medium 12
kindergarten 1 destination medium 12
university 3 destination medium 15
college 3 destination medium 15
hospital 3 destination medium 20
office 3 destination medium 25
government 1 destination medium 25
civic 1 destination medium 25
hotel 3 destination medium 25
public 1 destination medium 30
retail 3 destination medium 30
commercial 3 destination medium 30
supermarket 1 destination medium 30
service 1 destination medium 35
train_station 1 destination medium 35
industrial 1 destination medium 60
manufacture 1 destination medium 60
transportation 1 destination medium 60
church 1 destination medium 60
warehouse 1 destination medium 80
ruins 1 other low 0
""".split("\n")[1:-1]


def test_clutter_values(spark):
    keys = ["landuse", "natural", "leisure", "amenity"]
    rows = [(i, None, *(line.split()[1] if line.split()[0] == k else None for k in keys)) for i, line in enumerate(CLUTTER)]
    df = spark.createDataFrame(rows, "osm_id bigint, building string, " + ", ".join(f"`{k}` string" for k in keys))
    got = {r.osm_id: (r.clutter, r.att_db) for r in coverage.clutter_rows(df).collect()}
    for i, line in enumerate(CLUTTER):
        _, value, name, db = line.split()
        assert got.get(i) == (None if name == "-" else (name, float(db))), value


def test_the_first_key_wins(spark):
    df = spark.createDataFrame([(1, None, "none", "water", "park", None), (2, None, "forest", "water", None, None)], "osm_id bigint, building string, landuse string, natural string, leisure string, amenity string")
    assert {r.osm_id: r.clutter for r in coverage.clutter_rows(df).collect()} == {1: "water", 2: "forest"}


def test_building_values(spark):
    df = spark.createDataFrame([(i, line.split()[0], 0, 0, 600) for i, line in enumerate(BUILDINGS)], "bldg_id bigint, bldg string, levels bigint, height_m bigint, area_m2 bigint")
    got = {r.bldg: r for r in population.capacity_scores(df).collect()}
    for line in BUILDINGS:
        name, floors, kind, confidence, each = line.split()
        area = 600 * float(floors)
        want = (float(floors), kind, confidence, area / float(each) if float(each) else 0.0)
        assert (got[name].floors, got[name].class_name, got[name].confidence, got[name].destination) == pytest.approx(want), name


def test_census_code(spark):
    assert spark.range(1).select(grid.census_code(F.lit(5_072_499.9), F.lit(3_300_500.0))).first()[0] == "CRS3035RES500mN3300500E5072000"


@pytest.mark.parametrize("lat", [49.0, 50.0, 52.0, 54.9])
def test_metric_northing_on_the_central_meridian_is_the_arc(spark, lat):
    got = spark.range(1).select(*geo.to_metric(F.lit(lat), F.lit(19.0))).first()
    assert got[0] == pytest.approx(500_000, abs=1e-3) and got[1] == pytest.approx(_meridian(lat) * 0.9993 - 5_300_000, abs=1e-3)


def _meridian(lat):
    """Length of the meridian of GRS 80 from the equator, by plain integration."""
    import numpy as np

    a, e2 = 6_378_137.0, 0.006694380022903416
    phi = np.linspace(0, np.radians(lat), 200_001)
    return float(np.trapezoid(a * (1 - e2) / (1 - e2 * np.sin(phi) ** 2) ** 1.5, phi))


def test_metric_scale_off_the_meridian(spark):
    """Transverse Mercator is conformal: steps to the east and to the north grow alike."""
    rows = [(50.5, 22.3), (53.9, 14.4), (49.1, 20.0)]
    for lat, lon in rows:
        d = 1e-4
        pts = [(lat, lon), (lat + d, lon), (lat, lon + d)]
        df = spark.createDataFrame(pts, "lat double, lon double")
        e, n = geo.to_metric(F.col("lat"), F.col("lon"))
        (e0, n0), (e1, n1), (e2, n2) = df.select(e, n).collect()
        north = ((e1 - e0) ** 2 + (n1 - n0) ** 2) ** 0.5 / (_meridian(lat + d) - _meridian(lat))
        import math

        radius = 6_378_137.0 / math.sqrt(1 - 0.006694380022903416 * math.sin(math.radians(lat)) ** 2) * math.cos(math.radians(lat))
        east = ((e2 - e0) ** 2 + (n2 - n0) ** 2) ** 0.5 / (radius * math.radians(d))
        assert north == pytest.approx(east, rel=2e-5) and 0.9993 <= north < 1.0012


def test_equal_area_published_example(spark):
    """IOGP guidance note 7-2, Lambert azimuthal equal area, EPSG:3035: 50 N 5 E is E 3962799.45, N 2999718.85."""
    x, y = geo.to_equal_area(F.lit(50.0), F.lit(5.0))
    got = spark.range(1).select(x, y).first()
    assert got[0] == pytest.approx(3962799.45, abs=0.01) and got[1] == pytest.approx(2999718.85, abs=0.01)


def test_ranks_equal_windows(spark):
    draw = random.Random(1)
    df = spark.createDataFrame([(i, draw.randrange(40), draw.choice([None, 1, 2, 5])) for i in range(3_000)], "id bigint, v bigint, w bigint").repartition(7)
    order = [F.desc("v"), F.col("id")]
    w = Window.orderBy(*order)
    want = df.withColumns({"k": F.row_number().over(w), "s": F.sum(F.coalesce("w", F.lit(0))).over(w.rowsBetween(Window.unboundedPreceding, 0)), "t": F.ntile(7).over(w)})
    got = ranks.running(ranks.row_number(df, order, "k"), order, "w", "s").withColumn("t", ranks.ntile(F.col("k"), F.lit(3_000), 7))
    assert sorted(map(tuple, got.select("id", "k", "s", "t").collect())) == sorted(map(tuple, want.select("id", "k", "s", "t").collect()))
    assert ranks.row_number(df.limit(0), order, "k").count() == 0


@pytest.mark.parametrize(
    ("text", "slug"),
    [("Łódź ul. Żółta 5", "lodz_ul_zolta_5"), ("Čeština", "cestina"), ("naïve façade", "naive_facade"), ("ﬁn Ⅷ", "fin_viii"), ("Tiếng Việt", "tieng_viet"), ("a日b", "ab"), ("Søk", "sk"), ("½ mili", "12_mili"), (None, ""), (" -- ", "")],
)
def test_slugs(spark, text, slug):
    df = spark.createDataFrame([(text,)], "v string")
    assert df.select(S.ascii_key(F.col("v"))).first()[0] == slug


@pytest.mark.parametrize(
    ("text", "status", "flag"),
    [("tak", "TAK", 1), (" T a k ", "TAK", None), ("y", "TAK", None), ("T", "T", None), ("1", "1", None), ("0", "0", 0), ("no", "NIE", None), ("NIE", "NIE", 0), ("N-D", "N/D", None), ("n/d", "N/D", 0), ("brak", None, None), ("", None, 0), (None, None, 0), ("może", "MOŻE", None)],
)
def test_status_words(spark, text, status, flag):
    df = spark.createDataFrame([(text,)], "v string")
    assert tuple(df.select(S.yes_no_nd(F.col("v")), S.status_flag(F.col("v"))).first()) == (status, flag)


def _snapshots(spark):
    v5 = [("A", "100", "0", "X", "t"), ("B", "1", "", "Y", ""), ("C", "7", "7", "Z", None)]
    v6 = [("A", "100", "10", "X"), ("C", "70", None, "Z"), ("D", "5", "", 'he said "no"\\')]
    v9 = [("A", "900", "10", "X", "123"), ("C", "70", "", "W", None), ("D", "5", "", 'he said "no"\\', "")]
    fields = ["nr_ref", "moc_w", "wysokosc_nad_terenem_m", "gmina"]
    table = lambda rows, *more: spark.createDataFrame(rows, ", ".join(f"{f} string" for f in [*fields, *more]))
    return table(v5, "robocza"), table(v6), table(v9, "npm_m")


def test_registry_word_by_word(spark):
    v5, v6, v9 = _snapshots(spark)
    registry = changes.diff_chain([("V5", v5), ("V6", v6), ("V9", v9)])
    assert registry.columns == ["rule_id", "stage", "operation", "nr_ref", "field", "before", "after", "reason", "source", "confidence"]
    height, blank = "Korekta wysokości montażu zgodnie z kontrolami domenowymi V5–V8.", "Zmiana zarejestrowana między zatwierdzonymi snapshotami pipeline."
    power, model = "Korekta jednostki lub wartości mocy po kontroli jakości.", "Ujednolicenie mocy modelowej, w tym analogowej SAD do odpowiednika DSE V9."
    want = {
        ("V5→V6", "remove_field", "*", "robocza", "column present", "column removed", "Usunięcie technicznej kolumny roboczej ze schematu kolejnego snapshotu.", "V5.csv -> V6.csv", 1.0),
        ("V5→V6", "update", "A", "wysokosc_nad_terenem_m", "0", "10", height, "V5.csv -> V6.csv", 1.0),
        ("V5→V6", "update", "C", "wysokosc_nad_terenem_m", "7", "", height, "V5.csv -> V6.csv", 0.9),
        ("V5→V6", "update", "C", "moc_w", "7", "70", power, "V5.csv -> V6.csv", 1.0),
        ("V5→V6", "disable", "B", "record", "active", "disabled", "Rekord usunięty z aktywnego snapshotu.", "V6.csv", 1.0),
        ("V5→V6", "add", "D", "record_json", "", r'{"gmina": "he said \"no\"\\", "moc_w": "5", "nr_ref": "D"}', "Rekord dodany między snapshotami.", "V6.csv", 1.0),
        ("V6→V9", "update", "A", "moc_w", "100", "900", model, "V6.csv -> V9.csv", 1.0),
        ("V6→V9", "update", "A", "npm_m", "", "123", "Uzupełnienie wysokości n.p.m. z danych SRTM.", "V6.csv -> V9.csv", 0.9),
        ("V6→V9", "update", "C", "gmina", "Z", "W", blank, "V6.csv -> V9.csv", 1.0),
    }
    rows = registry.collect()
    assert {tuple(r)[1:] for r in rows} == want and len(rows) == len(want)
    for r in rows:
        assert r.rule_id == "CORR-" + hashlib.sha256(f"{r.stage}|{r.operation}|{r.nr_ref}|{r.field}".encode()).hexdigest()[:12].upper()
    back = changes.replay(v5, registry, ["V5→V6", "V6→V9"])
    assert sorted(map(tuple, back.select(v9.columns).collect())) == sorted(tuple(v or "" for v in r) for r in v9.collect()) and set(back.columns) == set(v9.columns)
    assert changes.replay_violations(v5, registry.where("stage = 'V5→V6'")).count() == 0
    with pytest.raises(ValueError, match="two versions"):
        changes.diff_chain([("V5", v5)])


def test_imputation_defaults(spark):
    rows = [("a", 1, "x", 300.0, 0.0), ("b", 2, "x", 300.0, 10.0), ("c", 3, "x", 500.0, 20.0), ("d", 4, "x", 300.0, 2.0), ("e", 5, "x", 300.0, -1.0)]
    df = spark.createDataFrame(rows, "nr_ref string, lp int, kind string, power double, height double")
    got = {r.nr_ref: (r.imputed, r.exact_peers, r.peers) for r in changes.impute_heights(df).collect()}
    mean = (10 + 2 + 20 / 3) / (1 + 1 + 1 / 3)
    assert got == {"a": (round(mean * 2) / 2, 2, 3), "e": (round(mean * 2) / 2, 2, 3)}
    alone = spark.createDataFrame([("z", 9, "y", 300.0, 0.0)], df.schema)
    with pytest.raises(Exception, match="no reference rows for the kind y"):
        changes.impute_heights(df.union(alone)).collect()


def test_words_of_results(spark):
    rules = {r.p: r.rule for r in spark.createDataFrame([(450,), (451,), (750,), (1050,), (1051,)], "p int").select("p", coverage.profile(F.col("p"))[2].alias("rule")).collect()}
    assert rules == {450: "nearest_profile_300", 451: "nearest_profile_600", 750: "nearest_profile_600", 1050: "nearest_profile_900", 1051: "nearest_profile_1200_or_cap"}
    assert recommend.PURCHASE == (
        "candidate_id nr_ref wojewodztwo powiat gmina teryt_gmi recommended_action priority_class priority_score_v13 risk_class recommended_power_class_w new_pop_ge65_proxy "
        "flood_risk_pop_ge65_gain_proxy redundancy_gain_pop_proxy failure_loss_pop_night_proxy estimated_cost_pln cost_per_new_person_ge65_pln candidate_lat candidate_lon "
        "candidate_source candidate_type effect_method"
    ).split()
    got = registry.QUERIES["r11_purchase_list"](spark, SF)
    assert got.columns == recommend.PURCHASE
    words = {c: {r[0] for r in got.select(c).distinct().collect()} for c in ("candidate_source", "effect_method", "recommended_action")}
    assert words["candidate_source"] <= {"nearest_public_osm_object", "gap_representative_point", "existing_siren_V9_V10"}
    assert words["effect_method"] <= {"gap_population_proxy", "existing_siren_primary_coverage_proxy"}
    assert words["recommended_action"] <= {"nowa_syrena", "walidacja_terenowa", "integracja", "modernizacja"}
    rows = [(r.priority_score_v13, r.new_pop_ge65_proxy, r.failure_loss_pop_night_proxy) for r in got.collect()]
    assert rows == sorted(rows, reverse=True) and {r.candidate_id.split("-")[0] for r in got.collect()} <= {"NEW", "EXIST", "GSM"}
    kinds = {r.source: (r.type, r.object_group) for r in registry.QUERIES["r03_candidate_sites"](spark, SF).collect()}
    assert kinds.get("gap_representative_point", ("gap_centroid", "brak_obiektu_publicznego_w_promieniu")) == ("gap_centroid", "brak_obiektu_publicznego_w_promieniu")
    left = registry.QUERIES["p09_residuals"](spark, SF).select("confidence", "reason").distinct().collect()
    assert set(map(tuple, left)) <= {("low", "no_usable_building_capacity")}


def test_numbers_of_the_normalised_register(spark):
    rows = [("1 200", None), (" 1200,5 ", 1200.5), ("7.25", 7.25), ("1,2,3", None), ("", None), ("x", None), ("1e3", 1000.0)]
    got = [r[0] for r in spark.createDataFrame(rows, "v string, w double").select(S.plain_number(F.col("v"))).collect()]
    assert got == [w for _, w in rows]
    days = spark.createDataFrame([("31-12-2020",), ("1-2-2021",), ("2021-02-03",), ("32-1-2020",)], "d string").select(S.date_iso(F.col("d"))).collect()
    assert [r[0] for r in days] == ["2020-12-31", "2021-02-01", "2021-02-03", ""]
