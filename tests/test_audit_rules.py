"""The audit's rules against a table of their attributes, one case a rule, and hand-made registers."""

import pytest
from pyspark.sql import functions as F

from earshot.operators import audit as A

GOOD = {
    "lp": "1", "nr_ref": "R1", "data": "1.1.2020", "wojewodztwo": "W", "powiat": "P", "gmina": "G", "wlasciciel": "Gmina", "rodzaj_syreny": "analogowa", "moc_w": "3000", "wysokosc": "10",
    "gsm": "TAK", "sk_psp": "TAK", "sygn_osp": "TAK", "sygn_ol": "NIE", "wgr_sygn": "NIE", "lat": "52", "lon": "19", "jednostka_psp": "KP", "kod_swd": "S",
}
# what is changed in a sound record -> (rule, column, category, severity, confidence) of the anomalies
CASES = [
    ({"moc_w": "abc"}, [("parse_error", "Moc [W]", "technical", "high", 1.0)]),
    ({"moc_w": "-"}, [("parse_error", "Moc [W]", "technical", "high", 1.0), ("missing_power", "Moc [W]", "technical", "high", 1.0)]),
    ({"moc_w": ""}, [("missing_power", "Moc [W]", "technical", "high", 1.0)]),
    ({"moc_w": "N/D"}, [("missing_power", "Moc [W]", "technical", "high", 1.0)]),
    ({"wysokosc": None}, [("missing_height", "Wysokość nad terenem [m]", "technical", "high", 1.0)]),
    ({"moc_w": "1999"}, [("analogue_power", "Moc [W]", "technical", "high", 1.0)]),
    ({"moc_w": "299", "rodzaj_syreny": "Cyfrowa"}, [("digital_power", "Moc [W]", "technical", "medium", 0.75)]),
    ({"moc_w": "299", "rodzaj_syreny": "inna"}, [("digital_power", "Moc [W]", "technical", "medium", 0.75)]),
    ({"moc_w": "5001", "rodzaj_syreny": ""}, [("digital_power", "Moc [W]", "technical", "medium", 0.75)]),
    ({"wysokosc": "100"}, [("height_sea_level", "Wysokość nad terenem [m]", "technical", "high", 0.98)]),
    ({"wysokosc": "99"}, [("height_review", "Wysokość nad terenem [m]", "technical", "medium", 0.55)]),
    ({"wysokosc": "60,5"}, []),
    ({"wysokosc": "2.9"}, [("height_low", "Wysokość nad terenem [m]", "technical", "high", 0.95)]),
    ({"lat": ""}, [("coordinates_missing", "Lat", "geographic", "high", 1.0)]),
    ({"lat": "", "lon": "brak"}, [("coordinates_missing", "Lat|Long", "geographic", "high", 1.0), ("parse_error", "Long", "technical", "high", 1.0)]),
    ({"lat": "19", "lon": "52"}, [("coordinates_swapped", "Lat|Long", "geographic", "high", 0.99)]),
    ({"lat": "70", "lon": "3"}, [("latitude_outside", "Lat", "geographic", "high", 1.0), ("longitude_outside", "Long", "geographic", "high", 1.0)]),
    ({"lat": "70"}, [("latitude_outside", "Lat", "geographic", "high", 1.0)]),
    ({"kod_swd": "", "jednostka_psp": "N/D"}, [("missing_unit", "Jednostka PSP", "administrative", "high", 1.0), ("missing_unit", "Kod SWD", "administrative", "high", 1.0)]),
    ({"gsm": "NIE", "rodzaj_syreny": "cyfrowa"}, [("digital_without_gsm", "GSM", "logical", "medium", 0.75)]),
    ({"gsm": "moze", "rodzaj_syreny": "cyfrowa"}, [("digital_without_gsm", "GSM", "logical", "medium", 0.75)]),
    ({"wgr_sygn": "TAK", "sygn_osp": "NIE"}, [("group_without_paths", "Wgr. sygn.|Sygn. OSP|Sygn. OL", "logical", "high", 0.95)]),
    ({"wlasciciel": " OSP", "sygn_osp": "n"}, [("osp_owner_without_signal", "Właściciel|Sygn. OSP", "logical", "medium", 0.7)]),
    ({"wlasciciel": "OSP Nowa", "sygn_osp": "NIE"}, []),
    ({"gsm": "NIE", "sk_psp": "NIE"}, [("no_control", "GSM|SK PSP", "logical", "low", 0.6)]),
    ({"sk_psp": "N/D"}, [("missing_status", "SK PSP", "technical", "medium", 0.8)]),
    ({"sygn_ol": "N/D"}, []),
    ({"sygn_ol": "N/D", "rodzaj_syreny": "cyfrowa"}, [("missing_status", "Sygn. OL", "technical", "medium", 0.8)]),
    ({"sygn_ol": "-"}, [("missing_status", "Sygn. OL", "technical", "medium", 0.8)]),
    ({"sygn_ol": "no"}, []),
]


def fired(spark, rows):
    df = spark.createDataFrame([tuple(r[n] for n in A.HEADERS) for r in rows], ", ".join(f"{n} string" for n in A.HEADERS))
    return A.fired_rules(A.evidence(A.with_gaps(A.prepare(df))))


@pytest.fixture(scope="module")
def found(spark):
    rows = [GOOD | {"lp": str(i), "nr_ref": f"R{i}", "powiat": f"P{i}"} | change for i, (change, _) in enumerate(CASES)]
    out = {}
    for r in fired(spark, rows).where("kind = 'anomaly'").collect():
        out.setdefault(int(r.lp), []).append((r.rule, r.field, r.category, r.severity, r.confidence))
    return out


@pytest.mark.parametrize("i", range(len(CASES)))
def test_rule(found, i):
    assert sorted(found.get(i, [])) == sorted(CASES[i][1]), CASES[i][0]


def test_duplicates_look_at_row_number_and_reference(spark):
    rows = [GOOD | {"lp": "1", "nr_ref": "A"}, GOOD | {"lp": " 1", "nr_ref": "B"}, GOOD | {"lp": "3", "nr_ref": ""}, GOOD | {"lp": "4", "nr_ref": None}]
    got = sorted((r.field, r.raw, r.value, r.reason) for r in fired(spark, rows).where("rule = 'duplicate_id'").collect())
    assert got == [
        ("Lp.", " 1", "1", "Duplikat identyfikatora Lp."), ("Lp.", "1", "1", "Duplikat identyfikatora Lp."),
        ("Nr ref.", "", "", "Duplikat identyfikatora Nr ref."), ("Nr ref.", "", "", "Duplikat identyfikatora Nr ref."),
    ]


def test_corrections(spark):
    rows = [GOOD | {"lp": str(i), "nr_ref": f"R{i}", "moc_w": p} for i, p in enumerate(["3000", "3100", "3300", "", "9000"])]
    rows += [GOOD | {"lp": "9", "nr_ref": "R9", "wysokosc": "120", "sygn_osp": " yes", "lat": "19", "lon": "52", "kod_swd": "", "gsm": ""}]
    got = {(r.lp, r.field): (r.value, r.method, r.confidence, r.scope) for r in fired(spark, rows).where("kind = 'correction'").collect()}
    assert got == {
        ("3", "Moc [W]"): ("3100", "srednia lokalna", 0.55, "powiat+rodzaj"),
        ("4", "Moc [W]"): ("3100", "srednia analogowych", 0.9, "global analogowa"),
        ("9", "Wysokość nad terenem [m]"): ("10", "srednia montazu nad terenem", 0.88, "rodzaj=analogowa"),
        ("9", "Sygn. OSP"): ("TAK", "standaryzacja TAK/NIE/N/D", 1.0, "regula logiczna"),
        ("9", "Lat"): ("52", "regula logiczna", 0.99, "lat/long swap"),
        ("9", "Long"): ("19", "regula logiczna", 0.99, "lat/long swap"),
        ("9", "Kod SWD"): ("S", "dominanta lokalna", 0.83, "wojewodztwo+powiat"),
        ("9", "GSM"): ("TAK", "dominanta lokalna", 0.9, "powiat+rodzaj"),
    }


def test_outliers_use_the_first_scope_with_ten_rows(spark):
    rows = [GOOD | {"lp": str(i), "nr_ref": f"R{i}", "moc_w": str(3000 + 10 * (i % 5)), "powiat": "P" if i < 12 else "Q"} for i in range(15)]
    rows += [GOOD | {"lp": "90", "nr_ref": "R90", "moc_w": "3100"}, GOOD | {"lp": "91", "nr_ref": "R91", "moc_w": "3100", "powiat": "Q"}]
    got = {r.lp: (r.category, r.severity, r.confidence, r.reason) for r in fired(spark, rows).where("rule = 'power_outlier'").collect()}
    assert got == {
        "90": ("relational", "medium", 0.72, "Moc odbiega od mediany grupy (powiat+rodzaj, n=13) o wiecej niz 2.5 MAD."),
        "91": ("relational", "medium", 0.72, "Moc odbiega od mediany grupy (wojewodztwo+rodzaj, n=17) o wiecej niz 2.5 MAD."),
    }


def test_clean_record_is_not_flagged(spark):
    df = spark.createDataFrame([tuple((GOOD | {"sygn_ol": "no"})[n] for n in A.HEADERS)], ", ".join(f"{n} string" for n in A.HEADERS))
    ready = A.with_gaps(A.prepare(df))
    rows = A.fired_rules(A.evidence(ready))
    assert {r.kind for r in rows.collect()} == {"correction"}
    normal = A.normalise(ready, A.quality_flags(A.anomalies(rows)))
    row = normal.first()
    assert len(normal.columns) == 41 and (row.is_clean_record, row.record_status, row.max_anomaly_severity, row.sygn_ol_status) == (1, "OK", "0", "NO")


def test_empty_register(spark):
    df = spark.createDataFrame([], ", ".join(f"{n} string" for n in A.HEADERS))
    ready = A.with_gaps(A.prepare(df))
    rows = A.fired_rules(A.evidence(ready))
    assert rows.count() == 0 and A.quality_table(ready, 41).where(F.col("value") > 0).count() == 1
    assert A.audit_summary(ready, A.anomalies(rows), A.corrections(rows)).where("value > 0").count() == 1
