"""Sound coverage: profiles, best level per cell, attenuation, classes and ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from earshot.functions import scalars as S
from earshot.operators.grid import CELL, areas, on_cells
from earshot.operators.tiles import UID_BITS, attenuated, best_packed

# fixed values
PROFILES = [(450, 300, 103, "nearest_profile_300"), (750, 600, 109, "nearest_profile_600"), (1050, 900, 112, "nearest_profile_900"), (None, 1200, 115, "nearest_profile_1200_or_cap")]
THRESHOLDS = (65, 70, 75)
REFERENCE_M, BUILDING_DB = 30.0, 10.0
CLUTTER_DB = {
    "residential": 6.0,
    "industrial": 8.0,
    "commercial": 7.0,
    "forest": 10.0,
    "farmland": 1.0,
    "farmyard": 3.0,
    "open_green": 1.5,
    "orchard": 4.0,
    "scrub": 5.0,
    "wetland": 2.0,
    "water": 0.0,
    "bare": 0.5,
    "construction": 5.0,
    "restricted": 5.0,
    "parking": 1.0,
    "public": 5.0,
}
#: Key -> value -> class; the first key that has the object's value wins.
CLUTTER_RULES = {
    "landuse": {
        "allotments": "open_green",
        "cemetery": "open_green",
        "commercial": "commercial",
        "construction": "construction",
        "farmland": "farmland",
        "farmyard": "farmyard",
        "forest": "forest",
        "grass": "open_green",
        "industrial": "industrial",
        "meadow": "open_green",
        "military": "restricted",
        "orchard": "orchard",
        "quarry": "industrial",
        "railway": "industrial",
        "residential": "residential",
        "retail": "commercial",
        "vineyard": "orchard",
    },
    "natural": {
        "bare_rock": "bare",
        "beach": "bare",
        "grassland": "open_green",
        "heath": "scrub",
        "sand": "bare",
        "scrub": "scrub",
        "water": "water",
        "wetland": "wetland",
        "wood": "forest",
    },
    "leisure": {
        "garden": "open_green",
        "golf_course": "open_green",
        "nature_reserve": "open_green",
        "park": "open_green",
        "pitch": "open_green",
        "sports_centre": "open_green",
    },
    "amenity": {
        "hospital": "public",
        "parking": "parking",
        "school": "public",
        "university": "public",
    },
}
ROADS = [
    "motorway",
    "trunk",
    "primary",
    "secondary",
    "tertiary",
    "unclassified",
    "residential",
    "service",
    "living_street",
    "pedestrian",
    "track",
]
NUMBERING_BLOCK = 4096


def profile(power: Column) -> tuple[Column, Column, Column]:
    """(profile power, level at 30 m, rule) for a rated power."""
    pick = lambda i: F.coalesce(*(F.when(power <= top, F.lit(p[i])) if (top := p[0]) else F.lit(p[i]) for p in PROFILES))
    return pick(1), pick(2), pick(3)


def radius(spl: Column, threshold: float) -> Column:
    """Distance at which the free-field level falls to the threshold."""
    return REFERENCE_M * F.pow(F.lit(10.0), (spl - threshold) / 20)


def with_profiles(sites: DataFrame, thresholds=THRESHOLDS) -> DataFrame:
    power, spl, rule = profile(F.col("moc_w"))
    df = sites.withColumns({"prof_w": power, "spl30": spl, "rule": rule, "site_cnt": F.count(F.lit(1)).over(Window.partitionBy("x", "y"))})
    return df.withColumns({f"r_{t}": radius(F.col("spl30"), t) for t in thresholds})


def colocated(sites: DataFrame) -> DataFrame:
    return sites.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"), F.min("nr_ref").alias("first_ref"), F.max("moc_w").alias("top_power")).where("n > 1")


def dedup_sites(sites: DataFrame) -> DataFrame:
    """One site per coordinate, the strongest, then the lowest reference; site_uid
    numbers coordinates by their first source row. Numbering adds a block's offset
    to the place within the block, so no window holds all sites; sites stay dealt by
    block for the join, which is merged, since the planner might broadcast either side."""
    fields = [c for c in sites.columns if c not in ("x", "y")]
    best = F.min(F.struct((-F.col("moc_w")).alias("neg"), F.col("nr_ref").alias("ref"), F.struct(*fields).alias("row"))).alias("best")
    kept = sites.groupBy("x", "y").agg(best, F.min("lp").alias("first")).select("x", "y", "best.row.*", "first")
    kept = kept.withColumn("block", F.floor(F.col("first") / NUMBERING_BLOCK))
    sizes = kept.groupBy("block").agg(F.count(F.lit(1)).alias("n"))
    starts = sizes.select("block", F.coalesce(F.sum("n").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("block").orderBy("first"))
    return on_cells(kept.withColumn("place", place), starts, ["block"]).withColumn("site_uid", F.col("start") + F.col("place")).drop("block", "first", "place", "start")


def best_levels(sites: DataFrame, least: float, cell: int = CELL) -> DataFrame:
    """(cx, cy, level, site_uid): the strongest free-field level of each cell in
    reach of ``least`` dB (0 at least) and its site; equal levels go to the smaller uid.

    Level (in millionths) and uid are packed into one long and the maxima taken tile
    by tile, so cells are not shuffled; see ``tiles``.
    """
    if least < 0:
        raise ValueError("least must not be negative")
    found = best_packed(sites.select("x", "y", "spl30", "site_uid", radius(F.col("spl30"), least).alias("r")), REFERENCE_M, cell)
    uid = F.lit(2**UID_BITS - 1) - F.col("p").bitwiseAND(F.lit(2**UID_BITS - 1))
    return found.select("cx", "cy", (F.shiftright("p", UID_BITS) / 1e6).alias("level"), uid.alias("site_uid"))


def attenuated_levels(sites: DataFrame, clutter: DataFrame, buildings: DataFrame, thresholds=THRESHOLDS, asked: DataFrame | None = None, keep: str = "all") -> DataFrame:
    """(cx, cy, level, site_uid, db): ``attenuate`` of the best levels and their classes, for boxes of clutter and buildings,
    tile by tile; see ``tiles.attenuated``."""
    least = min(thresholds)
    if least < 0:
        raise ValueError("thresholds must not be negative")
    reach = sites.select("x", "y", "spl30", "site_uid", radius(F.col("spl30"), least).alias("r"))
    return attenuated(reach, clutter, buildings, REFERENCE_M, BUILDING_DB, tuple(thresholds), asked, keep)


def clutter_cells(touched: DataFrame) -> DataFrame:
    """(cx, cy, att_db) of cells that polygons of (seq, att_db) touch; the later one overwrites; 0 dB is never written."""
    return touched.where("att_db > 0").groupBy("cx", "cy").agg(F.max(F.struct("seq", "att_db")).alias("b")).select("cx", "cy", "b.att_db")


def attenuate(best: DataFrame, clutter: DataFrame, buildings: DataFrame, penalty: float = BUILDING_DB) -> DataFrame:
    """Level less clutter and building loss; the winning site stays as it was."""
    built = buildings.select("cx", "cy").distinct().withColumn("built", F.lit(penalty))
    out = on_cells(on_cells(best, clutter, ["cx", "cy"], "left"), built, ["cx", "cy"], "left")
    loss = F.coalesce("att_db", F.lit(0.0)) + F.coalesce("built", F.lit(0.0))
    return out.select("cx", "cy", F.round(F.col("level") - loss, 6).alias("level"), "site_uid")


def threshold_class(level: Column, thresholds=THRESHOLDS) -> Column:
    return F.coalesce(F.array_max(F.filter(F.array(*map(F.lit, thresholds)), lambda t: level >= t)), F.lit(0))


def covered(levels: DataFrame, thresholds=THRESHOLDS) -> DataFrame:
    """Covered cells with class, winner and the packed code."""
    df = levels.withColumn("db", threshold_class(F.col("level"), thresholds)).where("db > 0")
    return df.withColumn("code", F.col("site_uid") * 1000 + F.col("db"))


def ranges(cells: DataFrame, sites: DataFrame) -> DataFrame:
    """Range of each (site, class) with attributes and area; ranges never overlap."""
    return on_cells(areas(cells, "site_uid", "db"), sites.select("site_uid", "nr_ref", "moc_w", "prof_w", "spl30"), ["site_uid"])


def ring_ranges(nearest: DataFrame, thresholds=THRESHOLDS) -> DataFrame:
    """Free-field rings by distance to the nearest site, as cells per (site, class); the cells carry their site's radii."""
    db = F.greatest(*(F.when(F.col("dist") <= F.col(f"r_{t}"), t).otherwise(0) for t in thresholds))
    return areas(nearest.withColumn("db", db).where("db > 0"), "site_uid", "db")


def building_rows(objects: DataFrame) -> DataFrame:
    """Tagged objects that are buildings, with floors and a height (tag, else three metres a floor)."""
    levels = S.lenient_float(F.col("levels"))
    height = F.coalesce(F.when(S.lenient_float(F.col("height")) > 0, S.lenient_float(F.col("height"))), levels * 3)
    rows = objects.where("building is not null and building <> 'no'")
    return rows.select("osm_id", F.col("building").alias("bldg"), levels.alias("levels"), height.alias("height_m"))


def clutter_class(tags: dict[str, Column]) -> Column:
    return F.coalesce(*(F.when(tags[key] == value, F.lit(name)) for key, values in CLUTTER_RULES.items() for value, name in values.items()))


def clutter_rows(objects: DataFrame) -> DataFrame:
    """Objects with a clutter class that are no buildings."""
    tags = {k: F.col(f"`{k}`") for k in ("landuse", "natural", "leisure", "amenity")}
    loss = F.element_at(F.create_map(*(F.lit(v) for kv in CLUTTER_DB.items() for v in kv)), F.col("clutter"))
    rows = objects.where("building is null or building = 'no'").withColumn("clutter", clutter_class(tags)).where("clutter is not null")
    return rows.select("osm_id", "clutter", loss.alias("att_db"))


def roads(objects: DataFrame, width: int = 8) -> DataFrame:
    return objects.where(F.col("highway").isin(ROADS)).select("osm_id", "highway", F.substring("name", 1, width).alias("name"))


def layer_counts(values: DataFrame, top: int = 30) -> DataFrame:
    """(layer, value, n): the most frequent values of each layer."""
    counts = values.groupBy("layer", "value").agg(F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(Window.partitionBy("layer").orderBy(F.desc("n"), "value"))
    return counts.withColumn("place", place).where(F.col("place") <= top).drop("place")
