"""Dasymetric population: census cells spread over buildings, every cell total kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.operators.grid import on_cells

# fixed values
DEFAULT_FLOORS = {
    "apartments": 3.0,
    "bungalow": 1.0,
    "college": 3.0,
    "commercial": 3.0,
    "detached": 2.0,
    "dormitory": 3.0,
    "farm": 2.0,
    "farmhouse": 2.0,
    "hospital": 3.0,
    "hotel": 3.0,
    "house": 2.0,
    "industrial": 1.0,
    "manufacture": 1.0,
    "office": 3.0,
    "residential": 3.0,
    "retail": 3.0,
    "school": 3.0,
    "semidetached_house": 2.0,
    "terrace": 2.0,
    "university": 3.0,
    "warehouse": 1.0,
    "yes": 1.5,
}
GROUPS = {
    "allotment_house": "non_occupied_fallback",
    "apartments": "multi_family",
    "barn": "non_occupied_fallback",
    "bungalow": "single_family",
    "carport": "non_occupied_fallback",
    "detached": "single_family",
    "dormitory": "dormitory",
    "farm": "single_family",
    "farm_auxiliary": "non_occupied_fallback",
    "farmhouse": "single_family",
    "garage": "non_occupied_fallback",
    "garages": "non_occupied_fallback",
    "greenhouse": "non_occupied_fallback",
    "house": "single_family",
    "outbuilding": "non_occupied_fallback",
    "residential": "multi_family",
    "roof": "non_occupied_fallback",
    "semidetached_house": "semi_detached",
    "shed": "non_occupied_fallback",
    "sty": "non_occupied_fallback",
    "terrace": "terrace",
    "yes": "generic_yes",
}
DIVISORS = {
    "church": 60.0,
    "civic": 25.0,
    "college": 15.0,
    "commercial": 30.0,
    "government": 25.0,
    "hospital": 20.0,
    "hotel": 25.0,
    "industrial": 60.0,
    "kindergarten": 12.0,
    "manufacture": 60.0,
    "office": 25.0,
    "public": 30.0,
    "retail": 30.0,
    "school": 12.0,
    "service": 35.0,
    "supermarket": 30.0,
    "train_station": 35.0,
    "transportation": 60.0,
    "university": 15.0,
    "warehouse": 80.0,
}
RESIDENTIAL = ["single_family", "semi_detached", "terrace", "multi_family", "dormitory"]
NIGHT_SHARE, DESTINATION_SHARE = 0.55, 0.45


def _lookup(table: dict, key: Column) -> Column:
    return F.element_at(F.create_map(*(F.lit(v) for kv in table.items() for v in kv)), key)


def floors(bldg: Column, levels: Column, height: Column) -> Column:
    """Levels, else height / 3, else the type's default; between 1 and 30."""
    value = F.when(levels > 0, levels.cast("double")).when(height > 0, height / 3).otherwise(F.coalesce(_lookup(DEFAULT_FLOORS, bldg), F.lit(1.0)))
    return F.least(F.lit(30.0), F.greatest(F.lit(1.0), value))


def capacity_scores(buildings: DataFrame) -> DataFrame:
    """Adds floors, group, class, confidence and the five scores: night, low (``yes``
    at its low rate), fallback (``yes`` at its full rate), generic, destination."""
    df = buildings.withColumn("floors", floors(F.col("bldg"), F.col("levels"), F.col("height_m")))
    area = F.greatest(F.col("area_m2").cast("double"), F.lit(1.0))
    fa, group, divisor = area * F.col("floors"), F.coalesce(_lookup(GROUPS, F.col("bldg")), F.lit("other")), _lookup(DIVISORS, F.col("bldg"))
    night = (
        F.when(group == "single_family", F.col("floors") * 4)
        .when(group == "semi_detached", F.col("floors") * 6)
        .when(group == "terrace", F.col("floors") * 3 * F.greatest(F.lit(1.0), area / 70))
        .when(group == "multi_family", fa / 35)
        .when(group == "dormitory", fa / 25)
        .otherwise(0.0)
    )
    generic = F.when(group == "non_occupied_fallback", F.greatest(F.lit(0.5), fa / 200)).otherwise(F.greatest(F.lit(1.0), fa / 120))
    own = F.when(group == "dormitory", fa / 25).otherwise(0.0)
    destination = F.greatest(own, F.coalesce(fa / divisor, F.lit(0.0)))
    confidence = F.when(group.isin(RESIDENTIAL), "high").when((group == "generic_yes") | divisor.isNotNull(), "medium").otherwise("low")
    return df.withColumns(
        {
            "night": night, "low": F.when(group == "generic_yes", fa / 200).otherwise(0.0), "fallback": F.when(group == "generic_yes", fa / 45).otherwise(0.0), "generic": generic,
            "destination": destination, "class_name": F.when((group == "other") & divisor.isNotNull(), "destination").otherwise(group), "confidence": confidence,
        }
    )


def to_census(points: DataFrame, grid: DataFrame, x0: int, y0: int, side: int = 500) -> DataFrame:
    """``points`` with gx, gy and cell_id (null outside the grid)."""
    at = points.withColumns({"gx": F.floor((F.col("x") - x0) / side).cast("bigint"), "gy": F.floor((F.col("y") - y0) / side).cast("bigint")})
    return on_cells(at, grid.select("gx", "gy", "cell_id"), ["gx", "gy"], "left")


def score_sums(scored: DataFrame) -> DataFrame:
    """Per census cell: sums of the scores, buildings, and buildings with a night score."""
    names = ["night", "low", "fallback", "generic", "destination"]
    return scored.where("cell_id is not null").groupBy("cell_id").agg(
        *(F.sum(n).alias(f"sum_{n}") for n in names), F.count(F.lit(1)).alias("buildings"), F.count_if(F.col("night") + F.col("low") > 0).alias("candidates")
    )


def cell_models(grid: DataFrame, sums: DataFrame) -> DataFrame:
    """Per census cell the night and day mode and their denominators; mode 0 where nothing can hold people."""
    s = lambda n: F.coalesce(F.col(f"sum_{n}"), F.lit(0.0))
    explicit = s("night") + s("low")
    night_mode = F.when(explicit > 0, 1).when(s("fallback") > 0, 2).when(s("generic") > 0, 3).otherwise(0)
    night_denom = F.when(explicit > 0, explicit).when(s("fallback") > 0, s("fallback")).when(s("generic") > 0, s("generic")).otherwise(0.0)
    out = on_cells(grid.select("cell_id", "tot"), sums, ["cell_id"], "left").withColumns({"night_mode": night_mode, "night_denom": night_denom})
    day = NIGHT_SHARE * F.col("night_denom") + DESTINATION_SHARE * s("destination")
    day_mode = F.when(day > 0, 1).when(s("generic") > 0, 2).otherwise(0)
    day_denom = F.when(day > 0, day).when(s("generic") > 0, s("generic")).otherwise(0.0)
    keep = ["cell_id", "tot", "night_mode", "night_denom", "day_mode", "day_denom"]
    return out.withColumns({"day_mode": day_mode, "day_denom": day_denom}).select(*keep, F.coalesce("buildings", F.lit(0)).alias("buildings"))


def allocate(scored: DataFrame, models: DataFrame) -> DataFrame:
    """Buildings with pop_night and pop_day: the cell's people in proportion to the score that its mode selects."""
    met = on_cells(scored.where("cell_id is not null"), models.drop("buildings"), ["cell_id"])
    mode = F.col("night_mode")
    night = F.when(mode == 1, F.col("night") + F.col("low")).when(mode == 2, F.col("fallback")).when(mode == 3, F.col("generic")).otherwise(0.0)
    day = F.when(F.col("day_mode") == 1, NIGHT_SHARE * night + DESTINATION_SHARE * F.col("destination")).when(F.col("day_mode") == 2, F.col("generic")).otherwise(0.0)
    share = lambda score, denom: F.coalesce(F.try_divide(F.col("tot") * score, F.col(denom)), F.lit(0.0))
    return met.withColumns({"pop_night": share(night, "night_denom"), "pop_day": share(day, "day_denom")})


def residuals(grid: DataFrame, models: DataFrame, x0: int, y0: int, side: int = 500) -> DataFrame:
    """Populated cells that no building can hold, as points in the cell's middle."""
    rows = models.where("tot > 0 and (night_denom <= 0 or day_denom <= 0)")
    rows = on_cells(rows, grid.select("cell_id", "gx", "gy"), ["cell_id"])
    left = lambda d: F.when(F.col(d) <= 0, F.col("tot").cast("double")).otherwise(0.0)
    words = (F.lit("low").alias("confidence"), F.lit("no_usable_building_capacity").alias("reason"))
    middle = lambda g, o: o + (F.col(g) + 0.5) * side
    return rows.select("cell_id", "tot", left("night_denom").alias("pop_night"), left("day_denom").alias("pop_day"), *words, middle("gx", x0).alias("x"), middle("gy", y0).alias("y"))


def population_points(allocated: DataFrame, left: DataFrame) -> DataFrame:
    """Buildings and residuals in one schema with their source."""
    a = allocated.select(F.lit("building").alias("origin"), F.col("bldg_id").alias("object_id"), "cell_id", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), "pop_night", "pop_day")
    b = left.select(F.lit("residual").alias("origin"), F.col("cell_id").alias("object_id"), "cell_id", "x", "y", "pop_night", "pop_day")
    return a.unionByName(b)


def balance(grid: DataFrame, points: DataFrame) -> DataFrame:
    sums = points.groupBy("cell_id").agg(F.sum("pop_night").alias("night"), F.sum("pop_day").alias("day"))
    out = on_cells(grid.select("cell_id", "tot"), sums, ["cell_id"], "left").na.fill(0.0, ["night", "day"])
    return out.withColumns({"off_night": F.abs(F.col("night") - F.col("tot")), "off_day": F.abs(F.col("day") - F.col("tot"))})


def by_range(points: DataFrame, ranges: DataFrame) -> DataFrame:
    """People per (site, class); ranges without people have zeros."""
    sums = points.where("db > 0").groupBy("site_uid", "db").agg(F.sum("pop_night").alias("pop_night"), F.sum("pop_day").alias("pop_day"))
    return on_cells(ranges.select("site_uid", "db"), sums, ["site_uid", "db"], "left").na.fill(0.0)


def by_site(points: DataFrame, sites: DataFrame, thresholds) -> DataFrame:
    """Per site and threshold: people of the class, and of the class and all above."""
    steps = sites.select("site_uid", F.explode(F.array(*map(F.lit, thresholds))).alias("db"))
    sums = points.where("db > 0").groupBy("site_uid").agg(
        *(F.sum(F.when(F.col("db") == t, F.col(p))).alias(f"{p}_{t}") for t in thresholds for p in ("pop_night", "pop_day"))
    )
    pick = lambda p, test: sum((F.when(test(t), F.coalesce(F.col(f"{p}_{t}"), F.lit(0.0))).otherwise(0.0) for t in thresholds), F.lit(0.0))
    out = on_cells(steps, sums, ["site_uid"], "left")
    return out.select(
        "site_uid", "db", *(pick(p, lambda t: F.col("db") == t).alias(p) for p in ("pop_night", "pop_day")),
        *(pick(p, lambda t: F.lit(t) >= F.col("db")).alias(f"{p}_ge") for p in ("pop_night", "pop_day")),
    )
