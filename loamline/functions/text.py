"""Names and texts: scene folders, areas, raster names, columns, flags, seasons and priorities.

Regular expressions over Cyrillic text carry (?iU): Java folds case and finds word borders by Unicode only then.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names, aliases and patterns that inputs use.
SCENE_PATTERN = r"(?i)KANOPUS_(\d{8})_(\d{6})_\d+\.(L\d)\.(MS|PMS|PAN)\.SCN01"
AREAS = {"амга": "Амга", "amga": "Амга", "юнкор": "Юнкор", "yunkor": "Юнкор", "юнкюр": "Юнкор", "yunkyur": "Юнкор"}
SLUGS = {"Амга": "amga", "Юнкор": "yunkor", "Юнкюр": "yunkyur", "amga": "amga", "yunkor": "yunkor", "yunkyur": "yunkyur"}
TRUE_WORDS = ["1", "true", "yes", "да", "y"]
SEASONS = {"early": (501, 615), "mid": (616, 731), "late": (801, 930)}
PRODUCT_SCORES, OTHER_PRODUCT = {"MS": 0, "PMS": 10, "PAN": 20}, 50
LEVEL_SCORES, OTHER_LEVEL = {"L2": 0, "L1": 1}, 5
# Usage texts of agricultural land (roots of words), what excludes them, and the strict rule.
INCLUDE = r"(?iU)сельскох|сельхоз|пастбищ|сенокос|сенокош|пашн|пахот|крестьян|фермер|кфх|личн\w*\s+подсобн\w*\s+хозяйств|\bлпх\b|животновод|скотовод|коневод|табун|оленевод|сайылык|сайылыч|полев\w*\s+участ|сельскохозяйственн\w*\s+угод|фонд\s+перераспределен|выращиван\w*\s+зернов|агрокомплекс|пастбища\s+и\s+сенокосы"
EXCLUDE = r"(?iU)садов|огород|дач|жил|дом|ижс|улиц|дорог|лес|кладбищ|связ|энерг|транспорт|гидротех|шлюз|дамб|канал|водопровод|полигон|отход|скотомогиль|биотерм|часовн|кордон|аэродром|котельн|подстанц|вл-|лэп|\bтп\b|баня|охот|рыбал|развлеч|культур|истор|ритуал|гараж|коммун|автосерв|азс|карьер|строитель|промышлен|склад|грэс|медицин|санатор|лагер|парк|свинар|убойн|летн\w*\s+усад|усадьб|кордона?"
STRICT_KEEP = r"(?iU)\bпашн\w*\b|\bпастбищ\w*\b|\bсенокос\w*\b|\bсенокош\w*\b|сельскохозяйственн\w*\s+использован|сельскохозяйственн\w*\s+производств|сельхозпроизводств|сельскохозяйственн\w*\s+угод|полев\w*\s+участ"
STRICT_DROP = r"(?iU)кфх|фермер|животновод|скотовод|коневод|оленевод|сайылык|личн\w*\s+подсобн\w*\s+хозяйств(?!.*полев\w*\s+участ)|\bлпх\b(?!.*полев\w*\s+участ)|под\s+личное\s+подсобное\s+хозяйство(?!.*полев)|под\s+сельскохозяйственные\s+объекты|фонд\s+перераспределен"
USAGE_CODE = "003001000000"
# Folders that name a product, and what tells an archive's area (with order numbers).
PRODUCT_FOLDERS = ["MS", "PAN", "PMS", "SCN01", "SCN02"]
ARCHIVE_SIGNS = {"amga": ["амга", "3926868"], "yunkor": ["юнкор", "юнк", "3927029"]}


def nonblank(x: Column) -> Column:
    """Trimmed text, NULL if nothing is left."""
    return F.nullif(F.trim(x.cast("string")), F.lit(""))


def found(x: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match; NULL where there is no match."""
    return F.when(x.rlike(pattern), F.regexp_extract(x, pattern, group))


def looked_up(key: Column, table: dict, other: Column) -> Column:
    out = other
    for k, v in reversed(table.items()):
        out = F.when(key == k, F.lit(v)).otherwise(out)
    return out


def scene_parts(name: Column) -> dict[str, Column]:
    """date (NULL if it is none), time, level and product of a scene's folder name; all NULL where the name is another."""
    date = F.try_to_date(found(name, SCENE_PATTERN, 1), "yyyyMMdd")
    ok = date.isNotNull()
    part = lambda i: F.when(ok, F.upper(found(name, SCENE_PATTERN, i)))
    return {"date": date, "time": part(2), "level": part(3), "product": part(4)}


def area_of_folder(folder: Column) -> Column:
    low = F.lower(folder)
    return F.when(low.contains("амга"), "Амга").when(low.contains("юнкор"), "Юнкор").otherwise("unknown")


def canonical_area(area: Column) -> Column:
    """Known names by alias, others trimmed; NULL for blank."""
    text = nonblank(area)
    return looked_up(F.translate(F.lower(text), "ё", "е"), AREAS, text)


def area_slug(area: Column) -> Column:
    """A name for files: by alias, else ASCII letters and digits joined by "_"; "area" if none is left."""
    name = F.coalesce(canonical_area(area), area)
    plain = F.lower(F.regexp_replace(F.regexp_replace(name, "[^A-Za-z0-9]+", "_"), "^_+|_+$", ""))
    return looked_up(name, SLUGS, F.coalesce(F.nullif(plain, F.lit("")), F.lit("area")))


def area_year_of_file(name: Column, suffix: str = "parcel_stats") -> dict[str, Column]:
    """area and year of AREA_YEAR_suffix.csv."""
    pattern = rf"(?i)^([^_]+)_(\d{{4}})_{suffix}\.csv$"
    raw = found(name, pattern, 1)
    return {"area": F.coalesce(canonical_area(raw), raw), "year": found(name, pattern, 2).cast("int")}


def raster_name_parts(name: Column) -> dict[str, Column]:
    """site, year, year2, season and feature: SITE_YEAR_YEAR_FEATURE or SITE_YEAR[_SEASON]_FEATURE, whatever the extension."""
    stem = F.regexp_replace(F.element_at(F.split(name, "/"), -1), r"(?<=.)\.[^.]*$", "")
    pair, single = r"^([^_]+)_(\d{4})_(\d{4})_(.+)$", r"^([^_]+)_(\d{4})_(.+)$"
    is_pair = stem.rlike(pair)
    rest = found(stem, single, 3)
    season = F.when(~is_pair, F.nullif(F.regexp_extract(rest, r"^(annual|early|mid|late)_", 1), F.lit("")))
    feature = F.regexp_replace(rest, r"^(annual|early|mid|late)_", "")
    feature = F.when(feature.endswith("_ms_composite"), "ms_composite").otherwise(feature)
    return {"site": found(stem, single, 1), "year": found(stem, single, 2).cast("int"), "year2": found(stem, pair, 3).cast("int"), "season": season, "feature": F.when(is_pair, found(stem, pair, 4)).otherwise(feature)}


def flag(x: Column) -> Column:
    """Text that says yes, whatever its case and blanks around it."""
    return F.coalesce(F.lower(F.trim(x.cast("string"))).isin(TRUE_WORDS), F.lit(False))


def season_of(day: Column) -> Column:
    """early, mid or late by month and day; NULL outside the seasons."""
    at = F.month(day) * 100 + F.dayofmonth(day)
    out = F.lit(None).cast("string")
    for name, (low, high) in SEASONS.items():
        out = F.when(at.between(low, high), name).otherwise(out)
    return out


def scene_score(product: Column, level: Column) -> Column:
    """Lower is better: product, then level."""
    return looked_up(F.upper(product), PRODUCT_SCORES, F.lit(OTHER_PRODUCT)) + looked_up(F.upper(level), LEVEL_SCORES, F.lit(OTHER_LEVEL))


def scene_id(source: Column, footprint: Column) -> Column:
    """Name of a scene's archive or folder without .zip and .gbd; where that only names a product, the deepest part of the footprint's path that names a scene, without its extension."""
    name = F.regexp_replace(F.regexp_replace(F.element_at(F.split(source, r"[/\\]"), -1), r"(?i)\.zip$", ""), r"(?i)\.gbd$", "")
    parts = F.reverse(F.split(footprint, r"[/\\]"))
    scene = F.get(F.filter(parts, lambda p: F.upper(p).startswith("KANOPUS") | p.startswith("102_")), F.lit(0))
    return F.when(name.isin(PRODUCT_FOLDERS), F.coalesce(F.regexp_replace(scene, r"(?<=.)\.[^.]*$", ""), name)).otherwise(name)


def archive_area(name: Column) -> Column:
    """Area of a scene archive by its name or order number; else the name itself without .zip."""
    low = F.lower(name)
    out = F.regexp_replace(low, r"(?<=.)\.[^.]*$", "")
    for slug, signs in reversed(ARCHIVE_SIGNS.items()):
        found_ = F.lit(False)
        for s in signs:
            found_ = found_ | low.contains(s)
        out = F.when(found_, slug).otherwise(out)
    return out


def plain_name(x: Column) -> Column:
    """Letters and digits only, in lower case."""
    return F.regexp_replace(F.lower(x), r"[^\p{L}\p{N}]+", "")


def year_in(x: Column) -> Column:
    """First 20dd in a text."""
    return found(x, r"(20\d{2})", 1).cast("int")


def leading_number(x: Column) -> Column:
    """First run of digits as a number; NULL without one."""
    return F.regexp_extract(x.cast("string"), r"(\d+)", 1).try_cast("bigint")


def top_folder(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), 1)


def file_kind(path: Column) -> Column:
    """raster, vector, table or other, by extension."""
    ext = F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))
    return F.when(ext.isin("tif", "tiff"), "raster").when(ext.isin("gpkg", "geojson", "json", "shp"), "vector").when(ext == "csv", "table").otherwise("other")


def template_score(stem: Column, area: str, year: int) -> Column:
    """How well a raster's name fits as a template: 100 for riskscore or 40 for risk, 30 for the year, 30 for the area."""
    name = plain_name(stem)
    base = F.when(name.contains("riskscore"), 100).when(name.contains("risk"), 40).otherwise(0)
    return base + F.when(name.contains(str(year)), 30).otherwise(0) + F.when(name.contains(area.lower()), 30).otherwise(0)


def usage_core(text: Column, include: str = INCLUDE, exclude: str = EXCLUDE) -> Column:
    """Usage texts that name agricultural use and nothing that excludes it."""
    return F.coalesce(text.rlike(include) & ~text.rlike(exclude), F.lit(False))


def usage_strict(text: Column, keep: str = STRICT_KEEP, drop: str = STRICT_DROP) -> Column:
    flat = F.regexp_replace(F.lower(text), r"\s+", " ")
    return F.coalesce(flat.rlike(keep) & ~flat.rlike(drop), F.lit(False))


def as_category(x: Column) -> Column:
    """Text of a category; NULL is the category "nan"."""
    return F.coalesce(x.cast("string"), F.lit("nan"))


# ---------------------------------------------------------------- column names, on the driver

# Features by canonical name; patterns are tried in order, on whole names first.
FEATURE_PATTERNS = {
    "parcel_id": [r"^parcel_id$", r"^id$", r"^cad_num$"],
    "risk_score_mean": [r"^risk_score_mean$", r"^risk_mean$", r"risk.*mean"],
    "hotspot_share": [r"^hotspot_share$", r"hotspot.*share"],
    "water_occurrence_mean": [r"^water_occurrence_mean$", r"water_occurrence.*mean"],
    "ndvi_mean": [r"^ndvi_mean$", r"ndvi.*mean", r"ndvi.*avg"],
    "ndwi_mean": [r"^ndwi_mean$", r"ndwi.*mean", r"ndwi.*avg"],
    "osavi_mean": [r"^osavi_mean$", r"osavi.*mean", r"savi.*mean"],
    "brightness_mean": [r"^brightness_mean$", r"brightness.*mean"],
    "nir_red_ratio_mean": [r"^nir_red_ratio_mean$", r"nir_red_ratio.*mean", r"nir.*red.*ratio.*mean"],
    "red_green_ratio_mean": [r"^red_green_ratio_mean$", r"red_green_ratio.*mean", r"red.*green.*ratio.*mean"],
    "water_share": [r"^water_share$", r"water.*share$"],
    "persistence_water_share": [r"^persistence_water_share$", r"persistence.*water.*share"],
    "change_share": [r"^change_share$", r"change.*share$"],
    "texture_anomaly_share": [r"^texture_anomaly_share$", r"texture.*anomaly.*share"],
    "delta_ndvi_mean": [r"^delta_ndvi_mean$", r"delta_ndvi.*mean", r"d1__ndvi_mean$"],
    "delta_ndwi_mean": [r"^delta_ndwi_mean$", r"delta_ndwi.*mean", r"d1__ndwi_mean$"],
    "slope_mean": [r"^slope_mean$", r"slope.*mean"],
    "tpi_mean": [r"^tpi_mean$", r"tpi.*mean"],
    "roughness_mean": [r"^roughness_mean$", r"roughness.*mean"],
    "curvature_mean": [r"^curvature_mean$", r"curvature.*mean"],
    "tri_mean": [r"^tri_mean$", r"tri.*mean"],
    "dem_mean": [r"^dem_mean$", r"dem.*mean"],
    "aspect_sin_mean": [r"^aspect_sin_mean$", r"aspect_sin.*mean"],
    "aspect_cos_mean": [r"^aspect_cos_mean$", r"aspect_cos.*mean"],
    "area_m2": [r"^area_m2$", r"^shape_area$", r"geom_area"],
    "cad_num": [r"^cad_num$"],
}
CURRENT = ["ndvi_mean", "ndwi_mean", "osavi_mean", "brightness_mean", "nir_red_ratio_mean", "red_green_ratio_mean", "water_share", "persistence_water_share", "change_share", "texture_anomaly_share", "water_occurrence_mean", "slope_mean", "tpi_mean", "roughness_mean", "curvature_mean", "tri_mean", "dem_mean"]
DYNAMIC = ["delta_ndvi_mean", "delta_ndwi_mean"]
BASELINE = ["risk_score_mean", "hotspot_share"]


def tidy_columns(df: DataFrame) -> DataFrame:
    """Column names trimmed, blanks to "_", "%" to "pct"."""
    return df.toDF(*[re.sub(r"\s+", "_", c.strip()).replace("%", "pct") for c in df.columns])


def match_for(names: list[str], patterns: list[str]) -> str | None:
    """The first name that a pattern matches whole; else among the first pattern's partial matches one that says "mean", then the shortest."""
    tests = [re.compile(p, re.I) for p in patterns]
    whole = (n for t in tests for n in names if t.fullmatch(n))
    parts = (hits for t in tests if (hits := [n for n in names if t.search(n)]))
    best = next(whole, None)
    return best if best is not None else min(next(parts, []), key=lambda n: ("mean" not in n.lower(), len(n)), default=None)


def with_canonical_names(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """df with a column for each feature that one of its own stands for, and which that is."""
    df = tidy_columns(df)
    known = {name: name if name in df.columns else match_for(df.columns, patterns) for name, patterns in FEATURE_PATTERNS.items()}
    known = {k: v for k, v in known.items() if v is not None}
    return df.withColumns({k: F.col(f"`{v}`") for k, v in known.items() if k != v}), known


def feature_groups(names: list[str]) -> dict[str, list[str]]:
    """The table's features by group."""
    lists = {"current": CURRENT, "dynamic": DYNAMIC, "baseline": BASELINE}
    out = {g: [c for c in wanted if c in names] for g, wanted in lists.items()}
    out["temporal"] = [c for c in names if c.startswith(("prev1__", "d1__", "roll2__"))]
    out["misc"] = [c for c in ("area_m2", "log_area_m2", "year_gap", "n_missing_primary", "centroid_lon", "centroid_lat") if c in names]
    return out


def training_features(names: list[str]) -> tuple[list[str], list[str]]:
    """Numeric and categorical columns to train on: no baseline feature nor what is made of one, each once."""
    g = feature_groups(names)
    base = {f"{p}{b}" for p in ("", "prev1__", "d1__", "roll2__") for b in BASELINE}
    return [c for c in dict.fromkeys(g["current"] + g["dynamic"] + g["temporal"] + g["misc"]) if c not in base], [c for c in ("area",) if c in names]
