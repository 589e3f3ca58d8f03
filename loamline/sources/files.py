"""Listings, tables, archives and reports. Files are read by Spark, so any store that Spark reads will do."""

from __future__ import annotations

import csv
import io
import json
import zipfile
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import nulls, text
from ..operators import geometry
from ..operators.features import PARCEL_YEAR, keep_first, union_all
from ..session import opened, unused, written

# Columns of the cadastre's tables, footprints' endings, names of a statistics table's keys and flags.
CADASTRE = ["CAD_N", "STATUS", "C_COST", "AREA", "UTL_ID", "UTL_DOC", "OBJ_WKT"]
CADASTRE_NAMES = ["cad_num", "status", "c_cost", "area_m2", "utl_id", "utl_doc", "wkt"]
FOOTPRINTS = r"(?i)\.gbd\.(shp|geojson|gpkg)$|_gbd\.shp$"
ID_COLUMNS, FLAG_COLUMNS = ["parcel_id", "cad_num", "id"], ["is_valid_for_full_analytics", "is_valid", "valid", "ok"]


def listing(spark: SparkSession, root: str, pattern: str = "*", recursive: bool = True) -> DataFrame:
    """(path, length, modificationTime) of files; their content is not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).option("pathGlobFilter", pattern).load(root).select("path", "length", "modificationTime")


def contents(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root).select("path", "content")


def footprint_rows(rows: DataFrame) -> DataFrame:
    """Rows whose path is a footprint's."""
    return rows.filter(F.col("path").rlike(FOOTPRINTS))


def footprints(files: DataFrame) -> DataFrame:
    return footprint_rows(files).dropDuplicates(["path"])


def classified(files: DataFrame, root: str) -> DataFrame:
    """files with relpath, folder and kind."""
    rel = F.regexp_replace(F.col("path"), r"^(?:file:)?/*" + root.removeprefix("file:").strip("/") + "/*", "")
    return files.withColumn("relpath", rel).withColumns({"folder": text.top_folder(F.col("relpath")), "kind": text.file_kind(F.col("relpath"))})


def not_coloured(files: DataFrame, suffix: str) -> DataFrame:
    """Inputs without those that are outputs themselves."""
    return files.filter(~F.regexp_replace("path", r"\.[^.]*$", "").endswith(suffix))


def risk_years(files: DataFrame, area: str) -> DataFrame:
    """Years for which an area has a risk layer."""
    return files.select(F.regexp_extract(F.col("path"), rf"/{area}_(\d{{4}})_risk_score\.tif$", 1).try_cast("int").alias("year")).filter("year is not null").distinct()


def template_raster(files: DataFrame, area: str, year: int) -> DataFrame:
    """The raster that fits best as a template (path), by name; none if none fits at all."""
    stem = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]*$", "")
    scored = files.withColumn("score", text.template_score(stem, area, year)).filter("score > 0")
    return scored.orderBy(F.desc("score"), F.length("path"), "path").limit(1)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Paths that a manifest names: trimmed, without blank lines, with forward slashes."""
    return spark.read.text(path).select(F.translate(F.trim("value"), "\\", "/").alias("path")).filter("path <> ''")


def table(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with header, separated by commas or, if that makes one column, by semicolons; columns are strings."""
    df = spark.read.csv(path, header=True)
    return spark.read.csv(path, header=True, sep=";") if len(df.columns) == 1 and ";" in df.columns[0] else df


def json_files(spark: SparkSession, root: str, pattern: str = "*.json") -> DataFrame:
    """(path, text, error): whole JSON texts; error for those that don't parse."""
    df = contents(spark, root, pattern).select("path", F.decode("content", "utf-8").alias("text"))
    return df.withColumn("error", F.when(F.try_parse_json("text").isNull(), F.lit("not JSON")))


def uniform_tables(spark: SparkSession, root: str, pattern: str) -> list[tuple[DataFrame, str]]:
    """(rows, name of the column with their file's name) for each kind of header among the CSVs that match: files of one header are one reader, however many they are."""
    found = listing(spark, root, pattern, False)
    first = spark.read.option("pathGlobFilter", pattern).text(root).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"), "value")
    heads = first.filter("at = 0").withColumn("n", F.monotonically_increasing_id()).groupBy("path").agg(F.min_by(F.regexp_replace("value", "^\\ufeff", ""), "n").alias("head"))
    kinds = [r.head for r in heads.select("head").distinct().orderBy("head").collect()]
    out = []
    for head in kinds:
        paths = [r.path for r in heads.filter(F.col("head") == head).select("path").orderBy("path").collect()] if len(kinds) > 1 else None
        sep = ";" if ";" in head and "," not in head else ","
        reader = spark.read.option("header", True).option("sep", sep).schema(", ".join(f"`{c}` string" for c in next(csv.reader([head], delimiter=sep))))
        df = reader.csv(paths) if paths else reader.option("pathGlobFilter", pattern).csv(root)
        name = unused("file", df)
        out.append((df.withColumn(name, F.col("_metadata.file_name")), name))
    return out if found.limit(1).count() else []


def parcel_stats(spark: SparkSession, root: str) -> DataFrame:
    """All AREA_YEAR_parcel_stats.csv of a folder as one table, with canonical names, area, year and is_valid. Files with the same header are read together."""
    parts = []
    for table_, file in uniform_tables(spark, root, "*_parcel_stats.csv"):
        keys = text.area_year_of_file(F.col(file))
        df, known = text.with_canonical_names(table_.withColumns({"_k1": keys["area"], "_k2": keys["year"]}).drop(file))
        wanted = [c for c in known if c not in ("parcel_id", "cad_num")]
        parts.append(df.select(F.col("_k1").alias("area"), F.col("_k2").alias("year"), F.col("parcel_id").cast("string").alias("parcel_id"), *[nulls.number(F.col(c)).alias(c) for c in wanted]))
    if not parts:
        raise FileNotFoundError(f"no parcel statistics in {root}")
    return union_all(parts).join(valid_flags(spark, root), PARCEL_YEAR, "left")


def valid_flags(spark: SparkSession, root: str) -> DataFrame:
    """(area, year, parcel_id, is_valid) of all AREA_YEAR_parcel_stats_valid.csv; the first row of a key counts."""
    parts = []
    for table_, file in uniform_tables(spark, root, "*_parcel_stats_valid.csv"):
        keys = text.area_year_of_file(F.col(file), "parcel_stats_valid")
        df = text.tidy_columns(table_.withColumns({"_k1": keys["area"], "_k2": keys["year"], "_at": F.monotonically_increasing_id()}).drop(file))
        key, flag = (next((c for c in names if c in df.columns), None) for names in (ID_COLUMNS, FLAG_COLUMNS))
        if key and flag:
            parts.append(df.select(F.col("_k1").alias("area"), F.col("_k2").alias("year"), F.col(key).cast("string").alias("parcel_id"), text.flag(F.col(flag)).alias("is_valid"), "_at"))
    if not parts:
        return spark.createDataFrame([], "area string, year int, parcel_id string, is_valid boolean")
    return keep_first(union_all(parts), PARCEL_YEAR, ["_at"]).drop("_at")


def zipped_tables(spark: SparkSession, path: str, columns: list[str] = CADASTRE, inner: str = ".csv.zip") -> DataFrame:
    """Rows of the CSVs in the zips in zips: the wanted columns as trimmed strings, and archive and member."""
    schema = ", ".join(["archive string", "member string", *[f"`{c}` string" for c in columns]])

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                outer = zipfile.ZipFile(io.BytesIO(content))
                for m in sorted(n for n in outer.namelist() if n.lower().endswith(inner)):
                    with zipfile.ZipFile(io.BytesIO(outer.read(m))) as z, z.open(z.namelist()[0]) as f:
                        rows = csv.DictReader(io.TextIOWrapper(f, "utf-8-sig"), skipinitialspace=True)
                        held = []
                        for row in rows:
                            held.append([name, m, *[row.get(c) for c in columns]])
                            if len(held) == 5000:
                                yield pd.DataFrame(held, columns=["archive", "member", *columns])
                                held = []
                        yield pd.DataFrame(held, columns=["archive", "member", *columns])

    return contents(spark, path, "*.zip").mapInPandas(read, schema)


def zip_members(files: DataFrame, ending: str = ".gbd.shp") -> DataFrame:
    """(path, member) of archive members with an ending, in order."""
    schema = pa.schema([("path", pa.string()), ("member", pa.string())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                names = sorted(n for n in zipfile.ZipFile(io.BytesIO(content.as_py())).namelist() if n.lower().endswith(ending))
                yield pa.RecordBatch.from_pydict({"path": [path] * len(names), "member": names}, schema=schema)

    return files.select("path", "content").mapInArrow(read, "path string, member string")


def cadastre(rows: DataFrame) -> DataFrame:
    """Cadastre rows by their lasting names, numbers read, missing texts empty, with the multipolygon of the outline; rows without one are left out."""
    out = rows.select(*[F.col(a).alias(b) for a, b in zip(CADASTRE, CADASTRE_NAMES, strict=True)])
    out = out.withColumns({"c_cost": nulls.number(F.col("c_cost")), "area_m2": nulls.number(F.col("area_m2"))} | {c: F.coalesce(c, F.lit("")) for c in ("cad_num", "status", "utl_id", "utl_doc")})
    return out.withColumn("geometry", geometry.from_wkt(F.col("wkt"))).filter(~geometry.is_empty(F.col("geometry"))).drop("wkt")


def usage_masks(rows: DataFrame) -> dict[str, Column]:
    """extended: with outline and usage code; core: that and a usage text of agriculture."""
    extended = F.coalesce((F.col("OBJ_WKT") != "") & (F.col("UTL_ID") == text.USAGE_CODE), F.lit(False))
    return {"extended": extended, "core": extended & text.usage_core(F.col("UTL_DOC"))}


# ---------------------------------------------------------------- sinks


#: What spreadsheets tell UTF-8 by.
MARK = "\ufeff"


def csv_line(names: list[str]) -> Column:
    """A row as a line of CSV: texts quoted where they hold a comma, a quote or a line's end; nothing for NULL."""
    quoted = lambda c: F.when(F.coalesce(c, F.lit("")).rlike('[",\\r\\n]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(F.coalesce(c, F.lit("")))
    return F.concat_ws(",", *[quoted(F.col(f"`{n}`").cast("string")) for n in names])


def plain(df: DataFrame) -> DataFrame:
    """df with nested columns as JSON, which is how a CSV can hold them."""
    return df.withColumns({f.name: F.to_json(F.col(f"`{f.name}`")) for f in df.schema if isinstance(f.dataType, T.StructType | T.ArrayType | T.MapType)})


def to_csv(df: DataFrame, path: str, *partitions: str, mark: bool = False) -> None:
    """df as CSV with a header, a folder for each value of partitions; with mark each file begins with the byte-order mark of UTF-8."""
    flat = plain(df)
    if not mark:
        flat.write.mode("overwrite").partitionBy(*partitions).csv(path, header=True)
        return
    # The header's first name carries the mark, so every file that Spark writes begins with it.
    names = [c for c in flat.columns if c not in partitions]
    flat.withColumnRenamed(names[0], MARK + names[0]).select(MARK + names[0], *names[1:], *partitions).write.mode("overwrite").partitionBy(*partitions).option("quoteAll", "false").csv(path, header=True)


def text_files(df: DataFrame, path: Column, header: str, line: Column, order: list[str], footer: str = "", between: str = "\n") -> DataFrame:
    """(path, content) of small text files, one for each path: header, the lines in order, footer. A file's lines meet in one task."""
    # Written first: Spark can't plan an aggregate whose arguments hold Python functions, which a line's geometry may.
    rows = written(df.select(path.alias("path"), F.struct(*[F.col(c) for c in order], line.alias("_line")).alias("r")), "lines", "zstd")
    lines = F.transform(F.array_sort(F.collect_list("r")), lambda r: r["_line"])
    return rows.groupBy("path").agg(F.encode(F.concat(F.lit(header), F.array_join(lines, between), F.lit(footer)), "UTF-8").alias("content"))


def to_files(files: DataFrame, root: str) -> DataFrame:
    """Writes files (path relative to root, content) by tasks, each under a name of its own until it is whole; returns (path, bytes)."""
    opened(root)
    schema = pa.schema([("path", pa.string()), ("bytes", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                fs, target = opened(f"{root.rstrip('/')}/{path}")
                fs.create_dir(target.rpartition("/")[0], recursive=True)
                with fs.open_output_stream(f"{target}.{attempt}.tmp") as out:
                    out.write(content.as_buffer())
                fs.move(f"{target}.{attempt}.tmp", target)
                yield pa.RecordBatch.from_pydict({"path": [path], "bytes": [len(content.as_buffer())]}, schema=schema)

    return written(files.select("path", "content").mapInArrow(write, "path string, bytes long"), "files")


def to_parquet(df: DataFrame, path: str, *partitions: str) -> None:
    df.write.mode("overwrite").partitionBy(*partitions).parquet(path)


def report(values: dict) -> str:
    """JSON of a report: UTF-8, indented."""
    return json.dumps(values, ensure_ascii=False, indent=2, default=str)


def to_text(spark: SparkSession, lines: list[str], path: str) -> None:
    """A small text file (a manifest, a report) written by Spark, so any store will do."""
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("overwrite").text(path)


def merged_settings(base: dict, over: dict) -> dict:
    """base with over's values, nested tables merged."""
    return base | {k: merged_settings(base[k], v) if isinstance(v, dict) and isinstance(base.get(k), dict) else v for k, v in over.items()}
