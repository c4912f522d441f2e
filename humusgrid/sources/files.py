"""Readers of text, JSON, CSV and HTML inputs."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_texts(spark: SparkSession, folder: str) -> DataFrame:
    """(document_id, text) of every *.txt file, the id from the file name; undecodable bytes are replaced."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(folder)
    name = F.regexp_extract("path", r"([^/]+)\.txt$", 1)
    return files.select(name.alias("document_id"), F.make_valid_utf8(F.col("content").cast("string")).alias("text"))


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines, gzip included, with columns `file`, and `corrupt`: the line that did not parse, null for the others."""
    lines = spark.read.text(path).filter("trim(value) <> ''").select("value", F.col("_metadata.file_name").alias("file"))
    parsed = F.from_json("value", f"{schema}, corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "corrupt"})
    return lines.select("file", parsed.alias("x")).select("file", "x.*")


def parsed_and_broken(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that parsed, (file, broken) with the number of lines of each file that did not)."""
    broken = rows.groupBy("file").agg(F.count_if(F.col("corrupt").isNotNull()).alias("broken"))
    return rows.filter("corrupt is null").drop("corrupt", "file"), broken


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """(name, rings) of the polygons of GeoJSON feature collections; several rows for the parts of a name.

    The name is the feature's two-letter country code, else the three-letter
    one; features without any, and other geometries, are left out.
    """
    point = "array<array<array<double>>>"
    raw = spark.read.option("multiLine", True).schema(f"features array<struct<properties: map<string, string>, geometry: struct<type: string, coordinates: string>>>").json(path)
    f = raw.select(F.explode("features").alias("f"))
    code = F.coalesce(*[F.try_element_at("f.properties", F.lit(k)) for k in ("ISO_A2", "iso_a2", "ISO_A3", "iso_a3")])
    kind, body = F.col("f.geometry.type"), F.col("f.geometry.coordinates")
    parts = F.when(kind == "Polygon", F.array(F.from_json(body, point))).when(kind == "MultiPolygon", F.from_json(body, f"array<{point}>"))
    return f.select(code.alias("name"), F.explode(parts).alias("rings")).filter("name is not null and rings is not null")


def read_catalogue(spark: SparkSession, articles: str, legacy: str) -> DataFrame:
    """(article_id, year, url, title): articles of a JSON catalogue with the titles of the legacy list, where it has one."""
    new = spark.read.option("multiLine", True).schema("articles array<struct<article_id: string, year: int, article_url: string>>").json(articles).select(F.explode("articles").alias("a")).select("a.*")
    old = spark.read.option("multiLine", True).schema("article_id string, title string").json(legacy).groupBy("article_id").agg(F.min("title").alias("title"))
    return new.join(old, "article_id", "left").select("article_id", "year", F.col("article_url").alias("url"), "title")


def index_scans(spark: SparkSession, metadata: str, texts: str, schema: str) -> DataFrame:
    """Metadata files of scanned crops with the texts of the same stem: the metadata's columns, stem, text, has_text."""
    stem = lambda c: F.regexp_extract(c, r"([^/]+)\.[^.]+$", 1)
    meta = spark.read.option("multiLine", True).schema(schema).json(metadata).withColumn("stem", stem(F.col("_metadata.file_path")))
    body = spark.read.format("binaryFile").load(texts).select(stem(F.col("path")).alias("_stem"), F.make_valid_utf8(F.col("content").cast("string")).alias("text"))
    joined = meta.join(body, F.col("stem") == F.col("_stem"), "left").drop("_stem")
    return joined.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("has_text", F.col("text") != "")


def resumed(spark: SparkSession, rows: DataFrame, key: str, folder: str, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Results of `work` for all rows, of which those that the folder holds are not worked again.

    Results are appended as JSON lines; lines cut off by a failure do not parse
    and count as missing.
    """
    schema = work(rows).schema
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    held = None
    if at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        held = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(folder).filter(F.col(key).isNotNull())
    todo = rows if held is None else rows.join(held.select(key).distinct(), key, "left_anti")
    work(todo).write.mode("append").json(folder)
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(folder).filter(F.col(key).isNotNull()).dropDuplicates()


def read_csv(spark: SparkSession, path: str, schema: str, null: str = "") -> DataFrame:
    """CSV with a header; null: how a missing value is written (with the default, empty texts are missing too)."""
    options = {"header": True, "multiLine": True, "escape": '"', "nullValue": null, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    return spark.read.schema(schema).options(**options).csv(path)


def read_matrices(spark: SparkSession, path: str) -> DataFrame:
    """(article, page, number, row_index, column_index, text_raw) of JSON matrix files; blank cells are skipped."""
    raw = spark.read.schema("data array<array<string>>").option("multiLine", True).json(path).withColumn("name", F.col("_metadata.file_name"))
    cells = raw.select("name", F.posexplode("data").alias("row_index", "cells")).select("name", "row_index", F.posexplode("cells").alias("column_index", "text_raw")).filter("trim(text_raw) <> ''")
    part = lambda i: F.regexp_extract("name", r"^(.+?)_p(\d+)_t(\d+)", i)
    return cells.select(part(1).alias("article"), part(2).try_cast("int").alias("page"), part(3).try_cast("int").alias("number"), "row_index", "column_index", "text_raw")


class _Tables(HTMLParser):
    """Cells of all tables of a page: (table, row, column, text, rowspan, colspan)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.cells: list[tuple[int, int, int, str, int, int]] = []
        self.table = self.row = -1
        self.taken: set[tuple[int, int]] = set()
        self.open: list | None = None

    @staticmethod
    def span(value: str | None) -> int:
        digits = ""
        for ch in (value or "").strip():
            if not ch.isdigit():
                break
            digits += ch
        return max(1, int(digits)) if digits else 1

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "table":
            self.close_cell()
            self.table, self.row, self.taken = self.table + 1, -1, set()
        elif tag == "tr":
            self.close_cell()
            self.row += 1
        elif tag in ("td", "th") and self.table >= 0:
            self.close_cell()
            self.row = max(self.row, 0)
            a = dict(attrs)
            self.open = ["", self.span(a.get("rowspan")), self.span(a.get("colspan"))]

    def handle_data(self, data: str) -> None:
        if self.open is not None:
            self.open[0] += data

    def handle_endtag(self, tag: str) -> None:
        if tag in ("td", "th", "tr", "table"):
            self.close_cell()

    def close_cell(self) -> None:
        if self.open is None:
            return
        text, down, across = self.open
        self.open = None
        column = 0
        while (self.row, column) in self.taken:
            column += 1
        self.taken.update((self.row + r, column + c) for r in range(down) for c in range(across))
        self.cells.append((self.table, self.row, column, " ".join(text.split()), down, across))


def html_cells(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """Cells of the tables of HTML pages, each in the first free slot of its row."""
    schema = f"`{id_col}` {pages.schema[id_col].dataType.simpleString()}, table_index int, row_index int, column_index int, text_raw string, rowspan int, colspan int"
    names = [id_col, "table_index", "row_index", "column_index", "text_raw", "rowspan", "colspan"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, html in zip(batch[id_col], batch[html_col]):
                if isinstance(html, str):
                    parser = _Tables()
                    parser.feed(html)
                    parser.close_cell()
                    rows += [(key, *cell) for cell in parser.cells]
            yield pd.DataFrame(rows, columns=names)

    return pages.select(id_col, html_col).mapInPandas(run, schema)


def write_csv(df: DataFrame, path: str, null: str = "") -> None:
    options = {"header": True, "escape": '"', "nullValue": null, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(**options).csv(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    """One compact object a line, nulls kept."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """(file, bytes, sha256, rows) of the files of a folder; rows of CSV files without their header, null for others."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    told = files.select(F.regexp_replace("path", "^file:/+", "/").alias("path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    lines = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").schema("c string").csv(folder)
    counts = lines.groupBy(F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "/").alias("path")).agg(F.count(F.lit(1)).alias("rows"))
    return told.join(counts, "path", "left").select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), "bytes", "sha256", "rows")


def export_package(frames: dict[str, DataFrame], folder: str, audit: DataFrame, force: bool = False) -> DataFrame:
    """Write every frame as CSV under its name and return the manifest.

    audit: (check, rows) of tables that should be empty; with any row there the
    package is refused unless forced.
    """
    failed = [r["check"] for r in audit.filter("rows > 0").collect()]  # as many as checks
    if failed and not force:
        raise ValueError(f"not ready for export: {', '.join(sorted(failed))}")
    for name, df in frames.items():
        write_csv(df, f"{folder}/{name}")
    spark = next(iter(frames.values())).sparkSession
    return manifest(spark, folder)
