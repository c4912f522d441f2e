"""Tables of cells: spans, data start, headers, candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from humusgrid.functions import rules
from humusgrid.operators.headers import classify_headers

# A number with an optional unit, and a depth range.
CELL_NUMBER = rf"(?iuU)^\s*(-?\d+(?:[.,]\d+)?)\s*({rules.HEADER_UNIT})?\s*$"
RANGE_LABEL = r"(?i)^\s*(\d{1,3})\s*[–—-]\s*(\d{1,3})(?:\s*(?:cm|см))?\s*$"


def is_number(text: Column) -> Column:
    return F.coalesce(text.rlike(CELL_NUMBER), F.lit(False))


def expand_rowspans(cells: DataFrame) -> DataFrame:
    """A cell covers the rows it spans; of two cells in a slot the one from the earlier row stays.

    cells: (artifact_id, row_index, column_index, text_raw, rowspan). Null spans count as 1.
    """
    rows = cells.withColumn("row", F.explode(F.sequence(F.col("row_index"), F.col("row_index") + F.greatest(F.coalesce("rowspan", F.lit(1)), F.lit(1)) - 1)))
    first = rows.groupBy("artifact_id", "row", "column_index").agg(F.min(F.struct("row_index", "text_raw"))["text_raw"].alias("text_raw"))
    return first.select("artifact_id", F.col("row").alias("row_index"), "column_index", "text_raw")


def data_starts(grid: DataFrame, header_rows: int = 3) -> DataFrame:
    """(artifact_id, start): first row with max(2, a third of the columns) numbers, else header_rows."""
    width = grid.groupBy("artifact_id").agg((F.max("column_index") + 1).alias("columns"))
    per_row = grid.groupBy("artifact_id", "row_index").agg(F.count_if(is_number(F.col("text_raw"))).alias("numbers"))
    dense = per_row.join(width, "artifact_id").filter(F.col("numbers") >= F.greatest(F.lit(2), F.floor(F.col("columns") / 3)))
    return width.select("artifact_id").join(dense.groupBy("artifact_id").agg(F.min("row_index").alias("start")), "artifact_id", "left").select("artifact_id", F.coalesce("start", F.lit(header_rows)).cast("int").alias("start"))


def column_headers(grid: DataFrame, starts: DataFrame) -> DataFrame:
    """(artifact_id, column_index, header): texts above the data start, in row order."""
    above = grid.join(starts, "artifact_id").filter("row_index < start")
    texts = F.transform(F.array_sort(F.collect_list(F.struct("row_index", F.coalesce("text_raw", F.lit("")).alias("t")))), lambda x: x["t"])
    return above.groupBy("artifact_id", "column_index").agg(F.trim(F.array_join(texts, " ")).alias("header"))


def cell_candidates(cells: DataFrame) -> DataFrame:
    """Numeric cells under recognised columns, with unit, row label and depth.

    Returns (candidate_id, artifact_id, row_index, column_index, property_id,
    header, value_num, unit_raw, row_label, depth_top_cm, depth_bottom_cm). The
    unit is the cell's, else the header's, else pH for pH in water.
    """
    grid = expand_rowspans(cells)
    starts = data_starts(grid)
    headers = column_headers(grid, starts)
    named = headers.join(classify_headers(headers, "header"), "header").filter("property is not null")
    body = grid.join(starts, "artifact_id").filter("row_index >= start")
    label = F.transform(F.array_sort(F.collect_list(F.when(~is_number(F.col("text_raw")) & (F.trim("text_raw") != ""), F.struct("column_index", "text_raw")))), lambda x: x["text_raw"])
    labels = body.groupBy("artifact_id", "row_index").agg(F.array_join(label, " | ").alias("row_label"), F.min_by(F.when(F.col("text_raw").rlike(RANGE_LABEL), F.col("text_raw")), F.when(F.col("text_raw").rlike(RANGE_LABEL), F.col("column_index"))).alias("range"))
    cells_ = body.filter(is_number(F.col("text_raw"))).join(named, ["artifact_id", "column_index"]).join(labels, ["artifact_id", "row_index"])
    unit = F.nullif(F.regexp_extract("text_raw", CELL_NUMBER, 2), F.lit(""))
    header_unit = F.nullif(F.regexp_extract("header", f"(?iuU){rules.HEADER_UNIT}", 0), F.lit(""))
    depth = lambda i: F.regexp_extract("range", RANGE_LABEL, i).try_cast("double")
    return cells_.select(
        F.format_string("%s:tm:r%d:c%d", "artifact_id", "row_index", "column_index").alias("candidate_id"), "artifact_id", "row_index", "column_index", F.col("property").alias("property_id"), "header",
        F.translate(F.regexp_extract("text_raw", CELL_NUMBER, 1), ",", ".").try_cast("double").alias("value_num"), F.coalesce(unit, header_unit, F.when(F.col("property") == "ph_h2o", "pH")).alias("unit_raw"),
        "row_label", depth(1).alias("depth_top_cm"), depth(2).alias("depth_bottom_cm"),
    )


def adjacent_continuations(tables: DataFrame) -> DataFrame:
    """Header tables whose next table of the page continues them: same page and width, number one higher.

    tables: (artifact_id, document_id, page, number, columns).
    """
    w = Window.partitionBy("document_id", "page").orderBy("number", "artifact_id")
    nxt = tables.withColumn("next_id", F.lead("artifact_id").over(w)).withColumn("_n", F.lead("number").over(w)).withColumn("_c", F.lead("columns").over(w))
    return nxt.filter((F.col("_n") == F.col("number") + 1) & (F.col("_c") == F.col("columns"))).select("artifact_id", "next_id")


# Fixed value: a mean with its spread.
MEAN_SPREAD = r"^\s*(-?\d+(?:[.,]\d+)?)\s*(?:±|\+/-)\s*(\d+(?:[.,]\d+)?)\s*(.*?)\s*$"


def statistical_cells(cells: DataFrame) -> DataFrame:
    """(candidate_id, artifact_id, row_index, column_index, value_num, spread, unit, value_text) of cells that state a mean and its spread.

    cells: (artifact_id, row_index, column_index, text_raw). The text is kept as
    it is; other cells have no row.
    """
    number = lambda i: F.translate(F.regexp_extract("text_raw", MEAN_SPREAD, i), ",", ".").try_cast("double")
    return cells.filter(F.col("text_raw").rlike(MEAN_SPREAD)).select(
        F.format_string("%s:tm-stat:r%d:c%d", "artifact_id", "row_index", "column_index").alias("candidate_id"), "artifact_id", "row_index", "column_index",
        number(1).alias("value_num"), number(2).alias("spread"), F.nullif(F.regexp_extract("text_raw", MEAN_SPREAD, 3), F.lit("")).alias("unit"), F.col("text_raw").alias("value_text"),
    )


# Fixed value: formulae whose digits are no numbers.
FORMULAE = r"(?i)H2O|CO2|CaCO3|P2O5|K2O|SiO2|Al2O3|Fe2O3|NO3|NH4|SO4|HCO3"


def is_header_only(text: Column) -> Column:
    """A header without digits but those of formulae."""
    return ~F.regexp_replace(text, FORMULAE, "").rlike(r"\d")


def split_headers(tables: DataFrame, headers: DataFrame, most_rows: int = 3) -> DataFrame:
    """(artifact_id, next_id): header tables of at most most_rows rows whose body is the next table of the page.

    tables: (artifact_id, document_id, page, number, columns, rows); headers:
    (artifact_id, header) of their cells. Every header cell must be without
    numbers.
    """
    numbers = headers.filter(~is_header_only(F.col("header"))).select("artifact_id").distinct()
    small = tables.filter(F.col("rows") <= most_rows).select("artifact_id").join(numbers, "artifact_id", "left_anti")
    return adjacent_continuations(tables).join(small, "artifact_id", "left_semi")
