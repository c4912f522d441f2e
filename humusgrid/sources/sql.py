"""Free SQL over a folder of tables."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a result that are shown.
SHOWN = 1000


def open_views(spark: SparkSession, folder: str, names: list[str] | None = None) -> list[str]:
    """Register every table of the folder (one Parquet file or directory each) as a view of its name."""
    if names is None:
        root = spark._jvm.org.apache.hadoop.fs.Path(folder)
        found = root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)
        names = sorted(f.getPath().getName().removesuffix(".parquet") for f in found if f.getPath().getName().endswith(".parquet"))
    for name in names:
        spark.read.parquet(f"{folder}/{name}.parquet").createOrReplaceTempView(name)
    return names


def statements(text: str) -> list[str]:
    """Statements of a text, cut at semicolons outside quotes and comments."""
    out, now, quote, i = [], "", "", 0
    while i < len(text):
        ch = text[i]
        if quote:
            quote = "" if ch == quote else quote
        elif ch in "'\"`":
            quote = ch
        elif text.startswith("--", i):
            end = text.find("\n", i)
            i = len(text) if end < 0 else end
            continue
        elif ch == ";":
            out.append(now)
            now, i = "", i + 1
            continue
        now += ch
        i += 1
    return [s.strip() for s in [*out, now] if s.strip()]


def run_sql(spark: SparkSession, text: str, **args: object) -> DataFrame:
    """Run the statements of a text one after another; the last one's result is returned."""
    parts = statements(text)
    if not parts:
        raise ValueError("no statement")
    for part in parts[:-1]:
        spark.sql(part)
    return spark.sql(parts[-1], args=args or None)


def answer(spark: SparkSession, text: str, shown: int = SHOWN) -> tuple[list[str], list[tuple], int, str | None]:
    """(columns, rows shown, rows in all, error): what a page shows of a query; an error comes as text."""
    try:
        df = run_sql(spark, text)
        return df.columns, [tuple(r) for r in df.limit(shown).collect()], df.agg(F.count(F.lit(1))).first()[0], None
    except (PySparkException, ValueError) as error:
        return [], [], 0, str(error).splitlines()[0]
