"""Registered queries read whole texts."""

from humusgrid.plans import catalog


def test_dms_extract_beyond_40000_characters(spark, tmp_path):
    near, far = "66°25'N, 67°18'E", "51°30'N, 36°06'E"
    over = "x" * 39990 + far  # stands over character 40 000
    rows = [("a", near + "y" * 50000 + far), ("b", over), ("c", None)]
    spark.createDataFrame(rows, "extraction_id string, raw_text string").write.parquet(str(tmp_path / "extraction.parquet"))
    got = sorted((r["extraction_id"], round(r["latitude"], 3), round(r["longitude"], 3)) for r in catalog.QUERIES["dms_extract"](spark, str(tmp_path)).collect())
    assert got == [("a", 51.5, 36.1), ("a", 66.417, 67.3), ("b", 51.5, 36.1)]
