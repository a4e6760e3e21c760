"""Reading catalogs, batch inputs and request documents; writing datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.cleaning import normalize_na

# Number columns of a catalog file; all others are text.
CATALOG_NUMBERS = {"id": "bigint", "Rating": "double"}


def require_path(path: str | None) -> str:
    if not path or not path.strip() or not (path.startswith("/") or "://" in path):
        raise ValueError("path must be a URI or an absolute path")
    return path


def read_catalog(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, multi_line: bool = False,
    number_rows: bool = False,
) -> DataFrame:
    """Read a catalog CSV with header: missing-value words become null, number columns are cast.

    Raises ``ValueError`` for a bad path or a file without rows. With
    ``number_rows`` a 1-based id in file order is added where there is none.
    ``multi_line`` allows line breaks in quoted fields, at the price of one task
    per file.
    """
    from shelfwise.operators.ordering import ensure_id

    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    raw = (reader.schema(schema) if schema else reader).csv(require_path(path))
    if raw.isEmpty():
        raise ValueError(f"the catalog has no rows: {path}")
    df = normalize_na(ensure_id(raw) if number_rows else raw)
    casts = {c: F.col(c).try_cast(t) for c, t in CATALOG_NUMBERS.items() if c in df.columns}
    return df.withColumns(casts) if casts else df


def read_batch_input(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Read batch input: JSON lines for ``.jsonl`` (blank lines skipped), else CSV with header.

    Without a schema JSON fields are found by a pass over the data; give one for
    large inputs. Numbers are kept as text either way.
    """
    require_path(path)
    if path.endswith(".jsonl"):
        reader = spark.read.option("primitivesAsString", True)
        return (reader.schema(schema) if schema else reader).json(path)
    return normalize_na((spark.read.schema(schema) if schema else spark.read).option("header", True).option("escape", '"').csv(path))


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """Request documents, one file each, as (value, path)."""
    return spark.read.text(require_path(path), wholetext=True).select(
        "value", F.col("_metadata.file_path").alias("path")
    )


def write_datasets(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write prepared rows, one folder per split where the frame has one."""
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    (writer.partitionBy("split") if "split" in df.columns else writer).save(path)


def read_dataset(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df if split is None else df.filter(F.col("split") == split)
