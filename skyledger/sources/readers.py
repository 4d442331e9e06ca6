"""Sources, each with a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Holds the whole record where a checked scan could not read it as declared, else null.
MALFORMED = "__malformed_record"


def jdbc_options(
    url: str,
    table: str,
    *,
    driver: str | None = None,
    partition_column: str | None = None,
    lower_bound: str | int | None = None,
    upper_bound: str | int | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options of a relational copy.

    A partitioned copy needs all four partition settings: without them the whole table would
    come through one connection and one task.
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if driver:
        options["driver"] = driver
    split = (partition_column, lower_bound, upper_bound, num_partitions)
    if any(part is not None for part in split):
        if any(part is None for part in split):
            raise ValueError("a partitioned copy needs column, lower bound, upper bound and number of partitions")
        options.update(
            partitionColumn=str(partition_column),
            lowerBound=str(lower_bound),
            upperBound=str(upper_bound),
            numPartitions=str(num_partitions),
        )
    return options


def scan_jdbc(spark: SparkSession, columns: dict[str, str], **options) -> DataFrame:
    """Copy a relational table through an explicit mapping of source to target column."""
    source = spark.read.format("jdbc").options(**jdbc_options(**options)).load()
    return source.selectExpr(*[f"`{name}` as `{target}`" for name, target in columns.items()])


def scan_csv_strings(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Comma-separated text with a header row; every column lands as a string."""
    schema = ", ".join(f"`{name}` string" for name in columns)
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", ",")
        .option("quote", '"')
        .option("escape", "\\")
        .csv(path)
    )


def scan_json_nested(spark: SparkSession, path: str, schema: str, array: bool = False) -> DataFrame:
    """JSON with nested structs.

    JSON lines split over many tasks. ``array=True`` reads files that hold one top-level array;
    such a file cannot be split, so land large data as lines or as many files.
    """
    return spark.read.schema(schema).option("multiLine", array).json(path)


def scan_delimited_noheader(spark: SparkSession, path: str, columns: list[str], sep: str = "|") -> DataFrame:
    """Delimited text without a header; every column lands as a string."""
    schema = ", ".join(f"`{name}` string" for name in columns)
    return spark.read.schema(schema).option("header", False).option("sep", sep).option("encoding", "UTF-8").csv(path)


def scan_delimited_checked(
    spark: SparkSession, path: str, columns: list[str], sep: str = ",", header: bool = False
) -> DataFrame:
    """Delimited text, every column a string, with MALFORMED for records of more or fewer fields."""
    schema = ", ".join(f"`{name}` string" for name in columns) + f", {MALFORMED} string"
    reader = spark.read.schema(schema).option("header", header).option("sep", sep).option("mode", "PERMISSIVE")
    return reader.option("escape", "\\").option("columnNameOfCorruptRecord", MALFORMED).csv(path)


def scan_json_checked(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines, with MALFORMED for lines that are no JSON or do not fit the schema."""
    reader = spark.read.schema(f"{schema}, {MALFORMED} string").option("mode", "PERMISSIVE")
    return reader.option("columnNameOfCorruptRecord", MALFORMED).json(path)


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table by name."""
    return spark.read.table(name)


def scan_layer(
    spark: SparkSession, layer_path: str, name: str, schema: str | None = None, fmt: str = "parquet"
) -> DataFrame:
    """A table of a layer by path."""
    reader = spark.read.format(fmt)
    if schema:
        reader = reader.schema(schema)
    return reader.load(f"{layer_path.rstrip('/')}/{name}")
