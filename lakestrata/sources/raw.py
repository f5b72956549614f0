"""Raw landing files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.audit import source_file

CORRUPT = "_corrupt_record"
SOURCE = "_source_file"


def read_csv_permissive(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str,
    *,
    header: bool = True,
    check_header: bool = False,
    **options: str,
) -> DataFrame:
    """CSV scan that keeps every row; the raw text of wrong-width rows is in ``_corrupt_record``.

    ``schema`` names the data columns (text, so that parsing never loses a value). Column pruning
    is off for this scan: with it on, a query that needs one column parses only that column and
    takes wrong-width rows for good ones. ``check_header`` makes a file whose header names differ
    from the schema fail instead of being read by position.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if CORRUPT not in schema.names:
        schema = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.options(
            header=header,
            mode="PERMISSIVE",
            columnNameOfCorruptRecord=CORRUPT,
            columnPruning=False,
            enforceSchema=not check_header,
            **options,
        )
        .schema(schema)
        .csv(path)
        .withColumn(SOURCE, source_file())
    )


def read_json_documents(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    *,
    multi_line: bool = True,
) -> DataFrame:
    """JSON scan. One task reads one multi-line document file, so a large feed should come as many
    files, or as JSON lines (``multi_line=False``), which Spark splits. A given schema saves the
    pass over the data that infers one.
    """
    reader = spark.read.option("multiLine", multi_line)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def split_json_documents(spark: SparkSession, path: str | list[str], schema: T.StructType | str) -> tuple[DataFrame, DataFrame]:
    """``(rows, broken)`` of document files: one JSON value a file, over as many lines as it likes.

    A file is read as text and parsed to a VARIANT; an array gives a row an element, anything else one row. Each column of
    ``schema`` is taken from the element by its name; a value that cannot be read as its type is NULL, as is a missing one.
    A file that is not JSON is not lost, as it would be under a reader with a schema: it is in ``broken`` as a whole, with its
    text in ``_corrupt_record``. So is an element that is no object. Both sides carry ``_source_file`` and partition columns of the
    path. A file is one row here, so it has to fit a task; an empty file is broken, an empty array gives no rows.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    texts = spark.read.text(path, wholetext=True).withColumn(SOURCE, source_file())
    found = [c for c in texts.columns if c not in ("value", SOURCE)]
    # Spark's parser stops after the first value and takes no notice of what follows. Within brackets and within braces a text
    # parses both times only if it is one value as a whole: what ends the one too early is an error in the other
    listed = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), "value", F.lit("]"))), "$", "array<variant>")
    named = F.try_parse_json(F.concat(F.lit('{"v":'), "value", F.lit("}")))
    one = named.isNotNull() & F.coalesce(F.size(listed) == 1, F.lit(False))
    parsed = texts.withColumn("_json", F.when(one, F.get(listed, 0)))
    whole = parsed.where(F.col("_json").isNull()).select(F.col("value").alias(CORRUPT), SOURCE, *found)
    kind = F.schema_of_variant("_json")
    items = F.when(kind.startswith("ARRAY"), F.try_variant_get("_json", "$", "array<variant>")).otherwise(F.array("_json"))
    each = parsed.where(F.col("_json").isNotNull()).select(F.explode(items).alias("_item"), SOURCE, *found)
    is_object = F.coalesce(F.schema_of_variant("_item").startswith("OBJECT"), F.lit(False))
    fields = [F.try_variant_get("_item", f"$['{f.name}']", f.dataType.simpleString()).alias(f.name) for f in schema]
    rows = each.where(is_object).select(*fields, SOURCE, *found)
    strange = each.where(~is_object).select(F.coalesce(F.to_json("_item"), F.lit("null")).alias(CORRUPT), SOURCE, *found)
    return rows, whole.unionByName(strange)
