"""Landing directories: CSV and whole-file JSON envelopes, with lineage and ingestion columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerlens import schemas
from ledgerlens import values as V
from ledgerlens.functions.columns import query_time

# Reader options (fixed values): header row, double quotes escaped by doubling, empty field = NULL.
CSV_OPTIONS = {"header": "true", "sep": ",", "quote": '"', "escape": '"', "encoding": "UTF-8", "nullValue": ""}


#: Holds the text of a line or file that could not be read as its schema says; NULL for all others.
BROKEN = "broken_record"


def _csv(reader, path: str, schema: StructType, keep_broken: bool, options: dict) -> DataFrame:
    if keep_broken:
        schema, options = StructType([*schema.fields, StructField(BROKEN, StringType())]), {"columnNameOfCorruptRecord": BROKEN, **options}
    return reader.schema(schema).options(**{**CSV_OPTIONS, **options}).csv(path)


def stream_csv(spark: SparkSession, path: str, schema: StructType, keep_broken: bool = False, **options) -> DataFrame:
    """Rows of landed CSV files.  A line with too few or too many fields gives what can be read of it; ``keep_broken``
    adds its text."""
    return _csv(spark.readStream, path, schema, keep_broken, options)


def read_csv(spark: SparkSession, path: str, schema: StructType, keep_broken: bool = False, **options) -> DataFrame:
    """The same of the files that are there now."""
    return _csv(spark.read, path, schema, keep_broken, options)


def stream_text_files(spark: SparkSession, path: str, **options) -> DataFrame:
    """One row per file, its whole content in ``value``."""
    return spark.readStream.options(wholetext="true", **options).format("text").load(path)


def with_lineage(df: DataFrame) -> DataFrame:
    """Source file and its modification time; only on frames read from files."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_modification_time").alias("source_file_modified_ts"),
    )


def with_ingestion(
    df: DataFrame,
    version: str = V.PIPELINE_VERSION,
    system: str | None = None,
    as_of: Column | datetime | None = None,
) -> DataFrame:
    now = query_time(as_of)
    stamps = {"ingestion_ts": now, "ingestion_date": F.to_date(now), "pipeline_version": F.lit(version)}
    if system is not None:
        stamps["source_system"] = F.lit(system)
    return df.withColumns(stamps)


def explode_envelopes(
    files: DataFrame, envelope: StructType, text: str = "value", keep_bad_files: bool = False, keep_broken: bool = False
) -> DataFrame:
    """One row per record of each envelope document.

    ``keep_broken`` keeps a document without readable records as a row without a record, with its text.

    A malformed document, or one without records, gives no row.  ``keep_bad_files`` keeps it as
    a row without a record and adds ``bad_file``: whether the declared and the actual number of
    records differ (or the document cannot be read).
    """
    if keep_broken:
        whole = StructType([*envelope.fields, StructField(BROKEN, StringType())])
        parsed = files.withColumn("envelope", F.from_json(text, whole, {"columnNameOfCorruptRecord": BROKEN}))
        unread = F.col("envelope.records").isNull() & (F.col(f"envelope.{BROKEN}").isNotNull() | (F.col("envelope").isNull() & F.col(text).isNotNull()))
        nothing = F.array(F.lit(None).cast(whole["records"].dataType.elementType))
        parsed = parsed.withColumns({BROKEN: F.when(unread, F.col(text)), "record": F.explode(F.when(unread, nothing).otherwise(F.col("envelope.records")))})
        return parsed.drop(text, "envelope")
    parsed = files.withColumn("envelope", F.from_json(text, envelope)).drop(text)
    if not keep_bad_files:
        return parsed.withColumn("record", F.explode("envelope.records")).drop("envelope")
    actual = F.coalesce(F.size("envelope.records"), F.lit(-1))
    declared = F.expr("try_cast(envelope.record_count AS int)")
    checked = parsed.withColumn("bad_file", ~F.coalesce(declared == actual, F.lit(False)))
    return checked.withColumn("record", F.explode_outer("envelope.records")).drop("envelope")


def stream_json_envelope(
    spark: SparkSession, path: str, envelope: StructType, keep_bad_files: bool = False, keep_broken: bool = False, **options
) -> DataFrame:
    files = with_lineage(stream_text_files(spark, path, **options))
    return explode_envelopes(files, envelope, "value", keep_bad_files, keep_broken)


# -- the two reference feeds --------------------------------------------------
def mcc_ingest(spark: SparkSession, path: str, as_of: Column | datetime | None = None, **options) -> DataFrame:
    """Streaming MCC rows with lineage and ingestion columns; ``keep_broken`` as for ``stream_csv``."""
    return with_ingestion(with_lineage(stream_csv(spark, path, schemas.MCC_FILE, **options)), as_of=as_of)


def sanctions_records(exploded: DataFrame, as_of: Column | datetime | None = None) -> DataFrame:
    """Flat sanctions rows from exploded envelopes that carry the lineage columns."""
    extra = [c for c in ("source_file", "source_file_modified_ts", "bad_file", BROKEN) if c in exploded.columns]
    return with_ingestion(exploded.select("record.*", *extra), as_of=as_of)


def sanctions_ingest(
    spark: SparkSession, path: str, as_of: Column | datetime | None = None, keep_bad_files: bool = False, keep_broken: bool = False, **options
) -> DataFrame:
    """Streaming sanctions records, one row per record of each landed document."""
    exploded = stream_json_envelope(spark, path, schemas.SANCTION_ENVELOPE, keep_bad_files, keep_broken, **options)
    return sanctions_records(exploded, as_of)
