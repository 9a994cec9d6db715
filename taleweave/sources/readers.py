"""Sources: delimited tables, corpora, registries, examples, runs, listings."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taleweave.functions import lexicon as X
from taleweave.functions.records import DISPLAY, RECORD_SCHEMA, STORED_SCHEMA
from taleweave.functions.text import extract_answer, strip
from taleweave.operators import ordering
from taleweave.operators import registry as registry_ops
from taleweave.operators import relational as R
from taleweave.sources.json_arrays import read_json_array

RUN_SCHEMA = (
    "run string, part int, steps array<int>, train_loss array<double>, val_loss array<double>, elapsed_minutes double"
)


def read_characters(spark: SparkSession, path: str) -> DataFrame:
    """`;`-separated table with a header, every column text, missing values null."""
    raw = spark.read.csv(path, sep=";", header=True, inferSchema=False)
    return R.missing_to_null(raw)


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: (path, text). Undecodable bytes become U+FFFD."""
    files = spark.read.text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def read_corpus_blocks(spark: SparkSession, path: str) -> DataFrame:
    """One row per block between blank lines: (path, offset, block, text).

    For files too large for one row. The reader cuts files at the separator on
    its own, so one huge file is read by many tasks. A speech never crosses a
    blank line, so blocks can be parsed apart. (path, offset, block) is the
    file order.
    """
    blocks = spark.read.text(path, lineSep="\n\n")
    return blocks.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("offset"),
        F.monotonically_increasing_id().alias("block"), F.col("value").alias("text"))


def _shown_schema() -> T.StructType:
    """Record fields under their names in JSON."""
    return T.StructType([T.StructField(DISPLAY.get(f.name, f.name), f.dataType) for f in RECORD_SCHEMA.fields])


def _stored(rows: DataFrame, order: list[str]) -> DataFrame:
    rows = rows.withColumnsRenamed({v: k for k, v in DISPLAY.items()})
    numbered = ordering.ordinal(rows, order, out="seq").drop(*order)
    named = registry_ops.conform(numbered, ["seq", "name"])
    return registry_ops.upsert(named, named.limit(0))


def read_registry_arrays(spark: SparkSession, path: str) -> DataFrame:
    """`read_registry` for files too large for one task, each an array of
    records or an object with them under `npcs`."""
    rows = read_json_array(spark, path, _shown_schema())
    return _stored(rows.select("path", "n", "record.*").withColumnsRenamed({"path": "_path", "n": "_n"}), ["_path", "_n"])


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Records of a JSON registry with their insertion order in `seq`.

    Takes an array of records or an object with them under `npcs`; a malformed
    file gives no rows. A later duplicate id replaces the values but keeps the
    first position.
    """
    shown = _shown_schema()
    schema = T.StructType(shown.fields + [T.StructField("npcs", T.ArrayType(shown)), T.StructField("_bad", T.StringType())])
    try:
        # one small JSON document per file, as the format requires
        raw = spark.read.schema(schema).json(path, multiLine=True, mode="PERMISSIVE", columnNameOfCorruptRecord="_bad")
    except AnalysisException:
        return spark.createDataFrame([], STORED_SCHEMA)
    raw = raw.where(F.col("_bad").isNull()).withColumn("_row", F.monotonically_increasing_id())
    own = F.struct(*[F.col(f.name) for f in shown.fields])
    listed = F.when(F.col("npcs").isNotNull(), F.col("npcs")).when(
        F.coalesce(*[F.col(f.name).cast("string") for f in shown.fields if f.name in ("npc_id", "name", "race", "primary_class")]).isNotNull(),
        F.array(own))
    rows = raw.select("_row", F.posexplode(listed).alias("_pos", "r")).select("_row", "_pos", "r.*")
    # file order; a registry file fits one task, `read_registry_arrays` takes larger ones
    return _stored(rows, ["_row", "_pos"])


def _manifest(path: str) -> str:
    return f"{path.rstrip('/')}/_manifest"


def latest_version(spark: SparkSession, path: str, below: int | None = None) -> int | None:
    """Newest version number of a versioned table. The manifest names a
    version once all its files are written, with or without rows."""
    try:
        versions = spark.read.schema("version long").json(_manifest(path))
    except AnalysisException:
        return None
    if below is not None:
        versions = versions.where(F.col("version") < below)
    return versions.agg(F.max("version").alias("v")).first()["v"]


def read_registry_table(spark: SparkSession, path: str, below: int | None = None) -> DataFrame:
    """Newest version of a Parquet registry; no table gives no rows. Only the
    files of that version are read."""
    version = latest_version(spark, path, below)
    if version is None:
        return spark.createDataFrame([], STORED_SCHEMA)
    return spark.read.parquet(f"{path.rstrip('/')}/version={version}")


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("token string, id int").parquet(path)


def read_examples(spark: SparkSession, path: str) -> DataFrame:
    """Labelled examples of text files: (path, task, input_text, label, text).

    Records end at the end mark, so passages may span lines.
    """
    raw = spark.read.text(path, lineSep=X.END_MARK)
    text = strip("value")
    rows = raw.select(F.col("_metadata.file_path").alias("path"), text.alias("body")).where(
        F.contains("body", F.lit(X.ANSWER_MARK)))
    task = F.lit(None).cast("string")
    for name, mark in X.TASK_MARKS.items():
        task = F.when(F.startswith("body", F.lit(mark)), F.lit(name)).otherwise(task)
    passage = strip(F.regexp_replace(F.substring_index("body", X.ANSWER_MARK, 1), r"^\[[A-Z]+\]", ""))
    return rows.select(
        "path", task.alias("task"), passage.alias("input_text"), extract_answer("body").alias("label"),
        F.concat("body", F.lit(" " + X.END_MARK)).alias("text"))


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Run histories in parts; files without parts have whole runs. An absent
    table gives no rows."""
    try:
        runs = spark.read.schema(RUN_SCHEMA).parquet(path)
        return runs.withColumn("part", F.coalesce("part", F.lit(0)))
    except AnalysisException:
        return spark.createDataFrame([], RUN_SCHEMA)


def list_files(spark: SparkSession, folders: list[str]) -> DataFrame:
    """(folder, path, modified) of every file below the folders. File contents
    are not read; a missing folder gives no rows."""
    listing = None
    for folder in folders:
        try:
            files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
        except AnalysisException:
            continue
        part = files.select(F.lit(folder).alias("folder"), "path", F.col("modificationTime").alias("modified"))
        listing = part if listing is None else listing.unionByName(part)
    if listing is None:
        return spark.createDataFrame([], "folder string, path string, modified timestamp")
    return listing
