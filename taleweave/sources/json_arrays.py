"""Records of a JSON array of any size, read by many tasks.

A file is read in pieces that end at a closing brace, which the text reader
cuts by byte ranges on its own. Whether a piece begins inside a string, and how
deep it lies, follows from the quotes and brackets before it: two prefix sums
over narrow rows. A record ends where the depth is back at that of the array's
elements; the pieces of each record are brought together and parsed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taleweave.operators import ordering
from taleweave.session import working_dir

#: What stands before the array of an object with the records under a key.
_OPENING = r'(?s)^\s*\{.*?"%s"\s*:\s*\['

#: Columns that order the pieces of a file.
PLACE = ["offset", "no"]


def _saved(df: DataFrame, name: str) -> DataFrame:
    path = working_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """(path, offset, no, piece, quotes, outside, inside): pieces in file order, the
    number of quotes, and the change of depth if the piece begins outside or
    inside a string, its closing brace included."""
    rows = spark.read.text(path, lineSep="}").select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("offset"), F.monotonically_increasing_id().alias("no"),
        F.col("value").alias("piece"))
    bare = F.regexp_replace("piece", r"\\.", "")  # an escaped quote ends no string
    rows = rows.withColumn("_parts", F.split(bare, '"'))

    def depth(parity: int):
        # segments between quotes lie in turn outside and inside strings
        own = F.array_join(F.filter("_parts", lambda _, i: i % 2 == parity), "")
        opened = F.length(F.regexp_replace(own, r"[^\[{]", "")) - F.length(F.regexp_replace(own, r"[^\]]", ""))
        return opened - F.when((F.size("_parts") - 1) % 2 == parity, 1).otherwise(0)

    return rows.select("path", *PLACE, "piece", (F.size("_parts") - 1).alias("quotes"),
                       depth(0).alias("outside"), depth(1).alias("inside"))


def read_json_array(spark: SparkSession, path: str, schema: T.StructType, under: str = "npcs") -> DataFrame:
    """(path, n, record) of files that hold an array of records, or an object
    with them under a key; `n` counts from 0 in each file.

    A file that is no such document gives no rows. A record may be nested and
    its strings may hold any braces; a record is one row, so it fits a task. In
    an object the array comes last, and no array of objects before it.
    """
    place = F.struct(*PLACE)
    pieces = _saved(_pieces(spark, path), "pieces")
    narrow = pieces.select("path", *PLACE, "quotes", "outside", "inside")
    quoted = ordering.running_total(narrow, PLACE, F.col("quotes").cast("long"), "path", "_quotes")
    # a piece begins inside a string after an odd number of quotes; with one, its brace is text
    begins = F.col("_quotes") % 2 == 1
    within = (F.col("_quotes") + F.col("quotes")) % 2 == 1
    turned = _saved(quoted.select("path", *PLACE, F.when(begins, F.col("inside")).otherwise(F.col("outside")).cast("long").alias("turn"),
                                  within.alias("within")), "turns")
    depths = ordering.running_total(turned, PLACE, F.col("turn"), "path", "_before")
    heads = pieces.groupBy("path").agg(F.min_by("piece", place).alias("head"), F.max_by("piece", place).alias("tail"),
                                       F.max(place).alias("last"))
    wrapped = F.regexp_like("head", F.lit(r"^\s*\{"))
    heads = _saved(heads.select("path", "last", "tail", wrapped.alias("wrapped"),
                                F.regexp_like("head", F.lit(r"^\s*\[")).alias("plain")), "heads")
    placed = _saved(depths.join(heads.select("path", "wrapped", "last"), "path").select(
        "path", *PLACE, "within", (F.col("_before") + F.col("turn") - F.col("wrapped").cast("int") - 1).alias("depth"),
        (place == F.col("last")).alias("final")), "depths")
    # a record ends outside strings at depth 0; what follows the last one is the file's end
    ends = F.when(~F.col("within") & ~F.col("final") & (F.col("depth") == 0), 1).otherwise(0)
    numbered = ordering.running_total(placed, PLACE, ends.cast("long"), "path", "n")
    # the tail is one closing bracket: before the end of the file, or before the object's brace
    sound = heads.where((F.col("plain") & F.regexp_like("tail", F.lit(r"^\s*\]\s*$")))
                        | (F.col("wrapped") & F.regexp_like("tail", F.lit(r"^\s*(\]\s*)?$"))))
    closing = F.col("wrapped") & F.regexp_like("piece", F.lit(r"^\s*\]\s*$"))
    together = numbered.where(~F.col("final")).select("path", *PLACE, "n").join(pieces.select("path", *PLACE, "piece"), ["path", *PLACE]) \
        .join(sound.select("path", "wrapped"), "path").where(~closing)
    text = F.concat(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*PLACE, "piece"))), lambda p: p["piece"]), "}"), F.lit("}"))
    rows = together.groupBy("path", "n", "wrapped").agg(text.alias("text"))
    first = F.when(F.col("wrapped"), F.regexp_replace("text", _OPENING % under, "")).otherwise(F.regexp_replace("text", r"^\s*\[", ""))
    body = F.when(F.col("n") == 0, first).otherwise(F.regexp_replace("text", r"^\s*,", ""))
    bad = "_bad"
    kinds = T.StructType([*schema.fields, T.StructField(bad, T.StringType())])
    parsed = _saved(rows.select("path", "n", F.from_json(body, kinds, {"columnNameOfCorruptRecord": bad}).alias("record")), "records")
    broken = parsed.where(F.col("record").isNull() | F.col(f"record.{bad}").isNotNull()).select("path").distinct()
    kept = parsed.join(broken, "path", "left_anti")
    return kept.select("path", "n", F.struct(*[F.col(f"record.{f.name}") for f in schema.fields]).alias("record"))
