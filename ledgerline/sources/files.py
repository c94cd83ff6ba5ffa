"""File discovery and JSON-lines parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from ledgerline.sources.schemas import Feed


def absolute(spark: SparkSession, root: str) -> str:
    """The folder as file listings name it, scheme included."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.makeQualified(path).toString().rstrip("/")


def _plain(uri: Column) -> Column:
    """A file URI without its scheme slashes, so that file:/x and file:///x agree."""
    return F.regexp_replace(F.url_decode(uri), r"^([a-z0-9]+):/+", "$1:/")


def relative(uri: Column, base: str) -> Column:
    """Path of a file below the root: what the tables call source_file."""
    plain = base.replace(":///", ":/").replace("://", ":/")
    return F.substring(_plain(uri), F.lit(len(plain) + 2), F.length(uri))


def list_files(spark: SparkSession, root: str, feed: Feed) -> DataFrame:
    """source_file and file_size of the files of one feed, listed without reading them.

    Only the folder part of the prefix is listed; the rest of it is matched.
    """
    base = absolute(spark, root)
    folder = f"{base}/{feed.prefix}".rpartition("/")[0]
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], "source_file string, file_size bigint")
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*{feed.suffix}")
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select(relative(F.col("path"), base).alias("source_file"), F.col("length").alias("file_size"))
    )
    return listed.where(F.col("source_file").startswith(feed.prefix))


def new_files(files: DataFrame, load_log: DataFrame) -> DataFrame:
    """Files without a successful load."""
    done = load_log.where("status = 'success'").select("source_file")
    return files.join(done, "source_file", "left_anti")


def read_lines(spark: SparkSession, root: str, source_files: list[str]) -> DataFrame:
    """Non-empty lines of the files, with their source_file."""
    base = absolute(spark, root)
    lines = spark.read.text([f"{base}/{name}" for name in source_files])
    return lines.select(
        relative(F.col("_metadata.file_path"), base).alias("source_file"), F.col("value").alias("line")
    ).where("line != ''")


def parse_lines(lines: DataFrame, feed: Feed) -> DataFrame:
    """Text fields as columns, and ``broken`` for lines that are not one JSON object.

    The line is parsed as the only member of a list, so that a second object or
    other text after the first is an error, as are single quotes. The fields
    come out of a generator, so that each line is parsed once.
    """
    fields = StructType([*feed.text_schema.fields]).add("_bad", StringType())
    strict = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
    members = F.from_json(F.concat(F.lit("["), "line", F.lit("]")), ArrayType(fields), strict)
    one = F.size(F.coalesce(members, F.array())) == 1
    shaped = F.coalesce(one, F.lit(False)) & F.col("line").rlike(r"^\s*\{") & F.col("line").rlike(r"\}\s*$")
    record = F.when(shaped, F.get(members, F.lit(0)))
    parsed = lines.select("source_file", "line", F.inline(F.array(F.coalesce(record, F.from_json(F.lit("{}"), fields)))), shaped.alias("_shaped"))
    return parsed.withColumn("broken", ~F.col("_shaped")).drop("_shaped")


def typed(parsed: DataFrame, feed: Feed) -> DataFrame:
    """Cast every field to its type at rest.

    ``mistyped`` marks rows with a value that does not fit; a missing value
    takes the default of its column.
    """
    columns, misfits = [], F.lit(False)
    for name, kind in feed.fields.items():
        text = F.col(name)
        value = text if isinstance(kind, StringType) else text.try_cast(kind)
        misfits = misfits | (text.isNotNull() & value.isNull())
        if name in feed.defaults:
            value = F.coalesce(value, F.lit(feed.defaults[name]).cast(kind))
        columns.append(value.alias(name))
    return parsed.select("source_file", "line", "broken", *columns, F.coalesce(misfits, F.lit(False)).alias("mistyped"))
