"""Reading and writing the files of a collection, wherever Spark reaches them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..session import cut

#: Fixed value: bytes that a cheap comparison looks at.
PREFIX = 1024

METADATA_JSON = "unique_id string, title string, year string, category string, tags array<string>, research_type string, sentiment_type string"


def binary_files(spark: SparkSession, folder: str, glob: str = "*.[pP][dD][fF]") -> DataFrame:
    """path, modificationTime, length and content of a folder's files; content is only read where it is selected."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)


def initial_bytes(files: DataFrame, n: int = PREFIX) -> DataFrame:
    return files.select("path", F.substring("content", 1, n).alias("prefix"))


def text_files(spark: SparkSession, folder: str, glob: str = "*.[tT][xX][tT]") -> DataFrame:
    """file_name and text of a folder's text files, line ends as \\n. Paths come percent-encoded and are decoded here."""
    found = spark.read.option("pathGlobFilter", glob).text(folder, wholetext=True).select("value", "_metadata.file_name")
    name = F.coalesce(F.try_url_decode(F.replace("file_name", F.lit("+"), F.lit("%2B"))), F.col("file_name"))
    return found.select(name.alias("file_name"), X.unix_lines(F.col("value")).alias("text"))


def used_ids(spark: SparkSession, path: str) -> DataFrame:
    """The identifiers of a registry: one a line, blank lines left out."""
    return spark.read.text(path).select(X.strip(F.col("value")).alias("unique_id")).filter("unique_id <> ''").distinct()


def append_ids(ids: DataFrame, path: str) -> None:
    ids.select("unique_id").write.mode("append").text(path)


def metadata_json(spark: SparkSession, folder: str, one_per_file: bool = False) -> DataFrame:
    """Records of JSON files, an object a line, or one object, over several lines, a file; broken ones, and ones without an identifier, are left out, so that a later join gives them empty fields."""
    return spark.read.schema(METADATA_JSON).option("multiLine", one_per_file).option("mode", "DROPMALFORMED").json(folder).filter("unique_id IS NOT NULL")


def write_metadata(records: DataFrame, folder: str) -> None:
    """One JSON object a line, without relevance."""
    records.drop("relevance").write.mode("overwrite").json(folder)


def write_documents(documents: DataFrame, folder: str) -> None:
    documents.drop("chunk_file").write.mode("overwrite").json(folder)


def write_text(docs: DataFrame, folder: str) -> None:
    """Texts as a JSON object a line, with their unique_id: one table, however many documents there are."""
    docs.select("unique_id", "text").write.mode("overwrite").json(folder)


def write_images(images: DataFrame, folder: str) -> None:
    """Images with their bytes as a Parquet table, in folders by extension."""
    images.write.mode("overwrite").partitionBy("extension").parquet(folder)


def table_csv(tables: DataFrame) -> DataFrame:
    """(unique_id, table_no, csv) of extracted tables' rows (unique_id, table_no, row_no, cells map<string,string>): a header of the table's own columns, in the order they come up,
    then a line per row; a cell that a row doesn't have is empty. A table's rows meet in a task; tables of a document are small."""
    found = tables.groupBy("unique_id", "table_no").agg(F.sort_array(F.collect_list(F.struct("row_no", F.map_entries("cells").alias("cells")))).alias("rows"))
    found = found.withColumn("header", F.array_distinct(F.flatten(F.transform("rows", lambda r: F.transform(r["cells"], lambda c: c["key"])))))
    quoted = lambda c: F.concat(F.lit('"'), F.replace(F.coalesce(c, F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))
    line = lambda r: F.array_join(F.transform("header", lambda h: quoted(F.try_element_at(F.map_from_entries(r["cells"]), h))), ",")
    lines = F.concat(F.array(F.array_join(F.transform("header", quoted), ",")), F.transform("rows", line))
    return found.select("unique_id", "table_no", F.array_join(lines, "\n").alias("csv"))


def write_tables(tables: DataFrame, folder: str) -> None:
    """Extracted tables as CSV files with their own columns and a header, a folder per table."""
    table_csv(tables).write.mode("overwrite").partitionBy("unique_id", "table_no").option("lineSep", "\n").text(folder)


def append_new(df: DataFrame, path: str, keys: list[str]) -> None:
    """Appends the rows whose keys the Parquet table at path doesn't have; makes the table if it isn't there."""
    spark = df.sparkSession
    try:
        old = spark.read.parquet(path).select(*keys).distinct()
    except Exception as e:  # the table's absence is a condition, all else an error
        if "PATH_NOT_FOUND" not in str(e):
            raise
        df.write.parquet(path)
        return
    cut(df.join(old, keys, "left_anti")).write.mode("append").parquet(path)


def sqlite_rows(records: DataFrame, path: str, table: str = "metadata") -> None:
    """Upserts records, in stored form, into a SQLite file on the driver's disk; rows stream through, a partition at a time."""
    import sqlite3

    fields = ["unique_id", "title", "year", "category", "tags", "research_type", "sentiment_type", "relevance"]
    columns = ", ".join(f"{c} {'INTEGER' if c == 'relevance' else 'TEXT PRIMARY KEY' if c == 'unique_id' else 'TEXT'}" for c in fields)
    with sqlite3.connect(path) as db:
        db.execute(f"CREATE TABLE IF NOT EXISTS {table} ({columns})")
        db.executemany(f"INSERT OR REPLACE INTO {table} ({', '.join(fields)}) VALUES ({', '.join('?' * len(fields))})", (tuple(r) for r in records.select(*fields).toLocalIterator()))
