"""Tables, series, nested records and whole documents."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import groupby, islice
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tarnworks.operators.scale import spread

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
RUN_SCHEMA = "Date string, Miles double, Time string"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def register_views(spark: SparkSession, folder: str) -> None:
    """Make every table of a folder available to SQL."""
    for name in TABLES:
        table(spark, folder, name).createOrReplaceTempView(name)


def run_sql(spark: SparkSession, sql: str) -> DataFrame:
    return spark.sql(sql)


def read_runs(spark: SparkSession, path: str, line_sep: str = "\r") -> DataFrame:
    """Running log ``Date, Miles, Time`` with ``M/d/yy`` dates and CR line ends."""
    raw = spark.read.csv(path, header=True, schema=RUN_SCHEMA, lineSep=line_sep)
    return raw.withColumn("Date", F.try_to_timestamp("Date", F.lit("M/d/yy")).cast("date"))


def read_returns(spark: SparkSession, path: str) -> DataFrame:
    """Stock returns ``date, S1 ...`` with empty cells as null."""
    raw = spark.read.csv(path, header=True)
    return raw.select(
        F.try_to_timestamp("date", F.lit("M/d/yyyy H:mm")).alias("date"),
        *[F.col(c).try_cast("double").alias(c) for c in raw.columns if c != "date"],
    )


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """JSON files each holding a list of nested records."""
    return spark.read.json(path, multiLine=True)


def write_records(rows: DataFrame, path: str, per_file: int = 10_000) -> None:
    """Rows as nested records in files of one JSON list each, of at most ``per_file`` records. A
    list is made of rows that lie together, so nothing is gathered beyond one file."""
    place = F.floor(F.monotonically_increasing_id() / per_file)
    listed = rows.select(F.struct("*").alias("record"), place.alias("file")).groupBy("file").agg(
        F.to_json(F.collect_list("record")).alias("value")
    )
    listed.select("value").write.option("maxRecordsPerFile", 1).text(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Every file of a folder as one document: ``doc_id`` (file name), ``text``."""
    raw = spark.read.text(path, wholetext=True)
    return raw.select(
        F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1).alias("doc_id"),
        F.col("value").alias("text"),
    )


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a path and the path in it."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def _arrow_rows(df: DataFrame, schema: StructType, work: Callable[[Iterator[dict]], Iterator[dict]]) -> DataFrame:
    """``work`` on the rows of each task, a few at a time."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = work(row for b in batches for at in range(0, len(b), 64) for row in b.slice(at, 64).to_pylist())
        while some := list(islice(found, 64)):
            yield pa.RecordBatch.from_pylist(some, schema=arrow)

    return df.mapInArrow(run, schema)


def write_document_files(docs: DataFrame, path: str, folders: int = 256) -> DataFrame:
    """One text file for each document (doc_id, text; ids differ), in ``folders`` folders by a
    hash of the id. Returns the manifest ``doc_id, path, bytes``, which is stored beside them.

    Tasks write their files where they stay, so that nothing is renamed or listed by the driver;
    one that runs again writes the same files. Texts that share an id follow each other in one
    file, a line end between them."""
    dealt = spread(docs.select(
        F.pmod(F.xxhash64("doc_id"), F.lit(folders)).cast("int").alias("folder"),
        "doc_id", F.coalesce("text", F.lit("")).alias("text"),
    ), "doc_id").sortWithinPartitions("folder", "doc_id")
    spark = docs.sparkSession

    def work(rows: Iterator[dict]) -> Iterator[dict]:
        store, root = _file_system(path)
        last = None
        for (folder, key), same in groupby(rows, lambda r: (r["folder"], r["doc_id"])):
            if folder != last:
                store.create_dir(f"{root}/files/{folder}", recursive=True)
                last = folder
            name = "%null" if key is None else quote(str(key), safe="")
            n = 0
            with store.open_output_stream(f"{root}/files/{folder}/{name}.txt") as out:
                for k, row in enumerate(same):
                    n += out.write((b"\n" if k else b"") + row["text"].encode())
            yield {"doc_id": key, "path": f"{path}/files/{folder}/{name}.txt", "bytes": n}

    schema = StructType([docs.schema["doc_id"], *StructType.fromDDL("path string, bytes long")])
    _arrow_rows(dealt, schema, work).write.parquet(f"{path}/manifest")
    return spark.read.parquet(f"{path}/manifest")


def read_document_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, text`` of the files of ``write_document_files``, by its manifest."""

    def work(rows: Iterator[dict]) -> Iterator[dict]:
        store, _ = _file_system(path)
        for row in rows:
            with store.open_input_stream(_file_system(row["path"])[1]) as file:
                yield {"doc_id": row["doc_id"], "text": file.read().decode()}

    manifest = spread(spark.read.parquet(f"{path}/manifest").select("doc_id", "path"), "path")
    schema = StructType([manifest.schema["doc_id"], *StructType.fromDDL("text string")])
    return _arrow_rows(manifest, schema, work)


def from_values(spark: SparkSession, values: Iterable[float]) -> DataFrame:
    """One double column ``x`` from a small Python collection."""
    return spark.createDataFrame([(float(v),) for v in values], "x double")


def write_by_document(results: DataFrame, path: str, folders: bool = False) -> None:
    """Results of documents (``doc_id`` and others): one Parquet table, or on request their
    ``value`` in one text folder per document, which is for few documents only."""
    if folders:
        results.select("doc_id", "value").write.partitionBy("doc_id").text(path)
    else:
        results.write.parquet(path)
