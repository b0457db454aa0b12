"""File sources: paper files as binary rows, the prompt template, file checks."""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Iterator
from importlib import resources

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evidentia.functions.strings import col, py_strip
from evidentia.functions.text import file_name_of
from evidentia.schema import HEADER_BYTES, PDF_MAGIC, PDF_SNIFF_BYTES
from evidentia.sources import paths

PAPER_GLOB = "*.{pdf,PDF}"
FILES_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])


def scan_papers(spark: SparkSession, path: str, glob: str = PAPER_GLOB) -> DataFrame:
    """``(path, file_name, modificationTime, length, content)`` for the paper
    files directly in ``path`` (not recursive); empty when the folder is
    missing or nothing matches.

    The listing yields each file once, so no de-duplication step (and no
    shuffle) is needed. ``content`` is read lazily: selecting only names and
    sizes never opens the files.
    """
    if not paths.exists(spark, path):
        df = spark.createDataFrame([], FILES_SCHEMA)
    else:
        df = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
              .option("recursiveFileLookup", "false").load(path))
    return df.select("path", file_name_of("path").alias("file_name"), "modificationTime",
                     "length", "content")


#: Schemes whose files the tasks open themselves, for reads of a part of a file. Others go through Spark's binary reader.
OPENED_SCHEMES = {"file": "file", "s3": "s3", "s3a": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}


def scan_heads(spark: SparkSession, path: str, glob: str = PAPER_GLOB, n: int = PDF_SNIFF_BYTES,
               opened: dict = OPENED_SCHEMES) -> DataFrame:
    """``(path, file_name, modificationTime, length, head)``: the paper files of ``scan_papers`` with their first
    ``n`` bytes, whatever their size.

    The folder is listed in a task (a folder's listing is one sequence), the list dealt over all tasks, and each
    opens its files and reads ``n`` bytes of each, so a scan costs a request a file and never
    the files' contents. ``head`` is null for a file that cannot be opened. Where the tasks cannot open a file system
    (its scheme is not in ``opened``: scheme -> the scheme's name for Arrow), Spark's binary reader delivers the
    whole content, of up to 2 GiB a file, and the head is cut from it; that reader leaves out empty files.
    """
    scheme = paths.scheme(spark, path)
    if scheme not in opened or not paths.exists(spark, path):
        return scan_papers(spark, path, glob).withColumn("head", F.substring("content", 1, n)).drop("content")
    folder = paths.qualified(spark, path)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            yield from _listing(folder, glob, opened)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stores: dict = {}
        for batch in batches:
            heads = [_head_of(p, n, stores, opened) for p in batch.column("path").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(heads, pa.binary())], [*_LISTED, "head"])

    files = spark.range(1, numPartitions=1).mapInArrow(listed, _LISTED_SCHEMA)
    dealt = files.repartition(max(2, spark.sparkContext.defaultParallelism))
    return dealt.mapInArrow(read, f"{_LISTED_SCHEMA}, head binary")


_LISTED = ["path", "file_name", "modificationTime", "length"]
_LISTED_SCHEMA = "path string, file_name string, modificationTime timestamp, length long"


def _store(uri: str, opened: dict):
    """(the file system of ``uri``, its path there, what stands before that path in a URI)."""
    from pyarrow import fs
    scheme, _, rest = uri.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/"), "file:"
    host, _, name = rest.lstrip("/").partition("/")
    store, base = fs.FileSystem.from_uri(f"{opened[scheme]}://{host}")
    return store, f"{base.rstrip('/')}/{name}", f"{scheme}://"


def _listing(folder: str, glob: str, opened: dict, rows: int = 10_000) -> Iterator[pa.RecordBatch]:
    """The files directly in ``folder`` whose name has the pattern (``{a,b}``: either)."""
    from pyarrow import fs
    store, at, before = _store(folder, opened)
    wanted = re.compile("|".join(fnmatch.translate(g) for g in _alternatives(glob)))
    found = [i for i in store.get_file_info(fs.FileSelector(at, recursive=False))
             if i.type == fs.FileType.File and wanted.match(i.base_name) and not i.base_name.startswith(("_", "."))]
    for k in range(0, len(found), rows):
        some = found[k:k + rows]
        yield pa.record_batch([pa.array([before + i.path for i in some]), pa.array([i.base_name for i in some]),
                               pa.array([i.mtime for i in some], pa.timestamp("us", "UTC")), pa.array([i.size for i in some], pa.int64())], _LISTED)


def _alternatives(glob: str) -> list[str]:
    """A pattern with ``{a,b}`` as several patterns without."""
    m = re.search(r"\{([^{}]*)\}", glob)
    return [glob] if not m else [x for a in m[1].split(",") for x in _alternatives(glob[:m.start()] + a + glob[m.end():])]


def _head_of(path: str, n: int, stores: dict, opened: dict) -> bytes | None:
    """The first ``n`` bytes of the file, by one positional read."""
    root = path.partition(":")[0] if path.startswith("file:") else "/".join(path.split("/")[:3])
    try:
        if root not in stores:
            stores[root] = _store(path, opened)[0]
        at = "/" + path.partition(":")[2].lstrip("/") if path.startswith("file:") else "/".join(path.split("/")[2:])
        with stores[root].open_input_file(at) as f:
            return f.read_at(min(n, f.size()), 0)
    except OSError:
        return None


def default_prompt() -> str:
    """The packaged prompt template, stripped. It is read where the package is installed (the driver) and
    reaches executors as a literal of the plan, never as a path."""
    return resources.files("evidentia").joinpath("resources", "coding_prompt.txt").read_text(encoding="utf-8").strip()


def load_prompt(spark: SparkSession, path: str | None = None) -> str:
    """The prompt template as one stripped UTF-8 string; a missing file raises. Without a path: the packaged one.

    A template is a few kilobytes of configuration, so it is read as one
    whole-text row and handed to the plan as a literal."""
    if path is None:
        return default_prompt()
    if not paths.exists(spark, path):
        raise FileNotFoundError(path)
    row = spark.read.text(path, wholetext=True).select(py_strip("value").alias("t")).first()
    return "" if row is None else row["t"]


def file_diagnostics(files: DataFrame, content="content", length="length") -> DataFrame:
    """Adds size, the first 10 bytes, whether ``%PDF`` occurs in the first
    1000 bytes, and the size in MB (bytes / 1048576). ``content`` may hold the
    files' first 1000 bytes only (``scan_heads``)."""
    c = col(content)
    head = F.substring(c, 1, PDF_SNIFF_BYTES)
    return files.select(
        "*",
        F.substring(c, 1, HEADER_BYTES).alias("header"),
        F.contains(head, F.lit(bytearray(PDF_MAGIC))).alias("is_pdf"),
        (col(length) / F.lit(1024 * 1024)).alias("size_mb"),
    )


def is_pdf(content) -> Column:
    return F.contains(F.substring(col(content), 1, PDF_SNIFF_BYTES), F.lit(bytearray(PDF_MAGIC)))
