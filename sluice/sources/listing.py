"""Landing listing (S1, S1a, S1b): every non-empty file under a name prefix."""

from __future__ import annotations

import os
import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import extension

PATH = "_path"
FILE_URI = "_file_uri"  # _metadata.file_path as Spark gives it (percent-encoded)
FILE_ID = "_file_id"


def prefix_glob(root: str, source_path: str) -> str:
    """Glob for 'every object whose name starts with source_path'."""
    return root.rstrip("/") + "/" + source_path + "*"


def decoded_path(c: Column) -> Column:
    """``_metadata.file_path`` is percent-encoded; '+' is literal in it."""
    return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def file_id(uri: Column, seed: int = 0) -> Column:
    """Compact key of a file, the same in the listing and in every scan. The
    run picks a seed under which no two of its files share a key."""
    return F.xxhash64(F.lit(seed), uri)


def absolute_root(root: str) -> str:
    """A local relative root is made absolute (Spark reports absolute paths)."""
    if re.match(r"^[A-Za-z][A-Za-z0-9+.-]*:", root) or root.startswith("/"):
        return root
    return os.path.abspath(root)


def relative_name(path: Column, root: str) -> Column:
    """Object name relative to the landing root (what the reports show)."""
    bare = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:", "", absolute_root(root)).strip("/")
    rx = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?/*" + re.escape(bare) + r"/+(.*)$"
    return F.regexp_extract(path, rx, 1)


def inputs(root: str, source_path: str, paths: list[str] | None = None):
    """What the readers load: an explicit file list, taken literally, or the prefix glob."""
    return [re.sub(r"([\\\[\]{}*?])", r"\\\1", p) for p in paths] if paths else prefix_glob(root, source_path)


#: In place of the extension of a file that Spark's sources do not read (a name, or a folder's, that begins with _ or .).
HIDDEN = "/hidden"


def hidden_files(spark: SparkSession, root: str, source_path: str) -> list[tuple[str, int]]:
    """(path, bytes) of the non-empty files under the prefix that Spark's own listing leaves out.

    The file system is asked for hidden names only, a depth at a time, so what comes to the
    driver is as long as their number; folders of such names are listed whole."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    literal = re.sub(r"([\\\[\]{}*?])", r"\\\1", root.rstrip("/")) + "/"
    # the last part of the prefix is the beginning of a name
    folder, _, name = source_path.rpartition("/")
    folder = literal + (folder + "/" if folder else "")
    fs = jvm.org.apache.hadoop.fs.Path(literal).getFileSystem(conf)
    glob = lambda pattern: list(fs.globStatus(jvm.org.apache.hadoop.fs.Path(pattern)) or [])
    found: list[tuple[str, int]] = []

    def take(status) -> None:
        if status.isFile():
            if status.getLen() > 0:
                found.append((status.getPath().toString(), status.getLen()))
            return
        inside = fs.listFiles(status.getPath(), True)
        while inside.hasNext():
            child = inside.next()
            if child.getLen() > 0:
                found.append((child.getPath().toString(), child.getLen()))

    def hidden(pattern: str) -> list:
        named = [(s, s.getPath().getName()) for s in glob(pattern)]
        return [s for s, n in named if n.startswith(".") or n.startswith("_") and "=" not in n]  # _key=value is read

    read = "{[!_.]*,_*=*}"
    if not name or name[0] in "_.":
        for status in hidden(f"{folder}{name}*" if name else f"{folder}[_.]*"):
            take(status)
    deeper = f"{folder}{name}*" if name else folder + read
    while True:
        folders = [s for s in fs.globStatus(jvm.org.apache.hadoop.fs.Path(deeper + "/*")) or []][:1]
        if not folders:
            return found
        for status in hidden(deeper + "/[_.]*"):
            take(status)
        deeper += "/" + read


def list_files(
    spark: SparkSession, root: str, source_path: str, paths: list[str] | None = None, seed: int = 0
) -> DataFrame:
    """(_path, source_filename, length, ext, _file_id) of every non-empty landing file.

    ``binaryFile`` with only path/length selected lists without reading
    content; 0-byte objects get no row at all (no file_stats either).
    """
    try:
        listing = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .load(inputs(root, source_path, paths))
            .select(F.col("path").alias(PATH), F.col("_metadata.file_path").alias(FILE_URI), "length")
        )
    except AnalysisException as e:
        if paths or "PATH_NOT_FOUND" not in str(e):
            raise  # a file that was named must be there
        # Nothing landed under the prefix: empty outputs, as for an empty listing.
        listing = spark.createDataFrame([], f"{PATH} string, {FILE_URI} string, length long")
    listing = listing.where(F.col("length") > 0).withColumn("ext", extension(F.col(PATH)))
    hidden = [] if paths else hidden_files(spark, absolute_root(root), source_path)
    if hidden:
        rows = spark.createDataFrame(hidden, f"{PATH} string, length long")
        listing = listing.unionByName(rows.select(PATH, F.col(PATH).alias(FILE_URI), "length", F.lit(HIDDEN).alias("ext")))
    return listing.select(
        PATH,
        relative_name(F.col(PATH), root).alias("source_filename"),
        "length",
        "ext",
        file_id(F.col(FILE_URI), seed).alias(FILE_ID),
    )


def reader(spark: SparkSession, ext: str):
    """DataFrameReader over the same listing, restricted to one extension."""
    return (
        spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", f"*.{ext}")
    )
