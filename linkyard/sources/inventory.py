"""Object listing and existence probe (S5, S6).

The listing uses the ``binaryFile`` source with its ``content`` column
pruned: Spark lists the files on the driver's file index and reads no
bytes (the scan's ReadSchema has path and length only).  What that index leaves
out, hidden names and empty files, comes from a file-system iterator.  The first n keys
need no such index: folders are listed in key order until there are enough.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    """The path and its file system (any Hadoop scheme)."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath, hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _beside_scan(spark: SparkSession, root: str) -> DataFrame:
    """``(path, length)`` of the files that a scan of ``root`` may leave out: empty ones, and those with a
    hidden name or folder below ``root``.  The driver walks all names and holds only these."""
    hpath, fs = _fs(spark, root)
    rows = []
    for top in fs.globStatus(hpath) or []:
        above = len(top.getPath().toString())
        files = fs.listFiles(top.getPath(), True)
        while files.hasNext():
            f = files.next()
            path, length = f.getPath().toString(), f.getLen()
            names = path[above:].split("/")
            if length == 0 or path[above:] == "" or any(n.startswith(("_", ".")) or n.endswith("._COPYING_") for n in names):
                rows.append((path, length))
    return spark.createDataFrame(rows, "path string, length long")


def _entries(fs, folder) -> list[tuple[str, object]]:
    """``(key, status)`` of a folder's entries in key order; a sub-folder's key ends with a slash, as its files' keys go on."""
    return sorted(((f.getPath().getName() + ("/" if f.isDirectory() else ""), f) for f in fs.listStatus(folder)), key=lambda e: e[0].encode())


def first_keys(spark: SparkSession, root: str, n: int) -> DataFrame:
    """``(path, length)`` of the first ``n`` files under ``root`` by path: folders are listed in key order, one at a
    time, until there are enough; what lies behind them is not listed."""
    hpath, fs = _fs(spark, root)
    found: list[tuple[str, int]] = []

    def walk(folder) -> None:
        for _, f in _entries(fs, folder):
            if len(found) >= n:
                return
            if f.isDirectory():
                walk(f.getPath())
            else:
                found.append((f.getPath().toString(), f.getLen()))

    for top in sorted(fs.globStatus(hpath) or [], key=lambda f: f.getPath().toString().encode()):
        if top.isDirectory():
            walk(top.getPath())
        else:
            found.append((top.getPath().toString(), top.getLen()))
    return spark.createDataFrame(found[:n], "path string, length long")


def file_inventory(spark: SparkSession, root: str, limit: int | None = None) -> DataFrame:
    """S5: ``(path, length)`` of every file under ``root``, hidden names (``_``, ``.``) and empty files
    included; ``limit`` = first keys by path (``first_keys``)."""
    if limit is not None and limit > 0:
        return first_keys(spark, root, limit)
    scan = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
        .select("path", "length")
    )
    return scan.unionByName(_beside_scan(spark, root).join(scan, "path", "left_anti"))


def object_exists(spark: SparkSession, root: str, path: str | None = None) -> bool:
    """S6: does ``root`` hold any file?  With ``path``: is ``path`` a file
    (the one-object probe)?  A missing root or object is False.

    The listing is a file-system iterator that stops at the first file and, unlike
    Spark's own listing, hides no name (``_`` and ``.`` included).
    """
    hpath, fs = _fs(spark, path if path is not None else root)
    if not fs.exists(hpath):
        return False
    if path is not None:
        return bool(fs.getFileStatus(hpath).isFile())
    return bool(fs.listFiles(hpath, True).hasNext())
