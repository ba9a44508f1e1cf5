"""Raw landing (S7): files copied unchanged into a raw zone, as pieces with a manifest.

A zone is a folder with ``pieces/landing=N`` (Parquet rows of file pieces, never one folder per source file) and
``manifest/landing=N`` (one row per landed file: size, time, what its pieces hold).  A landing writes its pieces, checks
them against the listed sizes, and becomes visible when its manifest folder gets its name, by one rename.  A reader takes
for each file the pieces of its latest landing, so landing a file again replaces it, also when it has become empty; nothing
is overwritten, and a landing that fails leaves nothing to see.

``land_files`` keeps bytes.  Hadoop would decompress names like ``.gz``; a pass-through codec keeps it from that, so
every file is read as a stream, in bounded memory whatever its size, and cut behind its line feeds.  A piece's place is
``(split, record)``: the byte where its input split begins, and a number that rises along the split.

``land_raw`` keeps decoded, numbered lines in the same way.
"""

from __future__ import annotations

import hashlib
import time

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import SPLIT_BROADCAST_ROWS
from .inventory import _fs
from .lines import read_lines
from .spread import UNSPLITTABLE_SUFFIXES

# Suffixes for which Hadoop has a codec.
CODEC_SUFFIXES = (*UNSPLITTABLE_SUFFIXES, ".bz2")
MODES = ("append", "replace_source")
BLOCK_BYTES = 1 << 20    # of neighbouring pieces that a digest's sort moves as one row
DIGEST_BYTES = 64 << 20  # of files a digest's partition, if the session's partitions would hold more


def _plain(path: str = "source_path"):
    """Listings write a local path's slashes differently."""
    return F.regexp_replace(path, "^file:/+", "file:///")


def _listed(spark: SparkSession, src: str) -> DataFrame:
    """``(source_path, source_size, source_mtime)`` of the files under ``src``, empty ones included."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(src)
    sized = listing.select(F.col("_metadata.file_path").alias("source_path"), F.col("_metadata.file_size").alias("source_size"),
                           F.col("_metadata.file_modification_time").alias("source_mtime"))
    # A scan skips empty files; the file index has their names, too.
    names = spark.createDataFrame([(f,) for f in listing.inputFiles()], "source_path string").withColumn("source_path", _plain())
    return names.join(sized.withColumn("source_path", _plain()), "source_path", "left").select(
        "source_path", F.coalesce("source_size", F.lit(0)).cast("long").alias("source_size"), "source_mtime")


def _suffix(path: str):
    return F.coalesce(*[F.when(F.col(path).endswith(x), F.lit(x)) for x in CODEC_SUFFIXES], F.lit(""))


def file_pieces(spark: SparkSession, src: str) -> DataFrame:
    """``(source_path, split, record, bytes)``: every file under ``src`` cut behind its line feeds, which the pieces leave out.

    One scan for the names without a codec (large files split), one for each suffix with one (a task streams a file)."""
    reader = spark.read.option("recursiveFileLookup", "true")
    found = reader.format("binaryFile").load(src).select(_suffix("path").alias("s")).distinct().collect()  # a few suffixes
    codec = spark.sparkContext._jvm.org.apache.hadoop.io.compress.PassthroughCodec
    out = None
    for suffix in sorted({r["s"] for r in found} | {""}):
        text = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n")
        if suffix:
            text = text.option("io.compression.codecs", codec.CLASSNAME).option(codec.OPT_EXTENSION, suffix)
        name = F.col("_metadata.file_path")
        mine = name.endswith(suffix) if suffix else ~F.coalesce(*[F.when(name.endswith(x), True) for x in CODEC_SUFFIXES], F.lit(False))
        rows = text.text(src).where(mine).select(
            name.alias("source_path"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("record"),
            F.col("value").cast("binary").alias("bytes"))
        out = rows if out is None else out.unionByName(rows)
    return out.withColumn("source_path", _plain())


def _land(spark: SparkSession, pieces: DataFrame, files: DataFrame, raw_path: str, mode: str, held, check) -> None:
    """Write a landing: ``pieces`` (with ``source_path``), then its manifest: ``files`` with the aggregates ``held`` of their
    pieces, in which ``check`` must hold for every row."""
    if mode not in MODES:
        raise ValueError("mode must be 'replace_source' or 'append'")
    number = f"{time.time_ns():020d}"
    place = f"{raw_path.rstrip('/')}/pieces/landing={number}"
    pieces.write.option("compression", "zstd").parquet(place)
    of_file = spark.read.parquet(place).groupBy("source_path").agg(*held, F.count(F.lit(1)).alias("n_pieces"))
    rows = files.join(of_file, "source_path", "left").withColumn("replaces", F.lit(mode == "replace_source"))
    staged = f"{raw_path.rstrip('/')}/_staged/{number}"
    rows.write.parquet(staged)
    wrong = spark.read.parquet(staged).where(~F.coalesce(check, F.lit(False))).select("source_path").limit(5).collect()
    if wrong:
        raise RuntimeError(f"not landed whole, or changed meanwhile: {[r['source_path'] for r in wrong]}")
    target, fs = _fs(spark, f"{raw_path.rstrip('/')}/manifest/landing={number}")
    fs.mkdirs(target.getParent())
    if not fs.rename(_fs(spark, staged)[0], target):
        raise OSError(f"could not publish landing {number}")


def raw_manifest(spark: SparkSession, raw_path: str) -> DataFrame:
    """The manifest rows a reader goes by: of each file its latest replacing landing and those appended since."""
    rows = spark.read.schema("landing string, source_path string, source_size long, source_mtime timestamp, held long, "
                             "n_pieces long, replaces boolean").parquet(f"{raw_path.rstrip('/')}/manifest")
    latest = rows.where("replaces").groupBy("source_path").agg(F.max("landing").alias("_lk_from"))
    return rows.join(latest, "source_path", "left").where(
        F.col("_lk_from").isNull() | (F.col("landing") >= F.col("_lk_from"))).drop("_lk_from")


def _visible(spark: SparkSession, raw_path: str) -> tuple[DataFrame, bool, int]:
    """The manifest rows a reader goes by, marked for a broadcast if they are few; whether they are; the bytes of their files."""
    visible = raw_manifest(spark, raw_path).select("landing", "source_path", "source_size", "source_mtime", "held")
    n_rows, n_bytes = visible.agg(F.count(F.lit(1)), F.coalesce(F.sum("source_size"), F.lit(0))).first()
    few = n_rows <= SPLIT_BROADCAST_ROWS
    return F.broadcast(visible) if few else visible, few, n_bytes


def _stored_pieces(spark: SparkSession, raw_path: str, columns: str) -> DataFrame:
    return spark.read.schema(f"landing string, source_path string, {columns}").parquet(f"{raw_path.rstrip('/')}/pieces")


def _pieces(spark: SparkSession, raw_path: str, columns: str) -> DataFrame:
    return _stored_pieces(spark, raw_path, columns).join(_visible(spark, raw_path)[0], ["landing", "source_path"])


BYTES = "split long, record long, bytes binary"


def land_files(spark: SparkSession, src: str, raw_path: str, mode: str = "replace_source") -> DataFrame:
    """S7: land the files under ``src`` byte by byte; returns the manifest a reader goes by.

    The pieces' bytes and line feeds must add up to the listed size, but for a last line feed that isn't there and
    a leading byte order mark (three bytes), which the text reader drops and the manifest's sizes give back.
    ``replace_source`` (default): a landed file replaces its earlier landings; ``append``: it is there once more.
    """
    held = F.sum(F.octet_length("bytes") + 1).cast("long").alias("held")
    differs = F.col("source_size") - F.coalesce("held", F.lit(0))
    _land(spark, file_pieces(spark, src), _listed(spark, src), raw_path, mode, [held], differs.isin(0, -1, 2, 3))
    return raw_manifest(spark, raw_path)


def landed_pieces(spark: SparkSession, raw_path: str) -> DataFrame:
    """``(source_path, landing, source_size, held, split, record, bytes)`` of the files a reader sees."""
    return _pieces(spark, raw_path, BYTES).select("source_path", "landing", "source_size", "held", "split", "record", "bytes")


def _blocks(pieces: DataFrame) -> DataFrame:
    """``(source_path, landing, split, record, block)``: neighbouring pieces from ``record`` on, without a gap, with their
    line feeds and compressed: a sort holds neither a row nor a path for every line.

    A scan meets the pieces of a split in the order they were written in; in another order blocks would only be shorter."""
    def packed(batches):
        press = pa.Codec("zstd", 1)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            path, landing, split, record, lines = batch.columns
            split, record, lines = split.to_numpy(), record.to_numpy(), lines.cast(pa.large_binary())
            off = np.frombuffer(lines.buffers()[1], np.int64, n + 1, 8 * lines.offset)
            data = lines.buffers()[2]
            part = (off[:-1] - off[0]) // BLOCK_BYTES
            fresh = np.ones(n, bool)
            fresh[1:] = (split[1:] != split[:-1]) | (record[1:] != record[:-1] + 1) | (part[1:] != part[:-1])
            for c in (path, landing):
                fresh[1:] |= pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)
            first = np.flatnonzero(fresh)
            end = np.append(first[1:], n)
            yield pa.RecordBatch.from_arrays(
                [path.take(pa.array(first)), landing.take(pa.array(first)), pa.array(split[first]), pa.array(record[first]),
                 pa.array([press.compress(data[a:b], asbytes=True) for a, b in zip(off[first].tolist(), off[end].tolist())], pa.binary())],
                names=["source_path", "landing", "split", "record", "block"])

    return pieces.select("source_path", "landing", "split", "record", F.concat("bytes", F.lit(b"\n")).alias("lines")).mapInArrow(
        packed, "source_path string, landing string, split long, record long, block binary")


def landed_digests(spark: SparkSession, raw_path: str) -> DataFrame:
    """``(source_path, landing, n_bytes, sha256)`` of every landed file that has a piece, rebuilt from its pieces (an
    empty file has none, nor has one that holds a byte order mark only).

    A SHA-256 is sequential: a task streams the blocks of a file's pieces in order and holds two blocks at a time."""
    def digests(batches):
        now, sha, size, want, last = None, None, 0, None, None

        def end():
            # Every piece but the last ends with a line feed; the last one if the file did.
            tail = last if want[0] - want[1] in (0, 3) else last[:-1]
            sha.update(tail)
            return now[0], now[1], size + len(tail), sha.hexdigest()

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.string(), pa.int64(), pa.string()))],
                                              names=["source_path", "landing", "n_bytes", "sha256"])

        for batch in batches:
            out = []
            for path, landing, total, held, block in zip(*(c.to_pylist() for c in batch.columns)):
                if (path, landing) != now:
                    if now is not None:
                        out.append(end())
                    now, sha, size, want = (path, landing), hashlib.sha256(), 0, (total, held)
                    if total - held in (2, 3):
                        sha.update(b"\xef\xbb\xbf")
                        size = 3
                else:
                    sha.update(last)
                    size += len(last)
                last = pa.input_stream(pa.py_buffer(block), compression="zstd").read()
            if out:
                yield batch_of(out)
        if now is not None:
            yield batch_of([end()])

    visible, few, n_bytes = _visible(spark, raw_path)
    pieces = _stored_pieces(spark, raw_path, BYTES)
    if few:  # a broadcast join leaves the scan's order; a shuffle join comes after the blocks
        pieces = pieces.join(visible, ["landing", "source_path"], "left_semi")
    blocks = _blocks(pieces).join(visible, ["landing", "source_path"])
    n = -(-n_bytes // DIGEST_BYTES)
    by_file = ["source_path", "landing"]
    dealt = blocks.repartition(n, *by_file) if n > int(spark.conf.get("spark.sql.shuffle.partitions")) else blocks.repartition(*by_file)
    return dealt.sortWithinPartitions(*by_file, "split", "record").select(
        *by_file, "source_size", "held", "block").mapInArrow(
        digests, "source_path string, landing string, n_bytes long, sha256 string")


def raw_lines_with_source(spark: SparkSession, src: str, line_sep: str | None = "\n") -> DataFrame:
    """Numbered lines of ``src`` with their provenance.

    Lines end at LF only, so a CR before it stays in the value.
    """
    lines = read_lines(spark, src, line_sep=line_sep, recursive=True, spread=False)
    return lines.select(F.col("file_path").alias("source_path"), "line_no", "value")


def land_raw(spark: SparkSession, src: str, raw_path: str, line_sep: str | None = "\n",
             mode: str = "replace_source") -> DataFrame:
    """S7 for lines: land the decoded lines of ``src`` unchanged and numbered, with provenance.

    ``replace_source`` (default): landing a file again replaces its lines, also when it has become empty; ``append``
    adds rows.  Returns the raw zone as a DataFrame.
    """
    lines = raw_lines_with_source(spark, src, line_sep).withColumn("source_path", _plain())
    last = (F.max("line_no") + 1).cast("long").alias("held")
    _land(spark, lines, _listed(spark, src), raw_path, mode, [last], F.coalesce("n_pieces", F.lit(0)) == F.coalesce("held", F.lit(0)))
    return raw_zone(spark, raw_path)


def raw_zone(spark: SparkSession, raw_path: str) -> DataFrame:
    """The landed lines: ``(source_path, source_size, source_mtime, line_no, value)``."""
    return _pieces(spark, raw_path, "line_no long, value string").select("source_path", "source_size", "source_mtime", "line_no", "value")
