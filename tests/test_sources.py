"""Sources: numbered line scan, generator, listing, landing."""

from __future__ import annotations

import os

import pytest
import re

from pyspark.sql import functions as F

from linkyard.operators import extract_refs
from linkyard.sources import (
    file_inventory, generate_index_lines, land_raw, object_exists, read_lines, read_lines_raw,
    write_index_files,
)

from .fixtures import write_text, x1_lines


def test_line_numbers_exact_across_splits(spark, workdir):
    lines = [f"row {i} " + "x" * (i % 37) for i in range(30_000)]
    write_text(f"{workdir}/big/a.txt", lines)
    write_text(f"{workdir}/big/b.txt.gz", lines[:500], gz=True)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        df = read_lines(spark, f"{workdir}/big")
        assert df.rdd.getNumPartitions() > 4  # really split
        plan = df._jdf.queryExecution().executedPlan().toString()
        # The split table is broadcast; the lines themselves are not shuffled.
        assert "BroadcastHashJoin" in plan
        assert re.search(r"hashpartitioning\(file_path#\d+, _lk_split", plan)
        assert not re.search(r"hashpartitioning\(file_path#\d+, line_no", plan)
        got = {(os.path.basename(r["file_path"]), r["line_no"]): r["value"] for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want = {("a.txt", i): v for i, v in enumerate(lines)}
    want.update({("b.txt.gz", i): v for i, v in enumerate(lines[:500])})
    assert got == want


def test_line_endings_and_separators(spark, workdir):
    write_text(f"{workdir}/crlf/a.txt", ["a", "b\u001cc", "d\u0085e", "f\u000bg"], eol="\r\n")
    write_text(f"{workdir}/cr/a.txt", ["x", "y"], eol="\r")
    crlf = [r["value"] for r in read_lines(spark, f"{workdir}/crlf").orderBy("line_no").collect()]
    assert crlf == ["a", "b\u001cc", "d\u0085e", "f\u000bg"]
    assert read_lines(spark, f"{workdir}/cr").count() == 2


def test_custom_line_separator_cuts_one_line_index(spark, workdir):
    one_line = "".join(x1_lines()[1:101])  # 100 JSON objects, no newline
    write_text(f"{workdir}/one/a.json", [one_line])
    assert read_lines(spark, f"{workdir}/one").count() == 1
    cut = read_lines(spark, f"{workdir}/one", line_sep="},")
    # 100 objects + the final newline after the last separator.
    assert cut.count() == 101
    assert cut.where(F.col("value").contains("https://")).count() == 100
    assert extract_refs(cut).count() == extract_refs(read_lines(spark, f"{workdir}/one")).count() == 200


def test_generator_matches_x1_shape(spark):
    gen = generate_index_lines(spark.range(100), "id", "E", "payer")
    got = [r["value"] for r in gen.orderBy("line_no").collect()]
    assert got == x1_lines("E")
    assert [r["line_no"] for r in gen.orderBy("line_no").collect()] == list(range(102))


def test_written_index_reads_back_in_order(spark, workdir):
    gen = generate_index_lines(spark.range(0, 3000, 7).repartition(5), "id", "E")
    path = write_index_files(gen, f"{workdir}/gz-index")
    assert all(p.endswith(".txt.gz") for p in os.listdir(path) if p.startswith("part-"))
    back = read_lines(spark, path).orderBy("file_path", "line_no")
    assert [r["value"] for r in back.collect()] == [r["value"] for r in gen.orderBy("line_no").collect()]


def test_inventory_lists_hidden_and_empty_files(spark, workdir):
    sizes = {"_SUCCESS": 0, "_a.txt": 3, "_day=1/x.txt": 6, "_tmp/b.txt": 4, ".c": 5, "d/e.txt": 0, "f.txt": 2}
    for name, size in sizes.items():
        os.makedirs(os.path.dirname(f"{workdir}/_up/{name}"), exist_ok=True)
        with open(f"{workdir}/_up/{name}", "w") as f:
            f.write("x" * size)

    def listed(**how):
        return [(r["path"].split("/_up/")[1], r["length"]) for r in file_inventory(spark, f"{workdir}/_up", **how).collect()]

    assert sorted(listed()) == sorted(sizes.items())
    assert listed(limit=3) == sorted(sizes.items())[:3]


def test_inventory_exists_and_raw_landing(spark, workdir):
    write_text(f"{workdir}/land/x/a.txt", ["one", "two"])
    write_text(f"{workdir}/land/b.txt.gz", ["three"], gz=True)
    inv = file_inventory(spark, f"{workdir}/land")
    assert sorted(os.path.basename(r["path"]) for r in inv.collect()) == ["a.txt", "b.txt.gz"]
    assert "content" not in inv.columns
    assert [os.path.basename(r["path"]) for r in file_inventory(spark, f"{workdir}/land", 1).collect()] == ["b.txt.gz"]
    assert object_exists(spark, f"{workdir}/land")
    assert not object_exists(spark, f"{workdir}/nothing-here")
    assert not object_exists(spark, f"{workdir}/land", "file:/no/such/file")
    assert object_exists(spark, f"{workdir}/land", f"{workdir}/land/x/a.txt")  # plain path form
    assert object_exists(spark, f"{workdir}/land", f"file://{workdir}/land/b.txt.gz")
    assert not object_exists(spark, f"{workdir}/land", f"{workdir}/land/x")  # a folder is not an object
    raw = land_raw(spark, f"{workdir}/land", f"{workdir}/raw")
    assert raw.columns == ["source_path", "source_size", "source_mtime", "line_no", "value"]
    assert sorted(r["value"] for r in raw.collect()) == ["one", "three", "two"]
    assert raw.where(F.col("source_size") <= 0).count() == 0
    assert {os.path.basename(r["source_path"]) for r in raw.collect()} == {"a.txt", "b.txt.gz"}
    # Landing a file again replaces it; other landed files stay.
    write_text(f"{workdir}/land2/b.txt.gz", ["three", "four"], gz=True)
    land_raw(spark, f"{workdir}/land", f"{workdir}/raw")
    again = land_raw(spark, f"{workdir}/land2", f"{workdir}/raw")
    assert sorted(r["value"] for r in again.collect()) == ["four", "one", "three", "three", "two"]
    # A file that has become empty leaves nothing; a file's bytes can be rebuilt, CR included.
    open(f"{workdir}/land/x/a.txt", "w").close()
    write_text(f"{workdir}/land/c.txt", ["p", "", "q"], eol="\r\n")
    zone = land_raw(spark, f"{workdir}/land", f"{workdir}/raw")
    names = {os.path.basename(r["source_path"]): [] for r in zone.collect()}
    for r in zone.orderBy("source_path", "line_no").collect():
        names[os.path.basename(r["source_path"])].append(r["value"])
    assert "a.txt" not in names and "".join(v + "\n" for v in names["c.txt"]) == "p\r\n\r\nq\r\n"


def test_object_exists_hides_no_name(spark, workdir):
    write_text(f"{workdir}/hidden/_only", ["x"])
    assert object_exists(spark, f"{workdir}/hidden")
    os.makedirs(f"{workdir}/hollow/deeper")
    assert not object_exists(spark, f"{workdir}/hollow")


def test_raw_scan_has_no_line_numbers(spark, workdir):
    write_text(f"{workdir}/r/a.txt", ["p", "q"])
    assert read_lines_raw(spark, f"{workdir}/r").columns == ["file_path", "value"]


def test_gzip_files_number_in_one_pass(spark, workdir):
    contents = {f"f{k}.json.gz": [f"{k}-{i} https://x/{i}" for i in range(50 + 1000 * k)] for k in range(5)}
    for name, lines in contents.items():
        write_text(f"{workdir}/gzonly/{name}", lines, gz=True)
    df = read_lines(spark, f"{workdir}/gzonly")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "_lk_split" not in plan and "HashAggregate" not in plan  # no split table
    got = {(os.path.basename(r["file_path"]), r["line_no"]): r["value"] for r in df.collect()}
    want = {(name, i): v for name, lines in contents.items() for i, v in enumerate(lines)}
    assert got == want


def test_gzip_one_pass_with_crlf_and_empty_lines(spark, workdir):
    lines = ["first https://a/1", "", "third\u001cstill third", "https://b/2.csv"]
    write_text(f"{workdir}/crlfgz/a.txt.gz", lines, gz=True, eol="\r\n")
    write_text(f"{workdir}/crlfgz/b.txt.gz", lines[::-1], gz=True)
    df = read_lines(spark, f"{workdir}/crlfgz")
    assert "_lk_split" not in df._jdf.queryExecution().executedPlan().toString()
    got = sorted((os.path.basename(r["file_path"]), r["line_no"], r["value"]) for r in df.collect())
    want = sorted([("a.txt.gz", i, v) for i, v in enumerate(lines)] +
                  [("b.txt.gz", i, v) for i, v in enumerate(lines[::-1])])
    assert got == want


def test_landed_bytes_are_those_of_the_files(spark, workdir):
    """CR, NUL, invalid UTF-8, byte order marks, missing last line ends, compressed and empty files, large files in many splits."""
    import bz2
    import gzip
    import hashlib
    import random

    from linkyard.sources import land_files, landed_digests, landed_pieces, raw_manifest

    rnd = random.Random(2)
    files = {
        "a/crlf.txt": b"one\r\ntwo\r\n", "a/nul.txt": b"x\x00y\n\x00", "no end.txt": b"p\n\nq", "feeds.txt": b"\n\n\n", "bad%20.txt": b"\xff\xfe\n\x80",
        "bom.txt": b"\xef\xbb\xbffirst\nsecond\n", "bom2.txt": b"\xef\xbb\xbfno end", "empty.txt": b"", "z.json.gz": gzip.compress(rnd.randbytes(200_000)),
        "z.json.bz2": bz2.compress(rnd.randbytes(3000)), "not really.zst": rnd.randbytes(5000), "large.bin": rnd.randbytes(300_000), "deep/er/t.gz": b"\xef\xbb\xbf",
    }

    def put(content):
        for name, data in content.items():
            os.makedirs(os.path.dirname(f"{workdir}/bytes/{name}"), exist_ok=True)
            with open(f"{workdir}/bytes/{name}", "wb") as f:
                f.write(data)

    def landed():
        from urllib.parse import unquote

        return {unquote(r["source_path"].split("/bytes/")[1]): (r["n_bytes"], r["sha256"]) for r in landed_digests(spark, f"{workdir}/zone").collect()}

    def want(content):
        return {n: (len(d), hashlib.sha256(d).hexdigest()) for n, d in content.items() if d.removeprefix(b"\xef\xbb\xbf")}

    put(files)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        manifest = land_files(spark, f"{workdir}/bytes", f"{workdir}/zone")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert landed() == want(files)
    assert manifest.count() == len(files) and landed_pieces(spark, f"{workdir}/zone").count() > 1000
    assert not [d for d, _, _ in os.walk(f"{workdir}/zone/pieces") if "source_path" in d]
    # Landed again: changed files replace their old pieces, emptied ones leave none.
    files |= {"a/crlf.txt": b"", "no end.txt": b"new\n", "new.txt": b"n"}
    put(files)
    land_files(spark, f"{workdir}/bytes", f"{workdir}/zone")
    assert landed() == want(files)
    assert raw_manifest(spark, f"{workdir}/zone").count() == len(files)


def _sort_memory(plan):
    """Bytes that a run plan's sorts held at most, summed over tasks."""
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        return _sort_memory(plan.executedPlan())
    if plan.getClass().getSimpleName().endswith("QueryStageExec"):
        return _sort_memory(plan.plan())
    own = plan.metrics().apply("peakMemory").value() if plan.getClass().getSimpleName() == "SortExec" else 0
    return own + sum(_sort_memory(plan.children().apply(i)) for i in range(plan.children().size()))


def test_a_digest_sorts_less_than_its_file_holds(spark, workdir):
    """The sort once held a row with the file's path for every line, some five times the file."""
    import hashlib

    from linkyard.sources import land_files, landed_digests

    data = b"".join(b'{"url": "https://example.com/%d"},\n' % i for i in range(400_000))
    os.makedirs(f"{workdir}/one")
    with open(f"{workdir}/one/large.txt", "wb") as f:
        f.write(data)
    land_files(spark, f"{workdir}/one", f"{workdir}/onezone")
    digests = landed_digests(spark, f"{workdir}/onezone")
    (got,) = digests.collect()
    assert (got["n_bytes"], got["sha256"]) == (len(data), hashlib.sha256(data).hexdigest())
    assert 0 < _sort_memory(digests._jdf.queryExecution().executedPlan()) < 2 * len(data)


def test_digests_of_many_blocks_and_of_more_partitions_than_the_session_names(spark, workdir, monkeypatch):
    """Blocks of a few bytes, a partition per file, the manifest joined by a shuffle, and pieces met in any order."""
    import hashlib
    import random

    from pyspark.sql import functions as F

    from linkyard.sources import land_files, landed_digests, landing

    rnd = random.Random(5)
    files = {f"f{i}.bin": rnd.randbytes(40_000) + b"\n" * (i % 2) for i in range(6)} | {"bom.txt": b"\xef\xbb\xbfa\nb", "feed.txt": b"\n", "one.txt": b"x"}
    os.makedirs(f"{workdir}/many")
    for name, data in files.items():
        with open(f"{workdir}/many/{name}", "wb") as f:
            f.write(data)
    want = sorted((n, len(d), hashlib.sha256(d).hexdigest()) for n, d in files.items())
    land_files(spark, f"{workdir}/many", f"{workdir}/mzone")
    land_files(spark, f"{workdir}/many", f"{workdir}/mzone")
    monkeypatch.setattr(landing, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(landing, "DIGEST_BYTES", 5000)
    stored = landing._stored_pieces
    for rows, pieces in ((landing.SPLIT_BROADCAST_ROWS, stored), (0, stored), (0, lambda *a: stored(*a).orderBy(F.xxhash64("record")))):
        monkeypatch.setattr(landing, "SPLIT_BROADCAST_ROWS", rows)
        monkeypatch.setattr(landing, "_stored_pieces", pieces)
        digests = landed_digests(spark, f"{workdir}/mzone")
        assert sorted((r["source_path"].rsplit("/", 1)[1], r["n_bytes"], r["sha256"]) for r in digests.collect()) == want


def test_a_landing_is_seen_whole_or_not_at_all(spark, workdir, monkeypatch):
    from linkyard.sources import land_files, landed_digests, landing

    write_text(f"{workdir}/whole/a.txt", ["x"] * 50)
    land_files(spark, f"{workdir}/whole", f"{workdir}/wzone")
    before = sorted(map(str, landed_digests(spark, f"{workdir}/wzone").collect()))
    write_text(f"{workdir}/whole/a.txt", ["y"] * 70)
    pieces = landing.file_pieces
    monkeypatch.setattr(landing, "file_pieces", lambda *a: pieces(*a).limit(10))  # some pieces get lost
    with pytest.raises(RuntimeError, match="not landed whole"):
        land_files(spark, f"{workdir}/whole", f"{workdir}/wzone")
    assert sorted(map(str, landed_digests(spark, f"{workdir}/wzone").collect())) == before
    with pytest.raises(ValueError):
        land_files(spark, f"{workdir}/whole", f"{workdir}/wzone", mode="other")


def test_first_keys_list_no_folder_behind_them(spark, workdir, monkeypatch):
    from linkyard.sources import inventory

    names = ["a.txt", "a/x.txt", "a/y/_z", "a0.txt", "b/c/d/e.txt", "b/c/f.txt", "b.txt", "é/u.txt", "z/last.txt"]
    for name in names:
        os.makedirs(os.path.dirname(f"{workdir}/keys/{name}"), exist_ok=True)
        open(f"{workdir}/keys/{name}", "w").close()
    listed = []
    entries = inventory._entries
    monkeypatch.setattr(inventory, "_entries", lambda fs, folder: listed.append(folder.getName()) or entries(fs, folder))
    ordered = sorted(names, key=str.encode)
    for n in range(1, len(names) + 2):
        listed.clear()
        got = [r["path"].split("/keys/")[1] for r in file_inventory(spark, f"{workdir}/keys", n).collect()]
        assert got == ordered[:n]
        if n <= 3:
            assert set(listed) <= {"keys", "a", "y"}
    assert file_inventory(spark, f"{workdir}/none", 3).count() == 0
