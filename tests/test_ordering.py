"""Encounter order: prefix sums, global index, batches, samples, caps."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from linkyard.operators import (
    assign_batches, batch_counts, cap_records, classified_refs, exclusive_prefix_sum, extract_refs,
    first_refs, first_refs_of_lines, indexed_refs, sample_urls, with_ordinal,
)

from .fixtures import scan_refs, x1_lines


def _lines_df(spark, lines, keys=None):
    keys = keys or list(range(len(lines)))
    return spark.createDataFrame(list(zip(keys, lines)), "line_no long, value string")


def test_exclusive_prefix_sum_brute_force(spark):
    rnd = random.Random(7)
    rows = [(f"f{rnd.randint(0, 3)}", k, rnd.randint(0, 9)) for k in rnd.sample(range(-5000, 50000), 3000)]
    df = spark.createDataFrame(rows, "g string, k long, w long")
    got = {(r["g"], r["k"]): r["s"] for r in exclusive_prefix_sum(df, ["g", "k"], "w", "s").collect()}
    run, want = 0, {}
    for g, k, w in sorted(rows):
        want[(g, k)] = run
        run += w
    assert got == want
    # Tiny buckets (width 1) and huge ones give the same answer.
    tiny = exclusive_prefix_sum(df, ["g", "k"], "w", "s", width=1, low=-5000)
    assert {(r["g"], r["k"]): r["s"] for r in tiny.collect()} == want
    # Several real levels: buckets of 7 keys, 4 buckets per upper bucket.
    deep = exclusive_prefix_sum(df, ["g", "k"], "w", "s", width=7, low=-5000, levels=3, fanout=4)
    assert {(r["g"], r["k"]): r["s"] for r in deep.collect()} == want
    flat = exclusive_prefix_sum(df.select("k", "w"), ["k"], "w", "s", width=5, low=-5000, levels=2, fanout=3)
    # Ranges of the group column: bounds need not be groups themselves.
    ranged = exclusive_prefix_sum(df, ["g", "k"], "w", "s", width=7, low=-5000, levels=1, fanout=4, bounds=["f1", "f1x", "f3", "zz"])
    assert {(r["g"], r["k"]): r["s"] for r in ranged.collect()} == want
    run, want_flat = 0, {}
    for k, wt in sorted((k, wt) for _, k, wt in rows):
        want_flat[k] = run
        run += wt
    assert {r["k"]: r["s"] for r in flat.collect()} == want_flat


def test_ordinal_is_dense_rank(spark):
    df = spark.range(0, 100_000, 13).select((F.col("id") * 3).alias("k"))
    got = [r["o"] for r in with_ordinal(df, ["k"], "o").orderBy("k").collect()]
    assert got == list(range(len(got)))


def test_x1_batches_at_three_sizes(spark):
    lines = _lines_df(spark, x1_lines())
    for size, sizes in ((10_000, [200]), (100, [100, 100]), (64, [64, 64, 64, 8])):
        b = assign_batches(lines, size)
        got = [r["count"] for r in b.groupBy("batch_no").count().orderBy("batch_no").collect()]
        assert got == sizes
        closed = [r["n_refs"] for r in batch_counts(classified_refs(lines), size).orderBy("batch_no").collect()]
        assert closed == sizes


def test_index_follows_encounter_order(spark):
    rnd = random.Random(3)
    texts = [" ".join(rnd.choice(["https://a/1", '{"url": "https://b/2.gz"}', "zz", ""]) for _ in range(4))
             for _ in range(400)]
    keys = sorted(rnd.sample(range(10**9), 400))
    lines = _lines_df(spark, texts, keys)
    got = sorted((r["ref_index"], r["line_no"], r["pos"], r["file_url"]) for r in indexed_refs(lines).collect())
    want = [(k, p, u) for k, t in zip(keys, texts) for p, u in enumerate(scan_refs(t))]
    assert [g[1:] for g in got] == want
    assert [g[0] for g in got] == list(range(len(want)))


def test_batch_counts_empty(spark):
    empty = _lines_df(spark, ["no links here"])
    assert batch_counts(classified_refs(empty), 10).count() == 0


def test_sample_20_of_x1(spark):
    lines = _lines_df(spark, x1_lines())
    s = sample_urls(classified_refs(lines), 20).orderBy("sample_rank").collect()
    assert [r["sample_rank"] for r in s] == list(range(1, 21))
    names = [r["file_url"].rsplit("/", 1)[1].split(".")[0] for r in s]
    assert names == [f"file{i}" for i in range(10) for _ in range(2)]
    assert s[-1]["file_url"] == "https://example.com/in-network/file9.json.gz"


def test_caps_small_large_and_zero(spark):
    lines = _lines_df(spark, [f'{{"url": "https://e/{i}.csv"}} https://x/{i}' for i in range(8000)])
    order = [(i, p) for i in range(8000) for p in range(3)]
    assert cap_records(lines, 0).count() == 24000
    small = sorted((r["line_no"], r["pos"]) for r in cap_records(lines, 500).collect())
    assert small == order[:500]
    large = sorted((r["line_no"], r["pos"]) for r in cap_records(lines, 15_001).collect())
    assert large == order[:15_001]


def test_first_refs_of_lines_reads_on_until_there_are_enough(spark):
    # The first 300 lines hold the marker but no reference.
    lines = _lines_df(spark, ["http nothing"] * 300 + [f"https://a/{i} https://b/{i}" for i in range(50)])
    got = [(r["sample_rank"], r["line_no"], r["pos"]) for r in first_refs_of_lines(lines, 7).orderBy("sample_rank").collect()]
    assert got == [(i + 1, 300 + i // 2, i % 2) for i in range(7)]
    assert first_refs_of_lines(lines, 1000).count() == 100


def test_ordered_operators_need_line_numbers(spark):
    import pytest

    raw = spark.createDataFrame([("f", "https://a")], "file_path string, value string")
    for call in (lambda: indexed_refs(raw), lambda: first_refs(extract_refs(raw), 5), lambda: cap_records(raw, 3),
                 lambda: first_refs_of_lines(raw, 3)):
        with pytest.raises(ValueError):
            call()


def test_batch_counts_beyond_an_array(spark):
    refs = spark.range(2**31 + 10).select(F.col("id"))
    b = batch_counts(refs, 1)
    row = b.agg(F.count(F.lit(1)).alias("n"), F.max("batch_no").alias("last"), F.sum("n_refs").alias("refs")).first()
    assert (row["n"], row["last"], row["refs"]) == (2**31 + 10,) * 3


def test_hot_file_and_hot_line(spark, workdir):
    """One file holds a third of all lines; one line holds a third of all refs."""
    from linkyard.sources import read_lines

    from .fixtures import write_text

    hot_line = " ".join(f"https://hot/{i}" for i in range(40_000))  # a third of all refs
    big = [f'{{"url": "https://b/{i}.json"}}' for i in range(19_999)] + [hot_line]
    files = {"big.txt": big}
    for k in range(40):
        files[f"small{k:02d}.txt"] = [f"https://s{k}/{i} x" for i in range(1000)]
    for name, content in files.items():
        write_text(f"{workdir}/hot/{name}", content)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128k")
    try:
        got = sorted((r["file_path"].rsplit("/", 1)[1], r["line_no"], r["pos"], r["ref_index"], r["batch_no"])
                     for r in assign_batches(read_lines(spark, f"{workdir}/hot"), 777).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want, idx = [], 0
    for name in sorted(files):  # encounter order: file path, then line, then position
        for n, text in enumerate(files[name]):
            for p, _ in enumerate(scan_refs(text)):
                want.append((name, n, p, idx, idx // 777 + 1))
                idx += 1
    assert got == sorted(want)


def test_cap_is_a_filter_on_the_index_at_any_size(spark):
    lines = _lines_df(spark, [f"https://a/{i} https://b/{i}" for i in range(3000)])
    for n in (1, 100, 5999, 10**6):
        capped = cap_records(lines, n)
        assert "TakeOrderedAndProject" not in capped._jdf.queryExecution().executedPlan().toString()
        got = sorted((r["line_no"], r["pos"]) for r in capped.collect())
        assert got == [(i, p) for i in range(3000) for p in range(2)][:n]


def test_prefix_sum_over_very_sparse_keys(spark):
    rnd = random.Random(5)
    keys = sorted({rnd.randrange(-(2**62), 2**62) for _ in range(2000)})
    rows = [(k, rnd.randint(0, 5)) for k in keys]
    df = spark.createDataFrame(rows, "k long, w long")
    got = {r["k"]: r["s"] for r in exclusive_prefix_sum(df, ["k"], "w", "s").collect()}
    run, want = 0, {}
    for k, w in rows:
        want[k] = run
        run += w
    assert got == want


def test_many_files_are_summed_by_ranges_of_paths(spark, workdir, monkeypatch):
    import linkyard.operators.ordering as ordering
    from linkyard.sources import read_lines

    from .fixtures import write_text

    rnd = random.Random(11)
    files = {f"d{k % 3}/f{k:02d}.txt": [" ".join(f"https://{k}/{i}-{j}" for j in range(rnd.randint(0, 4))) for i in range(rnd.randint(0, 30))]
             for k in range(24)}
    for name, content in files.items():
        write_text(f"{workdir}/many/{name}", content)
    monkeypatch.setattr(ordering._path_bounds, "__defaults__", (4, 5))
    lines = read_lines(spark, f"{workdir}/many", recursive=True)
    assert len(ordering._path_bounds(lines)) == 4
    got = sorted((r["ref_index"], r["file_url"]) for r in indexed_refs(lines).collect())
    want = [u for name in sorted(files) for text in files[name] for u in scan_refs(text)]
    assert got == list(enumerate(want))
