"""The five stages, each held against a brute-force version of what it must do to its own input."""

from __future__ import annotations

from collections import Counter

import duckdb
import pandas as pd
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from linkyard.llm.mixing import MIX_SQL
from linkyard.llm.ship import stored
from linkyard.llm.token_output import in_stored_order

from .test_decontaminate import brute as brute_windows, words
from .test_simhash import brute_components, brute_fp

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [("input", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), f"test-{name}")
        out.append((name, docs))
    return {k: v for k, v in out}


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_stages_and_columns(results):
    assert list(results) == ["input", "toxicity", "simhash", "decontaminate", "mix", "tokens"]
    for name in ("toxicity", "simhash", "decontaminate", "mix"):
        assert results[name].columns == results["input"].columns


def test_toxicity_keeps_clean_rows_as_they_are(spark, results):
    before, after = {r["doc_id"]: r for r in rows(results["input"])}, {r["doc_id"]: r for r in rows(results["toxicity"])}
    assert all(before[k] == r for k, r in after.items())
    labels = {r["doc_id"]: r["toxic"] for r in rows(spark.read.parquet(f"{SF}/labels.parquet"))}
    assert not [k for k in set(before) - set(after) if labels.get(k) == 0]


def test_simhash_keeps_one_of_each_group(results):
    before = sorted(rows(results["toxicity"]), key=lambda r: r["doc_id"])
    first = set(brute_components([brute_fp(r["text"]) for r in before]))
    assert sorted(rows(results["simhash"]), key=lambda r: r["doc_id"]) == [before[i] for i in sorted(first)]


def test_decontamination_leaves_no_window(spark, results):
    items = [(r["item_id"], r["text"]) for r in rows(spark.read.parquet(f"{SF}/benchmark.parquet"))]
    before = rows(results["simhash"])
    hit = {x[0]: x for x in brute_windows([(r["doc_id"], r["text"]) for r in before], items)}
    after = {r["doc_id"]: r for r in rows(results["decontaminate"])}
    for r in before:
        _, n, n_hit, _, _, bad = hit[r["doc_id"]]
        if not bad:
            assert after[r["doc_id"]] == r
        elif n_hit <= 0.8 * n:
            assert len(words(after[r["doc_id"]]["text"])) == n - n_hit
    assert not any(x[5] for x in brute_windows([(k, r["text"]) for k, r in after.items()], items))


def test_mix_reads_each_row_as_often_as_sql_says(results):
    before = rows(results["decontaminate"])
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(before)[["doc_id", "text", "source"]])
    takes = {k: (t // s if s else 0) for k, s, t in con.execute(f"SELECT doc_id, size, taken FROM ({MIX_SQL})").fetchall()}
    got = Counter(r["doc_id"] for r in rows(results["mix"]))
    assert got == Counter({k: int(n) for k, n in takes.items() if n})
    by = {r["doc_id"]: r for r in before}
    assert all(r == by[r["doc_id"]] for r in rows(results["mix"]))


def test_mix_is_stored_in_training_order(results):
    """Times worked out from the targets, by plain arithmetic, ascend over the stored rows."""
    before = rows(results["decontaminate"])
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(before)[["doc_id", "text", "source"]])
    first = dict(con.execute(f"SELECT doc_id, first_position FROM ({MIX_SQL})").fetchall())
    stored_rows = [r["doc_id"] for r in sorted(rows(in_stored_order(results["mix"])), key=lambda r: r["position"])]
    met = {}
    for i, k in enumerate(stored_rows):
        met.setdefault(k, i)
    assert met == {k: v for k, v in first.items() if v is not None}


def test_tokens_lie_in_training_order(spark, results):
    """Shards hold the readings of the mix one after the other, repeats at their own places."""
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want, start = [], 0
    order = sorted(rows(in_stored_order(results["mix"])), key=lambda r: r["position"])
    assert [r["position"] for r in order] == list(range(len(order)))
    for r in order:
        n = len(tok.encode(r["text"], add_special_tokens=False).ids) + 1
        want.append((r["doc_id"], start, n, r["position"]))
        start += n
    got = rows(results["tokens"])
    assert sorted(((r["doc_id"], r["start"], r["n_tokens"], r["position"]) for r in got), key=lambda r: r[3]) == want
    assert len({r["doc_id"] for r in got}) < len(got)  # some are read more than once
    assert corpus_pipeline.run(spark, SF).count() == len(want) and corpus_pipeline.ORACLE_SQL is None


def test_stages_take_odd_and_empty_tables(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "start", "n_tokens", "ids_crc32", "position"]
        assert docs.count() == 0 or docs.where("n_tokens > 0").count() == docs.count()
