from __future__ import annotations

import zlib
from hashlib import sha256

import duckdb
import pytest
from pyspark.sql import functions as F

from linkyard.llm.merkle import FIELDS, MANIFEST_SQL, PersistentBlock, digest, fold, manifest, manifest_report, with_tampered


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(nodes):
    """All levels of a tree, leaves first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([H(*row[i: i + 3]) for i in range(0, len(row), 3)])
    return levels


def brute(rows):
    """Rows of (doc_id, source, lang, n_chars, text) to sorted result rows, by rebuilding whole trees."""
    by_source = {}
    for r in rows:
        hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
        cut = r[4].replace("\n", "") if hit and r[4] is not None else r[4]
        by_source.setdefault(r[1], []).append((r[0], leaf_of(r), leaf_of((*r[:4], cut))))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    for v in by_source.values():
        v.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
    trees = {s: tree([x[1] for x in by_source[s]]) for s in names}
    top = tree([trees[s][-1][0] for s in names]) if names else [[None]]
    out = []
    for k, s in enumerate(names):
        for pos, (doc, leaf, shown) in enumerate(by_source[s]):
            siblings, at = [], pos
            for level in trees[s][:-1]:
                run = range(at // 3 * 3, min(at // 3 * 3 + 3, len(level)))
                siblings += [level[i] for i in run if i != at]
                at //= 3
            at = k
            for level in top[:-1]:
                run = range(at // 3 * 3, min(at // 3 * 3 + 3, len(level)))
                siblings += [level[i] for i in run if i != at]
                at //= 3
            # The changed tree, built as a whole.
            changed = [x[1] for x in by_source[s]]
            changed[pos] = shown
            subs = [trees[n][-1][0] for n in names]
            subs[k] = tree(changed)[-1][0]
            folded, root = tree(subs)[-1][0], top[-1][0]
            out.append((doc, s, leaf, trees[s][-1][0], root, H(*siblings), folded, folded == root))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "source", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def got(df):
    return sorted([tuple(r) for r in df.select(*COLUMNS).collect()], key=str)


def test_persistent_block_shares_all_but_ancestors():
    leaves = [digest(str(i).encode()) for i in range(30)]
    block = PersistentBlock(leaves)
    before, made = block.digests[block.root], len(block.digests)
    new = block.version(17, digest(b"x"))
    assert len(block.digests) - made == block.height + 1  # the leaf and its ancestors
    changed = list(leaves)
    changed[17] = digest(b"x")
    assert block.digests[new] == PersistentBlock(changed).digests[-1] == fold(digest(b"x"), block.siblings(17))
    assert block.digests[block.root] == before  # the old version is still whole
    assert fold(leaves[29], block.siblings(29)) == before
    block.forget(made)
    assert len(block.digests) == made


def test_lone_and_short_runs():
    assert PersistentBlock([digest(b"a")]).height == 0
    one = PersistentBlock([digest(b"a")], levels=2)
    assert one.digests[one.root] == digest(digest(digest(b"a")))


@pytest.mark.parametrize("levels,range_bytes", [(7, 16e6), (1, 600.0), (2, 2000.0)])
def test_odd_rows_against_whole_trees(spark, odd_docs, odd_rows, levels, range_bytes):
    """Nulls, repeats, clashing columns; small blocks and ranges make several layers."""
    extra = [(100 + i, f"t{i}\nu", "en", "hot", i) for i in range(40)] + [(7, "same\n", "en", "hot", 5)] * 9
    docs = odd_docs.select(*FIELDS, "fp", "u", "key", "bucket").unionByName(
        spark.createDataFrame(extra, "doc_id long, text string, lang string, source string, n_chars long"), allowMissingColumns=True)
    docs = docs.withColumns({"tree": F.lit("t"), "pos": F.lit(3), "block": F.lit(1), "rng": F.lit(2), "node": F.lit("n")})
    rows = [(r[0], r[3], r[2], 0, r[1]) for r in odd_rows] + [(r[0], r[3], r[2], r[4], r[1]) for r in extra]
    assert got(manifest(with_tampered(docs), levels=levels, range_bytes=range_bytes)) == brute(rows)


def test_one_row_and_empty(spark, no_docs):
    assert manifest_report(no_docs).count() == 0
    one = spark.createDataFrame([(4, "a\nb", None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    rows = got(manifest_report(one))
    assert rows == brute([(4, None, None, None, "a\nb")])
    assert rows[0][5] == sha256(b"").hexdigest()


def test_whole_table_against_sql(spark):
    path = "/root/testdata/sf0.001/documents.parquet"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}'")
    want = con.execute(MANIFEST_SQL)
    names = [d[0] for d in want.description]
    rows = sorted(map(str, want.fetchall()))
    assert rows == sorted(str(tuple(r)) for r in manifest_report(spark.read.parquet(path)).select(*names).collect())
    assert any("False" in r for r in rows) and any("True" in r for r in rows)
