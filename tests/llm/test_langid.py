"""Language codes: codewords, held-out accuracy, odd rows."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pytest

from linkyard.llm.langid import block_vectors, codewords, decode_codes, identify, language_report

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("n", [2, 3, 4, 7, 12])
def test_codewords_differ_and_no_bit_is_constant(n):
    code = codewords(n)
    assert (np.abs(code.sum(axis=0)) < n).all()
    least = min((code[i] != code[j]).sum() for i, j in combinations(range(n), 2))
    assert least >= (2 ** (n - 2) if n <= 7 else 5)


def test_one_wrong_bit_is_corrected():
    code = codewords(4)
    weights = np.ones_like(code)
    for i in range(4):
        for bit in range(code.shape[1]):
            f = code[i].copy() * 3
            f[bit] *= -1
            assert decode_codes(f[None], code, weights).argmin() == i


def test_vectors_equal_brute_force_counts():
    texts = [b"abc abd", "été".encode(), b"", b"x"]
    part, off = np.frombuffer(b"".join(texts), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    x = block_vectors(part, off)
    for i, t in enumerate(texts):
        alone = block_vectors(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0]
        assert np.allclose(x[i], alone)
        grams = sum(max(0, len(t) - k + 1) for k in (1, 2, 3, 4))
        assert abs((x[i] ** 2).sum() - (grams > 0)) < 1e-4


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language_report(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 200 and np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_odd_rows(odd_docs, odd_rows, no_docs):
    got = language_report(odd_docs).collect()
    assert len(got) == len(odd_rows)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], set()).add((r["lang_pred"], r["score"]))
    assert by[1] == by[2] == by[3] == by[11] == {("und", 0.0)}
    assert len(by[5]) == 1 and by[5].pop()[0] in {"en", "fr", "de", "es"}
    assert language_report(no_docs).count() == 0
    assert {r["lang_pred"] for r in identify(odd_docs, no_docs).collect()} == {"und"}


def test_predictions_against_plain_decoding(spark):
    """Every prediction is the language whose codeword has the least weighted logistic loss, found by plain loops."""
    import math

    import numpy as np
    import pyarrow as pa

    from linkyard.llm.langid import block_vectors, fit_codes, identify, labelled_vectors
    from linkyard.llm.textual import text_bytes

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    langs, x, y = labelled_vectors(docs, 3000)
    code, w, b, weights = fit_codes(x, y, len(langs))
    got = {r["doc_id"]: r for r in identify(docs, docs).collect()}
    for r in docs.select("doc_id", "text").collect():
        if not any(c.isalpha() for c in r["text"] or ""):
            assert got[r["doc_id"]]["lang_pred"] == "und"
            continue
        margins = (block_vectors(*text_bytes(pa.array([r["text"]]))) @ w + b)[0]
        losses = [sum(weights[k][j] * math.log1p(math.exp(-float(margins[j]) * code[k][j])) for j in range(code.shape[1])) * code.shape[1]
                  for k in range(len(langs))]
        best = int(np.argmin(losses))
        assert got[r["doc_id"]]["lang_pred"] == langs[best]
        assert abs(got[r["doc_id"]]["score"] - 1 / sum(math.exp(losses[best] - v) for v in losses)) < 1e-3
