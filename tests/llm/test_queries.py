from __future__ import annotations

import hashlib

import pytest
from oracle import compare, connect

from tapebook.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, name):
    assert compare(spark, connect(SF), QUERIES[name], ORACLES[name], SF) is None


def test_bpe_equals_the_library(spark):
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op3_bpe_round_trip"](spark, SF).collect()
    assert len(rows) == len(texts)
    lengths = []
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        lengths.append(len(ids))
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
    counted = QUERIES["op1_token_counts"](spark, SF).collect()
    assert {r.n_tokens: r.n_docs for r in counted} == {n: lengths.count(n) for n in lengths}
    assert all(r.truncated_total == sum(min(n, r.n_tokens) for n in lengths) for r in counted)
