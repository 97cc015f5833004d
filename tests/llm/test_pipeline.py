"""The pipeline's stages against plain versions, each on its own input."""

import re
import zlib

import numpy as np
import pytest

pytest.importorskip("pixelweave.llm")
corpus_pipeline = pytest.importorskip("corpus_pipeline")
import public_tokenizers
from tokenizers import Tokenizer

from .test_brute_force import plain_components, plain_spans

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    from pixelweave.llm.common import written

    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, f in corpus_pipeline.STAGES:
        docs = written(f(spark, docs, SF), name)
        out.append(docs)
    return out


def rows(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_columns_and_shrinking(spark, stages):
    own = spark.read.parquet(f"{SF}/documents.parquet")
    assert all(s.columns == own.columns for s in stages[:-1])
    assert own.count() > stages[0].count() > stages[1].count() == stages[2].count() == stages[3].count() > 0


def test_one_of_each_group_stays(stages):
    before, after = rows(stages[0]), rows(stages[1])
    found = plain_components(list(before.items()))
    assert set(after) == {c for _, c in found.values()} and all(after[k] == before[k] for k in after)


def test_no_long_passage_twice(stages):
    """Chunk ends are found by chance, so a passage of just 50 words may escape once in some hundreds, of 60 hardly ever."""
    seen = {}
    for k, t in rows(stages[2]).items():
        w = t.split()
        for i in range(len(w) - 59):
            seen.setdefault(tuple(w[i : i + 60]), set()).add(k)
    assert not [v for v in seen.values() if len(v) > 1]
    before = rows(stages[1])
    for k, t in rows(stages[2]).items():
        it = iter(before[k])
        assert all(c in it for c in t)  # text only goes


def test_personal_data_is_masked(stages):
    before = rows(stages[2])
    for k, t in rows(stages[3]).items():
        want, have = plain_spans(before[k]), plain_spans(t)
        assert not have["email"] and not have["card"]
        if not any(want.values()):
            assert t == before[k] or "[IBAN]" in t or "[SSN]" in t
        else:
            assert re.search(r"\[(EMAIL|IP|CARD|PHONE)\]", t)


def test_packed_ids(stages):
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {k: np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for k, t in rows(stages[3]).items()}
    got = stages[4].collect()
    assert sum(r.length for r in got) == sum(map(len, ids.values()))
    assert all(r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) for r in got)


def test_run_gives_the_same(spark, stages):
    total = lambda got: {k: sum(r.length for r in got if r.doc_id == k) for k in {r.doc_id for r in got}}
    assert total(corpus_pipeline.run(spark, SF).collect()) == total(stages[4].collect())
