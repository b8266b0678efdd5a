"""Each stage against a plain version of its decision, on a table with the hard cases."""

from __future__ import annotations

import collections
import zlib

import numpy as np
import pytest

import corpus_pipeline as pipeline
from tests.llm import data
from tests.llm.test_operators import LOWER, SEVEN, _components, _counts, _fingerprint, words

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, _text string, fp long, kept int"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("sf"))
    rows = [(i, t, "en", s, len(t or ""), "clash", 1, 0) for i, t, s, *_ in data.rows()]
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(
        f"{root}/labels.parquet")
    some = SEVEN.findall(next(t for i, t, *_ in data.rows() if i == 65).translate(LOWER))
    spark.createDataFrame([(1, " ".join(some[10:40])), (2, None)], "item_id long, text string").write.parquet(
        f"{root}/benchmark.parquet")
    return root


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_stages(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    kept = pipeline.quality_stage(spark, docs, tables)
    assert kept.columns == docs.columns
    assert _rows(kept) == [r for r in _rows(docs) if not (
        (c := _counts(r[1]))[0] < 20 or 100 * c[4] > 30 * c[0])]

    one = pipeline.simhash_stage(spark, kept, tables)
    of = _components([_fingerprint(r[1]) for r in _rows(kept)], 4)
    groups = collections.defaultdict(list)
    for r in _rows(kept):
        groups[of[_fingerprint(r[1])]].append(r)
    left = collections.Counter(of[_fingerprint(r[1])] for r in _rows(one))
    assert set(left.values()) == {1} and set(left) == set(groups)
    for r in _rows(one):
        ids = [x[0] for x in groups[of[_fingerprint(r[1])]] if x[0] is not None]
        assert r in groups[of[_fingerprint(r[1])]] and (not ids or r[0] == min(ids))

    clean = pipeline.decontamination_stage(spark, one, tables)
    assert clean.columns == docs.columns
    before, after = {r[0]: r for r in _rows(one)}, {r[0]: r for r in _rows(clean)}
    bench = [r.text for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect() if r.text]
    windows = {tuple(w[k:k + 10]) for t in bench for w in [SEVEN.findall(t)] for k in range(len(w) - 9)}
    changed = 0
    for i, r in after.items():
        w = SEVEN.findall((r[1] or "").translate(LOWER))
        assert not any(tuple(w[k:k + 10]) in windows for k in range(len(w) - 9))
        changed += r != before[i]
        assert r == before[i] or r[4] == len(r[1]) < len(before[i][1])
    assert changed >= 1

    mixed = pipeline.mixing_stage(spark, clean, tables)
    assert mixed.columns == docs.columns and set(_rows(mixed)) <= set(_rows(clean))
    assert max(collections.Counter(_rows(mixed)).values()) <= 2
    total = sum(len(words(r[1])) for r in _rows(clean))
    assert abs(sum(len(words(r[1])) for r in _rows(mixed)) - 1.5 * total) < 0.5 * total

    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = pipeline.token_stage(spark, mixed, tables)
    want = sorted(zlib.crc32(np.array(plain.encode(r[1] or "", add_special_tokens=False).ids + [2], "<u4").tobytes())
                  for r in _rows(mixed))
    assert sorted(r.ids_crc32 for r in out.collect()) == want


def test_run_is_all_stages_and_takes_empty_tables(spark, tables, tmp_path):
    assert pipeline.run(spark, tables).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert [k for k, _ in pipeline.STAGES] == ["quality", "simhash", "decontamination", "mixing", "tokens"]
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{tables}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0
