"""The pipeline's stages after its classifiers, against plain Python; the classifiers by what they keep."""

import corpus_pipeline as pipeline
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from test_decontaminate import brute as brute_hits
from test_minhash import brute as brute_groups

from hubbub.llm.bpe import read_ranks

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    root = tmp_path_factory.mktemp("stages")
    for name, stage in pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(root / name))
        docs = spark.read.parquet(str(root / name))
        out.append(docs)
    return out


def test_order_and_columns(spark, stages):
    assert [n for n, _ in pipeline.STAGES] == ["quality", "toxicity", "near_dedup", "decontamination", "byte_level_bpe"]
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    assert all(df.columns == columns for df in stages[:-1])


def test_classifiers_keep_clean_documents(spark, stages):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").join(docs.select("doc_id"), "doc_id")
    good = labels.where("quality = 1")
    kept = good.join(stages[0], "doc_id", "left_semi")
    assert kept.count() >= 0.95 * good.count()
    clean = labels.where("toxic = 0").join(stages[0], "doc_id", "left_semi")
    assert clean.join(stages[1], "doc_id", "left_semi").count() >= 0.9 * clean.count()


def test_one_of_each_group_stays(stages):
    rows = [(r.doc_id, r.text) for r in stages[1].collect()]
    assert {r.doc_id for r in stages[2].collect()} == {k for k, _, _, kept in brute_groups(rows) if kept}


def test_passages_go(spark, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    before = {r.doc_id: r.text for r in stages[2].collect()}
    after = {r.doc_id: r for r in stages[3].collect()}
    for key, n_words, n_hit, *_ in brute_hits(list(before.items()), items):
        if n_hit == 0:
            assert after[key].text == before[key]
        elif 2 * n_hit >= n_words:
            assert key not in after
        else:
            assert len(after[key].text) < len(before[key]) and after[key].n_chars == len(after[key].text)


def test_ids_are_the_librarys(stages):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        exact = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(f.read()), special_tokens={})
    text = {r.doc_id: r.text for r in stages[3].collect()}
    found = stages[4].collect()
    assert len(found) == len(text)
    for r in found:
        assert r.ids == exact.encode_ordinary(text[r.doc_id]) and r.n_tokens == len(r.ids) and r.intact


def test_odd_rows_pass_all_stages(spark, odd, none):
    docs = odd.withColumns({"lang": F.lit(None).cast("string"), "source": F.lit("s"), "n_chars": F.length("text")})
    for name, stage in pipeline.STAGES:
        docs = stage(spark, docs, SF)
        empty = stage(spark, none, SF)
        assert empty.count() == 0, name
    assert {r.doc_id for r in docs.collect()} >= {None, 1, 4, 6}


def test_an_id_with_several_texts(spark):
    """(1, a), (2, a), (2, c): the copy goes and c stays; equal sets of one id stay once; rows repeat."""
    a, c, d = "one two three four five six", "other words stand in this text", "ONE TWO three four five six"
    rows = [(1, a), (2, a), (2, c), (2, c), (1, d), (3, None), (3, ""), (4, c), (None, a), (5, "five")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    found = sorted(((r.doc_id, (r.text or "").lower()) for r in pipeline.drop_near_copies(spark, docs, SF).collect()), key=repr)
    assert found == sorted([(1, a), (2, c), (3, ""), (5, "five"), (None, a)], key=repr)
