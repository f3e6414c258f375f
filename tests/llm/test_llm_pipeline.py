"""The pipeline's stages, each against its operator's result by plain Python."""

import brute
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_llm_operators import check_packing, labelled

import __spark_entry__ as contract
import corpus_pipeline


@pytest.fixture(scope="module")
def stages(spark, small_dir, tmp_path_factory):
    """What each stage read and returned."""
    root = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, small_dir).write.parquet(str(root / str(k)))
        docs = spark.read.parquet(str(root / str(k)))
        out.append(docs)
    return out


def pairs(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def test_stage_names():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules",
        "SimHash near-dedup",
        "substring dedup",
        "benchmark decontamination",
        "packing",
    ]
    assert contract.queries()["pipeline"] is corpus_pipeline.run


def test_all_but_the_last_return_documents(stages):
    assert all(df.dtypes == stages[0].dtypes for df in stages[:-1])


def test_quality_stage(stages):
    failed = {e[0] for e in brute.counts(pairs(stages[0])) if e[-1]}
    # Too few labels for cutoffs here, also in the pool, so only the base rules reject.
    assert {i for i, _ in pairs(stages[1])} == {i for i, _ in pairs(stages[0])} - failed


def test_quality_stage_with_enough_labels(spark, tmp_path):
    docs, labels = labelled(spark, 400)  # 300 of them good
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    kept = {r.doc_id for r in corpus_pipeline.quality_rules(spark, docs, str(tmp_path)).collect()}
    assert not kept & set(range(0, 400, 4))
    assert len(kept) >= 0.98 * 300


def test_near_duplicate_stage(stages):
    _, groups = brute.near(pairs(stages[1]))
    kept = pairs(stages[2])
    assert sorted((i for i, _ in kept), key=repr) == groups
    assert set(kept) <= set(pairs(stages[1]))


def test_substring_stage(stages):
    words = F.trim(F.regexp_replace("text", "[ \\x09-\\x0D]+", " "))
    digests = {r[0]: r[1] for r in stages[3].select("doc_id", F.sha2(words, 256)).collect()}
    assert digests == {e[0]: e[3] for e in brute.substring(pairs(stages[2]))}
    assert stages[3].filter("n_chars <> length(text)").count() == 0


def test_decontamination_stage(spark, small_dir, stages):
    items = spark.read.parquet(f"{small_dir}/benchmark.parquet").select("item_id", "text")
    found = brute.leaks(pairs(stages[3]), [tuple(r) for r in items.collect()])
    clean = {e[0] for e in found if not e[-1]}
    assert sorted(pairs(stages[4])) == sorted(d for d in pairs(stages[3]) if d[0] in clean)


def test_packing_stage(stages):
    assert public_tokenizers.path("byte_bpe_50k.json")
    check_packing(stages[5].collect(), pairs(stages[4]))


def test_run_applies_all_stages(spark, small_dir, stages):
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    found = corpus_pipeline.run(spark, small_dir).select(columns)
    assert sorted(map(tuple, found.collect())) == sorted(
        map(tuple, stages[-1].select(columns).collect())
    )


def test_stages_on_odd_documents(spark, small_dir, odd_table, tmp_path):
    """Nulls, empty and long texts, ties, repeated rows and columns of clashing names."""
    items = [tuple(r) for r in spark.read.parquet(f"{small_dir}/benchmark.parquet").select("item_id", "text").collect()]
    found = [odd_table]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, found[-1], small_dir).write.parquet(str(tmp_path / str(k)))
        found.append(spark.read.parquet(str(tmp_path / str(k))))
    assert all(df.dtypes == odd_table.dtypes for df in found[:-1])
    quality, near, substring, clean = ([(r.doc_id, r.text) for r in df.collect()] for df in found[1:5])
    odd = pairs(odd_table)
    kept = [d for d in odd if not brute.counts([d])[0][-1]]
    assert sorted(quality, key=repr) == sorted(kept, key=repr)
    assert sorted((i for i, _ in near), key=repr) == brute.near(quality)[1]
    assert sorted(t[0] for t in brute.substring(near) if t[0]) == sorted(i for i, _ in substring if i)
    leaked = {e[0] for e in brute.leaks(substring, items) if e[-1]}
    assert sorted(clean, key=repr) == sorted((d for d in substring if d[0] not in leaked), key=repr)
    check_packing(found[5].collect(), clean)


@pytest.mark.parametrize("number", range(5))
def test_stages_by_themselves_on_odd_and_empty_documents(spark, small_dir, odd_table, empty_table, number):
    """A stage that another order would give nulls and empty texts; and one that gets nothing."""
    _, stage = corpus_pipeline.STAGES[number]
    out = stage(spark, odd_table, small_dir)
    assert out.count() > 0 and (number == 4 or out.dtypes == odd_table.dtypes)
    assert stage(spark, empty_table, small_dir).count() == 0
