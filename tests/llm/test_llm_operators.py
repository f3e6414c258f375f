"""Every operator on a table of odd documents, on an empty one, and on the given small tables."""

import base64
import gzip
import hashlib
import os
import random
import re
import zlib
from collections import Counter as Bag

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from brute import CLASHING, rows_of
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

from ladderlake.llm import chat, decontaminate, packing, quality, sharding, simhash
from ladderlake.llm import substring, suffix, token_counts, warc
from ladderlake.llm.queries import REGISTRY
from ladderlake.session import staging_path

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def untouched(df, odd_table):
    """The columns that came in still hold what they held."""
    own = [c for c in odd_table.columns if c != "text"]
    assert rows_of(df.select(own)) == rows_of(odd_table.select(own))


# --- sharding ----------------------------------------------------------------


def gapless(rows):
    by_shard = {}
    for shard, slot in rows:
        by_shard.setdefault(shard, []).append(slot)
    return all(sorted(s) == list(range(len(s))) for s in by_shard.values())


def test_shards_hold_every_record_once(spark, odd_table, empty_table):
    out = sharding.shard_records(odd_table, 4, bucket_bytes=200_000)
    assert out.columns == [*odd_table.columns, "shard_", "slot_"]
    assert rows_of(out.select(odd_table.columns)) == rows_of(odd_table)
    assert gapless(out.select("shard_", "slot_").collect())
    again = sharding.shard_records(odd_table, 4, bucket_bytes=200_000)
    assert rows_of(out) == rows_of(again)
    assert rows_of(out) != rows_of(sharding.shard_records(odd_table, 4, seed=1))
    assert sharding.shard_records(empty_table, 4).count() == 0


def test_a_hot_id_gets_more_buckets(spark, tmp_path):
    """A third of all bytes under one id: no bucket much larger than asked for."""
    rows = [(1, "x" * 200)] * 5000 + [(k, "y" * 200) for k in range(2, 10_002)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "d"))
    stored = spark.read.parquet(str(tmp_path / "d"))
    for n_shards in (24, 240):
        dealt = sharding.scatter(stored, n_shards, "doc_id", "text", 1, 20_000, ("shard", "record", "bucket"))
        sizes = dealt.groupBy("bucket").agg(F.sum(F.octet_length("text") + 8).alias("n"), F.count_distinct("shard").alias("s"))
        worst = sizes.agg(F.max("n"), F.max("s")).first()
        assert worst[0] <= 2.5 * 20_000 and worst[1] == 1
    out = sharding.shard_records(stored, 24, bucket_bytes=20_000)
    assert gapless(out.select("shard", "slot").collect()) and out.count() == 15_000
    folders = {os.path.basename(os.path.dirname(f)) for f in out.inputFiles()}
    assert folders == {f"shard={r.shard}" for r in out.select("shard").distinct().collect()}


def test_a_repeated_row_does_not_fill_one_bucket(spark, tmp_path):
    rows = [(1, "x" * 100)] * 4000 + [(k, "y") for k in range(8000)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "d"))
    stored = spark.read.parquet(str(tmp_path / "d"))
    out = sharding.shard_records(stored, 2, bucket_bytes=20_000)
    slots = sorted(r.slot for r in out.filter("doc_id = 1 and text like 'x%'").collect())
    shard = out.filter("doc_id = 1").first().shard
    n = out.filter(F.col("shard") == shard).count()
    # They lie all over their shard, not in one run.
    assert slots[0] < n / 10 and slots[-1] > n * 9 / 10
    assert gapless(out.select("shard", "slot").collect())


def test_one_more_shard_takes_rows_only_into_itself():
    keys = np.random.default_rng(1).integers(0, 1 << 63, 50_000).astype(np.uint64)
    for n in (1, 2, 24, 1000):
        old, new = sharding.jump_hash(keys, n), sharding.jump_hash(keys, n + 1)
        assert old.max() < n and (new[old != new] == n).all()
        assert abs((new == n).mean() - 1 / (n + 1)) < 0.01


def test_sharding_query(spark, small_dir, small_docs):
    rows = REGISTRY["op1_sharding"](spark, small_dir).collect()
    expected = {(i, len(t.encode()) + 8, zlib.crc32(t.encode())) for i, t in small_docs}
    assert {(r.doc_id, r["size"], r.text_crc32) for r in rows} == expected
    assert len(rows) == len(small_docs) and {r.law for r in rows} == {"key"}
    assert gapless([(r.shard, r.slot) for r in rows])
    assert all(r.grown_shard in (r.shard, 24) for r in rows)


# --- substring dedup ---------------------------------------------------------


def words_digest(df):
    words = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), "[ \\x09-\\x0D]+", " "))
    return F.sha2(words, 256)


@pytest.mark.parametrize("block_bytes", [1 << 20, 300_000, 2_000])
def test_substrings(spark, odd_table, table_docs, empty_table, block_bytes):
    out = substring.remove_repeats(odd_table, block_bytes=block_bytes)
    found = out.select("doc_id", "n_words_", "n_removed_", words_digest(out))
    assert rows_of(found) == brute.substring(table_docs)
    untouched(out, odd_table)
    # A text that loses nothing keeps its bytes; a null stays null.
    kept = out.filter("n_removed_ = 0").select("doc_id", "text")
    assert not set(map(tuple, kept.collect())) - set(table_docs)
    assert substring.remove_repeats(empty_table).count() == 0


def test_substring_query(spark, small_dir, small_docs):
    out = REGISTRY["op2_substring_dedup"](spark, small_dir)
    assert rows_of(out.select("doc_id", "n_words", "n_removed", "kept_sha256")) == brute.substring(
        small_docs
    )


# --- WARC --------------------------------------------------------------------


def pages(spark):
    rows = [
        (4, "http://a/x", "<p>é</p>\r\n\r\nWARC/1.1\r\n", 1),
        (2, "http://a/y", "<p>é</p>\r\n\r\nWARC/1.1\r\n", 1),
        (3, "http://b/\r\nInjected: 1", None, 1),
        (5, None, "", 1),
        (6, "http://c/", "x" * 300_000, 1),
        (6, "http://c/", "x" * 300_000, 1),
        (None, "http://d/", "<p>é</p>\r\n\r\nWARC/1.1\r\n", 1),
        (None, "http://d/", "only here", 1),
        (None, "http://d/", "only here", 1),
    ]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, digest int")


def test_warc_round_trip(spark):
    path = staging_path(spark, "warc-test")
    warc.write_warc(pages(spark), path)
    read = warc.read_warc(spark, path, payload=True).collect()
    own = lambda r, name: int(r.headers[name]) if name in r.headers else None
    found = [
        (own(r, "warc-page-id"), r.record_type, own(r, "warc-refers-to-page-id")) for r in read
    ]
    assert sorted(found, key=repr) == sorted(
        [
            (2, "response", None),
            (4, "revisit", 2),
            (None, "revisit", 2),
            (3, "response", None),
            (5, "revisit", 3),
            (6, "response", None),
            (6, "response", None),
            (None, "response", None),
            (None, "response", None),
        ],
        key=repr,
    )
    for r in read:
        if r.record_type == "response":
            digest = base64.b32encode(hashlib.sha1(r.payload).digest()).decode()
            assert (r.payload_bytes, r.payload_digest) == (len(r.payload), digest)
        assert "injected" not in r.headers
    refers = {r.headers["warc-refers-to"] for r in read if r.record_type == "revisit"}
    assert refers <= {r.record_id for r in read if r.record_type == "response"}


def test_warc_predicates_skip_blocks(spark, monkeypatch):
    path = staging_path(spark, "warc-test")
    warc.write_warc(pages(spark), path)
    only = warc.read_warc(spark, path, record_types=["revisit"], headers={"WARC-Page-ID": ["4"]})
    assert [r.headers["warc-refers-to-page-id"] for r in only.collect()] == ["2"]

    blocks = []
    original = warc._Lines.read
    monkeypatch.setattr(warc._Lines, "read", lambda self, n: blocks.append(n) or original(self, n))
    reader = warc.PushingReader({"path": path, "given": '{"verify": true, "payload": false}'})
    left = reader.pushFilters(
        [warc.EqualTo(("record_type",), "response"), warc.StringStartsWith(("target_uri",), "http://c")]
    )
    assert list(left) == []
    rows = [b.to_pylist() for p in reader.partitions() for b in reader.read(p)]
    assert [r["target_uri"] for b in rows for r in b] == ["http://c/"] * 2
    assert blocks == [300_000] * 2


def test_warc_pushed_filters(spark):
    path = staging_path(spark, "warc-test")
    warc.write_warc(pages(spark), path)
    key = "spark.sql.python.filterPushdown.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        read = warc.read_warc(spark, path)
        assert read.filter("record_type = 'revisit'").count() == 3
        assert read.filter("target_uri like 'http://c%' and payload_bytes > 5").count() == 2
        assert read.filter("record_type in ('revisit', 'x') and offset >= 0").count() == 3
    finally:
        spark.conf.set(key, before)


def test_warc_query_pushes_its_predicates(spark, small_dir, monkeypatch):
    """Revisits are read without a block; responses are verified in the one read that keeps them."""
    path = staging_path(spark, "warc-test")
    warc.write_warc(spark.read.parquet(f"{small_dir}/pages.parquet"), path)
    blocks = []
    original = warc._Lines.read
    monkeypatch.setattr(warc._Lines, "read", lambda self, n: blocks.append(n) or original(self, n))
    counts = {}
    for kind in ("response", "revisit"):
        blocks.clear()
        given = f'{{"verify": {str(kind == "response").lower()}, "payload": false}}'
        reader = warc.PushingReader({"path": path, "given": given})
        assert list(reader.pushFilters([warc.EqualTo(("record_type",), kind)])) == []
        rows = sum(b.num_rows for p in reader.partitions() for b in reader.read(p))
        counts[kind] = (rows, len(blocks))
    found = REGISTRY["op3_warc"](spark, small_dir)
    held = {r.record_type: r["count"] for r in found.groupBy("record_type").count().collect()}
    assert counts == {"response": (held["response"],) * 2, "revisit": (held.get("revisit", 0), 0)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RelationV2") == 2 and "record_type" not in plan.split("Filter")[-1][:60]


@pytest.mark.parametrize("members", [False, True])
def test_warc_gzip_archives(spark, tmp_path, members):
    """Compressed whole, as Spark writes them, and record by record, as crawlers do."""
    plain, packed = str(tmp_path / "plain"), str(tmp_path / "packed")
    warc.write_warc(pages(spark), plain)
    if members:
        os.makedirs(packed)
        for file in sorted(os.listdir(plain)):
            if file.startswith("part"):
                raw = open(f"{plain}/{file}", "rb").read()
                ends = [m.end() for m in re.finditer(rb"\r\n\r\n(?=WARC/1\.1\r\nWARC-Type|$)", raw)]
                parts = [raw[a:b] for a, b in zip([0, *ends], [*ends, len(raw)])]
                open(f"{packed}/{file}.warc.gz", "wb").write(b"".join(gzip.compress(x) for x in parts if x))
    else:
        warc.write_warc(pages(spark), packed, compression="gzip")
        assert any(f.endswith(".gz") for f in os.listdir(packed))
    columns = ["record_type", "record_id", "target_uri", "payload_bytes", "payload_digest", "payload"]
    read = lambda path, **more: rows_of(warc.read_warc(spark, path, payload=True, **more).select(columns))
    assert read(packed) == read(plain)
    assert read(packed, record_types=["revisit"]) == read(plain, record_types=["revisit"])


def test_warc_finds_damage(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write_warc(pages(spark).filter("page_id = 6").limit(1), path)
    file = next(p for p in (tmp_path / "w").iterdir() if p.name.startswith("part"))
    file.write_bytes(file.read_bytes().replace(b"xxxxxx", b"xxyxxx", 1))
    for crc in (tmp_path / "w").glob(".*.crc"):
        crc.unlink()
    with pytest.raises(Exception, match="damaged"):
        warc.read_warc(spark, path).collect()


def test_warc_of_nothing(spark):
    path = staging_path(spark, "warc-test")
    warc.write_warc(pages(spark).limit(0), path)
    assert warc.read_warc(spark, path).count() == 0


# --- decontamination ---------------------------------------------------------


def items_of(docs):
    passage = next(t for i, t in docs if i == 5 and t.startswith("w"))
    words = passage.split()
    return [
        (1, " ".join(words[5:40])),
        (1, "unique words of item one"),
        (2, "Same LINE here"),
        (3, None),
        (4, ""),
        (None, " ".join(words[:12])),
        (11, " ".join(words[20:29])),
        (7, "not in any document at all, this one, as it seems to me today"),
        (8, "日本語"),
    ]


def summary(found, name="leaks"):
    return found.select(
        "doc_id",
        f"{name}.n_words",
        f"{name}.n_hit",
        F.size(f"{name}.items"),
        F.sha2(F.array_join(f"{name}.items", ","), 256),
        F.col(f"{name}.n_hit") > 0,
    )


@pytest.mark.parametrize("block_bytes", [1 << 20, 100])
def test_leaks(spark, odd_table, table_docs, empty_table, monkeypatch, block_bytes):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block_bytes)
    items = items_of(table_docs)
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.find_leaks(odd_table, benchmark)
    expected = brute.leaks(table_docs, items)
    assert rows_of(summary(found, "leaks_")) == expected
    assert rows_of(found.select(odd_table.columns)) == rows_of(odd_table)
    clean = decontaminate.remove_leaks(odd_table, benchmark)
    assert clean.columns == odd_table.columns
    assert clean.count() == sum(not e[-1] for e in expected) < odd_table.count()
    assert decontaminate.find_leaks(empty_table, benchmark).count() == 0
    no_items = decontaminate.remove_leaks(odd_table, benchmark.limit(0))
    assert no_items.count() == odd_table.count()


def test_a_window_of_many_items_is_searched_once(spark, tmp_path, monkeypatch):
    """Items with one prompt, and a source that repeats it: no pair of place and item is made."""
    prompt = "answer the question below in one word and say why"
    items = [(k, f"{prompt} q{k} z{k}") for k in range(600)] + [(600, prompt), (601, "short one")]
    docs = [(k, f"x{k} {prompt} {'filler ' * (k % 5)}" * 3) for k in range(300)] + [(300, None), (301, "a short one")]
    spark.createDataFrame(docs, "doc_id bigint, text string").repartition(2).write.parquet(str(tmp_path / "d"))
    stored = spark.read.parquet(str(tmp_path / "d"))
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    own = decontaminate.Items(items, 10)
    kinds, of = own.kinds()
    assert len(kinds) == 2 + 2 * 600 and len(of) == len(own.starts)
    assert len(own.owners(int(of[0]))) == 601
    found = decontaminate.find_leaks(stored, benchmark, carry=["doc_id"], with_matches=False)
    assert rows_of(summary(found)) == brute.leaks(docs, items)
    assert found.filter(F.size("leaks.matches") > 0).count() == 0
    # Several blocks, of which a task keeps two.
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 8000)
    several = decontaminate.find_leaks(stored, benchmark, carry=["doc_id"], with_matches=False)
    assert rows_of(summary(several)) == brute.leaks(docs, items)
    path, n = decontaminate.store_blocks(benchmark, "item_id", "text", 8000)
    assert n > 4
    blocks, read = decontaminate.Blocks(path, n, 10), []
    real = blocks._read
    blocks._read = lambda k: read.append(k) or real(k)
    for _ in range(3):
        assert sum(len(b.ids) for b in blocks) == 602
        assert len(blocks.held) == decontaminate.HELD_BLOCKS
    assert len(read) == n + 2 * (n - decontaminate.HELD_BLOCKS)
    one = decontaminate.Blocks(*decontaminate.store_blocks(benchmark, "item_id", "text", 1 << 20), 10)
    real_one, read = one._read, []
    one._read = lambda k: read.append(k) or real_one(k)
    assert [len(b.ids) for _ in range(3) for b in one] == [602] * 3 and read == [0]


def test_longest_matches(spark):
    item = " ".join(f"i{k}" for k in range(30))
    docs = [(1, f"x y {item} z"), (2, " ".join(item.split()[4:18])), (3, item + " " + item)]
    found = decontaminate.find_leaks(
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame([("q", item)], "item_id string, text string"),
    )
    matches = {
        r.doc_id: [(m.item_start, m.doc_start, m.length) for m in r.leaks.matches]
        for r in found.collect()
    }
    assert matches == {1: [(0, 2, 30)], 2: [(4, 0, 14)], 3: [(0, 0, 30), (0, 30, 30)]}


def test_suffix_array_is_sorted():
    own = random.Random(5)
    for n, letters, depth in ((1, 2, 4), (50, 2, 16), (300, 3, 10), (300, 70_000, 12)):
        codes = np.array([own.randrange(letters) for _ in range(n)], np.int64)
        order = decontaminate.suffix_array(codes, depth)
        cut = [codes[k : k + depth].tolist() for k in order]
        assert sorted(order.tolist()) == list(range(n)) and cut == sorted(cut)


def test_decontamination_query(spark, small_dir, small_docs):
    items = spark.read.parquet(f"{small_dir}/benchmark.parquet").select("item_id", "text")
    expected = brute.leaks(small_docs, [tuple(r) for r in items.collect()])
    found = REGISTRY["op4_decontamination"](spark, small_dir)
    assert rows_of(found) == expected and any(e[-1] for e in expected)


# --- token counts ------------------------------------------------------------


@pytest.fixture(scope="module")
def unigram():
    """The tokenizer whose counts are to be met, over the same pieces and scores."""
    known = token_counts.Vocabulary.load(PIECES)
    own = [("<unk>", 0.0), *((f"<0x{b:02X}>", known.lowest) for b in range(256))]
    return Tokenizer(models.Unigram([*own, *known.scores.items()], 0, True))


def tokens(unigram, text):
    return len(unigram.encode(token_counts.normalise(text)).ids) if text else 0


def test_token_counts(spark, odd_table, table_docs, empty_table, unigram):
    out = token_counts.count_tokens(odd_table, PIECES)
    expected = [(i, tokens(unigram, t)) for i, t in table_docs]
    assert rows_of(out.select("doc_id", "n_tokens_")) == sorted(expected, key=repr)
    assert rows_of(out.select(odd_table.columns)) == rows_of(odd_table)
    assert token_counts.count_tokens(empty_table, PIECES).count() == 0


def test_token_count_ties():
    """Equal scores: the piece that starts earlier wins, which shows in the count."""
    scores = {"a": -1.0, "b": -1.0, "ab": -2.0, "c": -1.0, "abc": -3.0, "bc": -2.0}
    counter = token_counts.Counter(token_counts.Vocabulary(scores, -9.0))
    own = Tokenizer(models.Unigram([("<unk>", -9.0), *scores.items()], 0, False))
    for text in ("ab", "abc", "bc", "cab", "abab", "aabbcc"):
        assert counter.count(text) == len(own.encode(text).ids), text


def test_token_counts_without_cuts(unigram):
    known = token_counts.Vocabulary.load(PIECES)
    spanning = token_counts.Vocabulary({**known.scores, "▁a▁b": -1.0}, known.lowest)
    counter = token_counts.Counter(spanning)
    assert not counter.cuts
    with_cuts = token_counts.Counter(known)
    texts = pa.chunked_array([["x a b c", None, "", "nothing to join"]])
    plain, joined = with_cuts.column(texts), counter.column(texts)
    assert joined[0] < plain[0] and joined[1:].tolist() == plain[1:].tolist()


def test_token_count_query(spark, small_dir, small_docs, unigram):
    found = REGISTRY["op5_token_counts"](spark, small_dir)
    assert rows_of(found) == sorted(((i, tokens(unigram, t)) for i, t in small_docs), key=repr)


# --- quality rules -----------------------------------------------------------


def test_counts(spark, odd_table, table_docs, empty_table):
    found = quality.measure(odd_table)
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    out = found.select("doc_id", *[f"counts_.{c}" for c in columns], quality.base_failed("counts_"))
    assert rows_of(out) == brute.counts(table_docs)
    assert rows_of(found.select(odd_table.columns)) == rows_of(odd_table)
    labels = spark.createDataFrame([(5, 1, 0)], "doc_id bigint, quality bigint, toxic bigint")
    kept = quality.keep_good(odd_table, labels)
    assert kept.columns == odd_table.columns
    assert kept.count() == sum(not e[-1] for e in brute.counts(table_docs))
    assert quality.keep_good(empty_table, labels).count() == 0
    assert quality.keep_good(odd_table, labels.limit(0)).count() == kept.count()


def test_binomial_bound():
    from math import comb

    exact = lambda k, n, p: sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
    for n in (1, 7, 60, 400):
        for p in (0.005, 0.05, 0.5):
            for k in (0, 1, n // 10, n // 2, n):
                assert abs(quality.binomial_cdf(k, n, p) - min(1, exact(k, n, p))) < 1e-10
    for n in (10, 200, 2000):
        most = quality.allowed(n, 0.02, 0.01)
        assert quality.binomial_cdf(most, n, 0.02) <= 0.01 < quality.binomial_cdf(most + 1, n, 0.02)


def labelled(spark, n, lang="en"):
    """Good documents with few symbols, bad ones with many, and labels for all."""
    own = random.Random(n)
    rows = []
    for k in range(n):
        bad = k % 4 == 0
        words = [f"word{own.randrange(10**6)}" for _ in range(60)]
        if bad or own.random() < 0.002:
            words = [w + "###" for w in words]
        rows.append((k, " ".join(words), lang, 0 if bad else 1))
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id bigint, text string, lang string")
    return docs, spark.createDataFrame(
        [(r[0], r[3], 0) for r in rows], "doc_id bigint, quality bigint, toxic bigint"
    )


def test_cutoffs_follow_the_labels(spark):
    docs, labels = labelled(spark, 4000)
    few, few_labels = labelled(spark, 40, lang=None)
    few = few.withColumn("doc_id", F.col("doc_id") + 100_000)
    few_labels = few_labels.withColumn("doc_id", F.col("doc_id") + 100_000)
    # Rows without use, and a second, worse label that counts.
    more = spark.createDataFrame(
        [(None, 1, 0), (5, None, 0), (1, 0, 0), (77, 1, None), (999_999, 1, 0)],
        "doc_id bigint, quality bigint, toxic bigint",
    )
    every, every_label = docs.union(few), labels.union(few_labels).union(more)
    good = {r.doc_id for r in labels.filter("quality = 1").collect()} - {1}
    kept = {r.doc_id for r in quality.keep_good(every, every_label).collect()}
    assert not kept & set(range(0, 4000, 4))
    assert len(kept & good) >= 0.98 * len(good)
    # The few labels of the null stratum prove nothing by themselves; the pool decides there.
    assert not kept & set(range(100_000, 100_040, 4))
    alone = {r.doc_id for r in quality.keep_good(few, few_labels).collect()}
    assert alone == set(range(100_000, 100_040))


def test_joint_steps_stop_at_the_first_that_fails(spark):
    own = random.Random(7)
    rows, labels, steps = [], [], {}
    for lang, n, p in (("a", 900, 0.2), ("b", 260, 0.004), (None, 700, 0.0), ("few", 200, 0.03)):
        for _ in range(n):
            k, step = len(rows), own.randrange(1, 300) if own.random() < p else None
            rows.append((k, lang, step))
            labels.append((k, 1, 0))
            steps.setdefault(lang, []).append(step)
    stepped = spark.createDataFrame(rows, "doc_id bigint, lang string, step bigint")
    labels = spark.createDataFrame(labels, "doc_id bigint, quality bigint, toxic bigint")
    stops = {(r.pooled, r.stratum): r for r in quality.joint_steps(stepped, labels, "lang").collect()}
    # 200 good labels are too few for one of five tests.
    assert set(stops) == {(False, "a"), (False, "b"), (False, None), (True, None)}
    steps["pool"] = [x for own in steps.values() for x in own]
    for (pooled, stratum), found in stops.items():
        values = steps["pool" if pooled else stratum]
        assert found.n_good == len(values)
        assert found.n_allowed == quality.allowed(len(values), quality.RISK, quality.DELTA / 5)
        rejected = lambda k: sum(x is not None and x <= k for x in values)
        fails = [k for k in range(1, 301) if rejected(k) > found.n_allowed]
        assert found.stop == (fails[0] if fails else None)
    assert stops[False, "a"].stop is not None and stops[False, None].stop is None


def test_sequence_estimates_the_good_share():
    """The more of a value's tail is explained by documents that are not good, the earlier."""
    size = 1001
    unlabelled, other, good = [0] * size, [0] * size, [0] * size
    unlabelled[0], unlabelled[300], unlabelled[900] = 800, 100, 100  # at 900 all are bad
    other[0], other[900], good[0] = 10, 10, 80
    steps = quality._steps(unlabelled, other, good)
    assert steps == sorted(steps, reverse=True) and steps[901:] == [0] * 100
    assert steps[900] == quality.STEPS // 100  # nothing but the tenth of 100 in 1,000
    assert steps[300] == quality.STEPS * (100 + 20) // 1000
    assert quality._steps([0] * size, other, good)[900] == quality.STEPS // 2 * 11 // 10
    assert quality._steps([0] * size, [0] * size, good) == [0] * size


def test_holdout_has_no_part_in_the_sequence(spark):
    docs, labels = labelled(spark, 400)
    measured = quality.measure_all(docs, labels, ["doc_id", "lang"])
    found = quality.sequence(measured, labels)
    swapped = measured.withColumn(
        "counts", F.when(F.col("doc_id") % 4 == 0, F.col("counts")).otherwise(F.col("counts").withField("n_symbols", F.lit(1).cast("bigint")))
    )
    assert quality.sequence(swapped, labels) == found


def test_terms_that_mark_toxic_documents(spark, tmp_path):
    """Learnt from labels and unlabelled documents; what good documents also hold marks nothing."""
    own = random.Random(11)
    rows, labels = [], []
    for k in range(3000):
        toxic = own.random() < 0.15
        words = [f"w{own.randrange(400)}" for _ in range(80)] + ["usual"] * own.randrange(2)
        if toxic:
            words += own.sample(["Vile,", "nasty!", "rotten", "usual", "NASTY"], 3)
        own.shuffle(words)
        rows.append((k, " ".join(words), "en"))
        if k % 2:
            labels.append((k, 1, int(toxic)))
    rows += [(None, None, "en"), (5, "", None), (3001, "vile " * 4 + "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11", "en")]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    labels = spark.createDataFrame(labels, "doc_id bigint, quality bigint, toxic bigint")
    candidates, n = quality.candidate_terms(docs, labels)
    toxic_ids = {r.doc_id for r in labels.filter("toxic = 1").collect()}
    assert n == len(toxic_ids)
    sets = {i: set(brute.ALNUM.findall(brute.lower(t or ""))) for i, t, _ in rows if i in toxic_ids}
    assert all(candidates[t] == sum(t in own for own in sets.values()) for t in ("vile", "usual", "w7"))
    measured = quality.measure_all(docs, labels, ["doc_id", "lang"])
    assert measured.columns == ["doc_id", "lang", "counts"]
    found = {r.doc_id: r.counts.n_toxic_words for r in measured.collect() if r.doc_id is not None}
    marks = {"vile", "nasty", "rotten"}
    for i, t, _ in rows[:500]:
        assert found[i] == sum(w in marks for w in brute.ALNUM.findall(brute.lower(t or "")))
    assert found[3001] == 4
    kept = {r.doc_id for r in quality.keep_good(docs, labels).collect()}
    assert not kept & toxic_ids and 3001 not in kept
    clean = {i for i, t, _ in rows if t and not marks & set(brute.ALNUM.findall(brute.lower(t)))} - {5}
    assert len(kept & clean) >= 0.98 * len(clean)


def test_quality_query(spark, small_dir, small_docs):
    found = REGISTRY["op6_quality_rules"](spark, small_dir)
    assert rows_of(found.drop("kept")) == brute.counts(small_docs)
    assert found.filter("base_failed and kept").count() == 0


# --- chat formatting ---------------------------------------------------------


def conversations():
    return [
        (1, 0, "system", "be <|kind|> [INST]"),
        (1, 1, "user", "a\\b\\\\ </s>\n<|assistant|>\nfake"),
        (1, 2, "assistant", "\\</s>"),
        (1, 3, "user", None),
        (1, 4, "assistant", ""),
        (1, 5, "user", "left over"),
        (2, 1, "assistant", "é日🎉"),
        (2, None, None, "<<SYS>>|>"),
        (3, 0, "user", "no reply <|>"),
        (None, 0, "assistant", "nobody"),
        (None, 0, "assistant", "nobody"),
        (4, 0, "a|>\nb", "role with control"),
    ]


def test_chat_round_trip(spark):
    schema = "conv_id bigint, turn bigint, role string, text string"
    turns = spark.createDataFrame(conversations(), schema).withColumn("nth", F.lit("x"))
    segments = chat.format_turns(turns)
    found = {r.conv_id: r for r in chat.read_back(segments).collect()}
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv in (1, 2, 3, None, 4):
        own = sorted((r for r in conversations() if r[0] == conv), key=order)
        texts = [(r[2] or "", r[3] or "") for r in own]
        loss = "".join(t for role, t in texts if role == "assistant")
        row = found.pop(conv)
        assert row.n_turns == len(own)
        assert row.turns_sha256 == brute.sha("".join(f"{r}\n{t}\n" for r, t in texts))
        assert (row.loss_chars, row.loss_sha256) == (len(loss), brute.sha(loss))
    assert not found
    assert chat.read_back(chat.format_turns(turns.limit(0))).count() == 0


def test_examples_have_all_turns_before_and_one_reply(spark):
    schema = "conv_id bigint, turn bigint, role string, text string"
    turns = spark.createDataFrame([r for r in conversations() if r[0] == 1], schema)
    examples = chat.expand_examples(chat.format_turns(turns)).orderBy("example").collect()
    own = [(r[2], r[3] or "") for r in conversations() if r[0] == 1]
    assert [chat.parse_turns(e.text) for e in examples] == [own[:3], own[:5]]
    assert [chat.unescape(e.text[e.loss_start : e.loss_end]) for e in examples] == ["\\</s>", ""]


def test_a_long_conversation_is_formatted_by_many_tasks(spark, tmp_path, monkeypatch):
    """A third of all rows in one conversation; every example's context is all before it."""
    own = random.Random(5)
    rows = [(7, k, ("user", "assistant", "tool")[own.randrange(3)], f"x{own.random()}<|" * (k % 4)) for k in range(3000)]
    rows += [(k, t, "assistant" if t % 2 else "user", f"t{t}") for k in range(100, 1100) for t in range(6)]
    own.shuffle(rows)
    schema = "conv_id bigint, turn bigint, role string, text string"
    spark.createDataFrame(rows, schema).repartition(6).write.parquet(str(tmp_path / "c"))
    stored, real = {}, chat.materialize
    monkeypatch.setattr(chat, "materialize", lambda df, name: stored.setdefault(name, real(df, name)))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        segments = chat.format_turns(spark.read.parquet(str(tmp_path / "c")))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    hot = sorted(r for r in rows if r[0] == 7)
    assert stored["turns"].filter("conv_id = 7").select("slice").distinct().count() >= 3
    assert stored["earlier"].count() < 8
    found = segments.filter("conv_id = 7").orderBy("nth").collect()
    assert [(r.nth, r.turn) for r in found] == [(k, k) for k in range(3000)]
    text = "".join(r.formatted for r in found)
    replies = [x for _, _, role, x in hot if role == "assistant"]
    examples = chat.prefix_examples(segments).filter("conv_id = 7").orderBy("example").collect()
    assert [e.example for e in examples] == list(range(len(replies)))
    for e, reply in zip(examples, replies):
        assert chat.unescape(text[e.loss_start : e.loss_end]) == reply
        assert len(chat.parse_turns(text[: e.context_end])) == e.nth
    digest = {r.conv_id: r for r in chat.read_back(segments).collect()}
    assert digest[7].turns_sha256 == brute.sha("".join(f"{r}\n{x}\n" for _, _, r, x in hot))
    assert digest[7].loss_sha256 == brute.sha("".join(replies)) and len(digest) == 1001


def test_escaping_is_reversible():
    own = random.Random(3)
    parts = [*chat.CONTROL, "\\", "<", "|", ">", "s", "\n", "x", "[", "/"]
    for _ in range(3000):
        text = "".join(own.choices(parts, k=own.randrange(9)))
        escaped = chat.escape(text)
        assert chat.unescape(escaped) == text
        bare = chat._BACK.sub("", escaped)
        formatted = chat.format_turn(text, text)[0] * 2
        assert chat.parse_turns(formatted) == [(text, text)] * 2, (text, bare)


def test_chat_query(spark, small_dir):
    found = {r.conv_id: r for r in REGISTRY["op7_chat_formatting"](spark, small_dir).collect()}
    stored = spark.read.parquet(f"{small_dir}/conversations.parquet").orderBy("conv_id", "turn")
    by_conv = {-1: [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]}
    for r in stored.collect():
        by_conv.setdefault(r.conv_id, []).append((r.role, r.text))
    assert set(found) == set(by_conv)
    for conv, turns in by_conv.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        row = found[conv]
        assert row.turns_sha256 == brute.sha("".join(f"{r}\n{t}\n" for r, t in turns))
        assert (row.loss_chars, row.loss_sha256) == (len(loss), brute.sha(loss))


# --- suffix-array dedup ------------------------------------------------------


@pytest.mark.parametrize("options", [{}, {"block_bytes": 3000}, {"block_bytes": 3000, "hot": 1}])
def test_suffixes(spark, odd_table, table_docs, empty_table, options):
    short = [(i, t) for i, t in table_docs if len(t or "") < 100_000]
    table = odd_table.filter("length(coalesce(text, '')) < 100000")
    out = suffix.remove_repeats(table, **options)
    found = out.select("doc_id", "n_bytes_", "n_removed_", "n_spans_", F.sha2("kept_", 256))
    assert rows_of(found) == brute.suffix(short)
    assert rows_of(out.select(table.columns)) == rows_of(table)
    assert suffix.remove_repeats(empty_table).count() == 0


def test_suffixes_of_long_texts(spark, odd_table, table_docs):
    table = odd_table.filter("doc_id in (7, 8)").select("doc_id", "text")
    out = suffix.remove_repeats(table)
    found = out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    assert rows_of(found) == brute.suffix([d for d in table_docs if d[0] in (7, 8)])


def test_collection_against_sorting():
    own = random.Random(9)
    for letters, most in (("ab", 4), ("abc\0", 3), ("a", 5)):
        strings = ["".join(own.choices(letters, k=own.randrange(most, 14))) for _ in range(30)]
        data = np.frombuffer("".join(strings).encode(), np.uint8)
        sizes = np.array([len(s) for s in strings])
        made = suffix.Collection(data, np.cumsum(sizes), sizes, most)
        every = sorted(s[k:] for s in strings for k in range(len(s) + 1))
        shared = [0] + [
            next((k for k in range(most) if a[k : k + 1] != b[k : k + 1] or k >= len(b)), most)
            for a, b in zip(every, every[1:])
        ]
        assert made.lcp.tolist() == shared
        text, offset, number = made.classes()
        groups = {}
        for s, o, c in zip(text, offset, number):
            groups.setdefault(strings[s][o : o + most], set()).add(int(c))
        assert len(text) == sum(len(s) - most + 1 for s in strings)
        assert all(len(g) == 1 for g in groups.values())
        assert len({min(g) for g in groups.values()}) == len(groups)


def test_suffix_query(spark, small_dir, small_docs):
    assert rows_of(REGISTRY["op8_suffix_dedup"](spark, small_dir)) == brute.suffix(small_docs)


# --- SimHash -----------------------------------------------------------------


def test_near_duplicates(spark, odd_table, table_docs, empty_table):
    expected, groups = brute.near(table_docs)
    assert rows_of(simhash.near_duplicates(odd_table)) == expected
    kept = simhash.keep_one(odd_table)
    assert kept.columns == odd_table.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == groups
    assert simhash.near_duplicates(empty_table).count() == 0
    assert simhash.keep_one(empty_table).count() == 0


@pytest.mark.parametrize("large", [8192, 70])
def test_no_link_is_lost(monkeypatch, large):
    """Chains and dense groups of fingerprints, against all pairs."""
    monkeypatch.setattr(simhash, "LARGE_POSTING", large)
    own = np.random.default_rng(4)
    center = own.integers(0, 1 << 63, 1).astype(np.uint64)[0]
    flips = lambda k: np.bitwise_or.reduce(np.uint64(1) << own.choice(64, k, False).astype(np.uint64))
    dense = [center ^ flips(own.integers(0, 6)) for _ in range(400)]
    chain = [center]
    for _ in range(60):
        chain.append(chain[-1] ^ flips(4))
    loose = list(own.integers(0, 1 << 63, 500).astype(np.uint64))
    prints = np.unique(np.array(dense + chain + loose, np.uint64))
    for bits in (0, 1, 3, 4):
        ends = {
            e for mask in simhash.place_masks(bits) for e in simhash.posting_links(prints, mask, bits)
        }
        assert all((a ^ b).bit_count() <= bits for a, b in ends)
        forest, every = simhash.Forest(len(prints)), simhash.Forest(len(prints))
        at = {int(p): k for k, p in enumerate(prints)}
        forest.link(*(np.array([at[e[s]] for e in ends], int) for s in (0, 1)))
        for k in range(len(prints)):
            near = np.flatnonzero(np.bitwise_count(prints[:k] ^ prints[k]) <= bits)
            every.link(np.full(len(near), k), near)
        assert [forest.find(k) for k in range(len(prints))] == [
            every.find(k) for k in range(len(prints))
        ]


def test_components(spark):
    own = random.Random(2)
    edges = [(k, k + 1) for k in range(0, 40)]  # a path
    edges += [(100, 100 + k) for k in range(1, 60)]  # a hub
    edges += [(own.randrange(200, 400), own.randrange(200, 400)) for _ in range(150)]
    edges = [(min(e), max(e)) for e in edges if e[0] != e[1]] + [(-5, 0)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    found = simhash.components(spark.createDataFrame(edges, "a bigint, b bigint"))
    assert rows_of(found) == sorted(((x, find(x)) for x in parent), key=repr)


def test_simhash_query(spark, small_dir, small_docs):
    assert rows_of(REGISTRY["op9_simhash"](spark, small_dir)) == brute.near(small_docs)[0]


# --- packing -----------------------------------------------------------------


def check_packing(rows, docs, window=1024):
    """Every id of every document lies in one piece, every window is filled without gaps."""
    tokenizer = Tokenizer.from_file(BPE)
    ids = [tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for _, t in docs]
    expected = Bag()
    for (doc_id, _), own in zip(docs, ids):
        for start in range(0, len(own), window):
            part = np.array(own[start : start + window], "<u4")
            expected[(doc_id, start, len(part), zlib.crc32(part.tobytes()), len(own))] += 1
    assert Bag((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == expected
    windows = {}
    for r in rows:
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    return windows


def test_packing(spark, odd_table, table_docs, empty_table):
    check_packing(packing.pack(odd_table, BPE).collect(), table_docs)
    assert packing.pack(empty_table, BPE).count() == 0


def test_windows_are_filled():
    own = random.Random(1)
    counts = np.zeros(101, np.int64)
    for _ in range(5000):
        counts[own.randrange(1, 61)] += own.choice((1, 1, 50))
    plan = packing.fill_windows(counts, 100)
    used = np.zeros(101, np.int64)
    for chosen, times in plan:
        assert sum(length * n for length, n in chosen.items()) <= 100
        for length, n in chosen.items():
            used[length] += n * times
    assert used.tolist() == counts.tolist()
    total = sum(k * int(c) for k, c in enumerate(counts))
    assert sum(times for _, times in plan) <= total / 100 * 1.001 + 2
    assert packing.fill_windows(np.zeros(5, int), 4) == []
    # The fullest window is found where taking the largest first would miss it.
    assert packing.fill_windows(np.bincount([6, 5, 4, 4, 3], minlength=13), 12)[0][0] in (
        {6: 1, 3: 1},
        {6: 1, 4: 1},
    ) or sum(k * v for k, v in packing.fill_windows(np.bincount([6, 5, 4, 4, 3]), 12)[0][0].items()) >= 11


@pytest.mark.parametrize("special", ["<|endoftext|>", "<|other|>"])
def test_units_give_the_tokenizers_ids(special):
    """With the special token, which the tokenizer itself takes, and without it."""
    own = random.Random(1)
    parts = [" ", "  ", "\n", "\t", "\u00a0", "\u3000", "\u2003", "\u0085", "a", "bc", "'s", "'", "."]
    parts += ["!?", "12", "é", "日", special, "<|", "|>", f"x{special}y", "\x1c", "À", "\u1680"]
    texts = ["".join(own.choices(parts, k=own.randrange(13))) for _ in range(5000)]
    tokenizer = packing.UnitTokenizer(BPE)
    assert tokenizer.merging
    ids, n = tokenizer.ids(pa.chunked_array([texts]))
    expected = [e.ids for e in tokenizer.tokenizer.encode_batch(texts, add_special_tokens=False)]
    ends = np.cumsum(n)
    assert [ids[e - k : e].tolist() for e, k in zip(ends, n)] == expected


def test_packing_query(spark, small_dir, small_docs):
    rows = REGISTRY["op10_packing"](spark, small_dir).collect()
    windows = check_packing(rows, small_docs)
    assert len(windows) <= sum(r.length for r in rows) / 1024 * 1.02 + 2


# --- all ---------------------------------------------------------------------


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in REGISTRY) == list(range(1, 11))
    assert len(CLASHING) == len(set(CLASHING))
