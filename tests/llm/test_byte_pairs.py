"""Encoding against the encoder library, and the round trip."""

import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from stayline.llm import byte_pairs, queries, shards


@pytest.fixture(scope="module")
def raw():
    return byte_pairs.read_ranks("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks(raw):
    return byte_pairs.Ranks(raw)


@pytest.fixture(scope="module")
def library(raw):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=raw, special_tokens={})


def checked(docs, ranks, library, **more):
    got = byte_pairs.encode(docs, ranks, **more).withColumn("bytes", ranks.decoded(F.col("ids"))).collect()
    texts = sorted((str(r.doc_id), r.text or "") for r in docs.collect())
    assert sorted((str(r.doc_id), bytes(r.bytes).decode()) for r in got) == texts
    for r in got:
        assert r.ids == library.encode_ordinary(bytes(r.bytes).decode())


def test_whole_texts(spark, sf, ranks, library):
    checked(spark.read.parquet(f"{sf}/documents.parquet").limit(200), ranks, library, shard_bytes=20_000)


def test_odd_rows(odd_docs, no_docs, ranks, library):
    checked(odd_docs, ranks, library)
    assert byte_pairs.encode(no_docs, ranks).collect() == []


def test_every_kind_of_character(spark, ranks, library):
    """Each assigned plane in runs, between letters, numbers and spaces; classes must be those of the library."""
    points = [c for c in range(0x3FFFF) if not 0xD800 <= c < 0xE000]
    texts = [" a1 ".join(map(chr, points[i:i + 400:3])) for i in range(0, len(points), 400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(8)
    got = byte_pairs.encode(docs, ranks)
    want = spark.createDataFrame([(i, library.encode_ordinary(t)) for i, t in enumerate(texts)], "doc_id bigint, want array<int>")
    assert got.join(want, "doc_id").where("ids = want").count() == len(texts)


@pytest.mark.parametrize("long", [0, 4, 1024])
def test_fold_and_heap_make_the_same_merges(spark, ranks, library, long):
    rng = random.Random(long)
    words = ["x" * 700, "ab" * 400, *["".join(rng.choice("abehinorst ") for _ in range(rng.randrange(1, 40))).strip() + "s"
                                      for _ in range(300)]]
    docs = spark.createDataFrame(list(enumerate(words)), "doc_id bigint, text string")
    checked(docs, ranks, library, long=long)


def test_heap_takes_the_leftmost_of_equals(raw):
    ranks = {**{bytes([i]): i for i in range(256)}, b"aa": 300, b"aaa": 301}
    library = tiktoken.Encoding("few", pat_str="a+", mergeable_ranks=ranks, special_tokens={})
    for n in range(1, 12):
        assert byte_pairs.heap_merge(b"a" * n, ranks) == library.encode_ordinary("a" * n)


def test_small_shards_change_nothing(odd_docs, ranks):
    rows = [sorted((str(r.doc_id), r.ids) for r in byte_pairs.encode(odd_docs, ranks, shard_bytes=n).collect())
            for n in (1, shards.SHARD_BYTES)]
    assert rows[0] == rows[1]


def test_words_of_a_part_met_in_several_turns(odd_docs, ranks, library):
    checked(odd_docs, ranks, library, shard_bytes=1, met_bytes=1)


def test_words_travel_as_packed_lists(spark, ranks):
    """A shard sends at most a list per part, of fewer bytes than its words have, and gets one list of ids for each."""
    rng = random.Random(5)
    words = [f" word{rng.randrange(10**6)}" for _ in range(60_000)]
    docs = spark.createDataFrame([(i, words[i:i + 600]) for i in range(0, 60_000, 600)], "id bigint, words array<string>")
    rows = docs.select(F.struct("id").alias("row"), "words").coalesce(2)
    made = shards.word_shards(rows, counted=False, parts=16)
    sent = shards.parted(made).collect()
    per_shard = {s: [r for r in sent if r.shard == s] for s in {r.shard for r in sent}}
    assert all([r.part for r in lists] == sorted({r.part for r in lists}) and len(lists) <= 16 for lists in per_shard.values())
    found = {s: [w for r in lists for w in shards.unpacked_words([r.words])[0].to_pylist()] for s, lists in per_shard.items()}
    assert set().union(*found.values()) == set(words) and all(len(v) == len(set(v)) for v in found.values())
    assert sum(len(r.words) for r in sent) < 0.6 * sum(len(w) for v in found.values() for w in v)
    at = {w: {r.part for r in sent if w in found[r.shard][:50] and w in shards.unpacked_words([r.words])[0].to_pylist()}
          for v in found.values() for w in v[:50]}
    assert all(len(parts) == 1 for parts in at.values())
    back = byte_pairs.encoded(shards.parted(made), ranks).collect()
    assert sorted((r.shard, r.part) for r in back) == sorted((r.shard, r.part) for r in sent)


@pytest.mark.parametrize("texts", [[], ["", "", ""], ["a"], ["", "\u00e4\u20ac", "", "x" * 3000, "b c", ""]])
def test_packed_lists_give_the_words_back(texts):
    words = pa.array(texts, pa.string())
    part = shards.word_parts(words, 7)
    again = shards.word_parts(pa.array(["other", *texts], pa.string()).slice(1), 7)
    assert part.tolist() == again.tolist()
    order = part.argsort(kind="stable")
    lists = shards._packed_words(words.take(pa.array(order)), part[order])
    assert lists.field("part").to_pylist() == sorted(set(part.tolist()))
    if texts:
        got, counts = shards.unpacked_words(lists.field("words").to_pylist())
        assert got.to_pylist() == [texts[i] for i in order]
        assert counts.tolist() == [part.tolist().count(p) for p in sorted(set(part.tolist()))]


def test_query(spark, sf, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.op12_byte_pairs(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
