"""Encoding through chunks, prefix counts, the token store and packing, against the library itself."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayline.llm import packing, token_counts, token_store
from stayline.llm.common import documents
from stayline.llm.tokens import encoder

PARTS = ["'", "re", "s", "t", "ve", "ll", " ", "  ", "\n", "\t", "a", "tion", "the", "!", "!!", "--", "1", "23", "é", "漢",
         "́", "Ǻ", "<|endoftext|>", "<|startoftext|>", "<|", " ", "😀", "\x1c", " "]


def texts(rng, n, most=9):
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, most))) for _ in range(n)]


@pytest.mark.parametrize("name,spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_chunks_give_the_ids_of_the_whole_text(rng, name, spaced):
    made = encoder(name, spaced)
    some = texts(rng, 4000)
    assert made.encode(some) == [made.whole(t) for t in some]


def test_a_full_cache_changes_nothing(rng):
    from stayline.llm.tokens import ChunkEncoder
    import public_tokenizers

    small = ChunkEncoder(public_tokenizers.path("byte_bpe_50k.json"), True, limit=20)
    some = [" ".join(f"w{rng.randint(0, 99)}" for _ in range(30)) for _ in range(20)]
    for part in (some[:7], some[7:], some):
        assert small.encode(part) == [small.whole(t) for t in part]


@pytest.mark.parametrize("name,spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_new_chunks_are_cut_together(rng, name, spaced):
    """One cut for the plain chunks of a call, also of other letters and around line breaks; odd ones stay alone."""
    import public_tokenizers
    from stayline.llm.tokens import ChunkEncoder

    made, cuts = ChunkEncoder(public_tokenizers.path(name), spaced), []
    one, many = made._split, made._split_marked
    made._split = lambda text: cuts.append("one") or one(text)
    made._split_marked = lambda text: cuts.append("many") or many(text)
    some = ["the naïve\nÀrger isn't", "Ÿ 12.5\n\nſ, x!"] * 3
    assert made.encode(some) == [made.whole(t) for t in some]
    assert cuts.count("many") == 1 and cuts.count("one") <= len(some) * spaced  # first chunks have no space before them
    odd = [*PARTS, "İ", "Ÿ", "ŉ", "ß", "\r", "\r\n", "\n\n", "\x0b", "\x00", "\xad", "\xa0", "\x85", "Σ"]
    for _ in range(5):
        some = ["".join(rng.choice(odd) for _ in range(rng.randint(0, 12))) for _ in range(400)]
        assert made.encode(some) == [made.whole(t) for t in some]


def test_counts_at_every_prefix(rng):
    made, library = token_counts.counter(token_counts.VOCABULARY), encoder(token_counts.VOCABULARY, True)
    for text in texts(rng, 1200) + ["aaaa" * 30, " " * 40 + "x", "-" * 90]:
        counts = np.cumsum(np.frombuffer(made.steps(text), "<i2")).tolist()
        assert counts == [len(library.whole(text[: i + 1])) // 4 for i in range(len(text))], repr(text)


def test_prefix_table(odd_docs, no_docs):
    library = encoder(token_counts.VOCABULARY, True)
    table = token_counts.prefix_table(odd_docs)
    rows = {r.doc_id: r for r in table.collect()}
    assert table.count() == odd_docs.count()
    for r in odd_docs.collect():
        text = r.text or ""
        got = rows[r.doc_id]
        assert (got.n_bytes, got.n_tokens) == (len(text.encode()), len(library.whole(text)) // 4)
        assert len(got.prefix_steps) == 2 * len(text)
    for r in token_counts.longest_within(table, 20).join(odd_docs.select("doc_id", "text"), "doc_id").collect():
        text = r.text or ""
        sizes = [len(library.whole(text[: i + 1])) // 4 for i in range(min(len(text), 400))]
        inside = [i + 1 for i, n in enumerate(sizes) if n <= 20]
        assert r.n_chars_kept == (inside[-1] if inside else 0) and r.n_tokens_kept <= 20
    assert token_counts.prefix_table(no_docs).count() == 0


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_planes_round_trip(kind):
    rng = np.random.default_rng(2)
    for n in (0, 1, 7, 8, 9, 1000, 4096, 9001):
        for top in (1, 300, 60_000, 2**32):
            ids = rng.integers(0, top, n, dtype=np.uint64).astype("<u4")
            data = token_store.pack_ids(ids, kind, block=4096)
            assert (token_store.unpack_ids(data) == ids).all()
            assert (token_store.unpack_ids(data, n // 3, n // 2) == ids[n // 3 : n // 3 + n // 2]).all()
    assert len(token_store.pack_ids(np.zeros(10**6, "<u4"), kind)) < 4096
    with pytest.raises(ValueError):
        token_store.unpack_ids(b"XXXX" + bytes(40))


@pytest.mark.parametrize("kind,chunk", [("byte", 1 << 19), ("bit", 50)])
def test_store_round_trip(spark, odd_docs, kind, chunk, tmp_path):
    library = encoder(token_store.VOCABULARY, False)
    path = str(tmp_path / "store")
    token_store.write(odd_docs, path, kind=kind, block=64, chunk=chunk, shards=4)
    got = sorted(token_store.read(spark, path).collect(), key=lambda r: r.start)
    order = sorted(odd_docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    at = 0
    for r, d in zip(got, order, strict=True):
        ids = library.whole(d.text or "") + b"\2\0\0\0"
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32, bytes(r.ids)) == (d.doc_id, at, len(ids) // 4, zlib.crc32(ids), ids)
        at += len(ids) // 4
    index = token_store.read_index(spark, path)
    assert index.agg(F.sum("n_ids")).first()[0] == at and index.agg(F.sum("n_docs")).first()[0] == len(order)


def test_store_of_nothing(spark, no_docs, tmp_path):
    token_store.write(no_docs, str(tmp_path / "none"))
    assert token_store.read(spark, str(tmp_path / "none")).count() == 0


def fits(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= capacity
    return len(by)


def test_packing_of_odd_rows(odd_docs, no_docs):
    library = encoder(packing.VOCABULARY, True)
    rows = packing.pack(odd_docs, capacity=64, with_ids=True).collect()
    fits(rows, 64)
    pieces = {}
    for r in rows:
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length
        pieces.setdefault(r.doc_id, []).append((r.piece, r.start, bytes(r.ids)))
    for d in odd_docs.collect():
        want = library.whole(d.text or "") + bytes(4)
        own = sorted(set(pieces[d.doc_id]))
        assert b"".join(p[2] for p in own) == want and [p[0] for p in own] == list(range(len(own)))
        assert all(len(p[2]) == 256 for p in own[1:])
        assert [p[1] for p in own] == [sum(len(q[2]) for q in own[:i]) // 4 for i in range(len(own))]
    assert len(pieces[7]) == 2 * len(set(pieces[7]))  # repeated rows are packed twice
    assert packing.pack(no_docs).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_everything_tightly(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 30, 100])
    counts = {n: rng.randint(0, 40) for n in range(1, capacity + 1) if rng.random() < 0.7}
    if seed == 5:
        counts = {1: 10_000, capacity // 2 + 1: 3}
    runs = packing.plan(counts, capacity)
    used, seen = {}, {n: 0 for n in counts}
    for length, low, high, first, offset, per in runs:
        assert low == seen[length]
        seen[length] = high
        for i in range(high - low):
            used.setdefault(first + i // per, []).append((offset + i % per * length, length))
    assert seen == counts
    total = 0
    for parts in used.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= capacity and sum(3 * n > capacity for _, n in parts) <= 2
        total += at
    assert total == sum(n * c for n, c in counts.items())
    large = sum(c for n, c in counts.items() if 2 * n > capacity)
    assert len(used) <= max(-(-total // capacity), large) * 1.22 + 1


def test_packing_is_near_the_bound(spark, sf):
    rows = packing.pack(documents(spark, sf)).select("doc_id", "piece", "sequence_id", "offset", "length").collect()
    assert fits(rows, packing.CAPACITY) <= -(-sum(r.length for r in rows) // packing.CAPACITY) * 1.01 + 1
