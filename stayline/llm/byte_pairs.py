"""Byte-level BPE by ranks: encoding of whole texts, and decoding.

Texts are cut into the pattern's matches; each distinct match is encoded once, by a fold of Spark's higher-order
functions over its bytes: every step joins the neighbours of the lowest rank, the leftmost of equals, until none has
a rank. The ranks are a literal of the plan: a map cut into buckets by checksum, because Spark looks a key up by reading
a map from its start. Matches above ``LONG`` bytes, for which a fold's steps times its array would grow as a square, go
through a heap with the same order of merges. Decoding looks pieces up by id and concatenates them.

Nulls are empty texts and have no ids. Repeated rows, also of one id, stay apart. An empty table gives an empty one.
Only the id and the text are read, so other columns may be called anything.
"""

from __future__ import annotations

import base64
import contextlib
import functools
import heapq
import json
import sys
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.llm.common import shuffle_width, text_of
from stayline.llm.shards import SHARD_BYTES, listed, packed, parted, trimmed, unpacked, unpacked_words, word_shards
from stayline.llm.tokens import PATTERN

# Task functions travel with their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Matches of more bytes are encoded with a heap.
LONG = 1024
#: Buckets of the literal rank map.
BUCKETS = 32_768
#: Stands for a pair that has no rank.
NONE = 2**31 - 1
#: More than the places in a word of ``LONG`` bytes.
PLACES = 2**16


def read_ranks(name: str) -> dict[bytes, int]:
    """Ranks by piece from a file of the driver; ``name`` is a file name of the public vocabularies or a path."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


def _class(points: list[int]) -> str:
    """Ascending code points as a character class, entered only from the first of them on: a cheap test for others."""
    if not points:
        return ""
    runs: list[list[int]] = []
    for p in points:
        if runs and p == runs[-1][1] + 1:
            runs[-1][1] = p
        else:
            runs.append([p, p])
    ranges = "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in runs)
    return f"[\\x{{{points[0]:X}}}-\\x{{10FFFF}}&&[{ranges}]]"


@functools.cache
def jvm_pattern(spark: SparkSession) -> str:
    """``PATTERN`` for the JVM, whose Unicode tables are older than the encoder library's.

    Letters and numbers that only the library knows are added to the classes; both sides are asked about every
    code point.
    """
    import tiktoken

    points = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    table = spark.createDataFrame([(points,)], "points string")
    extra = {}
    for kind in ("L", "N"):
        library = tiktoken.Encoding(
            "classes", pat_str=rf"\p{{{kind}}}", mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
        known = library.decode(library.encode_ordinary(points))
        ours = table.select(F.array_join(F.regexp_extract_all("points", F.lit(rf"\p{{{kind}}}"), F.lit(0)), "")).first()[0]
        extra[kind] = _class(sorted(map(ord, set(known) - set(ours))))
    letters, numbers = rf"[\p{{L}}{extra['L']}]", rf"[\p{{N}}{extra['N']}]"
    other = rf"[^\s\p{{L}}\p{{N}}{extra['L']}{extra['N']}]"
    own = PATTERN.replace(r"[^\s\p{L}\p{N}]", other)
    own = own.replace(r" ?\p{L}+", f" ?{letters}+").replace(r" ?\p{N}+", f" ?{numbers}+")
    return "(?U)" + own


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once."""
    return F.transform(F.array(value), use)[0]


def _rank(piece: Column, table: Column) -> Column:
    bucket = F.get(table, (F.crc32(piece.cast("binary")) % BUCKETS).cast("int"))
    return F.coalesce(F.try_element_at(bucket, piece), F.lit(NONE))


def _merged(digits: Column, table: Column) -> Column:
    """Ids of a word from the digits of its bytes.

    The state of the fold are the cuts between pieces, from left to right, each as the rank of what its removal would
    join, and its place behind that. The least of them is the next to go; its neighbours get new ranks.
    """
    size = (F.length(digits) / 2).cast("int")

    def piece(start: Column, end: Column) -> Column:
        return F.substring(digits, 2 * start + 1, 2 * (end - start))

    def place(cuts: Column, i: Column) -> Column:
        """Place of the i-th cut; before the first and after the last are the ends of the word."""
        return F.coalesce((F.get(cuts, i) % PLACES).cast("int"), F.when(i < 0, F.lit(0)).otherwise(size))

    def entry(start: Column, at: Column, end: Column) -> Column:
        return _rank(piece(start, end), table).cast("bigint") * PLACES + at

    def removed(cuts: Column, least: Column) -> Column:
        return F.filter(F.transform(cuts, lambda cut, i: F.when(cut == least, F.lit(None)).when(
            F.get(cuts, i + 1) == least, entry(place(cuts, i - 1), place(cuts, i), place(cuts, i + 2))).when(
            F.get(cuts, i - 1) == least, entry(place(cuts, i - 2), place(cuts, i), place(cuts, i + 1))).otherwise(cut),
        ), lambda cut: cut.isNotNull())

    def step(cuts: Column, _: Column) -> Column:
        # The least is found by value: array_position leaves its loop by an exception, which costs more than the loop.
        return F.when(F.array_min(cuts) < NONE * PLACES, _let(F.array_min(cuts), lambda least: removed(cuts, least))
                      ).otherwise(cuts)

    def pieces(cuts: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(cuts)),
                           lambda i: _rank(piece(place(cuts, i - 1), place(cuts, i)), table))

    inner = F.when(size > 1, F.sequence(F.lit(1), size - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(inner, F.transform(inner, lambda i: entry(i - 1, i, i + 1)), step, pieces)


class Ranks:
    """Column expressions over a vocabulary; pieces are written in hexadecimal digits."""

    def __init__(self, ranks: dict[bytes, int]):
        self.by_piece = ranks
        buckets: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
        by_id = [""] * (max(ranks.values(), default=-1) + 1)
        for piece, rank in ranks.items():
            buckets[zlib.crc32(piece.hex().encode()) % BUCKETS][piece.hex()] = rank
            by_id[rank] = piece.hex()
        # Both are constant expressions: the optimizer turns them into literals.
        self._buckets = F.from_json(F.lit(json.dumps(buckets, separators=(",", ":"))), "array<map<string,int>>")
        self._pieces = F.split(F.lit(",".join(by_id)), ",")

    def merged(self, word: Column) -> Column:
        """Ids of a word, by the fold."""
        digits = F.lower(F.hex(word.cast("binary")))
        return _let(self._buckets, lambda table: _let(digits, lambda own: _merged(own, table)))

    def whole(self, spark: SparkSession) -> DataFrame:
        """Rows (word, id) of the pieces that are texts: as many as the vocabulary has at most."""
        texts = []
        for piece, rank in self.by_piece.items():
            with contextlib.suppress(UnicodeDecodeError):
                texts.append((piece.decode(), rank))
        return spark.createDataFrame(texts, "word string, id int")

    def decoded(self, ids: Column) -> Column:
        """Bytes of an array of ids."""
        return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(self._pieces, i)), ""))


def heap_merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: pairs wait in a heap by (rank, place); outdated ones are passed over."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    stop, before = list(range(1, n + 1)), list(range(-1, n - 1))  # a live piece starts at i and ends at stop[i]
    live = [True] * n

    def pair(i: int) -> tuple[int, int, int] | None:
        if i < 0 or stop[i] >= n:
            return None
        end = stop[stop[i]]
        rank = ranks.get(word[i:end])
        return None if rank is None else (rank, i, end)

    heap = [p for p in map(pair, range(n)) if p]
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        if not live[i] or stop[i] >= n or stop[stop[i]] != end:
            continue
        live[stop[i]] = False
        stop[i] = end
        if end < n:
            before[end] = i
        for p in (pair(before[i]), pair(i)):
            if p:
                heapq.heappush(heap, p)
    return [ranks[word[i:stop[i]]] for i in range(n) if live[i]]


#: Parts that the words are dealt to by their bytes.
PARTS = 512
#: Bytes of words of all shards after which a task works on what it has of a part; a word met again later is folded again.
MET_BYTES = 64 << 20
#: Where the words of a part came from: the shards, how many each sent, and which word each of those is.
SOURCES = pa.struct([("part", pa.int32()), ("shards", pa.binary()), ("counts", pa.binary()), ("codes", pa.binary())])
#: Rows of an Arrow batch handed on.
HANDED_ROWS = 10_000
#: Words of texts whose ids a task has in memory at a time, and the rest of the last text.
GATHERED_CELLS = 250_000


def _met(number: int, part: int, shards: list[int], lists: list[bytes]) -> Iterator[pa.RecordBatch]:
    words, counts = unpacked_words(lists)
    coded = words.dictionary_encode()
    sources = {"part": part, "shards": np.array(shards, "<i8").tobytes(), "counts": counts.astype("<i8").tobytes(),
               "codes": coded.indices.to_numpy().astype("<i4").tobytes()}
    names = ["number", "place", "sources", "word"]
    yield pa.RecordBatch.from_arrays([
        pa.array([number], pa.int32()), pa.array([-1], pa.int32()), pa.array([sources], SOURCES), pa.nulls(1, pa.string())], names)
    n = len(coded.dictionary)
    rows = pa.RecordBatch.from_arrays([
        pa.array(np.full(n, number, "i4")), pa.array(np.arange(n, dtype="i4")), pa.nulls(n, SOURCES), coded.dictionary], names)
    for i in range(0, n, HANDED_ROWS):
        yield rows.slice(i, HANDED_ROWS)


def _meet(most: int):
    """Distinct words of each part, a row each, and a row that says where they came from. Lists arrive by part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, now, shards, lists, size = 0, None, [], [], 0
        for batch in batches:
            for shard, part, words in zip(*(batch[c].to_pylist() for c in ("shard", "part", "words"))):
                if lists and (part != now or size >= most):
                    yield from _met(number, now, shards, lists)
                    number, shards, lists, size = number + 1, [], [], 0
                now = part
                shards.append(shard)
                lists.append(words)
                size += zstandard.frame_content_size(words)
        if lists:
            yield from _met(number, now, shards, lists)

    return run


def _answers(held: list[pa.RecordBatch], ranks: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """Ids of the words that each shard sent, in the order it sent them."""
    table = pa.Table.from_batches(held)
    place = table["place"].to_numpy()
    table = table.take(pa.array(np.argsort(place, kind="stable"))).combine_chunks()
    sources, table = table["sources"][0].as_py(), table.slice(1)
    shards, counts, codes = (np.frombuffer(sources[c], t) for c, t in (
        ("shards", "<i8"), ("counts", "<i8"), ("codes", "<i4")))
    value, at = table["value"].combine_chunks(), np.arange(len(table))
    if value.null_count:  # words of many bytes
        missing = value.is_null().to_numpy(zero_copy_only=False)
        own = [heap_merge(w.encode(), ranks) for w in table["word"].filter(pa.array(missing)).to_pylist()]
        at[missing] = len(table) + np.arange(len(own))
        value = pa.concat_arrays([value, pa.array(own, value.type)])
    value = value.take(pa.array(at[codes]))
    offsets, ids = value.offsets.to_numpy(), value.values.to_numpy()
    ends = np.cumsum(counts)
    for shard, begin, end in zip(shards.tolist(), (ends - counts).tolist(), ends.tolist()):
        own = offsets[begin:end + 1]
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int64()), pa.array([sources["part"]], pa.int32()),
             *[pa.array([packed(v)], pa.binary()) for v in (np.diff(own), ids[own[0]:own[-1]])]],
            names=["shard", "part", "length", "ids"])


def _answer(ranks: dict[bytes, int]):
    """Packed ids for each packed list of words: rows of one number lie together, whatever their order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for batch in batches:
            number = batch["number"].to_numpy()
            cuts = np.flatnonzero(np.concatenate([number[:1] == number[:1], number[1:] != number[:-1]])).tolist()
            for a, b in zip(cuts, [*cuts[1:], len(number)]):
                if held and number[a] != now:
                    yield from _answers(held, ranks)
                    held = []
                now = number[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield from _answers(held, ranks)

    return run


def encoded(lists: DataFrame, ranks: Ranks, long: int = LONG, most: int = MET_BYTES) -> DataFrame:
    """Packed ids (shard, part, length, ids) of packed words (shard, part, words); a word that comes often is folded once.

    Only packed lists are sent between tasks: words to the task of their part, and their ids back to the shards.
    """
    width = F.octet_length("word")
    dealt = lists.repartition(shuffle_width(lists), "part").sortWithinPartitions("part", "shard")
    met = dealt.mapInArrow(_meet(most), "number int, place int, "
                           "sources struct<part:int,shards:binary,counts:binary,codes:binary>, word string")
    whole = F.broadcast(ranks.whole(lists.sparkSession))  # the vocabulary, a fixed size
    own = F.when(F.col("id").isNotNull(), F.array("id")).when(width <= long, ranks.merged(F.col("word")))
    found = met.join(whole, "word", "left").select(
        "number", "place", "sources", own.alias("value"), F.when(width > long, F.col("word")).alias("word"))
    return found.mapInArrow(_answer(ranks.by_piece), "shard bigint, part int, length binary, ids binary")


def _known(parts: list[dict]) -> pa.ListArray:
    """Ids of a shard's words in order, from the packed parts."""
    parts = sorted(parts, key=lambda p: p["part"])
    length, ids = (np.concatenate([unpacked(p[c]) for p in parts]) if parts else np.zeros(0, "i4")
                   for c in ("length", "ids"))
    return listed(pa.array(ids), length)


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of each row of a shard: the ids of its words, one after the other."""
    for batch in batches:
        for s in range(batch.num_rows):
            rows, lengths = batch["rows"][s].values, batch["lengths"][s].values.to_numpy(zero_copy_only=False)
            if rows is None or not len(rows):
                continue
            known, places = _known(batch["parts"][s].as_py() or []), unpacked(batch["places"][s].as_py())
            ends = np.concatenate([[0], np.cumsum(lengths)])
            turn = ends[:-1] // GATHERED_CELLS
            first = np.flatnonzero(np.concatenate([[True], turn[1:] != turn[:-1]])).tolist()
            for a, b in zip(first, [*first[1:], len(rows)]):
                ids = known.take(pa.array(places[ends[a]:ends[b]]))
                bounds = ids.offsets.to_numpy()[ends[a:b + 1] - ends[a]]
                yield pa.RecordBatch.from_arrays(
                    [rows.field("id").slice(a, b - a), listed(ids.flatten(), np.diff(bounds))], names=["id", "ids"])


def encode(
    docs: DataFrame, ranks: Ranks, id_col: str = "doc_id", text: str = "text", long: int = LONG,
    shard_bytes: int = SHARD_BYTES, met_bytes: int = MET_BYTES,
) -> DataFrame:
    """Rows (``id_col``, ids array<int>): each text's ids, without special tokens."""
    matches = F.regexp_extract_all(text_of(text), F.lit(jvm_pattern(docs.sparkSession)), F.lit(0))
    rows = docs.select(F.struct(F.col(f"`{id_col}`").alias("id")).alias("row"), matches.alias("words"))
    shards = word_shards(rows, counted=False, shard_bytes=shard_bytes, parts=PARTS)
    found = encoded(parted(shards), ranks, long, met_bytes)
    own = found.groupBy("shard").agg(F.collect_list(F.struct("part", "length", "ids")).alias("parts"))  # one shard's words
    filled = shards.drop("words").join(own, "shard", "left")
    kind = docs.schema[id_col].dataType.simpleString()
    found = filled.select("rows", "lengths", "places", "parts").mapInArrow(
        lambda batches: trimmed(_gather(batches)), f"id {kind}, ids array<int>")
    return found.withColumnRenamed("id", id_col)
