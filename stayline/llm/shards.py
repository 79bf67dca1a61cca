"""Documents in shards: each shard holds its own distinct words once and its documents as places in that list.

A word's value (an id, its token ids) is worked out once for the whole table and joined to the shards that hold the
word: a word that occurs everywhere costs one row per shard, not one per occurrence. Shards are cut at a number of
bytes, so neither a shard nor the values joined to it grow with the table. Where words need not be rows, a shard keeps
and sends them as compressed lists, one for each of a fixed number of parts.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayline.llm.common import shuffle_width, small_batches
from stayline.session import materialise, new_path

# Task functions travel with their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of words after which a shard is closed.
SHARD_BYTES = 16 << 20
#: Ends a word in a packed list: no byte of UTF-8.
END = 0xFF
MIX = np.uint64(0x9E3779B97F4A7C15)


def packed(values: np.ndarray, kind: str = "<i4") -> bytes:
    """Numbers as byte planes, zstandard: of small numbers the upper planes are all but empty."""
    planes = np.ascontiguousarray(values, kind).view("u1").reshape(-1, np.dtype(kind).itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes, kind: str = "<i4") -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "u1").reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def _bytes_of(words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all words and the bounds of each."""
    bounds = np.frombuffer(words.buffers()[1], "<i4")[words.offset:words.offset + len(words) + 1]
    return np.frombuffer(words.buffers()[2] or b"", "u1")[bounds[0]:bounds[-1]], bounds - bounds[0]


def word_parts(words: pa.StringArray, parts: int) -> np.ndarray:
    """A part for each word, by its bytes alone: a word has the same one in every shard."""
    if not len(words):
        return np.zeros(0, "i8")
    data, bounds = _bytes_of(words)
    lengths = np.diff(bounds)
    place = np.arange(len(data)) - np.repeat(bounds[:-1], lengths)
    terms = (data + np.uint64(1)) * np.cumprod(np.full(lengths.max(), MIX))[place]
    sums = np.concatenate([np.zeros(1, "u8"), np.cumsum(terms)])  # modulo 2^64, as are their differences
    mixed = sums[bounds[1:]] - sums[bounds[:-1]]
    mixed = (mixed ^ (mixed >> np.uint64(32))) * MIX
    return ((mixed >> np.uint64(32)) % np.uint64(parts)).astype("i8")


def _packed_words(words: pa.StringArray, part: np.ndarray) -> pa.StructArray:
    """Words in order of ``part`` as one compressed list per part."""
    data, bounds = _bytes_of(words)
    data = np.insert(data, bounds[1:], END)
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(part)), bool), part[1:] != part[:-1]]))
    compress = zstandard.ZstdCompressor(level=3).compress
    cuts = [*(bounds[first] + first).tolist(), len(data)]  # each word before has its end mark
    lists = [compress(data[a:b].tobytes()) for a, b in zip(cuts, cuts[1:])]
    return pa.StructArray.from_arrays(
        [pa.array(part[first], pa.int32()), pa.array(lists, pa.binary())], names=["part", "words"])


def unpacked_words(lists: list[bytes]) -> tuple[pa.StringArray, np.ndarray]:
    """The words of several packed lists, one after the other, and how many each list has."""
    decompress = zstandard.ZstdDecompressor().decompress
    plain = [np.frombuffer(decompress(b), "u1") for b in lists]
    data = np.concatenate(plain)
    ends = data == END
    stops = np.flatnonzero(ends)
    bounds = np.concatenate([[0], stops - np.arange(len(stops))]).astype("<i4")
    words = pa.StringArray.from_buffers(len(stops), pa.py_buffer(bounds), pa.py_buffer(data[~ends]))
    return words, np.diff(np.searchsorted(stops, np.cumsum([0, *map(len, plain)])))


def trimmed(made: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hands on ``made``. Memory that is free after each batch goes back to the system: idle workers would keep it."""
    def trim() -> None:
        for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
            pool.release_unused()

    for batch in made:
        yield batch
        del batch
        trim()
    trim()


def _dealt(df: DataFrame, name: str) -> DataFrame:
    """``df`` stored in buckets by shard, so that joining values to the shards moves the values only."""
    spark = df.sparkSession
    path = new_path(spark, name)
    table = f"{name}_{path[-12:]}"
    df.write.bucketBy(shuffle_width(df), "shard").options(path=path, compression="zstd").format("parquet").saveAsTable(table)
    return spark.table(table)


def listed(values: pa.Array, lengths: np.ndarray) -> pa.ListArray:
    """Consecutive runs of ``values`` as lists."""
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype("int32")
    return pa.ListArray.from_arrays(pa.array(ends), values)


def ascii_words(texts: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
    """Runs of bytes that are no ASCII white space, of all texts, and how many each text has."""
    data, bounds = _bytes_of(texts)
    solid = (data != 32) & ((data < 9) | (data > 13))
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    heads = bounds[:-1][bounds[:-1] < bounds[1:]]  # a word also begins where its text does
    begins[heads] = solid[heads]
    starts = np.flatnonzero(begins)
    before = np.cumsum(solid, dtype="<i4")
    ends = np.append(before[starts] - 1, before[-1:] if len(before) else 0).astype("<i4")
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(data[solid]))
    return words, np.diff(np.searchsorted(starts, bounds))


def _shard(number: int, held: list[pa.RecordBatch], counted: bool, parts: int) -> pa.RecordBatch:
    table = pa.Table.from_batches(held).combine_chunks()
    rows, words = table["row"].combine_chunks(), table["words"].combine_chunks()
    if pa.types.is_string(words.type):
        words, lengths = ascii_words(words)
    else:
        words, lengths = words.flatten(), np.diff(words.offsets.to_numpy())
    coded = words.dictionary_encode()
    order = pc.array_sort_indices(coded.dictionary).to_numpy()  # neighbours in order store well
    if parts:
        part = word_parts(coded.dictionary, parts)[order]
        by_part = np.argsort(part, kind="stable")
        order, part = order[by_part], part[by_part]
    rank = np.empty(len(order), "i4")
    rank[order] = np.arange(len(order))
    places, distinct = rank[coded.indices.to_numpy(zero_copy_only=False)], coded.dictionary.take(pa.array(order))
    counts = None
    if counted:
        width = max(1, len(distinct))
        cells, counts = np.unique(np.repeat(np.arange(len(lengths)), lengths) * width + places, return_counts=True)
        lengths, places = np.bincount(cells // width, minlength=len(lengths)), cells % width
    stored = _packed_words(distinct, part) if parts else distinct
    return pa.RecordBatch.from_arrays([
        pa.array([number], pa.int64()), listed(rows, np.array([len(rows)])),
        listed(pa.array(lengths.astype("int32")), np.array([len(lengths)])),
        pa.array([packed(places)], pa.binary()), pa.array([None if counts is None else packed(counts)], pa.binary()),
        listed(stored, np.array([len(stored)])),
    ], names=["shard", "rows", "lengths", "places", "counts", "words"])


def word_shards(rows: DataFrame, counted: bool, shard_bytes: int = SHARD_BYTES, parts: int = 0) -> DataFrame:
    """Stored shards of ``rows`` (row struct, words array<string>, or string: words parted by ASCII white space).

    Columns: shard, rows (the structs), lengths (cells per row), places (cells as places in ``words``), counts,
    words. A cell is an occurrence of a word, in order; ``counted``, it is a distinct word of the row with its count.
    With ``parts``, words are parted by their bytes, in ascending order of the parts, and a part is one packed list.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= shard_bytes:
                yield _shard(number, held, counted, parts)
                number, held, size = number + 1, [], 0
        if size:
            yield _shard(number, held, counted, parts)

    row = rows.schema["row"].dataType.simpleString()
    word = "struct<part:int,words:binary>" if parts else "string"
    schema = (f"shard bigint, rows array<{row}>, lengths array<int>, places binary, counts binary, words array<{word}>")
    with small_batches(rows.sparkSession):
        return _dealt(rows.select("row", "words").mapInArrow(lambda batches: trimmed(cut(batches)), schema), "shards")


def places(shards: DataFrame) -> DataFrame:
    """Rows (shard, place, word): each distinct word of each shard."""
    return shards.select("shard", F.posexplode("words").alias("place", "word"))


def parted(shards: DataFrame) -> DataFrame:
    """Rows (shard, part, words): each packed list of each shard."""
    return shards.select("shard", F.explode("words").alias("list")).select("shard", "list.*")


def gathered(shards: DataFrame, found: DataFrame) -> DataFrame:
    """Shards with ``values``: what ``found`` (shard, place, value) has for each of their words, in order."""
    own = found.groupBy("shard").agg(  # one shard's words
        F.sort_array(F.collect_list(F.struct("place", "value"))).getField("value").alias("values"))
    return shards.drop("words").join(own, "shard", "left")


def _numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers words that arrive in order; ``word`` stays in the first row of each."""
    number, last = (TaskContext.get().partitionId() << 33) - 1, None
    for batch in batches:
        words = batch["word"]
        if not len(words):
            continue
        new = np.ones(len(words), bool)
        new[1:] = pc.not_equal(words[1:], words[:-1]).to_numpy(zero_copy_only=False)
        new[0] = words[0].as_py() != last
        last = words[-1].as_py()
        value = number + np.cumsum(new)
        number = int(value[-1])
        yield pa.RecordBatch.from_arrays(
            [batch["shard"], batch["place"], pa.array(value), pc.if_else(pa.array(new), words, pa.scalar(None, words.type))],
            names=["shard", "place", "value", "word"])


def numbered(shards: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Dense numbers from 0 for the words of all shards: rows (shard, place, value), and the dictionary (word, value).

    Words meet once, in order, and are stored with their numbers, which so stay the same whatever is read again.
    """
    met = places(shards)
    ordered = met.repartition(shuffle_width(met), "word").sortWithinPartitions("word")
    stored = materialise(ordered.mapInArrow(_numbers, "shard bigint, place int, value bigint, word string"), "numbers")
    part = F.shiftright("value", 33)  # the upper bits name the task
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored.where("word is not null").groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))  # one row per task
    dense = stored.withColumn("part", part).join(F.broadcast(starts), "part").withColumn(
        "value", F.col("start") + F.col("value").bitwiseAND(2**33 - 1))
    return dense.select("shard", "place", "value"), dense.where("word is not null").select("word", "value")
