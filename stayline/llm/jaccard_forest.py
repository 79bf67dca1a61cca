"""N-gram Jaccard join with MinHash bands of one depth and exact verification.

Every document becomes its set of five-word shingles (hashed to 64 bits); documents with equal sets
form a class, and everything after works on classes. A class has ``TREES`` signatures of ``DEPTH``
MinHash values, one per tree. The depth of the prefixes is set before any data is read: the largest at
which two sets at the threshold meet in some tree with the target recall. Classes with the same prefix
meet by its hash; there is no sorted trie and no shortening per bucket. Classes that meet are linked to the first class of
their bucket, never pairwise, and the connected parts of these links are verified exactly: the sizes
of all intersections inside a part come from products of 0/1 matrices, block by block. Only counts and
a spanning link per class leave a block, so a large group of near copies costs no row per pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm.common import boxed, boxed_text, join_on, keyed, shuffle_width, small_batches
from stayline.llm.components import components
from stayline.session import materialise

WORDS = 5
THRESHOLD = (4, 5)  # a link needs intersection / union of at least 4 / 5
TREES = 32
DEPTH = 8
RECALL = 0.9999
#: Classes per block of the verification; a task holds two blocks.
BLOCK = 128
_SEED = 20_240_607
_PRIME = np.uint64(0x9E3779B97F4A7C15)  # odd, so that its powers have inverses modulo 2**64


def prefix_depth(recall: float = RECALL, trees: int = TREES, depth: int = DEPTH, threshold: float | None = None) -> int:
    """Shorten the prefix from ``depth`` until sets at the threshold meet in a tree with ``recall``."""
    s = THRESHOLD[0] / THRESHOLD[1] if threshold is None else threshold
    while depth > 1 and 1 - (1 - s**depth) ** trees < recall:
        depth -= 1
    return depth


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers: list[np.ndarray] = []


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the prime and of its inverse, modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 16)
        inverse = np.uint64(pow(int(_PRIME), -1, 1 << 64))
        _powers[:] = [np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, p, np.uint64)]), dtype=np.uint64)
                      for p in (_PRIME, inverse)]
    return _powers[0], _powers[1]


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words: runs of letters, digits, underscores and non-ASCII characters, in lower case."""
    data = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)
    if not len(data):
        return np.empty(0, np.uint64)
    inside = ((data >= 97) & (data <= 122)) | ((data >= 48) & (data <= 57)) | (data >= 128) | (data == 95)
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]])))
    starts, ends = edge[::2], edge[1::2]
    power, inverse = _power_table(len(data) + 1)
    with np.errstate(over="ignore"):
        sums = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)])])
        return _mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Shingle hashes in order; a text of fewer words is one shingle, a text without words has none."""
    return shingles_of(word_hashes(text), words)


def shingles_of(hashed: np.ndarray, words: int = WORDS) -> np.ndarray:
    """``shingles`` of a text whose word hashes are known."""
    if not len(hashed):
        return hashed
    n = min(words, len(hashed))
    with np.errstate(over="ignore"):
        total = np.full(len(hashed) - n + 1, np.uint64(n))
        for i in range(n):
            total = _mix(total * _PRIME + hashed[i : len(hashed) - n + 1 + i])
    return total


def shingle_set(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    return np.unique(shingles(text, words))


_factors = np.random.default_rng(_SEED).integers(0, 1 << 63, (TREES * DEPTH, 2), dtype=np.uint64)
_FACTOR, _SHIFT = _factors[:, 0] * np.uint64(2) + np.uint64(1), _factors[:, 1]


def signature(shingles: np.ndarray) -> np.ndarray:
    """MinHash values, ``TREES`` rows of ``DEPTH``."""
    best = np.full(TREES * DEPTH, np.iinfo(np.uint32).max, np.uint32)
    with np.errstate(over="ignore"):
        for at in range(0, len(shingles), 512):  # bounded memory for long texts
            part = shingles[at : at + 512, None] * _FACTOR + _SHIFT
            np.minimum(best, (part >> np.uint64(32)).astype(np.uint32).min(0), out=best)
    return best.reshape(TREES, DEPTH)


def tree_keys(values: np.ndarray, depth: int) -> np.ndarray:
    """One signed 64-bit key per tree: the tree and the first ``depth`` values of its signature."""
    with np.errstate(over="ignore"):
        key = np.arange(1, TREES + 1, dtype=np.uint64)
        for i in range(depth):
            key = _mix(key * _PRIME + values[:, i].astype(np.uint64))
    return key.view(np.int64)


def _describe(docs: DataFrame, id_col: str, text: str, depth: int) -> DataFrame:
    """Rows (id, mark, digest, keys): digest of the shingle set, null without words; keys of its tree prefixes.

    ``mark`` tells rows with one id and different texts apart. Sets of fewer than four shingles have no
    keys: no other set can be similar enough.
    """

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, keys = [], []
            for value in batch.column(2).to_pylist():
                found = shingle_set(value)
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                keys.append(tree_keys(signature(found), depth) if len(found) >= THRESHOLD[0] else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(digests, "binary"), pa.array(keys, pa.list_(pa.int64()))],
                ["id", "mark", "digest", "keys"])

    rows = keyed(docs, id_col, text)
    kind = dict(rows.dtypes)["id"]
    with small_batches(docs.sparkSession):
        schema = f"id {kind}, mark bigint, digest binary, keys array<bigint>"
        return materialise(rows.mapInArrow(describe, schema), "sets")


def _intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections between two lists of sorted sets."""
    sizes = [len(s) for s in left] + [len(s) for s in right]
    owner = np.repeat(np.arange(len(sizes)), sizes)
    values, column, counts = np.unique(np.concatenate([*left, *right]), return_inverse=True, return_counts=True)
    shared = counts[column] > 1  # a shingle of one set only is in no intersection
    owner, column = owner[shared], np.unique(column[shared], return_inverse=True)[1]
    out = np.zeros((len(left), len(right)), np.float64)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    width = max(64, (1 << 22) // len(sizes))
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [at, at + width])
        table = np.zeros((len(sizes), width), np.float32)
        table[owner[a:b], column[a:b] - at] = 1
        out += table[: len(left)] @ table[len(left) :].T
    return out


def _spanning(similar: np.ndarray, names_a: np.ndarray, names_b: np.ndarray) -> dict[int, int]:
    """The smallest class each class of two blocks is connected to by their similar pairs."""
    rows, cols = np.nonzero(similar)
    names = np.concatenate([names_a, names_b])
    ends = np.stack([names_a[rows], names_b[cols]])
    label = {int(n): int(n) for n in names}

    def find(x: int) -> int:
        while label[x] != x:
            label[x] = label[label[x]]
            x = label[x]
        return x

    # One link per row and column already connects most; only links between different parts are joined.
    for a, b in {(int(a), int(b)) for a, b in ends.T}:
        ra, rb = find(a), find(b)
        if ra != rb:
            label[max(ra, rb)] = min(ra, rb)
    return {int(n): find(int(n)) for n in set(ends.ravel().tolist())}


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per group (part, a, b) of sorted rows: (k, links, root) for every class with a link in it."""
    num, den = THRESHOLD
    held: dict[int, tuple[int, int, np.ndarray]] = {}
    current = None

    def close() -> pa.RecordBatch | None:
        _, a, b = current
        sides = [{k: v for k, v in held.items() if v[0] == side} for side in (a, b)]
        if a == b:
            sides[1] = sides[0]
        if not sides[0] or not sides[1]:
            return None
        names = [np.array(list(s), np.int64) for s in sides]
        sets = [[v[2] for v in s.values()] for s in sides]
        weights = [np.array([v[1] for v in s.values()], np.int64) for s in sides]
        inter = _intersections(*sets)
        sizes = [np.array([len(x) for x in s]) for s in sets]
        union = sizes[0][:, None] + sizes[1][None, :] - inter
        similar = inter * den >= union * num
        if a == b:
            np.fill_diagonal(similar, False)
        if not similar.any():
            return None
        links: dict[int, int] = {}
        for k, n in zip(names[0].tolist(), (similar @ weights[1]).tolist(), strict=True):
            links[k] = n
        if a != b:
            for k, n in zip(names[1].tolist(), (weights[0] @ similar).tolist(), strict=True):
                links[k] = n
        roots = _spanning(np.triu(similar) if a == b else similar, *names)
        rows = [(k, n, roots[k]) for k, n in links.items() if n]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], "int64") for i in range(3)], ["k", "links", "root"])

    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True):
            part, a, b, k, block, n, data = row
            if current != (part, a, b):
                if held and (made := close()) is not None:
                    yield made
                held, current = {}, (part, a, b)
            held.setdefault(k, (block, n, np.frombuffer(data, "<u8")))
    if held and (made := close()) is not None:
        yield made


def join_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", recall: float = RECALL,
                block: int = BLOCK) -> DataFrame:
    """Per row: ``id_col, class_id, group_id, n_links, kept`` and ``_mark``.

    ``class_id`` is the smallest id with the same shingle set, ``group_id`` the smallest id connected by
    links, ``n_links`` the number of other rows with a similarity of at least 0.8 (rows of equal sets
    included), ``kept`` marks the rows that hold the group's id. A text without words (null, empty) is
    alone in its class and has no links. ``_mark`` is a hash of the text.
    """
    sets = _describe(docs, id_col, text, prefix_depth(recall))
    kind = dict(sets.dtypes)["id"]
    grouped = sets.where("digest is not null").groupBy("digest").agg(
        F.min(F.struct("id", "mark")).alias("first"), F.count(F.lit(1)).alias("n"), F.first("keys").alias("keys"))
    classes = materialise(grouped.withColumn("k", F.monotonically_increasing_id()), "classes")

    # Buckets: classes with a common prefix in some tree, linked to the first of them.
    spread = classes.where("keys is not null").select("k", F.explode("keys").alias("key"))
    buckets = spread.groupBy("key").agg(F.min("k").alias("a"), F.max("k").alias("_last")).where("a != _last")
    candidates = spread.join(buckets.select("key", "a"), "key").where("k != a").select("a", F.col("k").alias("b"))
    parts = components(candidates)
    width = materialise(parts.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / block).alias("blocks")), "parts")
    members = join_on(parts, width, ["root"]).select(
        F.col("node").alias("k"), F.col("root").alias("part"), "blocks",
        F.pmod(F.xxhash64("node"), "blocks").cast("int").alias("block"))
    members = members.join(classes.select("k", "first", "n", "digest"), "k").select(
        F.col("first.id").alias("id"), F.col("first.mark").alias("mark"), "k", "part", "blocks", "block", "n", "digest")

    # The sets of these classes are made again from their first texts, so only those are dealt out.
    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(t) for t in batch.column(6).to_pylist()]
            own = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in found]
            same = pa.array([a == b for a, b in zip(own, batch.column(5).to_pylist(), strict=True)])
            data = pa.array([s.astype("<u8").tobytes() for s in found], "binary")
            columns = [*batch.columns[:5], data]
            yield pa.RecordBatch.from_arrays(columns, ["part", "blocks", "block", "k", "n", "data"]).filter(same)

    texts = keyed(docs, id_col, text)
    wanted = join_on(texts, members, ["id", "mark"]).select("part", "blocks", "block", "k", "n", "digest", "text")
    made = wanted.mapInArrow(sets_of, "part bigint, blocks bigint, block int, k bigint, n bigint, data binary")
    other = F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))).alias("other")
    dealt = made.select("*", other).select(
        "part", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "k", "block", "n", "data")
    pairs = dealt.repartition(shuffle_width(docs), "part", "a", "b").sortWithinPartitions("part", "a", "b", "k")
    with small_batches(docs.sparkSession):
        verified = materialise(pairs.mapInArrow(_verify, "k bigint, links bigint, root bigint"), "verified")

    counts = verified.groupBy("k").agg(F.sum("links").alias("links"))
    groups = components(verified.select(F.col("root").alias("a"), F.col("k").alias("b")))
    named = classes.join(groups, F.col("k") == F.col("node"), "left").select(
        "k", "digest", "n", F.col("first.id").alias("class_id"), F.coalesce("root", "k").alias("group"))
    heads = named.groupBy("group").agg(F.min(F.struct("class_id")).alias("head"))
    named = named.join(heads, "group").join(counts, "k", "left").select(
        "digest", "class_id", F.col("head.class_id").alias("group_id"),
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.lit(True).alias("_in"))
    rows = sets.select("id", "mark", "digest").join(named, "digest", "left")
    own = lambda c: F.when(F.col("_in"), F.col(c)).otherwise(F.col("id")).cast(kind)
    return rows.select(
        F.col("id").alias(id_col), own("class_id").alias("class_id"), own("group_id").alias("group_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.col("id").eqNullSafe(own("group_id")).alias("kept"), F.col("mark").alias("_mark"))


def survivors(docs: DataFrame, id_col: str = "doc_id", text: str = "text", recall: float = RECALL) -> DataFrame:
    """One row of ``docs`` per group, with all its columns: that with the smallest id.

    Texts without words are in no group and all stay. Repeated rows with that id count as one.
    """
    decided = materialise(join_groups(docs, id_col, text, recall).where("kept"), "kept")
    decided = decided.select(F.col(f"`{id_col}`").alias("id"), F.col("_mark").alias("mark"))
    marked = boxed(docs).withColumn("id", F.col("doc")[id_col]).withColumn("mark", F.xxhash64(boxed_text(text)))
    kept = join_on(marked, decided.distinct(), ["id", "mark"])
    if not decided.groupBy("id", "mark").count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates(["id", "mark"])
    return kept.select("doc.*")
