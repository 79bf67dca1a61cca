"""Audit of five document filters: what each removes, alone and after the others, in every order.

The words of all documents become a sparse document-term matrix: a dictionary numbers the words of the whole table, and
shards in compressed-row form hold, per document, the numbers of its words and their counts. A row's sum is its number
of words and its number of cells that of its distinct words; from those come the filters A (too short) and B (too
repetitive). C (capitals), D (markup) and E (copy of an earlier document) are attached, documents fold to counts per
part and set of failed filters, and the orders are worked out from those counts.

A null text is empty, a null source is the part "". A null id is neither smaller nor larger than another, so such a row
fails no E and has no labels; rows that share an id and a text fail no E because of each other. A document is good or
toxic if any of its labels says so. An empty table has no parts and gives no rows. Only the id, text and source are
read, so other columns may be called anything.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, Sequence
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.llm.common import small_batches, text_of
from stayline.llm.shards import gathered, listed, numbered, packed, unpacked, word_shards
from stayline.session import materialise

# Task functions travel with their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of text in a shard: what a task holds several times over while it counts words.
SHARD_BYTES = 12 << 20
FILTERS = "ABCDE"
#: What the filters ask for.
MIN_WORDS, MIN_DISTINCT_PCT, MAX_CAPITALS_PCT, MARKUP = 50, 65, 5, "[#$%&*|]"

def _matrix_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shards with the dictionary's numbers."""
    for batch in batches:
        for s in range(batch.num_rows):
            lengths = batch["lengths"][s].values.to_numpy(zero_copy_only=False)
            numbers = batch["values"][s].values
            terms = np.zeros(0, "int64")
            if numbers is not None:
                terms = numbers.to_numpy(zero_copy_only=False)[unpacked(batch["places"][s].as_py())]
            starts = np.concatenate([[0], np.cumsum(lengths)])
            yield pa.RecordBatch.from_arrays([
                batch["shard"].slice(s, 1), batch["rows"].slice(s, 1), listed(pa.array(starts), np.array([len(starts)])),
                pa.array([packed(terms, "<i8")], pa.binary()), batch["counts"].slice(s, 1),
            ], names=["shard", "rows", "starts", "terms", "counts"])


def document_term_matrix(rows: DataFrame, shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, DataFrame]:
    """The stored matrix and dictionary of ``rows`` (row struct, words as ``word_shards`` takes them).

    Matrix, one row per shard: shard, rows (the structs), starts (the first cell of each row, and the end), terms and
    counts (of each cell, as ``shards.unpacked`` reads them: 64-bit numbers and 32-bit counts). Dictionary: word, value;
    numbers are dense.
    """
    shards = word_shards(rows, counted=True, shard_bytes=shard_bytes)
    values, dictionary = numbered(shards)
    row = rows.schema["row"].dataType.simpleString()
    schema = f"shard bigint, rows array<{row}>, starts array<bigint>, terms binary, counts binary"
    with small_batches(rows.sparkSession, 1):
        matrix = materialise(gathered(shards, values).mapInArrow(_matrix_rows, schema), "matrix")
    return matrix, dictionary


def _row_sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for s in range(batch.num_rows):
            rows = batch["rows"][s].values
            starts = batch["starts"][s].values.to_numpy(zero_copy_only=False)
            sums = np.concatenate([[0], np.cumsum(unpacked(batch["counts"][s].as_py()), dtype="i8")])
            yield pa.RecordBatch.from_arrays(
                [rows, pa.array(np.diff(sums[starts])), pa.array(np.diff(starts))], names=["row", "words", "distinct"])


def row_sizes(matrix: DataFrame) -> DataFrame:
    """Rows (row, words, distinct): sum and number of cells of each row of the matrix."""
    row = matrix.schema["rows"].dataType.elementType.simpleString()
    return matrix.select("rows", "starts", "counts").mapInArrow(
        _row_sizes, f"row {row}, words bigint, distinct bigint")


def flagged(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Rows (id, part, digest, words, distinct, fails): ``fails`` has a bit for each of A to D."""
    value = text_of(text)
    row = F.struct(
        F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{source}`").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(value, 256)).alias("digest"),
        (100 * F.length(F.regexp_replace(value, "[^A-Z]+", "")) > MAX_CAPITALS_PCT * F.length(value)).alias("capitals"),
        value.rlike(MARKUP).alias("markup"))
    rows = docs.select(row.alias("row"), value.alias("words"))
    matrix, _ = document_term_matrix(rows, shard_bytes)
    short = F.col("words") < MIN_WORDS
    dull = 100 * F.col("distinct") < MIN_DISTINCT_PCT * F.col("words")
    bits = [flag.cast("int") * 2**i for i, flag in enumerate([short, dull, F.col("row.capitals"), F.col("row.markup")])]
    return row_sizes(matrix).select("row.id", "row.part", "row.digest", "words", "distinct", sum(bits).alias("fails"))


def _with_copies(rows: DataFrame) -> DataFrame:
    """Counts per part, set of failed filters with E, and label. ``rows`` has one row per document."""
    # Equal texts fold before they meet: per id first, then per part and labels, and only those by text.
    same = ["digest", "part", "fails", "good", "toxic"]
    per_id = rows.groupBy("id", *same).agg(F.count(F.lit(1)).alias("n"))
    known = F.col("id").isNotNull()
    folded = per_id.groupBy(*same).agg(
        F.sum("n").alias("n"), F.sum(F.when(known, 0).otherwise(F.col("n"))).alias("nameless"),
        F.min(F.when(known, F.struct("id", "n"))).alias("least"))
    smallest = F.min("least.id").over(Window.partitionBy("digest"))  # as many rows as parts and labels hold the text
    first = F.when(F.col("least.id") == F.col("smallest"), F.col("least.n")).otherwise(0)
    split = folded.withColumn("smallest", smallest).withColumn("firsts", first + F.col("nameless"))
    both = F.explode(F.array(
        F.struct(F.col("fails"), F.col("firsts").alias("n")),
        F.struct((F.col("fails") + 16).alias("fails"), (F.col("n") - F.col("firsts")).alias("n"))))
    counts = split.select("part", "good", "toxic", both.alias("c")).select("part", "good", "toxic", "c.*")
    return counts.groupBy("part", "fails", "good", "toxic").agg(F.sum("n").alias("n"))


def audit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """One row per part, order of the filters and step; see the module's text."""
    rows = flagged(docs, id_col, text, source, shard_bytes)
    marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("of")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    named = rows.where("id is not null").join(marks, F.col("id") == F.col("of"), "left").select(
        *rows.columns, *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")])
    nameless = rows.where("id is null").select("*", F.lit(False).alias("good"), F.lit(False).alias("toxic"))
    counts = _with_copies(named.unionByName(nameless))

    def left_after(kept: Column) -> Column:
        """Documents that fail none of a set of filters, for every set."""
        return F.array(*[F.sum(F.when(F.col("fails").bitwiseAND(s) == 0, kept).otherwise(0)) for s in range(32)])

    one = F.col("n")
    per_part = counts.groupBy("part").agg(
        left_after(one).alias("all"), left_after(F.when(F.col("good"), one).otherwise(0)).alias("good"),
        left_after(F.when(F.col("toxic"), one).otherwise(0)).alias("toxic"))

    def gone(of: str, before: Column, bit: Column) -> Column:
        return F.get(of, before) - F.get(of, before.bitwiseOR(bit))

    # A filter's removals over all orders: each set of others stands before it in |set|! (4 - |set|)! orders.
    def over_orders(bit: int) -> Column:
        others = [s for s in range(32) if not s & bit]
        return sum(
            F.lit(factorial(s.bit_count()) * factorial(4 - s.bit_count())) * gone("all", F.lit(s), F.lit(bit))
            for s in others)

    per_part = per_part.withColumn("shares", F.array(*[over_orders(1 << i) for i in range(5)]))
    steps = F.from_json(
        F.lit(json.dumps(_steps(FILTERS))), "array<struct<filter_order:string,step:int,filter:int,bit:int,before:int>>")
    before, bit = F.col("s.before"), F.col("s.bit")
    return per_part.withColumn("s", F.explode(steps)).select(
        "part", F.col("s.filter_order").alias("filter_order"), F.col("s.step").alias("step"),
        F.get("all", before.bitwiseOR(bit)).alias("kept"), gone("all", before, bit).alias("removed"),
        (gone("all", F.lit(0), bit) - gone("all", before, bit)).alias("redundant"),
        gone("all", F.lit(31) - bit, bit).alias("unique_fails"),
        gone("good", before, bit).alias("good_lost"), gone("toxic", before, bit).alias("toxic_lost"),
        F.get("shares", F.col("s.filter")).alias("shapley"))


def _steps(filters: Sequence[str]) -> list[dict]:
    """Every step of every order: the filter's place and bit, and the bits of those before it."""
    found = []
    for order in permutations(range(len(filters))):
        before = 0
        for step, i in enumerate(order, 1):
            found.append({"filter_order": "".join(filters[j] for j in order), "step": step, "filter": i,
                          "bit": 1 << i, "before": before})
            before |= 1 << i
    return found
