"""Document fingerprints: a Merkle tree over sections and paragraphs.

A paragraph is a line with its line end; it is made of clauses (up to a punctuation mark and the white
space after it; longer ones are cut). Consecutive paragraphs form a section up to one whose hash ends
it, so an edit moves no later section border. Every node is the hash of its children, the root is the
fingerprint: equal texts have equal roots, and two trees are compared by descending only into branches
that differ. All characters of a text are in exactly one leaf.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayline.llm.common import shuffle_width, small_batches, text_of
from stayline.session import materialise

#: A clause is cut after this many characters.
LEAF_CHARS = 120
#: A section ends at a paragraph whose hash is divisible by this.
SECTION = 4
_LEAF = re.compile(rf"[^.,;:!?]{{1,{LEAF_CHARS}}}(?:[.,;:!?]+\s*)?|[.,;:!?]+\s*", re.DOTALL)


def _hash(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


@dataclass
class Tree:
    root: bytes
    sections: list[tuple[bytes, list[int]]]  # node, its paragraphs
    paragraphs: list[tuple[bytes, list[tuple[bytes, int]]]]  # node, its leaves (hash, characters)

    def leaves(self, sections: list[int]) -> Counter:
        found: Counter = Counter()
        for s in sections:
            for p in self.sections[s][1]:
                for leaf, n in self.paragraphs[p][1]:
                    found[leaf] += n
        return found

    def chars(self) -> int:
        return sum(n for _, leaves in self.paragraphs for _, n in leaves)


def tree(text: str) -> Tree:
    paragraphs, sections, members = [], [], []
    for line in re.findall(r"[^\n]*\n|[^\n]+", text):
        leaves = [(_hash(b"l" + x.encode("utf-8", "surrogatepass")), len(x)) for x in _LEAF.findall(line)]
        node = _hash(b"p" + b"".join(h for h, _ in leaves))
        members.append(len(paragraphs))
        paragraphs.append((node, leaves))
        if node[-1] % SECTION == 0:
            sections.append(members)
            members = []
    if members:
        sections.append(members)
    nodes = [(_hash(b"s" + b"".join(paragraphs[p][0] for p in m)), m) for m in sections]
    return Tree(_hash(b"r" + b"".join(h for h, _ in nodes)), nodes, paragraphs)


def likeness(a: Tree, b: Tree) -> float:
    """Share of characters in common leaves, 0 to 1; 1 for equal roots without looking further.

    Sections with the same node on both sides are counted whole, the leaves of the others are compared.
    """
    if a.root == b.root:
        return 1.0
    left, right = Counter(h for h, _ in a.sections), Counter(h for h, _ in b.sections)
    same = left & right

    def rest(t: Tree) -> tuple[list[int], int]:
        budget, open_, whole = Counter(same), [], 0
        for i, (h, members) in enumerate(t.sections):
            if budget[h]:
                budget[h] -= 1
                whole += sum(n for p in members for _, n in t.paragraphs[p][1])
            else:
                open_.append(i)
        return open_, whole

    (open_a, whole), (open_b, _) = rest(a), rest(b)
    leaves_a, leaves_b = a.leaves(open_a), b.leaves(open_b)
    common = whole + sum((leaves_a & leaves_b).values())
    return common / max(1, a.chars() + b.chars() - common)


def differences(a: Tree, b: Tree) -> list[tuple[int, int]]:
    """Character spans of ``a`` whose paragraphs ``b`` does not have: where an edit lies."""
    if a.root == b.root:
        return []
    there = Counter(h for h, _ in b.paragraphs)
    spans, at = [], 0
    for node, leaves in a.paragraphs:
        n = sum(k for _, k in leaves)
        if there[node]:
            there[node] -= 1
        elif spans and spans[-1][1] == at:
            spans[-1] = (spans[-1][0], at + n)
        else:
            spans.append((at, at + n))
        at += n
    return spans


def edited(text: str, following: str) -> str:
    """The last quarter of the characters replaced by the first as many of the following text."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k] if k else text


_FIELDS = ("n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, "
           "near_next double, n_sections bigint, n_paragraphs bigint, edit_start bigint")


def _compare(text: str, own: Tree, following: str, next_tree: Tree) -> tuple:
    changed = edited(text, following)
    other = own if changed == text else tree(changed)
    spans = differences(own, other)
    sha = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
    return (len(text), sha, own.root.hex(), other.root.hex(), likeness(own, other), likeness(own, next_tree),
            len(own.sections), len(own.paragraphs), spans[0][0] if spans else None)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the fingerprint, that of an edited text, and the likeness to both it and the next row's.

    Rows follow each other by ascending id (null first, repeated ids by text), the first after the
    last; a single row follows itself. A null text counts as empty. ``edit_start`` is where the first
    paragraph that the edit changed begins, null if it changed none.

    The rows are sorted by ranges, and each task compares neighbours as they pass. Only the last row
    of a range waits for the first of the next range: one text per range is written for that.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text).alias("text"))
    kind = dict(rows.dtypes)["id"]
    done = pa.schema([("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                      ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
                      ("n_sections", pa.int64()), ("n_paragraphs", pa.int64()), ("edit_start", pa.int64())])

    def batch_of(ids: pa.Array, found: list[tuple], edges: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array([f[i] for f in found], field.type) for i, field in enumerate(done)]
        part, first, last = zip(*edges, strict=True)
        columns += [pa.array(part, "int32"), pa.array(first, "string"), pa.array(last, "string")]
        return pa.RecordBatch.from_arrays([ids, *columns], ["id", *done.names, "part", "first", "last"])

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, opening, held = TaskContext.get().partitionId(), None, None
        for batch in batches:
            ids, found = [], []
            for i, value in enumerate(batch.column(1).to_pylist()):
                own = tree(value)
                if held is None:
                    opening = value
                else:
                    ids.append(held[0])
                    found.append(_compare(held[1], held[2], value, own))
                held = (batch.column(0).slice(i, 1), value, own)
            if found:
                yield batch_of(pa.concat_arrays(ids), found, [(None, None, None)] * len(found))
        if held is not None:
            yield batch_of(held[0], [(None,) * len(done)], [(part, opening, held[1])])

    ordered = rows.repartitionByRange(shuffle_width(docs), "id").sortWithinPartitions("id", "text")
    schema = f"id {kind}, {_FIELDS}, part int, first string, last string"
    with small_batches(spark):
        made = materialise(ordered.mapInArrow(neighbours, schema), "fingerprints")
    edges = made.where("part is not null").select("id", "part", "first", "last")
    # One number per range is ordered here; the texts are joined to it.
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = edges.select("part").withColumn(
        "next", F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(whole)))
    openings = edges.select(F.col("part").alias("next"), F.col("first").alias("following"))
    waiting = edges.join(after, "part").join(openings, "next").select("id", F.col("last").alias("text"), "following")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
            found = [_compare(a, tree(a), b, tree(b)) for a, b in pairs]
            columns = [pa.array([f[i] for f in found], field.type) for i, field in enumerate(done)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["id", *done.names])

    inner = made.where("part is null").drop("part", "first", "last")
    both = inner.unionByName(waiting.mapInArrow(close, f"id {kind}, {_FIELDS}"))
    return both.withColumnRenamed("id", id_col)
