"""The audit against plain Python over all orders."""

import itertools
import re

import pyarrow as pa
import pytest

from stayline.llm import filter_audit, shards

LABELS = "doc_id bigint, quality int, toxic int"


def brute(rows, labels):
    """Rows (part, order, step) of documents (id, text, source)."""
    found, parts = {}, {}
    for i, text, source in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
            "E": i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in rows)}
        own = [m for m in labels if i is not None and m[0] == i]
        parts.setdefault(source or "", []).append((fails, any(m[1] == 1 for m in own), any(m[2] == 1 for m in own)))
    for part, docs in parts.items():
        shapley = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if d[0][f]]
                left = [d for d in left if not d[0][f]]
                shapley[f] += len(gone)
                found[part, "".join(order), step] = [
                    len(left), len(gone), sum(d[0][f] for d in docs) - len(gone),
                    sum(d[0][f] and sum(d[0].values()) == 1 for d in docs), sum(d[1] for d in gone), sum(d[2] for d in gone)]
        for order in itertools.permutations("ABCDE"):
            for step, f in enumerate(order, 1):
                found[part, "".join(order), step].append(shapley[f])
    return found


def compared(docs, labels, **more):
    rows = [(r.doc_id, r.text, r.source) for r in docs.select("doc_id", "text", "source").collect()]
    want = brute(rows, [tuple(r) for r in labels.collect()])
    got = {(r[0], r[1], r[2]): list(r[3:]) for r in filter_audit.audit(docs, labels, **more).collect()}
    assert got == want


@pytest.mark.parametrize("shard_bytes", [1, 3000, filter_audit.SHARD_BYTES])
def test_equals_plain_counts(spark, rng, shard_bytes):
    def text():
        words = [rng.choice(["on", "off", "A", "NASA", "up", "#", "x|y", *map(str, range(60))]) for _ in range(rng.choice([0, 9, 49, 50, 70]))]
        return rng.choice([" ", "\n", "  \t"]).join(words)

    texts = [text() for _ in range(30)]
    rows = [(i, rng.choice(texts), rng.choice(["a", "b", None, ""])) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(3)
    labels = spark.createDataFrame(
        [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 140, 2)] + [(4, 1, 1), (None, 1, 1)], LABELS)
    compared(docs, labels, shard_bytes=shard_bytes)


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(7, 1, 0), (1, 0, 1), (1, 1, 0), (None, 1, 1)], LABELS)
    compared(odd_docs, labels)
    assert filter_audit.audit(no_docs, labels).collect() == []
    assert filter_audit.audit(odd_docs, labels.limit(0)).count() == 5 * 120 * 4


def test_matrix_holds_every_count(spark, odd_docs):
    from pyspark.sql import functions as F

    rows = odd_docs.select(F.struct("doc_id").alias("row"), F.coalesce("text", F.lit("")).alias("words"))
    matrix, dictionary = filter_audit.document_term_matrix(rows, shard_bytes=1000)
    words = {r["value"]: r["word"] for r in dictionary.collect()}
    assert sorted(words) == list(range(len(words)))
    got = []
    for shard in matrix.collect():
        terms, counts = shards.unpacked(shard["terms"], "<i8"), shards.unpacked(shard["counts"])
        for i, row in enumerate(shard["rows"]):
            cells = range(shard["starts"][i], shard["starts"][i + 1])
            got.append((str(row["doc_id"]), {words[terms[c]]: counts[c] for c in cells}))
    want = []
    for r in odd_docs.collect():
        counts = {}
        for w in re.findall(r"[^\x20\x09-\x0D]+", r.text or ""):
            counts[w] = counts.get(w, 0) + 1
        want.append((str(r.doc_id), counts))
    key = lambda x: (x[0], sorted(x[1].items()))
    assert sorted(got, key=key) == sorted(want, key=key)


@pytest.mark.parametrize("texts", [[], [""], ["", " "], ["a", "b"], [" a b", "c ", "", "\té d\x0b漢 x"], ["ab", "cd ef"]])
def test_words_of_bytes(texts):
    words, lengths = shards.ascii_words(pa.array(texts, pa.string()))
    want = [re.findall(r"[^\x20\x09-\x0D]+", t) for t in texts]
    assert words.to_pylist() == [w for ws in want for w in ws] and list(lengths) == [len(w) for w in want]
    sliced = pa.array(["x y", *texts], pa.string())[1:]
    assert shards.ascii_words(sliced)[0].to_pylist() == words.to_pylist()
