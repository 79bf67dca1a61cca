"""Mixing, quality scores, license scans and the pipeline."""

import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from stayline.llm import license_scan, mixing, quality, queries
from stayline.llm.common import documents


def water_filled(sizes, weights=(5, 2, 1), share=1.5, cap=2):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] >= cap * sizes[s]}
        if not full:
            return out | {s: level * weight[s] for s in open_}
        for s in full:
            out[s] = cap * sizes[s]
            left -= out[s]
        open_ -= full
    return out


def check_mix(df):
    got = mixing.mix(df).collect()
    assert len(got) == df.count()
    sizes, taken = {}, {}
    for r in got:
        assert r.mix_size == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        assert 0 <= r.mix_copies <= 2
        sizes[r.source] = sizes.get(r.source, 0) + r.mix_size
        taken[r.source] = taken.get(r.source, 0) + r.mix_size * r.mix_copies
    want = water_filled(sizes)
    for r in got:
        assert r.mix_source_size == sizes[r.source]
        assert r.mix_target == pytest.approx(want[r.source], rel=1e-9)
    return got, taken, want


def test_mix_meets_its_targets(spark, sf):
    df = documents(spark, sf)
    got, taken, want = check_mix(df)
    for s, target in want.items():
        assert taken[s] == pytest.approx(target, rel=0.02)
    again = mixing.mix(df.repartition(7)).collect()
    assert {r.doc_id: r.mix_copies for r in got} == {r.doc_id: r.mix_copies for r in again}
    repeated = mixing.mixed(df)
    assert repeated.columns == df.columns and repeated.count() == sum(r.mix_copies for r in got)


def test_rates_tilt_with_the_size(spark, sf):
    rows = mixing.mix(documents(spark, sf)).select("source", "mix_size", "mix_rate", "mix_target", "mix_source_size").toPandas()
    for _, part in rows.groupby("source"):
        ratio = part["mix_target"].iloc[0] / part["mix_source_size"].iloc[0]
        if ratio < 1.99:
            assert (np.corrcoef(part["mix_size"], part["mix_rate"])[0, 1] > 0) == (ratio > 1)


def test_mix_of_odd_rows(odd_docs, no_docs):
    check_mix(odd_docs)
    assert mixing.mix(no_docs).count() == 0


def test_a_hot_size_class_is_cut_exactly(spark):
    rows = [(i, "a b c", "s") for i in range(5000)] + [(5000 + i, "x " * 40, "t") for i in range(300)]
    got, taken, want = check_mix(spark.createDataFrame(rows, "doc_id bigint, text string, source string"))
    for s, target in want.items():
        assert taken[s] == pytest.approx(target, abs=41)


def test_quality_on_held_out_rows(spark, sf):
    got = queries.op5_compression_quality(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = got.join(labels, "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    hits = np.mean([r.predicted == r.quality for r in rows])
    kept = np.mean([r.predicted for r in rows if r.quality])
    assert hits > 0.93 and kept > 0.98
    assert got.count() == documents(spark, sf).count()
    assert got.where("score between 0 and 1 and predicted = int(score >= 0.3)").count() == got.count()


def test_quality_of_odd_rows(spark, sf, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None)], "doc_id bigint, quality int")
    model = quality.train(odd_docs, labels)
    scored = quality.score(odd_docs, model, name="q")
    assert scored.columns == [*odd_docs.columns, "q"]
    assert scored.where("q between 0 and 1").count() == odd_docs.count()
    assert quality.score(no_docs, model).count() == 0
    only = quality.train(odd_docs, labels.where("quality = 1"))
    assert quality.score(odd_docs, only).where("score = 1").count() == odd_docs.count()
    assert quality.train(odd_docs, labels.limit(0)).constant == 1.0


def held(text, template):
    def sets(t):
        w = re.findall(r"[a-z0-9_\x80-\U0010ffff]+", t.lower())
        n = min(5, len(w))
        return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set()

    want = sets(template)
    return len(want & sets(text)) / len(want)


#: Short notices by which texts state their license.
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
]


def test_licenses(spark, sf, rng):
    long = " ".join(f"t{i}" for i in range(60))
    templates = [*NOTICES, ("long", long)]
    changed = long.split()
    for i in (3, 58):
        changed[i] = "other"
    torn = long.split()
    for i in (10, 20, 30, 40):
        torn[i] = "other"
    noise = lambda n: " ".join(f"n{rng.randint(0, 9999)}" for _ in range(n))
    made = [(i, f"{noise(rng.randint(0, 300))} {body} {noise(rng.randint(0, 300))}") for i, body in enumerate(
        [long, " ".join(changed), " ".join(torn), *[t for _, t in templates], templates[0][1].upper()] * 4)]
    made.append((900, f"{noise(40_000)} {long} {noise(40_000)} {templates[3][1]}"))
    docs = documents(spark, sf).select("doc_id", "text").union(
        spark.createDataFrame([(i + 10**6, t) for i, t in made], "doc_id bigint, text string"))
    got = {(r.doc_id, r.license): r for r in license_scan.scan(docs, templates).collect()}
    want = {(r.doc_id, n) for r in docs.collect() for n, t in templates if held(r.text, t) >= 0.8}
    assert set(got) == want
    assert got[10**6, "long"].containment == 1.0 and got[10**6 + 1, "long"].containment < 1


def test_licenses_of_odd_rows(odd_docs, no_docs):
    assert license_scan.scan(odd_docs, NOTICES).count() == 0
    assert license_scan.scan(odd_docs, [("two", "One, two!")]).collect()[0].doc_id == 8
    assert license_scan.scan(no_docs, NOTICES).count() == 0


def test_pipeline(spark, sf):
    docs = documents(spark, sf)
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        if name != "packing":
            assert out.columns == docs.columns
        kept[name] = out.count()
        docs = corpus_pipeline.materialise(out, "test-stage")
    assert kept["quality"] > kept["exact dedup"] > kept["near duplicates"]
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    assert docs.join(labels.where("quality = 0"), "doc_id", "left_semi").select("doc_id").distinct().count() < 30
    rows = docs.collect()
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(sum(n for _, n in p) <= 2048 for p in by.values())


def test_pipeline_of_odd_rows(spark, odd_docs, no_docs, tmp_path):
    spark.createDataFrame([], "doc_id bigint, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.materialise(stage(spark, docs, str(tmp_path)), "odd-stage")
        docs.count()
