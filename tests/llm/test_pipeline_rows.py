"""The rows of the whole pipeline against its stages in plain Python."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from stayline.llm import packing, quality
from stayline.llm.common import documents
from stayline.llm.queries import held_out
from stayline.llm.tokens import encoder
from test_groups import near
from test_mixing_quality import water_filled
from test_tokens import fits


def scores(spark, sf, rows):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = quality.train(documents(spark, sf), labels, usable=~held_out())
    x = quality.measures([r.text or "" for r in rows], model.compressors())
    terms = quality._terms(x, model.mean, model.scale)
    return 1 / (1 + np.exp(-(terms @ np.array(model.weights))))


def copies(rows):
    """Copies of each row: rates by bisection, spacing over the sizes, the rest settled in words."""
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in rows}
    total = Counter()
    for r in rows:
        total[r.source] += size[r.doc_id]
    goals, out = water_filled(total), {}
    for source, goal in goals.items():
        classes = defaultdict(list)
        for r in rows:
            if r.source == source:
                classes[size[r.doc_id]].append((r.h, r.doc_id))
        scale = sum(s * s * len(c) for s, c in classes.items()) / max(total[source], 1) or 1.0
        rate = lambda s, tilt: 2 / (1 + math.exp(-tilt * s / scale))
        low, high = -50.0, 50.0
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (mid, high) if sum(len(c) * s * rate(s, mid) for s, c in classes.items()) < goal else (low, mid)
        tilt, full = round(low, 8), goal >= (2 - 1e-9) * total[source]
        rates = {s: 1.0 if not total[source] else 2.0 if full else rate(s, tilt) for s in sorted(classes, reverse=True)}
        upto, extra = 0.0, {}
        for s, v in rates.items():
            n, part = len(classes[s]), v - math.floor(v)
            since, upto = upto, upto + n * part
            extra[s] = max(0, min(math.floor(upto + 0.5) - math.floor(since + 0.5), n))
        gap = goal - sum((math.floor(v) * len(classes[s]) + extra[s]) * s for s, v in rates.items())
        for s, v in rates.items():
            if s:
                wish = int(math.copysign(math.floor(abs(gap / s) + 0.5), gap))
                more = max(-extra[s], min(wish, len(classes[s]) - extra[s] if v > math.floor(v) else 0))
                gap, extra[s] = gap - more * s, extra[s] + more
        for s, members in classes.items():
            for place, (_, i) in enumerate(sorted(members)):
                out[i] = math.floor(rates[s]) + (place < extra[s])
    return out


def expected(spark, sf):
    rows = documents(spark, sf).withColumn("h", F.xxhash64("doc_id")).collect()
    assert len({r.doc_id for r in rows}) == len(rows)
    steps = [rows, [r for r, s in zip(rows, scores(spark, sf, rows)) if s >= quality.THRESHOLD]]
    last = {}
    for r in steps[-1]:
        last[r.text or ""] = max(r.doc_id, last.get(r.text or "", r.doc_id))
    steps.append([r for r in steps[-1] if r.doc_id == last[r.text or ""]])
    _, group = near([(r.doc_id, r.text) for r in steps[-1]])
    steps.append([r for r in steps[-1] if group[r.doc_id] == r.doc_id])
    assert all(len(a) > len(b) for a, b in zip(steps, steps[1:]))
    taken, library, want = copies(steps[-1]), encoder(packing.VOCABULARY, True), Counter()
    for r in steps[-1]:
        ids = library.whole(r.text or "") + bytes(4)
        n = len(ids) // 4
        edges = [0, *range(n % 2048 or 2048, n + 1, 2048)]
        for k, (a, b) in enumerate(zip(edges, edges[1:])):
            want[r.doc_id, k, a, b - a, zlib.crc32(ids[4 * a : 4 * b])] += taken[r.doc_id]
    return +want


def test_rows_of_the_pipeline(spark, sf, monkeypatch):
    want = expected(spark, sf)
    found = lambda rows: Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    rows = corpus_pipeline.run(spark, sf).collect()
    assert found(rows) == want
    fits(rows, 2048)
    # A stage that loses one document shows.
    some = min(want)[0]
    lossy = [(n, (lambda s, d, p, f=f: f(s, d, p).where(f"doc_id <> {some}")) if n == "mixing" else f)
             for n, f in corpus_pipeline.STAGES]
    monkeypatch.setattr(corpus_pipeline, "STAGES", lossy)
    assert found(corpus_pipeline.run(spark, sf).collect()) != want
