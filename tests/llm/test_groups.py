"""Deduplication, near copies, repeats and fingerprints against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayline.llm import fingerprints, jaccard_forest, stream_dedup, suffix_dedup
from stayline.llm.common import documents, with_rank
from stayline.llm.components import components
from stayline.session import new_path

weak = lambda text: F.substring(F.sha2(text, 256), 1, 1)  # noqa: E731  collides


def check_copies(df, got):
    rows = [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]
    size = Counter(t for _, t in rows)
    keep = {}
    for i, t in rows:
        keep[t] = max(keep.get(t, -1), -1 if i is None else i)
    assert len(got) == len(rows)
    want = Counter((i, None if keep[t] < 0 else keep[t], size[t]) for i, t in rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in got) == want
    assert sum(r.kept for r in got) == len(size) and all(r.doc_id == r.keep_id for r in got if r.kept)


@pytest.mark.parametrize("digest", [stream_dedup.sha256, weak])
def test_copies_of_odd_rows(odd_docs, digest):
    check_copies(odd_docs, stream_dedup.deduplicate(odd_docs, digest=digest, max_files=1).collect())
    kept = stream_dedup.survivors(odd_docs, digest=digest)
    assert kept.columns == odd_docs.columns
    assert kept.count() == odd_docs.select(F.coalesce("text", F.lit(""))).distinct().count()


def test_no_copies_of_nothing(no_docs):
    assert stream_dedup.deduplicate(no_docs).count() == 0 and stream_dedup.survivors(no_docs).count() == 0


def test_state_goes_on_with_later_arrivals(spark):
    state = new_path(spark, "state")
    first = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id bigint, text string")
    later = spark.createDataFrame([(3, "a"), (4, "c")], "doc_id bigint, text string")
    stream_dedup.deduplicate(first, state=state).count()
    got = {r.doc_id: r for r in stream_dedup.deduplicate(later, state=state).collect()}
    assert (got[3].keep_id, got[3].group_size, got[4].group_size) == (3, 2, 1)


def test_a_resumed_state_keeps_the_larger_earlier_id(spark):
    """The later row has the smaller id, and stands at the same place in its call as the earlier one in its own."""
    state = new_path(spark, "state")
    first = spark.createDataFrame([(100, "a"), (7, "b")], "doc_id bigint, text string").coalesce(1)
    later = spark.createDataFrame([(50, "a"), (8, "b"), (100, "a")], "doc_id bigint, text string").coalesce(1)
    assert all(r.kept for r in stream_dedup.deduplicate(first, state=state).collect())
    again = new_path(spark, "state")
    stream_dedup.survivors(first, state=again).count()
    assert [r.doc_id for r in stream_dedup.survivors(later, state=again).collect()] == [8]
    got = {(r.doc_id, r.keep_id, r.group_size): r.kept for r in stream_dedup.deduplicate(later, state=state).collect()}
    assert got == {(50, 100, 3): False, (100, 100, 3): False, (8, 8, 2): True}


def test_a_hit_on_an_earlier_call_compares_bytes(spark):
    """Every text has the same digest."""
    one = lambda text: F.substring(text, 1, 0)
    for keep in (stream_dedup.deduplicate, stream_dedup.survivors):
        state = new_path(spark, "state")
        keep(spark.createDataFrame([(1, "x"), (5, "z")], "doc_id bigint, text string"), state=state, digest=one).count()
        got = keep(spark.createDataFrame([(2, "y"), (3, "x"), (4, "z")], "doc_id bigint, text string"), state=state, digest=one)
        if keep is stream_dedup.survivors:
            assert sorted(r.doc_id for r in got.collect()) == [2, 3]
        else:
            assert {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in got.collect()} == {
                (2, 2, 1, True), (3, 3, 2, True), (4, 5, 2, False)}


def shingle_sets(rows):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[a-z0-9_\x80-\U0010ffff]+", (t or "").lower())
        n = min(5, len(w))
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set()
    return sets


def near(rows):
    sets = shingle_sets(rows)
    links = {i: {j for j in sets if j != i and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) and sets[i] | sets[j]}
             for i in sets}
    group = {}
    for i in sorted(sets):
        stack = [] if i in group else [i]
        while stack:
            x = stack.pop()
            group[x] = i
            stack += [j for j in links[x] if j not in group]
    return links, group


def test_links_and_groups(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)]
    base = [rng.choice(vocabulary) for _ in range(110)]
    rows = []
    for _ in range(330):  # one large group of near copies, over several blocks
        b = list(base)
        for _ in range(rng.randint(0, 3)):
            b[rng.randrange(len(b))] = rng.choice(vocabulary)
        rows.append(" ".join(b))
    for _ in range(25):
        b = [rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 4, 8, 9, 10, 30, 300]))]
        for _ in range(5):
            c = list(b)
            for _ in range(rng.randint(0, max(1, len(b) // 40))):
                c[rng.randrange(len(c))] = rng.choice(vocabulary)
            rows.append(rng.choice([" ", ", "]).join(c))
    rows = [(i, t) for i, t in enumerate([*rows, None, "", "...", rows[0]])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    links, group = near(rows)
    got = jaccard_forest.join_groups(df, block=100).collect()
    assert {r.doc_id: (r.n_links, r.group_id, r.kept) for r in got} == {
        i: (len(links[i]), group[i], group[i] == i) for i, _ in rows}
    sets = shingle_sets(rows)
    for r in got:
        assert not sets[r.doc_id] or r.class_id == min(i for i in sets if sets[i] == sets[r.doc_id])
    assert sorted(r.doc_id for r in jaccard_forest.survivors(df).collect()) == sorted(set(group.values()))


def test_links_of_odd_rows(odd_docs, no_docs):
    got = jaccard_forest.join_groups(odd_docs)
    assert got.count() == odd_docs.count()
    one = {r.doc_id: r for r in got.collect()}
    assert one[1].n_links == 2 and one[3].group_id == 1 and one[7].n_links == 1
    assert all(one[i].n_links == 0 and one[i].kept for i in (4, 5, 6, 8, 9, None, 10))
    kept = jaccard_forest.survivors(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 4, 5, 6, 7, 8, 9, 10]
    assert jaccard_forest.join_groups(no_docs).count() == 0 and jaccard_forest.survivors(no_docs).count() == 0


def test_prefix_depth_keeps_the_recall():
    for recall in (0.9, 0.99, 0.9999):
        d = jaccard_forest.prefix_depth(recall)
        assert 1 - (1 - 0.8**d) ** jaccard_forest.TREES >= recall
        assert d == jaccard_forest.DEPTH or 1 - (1 - 0.8 ** (d + 1)) ** jaccard_forest.TREES < recall


def test_components_of_a_long_chain(spark):
    links = spark.range(200).selectExpr("(id * 7) % 201 as a", "((id + 1) * 7) % 201 as b").union(
        spark.createDataFrame([(500, 501), (502, 501), (9000, 9000)], "a bigint, b bigint"))
    got = {r.node: r.root for r in components(links).collect()}
    assert set(got.values()) == {0, 500} and len(got) == 204


def brute_repeats(rows, length):
    seen = Counter(b[p : p + length] for _, b in rows for p in range(len(b) - length + 1))
    out = []
    for i, b in rows:
        hit = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                hit[p : p + length] = True
        hit = hit[: len(b)]
        runs = int((np.diff(np.concatenate([[0], hit.astype(int)])) == 1).sum())
        out.append((i, len(b), int(hit.sum()), runs, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~hit])).hexdigest()))
    return Counter(out)


def repeats_of(df, **settings):
    rows = [(r.doc_id, (r.text or "").encode()) for r in df.select("doc_id", "text").collect()]
    got = suffix_dedup.remove_repeats(df, **settings).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute_repeats(
        rows, settings.get("length", suffix_dedup.LENGTH))
    for r in got:
        assert sum(s.stop - s.start for s in r.spans) == r.n_removed and len(r.kept) == r.n_bytes - r.n_removed


@pytest.mark.parametrize("group", [suffix_dedup.GROUP, 4])
def test_repeats(spark, group):
    rng = random.Random(4)
    made = lambda n: "".join(rng.choice("abcdefghij klmnop") for _ in range(n))
    passages = [made(n) for n in (199, 200, 201, 260, 500, 1500)]
    rows = []
    for i in range(150):
        text = made(rng.randint(0, 400))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            text += p[rng.choice([0, 0, len(p) // 3]) :] + made(rng.randint(0, 300))
        rows.append((i, text))
    rows += [(200, None), (201, "ab" * 300), (202, "a" * 1000), (203, "a" * 199), (204, rows[5][1]), (205, "é" * 250)]
    repeats_of(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7), group=group)


def test_repeats_of_odd_rows(odd_docs, no_docs):
    repeats_of(odd_docs)
    assert suffix_dedup.remove_repeats(no_docs).count() == 0


def test_suffix_order_and_collisions(monkeypatch):
    rng = random.Random(1)
    texts = [bytes(rng.choice(b"ab") for _ in range(40)) for _ in range(12)]
    windows = [len(t) - 5 for t in texts]
    groups = [0] * 5 + [1] * 7
    arena = suffix_dedup.Arena(texts, 6)
    starts = np.concatenate([np.arange(n) + 40 * i for i, n in enumerate(windows)])
    group = np.repeat(groups, windows)
    order = arena.sort(starts, group)
    data = arena.data.tobytes()
    keys = [(int(group[i]), data[starts[i] : starts[i] + 6]) for i in order]
    assert keys == sorted(keys)

    def same(label):
        found = {}
        for i, c in enumerate(label):
            found.setdefault(int(c), set()).add((int(group[i]), data[starts[i] : starts[i] + 6]))
        return all(len(v) == 1 for v in found.values()) and len(found) == len(set(keys))

    assert same(suffix_dedup.classes(texts, windows, groups, 6))
    # Hashes that never differ: every group is settled by its bytes.
    monkeypatch.setattr(suffix_dedup, "prefix_hashes", lambda d: np.zeros(len(d) + 1, np.uint64))
    assert same(suffix_dedup.classes(texts, windows, groups, 6))


def test_suffixes_that_differ_in_their_first_bytes_are_not_merged(monkeypatch):
    """Copies are merged with each other only: comparisons do not grow with the windows of a text."""
    rng = np.random.default_rng(3)
    base = [rng.integers(0, 256, 336, dtype=np.uint8).tobytes() for _ in range(4)]
    texts = [b[:k] + bytes([255 - b[k]]) + b[k + 1 :] for b in base for k in (20, 330)]
    compared, extension = [], suffix_dedup.Arena.extension

    def recorded(arena, a, b):
        compared.append(len(a))
        return extension(arena, a, b)

    monkeypatch.setattr(suffix_dedup.Arena, "extension", recorded)
    label = suffix_dedup.classes(texts, [137] * 8, [i // 2 for i in range(8)])
    assert sum(compared) < 4 * 137 * 8
    windows = [(i // 2, t[k : k + 200]) for i, t in enumerate(texts) for k in range(137)]
    assert len(set(zip(label.tolist(), windows))) == len(set(label.tolist())) == len(set(windows))


def check_fingerprints(df):
    rows = sorted(((r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    got = fingerprints.fingerprints(df).collect()
    want = Counter()
    for (i, text), (_, following) in zip(rows, rows[1:] + rows[:1], strict=True):
        k = len(text) // 4
        changed = text[: len(text) - k] + following[:k]
        want[i, len(text), hashlib.sha256(changed.encode()).hexdigest(), fingerprints.tree(text).root.hex(),
             fingerprints.tree(changed).root.hex()] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) for r in got) == want
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert all((r.near_edited == 1) == (r.fingerprint == r.edited_fingerprint) for r in got)
    return got


def test_fingerprints(spark, sf, odd_docs, no_docs):
    check_fingerprints(odd_docs)
    assert fingerprints.fingerprints(no_docs).count() == 0
    got = check_fingerprints(documents(spark, sf).repartition(5))
    assert np.mean([r.near_edited for r in got]) > 0.5 and np.mean([r.near_next for r in got]) < 0.01
    check_fingerprints(odd_docs.where("doc_id = 1"))


def test_trees(rng):
    text = "\n".join(" ".join(f"w{rng.randint(0, 50)}" for _ in range(30)) + "." for _ in range(60))
    own = fingerprints.tree(text)
    at = text.index("\n", 1500) + 1
    other = fingerprints.tree(text[:at] + "new " + text[at:])
    assert own.chars() == len(text) and own.root != other.root
    assert 0.9 < fingerprints.likeness(own, other) < 1
    spans = fingerprints.differences(own, other)
    assert len(spans) == 1 and spans[0][0] == at
    assert fingerprints.likeness(own, fingerprints.tree("")) == 0 and fingerprints.likeness(own, own) == 1


def test_rank_over_ranges(spark):
    df = spark.range(300).selectExpr("if(id % 50 = 0, null, id * 13 % 301) as v").repartition(4)
    got = [r.rank for r in with_rank(df, [F.col("v").asc_nulls_last()]).orderBy(F.col("v").asc_nulls_last(), "rank").collect()]
    assert got == list(range(300))


def test_links_of_a_large_group_shrink_per_round(spark, monkeypatch):
    """Chains of groups with many mutual links: later rounds join the links between groups only."""
    from stayline.llm import components as module

    rng, pairs = np.random.default_rng(5), set()
    names = rng.permutation(400)
    for group in range(8):
        own = names[group * 50:group * 50 + 50]
        pairs |= {(int(a), int(b)) for a in own for b in own[rng.integers(0, 50, 12)]}
        pairs.add((int(own[0]), int(names[(group * 50 + 50) % 400])))
    sizes, write = [], module.materialise

    def recorded(df, name):
        made = write(df, name)
        if name == "links":
            sizes.append(made.count())
        return made

    monkeypatch.setattr(module, "materialise", recorded)
    got = {r.node: r.root for r in components(spark.createDataFrame(sorted(pairs), "a long, b long")).collect()}
    assert got == dict.fromkeys(range(400), 0)
    assert len(sizes) > 1 and sizes[1] <= sizes[0] / 4 and sizes[-1] == 0
