"""Repeated substrings: which bytes lie in a string of ``length`` bytes that also starts elsewhere.

Every window of ``length`` bytes is assigned to one gram inside it, the one of least hash (the first of
equals), so equal windows have equal grams at equal places. Consecutive windows with the same gram form
a domain. Then

1. grams that occur once are dropped: their windows cannot repeat;
2. equal domains are found by a 128-bit digest of their bytes; all their windows repeat;
3. what is left, domains that share a gram but differ, mostly at the ends of copied passages, goes to
   a suffix sort. The suffixes of a group of domains are merge-sorted; two suffixes are compared by
   their common extension, found by binary search over prefix polynomial hashes, and the byte after it.
   Neighbours with a common extension of ``length`` repeat, once their bytes have been compared.

Groups of more than ``GROUP`` domains are dealt to several tasks, and each sorts its share. What may still
repeat across shares goes by blocks of ``BLOCK`` windows next to each other: the bytes that all windows
of a block have in common are counted by digest, and only blocks whose core occurs in several shares
are looked at window by window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm.common import join_on, keyed, shuffle_width, small_batches
from stayline.llm.jaccard_forest import _mix, _power_table
from stayline.session import materialise

LENGTH = 200
GRAM = 64
#: Domains of one gram that are sorted together.
GROUP = 512
#: Windows of a domain that are handed on together when its group is dealt to several tasks.
BLOCK = 8
#: Texts are read in pieces of so many window starts.
PIECE = 1 << 20
#: Suffixes sorted at once in a task.
SORTED = 1 << 16


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all prefixes, modulo 2**64."""
    power, _ = _power_table(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=out[1:])
    return out


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by running minima of blocks from both sides."""
    n = len(values) - width + 1
    pad = -len(values) % width
    top = np.iinfo(np.uint64).max
    table = np.concatenate([values, np.full(pad, top, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    back = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def domains(data: bytes, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[int, int, int, int]]:
    """(gram hash, first window, last window, place of the gram) for all windows of ``data``, in order."""
    total = len(data) - length + 1
    for begin in range(0, total, PIECE):
        stop = min(total, begin + PIECE)
        piece = np.frombuffer(data, np.uint8)[begin : stop + length - 1]
        sums = prefix_hashes(piece)
        _, inverse = _power_table(len(piece) + 1)
        grams = len(piece) - gram + 1
        with np.errstate(over="ignore"):
            hashed = _mix((sums[gram:] - sums[:grams]) * inverse[:grams])
        place = np.uint64(PIECE.bit_length())
        ordered = (hashed >> place << place) | np.arange(grams, dtype=np.uint64)
        chosen = (_sliding_least(ordered, length - gram + 1) & np.uint64((1 << int(place)) - 1)).astype(np.int64)
        edges = np.flatnonzero(np.diff(chosen)) + 1
        first = np.concatenate([[0], edges])
        last = np.concatenate([edges, [len(chosen)]]) - 1
        at = chosen[first]
        yield from zip(hashed[at].view(np.int64).tolist(), (first + begin).tolist(), (last + begin).tolist(),
                       (at + begin).tolist(), strict=True)


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


class Arena:
    """Texts laid end to end, with the extensions of suffixes found by hashes."""

    def __init__(self, texts: list[bytes], length: int):
        self.length = length
        # A tail of zeros keeps the probes of the last suffixes inside.
        self.data = np.frombuffer(b"".join(texts) + bytes(length), np.uint8)
        self.sums = prefix_hashes(self.data)
        _, self.inverse = _power_table(len(self.data) + 1)

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common extension of the suffixes at ``a`` and ``b``, up to ``length``, by binary search."""
        with np.errstate(over="ignore"):
            done = np.zeros(len(a), np.int64)
            step = 1 << (self.length.bit_length() - 1)
            while step:
                to = done + step
                ok = to <= self.length
                n = np.where(ok, to, 0)
                left = (self.sums[a + n] - self.sums[a]) * self.inverse[a]
                right = (self.sums[b + n] - self.sums[b]) * self.inverse[b]
                done = np.where(ok & (left == right), to, done)
                step >>= 1
        return done

    def less(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        n = self.extension(a, b)
        at = np.minimum(n, self.length - 1)
        return (n < self.length) & (self.data[a + at] < self.data[b + at])

    def heads(self, suffixes: np.ndarray) -> np.ndarray:
        """The first bytes of each suffix, up to 8 and none behind ``length``, as numbers in the order of the bytes."""
        out = np.zeros(len(suffixes), np.uint64)
        for k in range(min(8, self.length)):
            out = (out << np.uint64(8)) | self.data[suffixes + k]
        return out

    def sort(self, suffixes: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Order of ``suffixes`` inside consecutive groups: a bottom-up merge sort of all groups at once.

        Groups are parted by the first bytes of their suffixes before, so only suffixes that share them are merged.
        """
        heads = self.heads(suffixes)
        order = np.lexsort((heads, group))
        group, heads = group[order], heads[order]
        starts = np.flatnonzero(np.concatenate([[True], (group[1:] != group[:-1]) | (heads[1:] != heads[:-1])]))
        sizes = np.diff(np.concatenate([starts, [len(group)]]))
        start, size = np.repeat(starts, sizes), np.repeat(sizes, sizes)
        width = 1
        while width < sizes.max(initial=0):
            x = np.flatnonzero(size > width)
            run = (x - start[x]) // width
            own = start[x] + run * width
            other = start[x] + (run ^ 1) * width
            end = start[x] + size[x]
            low, high = np.minimum(other, end), np.minimum(other + width, end)
            # Rank in the other run: of equals, those of the left run come first.
            base, left_run = low.copy(), run % 2 == 0
            mine = suffixes[order[x]]
            open_ = np.flatnonzero(low < high)
            while len(open_):
                middle = (low[open_] + high[open_]) // 2
                theirs, here = suffixes[order[middle]], mine[open_]
                left = left_run[open_]
                before = self.less(np.where(left, theirs, here), np.where(left, here, theirs))
                goes = np.where(left, before, ~before)  # the other element comes before this one
                low[open_] = np.where(goes, middle + 1, low[open_])
                high[open_] = np.where(goes, high[open_], middle)
                open_ = open_[low[open_] < high[open_]]
            target = np.minimum(own, other) + (x - own) + (low - base)
            merged = order.copy()
            merged[target] = order[x]
            order = merged
            width *= 2
        return order

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the windows at ``a`` and ``b`` have the same bytes."""
        out = np.zeros(len(a), bool)
        span = np.arange(self.length)
        for at in range(0, len(a), 4096):
            i, j = a[at : at + 4096, None], b[at : at + 4096, None]
            out[at : at + 4096] = (self.data[i + span] == self.data[j + span]).all(1)
        return out


def classes(texts: list[bytes], windows: list[int], groups: list[int], length: int = LENGTH) -> np.ndarray:
    """A number per window: equal for windows of one group with the same bytes.

    Text i holds ``windows[i]`` windows, one per start; texts of a group are consecutive.
    """
    arena = Arena(texts, length)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])[:-1]
    counts = np.array(windows, np.int64)
    firsts = np.concatenate([[0], np.cumsum(counts)])
    suffixes = np.arange(firsts[-1]) - np.repeat(firsts[:-1] - offsets, counts)
    group = np.repeat(np.array(groups, np.int64), counts)
    order = arena.sort(suffixes, group)
    a, b = suffixes[order[:-1]], suffixes[order[1:]]
    near = np.flatnonzero((group[order[1:]] == group[order[:-1]]) & (arena.extension(a, b) == length))
    same = np.zeros(len(order), bool)
    checked = arena.equal(a[near], b[near])
    same[near[checked] + 1] = True
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(~same)
    if not checked.all():  # hashes collided: the groups concerned are settled by their bytes
        data = arena.data.tobytes()
        top, seen = int(out.max()) + 1, {}
        for i in np.flatnonzero(np.isin(group, group[order[near[~checked]]])):
            s = int(suffixes[i])
            out[i] = seen.setdefault((int(group[i]), data[s : s + length]), top + len(seen))
    return out


def _spans(flags: np.ndarray, first: int, length: int) -> list[tuple[int, int]]:
    """Byte spans covered by the flagged windows, which start at ``first`` and on."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]])))
    return [(first + int(a), first + int(b) - 1 + length) for a, b in zip(edge[::2], edge[1::2], strict=True)]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs; spans that touch are one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH,
                   gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """Rows (id, mark, start, stop): byte spans to remove, overlapping, ``mark`` a hash of the text."""
    spark = docs.sparkSession
    rows = keyed(docs, id_col, text)
    kind = dict(rows.dtypes)["id"]

    # 1. Domains of all texts. Those that repeat inside a batch are settled there, as merged spans.
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, count = [], {}
            for i, value in enumerate(batch.column(2).to_pylist()):
                data = value.encode("utf-8", "surrogatepass")
                if len(data) < length:
                    continue
                for g, first, last, at in domains(data, length, gram):
                    key = (g, _digest((at - first).to_bytes(8, "little") + data[first : last + length]))
                    count[key] = count.get(key, 0) + 1
                    found.append((i, key, first, last))
            owner, g, d, n, lo, hi, done = [], [], [], [], [], [], []
            held: dict[tuple, list[int]] = {}
            told = set()
            for i, key, first, last in found:
                if count[key] == 1:
                    row = (i, key[0], key[1], 1, first, last, False)
                else:  # settled; the first of its kind still counts for the others in the corpus
                    held.setdefault(i, []).append((first, last + length))
                    if key in told:
                        continue
                    told.add(key)
                    row = (i, key[0], key[1], count[key], first, last, True)
                for column, v in zip((owner, g, d, n, lo, hi, done), row, strict=True):
                    column.append(v)
            for i, spans in held.items():
                for a, b in merged(spans):
                    for column, v in zip((owner, g, d, n, lo, hi, done), (i, None, None, 0, a, b, True), strict=True):
                        column.append(v)
            at = pa.array(owner, "int64")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(g, "int64"), pa.array(d, "binary"),
                 pa.array(n, "int64"), pa.array(lo, "int64"), pa.array(hi, "int64"), pa.array(done, "bool")],
                ["id", "mark", "g", "d", "n", "lo", "hi", "done"])

    schema = f"id {kind}, mark bigint, g bigint, d binary, n bigint, lo bigint, hi bigint, done boolean"
    with small_batches(spark):
        found = materialise(rows.mapInArrow(describe, schema), "domains")
    settled = found.where("g is null").select("id", "mark", F.col("lo").alias("start"), F.col("hi").alias("stop"))
    found = found.where("g is not null")

    # 2. Counts of (gram, digest), then of grams. Only grams that occur twice go on.
    kinds = found.groupBy("g", "d").agg(F.sum("n").alias("n"))
    grams = kinds.groupBy("g").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("differ"))
    live = materialise(kinds.join(grams.where("total > 1"), "g"), "live-grams")
    known = found.where("not done").join(live.drop("total").withColumnRenamed("n", "all"), ["g", "d"])
    known = materialise(known.select("id", "mark", "g", "d", "lo", "hi", "all", "differ"), "live-domains")
    whole = known.where("all > 1").select(
        "id", "mark", F.col("lo").alias("start"), (F.col("hi") + length).alias("stop"))

    # 3. Domains that differ under a common gram, and one of each repeated kind beside them.
    heads = found.join(live.where("differ > 1 and n > 1").select("g", "d", "differ"), ["g", "d"])
    heads = heads.groupBy("g", "d", "differ").agg(F.min(F.struct("id", "mark", "lo", "hi")).alias("h")).select(
        "h.id", "h.mark", "g", "differ", "h.lo", "h.hi", F.lit(True).alias("done"))
    edges = known.where("all = 1 and differ > 1").select(
        "id", "mark", "g", "differ", "lo", "hi", F.lit(False).alias("done"))
    shares = F.ceil(F.col("differ") / group)
    salt = F.pmod(F.xxhash64("id", "mark", "lo"), shares).cast("int")
    wanted = edges.unionByName(heads).select(
        "id", "mark", F.struct("g", salt.alias("salt"), (shares > 1).alias("split"), "done", "lo", "hi").alias("w"))
    wanted = materialise(wanted.groupBy("id", "mark").agg(F.collect_list("w").alias("w")), "wanted")
    cut = join_on(wanted, rows, ["id", "mark"])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, parts = [], []
            columns = (batch.column(2).to_pylist(), batch.column(3).to_pylist())
            for i, (places, value) in enumerate(zip(*columns, strict=True)):
                data = value.encode("utf-8", "surrogatepass")
                for w in places:
                    owner.append(i)
                    part = data[w["lo"] : w["hi"] + length]
                    parts.append((w["g"], w["salt"], w["split"], w["done"], w["lo"], w["hi"], part))
            at = pa.array(owner, "int64")
            kinds = (pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at)]
                + [pa.array([p[k] for p in parts], t) for k, t in enumerate(kinds)],
                ["id", "mark", "g", "salt", "split", "done", "lo", "hi", "data"])

    schema = (f"id {kind}, mark bigint, g bigint, salt int, split boolean, done boolean, lo bigint, hi bigint, "
              "data binary")
    dealt = cut.mapInArrow(pieces, schema).repartition(shuffle_width(docs), "g", "salt")
    dealt = dealt.sortWithinPartitions("g", "salt")

    def blocks(
        g: int, data: bytes, label: np.ndarray, often: np.ndarray, lo: int, done: bool, told: set
    ) -> list[tuple]:
        """Blocks with windows not told yet: (start, None, core, bytes, windows, windows still open), as bits."""
        (_, _, _, at), = domains(data, length, gram)
        out = []
        for b in sorted({(at - k) // BLOCK for k in range(len(label))}):
            low = max(0, at - BLOCK * b - BLOCK + 1)
            here = open_ = 0
            for k in range(low, min(len(label), at - BLOCK * b + 1)):
                if int(label[k]) not in told:
                    told.add(int(label[k]))
                    here |= 1 << (k - low)
                    open_ |= 0 if done or often[k] else 1 << (k - low)
            if here:
                core = at - BLOCK * b
                key = _digest(g.to_bytes(8, "little", signed=True) + b.to_bytes(4, "little")
                              + data[core : core + length - BLOCK + 1])
                part = data[low : min(len(label), core + 1) - 1 + length]
                out.append((lo + low, None, key, part, here, open_))
        return out

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # (batch, row, g, salt, split, done, lo, hi, data)
        size = 0

        def flush() -> pa.RecordBatch:
            numbers: dict[tuple, int] = {}
            groups = [numbers.setdefault((h[2], h[3]), len(numbers)) for h in held]
            counts = [h[7] - h[6] + 1 for h in held]
            label = classes([h[8] for h in held], counts, groups, length)
            often = np.bincount(label)[label] > 1
            names, rest, at = [], [], 0
            told: set[int] = set()
            for (batch, row, g, _, split, done, lo, _, data), n in zip(held, counts, strict=True):
                flags = often[at : at + n]
                out = []
                if not done:
                    out += [(a, b, None, None, 0, 0) for a, b in _spans(flags, lo, length)]
                if split:
                    out += blocks(g, data, label[at : at + n], flags, lo, done, told)
                names += [(batch, row)] * len(out)
                rest += out
                at += n
            none = held[0][0].slice(0, 0)
            ids = [pa.concat_arrays([none.column(c), *[b.column(c).slice(r, 1) for b, r in names]]) for c in (0, 1)]
            types = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.int32())
            return pa.RecordBatch.from_arrays(
                [*ids, *[pa.array([r[k] for r in rest], t) for k, t in enumerate(types)]],
                ["id", "mark", "start", "stop", "core", "data", "here", "open"])

        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(2, 9)]
            for r, values in enumerate(zip(*columns, strict=True)):
                if size >= SORTED and (held[-1][2], held[-1][3]) != values[:2]:
                    yield flush()
                    held, size = [], 0
                held.append((batch, r, *values))
                size += values[5] - values[4] + 1
        if held:
            yield flush()

    schema = f"id {kind}, mark bigint, start bigint, stop bigint, core binary, data binary, here int, open int"
    with small_batches(spark, 4096):
        sorted_ = materialise(dealt.mapInArrow(search, schema), "sorted-windows")
    inside = sorted_.where("core is null").select("id", "mark", "start", "stop")

    # 4. Blocks whose core is in several shares, then their windows.
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, found = [], []
            columns = [batch.column(k).to_pylist() for k in range(2, 6)]
            for i, (start, data, here, open_) in enumerate(zip(*columns, strict=True)):
                for k in range(BLOCK):
                    if here >> k & 1:
                        owner.append(i)
                        found.append((start + k, _digest(data[k : k + length]), bool(open_ >> k & 1)))
            at = pa.array(owner, "int64")
            types = (pa.int64(), pa.binary(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at)]
                + [pa.array([f[k] for f in found], t) for k, t in enumerate(types)],
                ["id", "mark", "start", "window", "open"])

    shared = sorted_.where("core is not null")
    met = shared.groupBy("core").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("core")
    again = shared.join(met, "core").select("id", "mark", "start", "data", "here", "open")
    schema = f"id {kind}, mark bigint, start bigint, window binary, open boolean"
    again = materialise(again.mapInArrow(each, schema), "shared-windows")
    often = again.groupBy("window").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("window")
    across = again.where("open").join(often, "window").select(
        "id", "mark", "start", (F.col("start") + length).alias("stop"))
    return settled.unionByName(whole).unionByName(inside).unionByName(across)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH,
                   gram: int = GRAM, group: int = GROUP, with_kept: bool = True) -> DataFrame:
    """Per row: ``id_col, n_bytes, n_removed, n_spans, kept_sha256``, the ``spans`` and the ``kept`` bytes.

    Every byte is removed that lies in a string of ``length`` bytes which also starts anywhere else, in
    the same text or another. Null counts as empty. Repeated rows are other places, so long enough
    texts of repeated rows lose all their bytes. Texts shorter than ``length`` stay whole.
    """
    spans = repeated_spans(docs, id_col, text, length, gram, group)
    gathered = materialise(
        spans.distinct().groupBy("id", "mark").agg(F.collect_list(F.struct("start", "stop")).alias("spans")), "spans")
    rows = keyed(docs, id_col, text)

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for places, value in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                data = value.encode("utf-8", "surrogatepass")
                runs = merged([(p["start"], p["stop"]) for p in places])
                kept, at = [], 0
                for a, b in runs:
                    kept.append(data[at:a])
                    at = b
                rest = b"".join([*kept, data[at:]])
                out.append((len(data) - len(rest), len(runs), hashlib.sha256(rest).hexdigest(), runs, rest))
            columns = [pa.array([o[0] for o in out], "int64"), pa.array([o[1] for o in out], "int64"),
                       pa.array([o[2] for o in out], "string")]
            names = ["id", "mark", "n_removed", "n_spans", "kept_sha256"]
            if with_kept:
                span = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
                columns += [pa.array([[{"start": a, "stop": b} for a, b in o[3]] for o in out], pa.list_(span)),
                            pa.array([o[4] for o in out], "binary")]
                names += ["spans", "kept"]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names)

    kind = dict(rows.dtypes)["id"]
    schema = f"id {kind}, mark bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + (
        ", spans array<struct<start:bigint,stop:bigint>>, kept binary" if with_kept else "")
    touched = join_on(gathered, rows, ["id", "mark"])
    with small_batches(docs.sparkSession):
        made = materialise(touched.select("id", "mark", "spans", "text").mapInArrow(strip, schema), "stripped")
    # Repeated rows have the same result.
    made = made.dropDuplicates(["id", "mark"])
    size, sha = F.octet_length("text").cast("bigint").alias("n_bytes"), F.sha2("text", 256).alias("_sha")
    plain = rows.select("id", "mark", size, sha, *([F.col("text").cast("binary").alias("_all")] if with_kept else []))
    out = join_on(plain, made, ["id", "mark"], "left")
    extra = [F.coalesce("spans", F.array().cast("array<struct<start:bigint,stop:bigint>>")).alias("spans"),
             F.coalesce("kept", "_all").alias("kept")] if with_kept else []
    return out.select(
        F.col("id").alias(id_col), "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"), F.coalesce("kept_sha256", "_sha").alias("kept_sha256"),
        *extra)
