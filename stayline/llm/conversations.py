"""Repair of conversation structure by the cheapest edits, with parallel Viterbi over chunks.

Roles have to follow ``(s?(ua)+)?`` by their initials. A row is kept (K, free), given the role user or assistant
(R, 2) or deleted (D, 3); rows without text can be inserted anywhere (I, 2); a truncated row that stays costs 1, a blank
or repeated one has to go. Of the cheapest edits, those with the least string of initials are taken.

Rows are ranked over the whole table and cut into chunks of equal length, so a conversation of any length is dealt to
many tasks. Backward costs: each chunk starts from a guessed vector behind its last row. A pass hands every chunk the
vector that the next one found at its first row; where it differs from the last one by more than a constant, the
chunk is run again until old and new vectors differ by a constant only. Passes go on until none changes. Tracing:
with the costs at its end a chunk is traced, from every state if its first conversation began earlier; the states are
then stitched along the chunks by doubling. One stream per conversation at last reads its rows beside their edits,
because a SHA-256 of a whole conversation can only be taken in order; it holds one row and the edits' letters.

A null role or text is one space. Rows of one turn are ordered by role and by the SHA-256 of the text; null turns come
first. A null conversation id is a conversation. Repeated rows are repeats. An empty table has no conversations.
Columns other than the four named ones are not read, so they may be called anything.
"""

from __future__ import annotations

import functools
import hashlib
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.llm.common import shuffle_width, small_batches, with_rank
from stayline.session import materialise

# Task functions travel with their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK_ROWS = 4096
BLANKS = " \t\n\v\f\r"
#: The costs.
DELETE, REROLE, INSERT, TRUNCATED = 3, 2, 2, 1
#: States: nothing yet, after s, after u, after a. An inserted or renamed row leads from each to:
NEXT = (2, 2, 3, 2)
#: Where a kept row leads, by the initial of its role.
KEPT = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None), "o": (None,) * 4}
#: Costs behind the last row of a conversation: what has to be inserted for a legal end.
END = (0, 2 * INSERT, INSERT, 0)


# --- one row, one vector -----------------------------------------------------------------------

def _moves(code: str, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of what can be done with a row, in the order of the letters."""
    found = [("D", DELETE, state)]
    if code not in "bd":
        extra = TRUNCATED if code.isupper() else 0
        kept = KEPT[code.lower()][state]
        if kept is not None:
            found.append(("K", extra, kept))
        found.append(("R", REROLE + extra, NEXT[state]))
    return found


_known: dict[tuple, tuple] = {}


def _before(code: str, after: tuple) -> tuple:
    """Costs in front of a row from those behind it, less a constant. Few pairs of code and vector exist."""
    found = _known.get((code, after))
    if found is None:
        row = [min(cost + after[to] for _, cost, to in _moves(code, q)) for q in range(4)]
        paired = [row[0], row[1], min(row[2], INSERT + row[3]), min(row[3], INSERT + row[2])]
        paired[0], paired[1] = min(row[0], INSERT + paired[2]), min(row[1], INSERT + paired[2])
        least = min(paired)
        found = _known[code, after] = tuple(c - least for c in paired)
    return found


def _backward(codes: str, after: tuple) -> list[tuple]:
    """The vector in front of each row, and the one behind the last."""
    found = [after]
    for code in reversed(codes):
        found.append(_before(code, found[-1]))
    return found[::-1]


def _rerun(codes: str, old: tuple, new: tuple, start: tuple) -> tuple:
    """The vector in front of the first row after the last one changed; ``start`` was it before the change."""
    for code in reversed(codes):
        if old == new:
            return start
        old, new = _before(code, old), _before(code, new)
    return new


def _trace(codes: str, costs: list[tuple], state: int, ends: bool) -> tuple[str, int]:
    """The least letters of the cheapest edits from ``state`` on, and the state behind them."""
    letters, at = [], 0
    while at < len(codes) or (ends and state in (1, 2)):
        here = costs[at]
        # Vectors are known up to a constant; it cancels out against the best move.
        options = [("I", INSERT + here[NEXT[state]], NEXT[state], at)]
        if at < len(codes):
            behind, shift = costs[at + 1], _shift(codes[at], costs[at + 1])
            options += [(m, c + behind[to] - shift, to, at + 1) for m, c, to in _moves(codes[at], state)]
        letter, _, state, at = min((o for o in options if o[1] == here[state]), key=lambda o: o[0])
        letters.append(letter)
    return "".join(letters), state


def _shift(code: str, after: tuple) -> int:
    """The constant that ``_before`` took off."""
    return min(cost + after[to] for q in range(4) for _, cost, to in _moves(code, q))


# --- chunks ------------------------------------------------------------------------------------

def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks with their rows' codes, cut where the conversation changes, and costs from a guessed end."""
    for batch in batches:
        kind = batch.schema.field("items").type.value_type.field("conv").type
        for chunk, items, firsts in zip(*(batch[c] for c in ("chunk", "items", "firsts"))):
            items, firsts = items.as_py(), set(firsts.as_py())
            convs, sizes, codes = [], [], []
            for i, item in enumerate(items):
                if not i or item["conv"] != convs[-1]:
                    convs.append(item["conv"])
                    sizes.append(0)
                sizes[-1] += 1
                code = item["code"]
                codes.append("d" if code != "b" and item["pos"] not in firsts else code)
            text = "".join(codes)
            start = _backward(text[:sizes[0]], END)[0]
            yield pa.RecordBatch.from_arrays([
                pa.array([chunk.as_py()], pa.int64()), pa.array([items[0]["pos"]], pa.int64()),
                pa.array([convs], pa.list_(kind)), pa.array([sizes], pa.list_(pa.int32())), pa.array([text]),
                pa.array([start], pa.list_(pa.int32())), pa.array([END], pa.list_(pa.int32())),
            ], names=["chunk", "pos", "convs", "sizes", "codes", "start", "behind"])


def _fix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One pass: take the vector found by the next chunk, run again as far as it makes a difference."""
    for batch in batches:
        for row in batch.to_pylist():
            behind, start, wanted = tuple(row["behind"]), tuple(row["start"]), row["wanted"]
            fresh = start
            if wanted is not None and tuple(wanted) != behind:
                if len(row["sizes"]) == 1:
                    fresh = _rerun(row["codes"], behind, tuple(wanted), start)
                behind = tuple(wanted)
            yield pa.RecordBatch.from_pydict({
                "chunk": pa.array([row["chunk"]], pa.int64()),
                "start": pa.array([fresh], pa.list_(pa.int32())), "behind": pa.array([behind], pa.list_(pa.int32())),
                "changed": [fresh != start]})


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per chunk and conversation: its codes, the edits from each state it may begin in, and the states behind them."""
    for batch in batches:
        kind = batch.schema.field("convs").type.value_type
        for row in batch.to_pylist():
            at, out = 0, []
            for i, (conv, size) in enumerate(zip(row["convs"], row["sizes"])):
                codes = row["codes"][at:at + size]
                ends = i + 1 < len(row["sizes"]) or not row["goes_on"]
                costs = _backward(codes, END if ends else tuple(row["behind"]))
                begun = i == 0 and row["came_from"]
                traced = [_trace(codes, costs, state, ends) for state in (range(4) if begun else [0])]
                out.append((conv, row["pos"] + at, codes, [t[0] for t in traced], [t[1] for t in traced] * (5 - len(traced)),
                            begun, i + 1 == len(row["sizes"])))
                at += size
            conv, pos, codes, audits, states, begun, last = zip(*out)
            yield pa.RecordBatch.from_arrays([
                pa.array([row["chunk"]] * len(out), pa.int64()), pa.array(conv, kind), pa.array(pos, pa.int64()),
                pa.array(codes), pa.array(audits, pa.list_(pa.string())),
                pa.array([s[:4] for s in states], pa.list_(pa.int32())), pa.array(begun), pa.array(last),
            ], names=["chunk", "conv", "pos", "codes", "audits", "states", "begun", "last"])


def _with_costs(chunks: DataFrame) -> DataFrame:
    """Chunks with the final vector behind their last row, and whether they share a conversation with a neighbour."""
    ends = chunks.select("chunk", F.get("convs", F.lit(0)).alias("head"), F.element_at("convs", -1).alias("tail"))
    after = ends.select((F.col("chunk") - 1).alias("chunk"), F.col("head").alias("next_head"), F.lit(True).alias("follows"))
    joints = ends.join(after, "chunk").where(F.col("tail").eqNullSafe(F.col("next_head"))).select("chunk")
    joints = materialise(joints.withColumn("goes_on", F.lit(True)), "joints")
    vectors = chunks.select("chunk", "start", "behind")
    while True:
        wanted = vectors.select((F.col("chunk") - 1).alias("chunk"), F.col("start").alias("wanted")).join(joints, "chunk")
        asked = chunks.select("chunk", "sizes", "codes").join(vectors, "chunk").join(
            wanted.select("chunk", "wanted"), "chunk", "left")
        vectors = materialise(asked.mapInArrow(
            _fix, "chunk bigint, start array<int>, behind array<int>, changed boolean"), "vectors")
        if vectors.where("changed").isEmpty():
            break
    came = joints.select((F.col("chunk") + 1).alias("chunk"), F.col("goes_on").alias("came_from"))
    return chunks.drop("start", "behind").join(vectors.select("chunk", "behind"), "chunk").join(
        joints, "chunk", "left").join(came, "chunk", "left").na.fill(False, ["goes_on", "came_from"])


def _stitched(edits: DataFrame) -> DataFrame:
    """Rows (conv, pos, codes, audit): of the traced edits those from the state that the chunk before ends in."""
    constant = F.size(F.array_distinct("states")) == 1
    runs = edits.where("last").select("chunk", (F.col("chunk") - 1).alias("back"), "states", (~F.col("begun")).alias("closed"))
    runs = runs.select("chunk", "back", "states", (F.col("closed") | constant).alias("closed"))
    while not runs.where("not closed").isEmpty():
        before = runs.select(F.col("chunk").alias("back"), F.col("back").alias("far"), F.col("states").alias("earlier"))
        further = F.transform("earlier", lambda q: F.get("states", q))
        runs = runs.join(before, "back", "left").select(
            "chunk", F.when(F.col("closed"), F.col("back")).otherwise(F.col("far")).alias("back"),
            F.when(F.col("closed"), F.col("states")).otherwise(further).alias("states"))
        runs = materialise(runs.select("*", constant.alias("closed")), "runs")
    entry = runs.select((F.col("chunk") + 1).alias("chunk"), F.get("states", F.lit(0)).alias("entry"))
    state = F.when(F.col("begun"), F.col("entry")).otherwise(0)
    return edits.join(entry, "chunk", "left").select("conv", "pos", "codes", F.get("audits", state).alias("audit"))


# --- rows --------------------------------------------------------------------------------------

def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Faults for tests and drills, by the checksum of conversation and turn: rows dropped, emptied, cut, repeated."""
    space = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(f"`{c}`").cast("string"), space) for c in (conv, turn)])
    kind = F.crc32(key.cast("binary")) % 20
    value, name = F.coalesce(F.col(f"`{text}`"), space), F.coalesce(F.col(f"`{role}`"), space)
    return rows.where(kind != 0).select(
        F.col(f"`{conv}`").alias(conv), F.col(f"`{turn}`").alias(turn), F.when(kind == 4, "user").otherwise(name).alias(role),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(value, "[.!?]", "")).otherwise(value).alias(text),
        F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("_"),
    ).drop("_")


def _ordered(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    space = F.lit(" ")
    named = rows.select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("bigint").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), space).alias("role"), F.coalesce(F.col(f"`{text}`"), space).alias("text"))
    return named.withColumn("digest", F.unhex(F.sha2("text", 256)))


def _code() -> Column:
    """b for a blank row, else the initial of its role (o for others), in capitals if the text is cut off."""
    told = F.rtrim("text", F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    return F.when(told == "", "b").when(F.right(told, F.lit(1)).isin(".", "!", "?"), letter).otherwise(F.upper(letter))


def edits(ordered: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Rows (conv, pos, codes, audit): of each stretch of a conversation its rows' codes and the edits' letters."""
    narrow = ordered.select("conv", "turn", "role", "digest", _code().alias("code"),
                            F.monotonically_increasing_id().alias("arrival"))  # equal rows may stand in any order
    order = [F.col(c) for c in ("conv", "turn", "role", "digest", "arrival")]
    ranked = with_rank(narrow, order, "pos")
    firsts = ranked.groupBy("conv", "role", "digest").agg(F.min("pos").alias("first"))
    item = F.struct("pos", "conv", "code")
    none = F.lit(None)
    both = ranked.select(F.expr(f"pos div {chunk_rows}").alias("chunk"), item.alias("item"),
                         none.cast("bigint").alias("first")).unionByName(
        firsts.select(F.expr(f"first div {chunk_rows}").alias("chunk"),
                      none.cast(ranked.select(item.alias("i")).schema["i"].dataType).alias("item"), "first"))
    whole = both.groupBy("chunk").agg(  # at most chunk_rows of each
        F.sort_array(F.collect_list("item")).alias("items"), F.collect_list("first").alias("firsts"))
    kind = ordered.schema["conv"].dataType.simpleString()
    with small_batches(ordered.sparkSession, 16):  # chunks at a time
        chunks = materialise(whole.mapInArrow(
            _cut, f"chunk bigint, pos bigint, convs array<{kind}>, sizes array<int>, codes string, start array<int>, "
                  "behind array<int>"), "chunks")
        traced = materialise(_with_costs(chunks).mapInArrow(
            _edits, f"chunk bigint, conv {kind}, pos bigint, codes string, audits array<string>, states array<int>, "
                    "begun boolean, last boolean"), "edits")
    return _stitched(traced)


def _beside(ordered: DataFrame, found: DataFrame, conversations: DataFrame) -> DataFrame:
    """Per conversation a head, then its edits in order, then its rows in order; conversations are dealt by hash."""
    none = F.lit(None).cast("string")
    heads = conversations.select("conv", F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("pos"),
                                 none.alias("a"), none.alias("b"), F.lit(None).cast("binary").alias("digest"))
    letters = found.select("conv", F.lit(1).alias("kind"), "pos", F.col("codes").alias("a"), F.col("audit").alias("b"),
                           F.lit(None).cast("binary").alias("digest"))
    rows = ordered.select("conv", F.lit(2).alias("kind"), F.col("turn").alias("pos"), F.col("role").alias("a"),
                          F.col("text").alias("b"), "digest")
    both = heads.unionByName(letters).unionByName(rows)
    # The edits and the rows of a conversation are each in the order of the ranks.
    by_role = F.when(F.col("kind") == 2, F.col("a"))
    return both.repartition(shuffle_width(both), "conv").sortWithinPartitions("conv", "kind", "pos", by_role, "digest")


class _Conversation:
    """Counts of one conversation and its repaired rows, fed in order."""

    def __init__(self, conv):
        self.conv, self.codes, self.audit = conv, [], []
        self.turns, self.least, self.last = 0, None, None
        self.illegal, self.cost, self.initial = 0, 0, None
        self.state, self.row, self.at = 0, 0, 0

    def begin(self) -> None:
        self.codes, self.audit = "".join(self.codes), "".join(self.audit)

    def _made(self, text: str) -> tuple[str, str]:
        role = "assistant" if self.state == 2 else "user"
        self.state = NEXT[self.state]
        return role, text

    def _inserted(self) -> Iterator[tuple[str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            self.cost += INSERT
            yield self._made("")

    def feed(self, turn: int | None, role: str, text: str) -> Iterator[tuple[str, str]]:
        if turn is not None and turn != self.last:
            self.turns += 1
            self.least, self.last = turn if self.least is None else self.least, turn
        if self.row:
            self.illegal += self.initial + role[:1] not in ("su", "ua", "au")
        self.initial = role[:1]
        yield from self._inserted()
        code, letter = self.codes[self.row], self.audit[self.at]
        self.row, self.at = self.row + 1, self.at + 1
        if letter == "D":
            self.cost += DELETE
            return
        self.cost += code.isupper() * TRUNCATED
        if letter == "K":
            self.state = KEPT[role[:1]][self.state]
            yield role, text
        else:
            self.cost += REROLE
            yield self._made(text)

    def finish(self) -> Iterator[tuple[str, str]]:
        yield from self._inserted()

    def counts(self) -> dict:
        faults = {"blank": self.codes.count("b"), "duplicate": self.codes.count("d"),
                  "truncated": sum(map(self.codes.count, "SUAO"))}
        gaps = 0 if self.least is None else self.last - self.least + 1 - self.turns
        return {"gaps": gaps, **faults, "illegal": self.illegal, "cost": self.cost, "audit": self.audit}


def _events(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Conversation, tuple[str, str] | None]]:
    """Repaired rows with their conversation; None after its last one."""
    now = None
    for batch in batches:
        for conv, kind, pos, a, b in zip(*(batch[c].to_pylist() for c in ("conv", "kind", "pos", "a", "b"))):
            if kind == 0:
                if now:
                    yield from _closing(now)
                now = _Conversation(conv)
            elif kind == 1:
                now.codes.append(a)
                now.audit.append(b)
            else:
                if not now.row:
                    now.begin()
                for made in now.feed(pos, a, b):
                    yield now, made
    if now:
        yield from _closing(now)


def _closing(now: _Conversation) -> Iterator[tuple[_Conversation, tuple[str, str] | None]]:
    if not now.row:
        now.begin()
    for made in now.finish():
        yield now, made
    yield now, None


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashed, empty, out, kind = hashlib.sha256(), True, [], None

    def seen() -> Iterator[pa.RecordBatch]:
        nonlocal kind
        for batch in batches:
            kind = batch.schema.field("conv").type
            yield batch

    def made() -> pa.RecordBatch:
        convs, counts, digests = zip(*out)
        return pa.RecordBatch.from_arrays([
            pa.array(convs, kind), *[pa.array([c[n] for c in counts], pa.int64()) for n in _COUNTS],
            pa.array([c["audit"] for c in counts]), pa.array(digests)],
            names=["conv", *_COUNTS, "audit", "repaired_sha256"])

    for conversation, row in _events(seen()):
        if row is None:
            out.append((conversation.conv, conversation.counts(), hashed.hexdigest()))
            hashed, empty = hashlib.sha256(), True
            if len(out) == 256:
                yield made()
                out = []
            continue
        if not empty:
            hashed.update(b"\n")
        hashed.update(f"{row[0]}:{row[1]}".encode())
        empty = False
    if out:
        yield made()


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    place, kind, out = 0, None, []

    def seen() -> Iterator[pa.RecordBatch]:
        nonlocal kind
        for batch in batches:
            kind = batch.schema.field("conv").type
            yield batch

    def made() -> pa.RecordBatch:
        convs, places, roles, texts = zip(*out)
        return pa.RecordBatch.from_arrays(
            [pa.array(convs, kind), pa.array(places, pa.int64()), pa.array(roles), pa.array(texts)],
            names=["conv", "place", "role", "text"])

    for conversation, row in _events(seen()):
        if row is None:
            place = 0
            continue
        out.append((conversation.conv, place, *row))
        place += 1
        if len(out) == 256:
            yield made()
            out = []
    if out:
        yield made()


def _streamed(rows, conversations, columns, chunk_rows) -> DataFrame:
    ordered = _ordered(rows, *columns)
    named = [t.select(F.col(f"`{columns[0]}`").alias("conv")) for t in (rows, conversations) if t is not None]
    return _beside(ordered, edits(ordered, chunk_rows), functools.reduce(DataFrame.unionByName, named).distinct())


def repair(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """The repaired rows: (``conv``, place, role, text), places from 0."""
    beside = _streamed(rows, None, (conv, turn, role, text), chunk_rows)
    kind = beside.schema["conv"].dataType.simpleString()
    with small_batches(rows.sparkSession):
        made = materialise(beside.mapInArrow(_repaired, f"conv {kind}, place bigint, role string, text string"), "repaired")
    return made.withColumnRenamed("conv", conv)


def audit(
    rows: DataFrame, conversations: DataFrame | None = None, conv: str = "conv_id", turn: str = "turn",
    role: str = "role", text: str = "text", chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """One row per conversation of ``rows``, and of ``conversations`` if given.

    Columns: ``conv``, gaps (turns missing between the least and the largest), blank, duplicate, truncated, illegal
    (neighbours whose initials are not su, ua or au), cost, audit (the edits' letters) and repaired_sha256 (of the
    repaired rows as ``role:text``, joined by newlines). Without rows: zeros, no edits, the hash of an empty string.
    """
    beside = _streamed(rows, conversations, (conv, turn, role, text), chunk_rows)
    kind = beside.schema["conv"].dataType.simpleString()
    schema = f"conv {kind}, {', '.join(f'{c} bigint' for c in _COUNTS)}, audit string, repaired_sha256 string"
    with small_batches(rows.sparkSession):
        made = materialise(beside.mapInArrow(_audits, schema), "audits")
    return made.withColumnRenamed("conv", conv)
