"""Exact token count at every prefix of a text, by dynamic programming over prefixes.

For byte-pair vocabularies an encoding is the one sequence of tokens in which every two neighbours
would also be encoded that way by themselves. So the encoding of a prefix is that of a shorter prefix
plus one last token that is compatible with the token before it, and the count at a prefix is one more
than at the shorter one. The counts of all prefixes of a word come from one pass over its bytes; words
of a corpus repeat, so each is done once per task. A table of counts answers truncation and budget
questions without encoding again.
"""

from __future__ import annotations

import contextlib
import json
import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm.common import small_batches, text_of
from stayline.llm.tokens import PATTERN, byte_letters
from stayline.session import materialise

VOCABULARY = "byte_bpe_50k.json"
#: The contractions of that pattern that have two letters.
CONTRACTIONS = ("'re", "'ve", "'ll")
#: White space as that pattern means it, in runs of two or more.
_RUN = regex.compile(r"\s\s+")
_BESIDE_SPACE = regex.compile(r"\s ")


class PrefixCounter:
    """Counts of all prefixes under a byte-level vocabulary file."""

    def __init__(self, path: str, limit: int = 600_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        raw = lambda s: bytes(letters[c] for c in s)
        self._special = [t["content"] for t in spec["added_tokens"]]
        self._tokens = {raw(t) for t in spec["model"]["vocab"] if t not in self._special}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        self._rank = {(raw(a), raw(b)): i for i, (a, b) in enumerate(pairs)}
        self._ends = {t[i:] for t in self._tokens for i in range(len(t))}
        self._split = regex.compile(PATTERN)
        self._specials = regex.compile("|".join(map(regex.escape, self._special))) if self._special else None
        self._fits: dict[tuple[bytes, bytes], bool] = {}
        self._states: dict[bytes, tuple[int, bytes]] = {}
        self._word_steps: dict[str, bytes] = {}
        self._chunks: dict[str, bytes] = {}
        self._limit = limit

    def _merge(self, data: bytes) -> list[bytes]:
        """The encoding of a few bytes by its definition: the best pair first."""
        parts = [data[i : i + 1] for i in range(len(data))]
        rank, none = self._rank.get, 1 << 60
        ranks = [rank(pair, none) for pair in zip(parts, parts[1:])]
        while ranks and (best := min(ranks)) < none:
            at = ranks.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at < len(ranks):
                ranks[at] = rank((parts[at], parts[at + 1]), none)
            if at:
                ranks[at - 1] = rank((parts[at - 1], parts[at]), none)
        return parts

    def _compatible(self, left: bytes, right: bytes) -> bool:
        key = (left, right)
        known = self._fits.get(key)
        if known is None:
            if len(self._fits) >= self._limit:
                self._fits.clear()
            known = self._merge(left + right) == ([left, right] if left else [right])
            self._fits[key] = known
        return known

    def word(self, word: str) -> list[int]:
        """Counts at every prefix of one pre-token, by code points, from 1 on."""
        data = word.encode()
        tokens, ends, states = self._tokens, self._ends, self._states
        counts, last = [0], [b""]
        for p in range(1, len(data) + 1):
            # Words share their beginnings: what a prefix ends with is known from an earlier word.
            state = states.get(data[:p]) if p <= 32 else None
            if state is not None:
                counts.append(state[0])
                last.append(state[1])
                continue
            found, q = [], p - 1
            while q >= 0 and data[q:p] in ends:
                if data[q:p] in tokens:
                    found.append(q)
                q -= 1
            # The longest that agrees with the token before it; exactly one token does.
            for q in reversed(found):
                if self._compatible(last[q], data[q:p]):
                    counts.append(counts[q] + 1)
                    last.append(data[q:p])
                    break
            else:
                raise ValueError("the vocabulary does not hold all single bytes")
            if p <= 32:
                if len(states) >= self._limit:
                    states.clear()
                states[data[:p]] = (counts[p], last[p])
        if word in CONTRACTIONS:  # cut before its end it is none
            counts[2] = 2
        if len(data) == len(word):
            return counts[1:]
        places = np.cumsum([len(c.encode()) for c in word]).tolist()  # the ends of code points
        return [counts[p] for p in places]

    def _steps_of(self, word: str) -> bytes:
        known = self._word_steps.get(word)
        if known is None:
            counts = self.word(word)
            known = array("h", [b - a for a, b in zip([0, *counts], counts)]).tobytes()
            if len(word) <= 64:
                if len(self._word_steps) >= self._limit:
                    self._word_steps.clear()
                self._word_steps[word] = known
        return known

    def _plain(self, text: str) -> np.ndarray:
        """Counts at every prefix of a text without special strings."""
        words = self._split.findall(text)
        steps = np.frombuffer(b"".join(map(self._steps_of, words)), "<i2")
        out = np.cumsum(steps, dtype=np.int64)
        if not _RUN.search(text):
            return out
        # White space at the end of a prefix is one pre-token, also the space that goes to the next word.
        for m in _RUN.finditer(text):
            a, b = m.span()
            out[a:b] = (out[a - 1] if a else 0) + np.array(self.word(text[a:b]))
        return out

    def text(self, text: str) -> np.ndarray:
        """Counts at every prefix: entry i is the number of tokens of the first i + 1 code points."""
        if self._specials is None or not self._specials.search(text):
            return self._plain(text)
        out, base, at = [], 0, 0
        for m in self._specials.finditer(text):
            # Inside the special string a prefix ends with ordinary text.
            part = self._plain(text[at : m.end() - 1])
            own = part[m.start() - at - 1] if m.start() > at else 0
            out += [base + part, np.array([base + own + 1], np.int32)]
            base, at = base + int(own) + 1, m.end()
        return np.concatenate([*out, base + self._plain(text[at:])])

    def _steps(self, chunk: str) -> bytes:
        if _RUN.search(chunk):
            return np.diff(self._plain(chunk), prepend=0).astype("<i2").tobytes()
        return b"".join(map(self._steps_of, self._split.findall(chunk)))

    def steps(self, text: str) -> bytes:
        """The differences of ``text(text)`` as little-endian signed 16-bit numbers: the stored table."""
        if _BESIDE_SPACE.search(text) or (self._specials is not None and self._specials.search(text)):
            return np.diff(self.text(text), prepend=0).astype("<i2").tobytes()
        # No white space stands before a space, so each chunk in front of a space is counted by itself.
        first, *rest = text.split(" ")
        known = list(map(self._chunks.get, rest))
        at = -1
        with contextlib.suppress(ValueError):
            while True:
                at = known.index(None, at + 1)
                known[at] = self._steps(" " + rest[at])
                if len(rest[at]) <= 64:
                    if len(self._chunks) >= self._limit:
                        self._chunks.clear()
                    self._chunks[rest[at]] = known[at]
        return self._steps(first) + b"".join(known)


_counters: dict[str, PrefixCounter] = {}


def counter(name: str) -> PrefixCounter:
    """One counter per Python worker and vocabulary; ``name`` is a file name or a path."""
    if name not in _counters:
        path = name
        if not os.path.isabs(name):
            import public_tokenizers

            path = public_tokenizers.path(name)
        _counters[name] = PrefixCounter(str(path))
    return _counters[name]


def prefix_table(docs: DataFrame, id_col: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY,
                 keep_table: bool = True) -> DataFrame:
    """Per row: ``id_col, n_bytes, n_tokens`` and, if kept, ``prefix_steps``.

    ``prefix_steps`` holds a signed 16-bit number per code point: by how much the count changes there.
    ``n_tokens`` is the sum of them, so it is read off the table. A null text counts as empty, with an
    empty table and no tokens. The result is written once.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = counter(vocabulary)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            tables = [made.steps(t) for t in texts]
            totals = [int(np.frombuffer(t, "<i2").sum(dtype=np.int64)) for t in tables]
            columns = [batch.column(0), batch.column(2), pa.array(totals, "int64")]
            names = [id_col, "n_bytes", "n_tokens"]
            if keep_table:
                columns.append(pa.array(tables, "binary"))
                names.append("prefix_steps")
            yield pa.RecordBatch.from_arrays(columns, names)

    source = docs.select(F.col(f"`{id_col}`"), text_of(text).alias("_text"),
                         F.octet_length(text_of(text)).cast("bigint").alias("_bytes"))
    kind = source.schema[0].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint" + ", prefix_steps binary" * keep_table
    with small_batches(docs.sparkSession):
        return materialise(source.mapInArrow(count, schema), "prefix-counts")


def longest_within(table: DataFrame, budget: int) -> DataFrame:
    """Add ``n_chars_kept`` and ``n_tokens_kept``: the longest prefix of at most ``budget`` tokens."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, used = [], []
            for steps in batch.column("prefix_steps").to_pylist():
                counts = np.cumsum(np.frombuffer(steps or b"", "<i2"), dtype=np.int64)
                inside = np.flatnonzero(counts <= budget)
                kept.append(int(inside[-1]) + 1 if len(inside) else 0)
                used.append(int(counts[inside[-1]]) if len(inside) else 0)
            columns = [*batch.columns, pa.array(kept, "int64"), pa.array(used, "int64")]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "n_chars_kept", "n_tokens_kept"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema)
    return table.mapInArrow(cut, f"{fields}, n_chars_kept bigint, n_tokens_kept bigint")
