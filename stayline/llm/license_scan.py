"""License scans: MinHash bands over overlapping text windows find templates, shingle containment verifies.

The shingles of a text are cut into overlapping windows sized to each template. A window and a template
become candidates when they agree in some band; the number of bands is set so that a window which
holds the template well enough is a candidate with ``RECALL``. A candidate counts only if the window
holds at least 0.8 of the template's distinct shingles exactly. Shingles have five words; a template of
fewer words is one shingle of its own word count, compared with text shingles of that count. A window
without any shingle of a template agrees with it in no band; only windows with one are hashed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm.common import small_batches, text_of
from stayline.llm.jaccard_forest import WORDS, shingles_of, word_hashes
from stayline.session import materialise

CONTAINMENT = 0.8
RECALL = 0.99999
#: A template may be spread over this many times its length.
SLACK = 1.25
_SEED = 77_001
_MARK_BITS = 20


def step_of(size: int) -> int:
    """Shingles from one window to the next for a template of ``size`` distinct shingles; a window has two steps."""
    return math.ceil(SLACK * size)


def bands(sizes: Sequence[int], containment: float = CONTAINMENT, recall: float = RECALL) -> int:
    """Bands of one MinHash value each, for the least similarity of a window that holds a template of these sizes.

    A window has two steps of shingles, of which at least ``containment`` of the template's are the template's.
    """
    least = min(need / (2 * step_of(n) + n - need) for n in sizes for need in (math.ceil(containment * n),))
    return math.ceil(math.log(1 - recall) / math.log(1 - least))


class Scanner:
    """The bounded template side: sets, window lengths and band values."""

    def __init__(self, templates: Sequence[tuple[str, str]]):
        self.names = [n for n, _ in templates]
        words = [word_hashes(t) for _, t in templates]
        if any(not len(w) for w in words):
            raise ValueError("a template has no words")
        self.sets = [np.unique(shingles_of(w)) for w in words]
        rng = np.random.default_rng(_SEED)
        drawn = rng.integers(0, 1 << 63, (bands([len(s) for s in self.sets]), 2), dtype=np.uint64)
        self.factor, self.shift = drawn[:, :1] * np.uint64(2) + np.uint64(1), drawn[:, 1:]
        # By words of a shingle, then by step.
        self.by_words: dict[int, dict[int, list[int]]] = {}
        for i, s in enumerate(self.sets):
            by_step = self.by_words.setdefault(min(WORDS, len(words[i])), {})
            by_step.setdefault(step_of(len(s)), []).append(i)
        self.values = [self.hashed(s).min(1) for s in self.sets]
        # Which shingles are in a template of a step; ``marks`` tells by the first bits that most are in none.
        self.wanted = {n: {step: np.unique(np.concatenate([self.sets[i] for i in members]))
                           for step, members in by_step.items()} for n, by_step in self.by_words.items()}
        self.all = {n: np.unique(np.concatenate(list(by_step.values()))) for n, by_step in self.wanted.items()}
        self.marks = {n: np.zeros(1 << _MARK_BITS, bool) for n in self.all}
        for n, values in self.all.items():
            self.marks[n][values >> np.uint64(64 - _MARK_BITS)] = True

    def hashed(self, values: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            x = values[None, :] * self.factor + self.shift
            return x ^ (x >> np.uint64(32))

    def scan(self, text: str) -> dict[str, tuple[float, int, int]]:
        """Per license: the best containment, the first word of its first window, the windows that hold it."""
        words = word_hashes(text)
        found: dict[str, tuple[float, int, int]] = {}
        for n_words in self.by_words:
            if len(words) >= n_words:
                self._scan(shingles_of(words, n_words), n_words, found)
        return found

    def _scan(self, run: np.ndarray, n_words: int, found: dict[str, tuple[float, int, int]]) -> None:
        by_step = self.by_words[n_words]
        held = np.flatnonzero(self.marks[n_words][run >> np.uint64(64 - _MARK_BITS)])
        if len(held):
            held = held[np.isin(run[held], self.all[n_words])]
        if not len(held):
            return
        width = 1 << 15
        # Long texts go by pieces that overlap by two windows of the largest template.
        reach = 4 * max(by_step)
        for at in range(0, len(run), width):
            part = run[at : at + width + reach]
            near = held[slice(*np.searchsorted(held, [at, at + len(part)]))] - at
            if not len(near):
                continue
            for step, members in by_step.items():
                block = np.unique(near[np.isin(part[near], self.wanted[n_words][step])] // step)
                # Windows of two blocks that begin in this piece and hold a shingle of a template.
                places = np.unique(np.concatenate([block, block - 1]))
                starts = places[(places >= 0) & (places * step < width)] * step
                # Many windows go by some 32,768 shingles at a time.
                for some in np.array_split(starts, 2 * step * len(starts) // width + 1):
                    self._match(part, some, step, members, at, found)

    def _match(self, part: np.ndarray, starts: np.ndarray, step: int, members: list[int], at: int,
               found: dict[str, tuple[float, int, int]]) -> None:
        if not len(starts):
            return
        # A window that is cut by the end repeats its last shingle.
        inside = np.minimum(starts[:, None] + np.arange(2 * step), len(part) - 1)
        window = self.hashed(part[inside].ravel()).reshape(-1, len(starts), 2 * step).min(2)
        for i in members:
            for a in starts[(window == self.values[i][:, None]).any(0)].tolist():
                held = np.isin(self.sets[i], part[a : a + 2 * step]).mean()
                if held >= CONTAINMENT:
                    best, first, n = found.get(self.names[i], (0.0, at + a, 0))
                    found[self.names[i]] = (max(best, float(held)), min(first, at + a), n + 1)


_scanners: dict[tuple, Scanner] = {}


def scanner(templates: tuple[tuple[str, str], ...]) -> Scanner:
    """One scanner per Python worker and set of templates."""
    if templates not in _scanners:
        _scanners[templates] = Scanner(templates)
    return _scanners[templates]


def scan(docs: DataFrame, templates: Sequence[tuple[str, str]], id_col: str = "doc_id",
         text: str = "text") -> DataFrame:
    """One row per row of ``docs`` and license found: ``id_col, license, containment, first_word, windows``.

    A license may have several templates; ``containment`` is the best of them. ``first_word`` is where the
    first window that holds a template begins, counted in words from 0; ``windows`` counts the windows.
    Null and empty texts hold nothing, an empty table gives an empty one, and each of repeated rows is reported.
    Only the id and the text are read, so other columns may be called anything.
    """
    fixed = tuple((str(a), str(b)) for a, b in templates)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = scanner(fixed)
        for batch in batches:
            owner, rows = [], []
            for i, value in enumerate(batch.column(1).to_pylist()):
                for name, (best, first, n) in sorted(made.scan(value).items()):
                    owner.append(i)
                    rows.append((name, best, first, n))
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(
                (pa.string(), pa.float64(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner, "int64")), *columns],
                [id_col, "license", "containment", "first_word", "windows"])

    rows = docs.select(F.col(f"`{id_col}`"), text_of(text).alias("_text"))
    kind = rows.schema[0].dataType.simpleString()
    schema = f"`{id_col}` {kind}, license string, containment double, first_word bigint, windows bigint"
    with small_batches(docs.sparkSession):
        return materialise(rows.mapInArrow(find, schema), "licenses")
