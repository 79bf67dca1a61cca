"""Token ids of whole texts with the ``tokenizers`` library, through a bounded cache of chunks."""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: A space after white space and before white space or the end: there a chunk is not independent of the next.
_UNSAFE = re.compile(r"\s (?!\S)")


#: Fixed value: the pre-token pattern of byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Below this character the pattern library and the tokenizer library agree on what a letter is.
_COMMON = "\u0250"


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: itself if printable, else from 256 on."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}

#: White space that parts chunks where several are cut at once.
MARK = "\r"
_LETTERS = r"[!-~\u00a1-\u00ac\u00ae-\u012f\u0131-\u017f]+"
#: Chunks that may stand between marks: their normal form is their lower case, character by character, and white space
#: in them is line breaks with other characters on both sides.
_PLAIN = re.compile(rf"{_LETTERS}(?:\n+{_LETTERS})*").fullmatch

#: Longer chunks are not kept.
KEPT_CHARS = 64


def _data(values: pa.Array) -> memoryview:
    """The bytes of all values of a large string or binary array that is no slice."""
    end = np.frombuffer(values.buffers()[1], "<i8")[len(values)] if len(values) else 0
    return memoryview(values.buffers()[2] or b"")[:end]


def spaced_chunks(texts: list[str]) -> tuple[pa.LargeStringArray, np.ndarray]:
    """What ``text.split(" ")`` gives, of all texts one after the other, and how many chunks each text has."""
    whole = pa.array(texts, pa.large_string())
    ends = np.frombuffer(whole.buffers()[1], "<i8")[1 : len(texts) + 1]
    data = np.frombuffer(whole.buffers()[2] or b"", "u1")[: ends[-1] if len(ends) else 0]
    space = data == ord(" ")
    at = np.flatnonzero(space)
    before = np.searchsorted(at, ends)  # spaces in this text and those before it
    last = before + np.arange(len(texts))
    bounds = np.zeros(len(at) + len(texts) + 1, "<i8")  # chunks end at spaces and at ends, and hold no space
    inner = np.ones(len(at) + len(texts), bool)
    inner[last] = False
    bounds[1:][last], bounds[1:][inner] = ends - before, at - np.arange(len(at))
    chunks = pa.LargeStringArray.from_buffers(len(inner), pa.py_buffer(bounds), pa.py_buffer(data[~space]))
    return chunks, np.diff(last, prepend=-1)


class ChunkEncoder:
    """Encodes texts as little-endian unsigned 32-bit ids.

    Words of a corpus repeat, so each space-separated chunk is encoded once and its ids are kept. No
    pre-token of the supported files crosses the boundary in front of a single space, so the ids of a
    text are those of its chunks; texts where white space makes that untrue, and texts that hold a
    special string, go to the library whole. A new chunk is cut into pre-tokens, and the library's
    model encodes those not seen yet. Each cache holds two generations of at most ``limit`` entries: a
    full one becomes the old one, from which entries in use are taken over. Entries are short: chunks above ``KEPT_CHARS``
    are encoded each time they come, so the caches are bounded in bytes, too. That changes no result.
    """

    def __init__(self, path: str, spaced: bool, limit: int = 200_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._spaced = spaced  # whether a space belongs to the chunk after it
        self._limit = limit
        self._known: dict[str, bytes] = {}
        self._parts: dict[str, bytes] = {}
        self._old_known: dict[str, bytes] = {}
        self._old_parts: dict[str, bytes] = {}
        spec = json.loads(self._tokenizer.to_str())["pre_tokenizer"]
        pattern = PATTERN if spec["type"] == "ByteLevel" else spec["pretokenizers"][0]["pattern"]["Regex"]
        self._split = regex.compile(pattern).findall
        self._split_marked = regex.compile(f"{MARK}|{pattern}").findall
        self._letters = {byte: letter for letter, byte in byte_letters().items()}
        self._space = self._letters[ord(" ")]
        normalizer = self._tokenizer.normalizer
        self._normal = normalizer.normalize_str if normalizer else None
        self._tokenize = self._tokenizer.model.tokenize

    def whole(self, text: str) -> bytes:
        """The library's own ids of the whole text."""
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _pretoken(self, word: str) -> bytes:
        """Ids of a pre-token that is written in the letters of the vocabulary."""
        return array("I", [t.id for t in self._tokenize(word)]).tobytes()

    def _written(self, word: str) -> str:
        """A pre-token in the letters of the vocabulary."""
        if word.isascii() and word.isprintable():
            return word.replace(" ", self._space)
        return word.encode().decode("latin-1").translate(self._letters)

    def _learn_parts(self, words: list[str]) -> list[bytes]:
        found = list(map(self._old_parts.get, words))
        for k, ids in enumerate(found):
            if ids is None:
                found[k] = self._pretoken(self._written(words[k]))
        if len(self._parts) + len(found) > self._limit:
            self._old_parts, self._parts = self._parts, {}
        self._parts.update((word, ids) for word, ids in zip(words, found) if len(word) <= KEPT_CHARS)
        return found

    def _chunk(self, text: str) -> bytes:
        if self._normal is not None:
            text = text.lower() if text.isascii() else self._normal(text)
        if not text.isascii() and max(text) >= _COMMON:
            return b"".join(self._pretoken(w) for w, _ in self._tokenizer.pre_tokenizer.pre_tokenize_str(text))
        out = []
        for word in self._split(text):
            ids = self._parts.get(word)
            out.append(self._learn_parts([word])[0] if ids is None else ids)
        return b"".join(out)

    def _plain(self, chunks: list[str]) -> list[bytes]:
        """Ids of plain chunks, which are cut together: ``MARK`` parts them."""
        lead = " " if self._spaced else ""
        text = "".join([f"{lead}{chunk}{MARK}" for chunk in chunks])
        words = self._split_marked(text if self._normal is None else text.lower())
        ids = list(map(self._parts.get, words))
        ends = [k for k, word in enumerate(words) if word == MARK]
        for k in ends:
            ids[k] = b""
        gaps = [k for k, own in enumerate(ids) if own is None]
        new = list({words[k] for k in gaps})
        learned = dict(zip(new, self._learn_parts(new)))
        for k in gaps:
            ids[k] = learned[words[k]]
        run = pa.array(ids, pa.large_binary())
        data, bounds = bytes(_data(run)), np.frombuffer(run.buffers()[1], "<i8")[ends].tolist()
        return [data[a:b] for a, b in zip([0, *bounds], bounds)]

    def _learn(self, chunks: list[str]) -> list[bytes]:
        lead = " " if self._spaced else ""
        found = list(map(self._old_known.get, chunks))
        new = [k for k, ids in enumerate(found) if not ids]
        plain = [k for k in new if _PLAIN(chunks[k])]
        if plain:
            for k, ids in zip(plain, self._plain([chunks[k] for k in plain])):
                found[k] = ids
        for k in new:
            if not found[k]:
                found[k] = self._chunk(lead + chunks[k])
        if len(self._known) + len(found) > self._limit:
            self._old_known, self._known = self._known, {}
        self._known.update(zip(chunks, found))
        for chunk in [chunk for chunk in chunks if len(chunk) > KEPT_CHARS]:
            del self._known[chunk]
        return found

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        rows = []
        for i, text in enumerate(texts):
            if any(s in text for s in self._special) or (self._spaced and _UNSAFE.search(text)):
                out[i] = self.whole(text)
            else:
                rows.append(i)
        if not rows:
            return out
        chunks, counts = spaced_chunks([texts[i] for i in rows])
        heads = [b""] * len(rows)
        if self._spaced:  # the first chunk has no space before it
            firsts = np.cumsum(counts) - counts
            heads = [self._chunk(chunk) for chunk in chunks.take(pa.array(firsts)).to_pylist()]
            others = np.ones(len(chunks), bool)
            others[firsts] = False
            chunks, counts = chunks.filter(pa.array(others)), counts - 1
        coded = chunks.dictionary_encode()  # a chunk is looked up once per call
        spaces = [pa.scalar(v, pa.large_string()) for v in ("", " ")]
        joined = _data(pc.binary_join_element_wise(coded.dictionary, *spaces))
        distinct = bytes(joined).decode().split(" ")[:-1]
        ids = list(map(self._known.get, distinct))
        gaps = [k for k, known in enumerate(ids) if known is None]
        for k, found in zip(gaps, self._learn([distinct[k] for k in gaps])):
            ids[k] = found
        run = pa.array(ids, pa.large_binary()).take(coded.indices)
        data = _data(run)
        ends = np.frombuffer(run.buffers()[1], "<i8")[np.concatenate([[0], np.cumsum(counts)])].tolist()
        for i, head, begin, end in zip(rows, heads, ends, ends[1:]):
            out[i] = head + data[begin:end]
        return out


_encoders: dict[tuple, ChunkEncoder] = {}


def encoder(name: str, spaced: bool) -> ChunkEncoder:
    """One encoder per Python worker and vocabulary; ``name`` is a file name or a path."""
    if (name, spaced) not in _encoders:
        path = name
        if not os.path.isabs(name):
            import public_tokenizers

            path = public_tokenizers.path(name)
        _encoders[name, spaced] = ChunkEncoder(str(path), spaced)
    return _encoders[name, spaced]
