"""Whole-text encoding with a public tokenizer, by cached runs of characters.

A vocabulary that lower-cases, drops white space and splits letters from digits
and punctuation encodes every white-space word on its own, and a word of plain
Latin letters and ASCII signs as the letter and sign runs it is made of.  Runs
are found over a whole slice of texts at once, and each distinct run is merged
once and remembered.  Words with anything else (other scripts, apostrophes,
special-token strings) are encoded whole; for any other kind of vocabulary whole
texts go through ``encode``.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from shelflife.llm.common import worker_cache

# Byte classes. 0 white space, 1 letters, 2 signs, 3 anything that
# keeps its word whole (control and non-ASCII bytes, and the apostrophe).
CLASS = np.full(256, 3, np.uint8)
CLASS[list(b" \t\n\x0b\x0c\r")] = 0
CLASS[[*range(65, 91), *range(97, 123)]] = 1
CLASS[[c for c in range(33, 127) if not chr(c).isalnum() and c != 39] + [*range(48, 58)]] = 2
# Second bytes of the letters U+00C0-U+00FF (without the two signs among them).
LATIN = np.zeros(256, bool)
LATIN[[c for c in range(0x80, 0xC0) if c not in (0x97, 0xB7)]] = True
# The normaliser and the splitting pattern for which words are independent.
WORDWISE_STEPS = ["NFC", "Replace", "Lowercase"]
WORDWISE_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class Encoder:
    """Token ids of whole texts, ``add_special_tokens=False``.

    ``cache_runs`` bounds the remembered runs; a full cache admits no more.
    """

    def __init__(self, path: str, cache_runs: int = 250_000):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.max_runs = cache_runs
        self.runs: dict[bytes, bytes] = {}
        spec = json.load(open(path, encoding="utf-8"))
        steps = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        splits = [p.get("pattern", {}).get("Regex")
                  for p in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
        marks = [t["content"] for t in spec["added_tokens"]]
        self.runwise = (steps == WORDWISE_STEPS and WORDWISE_SPLIT in splits
                        and not any(re.search(r"\s", m) for m in marks))
        self.code = "H" if self.tok.get_vocab_size() <= 1 << 16 else "I"
        self.dtype = np.dtype("<u2" if self.code == "H" else "<u4")
        self.marks = re.compile(b"|".join(re.escape(m.encode()) for m in marks) or rb"(?!)")
        self.letters = re.compile(rb"(?:[a-z]|\xc3[\xa0-\xb6\xb8-\xbf\x9f])+")

    def _pack(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def _whole(self, text: str) -> bytes:
        return self._pack(self.tok.encode(text, add_special_tokens=False).ids)

    def _run(self, run: bytes) -> bytes:
        """Ids of one run: letters are one merge; everything else goes through the pipeline."""
        if not run.isalpha() and not self.letters.fullmatch(run):
            return self._whole(run.decode())
        return self._pack([t.id for t in
                           self.tok.model.tokenize(run.decode("latin-1").translate(BYTE_CHARS))])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a slice of binary texts, and where each text's ids begin (and the last end)."""
        if not self.runwise:
            each = [np.frombuffer(self._whole(t.decode()), self.dtype) for t in texts.to_pylist()]
            return (np.concatenate([np.empty(0, self.dtype), *each]),
                    np.cumsum([0, *map(len, each)]))
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        # a space after each text, so that no run crosses texts
        raw = np.frombuffer(b" ".join([*texts.to_pylist(), b""]), np.uint8)
        text_at = np.cumsum(sizes + 1) - sizes - 1
        low, run_at = self._split(raw)
        coded = pa.Array.from_buffers(
            pa.binary(), len(run_at),
            [None, pa.py_buffer(np.append(run_at, len(raw)).astype(np.int32)), pa.py_buffer(low)]
        ).dictionary_encode()
        cache, known = self.runs, _values(coded.dictionary)
        each = list(map(cache.get, known))
        for i, ids in enumerate(each):
            if ids is None:
                each[i] = ids = b"" if known[i].isspace() else self._run(known[i])
                if len(cache) < self.max_runs:
                    cache[known[i]] = ids
        flat = np.frombuffer(b"".join(each), self.dtype)
        n_ids = np.fromiter(map(len, each), np.int32, len(each)) // self.dtype.itemsize
        begin = np.cumsum(n_ids, dtype=np.int32) - n_ids
        run = np.asarray(coded.indices)
        n = n_ids[run]
        ends = np.zeros(len(run) + 1, np.int32)
        np.cumsum(n, out=ends[1:])
        at = np.arange(ends[-1], dtype=np.int32) + np.repeat(begin[run] - ends[:-1], n)
        first = np.searchsorted(run_at, np.append(text_at, len(raw)))
        return flat[at], ends[first]

    def _split(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes with plain words lower-cased, and where runs begin (white space runs too)."""
        kind = CLASS[raw]
        lead = np.flatnonzero(raw[:-1] == 0xC3)
        lead = lead[LATIN[raw[lead + 1]]]
        kind[lead] = kind[lead + 1] = 1
        for m in self.marks.finditer(raw.data):
            kind[m.start():m.end()] = 3
        low = raw.copy()
        low[(raw >= 65) & (raw <= 90)] += 32
        upper = lead[raw[lead + 1] <= 0x9E] + 1
        low[upper] += 32
        new = np.ones(len(raw), bool)
        np.not_equal(kind[1:], kind[:-1], out=new[1:])
        new[1:] |= raw[:-1] == 32  # each text begins a run, whatever stands before it
        odd = np.flatnonzero(kind == 3)
        if len(odd):
            space = np.flatnonzero(kind == 0)
            k = np.unique(np.searchsorted(space, odd))
            for i in k:  # words that stay whole, in their own letters
                a = space[i - 1] + 1 if i else 0
                new[a + 1:space[i]] = False
                low[a:space[i]] = raw[a:space[i]]
        return low, np.flatnonzero(new)


def _values(strings: pa.Array) -> list[bytes]:
    """The values of a binary array, cut from one buffer."""
    data = strings.buffers()[2].to_pybytes() if len(strings) else b""
    at = np.frombuffer(strings.buffers()[1], np.int32)[:len(strings) + 1].tolist()
    return [data[a:b] for a, b in zip(at, at[1:])]


def _byte_chars() -> dict[int, str]:
    """Byte to character map of byte-level vocabularies: printable bytes stay themselves,
    the others take the code points from 256 on, in byte order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


BYTE_CHARS = _byte_chars()


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file, loaded once per process."""
    cache = worker_cache()
    key = ("encoder", path)
    if key not in cache:
        cache[key] = Encoder(path)
    return cache[key]
