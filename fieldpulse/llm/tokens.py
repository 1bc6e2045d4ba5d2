"""Token ids of texts by a public tokenizer, as bytes of little-endian 32-bit ids."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Entries in a generation of what a Python worker keeps; about 150 bytes each.
RUNS_KEPT = 220_000
WORDS_KEPT = 30_000
#: Characters of text that are split at a time, so that a run is looked up once for all its places in them.
GROUP_CHARS = 1 << 21

# The vocabulary's own rules for normalizing and splitting, as its file states them.
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: ASCII and Latin-1 letters stay as they are but for case; names of special tokens are found before a text is split.
BEYOND_PLAIN = re.compile(r"<\||[^\x00-\x7f\xc0-\xd6\xd8-\xf6\xf8-\xff]")
_LATIN = [chr(c) for c in range(256)]
PLAIN = "".join(c for c in _LATIN if not BEYOND_PLAIN.match(c)).encode("latin-1")
LOWERED = bytes(ord(c.lower()) for c in _LATIN)
#: What the split tells apart, by Latin-1 byte; digits stand alone, other kinds in runs.
BLANK, LETTER, DIGIT, MARK = range(4)
KIND = np.array(
    [BLANK if c in "\t\n\v\f\r " else DIGIT if c in "0123456789" else LETTER if c.isalpha() else MARK for c in _LATIN],
    np.uint8,
)


class _Kept(dict):
    """Results of ``find``, kept for the present and the previous generation of ``size``."""

    def __init__(self, find: Callable[[str | bytes], bytes], size: int):
        self.find, self.size, self.before = find, size, {}

    def __missing__(self, key: str | bytes) -> bytes:
        ids = self.before.get(key)
        if ids is None:
            ids = self.find(key)
        if len(self) >= self.size:
            self.before = dict(self)
            self.clear()
        self[key] = ids
        return ids


def plain_runs(text: bytes) -> tuple[np.ndarray, pa.Array]:
    """Where the runs of a lower-cased plain text in Latin-1 begin, and the runs, by the vocabulary's split."""
    padded = np.frombuffer(text + b"   ", np.uint8)
    kind = KIND[padded]
    begins = kind != BLANK
    begins[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    # A mark that is nothing but an apostrophe takes the letters of a contraction.
    marks = np.flatnonzero(padded == ord("'"))
    marks = marks[begins[marks] & (kind[marks + 1] == LETTER)]
    first, second = padded[marks + 1], padded[marks + 2]
    taken = np.isin(first, np.frombuffer(b"stmd", np.uint8)).astype(np.int64)
    for pair in (b"re", b"ve", b"ll"):
        taken[(first == pair[0]) & (second == pair[1])] = 2
    marks, taken = marks[taken > 0], taken[taken > 0]
    begins[marks + 1] = False
    after = marks + 1 + taken
    begins[after] |= kind[after] == LETTER
    shown = kind != BLANK
    letters, places = padded[shown], np.flatnonzero(begins)
    offsets = np.append(np.flatnonzero(begins[shown]), len(letters))
    runs = pa.Array.from_buffers(
        pa.large_binary(), len(places), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(letters)]
    )
    return places, runs


class Encoder:
    """Encodes by the tokenizers library, which sees a run of letters again only when it has become rare.

    Where the vocabulary splits at white space and between letters, digits and marks, the
    ids of a text are those of its runs in a row. They are kept for two generations, so
    memory is bounded and frequent ones stay. Texts are taken in groups: a group is split
    as one array of bytes, and its different runs are looked up once each. In texts with
    characters beyond ASCII and Latin-1 letters, words that hold such go to the library
    whole, as do all texts where the vocabulary has other rules.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        rules = json.loads(self.tokenizer.to_str())
        normalizers = [n["type"] for n in (rules["normalizer"] or {}).get("normalizers", [])]
        splits = [p.get("pattern", {}).get("Regex") for p in (rules["pre_tokenizer"] or {}).get("pretokenizers", [])]
        self.by_run = normalizers == NORMALIZERS and splits == [SPLIT, None]
        # The model's characters for the bytes of a character, as the library's byte-level step gives them.
        in_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.in_bytes = str.maketrans({c: in_bytes.pre_tokenize_str(c)[0][0] for c in PLAIN.decode("latin-1")})
        self.tokenize = self.tokenizer.model.tokenize
        self.id_bytes = [i.to_bytes(4, "little") for i in range(1 + max(self.tokenizer.get_vocab().values()))]
        self.runs = _Kept(self._run, RUNS_KEPT)
        self.words = _Kept(self._whole, WORDS_KEPT)

    def encode(self, text: str | None) -> bytes:
        """Ids of ``text`` (null: empty) without special tokens added."""
        return next(self.encode_all([text]))

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The ids of each text, in their order; texts are read by the group."""
        group, held = [], 0
        for text in texts:
            group.append(text or "")
            held += len(group[-1])
            if held >= GROUP_CHARS:
                yield from self._group(group)
                group, held = [], 0
        yield from self._group(group)

    def _group(self, texts: list[str]) -> Iterator[bytes]:
        if not self.by_run:
            yield from map(self._whole, texts)
            return
        plain: list[bytes] = []
        parts = [self._parts(text, plain) for text in texts]
        ids = self._plain(plain)
        for of_text in parts:
            yield b"".join([ids[part] if isinstance(part, int) else part for part in of_text])

    def _parts(self, text: str, plain: list[bytes]) -> list[int | bytes]:
        """``text`` as places of its plain parts, which are added to ``plain``, and ids of the words between."""
        raw = self._latin(text)
        if raw is not None:
            plain.append(raw)
            return [len(plain) - 1]
        text = text.replace("\n", " ")
        parts, done = [], 0
        while found := BEYOND_PLAIN.search(text, done):
            begin = text.rfind(" ", done, found.start()) + 1  # ``done`` is 0 or the place of a blank
            end = text.find(" ", found.start())
            end = len(text) if end < 0 else end
            if begin > done:
                parts.append(len(plain))
                plain.append(text[done:begin].encode("latin-1"))
            parts.append(self.words[text[begin:end]])
            done = end
        if done < len(text):
            parts.append(len(plain))
            plain.append(text[done:].encode("latin-1"))
        return parts

    @staticmethod
    def _latin(text: str) -> bytes | None:
        """A plain text in Latin-1, None for others."""
        if "<|" in text:
            return None
        try:
            raw = text.encode("latin-1")
        except UnicodeEncodeError:
            return None
        return None if raw.translate(None, PLAIN) else raw

    def _plain(self, texts: list[bytes]) -> list[bytes]:
        """Ids of plain texts in Latin-1."""
        places, runs = plain_runs(b" ".join(texts).translate(LOWERED))
        coded = runs.dictionary_encode()
        found = list(map(self.runs.__getitem__, coded.dictionary.to_pylist()))
        which = coded.indices.to_numpy()
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts, counts = np.cumsum(lengths) - lengths, lengths[which]
        ends = np.cumsum(counts)
        ids = np.frombuffer(b"".join(found), "<u4")
        total = int(ends[-1]) if len(ends) else 0
        taken = np.repeat(starts[which] - (ends - counts), counts)
        taken += np.arange(total)
        raw = ids[taken].tobytes()
        # A text's ids end before the first run that begins behind it.
        text_ends = np.cumsum([len(text) + 1 for text in texts])
        cuts = np.append(0, ends)[np.searchsorted(places, text_ends)] * 4
        return [raw[begin:end] for begin, end in zip([0, *cuts[:-1].tolist()], cuts.tolist())]

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _run(self, run: bytes) -> bytes:
        text = run.decode("latin-1")
        if not run.isalnum():  # ASCII letters and digits stand for themselves
            text = text.translate(self.in_bytes)
        return b"".join([self.id_bytes[t.id] for t in self.tokenize(text)])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker and vocabulary."""
    return Encoder(path)
