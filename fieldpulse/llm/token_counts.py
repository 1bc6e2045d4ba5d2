"""Token counts of texts by a public tokenizer: lengths only, no ids leave Python.

An Arrow function gets a batch of texts and returns their counts. Texts are taken in
groups of about ``GROUP_BYTES``, and longer ones are cut into parts of that size first,
so a task's memory follows neither the number of rows in a batch nor the longest text.
A part is split into the pieces that the tokenizer encodes one by one anyway; pieces not
met before go to the library in batches of about ``BATCH_BYTES``, and their lengths are
kept for two generations of ``LENGTHS_KEPT``.

Cuts are only made where the vocabulary's own rules split whatever stands around:

* byte-level BPE with the usual pattern: between a letter or digit and a blank, between an
  ASCII letter or digit and an ASCII character of another kind; plain texts (ASCII and
  Latin-1 letters) are split by the pattern itself;
* sentencepiece that changes no character: at a single blank between ASCII characters,
  where no entry of the vocabulary goes on after a word's end.

Names of special tokens inside a text count as the library counts them by default, and no
cut falls into one. Vocabularies with other rules get whole texts, in batches of bytes. A
run without any such place is encoded whole, as the result depends on all of it.

Defined cases: a null or empty text has 0 bytes and 0 tokens; repeated rows are counted
each; an empty table gives an empty result; further columns stay as they are, and a
counted column that clashes with one of them has to be given another name.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType

#: Bytes of text a worker splits at a time, bytes of a call of the library.
GROUP_BYTES = 1 << 18
BATCH_BYTES = 1 << 16
#: Lengths in a generation of what a worker keeps, and the longest piece kept.
LENGTHS_KEPT = 300_000
PIECE_KEPT = 48

# The byte-level pattern over ASCII and Latin-1 letters, as the library's documentation states it.
_LETTERS = r"A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
_BLANKS = r"\t-\r "
PLAIN_PIECES = re.compile(
    rf"'(?:[stmd]|re|ve|ll)| ?[{_LETTERS}]+| ?[0-9]+| ?[^{_BLANKS}0-9{_LETTERS}]+"
    rf"|[{_BLANKS}]+(?![^{_BLANKS}])|[{_BLANKS}]+"
)
BEYOND_PLAIN = re.compile(rf"[^\x00-\x7f{_LETTERS}]")
#: Places where the pattern splits in any context.
SAFE = re.compile(
    r"(?<=\w)(?=[ \n])|(?<=[A-Za-z])(?=[0-9!-/:;=?@\[-`{}~])|(?<=[0-9])(?=[A-Za-z!-/:;=?@\[-`{}~])"
    r"|(?<=[一-龥ぁ-ゖァ-ヺ])(?=[、。！，：；？])"
)
SAFE_BLANK = re.compile(r"(?<=[!-~]) (?=[!-~])")


def parts(text: str, places: re.Pattern, size: int) -> Iterator[tuple[str, str]]:
    """``text`` cut at the last place before each ``size`` characters, or else the next one.

    Gives each part with what stood at the cut after it and belongs to neither.
    """
    start = 0
    while len(text) - start > size:
        cut = None
        # Look back from the end of the part in steps, so that near places are found without a scan of it all.
        for step in (256, 4096, size):
            low = max(start + 1, start + size - step)
            for found in places.finditer(text, low, start + size + 1):
                cut = found
            if cut:
                break
        cut = cut or places.search(text, start + size)
        if not cut or cut.start() >= len(text):
            break
        yield text[start:cut.start()], text[cut.start():cut.end()]
        start = cut.end()
    yield text[start:], ""


class _Lengths:
    """Counts of pieces, encoded in batches of bytes, kept for two generations."""

    def __init__(self, encode: Callable[[list[str]], list[int]]):
        self.encode = encode
        self.now: dict[str, int] = {}
        self.before: dict[str, int] = {}

    def total(self, pieces: list[str]) -> int:
        try:
            return sum(map(self.now.__getitem__, pieces))
        except KeyError:
            pass
        missing, brief = [], {}
        for piece in set(pieces).difference(self.now):
            if (length := self.before.get(piece)) is None:
                missing.append(piece)
            else:
                self.now[piece] = length
        for batch in batches_of_bytes(missing):
            found = dict(zip(batch, self.encode(batch)))
            self.now.update(item for item in found.items() if len(item[0]) <= PIECE_KEPT)
            brief.update(item for item in found.items() if len(item[0]) > PIECE_KEPT)
        count = sum(self.now[piece] if piece in self.now else brief[piece] for piece in pieces)
        if len(self.now) >= LENGTHS_KEPT:
            self.before, self.now = self.now, {}
        return count


def batches_of_bytes(texts: list[str], size: int = BATCH_BYTES) -> Iterator[list[str]]:
    """``texts`` in their order, in lists of about ``size`` bytes; a longer text is a list of its own."""
    batch, held = [], 0
    for text in texts:
        length = len(text) if text.isascii() else len(text.encode())
        if batch and held + length > size:
            yield batch
            batch, held = [], 0
        batch.append(text)
        held += length
    if batch:
        yield batch


class ByteLevelCounter:
    """Counts by a vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        rules = json.loads(self.tokenizer.to_str())
        added = rules["added_tokens"]
        names = [token["content"] for token in added]
        split = rules["pre_tokenizer"] or {}
        self.by_piece = (
            rules["normalizer"] is None and split.get("type") == "ByteLevel"
            and split.get("use_regex", True) and not split["add_prefix_space"]
            and not any(token[flag] for token in added for flag in ("lstrip", "rstrip", "single_word"))
            and not any(other != name and name in other for name in names for other in names)
        )
        self.special = re.compile("|".join(map(re.escape, names))) if names else None
        self.lengths = _Lengths(self._encode)

    def _encode(self, texts: list[str]) -> list[int]:
        return [len(found) for found in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def count(self, text: str) -> int:
        special, start = 0, 0
        total = 0
        for found in self.special.finditer(text) if self.special else ():
            total += self._between(text[start:found.start()])
            special, start = special + 1, found.end()
        return total + special + self._between(text[start:] if start else text)

    def _between(self, text: str) -> int:
        total = 0
        for part, _ in parts(text, SAFE, GROUP_BYTES):
            if part.isascii() or not BEYOND_PLAIN.search(part):
                total += self.lengths.total(PLAIN_PIECES.findall(part))
            elif part:
                total += self.lengths.total([piece for piece in SAFE.split(part) if piece])
        return total

    def counts(self, texts: list[str]) -> list[int]:
        if self.by_piece:
            return [self.count(text) for text in texts]
        return [n for batch in batches_of_bytes(texts) for n in self._encode(batch)]


class SentencePieceCounter:
    """Counts by a model file of the sentencepiece library."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        words_end = re.compile("[^▁]▁")
        ascii_kept = "".join(map(chr, range(33, 127)))
        self.by_part = (
            self.model.normalize(f" {ascii_kept}  a") == f"▁▁{ascii_kept}▁▁a"
            and not any(words_end.search(self.model.id_to_piece(i)) for i in range(self.model.vocab_size()))
        )

    def _encode(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.model.encode(texts, num_threads=1)]

    def counts(self, texts: list[str]) -> list[int]:
        if not self.by_part:
            return [n for batch in batches_of_bytes(texts) for n in self._encode(batch)]
        # The blank at a cut comes back as the blank the model puts before every text.
        owners, cut = [], []
        for owner, text in enumerate(texts):
            for part, _ in parts(text, SAFE_BLANK, BATCH_BYTES):
                owners.append(owner)
                cut.append(part)
        totals = [0] * len(texts)
        found = (n for batch in batches_of_bytes(cut) for n in self._encode(batch))
        for owner, n in zip(owners, found):
            totals[owner] += n
        return totals


@lru_cache(maxsize=2)
def counter(path: str) -> ByteLevelCounter | SentencePieceCounter:
    """One counter per Python worker and vocabulary."""
    return SentencePieceCounter(path) if path.endswith(".model") else ByteLevelCounter(path)


def token_count(text: Column, vocabulary: str) -> Column:
    """Number of tokens of ``text`` by the vocabulary file, no special tokens added."""

    @F.arrow_udf(LongType())
    def count(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        by = counter(vocabulary)
        for column in columns:
            counted = []
            for start in range(0, len(column), 256):
                counted += by.counts(column.slice(start, 256).to_pylist())
            yield pa.array(counted, pa.int64())

    return count(F.coalesce(text, F.lit("")))


def count_tokens(
    docs: DataFrame, vocabulary: str, limit: int, text: str = "text",
    n_bytes: str = "n_bytes", n_tokens: str = "n_tokens", over_limit: str = "over_limit",
) -> DataFrame:
    """``docs`` with the bytes and tokens of each whole text, and whether these are more than ``limit``."""
    taken = {name.lower() for name in docs.columns} & {n_bytes.lower(), n_tokens.lower(), over_limit.lower()}
    if taken:
        raise ValueError(f"columns exist already: {sorted(taken)}")
    counted = docs.withColumns({
        n_bytes: F.coalesce(F.octet_length(text), F.lit(0)).cast("long"),
        n_tokens: token_count(F.col(text), vocabulary),
    })
    return counted.withColumn(over_limit, F.col(n_tokens) > limit)
