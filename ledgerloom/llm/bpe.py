"""BPE encoding by a priority queue of merge ranks, and decoding by concatenating vocabulary strings.

The vocabulary is a public tokenizer file in the JSON layout of the ``tokenizers`` library: a BPE model with a
word-end suffix over byte characters, text normalised by NFC, white-space folding and lower case, and words cut by
one pattern. The path is a parameter; every executor reads the file from its own installation.

Encoding is a map over rows without a shuffle, so a hot source or a group of copies costs nothing special. Words
repeat, so each task remembers the ids of the words it met last, within a bound in bytes (:data:`REMEMBERED_BYTES`),
and forgets them when it ends; its memory does not grow with its rows.

Defined results: a null or empty text has no tokens, and its decoded text is empty; repeated rows give repeated
rows; an empty table gives an empty table of the same schema; other columns of the input are not looked at unless
named in ``keep``, and a kept column that has the name of a result column gives way to the result.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from array import array
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import Tokenizer

from ledgerloom.llm.memory import released

# Bytes of a table of remembered words, twice that with its older generation; bytes of an entry besides its strings.
REMEMBERED_BYTES = 44 << 20
ENTRY_BYTES = 220
# Characters of a piece that is not remembered.
LONG = 200

# The word pattern of the tokenizer file, with its white-space class spelled out.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"
# Separators that Python's split() takes for white space and the tokenizer does not.
SEPARATORS = re.compile("[\x1c-\x1f]")
# Characters beyond Latin letters, common punctuation and symbols; and the separators.
UNSURE = re.compile("[^\x00-\x1b\x20-\u024f\u2010-\u2027\u2030-\u205e\u20a0-\u20bf]")


def byte_characters() -> list[str]:
    """The visible character that stands for each byte: itself if printable, else the next one from 256 on."""
    printable = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class Remembered(dict):
    """Results of ``work`` by argument, as many of those met last as take ``most`` to twice ``most`` bytes.

    When the table is full it becomes the older one and a new one begins; what is met again moves over. A long
    argument is worked out anew each time.
    """

    def __init__(self, work: Callable[[str], bytes], most: int = REMEMBERED_BYTES):
        super().__init__()
        self.work, self.most, self.held, self.older = work, most, 0, {}

    def __missing__(self, key: str) -> bytes:
        found = self.older.get(key)
        if found is None:
            found = self.work(key)
            if len(key) > LONG:
                return found
        # A character takes four bytes at most.
        self.held += ENTRY_BYTES + (len(key) if key.isascii() else 4 * len(key)) + len(found)
        if self.held > self.most:
            self.older = dict(self)
            self.forget_newest()
        self[key] = found
        return found

    def forget_newest(self) -> None:
        self.clear()
        self.held = 0

    def forget(self) -> None:
        self.forget_newest()
        self.older = {}


class Vocabulary:
    """Ids, merge ranks and special strings of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in (self.ids | self.special).items()}
        self.shift = max(self.strings).bit_length()
        # Two neighbouring ids, packed into one number -> rank; rank -> id of the merged symbol.
        self.ranks: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, (left, right) in enumerate(model["merges"]):
            self.ranks[self.ids[left] << self.shift | self.ids[right]] = rank
            self.merged.append(self.ids[left + right])
        # Id of each byte within a word and at its end.
        self.inner = [self.ids[c] for c in byte_characters()]
        self.final = [self.ids[c + self.suffix] for c in byte_characters()]
        self.words = regex.compile(WORDS)
        specials = sorted(self.special, key=len, reverse=True)
        self.specials = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        self.library = Tokenizer.from_file(path)
        self.by_characters = Remembered(self.symbols_ids)
        self.by_piece = Remembered(self.piece_ids)

    def forget(self) -> None:
        self.by_characters.forget()
        self.by_piece.forget()

    def merge(self, symbols: list[int]) -> list[int]:
        """Apply the lowest-ranked merge, leftmost first, until none applies.

        The symbols form a doubly linked list (``before``/``after``); the queue holds rank and place of candidate
        pairs as they arise. ``current`` is the rank of the pair that begins at a place now, -1 for none: an entry with
        another rank is stale and skipped when it is taken.
        """
        n, shift, rank_of, push, pop = len(symbols), self.shift, self.ranks.get, heapq.heappush, heapq.heappop
        merged, at = self.merged, symbols
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        place_bits = n.bit_length()
        place = (1 << place_bits) - 1
        current = [rank_of(a << shift | b, -1) for a, b in zip(at, at[1:], strict=False)]
        current.append(-1)
        queue = [rank << place_bits | i for i, rank in enumerate(current) if rank >= 0]
        heapq.heapify(queue)
        while queue:
            entry = pop(queue)
            i, rank = entry & place, entry >> place_bits
            if current[i] != rank:
                continue
            j = after[i]
            symbol = at[i] = merged[rank]
            at[j] = current[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                rank = current[i] = rank_of(symbol << shift | at[k], -1)
                if rank >= 0:
                    push(queue, rank << place_bits | i)
            else:
                current[i] = -1
            h = before[i]
            if h >= 0:
                rank = current[h] = rank_of(at[h] << shift | symbol, -1)
                if rank >= 0:
                    push(queue, rank << place_bits | h)
        return [s for s in at if s >= 0]

    def symbols_ids(self, characters: str) -> bytes:
        """Ids of one word, given as byte characters, as little-endian unsigned 32-bit integers."""
        symbols = [*characters[:-1], characters[-1] + self.suffix]
        return array("I", self.merge([self.ids[s] for s in symbols])).tobytes()

    def piece_ids(self, piece: str) -> bytes:
        """Ids of a normalised piece of text between white space: one word, or a few, each remembered as a piece."""
        words = self.words.findall(piece)
        if len(words) > 1:
            return b"".join(map(self.by_piece.__getitem__, words))
        if not words:
            return b""
        raw = words[0].encode()
        symbols = [*map(self.inner.__getitem__, raw[:-1]), self.final[raw[-1]]]
        return array("I", self.merge(symbols)).tobytes()

    def _plain(self, text: str) -> Iterable[bytes]:
        if text.isascii() and not SEPARATORS.search(text):
            return map(self.by_piece.__getitem__, text.lower().split())
        if not UNSURE.search(text):
            return map(self.by_piece.__getitem__, unicodedata.normalize("NFC", text).lower().split())
        # Scripts whose tables differ between Unicode versions: the library normalises and cuts into words.
        cut = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return map(self.by_characters.__getitem__, (word for word, _ in cut))

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, packed as :meth:`symbols_ids` packs them."""
        if self.specials is None or not any(s in text for s in self.special):
            return b"".join(self._plain(text))
        parts, start = [], 0
        for found in self.specials.finditer(text):
            parts += [*self._plain(text[start : found.start()]), array("I", [self.special[found[0]]]).tobytes()]
            start = found.end()
        return b"".join([*parts, *self._plain(text[start:])])

    def decode(self, packed: bytes) -> str:
        """Vocabulary strings one after the other; as the file names no decoder, one space stands between them."""
        return " ".join(map(self.strings.__getitem__, memoryview(packed).cast("I")))


_loaded: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary at ``path``, read once per Python worker."""
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


def encode_texts(
    docs: DataFrame, path: str, text: str = "text", keep: Sequence[str] = (), ids: str = "ids", decoded: str | None = None
) -> DataFrame:
    """Add ``ids`` (packed 32-bit integers), ``n_tokens`` and, if named, the ``decoded`` text to the ``keep`` columns."""
    results = [ids, "n_tokens", *([decoded] if decoded else [])]
    kept = [c for c in dict.fromkeys(keep) if c not in results]
    fields = [T.StructField(c, docs.schema[c].dataType) for c in kept]
    fields += [T.StructField(ids, T.BinaryType()), T.StructField("n_tokens", T.LongType())]
    fields += [T.StructField(decoded, T.StringType())] if decoded else []
    at = docs[text].alias("_bpe_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            packed = [words.encode(t.as_py() or "") for t in batch.column(len(kept))]
            columns = [batch.column(i) for i in range(len(kept))]
            columns += [pa.array(packed, pa.binary()), pa.array([len(p) // 4 for p in packed], pa.int64())]
            if decoded:
                columns.append(pa.array(map(words.decode, packed), pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *results])

    forgetful = released(run, lambda: vocabulary(path).forget())
    return docs.select(*kept, at).mapInArrow(forgetful, T.StructType(fields))
