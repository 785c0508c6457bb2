"""Language identification by a linear-chain conditional random field over the words of a text.

Every word gets a score per language from its affixes, its character n-grams and a lexicon; learned transitions tie
neighbours together. Forward-backward labels each word with the probability of every language, so texts that switch
language are followed word by word. The language of a text is the one with the most expected words, and its score
is that share.

Training uses a bounded sample: per language ``texts_per_language`` labelled documents (those with the smallest hash
of their id), ``windows`` stretches of ``window_words`` words of each, taken at hashed places of the whole text.
Some stretches are joined across languages so that switches are learned. The sample is the only thing that
reaches the driver, and the model, whose size depends on the number of languages alone, the only thing sent out.

Labelling is a map over rows without a shuffle. A text is labelled in stretches of at most ``STRETCH`` words, all of
it; many stretches are worked on side by side.

Defined results: a null text or one without a letter is ``und`` with score 0; words without a letter are passed
over; repeated rows are labelled alike; if nothing can be learned from, every text is ``und``; an empty table gives
an empty table; columns of the input that are not named are not looked at, and a kept column with the name of a
result column gives way to it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.memory import released

UNKNOWN = "und"
TEXTS_PER_LANGUAGE, WINDOWS, WINDOW_WORDS = 300, 4, 40
# Characters of a sampled word; in text without spaces a word may be a whole text.
WORD_CHARACTERS = 200
# Hashed n-gram and affix weights per language; words of the lexicon.
BUCKETS, LEXICON_WORDS, LEXICON_LEAST = 1 << 17, 20_000, 3
ROUNDS, RATE, DECAY = 40, 0.3, 1e-4
STRETCH, CHARACTERS_AT_ONCE = 1024, 1 << 20

NO_LETTERS = regex.compile(r"\P{L}+")


class Model(NamedTuple):
    languages: list[str]
    lexicon: dict[str, int]
    hashed: np.ndarray
    listed: np.ndarray
    transitions: np.ndarray


# Features


def mixed(codes: np.ndarray, salt: int) -> np.ndarray:
    """Bucket of a 64-bit code."""
    h = (codes + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(64 - (BUCKETS.bit_length() - 1))).astype(np.int64)


def features(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers and buckets of all n-grams (1 to 3, ends marked) and affixes (2 to 4) of letter-only words."""
    text = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le"), np.uint32).astype(np.uint64)
    ends = text == 32
    word = np.cumsum(ends) - 1
    first, second = np.flatnonzero(ends)[:-1] + 1, np.flatnonzero(ends)[1:]
    lengths = second - first
    letter = ~ends
    owners, buckets = [], []

    def add(owner: np.ndarray, codes: np.ndarray, salt: int) -> None:
        owners.append(owner)
        buckets.append(mixed(codes, salt))

    gram = text
    add(word[letter], gram[letter], 1)
    pair = gram[:-1] << np.uint64(21) | gram[1:]
    for n, codes in ((2, pair), (3, pair[:-1] * np.uint64(0x100000001B3) + gram[2:])):
        # A pair or triple with a letter in its second place lies in that letter's word, marks included.
        at = np.flatnonzero(letter[1 : len(codes) + 1])
        add(word[at + 1], codes[at], n)
    for k in (2, 3, 4):
        own = np.flatnonzero(lengths >= k)
        for salt, start in ((10 + k, first[own]), (20 + k, second[own] - k)):
            codes = np.zeros(len(own), np.uint64)
            for i in range(k):
                codes = codes * np.uint64(0x100000001B3) + text[start + i]
            add(own, codes, salt)
    return np.concatenate(owners), np.concatenate(buckets)


def word_scores(model: Model, words: Sequence[str]) -> np.ndarray:
    """Scores per word and language."""
    if not words:
        return np.zeros((0, len(model.languages)))
    owner, bucket = features(words)
    listed = np.fromiter((model.lexicon.get(w, -1) for w in words), np.int64, len(words))
    scores = [np.bincount(owner, model.hashed[bucket, k], len(words)) for k in range(len(model.languages))]
    return np.stack(scores, 1) + np.where(listed[:, None] >= 0, model.listed[listed], 0.0)


# The chain


class Packed(NamedTuple):
    """Where the words of sequences stand when they are put in order of place, longest sequence first."""

    position: np.ndarray
    running: np.ndarray
    offsets: np.ndarray


def pack(lengths: np.ndarray) -> Packed:
    """For non-empty sequences. ``running``: sequences that have a word at each place."""
    rank = np.empty(len(lengths), np.int64)
    rank[np.argsort(-lengths, kind="stable")] = np.arange(len(lengths))
    running = len(lengths) - np.cumsum(np.bincount(lengths))[:-1]
    offsets = np.r_[0, np.cumsum(running)]
    place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return Packed(offsets[place] + np.repeat(rank, lengths), running, offsets)


def forward_backward(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray, pairs: bool = False):
    """Probabilities of the labels of every word, and, if asked for, the expected number of each transition."""
    order = pack(lengths)
    local = np.empty_like(scores)
    local[order.position] = np.exp(scores - scores.max(1, keepdims=True))
    move = np.exp(transitions - transitions.max())
    running, at = order.running, order.offsets
    forward = np.empty_like(local)
    a = local[: running[0]]
    forward[: running[0]] = a = a / a.sum(1, keepdims=True)
    for t in range(1, len(running)):
        n = running[t]
        a = (a[:n] @ move) * local[at[t] : at[t] + n]
        a /= a.sum(1, keepdims=True)
        forward[at[t] : at[t] + n] = a
    expected = np.zeros_like(move)
    b = np.ones((running[-1], len(move)))
    for t in range(len(running) - 1, 0, -1):
        n, m = running[t], running[t - 1]
        after = local[at[t] : at[t] + n] * b
        before = forward[at[t - 1] : at[t - 1] + n]
        back = after @ move.T
        if pairs:
            total = (before * back).sum(1, keepdims=True)
            expected += (before / total).T @ after * move
        forward[at[t] : at[t] + n] *= b
        b = np.ones((m, len(move)))
        b[:n] = back / back.sum(1, keepdims=True)
    forward[: running[0]] *= b
    forward /= forward.sum(1, keepdims=True)
    return forward[order.position], expected


# Training


def training_sample(
    labelled: DataFrame, key: str, text: str, language: str, texts_per_language: int, windows: int, window_words: int
) -> list[tuple[str, list[str]]]:
    """At most ``texts_per_language * windows`` stretches of words per language, in a fixed order.

    A word has at most ``WORD_CHARACTERS`` characters, from a hashed place if it is longer, so the sample is bounded in
    characters too.
    """
    usable = labelled.where(F.col(text).isNotNull() & F.col(language).isNotNull())
    ids = usable.select(F.col(key).alias("_id"), F.col(language).alias("_lang"), F.xxhash64(key).alias("_hash"))
    # Hashes are spread evenly, so the smallest of a language lie below a few times their share of the range.
    counts = F.broadcast(ids.groupBy("_lang").agg(F.count(F.lit(1)).alias("_rows")))
    share = F.lit(float(4 * texts_per_language)) / F.col("_rows")
    small = ids.join(counts, "_lang").where((F.col("_hash") / F.lit(2.0**64) + 0.5 <= share) | (F.col("_rows") <= 8 * texts_per_language))
    order = Window.partitionBy("_lang").orderBy("_hash", "_id")
    chosen = small.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= texts_per_language)
    # At most the sample's bound of ids: the texts are not shuffled to find them.
    wanted = F.broadcast(chosen.select("_id", "_lang").distinct())
    texts = usable.join(wanted, (F.col(key) == F.col("_id")) & (F.col(language) == F.col("_lang")))
    words = F.split(F.lower(F.trim(F.col(text))), r"\s+")

    def stretch(j: Column) -> Column:
        last = F.greatest(F.lit(0), F.size("words") - window_words)
        chosen = F.slice("words", (F.pmod(F.xxhash64("_id", j), last + 1) + 1).cast("int"), F.lit(window_words))
        return F.transform(chosen, lambda w: F.when(F.length(w) > WORD_CHARACTERS, part_of(w, j)).otherwise(w))

    def part_of(word: Column, j: Column) -> Column:
        start = F.pmod(F.xxhash64("_id", j), F.length(word) - WORD_CHARACTERS + 1) + 1
        return F.substr(word, start.cast("int"), F.lit(WORD_CHARACTERS))

    cut = texts.select("_id", "_lang", words.alias("words")).select(
        "_id", "_lang", F.explode(F.transform(F.sequence(F.lit(1), F.lit(windows)), stretch)).alias("words")
    )
    # Equal ids could make the sample larger than its bound.
    bound = Window.partitionBy("_lang").orderBy(F.xxhash64("_id"), "_id", "words")
    rows = cut.withColumn("_n", F.row_number().over(bound)).where(F.col("_n") <= texts_per_language * windows)
    found = [(r["_lang"], [w for w in (NO_LETTERS.sub("", w) for w in r["words"]) if w]) for r in rows.collect()]
    return sorted(x for x in found if x[1])


def train(sample: Sequence[tuple[str, list[str]]]) -> Model:
    """Maximum likelihood by full gradients with steps scaled per weight; the same sample gives the same model."""
    languages = sorted({lang for lang, _ in sample})
    if not languages:
        return Model([], {}, np.zeros((BUCKETS, 0)), np.zeros((0, 0)), np.zeros((0, 0)))
    number = {lang: k for k, lang in enumerate(languages)}
    drawn = np.random.default_rng(7).permutation(len(sample))
    sequences = [(words, [number[lang]] * len(words)) for lang, words in sample]
    # Every other stretch also appears with a part of another one after it.
    for i, j in zip(drawn[::2], drawn[1::2], strict=False):
        (a, x), (b, y) = sequences[i], sequences[j]
        sequences.append((a[: len(a) // 2 + 1] + b[len(b) // 2 :], x[: len(a) // 2 + 1] + y[len(b) // 2 :]))
    words = [w for s, _ in sequences for w in s]
    gold = np.array([k for _, labels in sequences for k in labels])
    lengths = np.array([len(s) for s, _ in sequences])
    ends = np.cumsum(lengths)
    inner = np.ones(len(words), bool)
    inner[ends - lengths] = False
    counts = Counter(w for _, s in sample for w in s)
    listed = sorted((w for w, n in counts.items() if n >= LEXICON_LEAST), key=lambda w: (-counts[w], w))[:LEXICON_WORDS]
    lexicon = {w: i for i, w in enumerate(listed)}

    unique = sorted(set(words))
    place = {w: i for i, w in enumerate(unique)}
    at = np.array([place[w] for w in words])
    owner, bucket = features(unique)
    entry = np.array([lexicon.get(w, -1) for w in unique])
    known = entry >= 0
    size = len(languages)
    weights = [np.zeros((BUCKETS, size)), np.zeros((max(1, len(listed)), size)), np.zeros((size, size))]
    steps = [np.full(w.shape, 1e-6) for w in weights]
    truth = np.eye(size)[gold]
    moves = np.zeros((size, size))
    np.add.at(moves, (gold[:-1][inner[1:]], gold[1:][inner[1:]]), 1)
    scale = 1 / len(words)
    for _ in range(ROUNDS):
        hashed, lists, transitions = weights
        scores = np.stack([np.bincount(owner, hashed[bucket, k], len(unique)) for k in range(size)], 1)
        scores[known] += lists[entry[known]]
        found, expected = forward_backward(scores[at], lengths, transitions, pairs=True)
        error = np.stack([np.bincount(at, (truth - found)[:, k], len(unique)) for k in range(size)], 1)
        gradients = [
            np.stack([np.bincount(bucket, error[owner, k], BUCKETS) for k in range(size)], 1),
            np.stack([np.bincount(entry[known], error[known, k], len(lists)) for k in range(size)], 1),
            moves - expected,
        ]
        for w, step, gradient in zip(weights, steps, gradients, strict=True):
            gradient = gradient * scale - DECAY * scale * w
            step += gradient**2
            w += RATE * gradient / np.sqrt(step)
    return Model(languages, lexicon, weights[0].astype(np.float32), weights[1], weights[2])


# Labelling


class Numbers(dict):
    """Numbers strings in the order in which they are first asked for."""

    def __missing__(self, key: str) -> int:
        self[key] = found = len(self)
        return found


def label_texts(model: Model, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Expected words per text and language, and words per text."""
    size = len(model.languages)
    if not size:
        return np.zeros((len(texts), 0)), np.zeros(len(texts), np.int64)
    pieces = Numbers()
    tokens = [np.fromiter(map(pieces.__getitem__, t.lower().split()), np.int64) for t in texts]
    # Pieces between white space without what is not a letter.
    words = [NO_LETTERS.sub("", p) for p in pieces]
    some = np.array([bool(w) for w in words], bool)
    scores = np.zeros((len(words), size))
    scores[some] = word_scores(model, [w for w in words if w])
    tokens = [t[some[t]] if len(t) else t for t in tokens]
    counts = np.array([len(t) for t in tokens], np.int64)
    if not counts.sum():
        return np.zeros((len(texts), size)), counts
    lengths = np.concatenate([np.r_[np.full(n // STRETCH, STRETCH), [n % STRETCH] * bool(n % STRETCH)] for n in counts])
    found, _ = forward_backward(scores[np.concatenate(tokens)], lengths.astype(np.int64), model.transitions)
    of = np.repeat(np.arange(len(texts)), counts)
    return np.stack([np.bincount(of, found[:, k], len(texts)) for k in range(size)], 1), counts


def slices(texts: Sequence[str]) -> Iterator[Sequence[str]]:
    """Texts in order, so many characters at once, one text at least."""
    begin = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > CHARACTERS_AT_ONCE:
            yield texts[begin:i]
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield texts[begin:]


def identify_languages(docs: DataFrame, model: Model, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """The ``keep`` columns, ``lang_pred`` and ``score`` of every text."""
    results = ("lang_pred", "score")
    kept = [c for c in dict.fromkeys(keep) if c not in results]
    fields = [T.StructField(c, docs.schema[c].dataType) for c in kept]
    fields += [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    # A few megabytes for each dozen languages, whatever the table.
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*sent.value.languages, UNKNOWN]
        for batch in batches:
            best, share = [], []
            for part in slices([t.as_py() or "" for t in batch.column(len(kept))]):
                expected, counts = label_texts(sent.value, part)
                top = expected.argmax(1) if len(names) > 1 else np.zeros(len(part), np.int64)
                best += np.where(counts > 0, top, len(names) - 1).tolist()
                share += [e[k] / n if n else 0.0 for e, k, n in zip(expected, top, counts, strict=True)]
            columns = [batch.column(i) for i in range(len(kept))]
            found = [pa.array([names[k] for k in best], pa.string()), pa.array(np.clip(share, 0.0, 1.0), pa.float64())]
            yield pa.RecordBatch.from_arrays([*columns, *found], [*kept, *results])

    return docs.select(*kept, docs[text].alias("_langid_text")).mapInArrow(released(run), T.StructType(fields))


def held_out(key: Column) -> Column:
    """Documents that nothing is learned from."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def learn_languages(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    language: str = "lang",
    texts_per_language: int = TEXTS_PER_LANGUAGE,
    windows: int = WINDOWS,
    window_words: int = WINDOW_WORDS,
) -> Model:
    """A model learned from the documents that are not :func:`held_out`."""
    labelled = docs.where(~held_out(F.col(key)))
    return train(training_sample(labelled, key, text, language, texts_per_language, windows, window_words))
