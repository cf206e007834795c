"""Language of every word, and of the text, by a linear-chain conditional random field.

A word's features are its affixes and character n-grams (n-grams of the word between two boundary
marks) and whether it is in a language's lexicon of frequent words. Features and the transitions
between neighbouring words' languages have learnt weights; forward-backward gives every word's
probability of each language, given the whole text. A text may switch languages.

Training takes a bounded sample: for each language the :data:`SAMPLE_DOCS` labelled documents with
the least hash of their key. Their lines are dealt into mixed sequences, so that switches occur.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.llm.common import map_batches

SAMPLE_DOCS = 200
LEXICON_WORDS = 500
UNKNOWN = "und"

FEATURE_BITS = 18
ORDERS = (1, 2, 3, 4)
SEQUENCE = 64
ROUNDS = 25
# Words a task keeps; a full store is emptied. This bounds memory and changes no result.
KEPT_WORDS = 400_000
# Documents and words that go through forward-backward together.
TOGETHER, TOGETHER_WORDS = 512, 400_000


def in_fold(key: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """Whether the CRC-32 of the key's text leaves this remainder."""
    crc = F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    return F.pmod(crc, F.lit(folds)) == fold


def letters_of(chunk: str) -> str:
    """A chunk's letters in lower case."""
    return chunk if chunk.isalpha() else "".join([c for c in chunk if c.isalpha()])


def chunks_of(text: str | None) -> list[str]:
    return text.lower().split() if text else []


def features_of(words: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each order the hashed n-grams of the words, and which word each belongs to."""
    codes = np.frombuffer("".join([f"\x02{w}\x03" for w in words]).encode("utf-32-le"), "<u4")
    codes = codes.astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    owner = np.repeat(np.arange(len(words)), lengths)
    found, value = [], np.zeros(len(codes), np.uint64)
    for order in range(1, max(ORDERS) + 1):
        n = len(codes) - order + 1
        if n <= 0:
            break
        value = value[:n] * np.uint64(0x100000001B3) + codes[order - 1 :] + np.uint64(order)
        if order in ORDERS:
            inside = owner[:n] == owner[order - 1 :]
            mixed = value * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - FEATURE_BITS)
            found.append((mixed[inside].astype(np.int64), owner[:n][inside]))
    return found


@dataclass
class Model:
    """Weights: ``features`` by hash, ``lexicon`` by word, ``transitions`` from row to column."""

    languages: list[str]
    features: np.ndarray
    lexicon: dict[str, np.ndarray]
    lexicon_weights: np.ndarray
    transitions: np.ndarray

    def emissions(self, words: list[str]) -> np.ndarray:
        """Each word's score for each language."""
        scores = np.zeros((len(words), len(self.languages)), np.float64)
        for hashes, owner in features_of(words):
            for label in range(scores.shape[1]):
                scores[:, label] += np.bincount(
                    owner, self.features[hashes, label], minlength=len(words)
                )
        lengths = np.fromiter(map(len, words), np.float64, len(words))
        scores /= np.sqrt(lengths + 2)[:, None]
        for i, word in enumerate(words):
            if (held := self.lexicon.get(word)) is not None:
                scores[i] += held * self.lexicon_weights
        return scores


def forward_backward(
    emissions: np.ndarray, lengths: np.ndarray, transitions: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Probabilities of labels in sequences side by side.

    ``emissions`` has axes step, sequence, label. Returns the marginals, and forward values, local
    scores and scaled backward values, from which pairs' expectations follow.
    """
    steps, n, k = emissions.shape
    local = np.exp(emissions - emissions.max(axis=2, keepdims=True))
    link = np.exp(transitions - transitions.max())
    alpha, scale = np.empty_like(local), np.empty((steps, n, 1))
    now = local[0]
    for t in range(steps):
        if t:
            now = (now @ link) * local[t]
        scale[t] = now.sum(axis=1, keepdims=True)
        now = now / scale[t]
        alpha[t] = now
    beta, going = np.empty_like(local), lengths[None, :] > np.arange(steps)[:, None]
    after = np.ones((n, k))
    beta[steps - 1] = after
    for t in range(steps - 2, -1, -1):
        after = ((after * local[t + 1]) @ link.T) / scale[t + 1]
        if not going[t + 1].all():
            after[~going[t + 1]] = 1.0
        beta[t] = after
    gamma = alpha * beta
    gamma /= gamma.sum(axis=2, keepdims=True)
    return gamma, alpha, local, beta / scale


def train(documents: list[tuple[str, str]], rounds: int = ROUNDS) -> Model | None:
    """Fit a model to ``(language, text)`` pairs; None without any word."""
    languages = sorted({lang for lang, _ in documents})
    lines = []
    for lang, text in documents:
        for line in text.split("\n"):
            found = [w for w in map(letters_of, chunks_of(line)) if w]
            if found:
                lines.append((zlib.crc32(line.encode()), languages.index(lang), found))
    if not lines:
        return None
    lines.sort()
    k = len(languages)
    frequent = [Counter() for _ in languages]
    for _, label, found in lines:
        frequent[label].update(found)
    lexicon: dict[str, np.ndarray] = {}
    for label, counts in enumerate(frequent):
        for word, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:LEXICON_WORDS]:
            lexicon.setdefault(word, np.zeros(k))[label] = 1.0
    place: dict[str, int] = {}
    tokens = np.array([place.setdefault(w, len(place)) for _, _, ws in lines for w in ws])
    labels = np.repeat([label for _, label, _ in lines], [len(ws) for _, _, ws in lines])
    words = list(place)
    n = -(-len(tokens) // SEQUENCE)
    lengths = np.full(n, SEQUENCE)
    lengths[-1] = len(tokens) - SEQUENCE * (n - 1)
    grid = np.zeros(n * SEQUENCE, np.int64)
    grid[: len(tokens)] = tokens
    grid = grid.reshape(n, SEQUENCE).T
    real = np.arange(SEQUENCE)[:, None] < lengths[None, :]
    truth = np.zeros((n * SEQUENCE, k))
    truth[np.arange(len(tokens)), labels] = 1
    truth = truth.reshape(n, SEQUENCE, k).transpose(1, 0, 2)
    pairs = np.einsum("tbi,tbj->ij", truth[:-1], truth[1:])

    model = Model(languages, np.zeros((1 << FEATURE_BITS, k)), lexicon, np.ones(k), np.zeros((k, k)))
    grams = features_of(words)
    size = np.sqrt(np.fromiter(map(len, words), np.float64, len(words)) + 2)[:, None]
    held = np.array([lexicon.get(w, np.zeros(k)) for w in words])
    weights = [model.features, model.lexicon_weights, model.transitions]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, rounds + 1):
        scores = model.emissions(words)
        gamma, alpha, local, beta = forward_backward(scores[grid], lengths, model.transitions)
        link = np.exp(model.transitions - model.transitions.max())
        linked = (local * beta)[1:] * real[1:, :, None]
        expected = np.einsum("tbi,tbj->ij", alpha[:-1], linked) * link
        missed = (truth - gamma) * real[:, :, None]
        by_word = np.stack(
            [np.bincount(grid.ravel(), missed[:, :, i].ravel(), len(words)) for i in range(k)], axis=1
        )
        shared, slope = by_word / size, np.zeros_like(model.features)
        for hashes, owner in grams:
            for i in range(k):
                slope[:, i] += np.bincount(hashes, shared[owner, i], len(slope))
        slopes = [slope, (by_word * held).sum(axis=0), pairs - expected]
        for w, g, m, v in zip(weights, slopes, first, second, strict=True):
            g -= 0.1 * w
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    model.features = model.features.astype(np.float32)
    return model


class Labeller:
    """Applies a model to texts; keeps the scores of words it has met."""

    def __init__(self, model: Model):
        self.model = model
        self.place: dict[str, int] = {}
        self.scores = np.zeros((1 << 16, len(model.languages)))
        self.used = 0

    def places(self, chunked: list[list[str]]) -> None:
        """Score the chunks that are not in the store; place -1 is for those without letters."""
        if len(self.place) > KEPT_WORDS:
            self.place, self.used = {}, 0
        new = list(set().union(*chunked).difference(self.place))
        words = [letters_of(c) for c in new]
        with_letters = [i for i, w in enumerate(words) if w]
        if with_letters:
            found = self.model.emissions([words[i] for i in with_letters])
            while self.used + len(found) > len(self.scores):
                self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
            self.scores[self.used : self.used + len(found)] = found
        self.place.update((c, -1) for c in new)
        for i in with_letters:
            self.place[new[i]] = self.used
            self.used += 1

    def marginals(self, texts: list[str | None]) -> list[np.ndarray]:
        """Every text's word probabilities, one row for each chunk that has a letter."""
        chunked = [chunks_of(t) for t in texts]
        self.places(chunked)
        place = self.place.__getitem__
        tokens = [np.fromiter(map(place, chunks), np.int64, len(chunks)) for chunks in chunked]
        tokens = [t[t >= 0] for t in tokens]
        order = sorted(range(len(tokens)), key=lambda i: len(tokens[i]))
        k = self.scores.shape[1]
        out: list[np.ndarray] = [np.zeros((0, k))] * len(tokens)
        order = [i for i in order if len(tokens[i])]
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and end - at < 64 and len(tokens[order[end]]) * (end - at + 1) <= TOGETHER_WORDS and len(tokens[order[end]]) <= 1.3 * len(tokens[order[at]]) + 16:
                end += 1
            group = order[at:end]
            lengths = np.array([len(tokens[i]) for i in group])
            grid = np.zeros((lengths.max(), len(group)), np.int64)
            for column, i in enumerate(group):
                grid[: lengths[column], column] = tokens[i]
            gamma, *_ = forward_backward(self.scores[grid], lengths, self.model.transitions)
            for column, i in enumerate(group):
                out[i] = gamma[: lengths[column], column]
            at = end
        return out

    def label(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [], []
        for gamma in self.marginals(texts):
            if len(gamma):
                mean = gamma.mean(axis=0)
                best = int(mean.argmax())
                names.append(self.model.languages[best])
                scores.append(min(1.0, float(mean[best])))
            else:
                names.append(UNKNOWN)
                scores.append(0.0)
        return names, scores


def sample(
    df: DataFrame, allowed: Column, lang: str, text: str, key: str, docs: int = SAMPLE_DOCS
) -> list[tuple[str, str]]:
    """At most ``docs`` labelled documents of each language, by the least hash of their key."""
    labelled = df.where(allowed & F.col(lang).isNotNull() & F.col(text).isNotNull())
    ranked = labelled.select(
        F.col(lang).alias("lang"),
        F.xxhash64(F.col(key).cast("string"), F.xxhash64(text)).alias("mark"),
    )
    # Spark keeps only this many rows of a language in each task before they meet
    place = F.row_number().over(Window.partitionBy("lang").orderBy("mark"))
    marks = ranked.withColumn("place", place).where(F.col("place") <= docs).select("lang", "mark")
    bounds = {r["lang"]: r["most"] for r in marks.groupBy("lang").agg(F.max("mark").alias("most")).collect()}
    if not bounds:
        return []
    limit = F.create_map(*[F.lit(x) for pair in bounds.items() for x in pair])
    own = F.xxhash64(F.col(key).cast("string"), F.xxhash64(text))
    chosen = labelled.where(own <= limit[F.col(lang)]).select(lang, text)
    # copies of a row share their mark: one of them is enough
    return sorted({(r[0], r[1]) for r in chosen.distinct().collect()})


def fit(
    df: DataFrame,
    allowed: Column | None = None,
    *,
    lang: str = "lang",
    text: str = "text",
    key: str = "doc_id",
    docs: int = SAMPLE_DOCS,
) -> Model | None:
    """A model of the languages labelled in ``df``, from rows where ``allowed`` holds; None if
    there are none."""
    return train(sample(df, F.lit(True) if allowed is None else allowed, lang, text, key, docs))


def identify(df: DataFrame, model: Model | None, text: str = "text", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keys`` with ``lang_pred``, the language most likely over the whole text's words, and
    ``score``, its mean probability.

    Null texts, texts without letters, and all texts when nothing could be learnt, are ``und``
    with score 0. Repeated rows come out each.
    """

    def task(batches: Iterator[list[list]]) -> Iterator[tuple]:
        labeller = Labeller(model) if model else None
        held: list[list] = [[] for _ in range(len(keys) + 1)]

        def labelled():
            texts = held[-1]
            if labeller:
                names, scores = labeller.label(texts)
            else:
                names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            return (*[list(c) for c in held[:-1]], names, scores)

        for columns in batches:
            for kept, column in zip(held, columns, strict=True):
                kept.extend(column)
            if len(held[-1]) >= TOGETHER:
                yield labelled()
                held = [[] for _ in held]
        if held[-1]:
            yield labelled()

    kinds = [f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys]
    schema = ", ".join([*kinds, "lang_pred string", "score double"])
    return map_batches(df.select(*keys, F.col(text).cast("string").alias("_text")), task, schema)


def keep(df: DataFrame, model: Model | None, min_score: float, text: str = "text") -> DataFrame:
    """The rows, unchanged, whose text has a recognised language with at least this score."""
    place = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(model) if model else None
        for whole in batches:
            for at in range(0, whole.num_rows, TOGETHER):
                batch = whole.slice(at, TOGETHER)
                if labeller:
                    names, scores = labeller.label(batch.column(place).to_pylist())
                    known = [n != UNKNOWN and s >= min_score for n, s in zip(names, scores, strict=True)]
                    yield batch.filter(pa.array(known, pa.bool_()))

    return df.mapInArrow(run, df.schema)
