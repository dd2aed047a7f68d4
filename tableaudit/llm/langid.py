"""Language of code-switched text by a linear-chain conditional random field.

Each word is labelled with a language.  Its score for a language is the sum of
the weights of its features (prefixes, suffixes, character trigrams, the word
itself as a lexicon entry), and transitions between the labels of neighbours are
learned with them.  Forward-backward gives each word's marginals; a document's
language is the one with the largest mean marginal, which is its score.

Training uses a bounded sample of labelled rows: ``rows_per_language`` rows of
each label, chosen by a hash of the id, and ``words_per_row`` words of each, from
a place chosen by hash.  Spans of different rows are laid end to end, so that the
chain sees switches.  Prediction reads every word of every text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_LANGUAGE = 300
WORDS_PER_ROW = 150
MOST_FEATURES = 60_000
UNKNOWN = "und"
_LETTERS = re.compile(r"[^\W\d_]+")
# Scores (words times languages) held at once, unless one text has more; words whose scores are kept; texts looked at together.
_BATCH_SCORES = 1 << 19
_KNOWN_WORDS = 1 << 19
_BATCH_TEXTS = 2048


def words_of(text: str | None) -> list[str]:
    """Runs of letters, lower-cased."""
    return [w for w in _LETTERS.findall((text or "").lower()) if any(c.isalpha() for c in w)]


def features(word: str) -> list[str]:
    """Affixes, character trigrams with the word's ends, and the word itself."""
    ends = f"^{word}$"
    out = [f"={word}"]
    out += [f"<{word[:n]}" for n in (1, 2, 3) if len(word) >= n]
    out += [f">{word[-n:]}" for n in (1, 2, 3, 4) if len(word) >= n]
    out += {ends[i : i + 3] for i in range(len(ends) - 2)}
    return out


@dataclass(frozen=True)
class Model:
    """Weights of features by language, and of transitions from a label to the next."""

    languages: tuple[str, ...]
    vocabulary: dict[str, int]
    weights: np.ndarray
    transitions: np.ndarray

    def scores(self, word: str) -> np.ndarray:
        found = [self.vocabulary[f] for f in features(word) if f in self.vocabulary]
        return self.weights[found].sum(axis=0) if found else np.zeros(len(self.languages))


def forward_backward(emissions: np.ndarray, starts: np.ndarray, lengths: np.ndarray, transitions: np.ndarray):
    """Marginals of each word of many sequences, all steps of equal place at once.

    ``emissions`` (words x labels) holds the sequences one after the other, each
    of at least one word, longest first.  Returns the marginals in the same order
    and the products forward and backward need for expected transitions.
    """
    n_labels = emissions.shape[1]
    local = np.exp(emissions - emissions.max(axis=1, keepdims=True))
    step = np.exp(transitions - transitions.max())
    steps = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(steps), side="left")
    forward = np.empty_like(local)
    state = np.full((len(lengths), n_labels), 1.0 / n_labels, local.dtype)
    for t in range(steps):
        n = active[t]
        at = starts[:n] + t
        state = (state[:n] @ step if t else state[:n]) * local[at]
        state /= state.sum(axis=1, keepdims=True)
        forward[at] = state
    backward = np.empty_like(local)
    behind = np.zeros((0, n_labels), local.dtype)
    for t in range(steps - 1, -1, -1):
        n = active[t]
        at = starts[:n] + t
        state = np.ones((n, n_labels), local.dtype)
        if len(behind):
            state[: len(behind)] = behind @ step.T
        backward[at] = state
        behind = state * local[at]
        behind /= behind.sum(axis=1, keepdims=True)
    marginals = forward * backward
    marginals /= marginals.sum(axis=1, keepdims=True)
    return marginals, forward, backward * local, step


def train(rows: list[tuple[str, list[str]]], most_features: int = MOST_FEATURES, rounds: int = 40) -> Model:
    """Fit by gradient steps on the conditional likelihood; ``rows`` are (language, words), in a fixed order."""
    languages = tuple(sorted({lang for lang, _ in rows}))
    if not languages:
        return Model((), {}, np.zeros((0, 0), np.float32), np.zeros((0, 0), np.float32))
    number = {lang: i for i, lang in enumerate(languages)}
    random = np.random.Generator(np.random.PCG64(7))
    spans = []
    for lang, words in rows:
        at = 0
        while at < len(words):
            size = int(random.integers(10, 41))
            spans.append((number[lang], words[at : at + size]))
            at += size
    spans = [spans[i] for i in random.permutation(len(spans))]
    types: dict[str, int] = {}
    word_ids = np.array([types.setdefault(w, len(types)) for _, words in spans for w in words])
    labels = np.array([k for k, words in spans for _ in words])
    by_type = [features(w) for w in types]
    counts = Counter(f for fs in by_type for f in fs)
    kept = sorted(counts, key=lambda f: (-counts[f], f))[:most_features]
    vocabulary = {f: i for i, f in enumerate(kept)}
    flat = np.array([vocabulary[f] for fs in by_type for f in fs if f in vocabulary])
    widths = np.array([sum(f in vocabulary for f in fs) for fs in by_type])
    owner = np.repeat(np.arange(len(types)), widths)
    n_labels = len(languages)
    weights = np.zeros((len(vocabulary), n_labels))
    transitions = np.zeros((n_labels, n_labels))
    # Sequences of equal length, cut from the spans as they lie.
    length = 120
    lengths = np.array([min(length, len(word_ids) - i) for i in range(0, len(word_ids), length)])
    starts = np.arange(len(lengths)) * length
    inner = np.ones(len(word_ids), bool)
    inner[starts] = False
    later = np.flatnonzero(inner)
    seen_pairs = np.zeros((n_labels, n_labels))
    np.add.at(seen_pairs, (labels[later - 1], labels[later]), 1)
    truth = np.eye(n_labels)[labels]
    spread = lambda by_word: np.stack(
        [
            np.bincount(flat, np.bincount(word_ids, by_word[:, k], len(types))[owner], len(vocabulary))
            for k in range(n_labels)
        ],
        axis=1,
    )
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in (weights, transitions)]
    for turn in range(1, rounds + 1):
        scores = np.stack([np.bincount(owner, weights[flat, k], len(types)) for k in range(n_labels)], axis=1)
        marginals, forward, after, step = forward_backward(scores[word_ids], starts, lengths, transitions)
        joint = forward[later - 1][:, :, None] * step[None] * after[later][:, None, :]
        joint /= joint.sum(axis=(1, 2), keepdims=True)
        gradients = (
            spread(truth - marginals) - 0.1 * weights,
            seen_pairs - joint.sum(axis=0) - 0.1 * transitions,
        )
        for parameter, gradient, (mean, square) in zip((weights, transitions), gradients, moments, strict=True):
            mean += 0.1 * (gradient - mean)
            square += 0.02 * (gradient**2 - square)
            parameter += 0.15 * (mean / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.98**turn)) + 1e-6)
    return Model(languages, vocabulary, weights.astype(np.float32), transitions.astype(np.float32))


def held_out(doc_id: Column, fold: int = 1, folds: int = 3) -> Column:
    """Whether a row belongs to the fold that training never sees; a null id is in no fold."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def training_rows(
    docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE, words_per_row: int = WORDS_PER_ROW
) -> list[tuple[str, list[str]]]:
    """The bounded sample: at most rows_per_language * languages rows of at most words_per_row words."""
    labelled = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"),
    ).where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    labelled = labelled.where(~held_out(F.col("doc_id")))
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not counts:
        return []
    # A share of each language by hash: about half as many rows again as wanted, then the first by hash.
    share = F.create_map(
        *[x for lang, n in sorted(counts.items()) for x in (F.lit(lang), F.lit(min(1.0, (1.5 * rows_per_language + 20) / n)))]
    )
    labelled = labelled.withColumn("h", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)))
    picked = labelled.where(F.col("h") < F.element_at(share, F.col("lang")) * float(1 << 40))

    def excerpts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cut = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(text)
                room = max(0, len(words) - words_per_row)
                at = crc32(b"%d" % doc_id) % (room + 1)
                cut.append(" ".join(words[at : at + words_per_row]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(3), batch.column(2), pa.array(cut, pa.string())], names=["h", "lang", "words"]
            )

    found = picked.select("doc_id", "text", "lang", "h").mapInArrow(excerpts, "h long, lang string, words string")
    taken: Counter = Counter()
    rows = []
    for r in sorted(found.collect(), key=lambda r: (r["h"], r["lang"], r["words"])):
        if r["words"] and taken[r["lang"]] < rows_per_language:
            taken[r["lang"]] += 1
            rows.append((r["lang"], r["words"].split(" ")))
    return rows


class Tagger:
    """Applies a model to many texts; scores of words are kept between them, up to a bound."""

    def __init__(self, model: Model) -> None:
        self.model, self.known = model, {}
        self.table = np.zeros((1024, len(model.languages)), np.float32)

    def _numbers(self, words: list[str]) -> np.ndarray:
        known = self.known
        for w in words:
            if w not in known:
                if len(known) == len(self.table):
                    self.table = np.concatenate([self.table, np.zeros_like(self.table)])
                self.table[len(known)] = self.model.scores(w)
                known[w] = len(known)
        return np.array([known[w] for w in words], np.int32)

    def shares(self, texts: Iterable[list[str]]) -> np.ndarray:
        """Mean marginal of each language, by text; zeros for a text without words.

        Texts may come one by one: of each only the numbers of its words are held.
        """
        done, held = [np.zeros((0, len(self.model.languages)))], []
        for words in texts:
            if len(self.known) > _KNOWN_WORDS:
                # The numbers held are of these scores.
                done.append(self._shares(held))
                held, self.known = [], {}
            held.append(self._numbers(words))
        return np.concatenate([*done, self._shares(held)])

    def _shares(self, texts: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(texts), len(self.model.languages)))
        order = sorted((i for i, t in enumerate(texts) if len(t)), key=lambda i: -len(texts[i]))
        most = _BATCH_SCORES // max(1, out.shape[1])
        at = 0
        while at < len(order):
            end, held = at, 0
            while end < len(order) and (end == at or held + len(texts[order[end]]) <= most):
                held += len(texts[order[end]])
                end += 1
            own = order[at:end]
            lengths = np.array([len(texts[i]) for i in own])
            starts = np.cumsum(lengths) - lengths
            scores = self.table[np.concatenate([texts[i] for i in own])]
            marginals = forward_backward(scores, starts, lengths, self.model.transitions)[0]
            out[own] = np.add.reduceat(marginals, starts, axis=0) / lengths[:, None]
            at = end
        return out


def languages(docs: DataFrame, model: Model, carry: bool = False) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): lang_pred, score, second (the next best language), and ``row``.

    Null texts and texts without a letter are ``und`` with score 0, and so is all
    when the model knows no language.  Repeated rows give repeated results; an
    empty table gives none.  With ``carry``, ``row`` is a struct of all columns,
    otherwise doc_id is the only one read besides the text.
    """
    names = list(model.languages)
    text = F.col("text").cast("string").alias("text")
    # A text that is carried as it is goes to Python and back once.
    inside = carry and dict(docs.dtypes).get("text") == "string"
    if carry:
        row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
        source = docs.select(row) if inside else docs.select(row, text)
    else:
        source = docs.select(F.col("doc_id").cast("long").alias("row"), text)

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(model)
        for batch in batches:
            for start in range(0, batch.num_rows, _BATCH_TEXTS):
                part = batch.slice(start, _BATCH_TEXTS)
                texts = part.column(0).field("text") if inside else part.column(1)
                best, score, second = [UNKNOWN] * len(texts), [0.0] * len(texts), [None] * len(texts)
                shares = tagger.shares(words_of(t.as_py()) if names else [] for t in texts)
                full = np.flatnonzero(shares.any(axis=1))
                for i, ranks in zip(full.tolist(), np.argsort(-shares[full], axis=1, kind="stable"), strict=True):
                    best[i], score[i] = names[ranks[0]], min(1.0, float(shares[i, ranks[0]]))
                    second[i] = names[ranks[1]] if len(names) > 1 else None
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(best, pa.string()), pa.array(score, pa.float64()), pa.array(second, pa.string())],
                    names=["row", "lang_pred", "score", "second"],
                )

    kind = source.schema["row"].dataType.simpleString()
    return source.mapInArrow(tag, f"row {kind}, lang_pred string, score double, second string")


def identify(docs: DataFrame) -> DataFrame:
    """Train on the labelled rows outside the held-out fold and label all rows: doc_id, held_out, lang_pred, score."""
    found = languages(docs, train(training_rows(docs)))
    return found.select(F.col("row").alias("doc_id"), held_out(F.col("row")).alias("held_out"), "lang_pred", "score", "second")
