"""Toxicity by a weighted finite-state grammar over clauses.

Four transducers work in a row: the lexical one turns words into classes (insult,
threat, target, negation, reporting verb) with a weight, by stems of words; the
next mark classes that are negated, reported, or aimed at a target; the last one
gives each matched pattern its weight.  They are composed into one machine by
walking the pairs of their states.  A clause's score is the sum along its path, and a text is
described by its clauses: the strongest, all of them, and each kind of pattern.

Stems and their weights are learned from labelled texts, as is the logistic
curve over the description.  Stems of one half of the training rows describe the
other half, so that the curve does not rest on words that were chosen from the
same texts.
"""

from __future__ import annotations

import math
import re
from collections import Counter, deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableaudit.llm.common import staged

# Bounds of the training sample and of what is learned from it.
ROWS_PER_CLASS = 3000
LEAST_SUPPORT = 4
LEAST_WEIGHT = 1.2
# A stem's weight is its log-odds less so many standard errors.
CAUTION = 2.0
STEM_LENGTHS = range(3, 9)
THRESHOLD = 0.3

OTHER, INSULT, HARM, TARGET, NEGATION, REPORT, INTENT, PAUSE = range(8)

# The words of each class before any text is seen.
SEEDS = {
    INSULT: (
        "idiot stupid moron loser trash scum worthless pathetic disgusting clown dumb "
        "dumm idioten abschaum wertlos idiota estúpido basura imbécile stupide ordure"
    ),
    HARM: "kill hurt destroy shoot stab töten umbringen schlagen tuer frapper matar golpear",
    TARGET: "you your yourself they them him her du dich dein ihr euch tu toi vous votre te usted ustedes",
    NEGATION: "not no never isn aren don nicht kein keine nie pas jamais ne nunca ni",
    REPORT: "said says called wrote claimed quoted sagte sagt nannte dit disait écrit dijo dice llamó",
    INTENT: "will gonna going werde werden vais allons voy vamos",
}
# The weight of a matched pattern in a clause's score, by kind.
KINDS = {
    "insult": 1.0, "aimed insult": 1.5, "denied insult": 0.3, "reported insult": 0.5,
    "threat": 1.0, "aimed threat": 1.5, "denied threat": 0.2, "reported threat": 0.4,
}
SEED_WEIGHT = 1.0
_CLAUSE = re.compile(r"[^.!?;\n]+")
_TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+|[,:]")
_WHOLE = " "
_KNOWN = 200_000


# ------------------------------------------------------------------ transducers

# A symbol is a class and the marks set on it so far.
Symbol = tuple[int, frozenset]


class Span:
    """Marks symbols of some classes that follow one of ``openers`` within ``span`` words.

    ``closes`` are classes that end the span at once.
    """

    def __init__(self, openers: set[int], marked: set[int], mark: str, span: int, closes: frozenset = frozenset()) -> None:
        self.openers, self.marked, self.mark, self.span, self.closes = openers, marked, mark, span, closes
        self.start = 0

    def step(self, state: int, symbol: Symbol) -> tuple[int, Symbol]:
        kind, marks = symbol
        if state and kind in self.marked:
            symbol = kind, marks | {self.mark}
        if kind in self.openers:
            return self.span, symbol
        if kind in self.closes:
            return 0, symbol
        return max(state - 1, 0), symbol


class Scorer:
    """Turns marked classes into kinds of patterns; its state is the last pattern that a target may still follow."""

    span = 3
    start = (0, "")

    def step(self, state: tuple[int, str], symbol: Symbol) -> tuple[tuple[int, str], str]:
        (left, waiting), (kind, marks) = state, symbol
        later = (left - 1, waiting) if left > 1 else self.start
        if kind == TARGET and waiting:
            return self.start, f"aimed {waiting}"
        if kind not in (INSULT, HARM):
            return later, ""
        if kind == HARM and "intent" not in marks and "aimed" not in marks:
            # A verb of harm alone is no threat, but becomes one with a target behind it.
            return ((self.span, "threat") if not marks else self.start), ""
        name = "insult" if kind == INSULT else "threat"
        for mark in ("reported", "denied", "aimed"):
            if mark in marks:
                return self.start, f"{mark} {name}"
        return (self.span, name), name


def grammar() -> list:
    return [
        Span({NEGATION}, {INSULT, HARM}, "denied", 3, frozenset({PAUSE})),
        Span({REPORT}, {INSULT, HARM}, "reported", 12),
        Span({TARGET}, {INSULT, HARM}, "aimed", 3, frozenset({PAUSE})),
        Span({INTENT}, {HARM}, "intent", 4, frozenset({PAUSE})),
        Scorer(),
    ]


def compose(machines: list, classes: Iterable[int]) -> list[list[tuple[int, str]]]:
    """One table, [state][class] to (next state, kind), of the machines in a row; state 0 is the start."""
    first = tuple(m.start for m in machines)
    number, todo, table = {first: 0}, deque([first]), []
    while todo:
        states, row = todo.popleft(), []
        for kind in classes:
            symbol, after = (kind, frozenset()), []
            for machine, state in zip(machines, states, strict=True):
                state, symbol = machine.step(state, symbol)
                after.append(state)
            after = tuple(after)
            if after not in number:
                number[after] = len(number)
                todo.append(after)
            row.append((number[after], symbol))
        table.append(row)
    return table


@cache
def machine() -> list[list[tuple[int, str]]]:
    return compose(grammar(), range(8))


# ---------------------------------------------------------------------- lexicon


@dataclass
class Lexicon:
    """Weights of insult stems (``word + ' '`` is a whole word), and the words of the other classes."""

    stems: dict[str, float]
    words: dict[str, int] = field(default_factory=lambda: fixed_classes())
    known: dict[str, int] = field(default_factory=dict, repr=False)

    def weight(self, word: str) -> float:
        found = [self.stems[s] for s in stems_of(word) if s in self.stems]
        return max(found, default=0.0)

    def kind(self, word: str) -> int:
        """The class of a word, from a bounded store of those seen before."""
        kind = self.words.get(word, OTHER) or (INSULT if self.weight(word) else OTHER)
        if len(self.known) >= _KNOWN:
            self.known.clear()
        if len(word) <= 64:
            self.known[word] = kind
        return kind

    def codes(self, words: list[str]) -> bytes:
        known = self.known.get
        return bytes([self.kind(w) if (k := known(w)) is None else k for w in words])


def fixed_classes() -> dict[str, int]:
    return {w: kind for kind, words in SEEDS.items() if kind != INSULT for w in words.split()} | {",": PAUSE, ":": PAUSE}


def stems_of(word: str) -> list[str]:
    return [word[:n] for n in STEM_LENGTHS if n <= len(word)] + [word + _WHOLE]


def stem_weight(toxic: float, clean: float, n_toxic: float, n_clean: float) -> float:
    odds = math.log((toxic + 0.5) / (n_toxic + 1)) - math.log((clean + 0.5) / (n_clean + 1))
    return odds - CAUTION * math.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))


def learn_lexicon(counts: dict[str, tuple[int, int]], n_toxic: int, n_clean: int) -> Lexicon:
    """Stems from the number of toxic and clean texts that hold each.

    The heaviest stems come first, of equal ones the longest.  Once a stem is kept,
    longer ones add nothing, and shorter ones are judged by the texts that are left
    to them.  Words of the seed list stay, unless the labels speak against them.
    """
    kept: dict[str, float] = {}
    for word in SEEDS[INSULT].split():
        toxic, clean = counts.get(word + _WHOLE, (0, 0))
        if clean < LEAST_SUPPORT or (toxic + 0.5) * (n_clean + 1) > (clean + 0.5) * (n_toxic + 1):
            kept[word + _WHOLE] = SEED_WEIGHT
    known = {s: stem_weight(a, b, n_toxic, n_clean) for s, (a, b) in counts.items() if a >= LEAST_SUPPORT}
    learned: dict[str, float] = {}
    taken: dict[str, list[int]] = {}
    for stem in sorted(known, key=lambda s: (-known[s], -len(s), s)):
        shorter = [stem[:n] for n in STEM_LENGTHS if n < len(stem)]
        if known[stem] < LEAST_WEIGHT or any(s in learned for s in shorter):
            continue
        # A text counted under several longer stems is taken off more than once, which errs on the careful side.
        off = taken.get(stem, [0, 0])
        toxic, clean = counts[stem][0] - off[0], max(counts[stem][1] - off[1], 0)
        weight = stem_weight(toxic, clean, n_toxic, n_clean) if toxic >= LEAST_SUPPORT else 0.0
        if weight < LEAST_WEIGHT:
            continue
        learned[stem] = weight
        for s in shorter:
            held = taken.setdefault(s, [0, 0])
            held[0] += toxic
            held[1] += clean
    return Lexicon({s: max(kept.get(s, 0.0), learned.get(s, 0.0)) for s in kept | learned})


# ---------------------------------------------------------------------- scoring


def clauses(text: str, lexicon: Lexicon) -> Iterator[tuple[int, int, float, dict[str, float]]]:
    """(start, end, score, weight by kind) of each clause that matches the grammar."""
    table = machine()
    low = text.lower()
    for part in _CLAUSE.finditer(low):
        words = _TOKEN.findall(part.group())
        codes = lexicon.codes(words)
        if INSULT not in codes and HARM not in codes:
            continue
        state, held, last = 0, {}, 0.0
        for word, code in zip(words, codes, strict=True):
            if code == INSULT:
                last = lexicon.weight(word)
            elif code == HARM:
                last = SEED_WEIGHT
            state, kind = table[state][code]
            if kind:
                held[kind] = held.get(kind, 0.0) + last
        if held:
            yield part.start(), part.end(), sum(KINDS[k] * w for k, w in held.items()), held


N_FEATURES = 2 + len(KINDS)


def description(found: list[tuple[int, int, float, dict[str, float]]]) -> list[float]:
    """The strongest clause, all clauses, and each kind's weight, the last two by log(1 + x)."""
    total: Counter = Counter()
    for *_, held in found:
        total.update(held)
    scores = [f[2] for f in found]
    return [max(scores, default=0.0), math.log1p(sum(scores)), *[math.log1p(total[k]) for k in KINDS]]


@dataclass(frozen=True)
class Model:
    """Lexicon, weights of the description, and the bias."""

    lexicon: Lexicon
    weights: tuple[float, ...]
    bias: float

    def score(self, found: list) -> float:
        at = self.bias + sum(w * x for w, x in zip(self.weights, description(found), strict=True))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, at))))


def fit_curve(features: np.ndarray, labels: np.ndarray, prior: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, float]:
    """Logistic weights by Newton steps, drawn towards ``prior``; the bias is free but for a faint pull to 0."""
    x = np.hstack([features, np.ones((len(features), 1))])
    centre, pull = np.append(prior, 0.0), np.append(np.full(features.shape[1], ridge), 1e-3)
    w = centre.copy()

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(np.logaddexp(0, z).sum() - labels @ z + 0.5 * (pull * (w - centre) ** 2).sum())

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        slope = x.T @ (p - labels) + pull * (w - centre)
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + np.diag(pull), slope)
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


# --------------------------------------------------------------------- training


def id_remainder(doc_id: Column, by: int) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % by


def training_ids(labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, toxic, fold) of at most ``rows_per_class`` ids of each class, and how many each class has.

    They are the first by a hash of the id.  Of several labels of one id the
    larger counts; labels other than 0 and 1 are not read.
    """
    known = (
        labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    h = F.xxhash64("doc_id")
    first = [known.where(F.col("toxic") == t).orderBy(h, "doc_id").limit(rows_per_class) for t in (0, 1)]
    ids = first[0].unionByName(first[1]).withColumn("fold", F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(2)).cast("int"))
    return ids, {t: sizes.get(t, 0) for t in (0, 1)}


def stem_counts(rows: DataFrame) -> DataFrame:
    """(stem, t0, t1, c0, c1): toxic and clean texts of either fold that hold each stem."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list[int]] = {}
        for batch in batches:
            for text, toxic, fold in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                at = (0 if toxic else 2) + fold
                for stem in {s for w in set(_TOKEN.findall((text or "").lower())) for s in stems_of(w)}:
                    seen.setdefault(stem, [0, 0, 0, 0])[at] += 1
                if len(seen) > _KNOWN:
                    yield _stem_batch(seen)
                    seen = {}
        yield _stem_batch(seen)

    counted = rows.select("text", "toxic", "fold").mapInArrow(count, "stem string, t0 long, t1 long, c0 long, c1 long")
    return counted.groupBy("stem").agg(*[F.sum(c).alias(c) for c in ("t0", "t1", "c0", "c1")])


def _stem_batch(seen: dict[str, list[int]]) -> pa.RecordBatch:
    columns = [pa.array([v[i] for v in seen.values()], pa.int64()) for i in range(4)]
    return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), *columns], names=["stem", "t0", "t1", "c0", "c1"])


def describe(rows: DataFrame, lexicons: dict[int, Lexicon]) -> DataFrame:
    """(doc_id, toxic, features) of rows with a fold, each by the lexicon of the other fold."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, toxic, folds = (c.to_pylist() for c in batch.columns)
            values = [description(list(clauses(t or "", lexicons[1 - f]))) for t, f in zip(texts, folds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(toxic, pa.int32()), pa.array(values, pa.list_(pa.float64()))],
                names=["doc_id", "toxic", "features"],
            )

    return rows.select("doc_id", "text", "toxic", "fold").mapInArrow(apply, "doc_id long, toxic int, features array<double>")


def train(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> Model:
    """The model of the labelled rows (labels: doc_id, toxic; docs: doc_id, text).

    At most ``rows_per_class`` ids of each class are read.  The driver gets stems
    with enough support, and one description per id.  Without labels of both
    classes the seed list and a fixed curve are left.
    """
    ids, sizes = training_ids(labels, rows_per_class)
    ids = staged(ids, "toxic-ids")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = staged(texts.join(F.broadcast(ids), "doc_id"), "toxic-rows")
    prior = np.array([0.5, 0.5] + [0.0] * len(KINDS))
    held = {(r["toxic"], r["fold"]): r["n"] for r in rows.groupBy("toxic", "fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = [held.get((t, f), 0) for t in (1, 0) for f in (0, 1)]
    toxic, clean = F.col("t0") + F.col("t1"), F.col("c0") + F.col("c1")
    enough = (toxic >= LEAST_SUPPORT) & (toxic * (n[2] + n[3] + 1) >= clean * (n[0] + n[1] + 1))
    seeds = F.col("stem").isin([w + _WHOLE for w in SEEDS[INSULT].split()])
    found = {r["stem"]: tuple(r)[1:] for r in stem_counts(rows).where(enough | seeds).collect()}
    whole = learn_lexicon({s: (a + b, c + d) for s, (a, b, c, d) in found.items()}, n[0] + n[1], n[2] + n[3])
    if not (n[0] + n[1] and n[2] + n[3]):
        return Model(whole, tuple(prior), -3.0)
    halves = {
        f: learn_lexicon({s: (v[f], v[2 + f]) for s, v in found.items()}, n[f], n[2 + f]) for f in (0, 1)
    }
    described = describe(rows, halves).groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.max("features").alias("features"))
    got = described.orderBy("doc_id").collect()
    labels_of = np.array([r["toxic"] for r in got], float)
    weights, bias = fit_curve(np.array([r["features"] for r in got]), labels_of, prior)
    # The sample holds the classes in other shares than the labels do.
    share = lambda a, b: math.log((a + 0.5) / (b + 0.5))
    bias += share(sizes[1], sizes[0]) - share(labels_of.sum(), (1 - labels_of).sum())
    return Model(whole, tuple(float(w) for w in weights), bias)


SCORED = (
    "doc_id long, score double, "
    "clauses array<struct<start:long, end:long, score:double, kinds:string>>"
)


def score_texts(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1) and the matched clauses of every whole text of ``docs`` (doc_id, text).

    Places are code points of the text in lower case.  Null and empty texts match nothing and get the score of
    that.  Repeated rows give repeated results; an empty table gives none; other
    columns are not read.
    """
    clause = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("kinds", pa.string())])
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("clauses", pa.list_(clause))])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, spans = [], []
            for text in batch.column(1):
                found = list(clauses(text.as_py() or "", model.lexicon))
                scores.append(model.score(found))
                spans.append([{"start": a, "end": b, "score": s, "kinds": ", ".join(sorted(k))} for a, b, s, k in found])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(spans, pa.list_(clause))], schema=schema)

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(apply, SCORED)


def toxicity(docs: DataFrame, labels: DataFrame, held_out: int = 2, parts: int = 4, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted and n_clauses of every row.

    The model is trained on labels of ids whose CRC-32 modulo ``parts`` is not
    ``held_out``; a null id counts as empty text.
    """
    model = train(docs, labels.where(id_remainder(F.col("doc_id"), parts) != held_out))
    return score_texts(docs, model).select(
        "doc_id",
        (id_remainder(F.col("doc_id"), parts) == held_out).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        F.size("clauses").cast("long").alias("n_clauses"),
    )
