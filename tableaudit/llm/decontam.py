"""Benchmark decontamination by winnowing.

Every window of ``window`` words holds ``window - gram + 1`` word k-grams.  Both
sides keep the smallest k-gram hash of each such run, so a window that stands in
a document and in an item gives both the same fingerprint: no shared span of
``window`` words or more is missed.  Documents that share a fingerprint are read
again; around each place of a shared fingerprint the windows that contain it are
compared with the items' windows as text.

Items shorter than a window are one window of their own length; for the few
lengths that occur, a document's fingerprints are all its k-grams of that length.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableaudit.llm.common import WORD, fold_ascii, staged

WINDOW, GRAM = 10, 5
NON_ASCII = r"[^\x00-\x7F]"


def words_of(text: Column) -> Column:
    """The folded words of a text; null has none.  ASCII texts take the faster of two equal ways."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    fold = F.when(text.rlike(NON_ASCII), fold_ascii(text)).otherwise(F.lower(text))
    return F.regexp_extract_all(fold, F.lit(WORD), F.lit(0))


def _grams(hashes: Column, n: Column, gram: int) -> Column:
    """Hash of the ``gram`` words from each place on, from an array of word hashes of length n."""
    at = lambda i, k: F.get(hashes, i + k)
    return F.when(
        n >= gram,
        F.transform(
            F.sequence(F.lit(0), n - gram), lambda i: F.xxhash64(F.lit(gram), *[at(i, k) for k in range(gram)])
        ),
    ).otherwise(F.array().cast("array<long>"))


def _winnowed(grams: Column, n: Column, window: int, gram: int) -> Column:
    """The smallest gram of each window, each once."""
    run = window - gram + 1
    smallest = lambda i: F.least(*[F.get(grams, i + k) for k in range(run)]) if run > 1 else F.get(grams, i)
    return F.when(
        n >= window, F.array_distinct(F.transform(F.sequence(F.lit(0), n - window), smallest))
    ).otherwise(F.array().cast("array<long>"))


def _hashed(df: DataFrame, gram: int) -> DataFrame:
    """Adds word hashes, their number and the grams to a frame with ``words``."""
    return (
        df.withColumn("n", F.size("words"))
        .withColumn("wh", F.transform("words", lambda w: F.xxhash64(w)))
        .withColumn("grams", _grams(F.col("wh"), F.col("n"), gram))
    )


def _text_of(words: Column, start: Column, n: Column | int) -> Column:
    return F.array_join(F.slice(words, start + 1, n), " ")


def _sized(starts: Column, n: int) -> Column:
    return F.transform(starts, lambda s: F.struct(s.alias("start"), F.lit(n).alias("n")))


@dataclass(frozen=True)
class Index:
    """A benchmark's windows as text with their items, its fingerprints, and the lengths of its short items."""

    windows: DataFrame
    prints: DataFrame
    short: tuple[int, ...]
    window: int
    gram: int


def index(benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> Index:
    """The index of items (item_id, text); an item id may be null."""
    if not 1 <= gram <= window:
        raise ValueError("gram must be between 1 and window")
    items = staged(
        _hashed(
            benchmark.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("words")),
            gram,
        ).where("n > 0"),
        "items",
    )
    # Lengths below the window: fewer than ten numbers.
    short = tuple(sorted(r[0] for r in items.where(F.col("n") < window).select("n").distinct().collect()))
    prints = F.concat(
        _winnowed(F.col("grams"), F.col("n"), window, gram),
        *[F.when(F.col("n") == n, _grams(F.col("wh"), F.col("n"), n)).otherwise(F.array().cast("array<long>")) for n in short],
    )
    start = F.explode(F.sequence(F.lit(0), F.greatest(F.col("n") - window, F.lit(0)))).alias("start")
    windows = items.select("item_id", "words", F.least(F.col("n"), F.lit(window)).alias("n"), start).select(
        "item_id", _text_of(F.col("words"), F.col("start"), F.col("n")).alias("window")
    )
    return Index(windows.distinct(), items.select(F.explode(prints).alias("print")).distinct(), short, window, gram)


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def document_prints(docs: DataFrame, known: Index) -> DataFrame:
    """doc_id, text_key, n_words and the fingerprints of each row, from one scan of the texts."""
    rows = _hashed(_keyed(docs).select("doc_id", "text_key", words_of(F.col("text")).alias("words")), known.gram)
    prints = F.concat(
        _winnowed(F.col("grams"), F.col("n"), known.window, known.gram),
        *[F.array_distinct(_grams(F.col("wh"), F.col("n"), n)) for n in known.short],
    )
    return rows.select("doc_id", "text_key", F.col("n").cast("long").alias("n_words"), prints.alias("prints"))


def hits(docs: DataFrame, known: Index, printed: DataFrame | None = None) -> DataFrame:
    """Places of benchmark windows: doc_id, text_key, start, n (words) and the window's text.

    (doc_id, text_key) names a document's text: equal rows have equal hits, which
    are listed once.  ``printed`` is the result of ``document_prints`` where it is
    at hand.
    """
    window, gram = known.window, known.gram
    printed = document_prints(docs, known) if printed is None else printed
    # With a plain explode Spark would test the array's size first, by computing it once more for each word.
    shared = staged(
        printed.select("doc_id", "text_key", F.explode_outer("prints").alias("print"))
        .join(known.prints, "print")
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set("print").alias("prints")),
        "shared-prints",
    )

    # The documents that share a fingerprint, once per text, with the places of what they share.
    again = (
        _keyed(docs).join(
            shared.select(F.col("doc_id").alias("d"), F.col("text_key").alias("k"), "prints"),
            F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")),
        )
        .select("doc_id", "text_key", "prints", words_of(F.col("text")).alias("words"))
    )
    again = _hashed(again, gram)
    shares = lambda grams, i: F.array_contains("prints", F.get(grams, i))
    places = lambda grams, n: F.filter(
        F.when(F.col("n") >= n, F.sequence(F.lit(0), F.col("n") - n)).otherwise(F.array().cast("array<int>")),
        lambda i: shares(grams, i),
    )
    # Windows that begin between a shared gram's place and the next shared gram's reach: each start once.
    at = places(F.col("grams"), gram)
    around = F.flatten(
        F.transform(
            at,
            lambda p, i: F.when(
                F.least(p, F.col("n") - window) >= F.greatest(p - (window - gram), F.get(at, i - 1) + 1, F.lit(0)),
                F.sequence(
                    F.greatest(p - (window - gram), F.get(at, i - 1) + 1, F.lit(0)), F.least(p, F.col("n") - window)
                ),
            ).otherwise(F.array().cast("array<int>")),
        )
    )
    starts = F.when(F.col("n") >= window, _sized(around, window))
    starts = F.coalesce(starts, F.array().cast("array<struct<start:int,n:int>>"))
    for n in known.short:
        own = _grams(F.col("wh"), F.col("n"), n)
        starts = F.concat(starts, _sized(places(own, n), n))
    found = again.select(
        "doc_id",
        "text_key",
        F.explode(
            F.transform(
                starts,
                lambda s: F.struct(
                    s["start"].alias("start"), s["n"].alias("n"),
                    _text_of(F.col("words"), s["start"], s["n"]).alias("window"),
                ),
            )
        ).alias("at"),
    ).select("doc_id", "text_key", "at.start", "at.n", "at.window").distinct()
    return found.join(known.windows.select("window").distinct(), "window", "left_semi")


def _covered(spans: Column) -> Column:
    """How many words lie in any of the spans (start, n), in one walk over them by start."""
    step = lambda held, s: F.struct(
        F.greatest(held["end"], s["start"] + s["n"]).alias("end"),
        (held["n"] + F.greatest(s["start"] + s["n"] - F.greatest(held["end"], s["start"]), F.lit(0))).alias("n"),
    )
    none = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    return F.aggregate(F.array_sort(spans), none, step, lambda held: held["n"].cast("long"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): n_words, n_hit, items, contaminated.

    A word is hit when it lies in any occurrence of an item's window.  ``items``
    are the ids of items with occurring windows, as sorted strings; an item without
    an id counts for hits but has no name to list.  Null and empty texts have no
    words; repeated rows give repeated results; an empty table on either side
    gives no hits.  Other columns are not read.
    """
    known = index(benchmark, window, gram)
    printed = staged(document_prints(docs, known), "prints")
    found = staged(hits(docs, known, printed), "hits")
    spans = found.groupBy("doc_id", "text_key").agg(_covered(F.collect_set(F.struct("start", "n"))).alias("n_hit"))
    named = (
        found.select("doc_id", "text_key", "window").distinct().join(known.windows, "window")
        .groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    )
    marks = spans.select(F.col("doc_id").alias("d"), F.col("text_key").alias("k"), "n_hit").join(
        named, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("k") == F.col("text_key"))
    ).select("d", "k", "n_hit", "items")
    return printed.select("doc_id", "text_key", "n_words").join(
        marks, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")), "left"
    ).select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        (F.coalesce("n_hit", F.lit(0).cast("long")) > 0).alias("contaminated"),
    )


def uncontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark window, with all their columns."""
    bad = hits(docs, index(benchmark, window, gram)).select("doc_id", "text_key").distinct()
    bad = bad.select(F.col("doc_id").alias("bad_id"), F.col("text_key").alias("bad_key"))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id").cast("long").alias("id"),
        F.xxhash64(F.col("text").cast("string")).alias("key"),
    )
    return rows.join(
        bad, F.col("id").eqNullSafe(F.col("bad_id")) & (F.col("key") == F.col("bad_key")), "left_anti"
    ).select("row.*")


def item_digest(marked: DataFrame) -> DataFrame:
    return marked.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )
