"""Fill-in-middle, toxicity and importance resampling against plain Python."""

import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from tableaudit.llm import importance, infill, toxicity
from tableaudit.llm.common import table
from test_operators import CLASH, ODD, SHAPE, words

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
MORE = [
    *ODD,
    (20, " a  b<P>c ", "en", "a", 1),
    (21, "<S><M>", "en", "a", 1),
    (22, "<P", "en", "a", 1),
    (23, "\x85\xa0 x y\x1cz  \n", "en", "a", 1),
    *[(100 + i, f" été {'<M' * (i % 3)} \U0001f600x{'y' * i}  z\n" * (i % 5 + 1) + " " * (i % 2), "en", "a", 1) for i in range(60)],
]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def numbers(seed, doc_id):
    digest = sha(f"{seed}:{'' if doc_id is None else doc_id}")
    return [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]


def brute_infill(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    h1, h2, h3, h4 = numbers(42, doc_id)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(u) for u in (units[:low], units[low:high], units[high:]))
    form = "spm" if h4 % 100 < 80 else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, n, form, len(p), len(m), sha(out), sha(text)


def sorted_rows(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.fixture(scope="module")
def more(spark):
    return spark.createDataFrame(MORE, SHAPE)


@pytest.mark.parametrize("size", [1, 5, 64, 1000, 1 << 20])
def test_infill_at_every_frame_size(more, size):
    few = more.where("n_chars = 1 and doc_id <> 6 or doc_id in (2, 3, 7, 8) or doc_id is null")
    expected = sorted_rows(brute_infill(i, t) for i, t in ((r["doc_id"], r["text"]) for r in few.collect()))
    got = infill.infill_digest(infill.infill(infill.store(few, frame_bytes=size)))
    assert sorted_rows(got.collect()) == expected


def test_infill_of_odd_and_long_texts(more):
    got = infill.infill_digest(infill.fill_in_middle(more))
    assert sorted_rows(got.collect()) == sorted_rows(brute_infill(i, t) for i, t, *_ in MORE)
    assert {r["form"] for r in got.collect()} == {"plain", "psm", "spm"}


def test_frames_are_read_alone_and_move_unchanged():
    raw = ("Ärger " * 5000 + " ").encode()
    pack = zstandard.ZstdCompressor().compress
    n, frames = infill.framed(raw, 1000, pack)
    reader = zstandard.ZstdDecompressor()
    assert n == 5001 and b"".join(infill.stream([f["data"] for f in frames], reader)) == raw
    asked = []

    class Counting:
        def decompress(self, data):
            asked.append(data)
            return reader.decompress(data)

    text = infill._Text(frames, n, Counting(), zstandard.ZstdCompressor())
    at, byte, chars = text.cut(2500)
    assert len(asked) == 1 and chars == 6 * 2499 + 5
    before = text.part((0, 0), (at, byte))
    assert before[:at] == [f["data"] for f in frames[:at]]
    assert len(b"".join(infill.stream(before, reader)).decode()) == chars
    assert text.cut(n)[:2] == (len(frames) - 1, len(reader.decompress(frames[-1]["data"])))


def test_infill_output_texts(more):
    out = infill.infill(infill.store(more))
    for r in infill.output_texts(out).where("form <> 'plain'").collect():
        p, s = r["text"].index("<P>"), r["text"].index("<S>")
        assert (p < s) == (r["form"] == "psm")


def test_empty_tables_and_clashing_columns(spark, more):
    none = more.limit(0)
    labels = spark.createDataFrame([(3, 1), (4, 0), (7, 0)], "doc_id long, toxic int")
    assert infill.infill_digest(infill.fill_in_middle(none)).count() == 0
    assert toxicity.toxicity(none, labels).count() == 0
    assert importance.resample(none, none).count() == 0
    wide = more
    for name in [*CLASH, "n", "form", "frames", "toxic", "fold", "stem", "rank", "tie", "n_words", "clauses"]:
        if name not in wide.columns:
            wide = wide.withColumn(name, F.lit(1))
    assert sorted_rows(infill.infill_digest(infill.fill_in_middle(wide)).collect()) == sorted_rows(
        brute_infill(i, t) for i, t, *_ in MORE
    )
    assert toxicity.toxicity(wide, labels.limit(0)).count() == len(MORE)
    assert toxicity.toxicity(wide, labels).count() == len(MORE)
    assert sorted_rows(importance.resample(wide, wide).collect()) == sorted_rows(importance.resample(more, more).collect())


# --------------------------------------------------------------------- importance


def features(text):
    w = [x.encode() for x in words(text)]
    return w + [a + b" " + b for a, b in zip(w, w[1:], strict=False)]


def brute_importance(docs, target):
    """(doc_id, n_features, weight, score, rank); ties of one id are left to the caller."""
    source, wanted = Counter(), Counter()
    for _, text in docs:
        source.update(crc32(f) % 10000 for f in features(text))
    for text in target:
        wanted.update(crc32(f) % 10000 for f in features(text))
    big_s, big_t = sum(source.values()), sum(wanted.values())
    gain = {
        b: math.floor(1000 * math.log((wanted[b] + 1.0) * (big_s + 10000.0) / ((source[b] + 1.0) * (big_t + 10000.0))))
        for b in range(10000)
    }
    rows = []
    for doc_id, text in docs:
        f = features(text)
        weight = sum(gain[crc32(x) % 10000] for x in f) // len(f) if f else 0
        h = numbers(7, doc_id)[0]
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(f), weight, score, None, len(words(text))])
    able = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, r in enumerate(able[: 25 * len(able) // 100]):
        r[4] = i + 1
    return [tuple(r[:5]) for r in rows]


def digest(df):
    return df.select("doc_id", "n_features", "weight", "score", "rank")


@pytest.mark.parametrize("sizes", [(4096, 65536), (3, 2), (0, 0)])
def test_importance_equals_brute_force_with_any_head(spark, sf, sizes):
    docs, target = table(spark, sf, "documents"), table(spark, sf, "benchmark")
    head = importance.learn_head(docs, *sizes)
    assert len(head.words) <= sizes[0] and len(head.pair_keys) <= sizes[1]
    expected = brute_importance([(r["doc_id"], r["text"]) for r in docs.collect()], [r["text"] for r in target.collect()])
    assert sorted_rows(digest(importance.resample(docs, target, head=head)).collect()) == sorted_rows(expected)


def test_importance_of_odd_texts(spark, more):
    target = spark.createDataFrame([("word x été",), (None,), ("",)], "text string")
    got = digest(importance.resample(more, target))
    assert sorted_rows(got.collect()) == sorted_rows(brute_importance([(i, t) for i, t, *_ in MORE], ["word x été", None, ""]))


def test_crc_of_joined_bytes():
    shifts, rng = importance._zero_shifts(64), np.random.default_rng(1)
    for n in range(65):
        a, b = rng.bytes(int(rng.integers(0, 40))), rng.bytes(n)
        got = importance.joined_crc(np.array([crc32(a)], np.uint32), np.array([crc32(b)], np.uint32), np.array([n]), shifts)
        assert int(got[0]) == crc32(a + b)


def test_long_words_and_small_groups(spark, monkeypatch):
    rows = [(i, f"{'a' * (60 + i)} {'b' * (60 + i)} x " * 8) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted_rows(digest(importance.resample(docs, docs)).collect()) == sorted_rows(brute_importance(rows, [t for _, t in rows]))


def test_ranks_run_through_all_ranges(spark):
    rows = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 7).alias("score"), F.col("id").alias("tie"))
    order = [F.desc("score"), F.asc("doc_id"), F.asc("tie")]
    got = importance.ranked(rows.repartition(9), order, 4000).collect()
    expected = sorted(((i % 7, i) for i in range(5000)), key=lambda r: (-r[0], r[1]))
    ranks = {r["doc_id"]: r["rank"] for r in got}
    assert [ranks[i] for _, i in expected] == [*range(1, 4001), *[None] * 1000]


def test_frequent_features_are_found(spark):
    docs = spark.createDataFrame([(i, f"the cat w{i} v{i} the cat") for i in range(3000)], "doc_id long, text string")
    found = {bytes(r["feature"]): r["n"] for r in importance.frequent_features(docs, counters=64).collect()}
    assert 0 < found[b"the"] <= 6000 and 0 < found[b"the cat"] <= 6000 and found[b""] == 18000


# ----------------------------------------------------------------------- toxicity


def clause_score(text, lexicon=None):
    lexicon = lexicon or toxicity.learn_lexicon({}, 0, 0)
    return sum(c[2] for c in toxicity.clauses(text, lexicon))


def test_grammar_scores_clauses():
    plain = clause_score("what an idiot, really")
    assert plain == 1.0
    assert clause_score("you are an idiot") > plain
    assert clause_score("idiot, you") > plain
    assert clause_score("he is not an idiot") < plain
    assert clause_score("she said the man was an idiot") < plain
    assert clause_score("she said so. what an idiot") == plain
    assert clause_score("not now, idiot") == plain
    assert clause_score("the idiot. the moron") == 2 * plain
    assert clause_score("we will kill the process") == clause_score("i will hurt someone") > 0
    assert clause_score("kill the process") == 0 < clause_score("kill you")
    assert clause_score("i will not kill you") < clause_score("i will kill you")
    assert clause_score("idiotic idiots are absent") == 0


def test_composed_machine_equals_the_row_of_machines():
    rng = np.random.default_rng(3)
    table_, machines = toxicity.machine(), toxicity.grammar()
    for _ in range(300):
        states, at = [m.start for m in machines], 0
        for kind in rng.integers(0, 8, 30).tolist():
            symbol = (kind, frozenset())
            for i, m in enumerate(machines):
                states[i], symbol = m.step(states[i], symbol)
            at, out = table_[at][kind]
            assert out == symbol


def test_lexicon_learns_stems():
    counts = {
        "low": (40, 0), "lowe": (40, 0), "lowei": (12, 0), "lowein ": (9, 0), "the": (50, 100), "rare": (3, 0),
        "idiot ": (1, 60), "los": (45, 90), "loser ": (20, 0), "lose": (20, 4),
    }
    got = toxicity.learn_lexicon(counts, 50, 100)
    # Of two stems of the same texts the longer, nothing below a kept one, and no short one that only holds a kept one.
    assert {"lowe", "loser ", "moron "} <= set(got.stems)
    assert not {"low", "lowei", "lowein ", "the", "rare", "idiot ", "los", "lose"} & set(got.stems)
    assert got.weight("loweich") > 0 and got.weight("los") == got.weight("lo") == 0


def test_scores_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    got = toxicity.toxicity(docs, labels)
    toxic = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    rows = [r for r in got.collect() if r["doc_id"] in toxic]
    assert all(r["held_out"] == (crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"]]
    hit = sum(r["predicted"] and toxic[r["doc_id"]] for r in held)
    wrong = sum(r["predicted"] and not toxic[r["doc_id"]] for r in held)
    total = sum(toxic[r["doc_id"]] for r in held)
    assert hit >= 0.9 * total and wrong <= 0.02 * (len(held) - total)


def test_held_out_labels_are_not_learned_from(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    flipped = labels.withColumn(
        "toxic", F.when(toxicity.id_remainder(F.col("doc_id"), 4) == 2, 1 - F.col("toxic")).otherwise(F.col("toxic"))
    ).withColumn("quality", F.lit(0))
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("s"))
    assert sorted_rows(toxicity.toxicity(docs, labels).collect()) == sorted_rows(toxicity.toxicity(other, flipped).collect())


def test_odd_labels_and_texts(spark, more):
    labels = spark.createDataFrame(
        [(3, 1), (3, 0), (4, 0), (None, 1), (5, None), (6, 7), (999, 1), (8, 0), (2, 0)], "doc_id long, toxic int"
    )
    rows = toxicity.toxicity(more, labels).collect()
    assert len(rows) == len(MORE) and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (2, 8)}) == 1


def test_a_bounded_number_of_training_rows(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(500)], "doc_id long, toxic int")
    ids, sizes = toxicity.training_ids(labels, 20)
    assert sizes == {0: 250, 1: 250} and ids.groupBy("toxic").count().select("count").distinct().collect() == [(20,)]
