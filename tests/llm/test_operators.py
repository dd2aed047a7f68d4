"""Operators of the llm package against plain Python, on small fixtures."""

import hashlib
import re
import tracemalloc
from collections import defaultdict
from pathlib import Path
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from tableaudit.llm import (
    decontam, exactdedup, langid, licenses, linededup, mixing, neardedup, pii, queries, sharding, tokens,
)
from tableaudit.llm.common import staged, table
from tableaudit.llm.components import connected
from tableaudit.session import shared_folder

SHAPE = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "word " * 30000
ODD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, "The MIT License. Mail a.b@c.de or call +1 (017) 555-7713 from 10.0.0.1", "en", "a", 10),
    (3, "The MIT License. Mail a.b@c.de or call +1 (017) 555-7713 from 10.0.0.1", "en", "a", 10),
    (None, "one two three four five six seven", None, "b", 7),
    (None, None, "fr", None, 7),
    (4, LONG, "en", "b", len(LONG)),
    (5, LONG.upper(), "fr", "b", len(LONG)),
    (6, "x" * 50000 + " " + "9" * 20000 + " " + "1." * 20000 + " " + "+1" * 9999, "en", "c", 1),
    (7, "Été İſ \U0001f600\nl'été x\x00y\x1cz", "fr", "c", 2),
    (8, "   \n\t ", "fr", "d", 2),
]


def low(text):
    return (text or "").encode().lower().decode()


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", low(text))


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, SHAPE)


@pytest.fixture(scope="session")
def docs(spark, sf):
    return table(spark, sf, "documents")


@pytest.fixture(scope="session")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}


CLASH = [
    "size", "row", "mixed", "shard", "target", "copies", "words", "key", "h", "n", "kept", "component", "text_key", "id",
    "raw_key", "place", "bytes", "source_size", "window", "print", "block", "score", "lang_pred", "second", "cell0",
]


def apply_all(frame, benchmark):
    """Each operator's rows over a frame, as (name, rows, keeps all columns)."""
    model = langid.train([("en", ["the", "and", "word"]), ("fr", ["le", "une", "été"])])
    yield "licenses", licenses.license_digest(licenses.scan_licenses(frame)), False
    yield "mix", mixing.mix_digest(frame), False
    yield "mix rows", mixing.mix(frame).select("row.*"), True
    yield "pii", pii.span_digest(pii.personal_data(frame)), False
    yield "lines", linededup.line_digest(linededup.dedup_lines(frame)), False
    yield "near", neardedup.near_duplicates(frame), False
    yield "exact", exactdedup.exact_duplicates(frame), False
    yield "languages", langid.identify(frame), False
    yield "languages, carried", langid.languages(frame, model, carry=True).select("row.*"), True
    yield "tokens", tokens.token_digest(frame, queries.tokenizer_path()), False
    yield "decontaminate", decontam.item_digest(decontam.decontaminate(frame, benchmark)), False
    yield "shards", sharding.shards(frame).select("row.*"), True


def test_odd_rows_give_one_result_each(spark, odd):
    bench = spark.createDataFrame([(1, "one two three"), (None, "mit license"), (2, None), (3, "")], "item_id long, text string")
    wide = odd.select("*", *[F.lit("x").alias(c) for c in CLASH])
    ids = sorted(str(r[0]) for r in ODD)
    for name, found, keeps in apply_all(wide, bench):
        rows = found.collect()
        assert sorted(str(r["doc_id"]) for r in rows) == ids, name
        if keeps:
            assert found.columns == wide.columns, name


def test_empty_tables(spark, odd):
    bench = spark.createDataFrame([], "item_id long, text string")
    for name, found, _ in apply_all(odd.limit(0), bench):
        assert found.collect() == [], name
    marked = decontam.decontaminate(odd, bench).collect()
    assert len(marked) == len(ODD) and not any(r["contaminated"] for r in marked)
    assert neardedup.one_of_each(odd.limit(0)).collect() == []


def test_stages_keep_columns_and_one_of_each(spark, odd):
    wide = odd.select("*", *[F.lit("x").alias(c) for c in CLASH])
    kept = neardedup.one_of_each(wide)
    assert kept.columns == wide.columns
    # The repeated row once, one of the two long texts, every text without words.
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["1", "2", "3", "None", "None", "4", "6", "7", "8"])
    bench = spark.createDataFrame([(1, "the mit license mail")], "item_id long, text string")
    clean = decontam.uncontaminated(wide, bench)
    assert clean.columns == wide.columns
    assert sorted(str(r["doc_id"]) for r in clean.collect()) == sorted(str(r[0]) for r in ODD if r[0] != 3)


def test_components(spark):
    pairs = [(1, 2), (2, 3), (9, 3), (5, 5), (7, 8), (20, 30)] + [(100 + i, 101 + i) for i in range(60)] + [(6, 100)]
    found = {r["node"]: r["root"] for r in connected(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 9: 1, 5: 5, 7: 7, 8: 7, 20: 20, 30: 20, 6: 6} | {100 + i: 6 for i in range(61)}


# 1 ---------------------------------------------------------------------------


def test_license_places(docs, texts):
    found = {r["doc_id"]: r for r in licenses.license_digest(licenses.scan_licenses(docs)).collect()}
    for doc_id, text in texts.items():
        w, row = words(text), found[doc_id]
        places, labels = [], set()
        for phrase, label in licenses.BASE.items():
            p = phrase.split()
            hit = [i for i in range(len(w)) if w[i : i + len(p)] == p]
            places += hit
            labels |= {label} if hit else set()
        assert (row["n_words"], row["n_base"], row["base_labels"]) == (len(w), len(places), ",".join(sorted(labels)))
        assert (row["first_word"], row["last_word"]) == ((min(places), max(places)) if places else (None, None))
        assert labels <= set(row["labels"].split(",")) and 0 <= row["score"] <= 1


def test_license_notices_cut_after_each_word(spark):
    for template in licenses.TEMPLATES:
        # Whatever words are the rarest: all equal, and each word of the template rarest in turn.
        for rare in ({}, *({w: -1 for w in template.words[i : i + 5]} for i in range(len(template.words)))):
            index = licenses.build_index((template,), {b"": 10, **{w: 5 for w in template.words}, **{w: 0 for w in rare}})
            for n in range(len(template.words) + 1):
                for cut in (template.words[:n], template.words[n:]):
                    found = licenses.scan_words(list(cut), index, 0.8)
                    whole = all(0 <= at < n for at in template.mandatory) if cut == template.words[:n] else n <= template.mandatory[0]
                    assert not found or whole
    rows = [(i, " ".join(w.decode() for w in licenses.TEMPLATES[3].words[:i])) for i in range(28)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert licenses.license_digest(licenses.scan_licenses(frame)).count() == 28


def test_license_notice_with_changed_words(spark):
    mit = licenses.NOTICES[0][1].split()
    mit[15] = "thing"
    rows = [(1, "x " + " ".join(mit)), (2, "permission is hereby granted"), (3, "GNU General Public License, GPL general public license")]
    found = {r["doc_id"]: r for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [(h["label"], h["start"]) for h in found[1]["hits"]] == [("mit", 1)] and 0.9 < found[1]["hits"][0]["share"] < 1
    assert found[2]["hits"] == []
    assert [(h["label"], h["start"]) for h in found[3]["hits"]] == [("gpl", 1), ("gpl", 5)]


# 2 ---------------------------------------------------------------------------


def test_mix_targets_and_quotas(spark):
    rows = [(i, "a b c d e", s) for s, n in (("a", 40), ("b", 900), ("c", 300), (None, 7)) for i in range(n)]
    rows = [(k, t, s) for k, (_, t, s) in enumerate(rows)] + [(5000, None, "d"), (5001, "", "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix(docs, block_words=50, shards=5)
    found = mixed.select("row.*", "size", "source_size", "target", "copies", "shards").collect()
    sizes = defaultdict(int)
    for r in found:
        sizes[r["source"]] += r["size"]
    # Water filling by rounds: share by weight, stop at three times the size, share the rest again.
    order = ["a", "b", "c", "d", None]
    weight = dict(zip(order, (5, 2, 1, 5, 2), strict=True))
    target, total = {}, sum(sizes.values())
    while True:
        open_ = [s for s in order if s not in target]
        level = (total - sum(target.values())) / sum(weight[s] for s in open_)
        over = [s for s in open_ if weight[s] * level > 3 * sizes[s]]
        if not over:
            target |= {s: weight[s] * level for s in open_}
            break
        target |= {s: 3.0 * sizes[s] for s in over}
    taken = defaultdict(int)
    by_shard = defaultdict(int)
    for r in found:
        assert r["target"] == pytest.approx(target[r["source"]]) and r["copies"] <= 3
        assert len(r["shards"]) == r["copies"]
        taken[r["source"]] += r["size"] * r["copies"]
        for at in r["shards"]:
            assert 0 <= at["shard"] < 5
            by_shard[at["shard"]] += 1
    for s in order:
        assert abs(taken[s] - target[s]) <= 5
    assert max(by_shard.values()) < 1.6 * min(by_shard.values())
    again = mixing.mix(docs, block_words=50, shards=5).select("row.*", "copies", "shards").collect()
    assert sorted(map(str, again)) == sorted(
        map(str, mixed.select("row.*", "copies", "shards").collect())
    )
    assert mixing.mixed_rows(mixed).count() == sum(r["copies"] for r in found)


def test_quotas_are_exact_and_hypergeometric(spark):
    quotas = [("a", 400), ("b", 100), ("c", 3), ("d", 0)]
    lefts = []
    for seed in range(30):
        frame = spark.createDataFrame(quotas, "source string, quota long").coalesce(1)
        runs = mixing.split_quotas(frame, 2, f"s{seed}").collect()
        by = defaultdict(dict)
        for r in runs:
            by[r["source"]][r["shard"]] = (r["first"], r["last"])
        for s, n in quotas:
            assert by[s][0][0] == 0 and by[s][0][1] == by[s][1][0] and by[s][1][1] == n
        assert abs(sum(by[s][0][1] for s, _ in quotas) - 251.5) < 1
        lefts.append(by["b"][0][1])
    # Mean 50, standard deviation 4.5 for one draw.
    assert abs(np.mean(lefts) - 50) < 4 and 2 < np.std(lefts) < 8


# 3 ---------------------------------------------------------------------------


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text):
    def digits(m):
        return re.sub("[^0-9]", "", m)

    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
    ]
    out = []
    for k, (kind, pattern, good) in enumerate(kinds):
        out += [(m.start(), k, kind, m.end()) for m in re.finditer(pattern, text or "") if good(m[0])]
    return [f"{kind}:{start}:{end}" for start, _, kind, end in sorted(out)]


TRICKY = [
    "a@b.c@d.e a@b.c_d@e.f x..@y.z-.w @b.c a@b", "1.2.3.4.5.6.7.8 256.1.1.1 000255.1.1.1 1.2.3 999999999999.1.1.1 01.02.03.04",
    "4111 1111 1111 1111 4111-1111-1111-1112 4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1  4111111111111111",
    "+1 (017) 555-7713 +12345678 +1 2 3 4 5 6 7 8 9) + 1 ++49 30 1234567. \U0001f600 +49 30 1234567",
    "éa@b.de \U0001f600\U0001f600 a@b.de\na@b.de", "GB82 WEST 1234 5698 7654 32 and GB82WEST12345698765433 bank DE89370400440532013000",
    "ssn 123-45-6789 000-12-3456",
]


def test_spans_match_plain_regex(spark, docs, texts):
    extra = spark.createDataFrame(list(enumerate(TRICKY, 100000)), "doc_id long, text string")
    found = {
        r["doc_id"]: r
        for r in pii.span_digest(pii.personal_data(docs.select("doc_id", "text").union(extra))).collect()
    }
    for doc_id, text in (texts | dict(enumerate(TRICKY, 100000))).items():
        wanted, row = base_spans(text), found[doc_id]
        assert row["base_sha256"] == hashlib.sha256(",".join(wanted).encode()).hexdigest(), (text[:80], row, wanted)
        assert set(wanted) <= set(row["spans"].split(",")) | {""}
        assert row["n_email"] == sum(w.startswith("email") for w in wanted)
    assert found[100005]["spans"] == "iban:0:27,iban:68:90" or "iban" in found[100005]["spans"]
    assert [s for s in found[100006]["spans"].split(",") if s.startswith("ssn")] == ["ssn:4:15"]


def test_context_raises_the_score(spark):
    rows = [(1, "visa card 4111111111111111"), (2, "number 4111111111111111")]
    found = {r["doc_id"]: r["spans"] for r in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[1][0]["score"] > found[2][0]["score"]


# 4 ---------------------------------------------------------------------------


def test_lines_match_brute_force(spark, docs):
    some = docs.where("doc_id % 4 = 0").select("doc_id", "text")
    base = "Call our office in the main street on weekdays between nine and five for all other questions about it"
    planted = [(900000 + i, base.replace("weekdays", f"weekday{i}") + "\n\nunique line number %d of this text" % (i * i * 7919)) for i in range(12)]
    frame = some.union(spark.createDataFrame(planted, "doc_id long, text string"))
    rows = sorted((r["doc_id"], r["text"]) for r in frame.collect())

    def normal(line):
        return low(re.sub(r"[ \t\r]+", " ", line).strip(" "))

    def grams(line):
        return {line[i : i + 7] for i in range(len(line) - 6)} if len(line) >= 7 else {line}

    places = [(d, i, normal(x)) for d, t in rows for i, x in enumerate((t or "").split("\n")) if normal(x)]
    distinct = sorted({x for _, _, x in places})
    sets, owners = [grams(x) for x in distinct], defaultdict(list)
    root = list(range(len(distinct)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in enumerate(sets):
        shared = defaultdict(int)
        for g in s:
            for j in owners[g]:
                shared[j] += 1
            owners[g].append(i)
        for j, n in shared.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                root[find(i)] = find(j)
    seen, dropped = set(), defaultdict(int)
    number = {x: i for i, x in enumerate(distinct)}
    for d, _, x in places:
        group = find(number[x])
        dropped[d] += group in seen
        seen.add(group)
    found = {r["doc_id"]: r["n_dropped"] for r in linededup.dedup_lines(frame).collect()}
    assert found == {d: dropped[d] for d, _ in rows}
    assert sum(found[900000 + i] for i in range(12)) == 11


def grams(line):
    return {line[i : i + 7] for i in range(len(line) - 6)} or {line}


def alike(a, b, percent=80):
    shared = len(grams(a) & grams(b))
    return 100 * shared >= percent * (len(grams(a)) + len(grams(b)) - shared)


def line_roots(lines):
    root = {x: x for x in lines}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(lines):
        for b in lines[:i]:
            if find(a) != find(b) and alike(a, b):
                root[find(a)] = find(b)
    groups = defaultdict(set)
    for x in lines:
        groups[find(x)].add(x)
    return {frozenset(g) for g in groups.values() if len(g) > 1}


def found_groups(spark, lines, **options):
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id long, text string")
    names = {hashlib.md5(x.encode()).digest(): x for x in lines}
    groups = defaultdict(set)
    for r in linededup.line_groups(docs, **options).collect():
        groups[r["root"]].add(names[bytes(r["node"])])
    return {frozenset(g) for g in groups.values()}


def changed(rng, line, n):
    at = list(line)
    for i in rng.choice(len(at), n, replace=False):
        at[i] = chr(97 + int(rng.integers(26)))
    return "".join(at)


@pytest.mark.parametrize("part_lines", [2000, 7])
def test_chains_and_families_of_lines_lose_no_link(spark, part_lines):
    rng = np.random.default_rng(8)
    base = "".join(chr(97 + int(c)) for c in rng.integers(0, 26, 120))
    chain = [base]
    for _ in range(40):  # each is like the one before, and the ends are not alike
        chain.append(changed(rng, chain[-1], 1))
    family = [f"order {i * 7919 % 1000:03d} was placed by customer {i} and shipped within the next two working days" for i in range(60)]
    apart = ["".join(chr(97 + int(c)) for c in rng.integers(0, 26, 80)) for _ in range(40)]
    short = ["abc", "abd", "é", "ab", "abcdefg", "abcdefgh"]
    lines = sorted({*chain, *family, *apart, *short})
    assert found_groups(spark, lines, part_lines=part_lines) == line_roots(lines)


def test_small_and_large_groups_are_searched_alike():
    rng = np.random.default_rng(9)
    base = "".join(chr(97 + int(c)) for c in rng.integers(0, 26, 100))
    lines = [changed(rng, base, int(k)) for k in rng.integers(0, 6, 60)] + ["x", "xy", "été" * 30]
    parts = lambda roots: {frozenset(i for i, r in enumerate(roots) if r == q) for q in roots}
    large = parts(linededup.line_components(lines, 7, 80))
    kept, linededup._ARRAYS = linededup._ARRAYS, 10**9
    try:
        assert parts(linededup.line_components(lines, 7, 80)) == large
    finally:
        linededup._ARRAYS = kept


def test_recall_of_line_bands():
    rng = np.random.default_rng(10)
    for low, high, least in ((0.8, 0.85, 0.998), (0.9, 1.0, 1.0)):
        pairs = []
        while len(pairs) < 1500:
            a = "".join(chr(97 + int(c)) for c in rng.integers(0, 26, int(rng.integers(60, 160))))
            b = changed(rng, a, int(rng.integers(1, 4)))
            shared = len(grams(a) & grams(b))
            if low <= shared / (len(grams(a)) + len(grams(b)) - shared) <= high:
                pairs.append((a, b))
        one = linededup.band_keys([a for a, _ in pairs], 7, 16, 4)
        two = linededup.band_keys([b for _, b in pairs], 7, 16, 4)
        assert (one == two).any(axis=1).mean() >= least


def test_normal_lines_and_signatures_of_odd_lines():
    assert linededup.normal_line("\t A  B\r\r c\x0b É \r".encode()) == "a b c\x0b É".encode()
    assert linededup.normal_line(b" \t\r ") == b""
    keys = linededup.band_keys(["", "a", "ab", "x" * 7, "x" * 5000, "\U0001f600" * 8, "a\x00b"], 7, 16, 4)
    assert keys.shape == (7, 16) and (keys[3] == keys[4]).all() and len({tuple(k) for k in keys.tolist()}) == 6


def test_staged_rows_leave_no_shuffle_files(spark):
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()

    def files():
        return {str(f) for top in env.blockManager().diskBlockManager().localDirsString() for f in Path(top).rglob("shuffle_*.data")}

    key, before = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", files()
    setting = spark.conf.get(key, None)
    rows = staged(spark.range(5000).repartition(3, "id").groupBy((F.col("id") % 1000).alias("k")).count(), "test")
    assert not files() - before
    assert spark.conf.get(key, None) == setting
    assert rows.agg(F.count("k"), F.sum("count")).first()[:] == (1000, 5000)


def test_texts_of_lines_do_not_stay(spark):
    top = Path(shared_folder(spark, "lines").removeprefix("file://")).parent
    before = {p.name for p in top.glob("*")}
    docs = spark.createDataFrame([(1, "a line of some length\nother words"), (2, "a line of some length!")], "doc_id long, text string")
    assert sum(r["n_dropped"] for r in linededup.dedup_lines(docs).collect()) == 1
    new = [p.name for p in top.glob("*") if p.name not in before]
    assert [n for n in new if n.startswith("line-groups-")]
    assert not [n for n in new if n.startswith(("lines-", "line-entries-"))]


def test_pairs_of_lines_as_on_sets():
    random = np.random.default_rng(3)
    pairs = []
    for size in [1, 3, 7, 8, 12, 40, 200] * 9:
        a = "".join(random.choice(list("ab é\U0001f600"), size))
        b = "".join(c if random.random() > 0.03 else "z" for c in a)
        pairs.append((a, b))
    want = []
    for a, b in pairs:
        x, y = linededup.shingles(a, 7), linededup.shingles(b, 7)
        want.append(100 * len(x & y) >= 80 * len(x | y))
    assert linededup.similar_pairs(pairs, 7, 80) == want and {True, False} == set(want)


def test_small_groups_of_lines_are_compared_together(monkeypatch):
    rng = np.random.default_rng(4)
    groups = []
    for size in [2, 3, 4, 5, 9, 15] * 5:
        base = "".join(rng.choice(list("ab \u00e9\U0001f600cdefgh"), int(rng.integers(1, 150))))
        chain = [base]
        while len(chain) < size:
            chain.append(changed(rng, chain[-1], min(len(base), int(rng.integers(0, 4)))) if rng.random() < 0.8 else f"{len(chain)} {base[::-1]}")
        groups.append(chain)
    want = [linededup.line_components(g, 7, 80) for g in groups]
    assert linededup.group_components(groups, 7, 80) == want
    assert {True, False} == {any(r not in (0, i) for i, r in enumerate(roots)) for roots in want}
    # Groups that are clearly alike or apart need no sets of shingles.
    x, y = ("".join(chr(97 + int(c)) for c in rng.integers(0, 26, 300)) for _ in range(2))
    monkeypatch.setattr(linededup, "shingles", None)
    assert linededup.group_components([[x, x[:-1], y], [y, x, y[1:]]], 7, 80) == [[0, 0, 2], [0, 1, 0]]


def test_hashes_of_shingles_do_not_depend_on_what_is_hashed_with_them():
    lines = ["", "a", "ab", "x" * 7, "abcdefgh", "\U0001f600" * 8, "x" * 300000, "a\x00b", "abcdefgh"]
    owner, hashes = linededup.shingle_hashes(lines, 7)
    assert linededup.shingle_hashes([], 7)[1].shape == (0,)
    for i, line in enumerate(lines):
        alone = linededup.shingle_hashes([line], 7)[1]
        assert len(alone) == max(len(line) - 6, 1) and (hashes[owner == i] == alone).all()
        assert len(set(alone.tolist())) == len(linededup.shingles(line, 7))


# 5 ---------------------------------------------------------------------------


def brute_components(texts, percent=85):
    sets = {}
    for d, t in texts.items():
        w = split(t)
        sets[d] = {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if w else set()
    owners, root = defaultdict(list), {d: d for d in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for d in sorted(sets):
        shared = defaultdict(int)
        for g in sets[d]:
            for j in owners[g]:
                shared[j] += 1
            owners[g].append(d)
        for j, n in shared.items():
            if 100 * n >= percent * (len(sets[d]) + len(sets[j]) - n):
                a, b = sorted((find(d), find(j)))
                root[b] = a
    return {d: (len(s), find(d)) for d, s in sets.items()}


def chained(n=60):
    """Texts of which neighbours are alike and ends are not."""
    w = [f"w{i}" for i in range(400)]
    out = {}
    for i in range(n):
        out[10_000 + i] = " ".join(w)
        for k in range(4):
            w[(i * 29 + k * 97) % 400] = f"v{i}x{k}"
    return out


@pytest.mark.parametrize("limit", [neardedup.TASK_SHINGLES, 2000])
def test_near_duplicates_match_brute_force(spark, texts, limit):
    some = texts | chained()
    frame = spark.createDataFrame(list(some.items()), "doc_id long, text string")
    found = neardedup.near_duplicates(frame, task_shingles=limit).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute_components(some)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


# 6 ---------------------------------------------------------------------------


def test_trie_finds_each_text_again():
    trie, random = exactdedup.RadixTrie(), np.random.default_rng(3)
    pool = [bytes(random.integers(97, 99, random.integers(0, 12)).astype(np.uint8)) for _ in range(400)]
    ends = {}
    for i, t in enumerate(pool):
        end = trie.insert(t, lambda t=t, i=i: exactdedup.Terminal(i, t))
        end.add(i, i)
        assert end.text == t and ends.setdefault(t, end) is end
    assert len(trie.terminals()) == len(set(pool))
    gone = trie.cut_largest()
    assert gone and len(gone) + len(trie.terminals()) == len(set(pool))


@pytest.mark.parametrize("memory", [64 << 20, 200])
def test_exact_duplicates_with_and_without_spill(spark, docs, texts, memory):
    extra = [(10**6 + i, "Same TEXT" if i % 3 else "same text") for i in range(200)] + [(10**6, "same text"), (None, "same Text")]
    frame = docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    groups = defaultdict(list)
    for d, t in [*texts.items(), *extra]:
        groups[low(t)].append(d)
    found = exactdedup.exact_duplicates(frame, "largest", memory, 50).collect()
    assert len(found) == len(texts) + len(extra)
    keep = {hashlib.sha256(t.encode()).hexdigest(): (max(d for d in ids if d is not None), len(ids)) for t, ids in groups.items()}
    assert all((r["keep_id"], r["group_size"]) == keep[r["text_sha256"]] for r in found)
    kept = [r["keep_id"] for r in found if r["kept"]]
    assert sorted(kept) == sorted(k for k, _ in keep.values())
    assert all(r["doc_id"] == r["keep_id"] for r in found if r["kept"])


# 7 ---------------------------------------------------------------------------


def test_held_out_accuracy(spark, sf):
    docs = table(spark, sf, "documents")
    found = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r["held_out"] == (crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in found)
    test = [r for r in found if r["held_out"] and r["lang_pred"] != "und"]
    assert np.mean([r["lang"] == r["lang_pred"] for r in test]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in found)


def test_forward_backward_is_exact():
    random = np.random.default_rng(5)
    emissions, transitions = random.normal(size=(9, 3)), random.normal(size=(3, 3))
    lengths = np.array([5, 3, 1])
    starts = np.array([0, 5, 8])
    marginals = langid.forward_backward(emissions, starts, lengths, transitions)[0]
    for at, n in zip(starts, lengths, strict=True):
        total = np.zeros((n, 3))
        for path in np.ndindex(*[3] * n):
            score = sum(emissions[at + t, k] for t, k in enumerate(path)) + sum(transitions[a, b] for a, b in zip(path, path[1:]))
            for t, k in enumerate(path):
                total[t, k] += np.exp(score)
        assert np.allclose(marginals[at : at + n], total / total.sum(axis=1, keepdims=True))


def test_switched_words_get_their_own_language():
    rows = [("en", ["the", "thing", "with", "that"] * 30), ("fr", ["létat", "été", "quoi", "eaux"] * 30)]
    model = langid.train(rows * 4)
    w = ["the", "thing"] * 8 + ["quoi", "été"] * 8
    scores = np.stack([model.scores(x) for x in w])
    marginals = langid.forward_backward(scores, np.array([0]), np.array([len(w)]), model.transitions)[0]
    assert [model.languages[k] for k in marginals.argmax(axis=1)] == ["en"] * 16 + ["fr"] * 16
    assert model.transitions[0, 0] > model.transitions[0, 1]


def test_texts_are_tagged_in_little_memory():
    model = langid.train([("en", ["the", "thing", "with"] * 30), ("fr", ["le", "une", "quoi"] * 30)])
    texts = [[("the", "quoi", "with", "une")[(i + k) % 4] for k in range(i % 50 * 20)] for i in range(2048)]
    one = langid.Tagger(model)
    alone = np.concatenate([one.shares([t]) for t in texts[:60]])
    assert not alone[0].any() and np.allclose(alone[1:50].sum(axis=1), 1)
    tagger = langid.Tagger(model)
    tagger.shares([["the"]])
    tracemalloc.start()
    try:
        found = tagger.shares(iter(texts))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    # One million words of two languages: 8 MB of scores, and several arrays of that size at once before.
    assert sum(map(len, texts)) > 1_000_000 and peak < 32 << 20
    assert np.allclose(found[:60], alone)
    # Numbers of words that are known no longer are not used.
    kept, langid._KNOWN_WORDS = langid._KNOWN_WORDS, 1
    try:
        assert np.allclose(langid.Tagger(model).shares(iter(texts[:60])), alone)
    finally:
        langid._KNOWN_WORDS = kept


def test_a_carried_text_goes_to_python_once(spark):
    model = langid.train([("en", ["the", "thing", "with"] * 30), ("fr", ["le", "une", "quoi"] * 30)])
    docs = spark.createDataFrame([(1, "the thing"), (2, None), (3, "une quoi"), (4, "12")], "doc_id long, text string")
    found = langid.languages(docs, model, carry=True)
    assert len(found._jdf.queryExecution().analyzed().children().head().output().mkString(",").split(",")) == 1
    assert {r["row"]["doc_id"]: r["lang_pred"] for r in found.collect()} == {1: "en", 2: "und", 3: "fr", 4: "und"}
    other = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    assert {r["row"]["doc_id"]: r["lang_pred"] for r in langid.languages(other, model, carry=True).collect()} == {
        1: "en", 2: "und", 3: "fr", 4: "und",
    }


# 8 ---------------------------------------------------------------------------


def test_ids_are_the_tokenizers(spark, docs, texts, tmp_path):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(queries.tokenizer_path())
    odd = ["Don't I'LL '90s x's''t", "Überße ÉÀ œuf ’s", "a\xa0b c\x1cd \x85e", "é K̇ İ ΣΣ 中文",
           "123 4.5 a1b2 _x_ <b> $$ ªºµ ×÷", "", None, "hello <|endoftext|> world", "a<|startoftext|>b<|endoftext|>",
           "x<|ENDOFTEXT|>y Ünd", "İ <|endoftext|>É", "<|endoftext", "y" * 70 + " " + "Yé" * 50]
    some = texts | {10**6 + i: t for i, t in enumerate(odd)}
    frame = spark.createDataFrame(list(some.items()), "doc_id long, text string").repartition(5)
    path = str(tmp_path / "orc")
    tokens.write_tokens(frame, path, queries.tokenizer_path(), partitions=4)
    found = {r["doc_id"]: r for r in tokens.read_tokens(spark, path).collect()}
    checks = {r["doc_id"]: r for r in tokens.ids_crc32(tokens.read_tokens(spark, path)).collect()}
    start = 0
    for d in sorted(some):
        ids = plain.encode(some[d] or "", add_special_tokens=False).ids + [1]
        assert found[d]["ids"] == ids, some[d]
        assert (found[d]["start"], found[d]["n_tokens"]) == (start, len(ids))
        assert checks[d]["ids_crc32"] == crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    wanted = sorted(some)[5:8]
    assert sorted(r["doc_id"] for r in tokens.lookup(spark, path, wanted).collect()) == wanted
    plan = tokens.lookup(spark, path, wanted)._jdf.queryExecution().toString()
    assert "PushedFilters: [In(doc_id" in plan


# 9 ---------------------------------------------------------------------------


def brute_hits(texts, items):
    out = {}
    item_windows = [(i, {tuple(w[k : k + 10]) for k in range(max(1, len(w) - 9))}) for i, t in items for w in [words(t)] if w]
    for d, t in texts.items():
        w, hit, ids = words(t), set(), set()
        for i, windows in item_windows:
            for n in {len(x) for x in windows}:
                for k in range(len(w) - n + 1):
                    if tuple(w[k : k + n]) in windows:
                        hit |= set(range(k, k + n))
                        ids.add(i)
        out[d] = (len(w), len(hit), sorted(str(i) for i in ids if i is not None))
    return out


def test_contamination_matches_brute_force(spark, docs, texts, sf):
    bench = [(r["item_id"], r["text"]) for r in table(spark, sf, "benchmark").collect()]
    bench = bench[:12] + [(10**5, "mail com"), (10**5 + 1, "one"), (None, "example com example com"), (7, "a b c d e f g h i j"), (8, None)]
    some = {d: texts[d] for d in sorted(texts)[:60]}
    some |= {10**6: "x y A, b c D e f g h i j z one", 10**6 + 1: bench[0][1] + " and " + bench[0][1], 10**6 + 2: "nd " * 40}
    bench += [(9, "nd " * 12)]
    frame = spark.createDataFrame(list(some.items()), "doc_id long, text string")
    items = spark.createDataFrame(bench, "item_id long, text string")
    found = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in decontam.decontaminate(frame, items).collect()}
    assert found == brute_hits(some, bench)


# 10 --------------------------------------------------------------------------


def test_shards_fit_and_split_only_when_needed(spark, docs):
    same = spark.createDataFrame([(7, "the same row " * 20)] * 400, "doc_id long, text string")
    frame = docs.select("doc_id", "text").union(same)
    limit = 20_000
    found = sharding.shards(frame, limit).select("row.doc_id", "bytes", "shard").collect()
    assert len(found) == frame.count()
    held, rows = defaultdict(int), defaultdict(int)
    for r in found:
        held[r["shard"]] += r["bytes"]
        rows[r["shard"]] += 1
    assert all(held[s] <= limit or rows[s] == 1 for s in held)
    names = sorted(held)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:]) if a != b)
    for s in names:  # what was split did not fit
        if s:
            assert sum(held[x] for x in names if x.startswith(s[:-1])) > limit


def test_every_copy_has_its_shard_when_splits_change(spark, tmp_path):
    rows = [(7, "the same row " * 20)] * 3000 + [(i, f"text {i} " * 9) for i in range(300)] + [(None, None)] * 5
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "t"))
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        sharded = sharding.shards(spark.read.parquet(str(tmp_path / "t")), 20_000)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    found = sharded.select("row.doc_id", "bytes", "shard").collect()
    assert len(found) == len(rows) and all(r["shard"] is not None for r in found)
    held = defaultdict(int)
    for r in found:
        held[r["shard"]] += r["bytes"]
    assert max(held.values()) <= 20_000
    names = sorted(held)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:]))
