"""Operators over text: golden cases, brute force, round trips and held-out accuracy."""

import os
import random
import time
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from humusgrid.llm import bpe, forms, leaks, queries, scans, subjects, survivor

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


# --- 1: look-alike text


@pytest.mark.parametrize(
    ("a", "b"),
    [("Field 62", "Ｆｉｅｌｄ ６２ "), ("profile 7", "pro­fi⁠le  7"), ("classification", "classiﬁcation"), ("café", "café"), ("P-63", "Р‑63"), ("part IV", "part Ⅳ"), ("орan", "оpаn"), ("A B", "\tA　B\n"), ("й", "й")],
)
def test_same_look(a, b):
    assert a != b and forms.look_form(a) == forms.look_form(b) and forms.canonical_form(a) == forms.canonical_form(b)


@pytest.mark.parametrize(("a", "b"), [("Soil", "soil"), ("cafe", "café"), ("m2", "m²"), ("No 5", "№ 5"), ("a b", "ab"), ("1/2", "½"), ("и", "й"), ("3", "З")])
def test_other_look(a, b):
    assert forms.look_form(a) != forms.look_form(b)


def test_look_is_finer_than_canonical_and_stable():
    rng = random.Random(1)
    pool = [chr(c) for c in range(0x20, 0x2FFF) if unicodedata.category(chr(c))[0] != "C"] + list("ﬁ‍­﻿Ａａ")
    for _ in range(3000):
        s = "".join(rng.choice(pool) for _ in range(rng.randrange(8)))
        look = forms.look_form(s)
        assert forms.look_form(look) == look
        assert forms.canonical_form(s) == forms.canonical_form(look)


@pytest.mark.parametrize(("a", "b"), [("В ТРАНШЕЕ", "в траншее"), ("B траншее", "в ТРАНШЕЕ"), ("МОЛ", "мол"), ("Soil", "SOIL"), ("straße", "STRASSE"), ("ﬁeld", "FIELD")])
def test_canonical_form_has_no_case(a, b):
    assert forms.canonical_form(a) == forms.canonical_form(b)


def test_look_alike_pairs_match_brute_force(spark):
    rng = random.Random(2)
    base = ["Salt marsh 1", "Сосна 2", "café", "x"]
    twist = [lambda s: s, lambda s: s.replace("a", "а"), lambda s: s.replace(" ", " "), lambda s: s + "​", lambda s: s.upper()]
    rows = [(f"d{rng.randrange(60)}", rng.choice(twist)(rng.choice(base)), rng.choice(["s1", "s2"])) for _ in range(120)] + [("n", None, "s1"), ("e", "", "s1"), ("b", " ​", "s1"), ("b2", " ", "s1"), (None, "x", "s1"), ("z", "x​", None), ("long", "x" * 200_000, "s1"), ("long2", "x" * 200_000 + "﻿", "s1")]
    df = spark.createDataFrame(rows, "id string, text string, scope string").withColumn("look", F.lit("clash"))
    seen = [(i, t, s) for i, t, s in rows if i and t and forms.look_form(t)]
    for scope in (None, "scope"):
        want = {(a[0], b[0]) for a in seen for b in seen if a[0] < b[0] and a[1] != b[1] and forms.look_form(a[1]) == forms.look_form(b[1]) and (scope is None or a[2] is not None and a[2] == b[2])}
        got = [tuple(r) for r in forms.look_alike_pairs(df, "id", "text", scope).collect()]
        assert len(got) == len(set(got)) and set(got) == want and want
    assert forms.look_alike_pairs(df.limit(0), "id", "text").count() == 0


def test_look_classes(spark):
    rows = [("1", "Café"), ("2", "Cafe\u0301"), ("3", "cafe"), ("4", None), ("5", " \u200b"), ("1", "Café"), (None, "Café ")]
    df = spark.createDataFrame(rows, "id string, text string").withColumn("look", F.lit("clash"))
    got = {(r["id"], r["text"]): (r["one_form"], r["class_id"], r["texts"]) for r in forms.look_classes(df, "id", "text").collect()}
    assert forms.look_classes(df, "id", "text").count() == len(rows)
    assert got[("1", "Café")] == got[("2", "Cafe\u0301")] == got[(None, "Café ")] == ("Café", "Cafe\u0301", 3)
    assert got[("3", "cafe")] == ("cafe", "cafe", 1) and got[("4", None)] == got[("5", " \u200b")] == (None, None, None)
    assert forms.look_classes(df.limit(0), "id", "text").count() == 0


# --- 2: scanned pages

PAGE = "Salt fluxes near Koso rise toward the sur-\n— 17 —\nSOIL LETTERS Vol. 3\nface in summers. The clay disperses afler\nrain, 3.1 against 2.2. Samples came from the layer 40-\n60 cm and the crust holds\nSOIL LETTERS Vol. 4   18\nfirm at horizon A1."


def test_page_edges_are_found():
    page = scans.read_page(PAGE)
    kinds = {page.lines[i]: k for i, k in page.noise.items()}
    assert kinds == {"— 17 —": {"page_number"}, "SOIL LETTERS Vol. 3": {"running_header"}, "SOIL LETTERS Vol. 4   18": {"running_header", "page_number"}}
    assert [b for _, b in scans.broken_words(page).values()] == ["sur-face"]
    fixed = scans.repair(PAGE, {"afler": "after"})
    assert fixed == "Salt fluxes near Koso rise toward the surface in summers. The clay disperses after rain, 3.1 against 2.2. Samples came from the layer 40-60 cm and the crust holds firm at horizon A1."


@pytest.mark.parametrize("text", ["One whole line.", "First part ends.\n\nMETHODS\n\nSecond part begins.", "A paragraph of words that is long\nenough, (n =\n26). More words.\n\n7.0  7.59\n7.5  6.35\n\nLast words.", "Taken from the layer 54-\n60 cm of soil."])
def test_clean_text_has_no_noise(text):
    assert scans.events(text, {}) == set()


def test_texts_that_say_nothing():
    assert scans.events(None, {}) == scans.events("", {}) == scans.events("  \n ", {}) == set()
    assert scans.repair(None, {}) is None and scans.repair("", {}) == ""


def test_very_long_text_is_worked_in_time():
    start = time.time()
    text = "\n".join(f"words of the page number {i} go on and on here\n- {i} -\nHEADING OF THE PAGE {i % 7}\nand they end" for i in range(4000))
    kinds = {k for k, _ in scans.events(text, {"wrods": "words"})}
    assert kinds == {"page_number", "running_header"} and time.time() - start < 30


def test_noise_over_tables(spark):
    clean = [(f"c{i}", f"The drainage of plot {i} follows the transect\nand the well-known drainage holds, {i}.5 units.") for i in range(40)]
    rows = [*clean, ("m", "The drainagc of the plot holds."), ("h", "The drain-\nage of the plot."), ("k", "The well-\nknown plot."), ("p", "The drainage of\n[12]\nthe plot holds."), ("n", None), ("e", ""), ("m", "The drainagc of the plot holds.")]
    df = spark.createDataFrame(rows, "id string, t string").withColumn("word", F.lit("clash"))
    got = sorted(tuple(r) for r in scans.noisy_texts([("f", df, "id", "t")]).collect())
    assert got == [("f", "h", "hyphenation"), ("f", "m", "misread"), ("f", "p", "page_number")]
    fixed = {r["row_id"]: r["repaired"] for r in scans.repaired_texts([("f", df, "id", "t")]).collect()}
    assert fixed["m"] == "The drainage of the plot holds." and fixed["h"] == "The drainage of the plot." and fixed["k"] == "The well-known plot." and fixed["p"] == "The drainage of the plot holds." and fixed["n"] is None
    assert scans.noisy_texts([("f", df.limit(0), "id", "t")]).count() == 0


def test_headings_misread_at_both_ends_are_one():
    a, b, c = "longtermchangeofmoistureprofiles", "1ongtermchangeofmoistureprofi1es".replace("1", "i"), "seasonalthawdepthsofpeatysoils"
    assert sorted(map(sorted, scans.repetitions({0: a, 3: c, 7: b}))) == [[0, 7], [3]]
    assert scans.skeleton("normal") == scans.skeleton("nonnal".replace("nn", "rnn")[:2] + "rrnal") and scans.skeleton("почва") == scans.skeleton("лочва") != scans.skeleton("почвы")


def test_repetitions_match_comparing_all():
    rng = random.Random(12)
    for _ in range(60):
        base = ["".join(rng.choice("abcde") for _ in range(rng.randrange(5, 40))) for _ in range(4)]
        signs = {}
        for i in range(25):
            s = list(rng.choice(base))
            for _ in range(rng.randrange(4)):
                s[rng.randrange(len(s)) : rng.randrange(len(s)) + 1] = rng.choice("abcdef")
            if len(s) >= 5:  # headings have as many letters
                signs[i] = "".join(s)
        lead: dict[str, list[int]] = {}
        lines: dict[str, list[int]] = {}
        for i, s in signs.items():
            lines.setdefault(s, []).append(i)
        for s, own in sorted(lines.items(), key=lambda kv: (-len(kv[1]), kv[0])):
            if not any(scans.alike(s, t) for t in lead):
                lead[s] = own
        assert len(scans.repetitions(signs)) == len(lead)


def test_words_of_many_misread_places(spark):
    long = "нефтепродуктообеспечениеминерализованностипочвенногопокрова"
    assert len(long) > 40
    twice = long.replace("н", "и", 1)[::-1].replace("п", "л", 1)[::-1]
    rows = [(long, 400), (twice, 1), ("чистая", 300), ("4истоя".replace("о", "а"), 2), ("x" * 60, 1)]
    got = {r["word"]: r["good"] for r in scans.misread_words(spark.createDataFrame(rows, "word string, n bigint")).collect()}
    assert got == {twice: long, "4истая": "чистая"}
    assert scans.misread_words(spark.createDataFrame(rows[:0], "word string, n bigint")).count() == 0


# --- 6: survivors


def test_field_sources(spark):
    rows = [("a", "x", "accepted", 5), ("b", "n/a", "flagged", 9), ("c", "y", "flagged", 9), ("d", None, "accepted", 1), ("e", "—", None, None), ("f", "  ", "odd", 2), ("a", "x", "accepted", 5)]
    records = spark.createDataFrame(rows, "pid string, v string, st string, u int").withColumn("upd", F.timestamp_seconds("u")).withColumn("trust", F.lit("clash"))
    members = spark.createDataFrame([("a", "g"), ("b", "g"), ("c", "g"), ("gone", "g"), ("d", "h"), ("e", "h"), ("f", "h"), ("x", "i")], "id string, group_id string")
    got = sorted(tuple(r) for r in survivor.field_sources(members, records, "pid", ["v"], survivor.trust_rank(F.col("st"), ("accepted", "flagged")), "upd").collect())
    assert got == [("g", "*", "c"), ("g", "v", "a"), ("h", "*", "f")]
    assert survivor.field_sources(members, records.limit(0), "pid", ["v"], F.lit(1), "upd").count() == 0


FULL = "In the second year no-till plots at the station need liming beforehand; the error was 22.01 %. The crew doubts that rotations raise protein."


def test_consensus():
    copies = [FULL[:70], FULL[40:], FULL, FULL[:90] + " . . . . . .", FULL[:55] + "..."]
    texts = [survivor.clean_text(t) for t in copies]
    assert survivor.consensus_of(texts, [1.0] * 5) == FULL
    assert survivor.consensus_of([texts[0], texts[1]], [1.0, 1.0]) == FULL  # built from two halves
    assert min(texts, key=lambda t: survivor.consensus_distance(t, FULL)) == FULL


def test_consensus_sources(spark):
    rng = random.Random(3)
    rows = [("g", "full", FULL), ("g", "cut", FULL[:60]), ("g", "pad", FULL[:60] + " . . . ."), ("g", "none", "n/a"), ("g", "null", None), ("e", "e1", " "), ("e", "e2", "—"), ("t", "t2", "same words"), ("t", "t1", "same  words"), (None, "q", "x")]
    rows += [("big", f"b{i:04d}", FULL[: rng.randrange(20, 120)] + f" {'.' * 9}") for i in range(300)] + [("big", "best", FULL)]
    df = spark.createDataFrame(rows, "group_id string, id string, text string").withColumn("chunk", F.lit("clash"))
    for chunk in (1, 16, 1000):
        got = {r["group_id"]: r["source_id"] for r in survivor.consensus_sources(df, chunk=chunk).collect()}
        assert got == {"g": "full", "t": "t1", "big": "best"}
    assert survivor.consensus_sources(df.limit(0)).count() == 0


def test_large_groups_have_the_same_consensus(spark):
    rng = random.Random(8)
    rows = []
    for g in range(12):
        whole = [f"w{rng.randrange(60)}" for _ in range(rng.randrange(15, 50))]
        for i in range(rng.randrange(2, 40)):
            words = [w if rng.random() > 0.08 else f"x{rng.randrange(9)}" for w in whole]
            words[rng.randrange(len(words)) : rng.randrange(len(words)) + 1] = [f"y{k}" for k in range(rng.randrange(3))]
            text = " ".join(words) or "w"
            rows.append((f"g{g}", f"i{g}-{i}", text[rng.randrange(9) : len(text) - rng.randrange(12)].strip()))
    df = spark.createDataFrame(rows, "group_id string, id string, text string")
    a, b = ({r["group_id"]: r["source_id"] for r in survivor.consensus_sources(df, chunk=c).collect()} for c in (1, 1000))
    assert a == b and len(a) == 12
    level = df.groupBy("group_id", "text").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    small, large = ({r["group_id"]: r["consensus"] for r in f(level).collect()} for f in (survivor._small_groups, survivor._large_groups))
    assert small == large


def test_common_tokens_are_a_longest_subsequence():
    rng = random.Random(9)
    for _ in range(300):
        a, b = ([rng.choice("abcd") for _ in range(rng.randrange(14))] for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        pairs = survivor.common_tokens(a, b)
        assert len(pairs) == table[-1, -1] and all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))


def test_alignment_of_very_long_texts_ends():
    a, b = " ".join(f"w{i}" for i in range(9000)), " ".join(f"v{i % 3000}" for i in range(9000))
    start = time.time()
    survivor.consensus_of([a, b], [1.0, 1.0])
    assert time.time() - start < 20


# --- 7: tokens


@pytest.fixture(scope="module")
def coder():
    path, pattern = queries.public_vocabulary("byte_bpe_50k.tiktoken")
    return bpe.Encoder(bpe.read_ranks(bpe.read_vocabulary(path)), pattern)


def test_ids_equal_the_public_encoder(coder):
    tiktoken = pytest.importorskip("tiktoken")
    path, pattern = queries.public_vocabulary("byte_bpe_50k.tiktoken")
    other = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=coder.ranks, special_tokens={})
    rng = random.Random(4)
    parts = [" ", "  ", "\n", "\r\n", "\t", " ", " ", "the", "soil's", "Почвы", "12.5", "№", "🌱", "<|endoftext|>", "é", "—", "'ll", "​", "\x1c", "a" * 30]
    for _ in range(4000):
        s = "".join(rng.choice(parts) for _ in range(rng.randrange(12)))
        assert np.frombuffer(coder.encode(s), np.int32).tolist() == other.encode_ordinary(s), repr(s)


def test_other_patterns_cut_for_themselves(coder):
    tiktoken = pytest.importorskip("tiktoken")
    pattern = r"[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}{1,3}| ?[^\s\p{L}\p{N}]+[\r\n]*|\s*[\r\n]+|\s+(?!\S)|\s+"
    own, other = bpe.Encoder(coder.ranks, pattern), tiktoken.Encoding("own2", pat_str=pattern, mergeable_ranks=coder.ranks, special_tokens={})
    assert coder.by_words and not own.by_words
    for s in ("one\n\n\ntwo", "a  b\r\n\r\n c 12345", " \n \n x", "Почва\n\n—\n"):
        assert np.frombuffer(own.encode(s), np.int32).tolist() == other.encode_ordinary(s)


def test_corpus_round_trip(spark):
    path, pattern = queries.public_vocabulary("byte_bpe_50k.tiktoken")
    texts = [None, "", "  \n", "Почва 🌱 soil", "word " * 60_000, "x" * 50_000, "dup", "dup"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumn("ids", F.lit("clash"))
    coded = bpe.encode_corpus(df, "doc_id", "text", path, pattern)
    rows = {r["doc_id"]: r["ids"] for r in coded.collect()}
    assert rows[0] == [] and rows[1] == [] and rows[6] == rows[7]
    back = {r["doc_id"]: r["text"] for r in bpe.decode_corpus(coded, "doc_id", "ids", path).collect()}
    assert all(back[i] == (t or "") for i, t in enumerate(texts))
    assert bpe.encode_corpus(df.limit(0), "doc_id", "text", path, pattern).count() == 0


# --- 8: leaks


def _words(text):
    return [w for w in map(leaks.word_key, leaks.BROKEN.sub("", text or "").split()) if w]


def test_leaks_match_brute_force(spark):
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(20 if i == 1 else 10, 60)))) for i in range(20)] + [(90, None), (91, ""), (92, "too short")]
    items.append((93, items[0][1]))
    docs = []
    for d in range(150):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(5, 80))]
        run = rng.choice(items[:20])[1].split()
        at, n = rng.randrange(len(run)), rng.choice([13, 14, 15, 16, 40])
        piece = run[at : at + n]
        if rng.random() < 0.3:
            piece = [w.upper() + rng.choice([",", "!", ""]) for w in piece]
        words[rng.randrange(len(words)) : 0] = piece
        text = rng.choice([" ", "\n", "  "]).join(words)
        docs.append((d, text))
    docs += [(500, None), (501, ""), (502, "  "), (503, items[3][1].replace("w1", "w-\n1")), (504, " ".join(vocabulary) * 300), (0, docs[0][1])]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("value", F.lit("clash"))
    it = spark.createDataFrame(items, "item_id bigint, text string").withColumn("words", F.lit("clash"))
    grams = {}
    for i, t in items:
        w = _words(t)
        for k in range(len(w) - 14):
            grams.setdefault(tuple(w[k : k + 15]), set()).add(i)
    want = set()
    for d, t in docs:
        w = _words(t)
        for k in range(len(w) - 14):
            want |= {(d, i) for i in grams.get(tuple(w[k : k + 15]), ())}
    for most in (leaks.MOST_SENT, 200):
        got = [(r["doc_id"], r["item_id"]) for r in leaks.leaked_items(df, it, "doc_id", "item_id", most_sent=most).collect()]
        assert len(got) == len(set(got)) and set(got) == want and want
    # two texts under one id: a near miss and a leak
    run = items[1][1].split()[:15]
    twice = [(d, " ".join(run[:14] + ["other"] * 4)) for d in range(40)] + [(d, "before " + " ".join(run) + " after") for d in range(40)] + [(None, " ".join(run))]
    got = [r["doc_id"] for r in leaks.leaked_items(spark.createDataFrame(twice, "doc_id bigint, text string"), it.filter("item_id = 1"), "doc_id", "item_id").collect()]
    assert len(items[1][1].split()) < 15 or sorted(x for x in got if x is not None) == list(range(40)) and None in got
    assert leaks.leaked_items(df.limit(0), it, "doc_id", "item_id").count() == 0 and leaks.leaked_items(df, it.limit(0), "doc_id", "item_id").count() == 0


# --- 9: subjects


def test_subjects_on_held_out_labels(spark):
    t = lambda n: spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet")
    labels = t("doc_labels").select("doc_id", "subject").distinct()
    held = labels.filter("doc_id % 4 = 0")  # held out to measure; the model sees the other labels and all texts
    found = subjects.document_subjects(t("documents"), t("subjects"), labels.filter("doc_id % 4 <> 0")).select("doc_id", "subject")
    ids = held.select("doc_id").distinct()
    hit, told, true = found.join(held, ["doc_id", "subject"]).count(), found.join(ids, "doc_id").count(), held.count()
    assert hit / told > 0.9 and hit / true > 0.9, (hit, told, true)


def test_sums_do_not_depend_on_rounds(spark):
    rng = np.random.default_rng(6)
    bags = spark.createDataFrame([(i, rng.integers(0, 900, rng.integers(1, 30)).tolist()) for i in range(400)], "id int, words array<int>")
    beta = spark.sparkContext.broadcast(subjects.word_shares(rng.gamma(0.3, 1.0, (7, 900)) + 1e-6))
    one, many = (subjects.expected_counts(bags.repartition(n), beta, 3) for n in (1, 70))
    assert one.shape == (7, 900) and np.allclose(one, many, rtol=1e-4, atol=1e-4)
    assert one.sum() == pytest.approx(sum(len(r["words"]) for r in bags.collect()), rel=1e-4)


def test_subjects_come_from_the_fitted_topics(spark):
    t = lambda n: spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet")
    model, _ = subjects.fit_subjects(t("documents"), t("subjects"), t("doc_labels"))
    assert len(model.subjects) > 2 * len(model.names) and set(model.subjects) == {*model.names, None}
    spoken = {s: {w for words, n in zip(model.top_terms(), model.subjects) if n == s for w in words} for s in model.names}
    assert {"peat", "bog"} & spoken["peatlands"] and {"thaw", "frozen"} & spoken["permafrost"]
    fitted, started = ({tuple(r) for r in subjects.document_subjects(t("documents"), t("subjects"), t("doc_labels"), passes=n).select("doc_id", "subject").collect()} for n in (subjects.PASSES, 0))
    assert fitted != started and len(fitted & started) > 0.9 * len(fitted)


def test_subjects_defined_cases(spark):
    salt, peat = "salt crusts rise in saline soils and salt flats crack", "peat bogs hold water and bog peat burns slowly"
    docs = [(i, salt if i % 2 else peat) for i in range(40)] + [(100, None), (101, ""), (102, " \n"), (103, "1. 5 - 7\n2. 8 - 9"), (104, f"{salt}.\n\n{peat}."), (104, f"{salt}.\n\n{peat}.")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("subject", F.lit("clash"))
    names = spark.createDataFrame([("salinity", "salt"), ("peatlands", None), (None, "x")], "subject string, description string")
    labels = spark.createDataFrame([(i, "salinity" if i % 2 else "peatlands") for i in range(20)] + [(1, "salinity"), (2, None), (None, "salinity"), (3, "unknown")], "doc_id bigint, subject string")
    got = {(r["doc_id"], r["subject"]) for r in subjects.document_subjects(df, names, labels).collect()}
    assert {(104, "salinity"), (104, "peatlands"), (39, "salinity"), (38, "peatlands")} <= got and not {d for d, _ in got} & {100, 101, 102, 103}
    assert subjects.document_subjects(df.limit(0), names, labels).count() == 0
    assert subjects.document_subjects(df, names.limit(0), labels).count() == 0
    subjects.document_subjects(df, names, labels.limit(0)).collect()


# --- all


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_runs(spark, name):
    df = queries.QUERIES[name](spark, DATA)
    rows = df.collect()
    assert len(rows) == len({repr(r) for r in rows}) or not name.endswith("_found")
