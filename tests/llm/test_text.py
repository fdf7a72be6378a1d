"""Confusables, tokens, packing and encoding repair."""

from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from assayweave.llm import confusables, encoding_repair, packing, tokens

DOCS = "doc_id long, text string, lang string"

FORMS = [
    ("ＩＣ５０ （ｎＭ）", "IC50 (nM)"), ("hCΑX2", "hCAX2"), ("Ångmer-17", "Ångmer-17"), ("Nórdane-20", "Nórdane-20"), ("1​2", "12"), ("24c [2]", "24c [2]"), ("(S)−X", "(S)-X"),
    ("ⅯTK1", "MTK1"), ("μM", "µM"), ("nΜ", "nM"), ("γ-Мedibelеgliptin", "γ-Medibelegliptin"), ("соединение ３３", "соединение 33"), ("сoединение", "соединение"), ("ϲompound", "compound"), ("СТС", "CTC"), ("Δραστικότητα", "Δραστικότητα"),
]
GENUINE = ["α-Lodo", "β–".replace("–", "-"), "γ Δ", "12 ± 1", "3 × 10⁻⁹ M", "≤5", "≥5 ≈6", "Kᵢ", "IC₅₀", "µM²", "ένωση 14", "Активность фермента", "Séralin-6", "plain  text ", "", "a·b", "соединение 33"]


@pytest.mark.parametrize(("text", "form"), FORMS)
def test_consistent_forms(text, form):
    assert confusables.consistent(text) == form
    assert confusables.consistent(form) == form


@pytest.mark.parametrize("text", GENUINE)
def test_genuine_texts_stay(text):
    assert confusables.consistent(text) == text


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40))
def test_consistent_is_idempotent(text):
    once = confusables.consistent(text)
    assert confusables.consistent(once) == once


def test_inconsistent_fields(spark):
    df = spark.createDataFrame([(1, "ａ", None, "x"), (2, "a", "β", "y"), (2, "a", "β", "y"), (None, "​", "", "z"), (3, None, None, None)], "value_id long, a string, b string, field string")
    got = {tuple(r) for r in confusables.inconsistent_fields(df, "value_id", ["a", "b"]).collect()}
    assert got == {(1, "a"), (None, "a")}
    assert confusables.inconsistent_fields(df.limit(0), "value_id", ["a"]).count() == 0


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(f"{tokens.TOKENIZER_DIR}/byte_bpe_50k.json")
    made.encode_special_tokens = True
    return made


ALPHABET = "abcdefghijklmnopqrstuvwxyz     ABC\n\t0123'éüñ’µ日本🙂"


def texts(seed, n, most):
    rng = random.Random(seed)
    return ["".join(rng.choices(ALPHABET, k=rng.randint(0, most))) for _ in range(n)]


def test_encoder_equals_the_library(library):
    cases = [*texts(1, 300, 200), "a" * 3000, " " * 2000, "ab" * 1500, "日" * 500, "<|endoftext|>", "", "\n\n \n", "don't we'll"]
    encode = tokens.encoder().encode
    assert [encode(t) for t in cases] == [e.ids for e in library.encode_batch(cases, add_special_tokens=False)]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abcdeilnorst", min_size=0, max_size=80), st.integers(0, 80), st.integers(0, 10), st.text(alphabet="abcdeilnorst", max_size=10))
def test_prefix_table_edits_are_exact(text, start, length, new):
    raw, put = text.encode(), new.encode()
    start = min(start, len(raw))
    stop = min(len(raw), start + length)
    vocabulary = tokens.encoder().vocabulary
    grown = tokens.PrefixTable(vocabulary, raw[:start])
    grown.append(raw[start:])
    assert grown.ids() == vocabulary.merge(raw) if raw else grown.ids() == []
    grown.replace(start, stop, put)
    edited = raw[:start] + put + raw[stop:]
    assert grown.ids() == (vocabulary.merge(edited) if edited else [])


def test_an_edit_touches_what_is_near():
    table = tokens.PrefixTable(tokens.encoder().vocabulary, b"the quick brown fox " * 400)
    assert table.replace(100, 101, b"x") < 400
    assert table.ids() == tokens.PrefixTable(tokens.encoder().vocabulary, table.text).ids()


def test_encode_corpus(spark, library):
    rows = [(n, t, "en") for n, t in enumerate(texts(2, 30, 100))] + [(98, None, None), (99, "", "x"), (100, "word " * 50_000, "x"), (100, "word " * 50_000, "x")]
    out = tokens.encode_corpus(spark.createDataFrame(rows, DOCS)).collect()
    got = {r["doc_id"]: r["ids"] for r in out}
    assert len(out) == len(rows) and got[98] == [] and got[99] == []
    assert all(got[n] == library.encode(t, add_special_tokens=False).ids for n, t, _ in rows if t)
    counts = {r["doc_id"]: r["n_tokens"] for r in tokens.count_tokens(spark.createDataFrame(rows, DOCS)).collect()}
    assert all(counts[n] == len(got[n]) for n in got)
    assert tokens.encode_corpus(spark.createDataFrame([], DOCS)).count() == 0


def check_packing(rows, sizes, capacity):
    placed = [r for r in rows if r["container"] is not None]
    by = {}
    for r in placed:
        by.setdefault(r["container"], []).append((r["offset"], r["size"]))
    for spans in by.values():
        end = 0
        for offset, size in sorted(spans):
            assert offset == end
            end += size
        assert end <= capacity
    pieces = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append((r["start"], r["size"]))
    for key, n in sizes:
        spans = sorted(pieces[key])
        assert sum(s for _, s in spans) == n and [s for s, _ in spans] == list(range(0, max(n, 1), capacity))
    return len(by)


def test_packing(spark):
    rng = random.Random(5)
    sizes = [(n, rng.choice([rng.randint(1, 1024), 300, 5000, 1024, 0, 1025])) for n in range(800)]
    rows = packing.pack(spark.createDataFrame(sizes, "doc_id long, n_tokens long")).collect()
    used = check_packing(rows, sizes, 1024)
    least = -(-sum(n for _, n in sizes) // 1024)
    assert least <= used <= 1.03 * least
    again = packing.pack(spark.createDataFrame(sizes, "doc_id long, n_tokens long").repartition(5)).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, again), key=str)
    assert packing.pack(spark.createDataFrame([], "doc_id long, n_tokens long")).count() == 0


def test_pack_documents_with_nulls(spark):
    out = packing.pack_documents(spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "hello there", "x"), (None, "hello", "x")], DOCS)).collect()
    assert {r["doc_id"]: r["container"] is None for r in out} == {1: True, 2: True, 3: False, None: False}
    report = packing.fill_report(packing.pack_documents(spark.createDataFrame([(1, "a b c", "x")], DOCS))).first()
    assert (report["containers"], report["least"]) == (1, 1)


def test_boundaries_are_optimal():
    import itertools

    rng = random.Random(2)
    for _ in range(20):
        histogram = {rng.randint(1, 40): rng.randint(1, 9) for _ in range(7)}
        sizes = sorted(histogram)

        def padding(bounds, histogram=histogram):
            return sum(n * (min(b for b in bounds if b >= s) - s) for s, n in histogram.items())

        for k in (1, 2, 3):
            best = min(padding((*c, sizes[-1])) for c in itertools.combinations(sizes[:-1], min(k, len(sizes)) - 1))
            assert padding(packing.optimal_boundaries(histogram, k)) == best
    assert packing.optimal_boundaries({}, 4) == []


CLEAN = [
    "Für 22c ließ sich kein Wert ermitteln (Löslichkeit < 3 µg/mL).", "La sélectivité envers PARX1 reste très élevée, même à forte concentration.", "В таблице 5 приведены значения для 48a и его аналогов.",
    "Ningún análogo mostró selectividad frente a CDX4.", "Values – “inactive” – didn’t reach ≤ 5 % at 37 °C.", "Žádný další účinek nebyl u látky zjištěn.", "NÃO HOUVE REPETIÇÃO.", "Серия РС-3; РСА подтвердил.",
    "SÃO and Â appear in strain names; the Ð series was dropped. Ø 12 mm, 3.2 Å; √n, ∞, ∑, № 4, ½, £, § 🙂", "В таблице", "plain ascii &micro;", "日本語のテキスト",
]


@pytest.mark.parametrize("text", CLEAN)
def test_clean_texts_are_left_alone(text):
    assert encoding_repair.repair_multibyte(text) == (text, False)


@pytest.mark.parametrize("page", ["cp1252", "latin-1", "cp1250", "cp1251", "cp437", "cp866", "mac_roman"])
@pytest.mark.parametrize("text", CLEAN[:6])
def test_multibyte_damage_is_undone(text, page):
    table = {b: bytes([b]).decode(page, errors="replace") for b in range(256)}
    broken = "".join(chr(b) if table[b] == "�" else table[b] for b in text.encode())
    assert encoding_repair.repair_multibyte(broken) == (text, True)


def test_damage_in_two_layers():
    twice = "élevée".encode().decode("latin-1").encode().decode("latin-1")
    assert encoding_repair.repair_multibyte(f"très {twice}") == ("très élevée", True)


def test_single_byte_damage_and_restoration(spark):
    swap = lambda t, written, shown: t.encode(written).decode(shown)
    good = [(n, CLEAN[n % 6], "x") for n in range(60)]
    bad = [
        (100, swap(CLEAN[0], "cp1252", "mac_roman"), "x"), (101, swap(CLEAN[1], "cp1252", "cp437"), "x"), (102, swap(CLEAN[2], "cp1251", "cp1252"), "x"), (103, "Fine. " + CLEAN[3].encode().decode("cp1252"), "x"),
        (104, "half broken Ã\x83 \x9d", "x"),
    ]
    rest = [(200, None, None), (201, "", None), (202, "ascii only", None), (203, CLEAN[8], None), (204, CLEAN[2] * 500, None)]
    df = spark.createDataFrame(good + bad + rest, DOCS)
    assert {r["doc_id"] for r in encoding_repair.find_garbled(df).collect()} == {100, 101, 102, 103, 104}
    restored = {r["doc_id"]: (r["restored"], r["complete"]) for r in encoding_repair.restore(df).collect()}
    assert restored[103] == ("Fine. " + CLEAN[3], True) and restored[102][0] == CLEAN[2] and restored[100][0] == CLEAN[0] and not restored[104][1]
    assert encoding_repair.find_garbled(df.limit(0)).count() == 0


def test_single_byte_damage_of_many_documents(spark):
    swap = lambda t, written, shown: t.encode(written).decode(shown)
    good = [(n, f"{CLEAN[0]} Nr. {n}", "x") for n in range(20)]
    copies = [(100 + n, swap(CLEAN[0], "cp1252", "mac_roman"), "x") for n in range(15)]
    third = [(200 + n, swap(f"{CLEAN[2]} {n}", "cp1251", "cp1252"), "x") for n in range(10)]
    rest = [(300 + n, f"{CLEAN[2]} {n}", "x") for n in range(20)] + [(400, swap("Siehe Löslichkeit oben", "cp1252", "mac_roman"), "x")]
    df = spark.createDataFrame(good + copies + third + rest, DOCS)
    koi = [(500 + n, f"Серия РС-{n}; {swap('Вещество при 5 мкМ подтвердил', 'koi8_r', 'cp1251')}", "x") for n in range(10)]
    df = df.unionByName(spark.createDataFrame(koi + [(600 + n, f"Вещество при 5 мкМ подтвердил мРНК {n}", "x") for n in range(15)], DOCS))
    wanted = {r[0] for r in copies + third + koi} | {400}
    assert {r["doc_id"] for r in encoding_repair.find_garbled(df).collect()} == wanted
    restored = {r["doc_id"]: r["restored"] for r in encoding_repair.restore(df).collect()}
    assert restored[107] == CLEAN[0] and restored[203] == f"{CLEAN[2]} 3" and restored[400] == "Siehe Löslichkeit oben"


def test_words_of_long_chains_are_looked_at():
    chain = "/".join(["plain"] * 12 + ["sŽlectivitŽ"] + ["tags"] * 5)
    assert "|sŽlectivitŽ|" in encoding_repair.contexts(f"a {chain}, b")
    fixed = encoding_repair.replace_words(f"a {chain}, b", {"|sŽlectivitŽ|": "sélectivité"})
    assert fixed == f"a {chain}, b".replace("Ž", "é")


def test_damage_in_any_number_of_layers(spark):
    text = "für Käse naïve"
    for _ in range(6):
        text = text.encode().decode("cp1252")
    assert encoding_repair.repair_multibyte(text) == ("für Käse naïve", True)
    df = spark.createDataFrame([(1, text), (2, "plain")], "doc_id long, text string")
    assert [tuple(r) for r in encoding_repair.restore(df).collect()] == [(1, "für Käse naïve", True)]


@pytest.mark.parametrize(("text", "form"), [("օne", "one"), ("Ꭺ1", "A1"), ("㎛", "µm"), ("ꓐ2", "B2"), ("ⲟne", "one"), ("ıbuprofen", "ibuprofen"), ("Կապ", "Կապ"), ("ᏣᎳᎩ", "ᏣᎳᎩ")])
def test_more_scripts(text, form):
    assert confusables.consistent(text) == form


def test_the_memory_of_pairs_is_bounded(monkeypatch):
    vocabulary = tokens.Vocabulary({bytes([b]): b for b in range(256)} | {b"ab": 256})
    monkeypatch.setattr(tokens, "REMEMBERED_PAIRS", 3)
    for a in b"xyzab":
        for b in b"xyzab":
            assert vocabulary.fits(a, b) is (bytes([a, b]) != b"ab") and len(vocabulary._fits) <= 3


def test_batches_stay_inside_their_bucket(spark):
    rng = np.random.default_rng(3)
    sizes = [int(x) for x in rng.integers(0, 90, 300)]
    df = spark.createDataFrame(list(enumerate(sizes)), "doc_id long, n_tokens long")
    out = packing.pack(df, capacity=64, buckets=4).toPandas()
    bounds = packing.optimal_boundaries(out[out["size"] > 0].groupby("size").size().to_dict(), 4)
    used = out[out["size"] > 0].assign(bucket=lambda d: np.searchsorted(bounds, d["size"]))
    assert used.groupby("container")["bucket"].nunique().max() == 1 and used.groupby("container")["size"].sum().max() <= 64
    assert used["size"].sum() == sum(sizes) and len(packing.by_bucket({}, 4)) == 0
    assert packing.pack(df, capacity=64).toPandas()["container"].max() <= out["container"].max()
