"""Language models: held-out accuracy, counts against brute force, rejection, odd rows."""

import random
import zlib
from collections import Counter

import numpy as np

from saasmart.llm import language_id as li
from saasmart.llm.queries import QUERIES
from tests.conftest import SF01


def test_held_out_documents_get_their_language(spark):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    got = QUERIES["op1_language_id"](spark, SF01).collect()
    assert sorted(r.doc_id for r in got) == sorted(langs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) / len(held) > 0.99
    assert sum(r.accepted for r in held) / len(held) > 0.99


def grams(text):
    """4-grams of classes, one boundary for each run of others, none before the first letter."""
    out, kept = Counter(), []
    for c in text.lower():
        k = ord(c) if c.isalpha() else 0
        if k or (kept and kept[-1]):
            kept.append(k)
    for i in range(len(kept)):
        window = [0] * max(0, 3 - i) + kept[max(0, i - 3):i + 1]
        out[tuple(window)] += 1
    return out


def test_counts_match_brute_force():
    texts = ["Ab1 -- cd", "", "...", "éÀ x", "  lead", "a" * 10]
    alphabet = li.Alphabet.of(texts)
    key, count = li._stream(texts, alphabet)
    want = Counter()
    for t in texts:
        want.update(grams(t))
    letter = [0, None, *alphabet.letters.tolist()]
    got = Counter(tuple(letter[int(k) >> 15 * b & 0x7FFF] for b in (3, 2, 1, 0)) for k in key)
    assert got == want
    assert count.tolist() == [sum(grams(t).values()) for t in texts]


def test_probabilities_sum_to_one():
    rng = random.Random(4)
    text = "".join(rng.choice("abc ") for _ in range(400))
    alphabet = li.Alphabet([ord(c) for c in "abcz"])
    key, _ = li._stream([text], alphabet)
    keys, counts = li._tally(key)
    model = li._smooth(["x"], 18, np.zeros(len(keys), int), keys, counts)
    scorer = li.Scorer(model)
    for context in ("abc", "zzz", "ab ", "cab"):
        total = 0.0
        for code in range(100):  # all others are as likely as the last
            k = sum(int(g) << 15 * (3 - i) for i, g in enumerate([*alphabet.codes(np.array([ord(c) for c in context])), code]))
            p = np.exp(probability(scorer, k))
            total += p
        total += p * ((1 << 15) - 100)
        assert abs(total - 1) < 0.01, (context, total)


def probability(scorer, key):
    m, log, left = scorer.model, 0.0, key
    for order in range(li.ORDER, 0, -1):
        k = np.array([left & ((1 << 15 * order) - 1)], dtype=np.uint64)
        row = scorer.find(order - 1, k)[0]
        if row >= 0:
            return log + m.grams[order - 1][2][row, 0]
        context = k >> np.uint64(15) if order > 1 else np.zeros_like(k)
        row = scorer.find(li.ORDER + order - 1, context)[0]
        if row >= 0:
            log += m.contexts[order - 1][2][row, 0]
    return log + m.floor


def test_odd_rows_rejection_and_extra_columns(spark):
    rng = random.Random(1)
    en = ["".join(rng.choice(["the ", "and ", "of ", "to "]) for _ in range(40)) for _ in range(300)]
    de = ["".join(rng.choice(["der ", "und ", "für ", "zu "]) for _ in range(40)) for _ in range(300)]
    rows = [(i, t, "en" if i < 300 else "de") for i, t in enumerate(en + de)]
    rows += [(900, None, "en"), (901, "", None), (902, "12 !!", "de"), (903, "the and of to the and", None),
             (904, "жзш щщю " * 20, None), (905, "der und " * 20000, None), (0, en[0], "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 as lang_pred", "2 as score")
    model = li.fit(df, key="doc_id")
    got = {r.doc_id: r.x for r in df.select("doc_id", li.predict(model, df.text).alias("x")).collect()}
    assert [got[i].lang_pred for i in (900, 901, 902, 903, 905)] == ["und", "und", "und", "en", "de"]
    assert not any(got[i].accepted for i in (900, 901, 902, 904)) and got[903].accepted and got[905].accepted
    assert got[900].score == 0


def test_no_labels_and_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert li.fit(empty) is None
    df = spark.createDataFrame([(1, "abc")], "doc_id long, text string")
    row = df.select(li.predict(None, df.text).alias("x")).first().x
    assert (row.lang_pred, row.score, row.accepted) == ("und", 0.0, False)


def test_no_two_letters_share_a_code():
    letters = [c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF and chr(c).isalpha()]
    rng = random.Random(6)
    some = sorted(rng.sample(letters, li.LETTERS - 10) + [ord(c) for c in "бあŵé"] + [0x10400, 0x20000])
    alphabet = li.Alphabet(some)
    codes = alphabet.codes(np.array(sorted(set(some)), np.uint32))
    assert len(set(codes.tolist())) == len(set(some)) and codes.min() == 2 and codes.max() < 1 << li.CHAR_BITS
    others = alphabet.codes(np.setdiff1d(letters, some)[:500].astype(np.uint32))
    assert set(others.tolist()) == {1}
    assert alphabet.codes(np.array([ord(" "), ord("1"), 0x1F600], np.uint32)).tolist() == [0, 0, 0]


def test_letters_of_other_scripts_are_told_apart(spark):
    """Two languages whose letters met in one code when codes were folded to 12 bits."""
    rng = random.Random(3)
    def fold(c):
        return (c ^ (c >> 12) * 0x5BD) & 0xFFF
    pool = [c for c in range(0x4E00, 0x9000)]
    one = [c for c in range(0x3041, 0x3097)]
    two = [next(p for p in pool if fold(p) == fold(c)) for c in one]
    texts = lambda own: ["".join(chr(rng.choice(own)) for _ in range(60)) for _ in range(40)]
    rows = [(i, t, lang) for lang, own in (("one", one), ("two", two)) for i, t in enumerate(texts(own))]
    model = li.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    probe = [(t, lang) for lang, own in (("one", one), ("two", two)) for t in texts(own)]
    df = spark.createDataFrame(probe, "text string, lang string")
    assert all(r.x.lang_pred == r.lang for r in df.select("lang", li.predict(model, df.text).alias("x")).collect())


def rare_beside_hot(spark):
    """600 texts of a language with many n-grams, 6 of one with few of its own."""
    rng = random.Random(2)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(5))
    rows = [(i, " ".join(word("abcdefghijklmnopqrstuvwxyz") for _ in range(60)), "hot") for i in range(600)]
    rows += [(600 + i, " ".join(word("klmnopäöüß") for _ in range(60)), "rare") for i in range(6)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_a_model_has_all_ngrams_whole_or_in_parts(spark, monkeypatch):
    monkeypatch.setattr(li, "CALIBRATION_SHARE", 1 << 40)  # all rows are counted
    df = rare_beside_hot(spark)
    rows = df.orderBy("doc_id").collect()
    whole = li.fit(df, key="doc_id")
    parts = li.fit(df, key="doc_id", model_bytes=1 << 20)
    assert whole.table is None and parts.parts > 1
    alphabet = li.Alphabet.of([r.text for r in rows])
    found = [li._tally(li._stream([r.text for r in rows if r.lang == name], alphabet)[0]) for name in ("hot", "rare")]
    who = np.repeat([0, 1], [len(k) for k, _ in found])
    brute = li._smooth(["hot", "rare"], 1, who, *map(np.concatenate, zip(*found)))
    brute.alphabet = alphabet
    assert set(whole.grams[3][1].tolist()) == {int(k) for some, _ in found for k in some}
    texts = [r.text for r in rows] + ["", None, "12", "жзш kab"]
    want, count, _ = li.Scorer(brute)([t or "" for t in texts])
    probe = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for model in (whole, parts):
        got = li._measured(model, probe, "text", "x").orderBy("doc_id").select("x.*").collect()
        assert np.allclose([r.entropy for r in got], want, atol=1e-4)
        assert [r.n_chars for r in got] == count.tolist()
    a, b = (li.identify(m, probe).orderBy("doc_id").select("found.*").collect() for m in (whole, parts))
    assert [(r.lang_pred, r.accepted, r.n_chars) for r in a] == [(r.lang_pred, r.accepted, r.n_chars) for r in b]
    assert [r.lang_pred for r in a[:len(rows)]] == [r.lang for r in rows]


def test_only_rows_that_calibrate_are_left_out(spark, monkeypatch):
    df = rare_beside_hot(spark).union(spark.createDataFrame([(900, "einzig", "one")], "doc_id long, text string, lang string"))
    seen = []
    monkeypatch.setattr(li, "_calibrate", lambda model, rows: seen.append(rows) or model)
    smooth, real = [], li._smooth
    monkeypatch.setattr(li, "_smooth", lambda langs, bits, who, key, n: smooth.append((langs, n.sum())) or real(langs, bits, who, key, n))
    every = sum(sum(grams(r.text).values()) for r in df.collect())
    for rows in (3, 10):
        li.fit(df, key="doc_id", calibration_rows=rows)
        langs, counted = smooth.pop()
        aside = seen.pop()
        assert langs == ["hot", "one", "rare"] and len(aside) <= rows
        assert counted + sum(n for _, _, n in aside) == every
