"""Language identification, collocations and clustering against plain restatements."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest
from conftest import LONG, ODD_TEXTS

from martloom.llm import centroids as C
from martloom.llm import language_id as L
from martloom.llm import phrases as P
from martloom.llm.queries import held_out
from martloom.llm.tables import table


# language identification

@pytest.mark.parametrize("text", [
    "Ab c.", "é", "x" * 9, "  Two\n\nwords!! ", "Straße ΑΣ", "日本 語 текст", "a1b2", "", "!!!", "\ud800a",
])
@pytest.mark.parametrize("cut", [3, 1 << 20])
def test_symbols_are_the_letters_and_single_blanks(monkeypatch, text, cut):
    monkeypatch.setattr(L, "SLICE", cut)
    got = Counter()
    for s in L.symbols(text):
        got += Counter(zip(s.tolist(), s[1:].tolist(), s[2:].tolist()))
    assert got == Counter(brute.letter_grams(text))


def test_bundles_are_sums_of_bound_vectors(monkeypatch):
    texts = ["The cat sat on the mat", "", "The the the", "x"]
    for block, cut in ((8192, 1 << 20), (3, 5)):
        monkeypatch.setattr(L, "BLOCK", block)
        monkeypatch.setattr(L, "SLICE", cut)
        got, grams = L.bundles(((i, s) for i, t in enumerate(texts) for s in L.symbols(t)), len(texts), 64)
        for i, t in enumerate(texts):
            assert got[i].tolist() == brute.bundle(t, lambda s: L.symbol_vector(s, 64).tolist(), 64)
            assert grams[i] == len(brute.letter_grams(t))


def test_languages_match_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in table(spark, sf_dir, "documents").select("doc_id", "text", "lang").limit(60).collect()]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = L.identified(frame, L.fit(frame, held_out, 64)).collect()
    want = brute.languages(rows, lambda s: L.symbol_vector(s, 64).tolist(), 64)
    assert [(r["doc_id"], r["lang_pred"]) for r in got] == [(d, p) for d, p, _ in want]
    assert np.allclose([r["score"] for r in got], [s for *_, s in want])


def test_held_out_documents_are_told_apart(spark, sf_dir, result):
    lang = {r["doc_id"]: r["lang"] for r in table(spark, sf_dir, "documents").select("doc_id", "lang").collect()}
    rows = [r for r in result("op11_language_id") if r[1]]
    assert len(rows) > 30 and sum(lang[r[0]] == r[2] for r in rows) >= 0.98 * len(rows)
    assert len(result("op11_language_id")) == len(lang)


def test_odd_texts_get_a_defined_language(rows_of):
    frame = rows_of(ODD_TEXTS)
    got = L.identified(frame, L.fit(frame, held_out)).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in ODD_TEXTS)
    lettered = [t is not None and any(c.isalpha() for c in t) for _, t in ODD_TEXTS]
    assert [r["lang_pred"] for r in got] == ["en" if k else "und" for k in lettered]
    assert all(0 <= r["score"] <= 1 for r in got)


def test_no_profiles_and_no_rows(rows_of):
    none = L.fit(rows_of([]), held_out)
    assert none.names == []
    assert [r["lang_pred"] for r in L.identified(rows_of([(1, "word")]), none).collect()] == ["und"]
    assert L.identified(rows_of([]), none).collect() == []
    assert L.fit(rows_of([(1, "word")], lang=None), held_out).names == []


def test_too_many_languages_are_an_error(monkeypatch, spark):
    monkeypatch.setattr(L, "MOST_LANGUAGES", 2)
    rows = spark.createDataFrame([(i, "word", f"l{i}") for i in range(12)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="languages"):
        L.fit(rows, held_out)


# collocations

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def mined(frame, **how):
    got = P.collocations(frame, filter_bits=1 << 20, **how)
    assert got.columns == COLUMNS
    return sorted(map(tuple, got.collect()), key=lambda r: (r[0], r[1]))


def texts_with_phrases(seed, n=160):
    rng = random.Random(seed)
    parts = ["New York", "new york city", "of the", "a b c d", "a b c", "é è", "x x x x x", "tab\tbed  wide"]
    out = []
    for i in range(n):
        words = [rng.choice(parts) if rng.random() < 0.4 else rng.choice("pqrstuvw") for _ in range(rng.randrange(30))]
        out.append((i, "".join(w + rng.choice([" ", " ", " ", ". ", "\n", "\r", ";"]) for w in words), rng.choice(["en", "de", None])))
    return out


@pytest.mark.parametrize("seed,least", [(1, 30), (2, 5), (3, 2)])
def test_collocations_match_brute_force(spark, seed, least):
    rows = texts_with_phrases(seed)
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    want = brute.collocations([(t, g) for _, t, g in rows], least, 50)
    assert want and mined(frame, least=least, top=50) == want


def test_failures_of_the_sample_are_found(spark, monkeypatch):
    """Phrases that only one piece holds, and that the sample therefore misses or not, need further passes."""
    rows = [(i, " ".join([f"u{i} v{i} w{i} z{i}"] * 7), "en") for i in range(12)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    passes = []
    added = P._added
    monkeypatch.setattr(P, "_added", lambda bits, df: passes.append(1) or added(bits, df))
    want = brute.collocations([(t, g) for _, t, g in rows], 5, 2000)
    assert mined(frame, least=5) == want
    monkeypatch.setattr(P, "SAMPLE", 1 << 40)  # a sample of nothing proposes nothing: every level is a failure
    passes.clear()
    # three lengths of the sample, the hashes of the first pass, and failures of one, two and three words
    assert mined(frame, least=5) == want and len(passes) == 3 + 1 + 3


class Sent:
    """A filter as a task gets it."""

    def __init__(self, bits):
        self.value = zlib.compress(bits)


def some_of(h, size=1 << 12, odds=0.5, seed=1):
    """A filter with a part of the hashes."""
    bits, rng = np.zeros(size, np.uint8), random.Random(seed)
    for x in h:
        if rng.random() < odds:
            for at in (x % (size * 8), (x >> 32) % (size * 8)):
                bits[at >> 3] |= 1 << (at & 7)
    return bits


def text_batches(seed, each=20):
    rows = texts_with_phrases(seed)
    langs, texts = [(g or "und") + "\n" for *_, g in rows], [t for _, t, _ in rows]
    every = pa.RecordBatch.from_arrays([pa.array(langs), pa.array(texts)], names=["lang", "text"])
    return [every.slice(i, each) for i in range(0, len(rows), each)]


def all_phrases(batches):
    """Every phrase's hash, and its count."""
    spelled, f = {}, Counter()
    for words, langs, piece, names in P._stretches(iter(batches)):
        for words_, level in P._levels(words, langs, piece, names, P.Filter(np.full(8, 255, np.uint8)), None):
            for i, h in enumerate(level.h.tolist()):
                spelled[h] = names[level.lang[i]], " ".join(words_[int(j)].as_py() for j in level.spelling[i])
                f[h] += int(level.count[i])
    return spelled, f


def in_order(batches):
    """Rows as they come out of the shuffle."""
    rows = pa.Table.from_batches(list(batches))
    return rows.sort_by("first").to_batches(max_chunksize=5)


@pytest.mark.parametrize("packed", [40, 1 << 21])
@pytest.mark.parametrize("least", [2, 300])
def test_packed_hashes_add_up(monkeypatch, packed, least):
    monkeypatch.setattr(P, "PACKED", packed)
    batches = text_batches(5) * 3
    _, f = all_phrases(batches)
    rows = P._hash_counts(iter(batches), Sent(np.full(8, 255, np.uint8)), None, least)
    got = [h % 2**64 for b in P._often(in_order(rows), least) for h in b["h"].to_pylist()]
    assert len(got) == len(set(got)) and set(got) == {h for h, n in f.items() if n >= least}


def test_hashes_take_no_row_each():
    h = np.sort(np.random.default_rng(1).integers(0, 2**64, 500_000, np.uint64))
    rows = list(P._packs(h, np.arange(len(h)), 30))
    assert sum(r.num_rows for r in rows) <= 1 << 16 and max(r.num_rows for r in rows) <= P.BATCH
    back = [P._of_packs(r, 30) for r in rows]
    assert (np.concatenate([x for x, _ in back]) == h).all()
    assert (np.concatenate([n for _, n in back]) == np.minimum(np.arange(len(h)), 30)).all()


@pytest.mark.parametrize("packed", [10, 1 << 21])
def test_packed_spellings_add_up(monkeypatch, packed):
    monkeypatch.setattr(P, "PACKED", packed)
    batches = text_batches(6) * 3
    spelled, f = all_phrases(batches)
    every = Sent(np.full(8, 255, np.uint8))
    rows = in_order(P._count_pass(iter(batches), every, Sent(np.zeros(8, np.uint8)), True))
    got = [r for b in P._often_spelled(iter(rows), every, 9) for r in b.to_pylist()]
    want = {(*spelled[h], h, n) for h, n in f.items() if n >= 9}
    assert {(r["lang"], r["phrase"], r["h"] % 2**64, r["f"]) for r in got if r["n"]} == want
    assert all(r["n"] == len(r["phrase"].split()) and r["known"] for r in got if r["n"])
    totals = Counter()
    for h, n in f.items():
        if " " not in spelled[h][1]:
            totals[spelled[h][0]] += n
    assert {r["lang"]: r["f"] for r in got if not r["n"]} == totals
    assert len(got) == len(want) + len(totals)


@pytest.mark.parametrize("seed", range(5))
def test_pieces_left_out_hold_nothing_that_came_into_reach(seed):
    batches = text_batches(seed)
    spelled, f = all_phrases(batches)
    old = some_of(f, odds=0.6, seed=seed)
    new = old | some_of([h for h in f if f[h] < 3], odds=0.1, seed=seed)
    left_out = 0
    for words, langs, piece, names in P._stretches(iter(batches)):
        def found(keep):
            levels = P._levels(words.filter(pa.array(keep)), langs[keep], piece[keep], names, P.Filter(new), P.Filter(old))
            return Counter({h: n for _, v in levels for h, n in zip(v.h[v.wanted].tolist(), v.count[v.wanted].tolist())})

        near = P._near(words, langs, piece, names, P.Filter(new), P.Filter(old), P.Filter(new & ~old))
        left_out += int((~near).sum())
        assert found(near) == found(np.ones(len(piece), bool))
    assert left_out


def test_failures_of_the_border_need_no_pass_of_their_own(spark, monkeypatch):
    """Hashes tell which words fail, so the first pass that spells counts words and pairs, and two more the rest."""
    rows = [(i, " ".join([f"u{i} v{i} w{i} z{i}"] * 7), "en") for i in range(12)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    stored, written = P.stored, []
    monkeypatch.setattr(P, "stored", lambda df, purpose: written.append(purpose) or stored(df, purpose))
    monkeypatch.setattr(P, "SAMPLE", 1 << 40)
    assert mined(frame, least=5) == brute.collocations([(t, g) for _, t, g in rows], 5, 2000)
    assert written.count("phrase-counts") == 3 and written.count("phrase-hashes") == 1


@pytest.mark.parametrize("bits,one_in", [(1 << 8, 1 << 40), (1 << 9, 8), (1 << 10, 1 << 40)])
def test_phrases_that_a_crowded_filter_has_by_mistake_are_still_extended(spark, monkeypatch, bits, one_in):
    """A pair that an earlier filter held, but whose words it did not, was never reached then."""
    rows = [(i, " ".join([f"u{i} v{i} w{i} z{i}"] * 9), "en") for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    monkeypatch.setattr(P, "SAMPLE", one_in)
    got = P.collocations(frame, least=5, filter_bits=bits)
    want = brute.collocations([(t, g) for _, t, g in rows], 5, 2000)
    assert sorted(map(tuple, got.collect()), key=lambda r: (r[0], r[1])) == want


def test_stretches_and_a_full_filter_change_nothing(spark, monkeypatch):
    rows = texts_with_phrases(4)
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    want = brute.collocations([(t, g) for _, t, g in rows], 10, 50)
    monkeypatch.setattr(P, "CHUNK", 64)
    monkeypatch.setattr(P, "PACKED", 40)
    monkeypatch.setattr(P, "BATCH", 7)
    assert mined(frame, least=10, top=50) == want
    got = P.collocations(frame, least=10, top=50, filter_bits=1 << 15)
    assert sorted(map(tuple, got.collect()), key=lambda r: (r[0], r[1])) == want


def test_odd_texts_of_collocations(rows_of, spark):
    rows = [(1, None), (2, ""), (3, " \t . ,"), (4, LONG), (4, LONG), (None, "some words " * 40), (7, "\x00 a \x00 a " * 40)]
    assert mined(rows_of(rows)) == brute.collocations([(t, "en") for _, t in rows], 30, 2000)
    assert mined(rows_of([])) == []
    assert mined(rows_of([(1, None)])) == []


def test_scores_beyond_64_bits_are_exact(spark):
    big = 6 * 10**18
    counts = spark.createDataFrame(
        [("en", 1, "a", big), ("en", 1, "b", big + 1), ("en", 2, "a b", big - 1)], "lang string, n int, phrase string, f long"
    )
    assert P.scored_phrases(counts).first()["score"] == 2_000_000 * (big - 1) // (2 * big + 1)


# clustering

def clusters_of(frame, **how):
    got = C.with_inertia(C.clustered(frame, **how))
    return Counter(map(tuple, got.collect()))


def vectors(seed, n, dims, spread=1.0):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(5, dims))
    return [(i, (middles[i % 5] + spread * rng.normal(size=dims)).astype("float32").tolist()) for i in range(n)]


@pytest.mark.parametrize("seed,spread", [(1, 0.05), (2, 0.6), (3, 3.0)])
def test_clusters_match_brute_force(spark, seed, spread):
    rows = vectors(seed, 300, 6, spread)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert clusters_of(frame, dims=6) == brute.clusters(rows, 6)


def test_bounds_spare_distances_and_stay_exact():
    """Rows far from every edge are not measured again, and what is left out changes no assignment."""
    x = np.array([v for _, v in vectors(5, 400, 6, 0.05)])
    x = np.floor(1024 * x).astype(np.int64)
    history = [x[:5]]
    d2 = np.stack([C.squared(x, c) for c in history[0]], 1)
    cluster, seen, work = d2.argmin(1), np.zeros_like(d2), []
    for _ in range(6):
        history.append(np.stack([x[cluster == c].sum(0) // (cluster == c).sum() for c in range(5)]))
        cluster, n = C.advanced(x, cluster, d2, seen, np.array(history))
        work.append(n)
        assert (cluster == np.stack([C.squared(x, c) for c in history[-1]], 1).argmin(1)).all()
    assert work[-1] < 0.05 * x.shape[0] * 5


def test_displacement_is_taken_as_a_whole():
    """A centroid that wanders off and comes back has no drift, so nothing is measured again."""
    x = np.array([[0, 0], [100, 0]])
    history = np.array([[[0, 0], [100, 0]], [[40, 0], [100, 0]], [[0, 0], [100, 0]]])
    d2, seen = np.array([[0, 10000], [10000, 0]]), np.zeros((2, 2), int)
    cluster, work = C.advanced(x, np.array([0, 1]), d2, seen, history)
    assert cluster.tolist() == [0, 1] and work == 0


def test_ties_go_to_the_smaller_number():
    history = np.array([[[0], [10], [10]]])
    x = np.array([[5], [10]])
    d2 = np.stack([C.squared(x, c) for c in history[0]], 1)
    assert C.advanced(x, d2.argmin(1), d2, np.zeros_like(d2), history)[0].tolist() == [0, 1]


def test_odd_vectors(spark):
    good = [(i, [float(i % 3), 0.5, -1.0 / (i + 1), 0.0]) for i in range(20)]
    rows = [
        *good, *good[:3], (None, [1.0, 1.0, 1.0, 1.0]), (50, None), (51, []), (52, [1.0]), (53, [1.0, None, 1.0, 1.0]),
        (54, [float("nan")] * 4), (55, [float("inf"), 0.0, 0.0, 0.0]), (56, [0.0] * 5),
    ]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, cluster string, d2 int")
    assert clusters_of(frame, dims=4) == brute.clusters(rows, 4)


@pytest.mark.parametrize("n", [0, 1, 5, 9])
def test_few_vectors(spark, n):
    rows = vectors(7, n, 3)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert clusters_of(frame, dims=3) == brute.clusters(rows, 3)


def test_equal_vectors_leave_clusters_empty(spark):
    rows = [(i, [0.25, 0.5]) for i in range(30)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert clusters_of(frame, dims=2) == brute.clusters(rows, 2)


def test_components_too_large_are_an_error(spark):
    frame = spark.createDataFrame([(1, [1e30, 0.0])], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="not below"):
        C.clustered(frame, dims=2)


def test_query_clusters_match_brute_force(spark, sf_dir, result):
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, sf_dir, "embeddings").collect()]
    assert Counter(result("op13_clusters")) == brute.clusters(rows, 64)
