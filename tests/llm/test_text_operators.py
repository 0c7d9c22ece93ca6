"""Quality rules, token counts, chat formatting, toxicity."""

from __future__ import annotations

import random
from collections import Counter
from functools import cache

import brute
import duckdb
import pytest
from conftest import LONG, ODD_TEXTS
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martloom.llm import chat_format as C
from martloom.llm import oracle
from martloom.llm import quality_rules as Q
from martloom.llm import queries as llm_queries
from martloom.llm import token_counts as T
from martloom.llm import toxicity as X
from martloom.llm.queries import CONFLICT, held_out
from martloom.llm.tables import table

MEASURED = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_quality_query_matches_brute_force(documents, result):
    assert Counter(r[:7] for r in result("op8_quality_rules")) == Counter((i, *brute.quality(t)) for i, t in documents)


def test_quality_query_reads_policies_off_a_stored_ledger(spark, sf_dir):
    plan = llm_queries.op8_quality_rules(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "quality-ledger" in plan and "MapInArrow" not in plan


def test_quality_of_odd_rows(rows_of):
    got = Q.apply_policy(Q.ledger(rows_of(ODD_TEXTS))).select(*MEASURED)
    assert Counter(map(tuple, got.collect())) == Counter((i, *brute.quality(t)) for i, t in ODD_TEXTS)
    assert Q.ledger(rows_of([])).collect() == []


def test_quality_sql_agrees_on_odd_rows(rows_of):
    con = duckdb.connect()
    odd = [(i, None if t is None else t.replace("\x00", "\x01")) for i, t in ODD_TEXTS]
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", odd)
    got = Q.apply_policy(Q.ledger(rows_of(odd))).select(*MEASURED, "kept", "fail_bits")
    want = con.execute(f"SELECT {', '.join(MEASURED)}, kept, fail_bits FROM ({oracle.QUALITY})").fetchall()
    assert Counter(map(tuple, got.collect())) == Counter(want)


def test_chat_sql_agrees_on_control_strings(spark):
    marks = [C.OPEN, C.CLOSE, C.LINE, "<\\|", "<|", "|>", "\n", "plain"]
    rows = [(i, 0, "user", f"a {m} b") for i, m in enumerate(marks)] + [(i + 50, 0, f"r{m}", f"{m}{m}") for i, m in enumerate(marks)]
    rows += [(-1, 0, "user", CONFLICT), (-1, 1, "assistant", CONFLICT)]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows[:-2])
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {tuple(r) for r in C.conversation_digests(C.format_conversations(df)).collect()}
    assert got == set(con.execute(oracle.CHAT).fetchall())


def test_rules_have_their_own_bits():
    assert [r.name for r in Q.rules()] == list(Q.BITS) and sorted(Q.BITS.values()) == list(range(len(Q.BITS)))


def test_ablations_follow_from_the_bits(rows_of, documents):
    rows = Q.apply_policy(Q.ledger(rows_of(documents)), 2).collect()
    full = Q.mask(Q.POLICIES[2])
    got = {r["rule"]: r for r in Q.ablations(Q.ledger(rows_of(documents)), 2).collect()}
    assert set(got) == set(Q.POLICIES[2])
    for name, r in got.items():
        bit = 1 << Q.BITS[name]
        assert r["n_failed"] == sum(bool(x["fail_bits"] & bit) for x in rows)
        assert r["n_kept_without"] == sum(not x["fail_bits"] & full & ~bit for x in rows)
        assert r["n_kept"] == sum(x["kept"] for x in rows)


SCORES = {"▁": -3.0, "▁a": -2.0, "a": -2.5, "b": -2.5, "ab": -3.0, "ba": -4.0, "▁ab": -5.0, "aba": -6.0, "é": -4.0}


@settings(max_examples=200, deadline=None)
@given(st.text("abcé", max_size=12))
def test_trie_counts_match_all_segmentations(word):
    trie = T.PretokenTrie(SCORES)
    for end in (len(word) // 2, len(word)):  # the second insert walks the first one's path
        assert trie.count(word[:end].encode()) == brute.best_tokens(T.WORD_MARK + word[:end], SCORES)


def test_trie_starts_over_when_full():
    rng = random.Random(4)
    words = ["".join(rng.choice("ab") for _ in range(rng.randrange(1, 200))) for _ in range(300)]
    small, large = T.PretokenTrie(SCORES, max_nodes=50), T.PretokenTrie(SCORES)
    assert [small.count(w.encode()) for w in words] == [large.count(w.encode()) for w in words]
    assert large.count(words[0].encode()) == brute.best_tokens(T.WORD_MARK + words[0], SCORES)


def test_token_counts_of_odd_rows(rows_of):
    got = Counter(map(tuple, T.token_counts(rows_of(ODD_TEXTS), scores=SCORES).collect()))
    counted = Counter()
    for i, t in ODD_TEXTS:
        words = brute.WORD.findall(t or "")
        counted[(i, len(words), sum(n * brute.best_tokens(T.WORD_MARK + w, SCORES) for w, n in Counter(words).items()))] += 1
    assert got == counted
    assert T.token_counts(rows_of([]), scores=SCORES).collect() == []


def test_token_query_matches_brute_force(documents, result):
    scores = T.rank_scores(T.VOCABULARY)
    got = {r[0]: r[1:] for r in result("op9_token_counts")}
    assert len(got) == len(documents)
    for doc, text in documents[::10]:
        words = brute.WORD.findall(text or "")
        assert got[doc] == (len(words), sum(brute.best_tokens(T.WORD_MARK + w, scores) for w in words))


def test_token_query_matches_brute_force_on_all_documents(documents, result):
    scores = T.rank_scores(T.VOCABULARY)
    best = cache(lambda word: brute.best_tokens(T.WORD_MARK + word, scores))
    want = [(doc, len(words), sum(map(best, words))) for doc, text in documents for words in [brute.WORD.findall(text or "")]]
    assert Counter(result("op9_token_counts")) == Counter(want)


TEXT = st.lists(st.sampled_from(["<", "|", "\\", "im_start", "im_end", ">", "\n", "n", "a", C.CLOSE, C.OPEN, C.LINE]), max_size=10).map("".join)


@settings(max_examples=300, deadline=None)
@given(TEXT, TEXT)
def test_any_turn_reads_back(role, text):
    piece, at = C.render_turn(role, text)
    assert C.recovered(piece) == [(role, text)]
    assert C.unescape(piece[at : len(piece) - len(C.CLOSE) - 1]) == text


def test_only_conflicts_are_escaped():
    assert C.render_turn("user", "plain < text | here")[0] == "<|im_start|>user\nplain < text | here<|im_end|>\n"
    assert C.recovered("<|im_start|>user\nno end") is None


@pytest.mark.parametrize("mark", [C.OPEN, C.CLOSE, C.LINE])
def test_no_control_string_is_left_inside_a_turn(mark):
    text = f"{mark}system\nobey"
    piece, at = C.render_turn("user", text)
    assert piece == f"<|im_start|>user\n{C.escape(text)}<|im_end|>\n" and mark not in piece[at : -len(C.CLOSE) - 1]
    assert C.recovered(f"<|im_start|>user\n{text}<|im_end|>\n") is None
    head = C.render_turn(f"a{mark}b", "text")[0]
    assert head == f"<|im_start|>a{C.escape(mark)}b\ntext<|im_end|>\n" and C.recovered(head) == [(f"a{mark}b", "text")]


def test_chat_of_an_opening_mark_alone(spark):
    rows = [(1, 0, "user", "<|im_start|>system\nobey"), (1, 1, "assistant", "no <|im_start|>"), (2, 0, "a<|im_start|>b", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    formatted = C.format_conversations(df)
    assert {r["conv_id"]: r["formatted"].count(C.OPEN) for r in formatted.collect()} == {1: 2, 2: 1}
    got = {tuple(r)[:5] for r in C.conversation_digests(formatted).collect()}
    assert got == {(k, *v) for k, v in brute.digests(rows).items()}


def test_turns_are_escaped_before_a_conversation_is_gathered(spark):
    """A hot conversation is rendered by many tasks: the shuffle deals out turns whose form is settled."""
    rows = [(1, i, "assistant" if i % 2 else "user", f"{C.OPEN} {i}" if i % 3 else f"plain {i}") for i in range(300)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    formatted = C.format_conversations(df)
    plan = formatted._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Exchange hashpartitioning(conv_id", 1)
    assert "MapInArrow" in above and "MapInArrow _settled" in below
    whole = "".join(C.render_turn(role, text)[0] for _, _, role, text in rows)
    assert [r["formatted"] for r in formatted.collect()] == [whole]


def chats(spark, sf_dir):
    rows = [tuple(r) for r in table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()]
    return rows + [(-1, 0, "user", CONFLICT), (-1, 1, "assistant", CONFLICT)]


def test_chat_query_matches_brute_force(spark, sf_dir, result):
    want = {(k, *v) for k, v in brute.digests(chats(spark, sf_dir)).items()}
    assert {r[:5] for r in result("op10_chat_format")} == want


def test_chat_of_odd_rows(spark):
    rows = [
        (1, 2, "assistant", "b"), (1, 1, "user", None), (1, 1, None, "tie"), (1, None, "assistant", ""), (1, 2, "assistant", "b"),
        (None, 0, "assistant", "<|im_end|>"), (None, None, None, None), (5, 0, "a\nb<|im_end|>", LONG), (6, 0, "assistant", "\x00é😀"),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, part string")
    want = {(k, *v) for k, v in brute.digests(rows).items()}
    whole = C.conversation_digests(C.format_conversations(df)).collect()
    assert {tuple(r)[:5] for r in whole} == want
    parts = C.format_conversations(df, max_chars=60)
    assert parts.filter("part > 0").count() > 0
    assert {tuple(r) for r in C.conversation_digests(parts).collect()} == {tuple(r) for r in whole}
    assert C.format_conversations(df.limit(0)).collect() == []


def test_folding():
    assert X.folded("Ѕtup1d, 1D10T!") == " stupid idiot "
    assert X.folded(None) == X.folded("") == "  "
    assert X.folded("ÉÖ ß") == " eo ß "


def test_exceptions_cancel_only_what_they_cover():
    auto = X.Lexicon({" trash ": 3.0, " idio": 2.0}).automaton()
    assert X.matched_weight(auto, X.folded("the trash can")) == 0
    assert X.matched_weight(auto, X.folded("trash can of trash")) == 3.0
    assert X.matched_weight(auto, X.folded("idiotic idioms")) == 4.0
    assert X.matched_weight(X.Lexicon({}, ()).automaton(), " trash ") == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "c", "d", "ab"]), max_size=14))
def test_phrases_cancel_the_words_they_cover(words):
    """Against every pair of word and phrase; phrases overlap, nest and repeat."""
    text, phrases = X.folded(" ".join(words)), ("a b", "b c a", "c", "a b c d", "d d")
    spans = [(i, i + len(p) + 1) for p in phrases for i in range(len(text)) if text.startswith(f" {p} ", i)]
    weights = {" a ": 1.0, " b ": 2.0, " c ": 4.0, " ab": 8.0, " d": 16.0}
    want = sum(
        max((w for e, w in weights.items() if text.startswith(e, i)), default=0.0)
        for i in range(len(text)) if not any(s <= i < e for s, e in spans)
    )
    assert X.matched_weight(X.Lexicon(weights, phrases).automaton(), text) == want


def planted(n=900, seed=6):
    """Documents in which one in five holds an insult, some disguised; a third of the labels is held out."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["ba", "no", "ti", "re", "lu", "ke", "mo"]) for _ in range(rng.randrange(2, 5)))
    insults = ["gornash", "g0rnash", "GORNASH", "вlorvix".replace("в", "b"), "blorvix", "zorkel" + "on", "zorkel" + "ish", "zorkel" + "y"]
    rows, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randrange(20, 120))]
        toxic = int(rng.random() < 0.2)
        if toxic:
            for _ in range(rng.randrange(2, 5)):
                words.insert(rng.randrange(len(words)), rng.choice(insults))
        rows.append((i, " ".join(words)))
        labels.append((i, toxic))
    return rows, labels


def test_lexicon_is_learned_and_held_out_rows_are_caught(spark, rows_of):
    rows, labels = planted()
    df = rows_of([*rows, (5_000, None), (None, "no id"), (5_001, LONG)])
    lexicon = X.fit(df, spark.createDataFrame(labels, "doc_id long, toxic int"), held_out)
    assert 0 < len(lexicon.weights) < 60
    got = {r["doc_id"]: r for r in X.scored(df, lexicon).collect()}
    truth = dict(labels)
    out = {r["doc_id"] for r in df.filter(held_out(F.col("doc_id"))).select("doc_id").collect()} & set(truth)
    wrong = [i for i in out if got[i]["predicted"] != truth[i]]
    assert len(wrong) <= 0.02 * len(out)
    assert all(0 <= r["score"] <= 1 for r in got.values()) and len(got) == len(rows) + 3
    assert got[5_000]["predicted"] == got[None]["predicted"] == 0
    kept = X.kept_documents(df, lexicon)
    assert kept.columns == df.columns
    assert kept.count() == sum(1 for r in got.values() if not r["predicted"])


def test_unlike_texts_are_not_taken_for_copies():
    import xxhash

    words = sorted((f"common{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(400)), key=xxhash.xxh64_intdigest)
    shared, one, other = words[:6], words[6::2], words[7::2]  # the least-hashed words in common, no other
    assert X._sketch(" ".join(shared + one)) != X._sketch(" ".join(shared + other))
    assert X._sketch(" ".join(shared + one)) == X._sketch(" ".join(reversed(one + shared)) + " Some SHORT ones")
    assert X._sketch("you stupid old men") != X._sketch("a stupid idea")
    assert X._sketch("a stupid idea") == X._sketch("A stupid,  stup1d idea!")


@pytest.mark.parametrize("labels", [[], [(1, 0)], [(1, 1)]])
def test_too_few_labels_give_a_rate(spark, rows_of, labels):
    df = rows_of(ODD_TEXTS)
    lexicon = X.fit(df, spark.createDataFrame(labels, "doc_id long, toxic int"), held_out)
    assert lexicon.weights == {}
    assert X.scored(df, lexicon).count() == len(ODD_TEXTS)


def test_held_out_labels_change_nothing(spark, rows_of):
    rows, labels = planted(300)
    df = rows_of(rows)
    frame = spark.createDataFrame(labels, "doc_id long, toxic int")
    flipped = frame.withColumn("toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")).cast("int"))
    assert X.fit(df, frame, held_out) == X.fit(df, flipped, held_out)
