"""Decontamination, mixing, sharding, archives, and the pipeline over them."""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from functools import reduce

import brute
import pytest
from conftest import LONG, ODD_TEXTS
from oracle import compare, duck
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import corpus_pipeline
from martloom.llm import decontaminate as D
from martloom.llm import mixing as M
from martloom.llm import queries as llm_queries
from martloom.llm import sharding as S
from martloom.llm import warc as W
from martloom.llm.tables import stored, table


@pytest.mark.parametrize("name", sorted(llm_queries.SQL))
def test_query_matches_sql(spark, sf_dir, name):
    assert compare(spark, duck(sf_dir), name, llm_queries.QUERIES[name], llm_queries.SQL[name], sf_dir) == []


BENCH = [
    (1, " ".join(f"Item{i}" for i in range(20))), (2, " ".join(f"item{i}" for i in range(5, 19))), (3, "two words"),
    (4, "solo"), (5, ""), (6, None), (None, "three little words"), (1, " ".join(f"Item{i}" for i in range(20))),
    (7, " ".join(["same"] * 15)), (10, "Straße ÉTÉ naïve"),
]
DOCS = [
    *ODD_TEXTS, (20, " ".join(f"item{i}" for i in range(12))), (21, "x " + "-".join(f"ITEM{i}" for i in range(13)) + " y"),
    (22, " ".join(f"item{i}" for i in range(20)) + " pad" * 500), (23, "two. Words; two words"), (24, "SOLO"),
    (25, " ".join(["same"] * 14)), (26, " ".join(["same"] * 40)), (27, "straße ÉtÉ NAÏVE"), (28, "three little words three little"),
    (29, "word " * 12 + "two words"), (30, LONG + "solo"),
]


@pytest.mark.parametrize("limit", [1_000, 0])
def test_contamination_of_odd_rows_by_both_joins(spark, rows_of, limit):
    bench = spark.createDataFrame([(*r, "x") for r in BENCH], "item_id long, text string, key string")
    got = D.contamination(rows_of(DOCS), bench, broadcast_windows=limit).drop("text_hash")
    assert Counter(map(tuple, got.collect())) == Counter(brute.contamination(DOCS, BENCH))


def test_uncontaminated_keeps_the_rest(spark, rows_of):
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    df = rows_of(DOCS)
    kept = D.uncontaminated(df, bench)
    bad = sum(r[-1] for r in brute.contamination(DOCS, BENCH))
    assert kept.columns == df.columns and kept.count() == len(DOCS) - bad
    assert D.uncontaminated(df, bench.limit(0)).count() == len(DOCS)
    assert D.contamination(rows_of([]), bench).collect() == []


def budgets(leaves, mix):
    """Budgets by the definition, in fractions: fill the children of a node evenly by weight up to their caps."""
    total = sum(leaves.values()) * mix.percent // 100
    weights = (mix.domains, mix.languages, mix.sources)

    def cap(prefix):
        return sum(
            t * mix.max_epochs for k, t in leaves.items()
            if k[: len(prefix)] == prefix and all(w.get(n, 1) > 0 for w, n in zip(weights, k))
        )

    def fill(prefix, budget):
        if len(prefix) == 3:
            return {prefix: budget}
        names = sorted({k[len(prefix)] for k in leaves if k[: len(prefix)] == prefix})
        open_ = {n: weights[len(prefix)].get(n, 1) for n in names if cap((*prefix, n)) and weights[len(prefix)].get(n, 1) > 0}
        given = dict.fromkeys(names, 0)
        left = budget
        while open_:
            full = [n for n, w in open_.items() if cap((*prefix, n)) <= left * w / sum(open_.values())]
            if not full:
                given |= {n: left * w / sum(open_.values()) for n, w in open_.items()}
                break
            for n in full:
                given[n] = cap((*prefix, n))
            left -= sum(given[n] for n in full)
            open_ = {n: w for n, w in open_.items() if n not in full}
        return {k: v for n in names for k, v in fill((*prefix, n), given[n]).items()}

    return fill((), min(total, cap(())))


@pytest.mark.parametrize("mix", [
    M.Mix(), M.Mix(percent=10, max_epochs=1), M.Mix(percent=300), M.Mix({"web": 1, "forum": 0}, {"en": 9}, {"src1": 5}, 90, 3),
])
def test_budgets_follow_the_tree(spark, mix):
    leaves = {
        (d, x, s): (7 * i * i + 13) % 1009 + 1
        for i, (d, x, s) in enumerate((d, x, f"src{s}") for d in ("web", "forum", "other") for x in ("en", "de", "zz") for s in range(4))
    }
    rows = [(*k, v) for k, v in leaves.items()]
    got = {tuple(r)[:3]: r["budget"] for r in M.leaf_budgets(spark.createDataFrame(rows, "domain string, language string, origin string, tokens long"), mix).collect()}
    want = budgets(leaves, mix)
    usable = [k for k in leaves if mix.domains.get(k[0], 1) and mix.languages.get(k[1], 1) and mix.sources.get(k[2], 1)]
    assert sum(got.values()) == min(sum(leaves.values()) * mix.percent // 100, sum(leaves[k] for k in usable) * mix.max_epochs)
    assert set(got) == set(leaves)
    for k, v in got.items():
        assert abs(v - want[k]) <= 3, k  # rounding of a child at each level


def test_prefixes_fit_and_could_not_be_longer(spark, sf_dir):
    rows = M.mixed_counts(table(spark, sf_dir, "documents"), M.Mix(percent=150, max_epochs=3)).collect()
    leaves = defaultdict(list)
    for r in rows:
        leaves[r["domain"], r["lang"], r["source"]].append(r)
    for members in leaves.values():
        used = sum(r["tokens"] * r["copies"] for r in members)
        assert used <= members[0]["budget"]
        least = min(r["copies"] for r in members)
        assert all(r["copies"] - least <= 1 for r in members)
    assert {r["copies"] for r in rows} >= {0, 1} or len(rows) < 50


def test_shortfall_of_a_leaf_whose_long_document_ends_the_prefix(rows_of):
    docs = rows_of([(1, "word " * 50), (2, "word"), (3, "word")])
    for seed in (7, 8):
        mix = M.Mix(percent=50, max_epochs=1, seed=seed)
        used = sum(r["tokens"] * r["copies"] for r in M.mixed_counts(docs, mix).collect())
        assert [tuple(r) for r in M.leaf_shortfalls(docs, mix).collect()] == [("reference", "en", "src1", 3, 26, used, 26 - used)]
        assert used <= 2  # the long document never fits
    assert M.leaf_shortfalls(rows_of([])).collect() == []


def test_domains_by_a_map(rows_of):
    docs = rows_of([(i, "a b c") for i in range(4)], source="src1").unionByName(rows_of([(9, "x y")], source="blog"))
    mix = M.Mix(domains={"web": 1, "other": 0}, domain_map={"blog": "web"}, percent=100)
    got = {(r["doc_id"], r["domain"], r["copies"]) for r in M.mixed_counts(docs, mix).collect()}
    assert {g for g in got if g[1] == "web"} == {(9, "web", 2)}
    assert {g[1] for g in got if g[0] != 9} <= {"other"} and not any(c for _, d, c in got if d == "other")


def test_mixed_returns_rows_as_often_as_counted(rows_of, spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("domain", F.lit("clash")).withColumn("copies", F.lit("clash"))
    mix = M.Mix(percent=120, max_epochs=2)
    counted = Counter({r["doc_id"]: r["copies"] for r in M.mixed_counts(docs, mix).collect()})
    got = M.mixed(docs, mix)
    assert got.columns == docs.columns
    assert Counter(r["doc_id"] for r in got.select("doc_id").collect()) == +counted
    odd = rows_of(ODD_TEXTS, lang=None, source=None)
    assert M.mixed_counts(odd, M.Mix(percent=100)).count() == len(ODD_TEXTS)
    assert M.mixed(odd, M.Mix(percent=100, max_epochs=1)).count() == len(ODD_TEXTS)
    assert M.mixed(rows_of([])).collect() == M.mixed_counts(rows_of([])).collect() == []


def gapless(rows, shards, n):
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    sizes = sorted(len(slots.get(s, [])) for s in range(shards))
    return sum(sizes) == n and sizes[-1] - sizes[0] <= 1 and all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_shards_of_documents(spark, sf_dir, documents, result):
    got = S.sharded_documents(table(spark, sf_dir, "documents")).collect()
    assert gapless(got, 40, len(documents)) and {r["law"] for r in got} == {"rows"}
    import zlib

    want = {i: (len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in documents}
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in got} == want
    again = S.sharded_documents(table(spark, sf_dir, "documents").repartition(5)).collect()
    assert set(map(tuple, again)) == set(map(tuple, got))


def test_shards_of_odd_rows(rows_of):
    df = rows_of(ODD_TEXTS)
    got = S.shard_rows(df, 4)
    assert sorted(got.columns) == sorted(df.columns)  # shard and slot are replaced
    assert gapless(got.collect(), 4, len(ODD_TEXTS))
    assert S.shard_rows(rows_of([]), 4).collect() == []


def test_matrix_has_exact_margins_and_the_law_of_a_shuffle(spark):
    """Margins, and over many seeds the mean and variance of one cell against the hypergeometric law."""
    blocks = spark.createDataFrame([(0, 30), (1, 50), (2, 0 + 20)], "block long, n long")
    cell = []
    for seed in range(16):
        rows = {r["block"]: r["upto"] for r in S.communication_matrix(blocks, 4, seed).collect()}
        assert [rows[b][-1] for b in range(3)] == [30, 50, 20]
        counts = [[u - v for u, v in zip(rows[b], [0, *rows[b]])] for b in range(3)]
        assert [sum(c) for c in zip(*counts)] == [25] * 4 and min(map(min, counts)) >= 0
        cell.append(counts[1][2])
    mean, variance = 12.5, 50 * 0.25 * 0.75 * 50 / 99
    assert abs(sum(cell) / 16 - mean) < 4 * math.sqrt(variance / 16)
    assert 0.2 * variance < sum((c - mean) ** 2 for c in cell) / 16 < 2.8 * variance


def test_matrix_has_the_law_of_a_shuffle_over_forty_seeds(spark):
    """Mean and variance of one cell, closer than above; all seeds are drawn in one job."""
    blocks, seeds = spark.createDataFrame([(0, 30), (1, 50), (2, 20)], "block long, n long"), range(40)
    drawn = [S.communication_matrix(blocks, 4, seed).filter("block = 1").withColumn("seed", F.lit(seed)) for seed in seeds]
    upto = {r["seed"]: r["upto"] for r in reduce(DataFrame.union, drawn).collect()}
    cell = [upto[s][2] - upto[s][1] for s in seeds]
    mean, variance = 12.5, 50 * 0.25 * 0.75 * 50 / 99
    assert abs(sum(cell) / 40 - mean) < 4 * math.sqrt(variance / 40)
    assert 0.4 * variance < sum((c - mean) ** 2 for c in cell) / 40 < 2.2 * variance


@pytest.mark.parametrize("population, good, draws", [(20, 7, 9), (5_000, 100, 300), (12, 12, 5), (10, 0, 4), (9, 3, 9)])
def test_hypergeometric_draws_have_the_law(spark, population, good, draws):
    n = 4_000
    long = lambda v: F.lit(v).cast("long")
    got = Counter(
        r[0] for r in spark.range(n).select(S.hypergeometric(long(population), long(good), long(draws), F.col("id"))).collect()
    )
    law = {
        k: math.comb(good, k) * math.comb(population - good, draws - k) / math.comb(population, draws)
        for k in range(max(0, draws + good - population), min(good, draws) + 1)
    }
    assert set(got) <= set(law)
    for k, p in law.items():
        assert abs(got[k] - n * p) <= 5 * math.sqrt(n * p * (1 - p)) + 1


PAGES = [
    (1, "http://a/ b\r\n%41", "x" * 1000), (2, None, "x" * 1000), (3, "http://c", "x" * 1000), (4, "http://d", "x" * 999), (5, "u", "x" * 999),
    (6, "u", None), (7, "u", ""), (8, "u", "é" * 500), (9, "u", "é" * 500), (None, "u", "é" * 500), (None, None, "y" * 2000), (None, "v", "y" * 2000),
    (11, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 100), (12, "u", LONG), (3, "again", "x" * 1000), (13, "\x00", "\x00" * 1200),
]


#: What no URI holds is written percent-encoded and read as every reader finds it; a percent sign stays.
URIS = {"http://a/ b\r\n%41": "http://a/%20b%0D%0A%41", "\x00": "%00"}


def test_archives_lie_where_spark_writes(spark, tmp_path):
    """A folder without a scheme belongs to the default file system of the cluster, not to an executor's disk."""
    assert W._qualified(spark, str(tmp_path)) == f"file://{tmp_path}"
    hadoop = spark._jsc.hadoopConfiguration()
    before = hadoop.get("fs.defaultFS")
    hadoop.set("fs.defaultFS", "viewfs://store/")
    hadoop.set("fs.viewfs.mounttable.store.link./shared", f"file://{tmp_path}")
    try:
        assert W._qualified(spark, "/shared/x") == "viewfs://store/shared/x"
    finally:
        hadoop.set("fs.defaultFS", before or "file:///")


def archived(spark, tmp_path, rows, **options):
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "page_id long, url string, html string, digest string, n string")
    index = W.write_archives(W.revisits(df), str(tmp_path / "w"), **options)
    return index, str(tmp_path / "w")


def test_archives_read_back(spark, tmp_path):
    index, folder = archived(spark, tmp_path, PAGES, max_bytes=2_000)
    rows = W.read_records(index, folder).collect()
    number = lambda urn: None if urn is None or "none" in urn else int(urn[10:-1])
    got = Counter((number(r["record_id"]), r["payload_bytes"], r["digest"], r["record_type"], number(r["refers_to"])) for r in rows)
    assert got == Counter(brute.archive(PAGES))
    assert Counter(r["url"] for r in rows) == Counter(URIS.get(u, u) for _, u, _ in PAGES)
    payloads = Counter(r["payload"] for r in rows if r["record_type"] == "response")
    assert payloads == Counter((h or "") for (_, _, h), b in zip(PAGES, brute.archive(PAGES)) if b[3] == "response")


@pytest.mark.parametrize("gap, block", [(0, 1), (10, 3_000), (1 << 20, 1 << 20)])
def test_selected_records_by_ranges(spark, tmp_path, gap, block):
    index, folder = archived(spark, tmp_path, [(i, f"http://h/{i}", f"page {i} " * (i % 50)) for i in range(200)])
    chosen = index.filter(F.col("url").endswith("7"))
    got = {r["url"]: r["payload"] for r in W.read_records(chosen, folder, gap=gap, block_bytes=block).collect()}
    assert got == {f"http://h/{i}": f"page {i} " * (i % 50) for i in range(200) if i % 10 == 7}


def test_no_pages(spark, tmp_path):
    index, folder = archived(spark, tmp_path, [])
    assert W.read_records(index, folder).collect() == []


def test_archive_query_matches_brute_force(spark, sf_dir, result):
    pages = [tuple(r) for r in table(spark, sf_dir, "pages").select("page_id", "url", "html").collect()]
    assert Counter(result("op7_warc")) == Counter(brute.archive(pages))


def test_archives_are_plain_gzip_members(spark, tmp_path):
    import gzip
    import pathlib

    index, folder = archived(spark, tmp_path, PAGES)
    whole = b"".join(gzip.decompress(p.read_bytes()) for p in sorted(pathlib.Path(folder, "archives").iterdir()))
    assert whole.count(b"WARC/1.1\r\nWARC-Type: ") == len(PAGES) and whole.endswith(b"\r\n\r\n")


def test_pipeline_stages_decide_as_their_operators_do(spark, sf_dir):
    """Each stage on what the one before kept, against plain restatements of its decision."""
    docs = table(spark, sf_dir, "documents")
    columns, before = docs.columns, None
    for name, stage in corpus_pipeline.STAGES:
        rows_in = {r["doc_id"]: r["text"] for r in docs.collect()}
        after = stored(stage(spark, docs, sf_dir), f"test-{name}")
        rows_out = [r["doc_id"] for r in after.select("doc_id").collect()]
        assert len(rows_out) == len(set(rows_out)) and set(rows_out) <= set(rows_in)
        if name == "near_dedup":
            want = {c for _, _, c in brute.groups([(i, brute.fingerprint(t)) for i, t in rows_in.items()])}
            assert set(rows_out) == want
        if name == "decontamination":
            bench = [tuple(r) for r in table(spark, sf_dir, "benchmark").select("item_id", "text").collect()]
            assert set(rows_out) == {r[0] for r in brute.contamination(rows_in.items(), bench) if not r[-1]}
        if name == "sharding":
            assert set(rows_out) == set(rows_in) and gapless(after.collect(), 40, len(rows_in))
            assert after.columns == [*columns, "shard", "slot"]
        else:
            assert after.columns == columns
            assert 0 < len(rows_out) < len(rows_in) or name == "toxicity"
        docs = after
    whole = corpus_pipeline.run(spark, sf_dir)
    assert Counter(map(tuple, whole.collect())) == Counter(map(tuple, docs.collect()))
