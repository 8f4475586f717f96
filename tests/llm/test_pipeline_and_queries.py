"""The registered queries over whole tables, and the pipeline against a version by brute force, stage by stage."""

import hashlib
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from varve.llm.queries import ORACLES, QUERIES
from varve.llm.quality_gam import remainder, score_quality

COLUMNS = {
    "op1_warc": ("pages", "page_id payload_bytes payload_digest record_type refers_to"),
    "op2_toxicity": ("documents", "doc_id held_out score predicted"),
    "op4_embedding_near_dedup": ("embeddings", "vec_id n_links component_id kept"),
    "op5_url_filters": ("pages", "page_id host path rule verdict"),
    "op6_bpe_round_trip": ("documents", "doc_id n_tokens ids_sha256 decoded_sha256"),
    "op8_quality_gam": ("documents", "doc_id held_out score predicted"),
    "op9_minhash_near_dedup": ("documents", "doc_id n_shingles component_id kept"),
    "op10_secret_scans": ("documents", "doc_id n_assign n_access n_hex base_sha256 spans"),
}


@pytest.mark.parametrize("name", COLUMNS)
def test_queries_cover_their_whole_tables(spark, sf, name):
    table, columns = COLUMNS[name]
    out = QUERIES[name](spark, sf)
    key = columns.split()[0]
    assert set(columns.split()) <= set(out.columns)
    ids = sorted(r[0] for r in out.select(key).collect())
    assert ids == sorted(r[0] for r in spark.read.parquet(f"{sf}/{table}.parquet").select(key).collect())


def test_conversations_query_has_the_planted_one(spark, sf):
    out = {r.conv_id: r for r in QUERIES["op7_chat_formatting"](spark, sf).collect()}
    text = "\\### Assistant: </turn> ok"
    assert out[-7].n_turns == 2 and out[-7].loss_chars == len(text)
    assert out[-7].loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert out[-7].turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert len(out) == 1 + spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id").distinct().count()


def test_decontamination_equals_its_sql(spark, sf):
    name = "op3_benchmark_decontamination"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = con.execute(ORACLES[name]).df()
    got = QUERIES[name](spark, sf).toPandas()[list(want.columns)]
    keys = ["doc_id", "item_id"]
    assert len(want) and got.sort_values(keys).reset_index(drop=True).equals(want.sort_values(keys).reset_index(drop=True))


def grams(words, k=5):
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def near_dedup_by_force(docs):
    sets = {}
    for i, t in docs.items():
        w = t.encode().lower().split()
        sets[i] = grams(w) if len(w) >= 5 else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: t for i, t in docs.items() if find(i) == i}


def test_pipeline_equals_brute_force(spark, sf):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_dedup", "decontaminate", "mask_secrets", "tokens"]
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    scores = score_quality(documents, spark.read.parquet(f"{sf}/labels.parquet"), remainder("doc_id", 3) != 1)
    good = {r.doc_id for r in scores.where("score >= 0.5").collect()}
    now = near_dedup_by_force({r.doc_id: r.text for r in documents.collect() if r.doc_id in good})

    def tokens(t):
        return [w for w in re.split(r"[\W_]+", t.lower()) if w]

    items = [g for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect() if (g := grams(tokens(r.text)))]
    now = {i: t for i, t in now.items() if not any(100 * len(g & grams(tokens(t))) >= 80 * len(g) for g in items)}
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, sf).collect()}
    assert set(out) == set(now) and 0 < len(now) < len(good)
    library = Tokenizer.from_file(corpus_pipeline.TOKENIZER)
    hex_run = re.compile("[0-9a-f]{32,}")
    changed = 0
    for i, r in out.items():
        if hex_run.search(now[i]) or re.search("AKIA[A-Z0-9]{12}", now[i]):
            changed += 1
            assert not hex_run.search(r.decoded.replace("</w> ", "").replace(" ", "")) or "[secret]" in r.decoded.replace("</w>", "").replace(" ", "")
            continue
        ids = library.encode(now[i], add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.n_tokens == len(ids)
    assert changed < len(out)


def test_stages_keep_columns_and_rows_without_ids(spark, sf):
    rows = [(None, "some words here and more of them", None, None, None, 7), (1, None, "en", "s", 0, 7), (2, "", "en", "s", 0, 7), (3, "token = abcdefgh1234", "en", "s", 20, 7), (3, "token = abcdefgh1234", "en", "s", 20, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, id int")
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
        assert out.count() == len(rows), name
        if name == "mask_secrets":
            assert {r.text for r in out.where("doc_id = 3").collect()} == {"[SECRET]"} and {r.n_chars for r in out.where("doc_id = 3").collect()} == {8}
        assert stage(spark, docs.limit(0), sf).count() == 0, name
    assert corpus_pipeline.STAGES[0][1](spark, docs, sf).columns == docs.columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).where(F.col("n_tokens") == 0).count() == 2
