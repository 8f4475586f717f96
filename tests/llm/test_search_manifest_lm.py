"""Ranked search, the Merkle manifest and language-model scores against brute force, with the cases that tables bring."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.compare import _rows, connect
from varve.llm import merkle, ngram_lm, ranked_search
from varve.llm.queries import ORACLES, QUERIES
from varve.llm.words import word_hashes
from varve.operators.series import position_levels

NEW = ("op11_ranked_search", "op12_merkle_manifest", "op13_lm_scoring")


@pytest.mark.parametrize("name", NEW)
def test_queries_equal_their_sql(spark, sf, name):
    frame = QUERIES[name](spark, sf)
    found = connect(sf).execute(ORACLES[name])
    names = [d[0] for d in found.description]
    assert _rows(frame.columns, frame.collect()) == _rows(names, found.fetchall())


# Ranked search


def terms_of(text):
    return [t.translate({c: c + 32 for c in range(65, 91)}) for t in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def best_by_force(docs, items, k):
    counts = [(i, Counter(terms_of(t))) for i, t in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    documents, total = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    queries = defaultdict(set)
    for item, text in items:
        queries[item] |= set(terms_of(text))
    out = []
    for item, terms in queries.items():
        scores = []
        for i, c, n in counts:
            m = 50 + (50 * n * documents) // total
            s = sum(math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if c[t])
            if s > 0:
                scores.append((-s, i is None, i if i is not None else 0))
        for rank, (s, none, i) in enumerate(sorted(scores)[:k], 1):
            out.append((item, rank, None if none else i, -s))
    return sorted(out, key=repr)


def search_corpus():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)] + ["Straße", "été", "日本", "x1"]
    docs = [(i, " ".join(rng.choices(words, weights=[1 / (j + 1) for j in range(len(words))], k=rng.choice([1, 5, 40, 200])))) for i in range(700)]
    docs += [(1000 + i, docs[5][1]) for i in range(120)] + [docs[7]] * 3  # copies, and a repeated row
    docs += [(2000, None), (2001, ""), (2002, "?! -- \t"), (None, docs[9][1]), (2003, ("W1 w2-W3, " * 40_000)), (-5, "ÉTÉ été x1.x1")]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([2, 12, 60])))) for i in range(30)]
    items += [(50, docs[5][1]), (51, None), (52, "!!"), (53, "nothing known here"), (54, "w1"), (54, "w2 W399"), (55, "Été")]
    return docs, items


@pytest.mark.parametrize("k,cells", [(50, ranked_search.BLOCK_CELLS), (7, 600)])
def test_search_equals_brute_force(spark, k, cells):
    docs, items = search_corpus()
    # Further columns, with names that the operator uses inside.
    d = spark.createDataFrame([(i, t, 1, "first", 2) for i, t in docs], "doc_id long, text string, n int, first string, score int").repartition(3)
    q = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, rank int")
    out = ranked_search.best_documents(d, q, k, cells=cells)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in out.collect()), key=repr) == best_by_force(docs, items, k)


def test_search_of_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranked_search.best_documents(docs.limit(0), items).count() == 0
    assert ranked_search.best_documents(docs, items.limit(0)).count() == 0
    assert ranked_search.best_documents(docs.select("doc_id", F.lit(None).cast("string").alias("text")), items).count() == 0


def test_search_leaves_most_pairs_unscored(spark, sf):
    """Bounds from a first share of the documents let whole batches go."""
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").orderBy("doc_id").collect()]
    items = [terms_of(r.text) for r in spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet").collect()]
    place = {t: i for i, t in enumerate(sorted({t for i in items for t in i}))}
    held = [sorted({place[t] for t in i}) for i in items]
    counts = [Counter(terms_of(t)) for t in texts]
    df = Counter(t for c in counts for t in c)
    weights = np.array([math.floor(1000 * math.log((2 * len(texts) + 2) / (2 * df[t] + 1))) for t in place], dtype=np.float64)
    total = sum(sum(c.values()) for c in counts)
    known = [(i, sum(c.values()), sorted((place[t], n) for t, n in c.items() if t in place)) for i, c in enumerate(counts)]
    ids, n = np.array([x[0] for x in known]), np.array([x[1] for x in known])
    sizes = np.array([len(x[2]) for x in known])
    terms, tfs = (np.array([e[j] for x in known for e in x[2]]) for j in range(2))
    values = ranked_search._values(tfs, np.repeat(n, sizes), len(texts), total)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    order = ranked_search.document_order(bounds, terms, values * weights[terms])
    entry = np.concatenate([np.arange(bounds[i], bounds[i + 1]) for i in order])
    ids, sizes, terms, values = ids[order], sizes[order], terms[entry], values[entry]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    block = ranked_search.block_of(held, weights)
    once = ranked_search.Search(block, 10, np.zeros(len(items)))
    once.visit(ids, bounds, terms, values)
    again = ranked_search.Search(block, 10, np.array([float(s[-1]) if len(s) == 10 else 0.0 for s in once.scores]))
    again.visit(ids, bounds, terms, values)
    assert [s.tolist() for s in once.scores] == [s.tolist() for s in again.scores]
    assert again.scored < once.scored < 0.6 * len(texts) * len(items)


def test_long_texts_are_counted_by_pieces(monkeypatch):
    text = ("Ab été-x9 " * 50).encode()
    whole = ranked_search.term_counts(text)
    monkeypatch.setattr(ranked_search, "PIECE", 7)
    assert ranked_search.term_counts(text) == whole == {b"ab": 50, "été".encode(): 50, b"x9": 50}
    assert ranked_search.term_counts(b"a" * 100) == {b"a" * 100: 1}


# Merkle manifest


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def manifest_by_force(rows, change):
    def leaf(r):
        return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))

    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append((r[0] is not None, r[0] or 0, leaf(r), leaf(change(r))))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))

    def grow(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([digest(*levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
        return levels

    def path(levels, i):
        out = []
        for level in levels[:-1]:
            first = i - i % 8
            out.append(("".join(level[first:i]), "".join(level[i + 1 : first + 8])))
            i //= 8
        return out

    trees = {g: grow([x[2] for x in sorted(groups[g])]) for g in names}
    top = grow([trees[g][-1][0] for g in names])
    root = top[-1][0]
    out = []
    for place, g in enumerate(names):
        for i, (has, doc, own, claimed) in enumerate(sorted(groups[g])):
            steps = path(trees[g], i) + path(top, place)
            folded = claimed
            for left, right in steps:
                folded = digest(left, folded, right)
            out.append((doc if has else None, own, trees[g][-1][0], root, digest(*(x for s in steps for x in s)), folded, folded == root))
    return sorted(out, key=repr)


COLUMNS = "doc_id long, source string, lang string, n_chars long, text string, key string, pos long, size int"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def lowered(r):
    text = r[4]
    if text is not None and zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 3 == 0:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return (*r[:4], text)


def manifest(spark, rows):
    df = spark.createDataFrame([(*r, "k", 1, 2) for r in rows], COLUMNS).repartition(5)
    hit = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 0
    claimed = {"text": F.when(hit, merkle.ascii_lower(F.col("text"))).otherwise(F.col("text"))}
    return merkle.merkle_manifest(df, FIELDS, claimed)


def test_manifest_equals_brute_force(spark):
    rng = random.Random(5)
    ids = [*range(600), *(rng.randrange(-(1 << 62), 1 << 62) for _ in range(60)), (1 << 63) - 1, -(1 << 63), 63, 64, -1, -64, -65]
    rows = [(i, rng.choice(["a", "b", None]), "en" if i % 7 else rng.choice(["de", "é", "", None, "z"]), rng.choice([None, 0, i % 100]), rng.choice([None, "", "Ünï CÖDE K", f"Text {i}", "lower only"])) for i in ids]
    rows += [rows[3]] * 9 + [(5, "a", "en", k, "X") for k in range(9)]  # repeated rows, and others with the same id
    rows += [(None, "n", "en", k, "No id") for k in range(11)] + [(None, None, None, None, None)] * 2
    rows += [(1, "s", "alone", 1, "A")]
    rng.shuffle(rows)
    out = manifest(spark, rows)
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    found = sorted((tuple(r) for r in out.collect()), key=repr)
    assert found == manifest_by_force(rows, lowered)
    assert any(r[-1] for r in found) and not all(r[-1] for r in found)


@pytest.mark.parametrize("n", [1, 8, 9, 512, 513, 4097])
def test_manifest_at_the_edges_of_blocks(spark, n):
    rows = [(i * 3, "s", "en", i, f"T{i}") for i in range(n)]
    assert sorted((tuple(r) for r in manifest(spark, rows).collect()), key=repr) == manifest_by_force(rows, lowered)


def test_hot_ids_are_placed_by_finer_buckets(spark, monkeypatch):
    monkeypatch.setattr(merkle, "position_levels", lambda df, keys, order: position_levels(df, keys, order, 4))
    rows = [(i % 3, "s", "en", i % 5, "T") for i in range(200)]
    assert sorted((tuple(r) for r in manifest(spark, rows).collect()), key=repr) == manifest_by_force(rows, lowered)


def test_manifest_of_an_empty_table(spark):
    out = merkle.merkle_manifest(spark.createDataFrame([], COLUMNS), FIELDS)
    assert out.count() == 0 and out.columns[0] == "doc_id"


# Language model


def tokens_of(text):
    return (text or "").encode().lower().split() + [None]  # None is the end


class ByForce:
    """The automaton as dictionaries: arcs and failure arcs by history."""

    def __init__(self, texts, order):
        self.order, self.counts, self.history = order, Counter(), Counter()
        for text in texts:
            w = [None, *tokens_of(text)]
            for i in range(1, len(w)):
                for n in range(1, min(order, i + 1) + 1):
                    h = tuple(w[i - n + 1 : i])
                    self.counts[h, w[i]] += 1
                    self.history[h] += 1
        self.words = {w for h, w in self.counts if not h}
        self.total = self.history[()]

    def p(self, h, w):
        if not h:
            return (self.counts[(), w] + 0.1) / (self.total + 0.1 * (len(self.words) + 1))
        c = self.history[h]
        if not c:
            return self.p(h[1:], w)
        b = 0.8 * c**-0.1
        return (1 - b) * self.counts[h, w] / c + b * self.p(h[1:], w)

    def score(self, text):
        w = [None, *tokens_of(text)]
        return sum(math.log10(self.p(tuple(w[max(0, i - self.order + 1) : i]), w[i])) for i in range(1, len(w)))

    def base(self, text):
        return sum(math.log10(self.p((), w)) for w in tokens_of(text))


def lm_corpus():
    rng = random.Random(11)
    words = [f"v{i}" for i in range(60)]
    docs = [(i, " ".join(rng.choices(words, weights=[1 / (j + 1) for j in range(60)], k=rng.choice([0, 1, 3, 30, 300])))) for i in range(150)]
    docs += [(500, None), (501, ""), (502, " \t\n "), (None, "v1 V2 unheard"), (503, "V1\x0bv2\x0cV3"), (504, "ÀB àb ab cd")] + [docs[4]] * 3
    docs += [(505, "v1 v2 " * 20_000), (506, "x" * 50_000)]
    return docs


@pytest.mark.parametrize("order,block,entries", [(2, ngram_lm.BLOCK_TOKENS, ngram_lm.ENTRIES), (3, 500, 300), (1, 2_000, 10)])
def test_scores_equal_brute_force(spark, order, block, entries):
    docs = lm_corpus()
    teaches = [i is not None and i % 4 != 0 for i, _ in docs]
    model = ByForce([t for (_, t), s in zip(docs, teaches, strict=True) if s], order)
    df = spark.createDataFrame([(i, t, s, "b", 1) for (i, t), s in zip(docs, teaches, strict=True)], "doc_id long, text string, teach boolean, block string, n_tokens int").repartition(3)
    out = ngram_lm.score_texts(df, F.col("teach"), order=order, block_tokens=block, entries=entries)
    assert out.columns == ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    rows = sorted(out.collect(), key=lambda r: (repr(r.doc_id), r.n_tokens))
    assert len(rows) == len(docs)
    for r, (i, t) in zip(rows, sorted(docs, key=lambda d: (repr(d[0]), len(tokens_of(d[1])))), strict=True):
        w = tokens_of(t)
        assert (r.doc_id, r.n_tokens, r.n_known, r.train_tokens) == (i, len(w), sum(x in model.words for x in w), model.total)
        assert math.isclose(r.base_score, model.base(t), rel_tol=1e-9) and math.isclose(r.score, model.score(t), rel_tol=1e-9)


def test_arcs_of_a_state_sum_to_one():
    model = ByForce([t for _, t in lm_corpus()[:100]], 3)
    for h in [(), (None,), (b"v0",), (b"v1", b"v0"), (b"v59",), (b"unheard", b"v2")]:
        assert math.isclose(sum(model.p(h, w) for w in [*model.words, b"never heard"]), 1, rel_tol=1e-9)


def test_walk_takes_failure_arcs():
    hashes = np.append(word_hashes(b"a b")[0], ngram_lm.END)
    block = ngram_lm.Block(hashes, np.array([3]), np.array([True]))
    keys, counts, grams = ngram_lm._distinct(block, 2)
    machine = ngram_lm.automaton(block, grams, counts * 0, 2, 10, 5, 1)
    # Nothing is known but that a text began: one failure arc from there, and then unknown words at the root.
    assert machine.walk(0, 3) == [machine.fail[2][0], *[machine.arc[1][0]] * 3] and machine.fail[2][0] == pytest.approx(math.log10(0.8))


def test_scores_of_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert ngram_lm.score_texts(df.limit(0), F.lit(True)).count() == 0
    rows = {r.doc_id: tuple(r)[1:] for r in ngram_lm.score_texts(df, F.lit(None).cast("boolean")).collect()}
    assert rows == {1: (3, 0, 0, 0.0, 0.0), 2: (1, 0, 0, 0.0, 0.0)}


def test_held_out_texts_score_above_the_base(spark):
    rows = QUERIES["op13_lm_scoring"](spark, "/root/testdata/sf0.01").where("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)
    assert sum(r.score > r.base_score for r in rows) > 0.8 * len(rows)
