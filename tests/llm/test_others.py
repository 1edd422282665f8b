"""Vectors, archives, classifiers, the pipeline."""

import base64
import hashlib
import random
import string
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from lamina.llm import graph, labelled, minhash, quality, substrings, toxicity, vectors, warc
from lamina.llm import queries as q

from .helpers import awkward, frame, text

SMALL = "/root/testdata/sf0.001"


# graph -------------------------------------------------------------------------------------------------------------


def brute_parts(edges):
    least = {x: x for e in edges for x in e}
    for _ in least:
        for a, b in edges:
            least[a] = least[b] = min(least[a], least[b])
    return least


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)] + [(200, i) for i in range(201, 230)] + [(5, 5)]
    out = {r.id: r.component for r in graph.components(spark.createDataFrame([*edges, (None, 1)], "a long, b long")).collect()}
    assert out == brute_parts([e for e in edges if e[0] != e[1]])
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


# vectors -----------------------------------------------------------------------------------------------------------


def brute_links(rows, cosine=0.95):
    unit = {}
    for i, v in rows:
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            unit[i] = np.array(v, float) / np.linalg.norm(np.array(v, float))
    ids = sorted(unit)
    edges = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1 :] if len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= cosine]
    parts = brute_parts(edges)
    return {i: (sum(i in e for e in edges), parts.get(i, i)) for i, _ in rows}


def many_vectors():
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(32).tolist()) for i in range(150)]
    for g in range(6):  # groups around a centre
        centre = rng.standard_normal(32)
        rows += [(1000 + 50 * g + i, (centre * rng.uniform(0.5, 3) + rng.standard_normal(32) * 0.12).tolist()) for i in range(12)]
    rows += [(2000 + i, rows[0][1]) for i in range(40)]  # copies
    rows += [(3000, None), (3001, []), (3002, [0.0] * 32), (3003, [None, *[1.0] * 31]), (3004, [float("nan")] * 32), (3005, [float("inf"), *[0.0] * 31]), (3006, [1.0, 2.0]), (3007, [2.0, 4.0])]
    return [(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in rows]


@pytest.mark.parametrize("block", [256, 5])
def test_links_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK", block)
    rows = many_vectors()
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in [*rows, rows[3]]], "vec_id long, embedding array<double>, weight int, hi int, slot string")
    out = vectors.linked(df).collect()
    assert len(out) == len(rows) + 1
    expected = brute_links(rows)
    found, wanted = sum(r.n_links for r in out), sum(n for n, _ in expected.values())
    assert 0.98 * wanted <= found <= wanted and sum((r.n_links, r.component_id) != expected[r.vec_id] for r in out) <= 2
    assert all(r.kept == (r.vec_id == r.component_id) for r in out)
    assert vectors.linked(df.limit(0)).count() == 0


def test_rows_that_share_a_vec_id_or_have_none(spark):
    a, b = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [(5, a), (5, b), (2, b), (3, a), (7, a), (7, a), (None, a), (None, a), (8, [0.0, 0.0, 1.0])]
    out = sorted(map(tuple, vectors.linked(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()), key=str)
    hi_lo = {tuple(v): tuple(np.frombuffer(xxhash.xxh3_128_digest(np.array(v).tobytes()), "<i8").tolist()) for v in (a, b)}
    first = min((a, b), key=lambda v: hi_lo[tuple(v)])
    alone = (5, 0, 5, True)
    if first == a:
        expected = [(5, 2, 3, False), alone, (2, 0, 2, True), (3, 2, 3, True), (7, 2, 3, False), (7, 2, 3, False)]
    else:
        expected = [alone, (5, 1, 2, False), (2, 1, 2, True), (3, 1, 3, True), (7, 1, 3, False), (7, 1, 3, False)]
    assert out == sorted([*expected, (None, 0, None, True), (None, 0, None, True), (8, 0, 8, True)], key=str)


def test_recall_at_the_threshold():
    rng = np.random.default_rng(1)
    k, tables = vectors.plan(100_000, 0.95)
    a = vectors.normalised(rng.standard_normal((300, 64)))
    side = rng.standard_normal((300, 64))
    side = vectors.normalised(side - (side * a).sum(axis=1, keepdims=True) * a)
    b = 0.951 * a + np.sqrt(1 - 0.951**2) * side
    met = (vectors.buckets(a, k, tables) == vectors.buckets(b, k, tables)).any(axis=1).mean()
    far = (vectors.buckets(a, k, tables) == vectors.buckets(side, k, tables)).any(axis=1).mean()
    assert met >= 0.97 and far < 0.05


def test_vector_query(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    out = {r.vec_id: (r.n_links, r.component_id) for r in q.op9_embedding_dedup(spark, SMALL).collect()}
    assert out == brute_links(rows)


# warc --------------------------------------------------------------------------------------------------------------


def digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


@pytest.mark.parametrize(("chunk", "least"), [(64 << 10, 0), (7, 0), (64 << 10, 4)])
def test_archives_round_trip(spark, monkeypatch, chunk, least):
    monkeypatch.setattr(warc, "CHUNK", chunk)
    real = warc.chunks
    monkeypatch.setattr(warc, "chunks", lambda *a, size=chunk: real(*a, size=size))
    rows = [(5, "http://a", "same"), (3, "http://b", "same"), (9, None, "same"), (1, "http://c x\r\ny", "äöü \U0001f600 " * 9), (2, "u", None), (4, "u", ""), (6, "u", "\r\n\r\n"), (7, "u", "abc"), (8, "v", "abc"), (8, "v", "abc"), (10, "w", "z" * 200_000), (11, "w", "z" * 200_000)]
    if chunk == 7:
        rows = [(i, u, t if t is None else t[:300]) for i, u, t in rows]
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], "page_id long, url string, html string, first int, sha1 string, record string")
    out = warc.round_trip(df, least_bytes=least).collect()
    assert len(out) == len(rows)
    bodies = {i: (t or "").encode() for i, _, t in rows}
    for r in out:
        body = bodies[r.page_id]
        first = min(i for i, b in bodies.items() if b == body) if len(body) >= least else r.page_id
        assert (r.payload_bytes, r.payload_digest) == (len(body), digest(body))
        assert (r.record_type, r.refers_to) == (("response", None) if first == r.page_id else ("revisit", first))
    assert warc.round_trip(df.limit(0)).count() == 0


def test_reader_verifies_and_chunks_join_to_a_record():
    body = memoryview(b"0123456789" * 3)
    parts = [*warc.chunks(1, "u", body, None, 8)]
    whole = b"".join(p[2] for p in parts)
    assert whole.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and whole.endswith(bytes(body) + b"\r\n\r\n") and [p[0] for p in parts] == [0, 1, 2, 3]
    assert b"WARC-Payload-Digest: sha1:" + digest(bytes(body)).encode() in whole
    reader = warc.Reader()
    with pytest.raises(ValueError):
        for _, _, data, so_far in parts:
            reader.feed(data.replace(b"456", b"x56"), so_far)
    cut = warc.Reader()
    cut.feed(parts[0][2], parts[0][3])
    with pytest.raises(ValueError):
        cut.result()
    letters = warc.Reader()
    (_, _, data, so_far), = warc.chunks(2, "u", memoryview(b"ab"), None)
    for i in range(len(data)):  # headers may be cut anywhere
        letters.held += data[i : i + 1]
    letters.feed(b"", so_far)
    assert letters.result()["payload_bytes"] == 2


def test_warc_query(spark):
    rows = {r.page_id: (r.html or "").encode() for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    out = q.op6_warc_chunks(spark, SMALL).collect()
    assert {r.page_id: (r.payload_bytes, r.payload_digest) for r in out} == {i: (len(b), digest(b)) for i, b in rows.items()}


# classifiers -------------------------------------------------------------------------------------------------------


def toxic_rows(n=240):
    rng, insults = random.Random(4), ("blockhead", "nitwit", "scoundrel")
    rows = []
    for i in range(n):
        t = text(1000 + i, 9)
        if i % 3 == 0:
            words = t.split(" ")
            words.insert(rng.randrange(len(words)), rng.choice(insults))
            t = " ".join(words)
        rows.append((t, int(i % 3 == 0)))
    return rows


@pytest.fixture(scope="module")
def toxic_model():
    return toxicity.fit(toxic_rows(), 1 / 3)


def toxic_score(model, t):
    words = [w for x in toxicity.tokens(t) if (w := toxicity.fold(x))]
    return float(model.probability(np.array([max(toxicity.margins(model, words), default=toxicity._BELOW)]))[0])


def test_toxicity_finds_plain_gapped_and_spelled_out_words(toxic_model):
    clean = text(5000, 9)
    assert toxic_score(toxic_model, clean) < 0.7 and toxic_score(toxic_model, "") < 0.7
    for word in ("blockhead", "Nitwit!!", "SCOUNDREL", "bl0ckhead", "b l o c k h e a d", "n.i.t.w.i.t", "scound-rel", "blockkhead"):
        assert toxic_score(toxic_model, f"{clean} {word} {clean}") >= 0.7, word


def inserted(w):
    return [w[:i] + c + w[i:] for i in range(1, len(w)) for c in string.ascii_lowercase]


def test_toxicity_finds_insults_with_a_letter_put_in():
    insults, rng, rows = ("clown", "stupid", "scoundrel", "nitwit", "worthless"), random.Random(6), []
    for i in range(300):
        words = text(1000 + i, 9).split(" ")
        if i % 3 == 0:
            words.insert(rng.randrange(len(words)), rng.choice(insults))
        rows.append((" ".join([*words, "closer", "stupa", "brown", "tidings"]), int(i % 3 == 0)))
    rows[1] = (rows[1][0] + " stupid", 0)  # a document that quotes an insult does not unlearn it
    model = toxicity.fit(rows, 1 / 3)
    for w in insults:  # by the kernel alone: the model holds no words
        found = [toxic_score(model, f) >= 0.7 for f in inserted(w)]
        assert toxic_score(model, w) >= 0.7 and np.mean(found) >= 0.95, (w, np.mean(found))
    assert all(toxic_score(model, w) < 0.7 for w in ("closer", "stupa", "brown", "tidings"))
    unseen = [toxicity.fold(w) for k in range(200) for w in text(90_000 + k, 9).split()]
    assert (model.probability(toxicity.margins(model, unseen)) >= 0.7).mean() < 0.001


def test_toxicity_of_the_tables_labels_finds_inserted_letters(spark):
    d = "/root/testdata/sf0.1"
    model = q.toxic_model(spark, d)
    for w in ("idiot", "stupid", "moron", "disgusting", "trash", "clown", "loser", "pathetic", "worthless"):
        assert (model.probability(toxicity.margins(model, inserted(w))) >= 0.7).mean() >= 0.9, w
    labels, docs = spark.read.parquet(f"{d}/labels.parquet").where("toxic = 0"), spark.read.parquet(f"{d}/documents.parquet")
    clean = docs.join(labels, "doc_id").select(toxicity.scorer(spark, model)("text").alias("s"))
    assert clean.where("s >= 0.7").count() <= 0.001 * clean.count()


def test_kernel_is_that_of_gapped_subsequences():
    def brute(a, b):
        def features(word):
            out, codes = {}, toxicity._codes(word)
            for i in range(len(codes)):
                for x, y, w in toxicity._WAYS:
                    if i + y < len(codes):
                        f = (codes[i], codes[i + x], codes[i + y])
                        out[f] = out.get(f, 0) + w
            return out

        fa, fb = features(a), features(b)
        norm = lambda f: np.sqrt(sum(w * w for w in f.values()))
        return sum(fa[f] * fb[f] for f in fa if f in fb) / norm(fa) / norm(fb)

    for a, b in (("nitwit", "nitwit"), ("nitwit", "nixtwit"), ("banana", "bandana"), ("aaaaaa", "aaa"), ("a", "ab")):
        assert abs(toxicity.Landmarks([b]).products([a])[0, 0] - brute(a, b)) < 1e-4
    assert toxicity.Landmarks(["x"]).products([""])[0, 0] < 1e-3
    wide = "qjxkvbzpgh" * 5 + "nitwit" + "zqxjkvbpmd" * 4
    parts = toxicity.windows(wide)
    assert all(len(x) == toxicity.WIDEST for x in parts) and any("nitwit" in x for x in parts) and parts[-1] == wide[-40:] and toxicity.windows("abc") == ["abc"]
    one = toxicity.Landmarks(["nitwit"])
    model = toxicity.Model(one.table(np.ones(1)), 0.0, 1.0, 0.0)
    assert toxicity.margins(model, [wide, "nitwit"])[1] > 0.99 and toxicity.margins(model, [wide])[0] > 0.1
    # what stands behind the first forty characters counts
    assert toxicity.margins(model, [wide[:50] + "nitwit"])[0] > toxicity.margins(model, [wide[:56].replace("nitwit", "qjxkvb")])[0] + 0.1
    assert toxicity.fold("Niiiiitwit!!") == "nitwit"


def test_toxicity_on_awkward_rows(spark, toxic_model):
    rows = [*awkward(), (70, "you nitwit")]
    out = frame(spark, rows, True).select("doc_id", toxicity.scorer(spark, toxic_model)("text").alias("s")).collect()
    assert len(out) == len(rows) and all(0 <= r.s <= 1 for r in out) and {r.doc_id for r in out if r.s >= 0.7} == {70}
    assert frame(spark, []).select(toxicity.scorer(spark, toxic_model)("text")).count() == 0
    assert toxicity.fit([("a b", 0)], 0.0).probability(np.zeros(2)).tolist() == [0.0, 0.0]


def quality_rows(n=300):
    rows = []
    for i in range(n):
        t = text(2000 + i, 9)
        bad = [t.upper().replace(" ", "!! "), t.replace(" ", "$$$ "), " | ".join(t.split()), " ".join(w for w in t.split()[:20] for _ in range(6))]
        rows.append((bad[i % 4], 0) if i % 2 else (t, 1))
    return rows


def test_quality_is_calibrated_and_learns(spark):
    rows = quality_rows()
    model = quality.fit(rows[:240], 0.8)
    found = quality.probabilities(model, [t for t, _ in rows[240:]])
    assert ((found >= 0.3) == np.array([y for _, y in rows[240:]], bool)).mean() >= 0.95
    out = frame(spark, awkward(), True).select(quality.scorer(spark, model)("text").alias("s")).collect()
    assert len(out) == len(awkward()) and all(0 <= r.s <= 1 for r in out)
    assert np.allclose(quality.probabilities(quality.fit([("a", 1)], 0.4), ["a", ""]), 0.4)
    assert frame(spark, []).select(quality.scorer(spark, model)("text")).count() == 0


def test_all_of_a_token_counts():
    assert quality.shape("a" * 64 + "!!!") != quality.shape("a" * 64 + "999") and quality.shape("aB1-" * 9) != quality.shape("aB1-" * 8)
    assert quality.words("ab " + "x" * 130) == ["ab", "x" * 64, "x" * 64, "xx"]
    model = quality.fit(quality_rows(), 0.8)
    tokens = ["%" * 64, "%" * 64 + "a" * 63 + "1", "%" * 6400 + "a" * 63 + "1"]  # what stands behind the first characters counts
    assert len({round(float(p), 12) for p in quality.probabilities(model, tokens)}) == 3


def test_samples_leave_out_the_fold(spark):
    docs = frame(spark, [(i, f"text {i}") for i in range(40)] + [(None, "n")])
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(3, 0), (None, 1), (4, None)], "doc_id long, toxic int")
    held = F.col("doc_id") % 5 == 0
    rows, share = labelled.sample(docs, labels, "toxic", held, per_class=100)
    assert sorted(int(t.split()[1]) for t, _ in rows) == [i for i in range(40) if i % 5]
    assert all(y == int(t.split()[1]) % 2 for t, y in rows) and abs(share - 0.5) < 0.1
    few, _ = labelled.sample(docs, labels, "toxic", held, per_class=3)
    assert few == labelled.sample(docs.repartition(5), labels.repartition(3), "toxic", held, per_class=3)[0] and len(few) <= 6
    assert labelled.sample(docs, labels.limit(0), "toxic", held) == ([], 0.0)
    # long documents are left out before the least hashes are taken, and a document of many rows counts once
    long = docs.unionByName(spark.range(7, 30).selectExpr("id as doc_id", "repeat('x', 500) as text")).unionByName(spark.range(5000).selectExpr("1L as doc_id", "'text 1' as text"))
    rows, _ = labelled.sample(long, labels, "toxic", held, per_class=12, longest=100)
    assert len(rows) == 24 and all(len(t) < 100 for t, _ in rows) and sum(t == "text 1" for t, _ in rows) <= 1


@pytest.mark.parametrize(("name", "label", "modulus", "fold", "least"), [("op1_quality", "quality", 5, 0, 0.9), ("op8_toxicity", "toxic", 3, 1, 0.85)])
def test_held_out_accuracy(spark, name, label, modulus, fold, least):
    d = "/root/testdata/sf0.01"
    out = q.QUERIES[name](spark, d)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"] and out.count() == spark.read.parquet(f"{d}/documents.parquet").count()
    rows = out.join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == fold) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == r[label] for r in held]) >= least


# SQL ---------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(q.ORACLE_SQL))
def test_queries_equal_their_sql(spark, name):
    d = "/root/testdata/sf0.01"
    db = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{d}/{table}.parquet'")
    said = db.sql(q.ORACLE_SQL[name])
    columns = sorted(said.columns)
    out = q.QUERIES[name](spark, d)
    assert sorted(out.columns) == columns
    assert sorted(map(tuple, out.select(columns).collect()), key=str) == sorted(said.select(", ".join(columns)).fetchall(), key=str)


# pipeline ----------------------------------------------------------------------------------------------------------


def test_pipeline_stage_by_stage(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "minhash", "substrings", "mixing", "bpe"] and corpus_pipeline.ORACLE_SQL is None
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        if name != "bpe":
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        found[name], docs = docs, spark.read.parquet(f"{tmp_path}/{name}")
        found[name + " out"] = docs
    ids = lambda n: {r.doc_id for r in found[n].collect()}
    toxic = {r.doc_id for r in q.op8_toxicity(spark, SMALL).where("predicted = 1").collect()}
    assert ids("toxicity out") == ids("toxicity") - toxic
    kept = {r.doc_id for r in minhash.near_duplicates(found["minhash"]).where("kept").collect()}
    assert ids("minhash out") == kept
    left = {r.doc_id: r.text for r in substrings.drop_repeats(found["substrings"]).collect()}
    assert {r.doc_id: r.text for r in found["substrings out"].collect()} == {i: t for i, t in left.items() if t.strip()}
    assert all(r.n_chars == len(r.text) for r in found["substrings out"].collect())
    counts = found["mixing out"].groupBy("doc_id").count().collect()
    assert {r["count"] for r in counts} <= {1, 2} and ids("mixing out") <= ids("mixing")
    assert found["bpe out"].count() == found["bpe"].count()
    for r in found["bpe out"].join(found["bpe"].dropDuplicates(["doc_id"]), "doc_id").collect():
        assert r.decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest() and len(r.ids) == r.n_tokens


def test_pipeline_on_awkward_documents(spark):
    rows = [(*r, "en", "s%d" % (i % 2), None, "more") for i, r in enumerate(awkward())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, component_id string")
    for rows in (docs, docs.limit(0)):
        now = rows
        for name, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, SMALL)
            assert name == "bpe" or now.columns == docs.columns
        assert (now.count() > 0) == (rows is docs)


def test_mixing_matches_draws_of_repeated_ids_by_source_and_size(spark):
    rows = [(i % 3 if i % 4 else None, " ".join(["w"] * (1 + i % 5 + 3 * (i % 3))), "en", "abc"[i % 3], 0) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    aims = {r.source_size: r.target for r in corpus_pipeline.mixing.mixed(docs).collect()}
    out = corpus_pipeline.mix_sources(spark, docs, SMALL).collect()
    sizes = {s: sum(len(r[1].split()) for r in rows if r[3] == s) for s in "abc"}
    assert len(set(sizes.values())) == 3 and all(abs(sum(len(r.text.split()) for r in out if r.source == s) - aims[sizes[s]]) <= 12 for s in "abc")
    given = Counter(r[:4] for r in rows)
    assert all(n <= 2 * given[r] for r, n in Counter((r.doc_id, r.text, r.lang, r.source) for r in out).items())
    hot = docs.unionByName(docs.where("doc_id = 1").limit(1).crossJoin(spark.range(5000)).select(docs.columns))
    assert abs(corpus_pipeline.mix_sources(spark, hot, SMALL).count() - 1.5 * hot.count()) < 0.4 * hot.count()
    again = corpus_pipeline.mix_sources(spark, docs.repartition(5), SMALL).collect()
    assert Counter(map(tuple, out)) == Counter(map(tuple, again))
