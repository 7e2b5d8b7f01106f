"""The learnt encoder: planted synonyms, directions against numpy, its projection against SQL."""

import tracemalloc
from collections import Counter
from types import SimpleNamespace

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

from postlake.operators import latent
from postlake.operators.embed import TOKEN_PATTERN, HashedBagOfWords, encode_frame, encode_with
from postlake.operators.search import knn

PAIRS = [("car", "auto"), ("film", "movie"), ("ship", "vessel")]
AROUND = [["engine", "road", "wheel", "driver", "fuel"], ["actor", "scene", "director", "screen", "cinema"],
          ["harbour", "sailor", "ocean", "anchor", "deck"]]


def cosine(a, b):
    return float(a @ b / np.sqrt((a @ a) * (b @ b)))


def corpus(n=400, seed=0):
    """Texts of three subjects; each uses one word of its pair, never both."""
    r = np.random.default_rng(seed)
    out = []
    for k in range(n):
        s = k % 3
        words = list(r.choice(AROUND[s], 4)) + [PAIRS[s][int(r.integers(2))]] * int(r.integers(1, 3)) + [f"noise{int(r.integers(150))}" for _ in range(3)]
        out.append((k, " ".join(r.permutation(words))))
    return out + [(9001, None), (9002, ""), (9003, "?!")]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(corpus(), "id long, title string").repartition(5)


@pytest.fixture(scope="module")
def encoder(texts):
    return latent.fit(texts, dim=8, rounds=6)


def test_synonyms_are_near_and_others_far(encoder):
    hashed = HashedBagOfWords()
    for k, (a, b) in enumerate(PAIRS):
        other = PAIRS[(k + 1) % 3][0]
        va, vb, vo = encoder([a, b, other])
        assert cosine(va, vb) > 0.9 and cosine(va, vo) < 0.3, (cosine(va, vb), cosine(va, vo))
        ha, hb = hashed([a, b])
        assert cosine(ha, hb) < 0.01  # words alone can't tell


def test_a_query_finds_texts_with_the_other_word(spark, texts, encoder):
    auto = {i for i, t in corpus() if t and "auto" in t.split() and "car" not in t.split()}
    vectors = encode_with(texts, encoder.factory(spark))
    query = encode_with(spark.createDataFrame([(1, "car")], "query_id long, title string"), encoder.factory(spark))
    subject = {i for i, _ in corpus()[:400] if i % 3 == 0}
    hits = [r.id for r in knn(vectors, query, k=60).collect()]
    assert len(set(hits) & subject) >= 57 and len(set(hits) & auto) >= 15


def plain_matrix(encoder, rows):
    made = latent._Rows(encoder.terms, encoder.idf)
    term, weight, count = made([t for _, t in rows])
    a = np.zeros((len(rows), len(encoder.terms)))
    a[np.repeat(np.arange(len(rows)), count), term] = weight
    return a


def test_directions_are_the_eigenvectors_of_the_company_of_words(encoder):
    a = plain_matrix(encoder, corpus())
    c = a.T @ a
    np.fill_diagonal(c, 0)
    values, vectors = np.linalg.eigh(c)
    order = np.argsort(-np.abs(values))
    values, vectors = values[order], vectors[:, order]
    assert np.allclose(encoder.strengths[:3], values[:3], rtol=1e-3)
    found = encoder.vectors[:, :3] / encoder.strengths[:3]
    assert np.allclose(np.abs(np.diag(found.T @ vectors[:, :3])), 1, atol=1e-2)
    assert np.allclose(found.T @ found, np.eye(3), atol=1e-8)
    rows = [(t or "").split() for _, t in corpus()]
    for t, d in zip(encoder.terms, encoder.df):
        assert d == sum(t in r for r in rows)


def test_the_model_depends_on_the_texts_alone(texts, encoder):
    again = latent.fit(texts.repartition(2), dim=8, rounds=6)
    assert again.terms == encoder.terms and np.allclose(again.vectors[:, :3], encoder.vectors[:, :3], atol=1e-6)


def test_saved_model_and_its_projection_in_sql(spark, texts, encoder, workdir):
    encoder.save(spark, workdir)
    again = latent.LatentEncoder.load(spark, workdir)
    assert again.terms == encoder.terms and again.name == encoder.name and np.array_equal(again.vectors, encoder.vectors)
    con = duckdb.connect()
    con.register("texts", texts.toPandas())
    con.execute(f"CREATE VIEW terms AS SELECT * FROM read_parquet('{workdir}/terms/*.parquet')")
    con.execute(f"CREATE VIEW meta AS SELECT * FROM read_parquet('{workdir}/meta/*.parquet')")
    sql = r"""
    WITH w AS (SELECT id, unnest(regexp_extract_all(lower(coalesce(title, '')), '[\p{L}\p{N}]+')) AS term FROM texts),
    t AS (SELECT id, term, (1 + ln(count(*))) * (ln((1 + any_value(n_texts)) / (1 + any_value(n_docs))) + 1) AS weight, any_value(vector) AS v
          FROM w JOIN terms USING (term), meta GROUP BY id, term),
    p AS (SELECT id, i, sum(weight * v[i]) AS x FROM t, range(1, 9) r(i) GROUP BY id, i),
    n AS (SELECT id, sqrt(sum(x * x)) AS size FROM p GROUP BY id)
    SELECT id, list(x / size ORDER BY i) AS v FROM p JOIN n USING (id) GROUP BY id"""
    want = dict(con.execute(sql).fetchall())
    got = {r.id: r.embedding for r in encode_with(texts, again.factory(spark)).collect()}
    assert len(want) == 400 and all(np.allclose(got[i], v, atol=1e-5) for i, v in want.items())
    assert all(not any(got[i]) for i in (9001, 9002, 9003))


def test_bounds_and_empty(spark, texts):
    few = latent.fit(texts, dim=300, max_terms=20)
    assert len(few.terms) == 20 and few.dim == 20 and list(few.df) == sorted(few.df, reverse=True)
    none = latent.fit(texts.where("false"), dim=5)
    assert none([None, "car"]).tolist() == [[0.0] * 5] * 2
    blocks = latent.fit(texts.limit(60), dim=4, min_docs=1)
    assert len(blocks.terms) > 50


def test_encode_frame_takes_the_learnt_encoder(spark, texts, encoder):
    frame = texts.where("id < 20").withColumns({"url": F.lit(None).cast("string"), "score": F.lit(1), "by_author": F.lit("x"),
                                                "created_ts": F.current_timestamp()})
    out, _, report = encode_frame(frame, model_name=encoder.name, encoder_factory=encoder.factory(spark))
    assert report["vector_dim"] == 8 and {r.model_name for r in out.select("model_name").collect()} == {encoder.name}


def test_words_are_the_runs_of_the_pattern():
    r = np.random.default_rng(5)
    some = ["a", "B", "Z", "9", "_", " ", "\n", "\x00", "\x7f", "\x85", "\xa0", "-", "é", "É", "ß", "İ", "Σ", "ς", "’", "–", "\u3000", "\u0301", "中", "文",
            "𝟘", "Ⅻ", "²", "Ж", "🙂", "ﬁ", "\ud800"]
    for text in ["", "?!", "naïve–car Car", "_a_"] + ["".join(r.choice(some, r.integers(14))) for _ in range(3000)]:
        want = Counter(w for w in regex.split(TOKEN_PATTERN, text.lower()) if w)
        assert Counter(w.decode() for w in latent.words_of(text)) == want, ascii(text)


def test_vocabulary_has_no_empty_word_and_counts_a_text_once(spark):
    rows = [("-car, Car!",), ("car–auto ",), (" auto",), ("…",), ("",), (None,)]
    found = latent.vocabulary(spark.createDataFrame(rows, "title string"), "title", 10, 1).collect()
    assert [tuple(r) for r in found] == [("auto", 2), ("car", 2)]


def test_products_of_common_and_rare_words_in_little_memory(monkeypatch):
    r = np.random.default_rng(2)
    n_rows, n_terms, width = 2000, 400, 32
    a = r.random((n_rows, n_terms)) * (r.random((n_rows, n_terms)) < np.where(np.arange(n_terms) < 250, 0.5, 0.002))
    a[::7] = 0
    term, count = np.nonzero(a)[1], (a > 0).sum(1)
    assert 0 < (a[:, 250:] > 0).sum() and (count == 0).any()
    cuts = pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32))
    batch = pa.record_batch({"terms": pa.ListArray.from_arrays(cuts, pa.array(term.astype(np.int32))),
                             "weights": pa.ListArray.from_arrays(cuts, pa.array(a[a > 0]))})
    basis = r.normal(size=(n_terms, width))
    monkeypatch.setattr(latent, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    tracemalloc.start()
    made = list(latent._products(SimpleNamespace(value=basis))([batch.slice(0, 3), batch.slice(3, 0), batch.slice(3)]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    got = np.concatenate([np.frombuffer(m.column("sums")[0].as_py()).reshape(-1, width) for m in made])
    assert np.allclose(got, a.T @ (a @ basis), rtol=1e-10)
    assert peak < 0.2 * len(term) * width * 8, peak  # entries times columns never stand in one array
