from postlake import schemas
from postlake.operators.features import build_tabular_features, build_text_features


#: By hand: length, words, hour and weekday (Monday 0) in UTC, URL, question, domain, author, target.
EXPECTED = {
    11: (37, 7, 0, 4, 1, 1, "db.example.org", "dana", 1),
    12: (14, 3, 23, 6, 1, 0, "notes.example.net", "erik", 0),
    13: (26, 5, 12, 5, 0, 0, "no_url", "unknown", 1),
    14: (8, 2, 10, 4, 1, 0, "no_url", "dana", 0),
}


def test_hand_derived_features(items):
    out = build_tabular_features(items)
    assert out.columns == schemas.TABULAR_COLUMNS
    cols = schemas.FEATURE_COLUMNS + [schemas.TARGET]
    assert {r.id: tuple(r[c] for c in cols) for r in out.collect()} == EXPECTED


def test_text_columns(items):
    out = build_text_features(items)
    assert out.columns == schemas.TEXT_COLUMNS and {r.id for r in out.collect()} == set(EXPECTED)


def test_one_text_per_id_is_the_latest(spark):
    rows = [(1, "story", "a", 1700000000 + k, f"t{k}", None, "5") for k in range(5)]
    for order in (rows, rows[::-1]):
        assert [r.title for r in build_text_features(spark.createDataFrame(order, EDGE_DDL)).collect()] == ["t4"]


EDGE_DDL = "id bigint, type string, by string, time bigint, title string, url string, score string"


def test_edge_rows(spark):
    rows = [
        (10, "story", "a", 1700000000, "   ", None, "5"),          # blank title
        (11, "story", "a", 1700000000, "t", None, None),            # null score
        (12, "story", "a", 1700000000, "t", None, "abc"),           # dirty score
        (13, "story", "a", 10 ** 13, "t", None, "5"),               # time out of range
        (14, "story", "a", 1700000000, "t", None, "100"),           # threshold
        (15, "story", None, 1700000000, "t", None, "1"),            # null author
        (16, None, "a", 1700000000, "t", None, "1"),                # null type
        (17, "story", "a", 1700000000, "q? ", None, "1"),           # trailing blank after '?'
        (18, "story", "a", 1700000000, "x?\n", None, "12.7"),       # '?' before final newline
    ]
    df = spark.createDataFrame(rows, EDGE_DDL)
    tab = {r.id: r for r in build_tabular_features(df).collect()}
    assert tab[10].n_words_title == 0
    assert 11 not in tab
    assert tab[12].score == 0 and tab[12].vai_bombar == 0
    assert 13 not in tab
    assert tab[14].vai_bombar == 1
    assert tab[15].by_author == "unknown"
    assert 16 not in tab
    assert tab[17].has_question == 0
    assert tab[18].has_question == 1 and tab[18].score == 12
    txt = {r.id: r for r in build_text_features(df).collect()}
    assert 10 not in txt                      # blank title dropped from text
    assert txt[11].score == 0                 # null score is 0 in text
    assert txt[13].created_ts is None         # kept with null created_ts
    assert txt[17].title == "q?"


def test_missing_column_is_null(spark):
    df = spark.createDataFrame([(1, "story", 1700000000, "t", 3)], "id bigint, type string, time bigint, title string, score bigint")
    out = build_tabular_features(df).collect()
    assert out[0].by_author == "unknown" and out[0].domain == "no_url"
    late = spark.createDataFrame([(1, "story", "a", "t", 3)], "id bigint, type string, by string, title string, score bigint")
    assert build_tabular_features(late).count() == 0 and build_text_features(late).count() == 0


def test_dirty_time_text(spark):
    df = spark.createDataFrame([(1, "story", "a", "soon", "t", None, "5"), (2, "story", "a", "1700000000", "t", None, "5")],
                               EDGE_DDL.replace("time bigint", "time string"))
    assert [r.id for r in build_tabular_features(df).collect()] == [2]
    assert {r.id: r.created_ts is None for r in build_text_features(df).collect()} == {1: True, 2: False}
