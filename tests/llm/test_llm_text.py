"""Encoding, token counts, fingerprints, chat templates and the line field."""

import hashlib
import random

import numpy as np
import public_tokenizers as tokenizers_dir
import pytest
import tiktoken
from llm_util import DOCS, SCHEMA, clashing, documents
from tokenizers import Tokenizer, models

from postlake.llm import bpe, chat, crf, ctph, unigram

RANKS = tokenizers_dir.path("byte_bpe_multi_50k.tiktoken")
PIECES = tokenizers_dir.path("piece_bpe_32k.model")
TEXTS = [*(r[1] for r in DOCS), "  lead and trail  ", "tabs\tand\r\nlines\n\n\n", "12345 67,890.5", "don't we'll I'm", "<|endoftext|>",
         "ab" * 2000, "\x00\x01 control", "e\u0301 combining", "mixed漢字kana かな", " ", "\n" * 50, "▁mark ▁ here"]


def rows_of(texts):
    return [(k, t, "en", "s", 1) for k, t in enumerate(texts)]


def test_bpe_equals_the_library(spark):
    vocab = bpe.Vocabulary(open(RANKS, "rb").read())
    own = tiktoken.Encoding("own", pat_str=tokenizers_dir.PATTERN, mergeable_ranks=vocab.ranks, special_tokens={})
    df = clashing(documents(spark, rows_of(TEXTS)))
    got = bpe.decode(bpe.encode(df, RANKS, tokenizers_dir.PATTERN), RANKS).collect()
    for r in got:
        assert r.ids == own.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()
    one = {r.doc_id: (r.ids, bytes(r.decoded)) for r in bpe.round_trip(df, RANKS, tokenizers_dir.PATTERN).collect()}
    assert one == {r.doc_id: (r.ids, bytes(r.decoded)) for r in got}
    assert bpe.encode(spark.createDataFrame([], SCHEMA), RANKS, tokenizers_dir.PATTERN).count() == 0


def test_bpe_replay_of_hard_words():
    vocab = bpe.Vocabulary(open(RANKS, "rb").read())
    own = tiktoken.Encoding("own", pat_str=tokenizers_dir.PATTERN, mergeable_ranks=vocab.ranks, special_tokens={})
    r, tokens = random.Random(3), list(vocab.tokens.values())
    words = [b"", *(b"a" * r.randint(1, 40) + bytes(r.randrange(256) for _ in range(r.randint(0, 6))) for _ in range(500)),
             *(b"".join(r.choice(tokens) for _ in range(r.randint(2, 6))) for _ in range(3000))]
    words = [w for w in words if w not in vocab.ranks]
    ids, counts = vocab.replay(words)
    for w, found in zip(words, np.split(ids, np.cumsum(counts)[:-1])):
        want = own._encode_single_piece(w) if w else []
        assert found.tolist() == want and vocab.alone(w) == want


def test_unigram_counts_equal_the_library(spark):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    vocab = [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]
    own = Tokenizer(models.Unigram(vocab, unk_id=0, byte_fallback=True))
    got = unigram.token_counts(clashing(documents(spark, rows_of(TEXTS))), PIECES).collect()
    for r in got:
        text = TEXTS[r.doc_id]
        want = len(own.encode("▁" + text.replace(" ", "▁"), add_special_tokens=False).ids) if text else 0
        assert r.n_tokens == want, text
    assert unigram.token_counts(spark.createDataFrame([], SCHEMA), PIECES).count() == 0


def test_unigram_ties_and_unknowns():
    scores = {"a": -1.0, "b": -1.0, "ab": -2.0, "abc": -4.0, "c": -2.0, "▁": -1.0}
    p = unigram.Pieces(scores, True, -4.0)
    assert p.best("ab") == (-2.0, 1)  # the longer piece starts first and wins the tie
    assert p.best("abc") == (-4.0, 1)
    assert p.best("aé") == (-1.0 - 14.0, 3) and p.count("") == (0.0, 0) and p.count(None) == (0.0, 0)
    assert unigram.Pieces(scores, False, -4.0).best("éèa")[1] == 2


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_distance():
    r = random.Random(1)
    for _ in range(400):
        a, b = ("".join(r.choice("abcd") for _ in range(r.randint(0, 70))) for _ in range(2))
        assert ctph.edit_distance(a, b) == edit(a, b)


@pytest.mark.parametrize("ranges", [1, 4, 50])
def test_edited_fingerprints(spark, ranges):
    rows = [r for r in DOCS if r[0] is not None and r != DOCS[4]]
    got = ctph.edited_fingerprints(clashing(documents(spark, rows)), ranges=ranges).orderBy("doc_id").collect()
    assert len(got) == len(rows)
    for k, (r, (i, text, *_)) in enumerate(zip(got, rows)):
        text, following = text or "", rows[(k + 1) % len(rows)][1] or ""
        cut = len(text) // 4
        new = text[:len(text) - cut] + following[:cut]
        assert (r.doc_id, r.n_chars, r.edited_sha256) == (i, len(text), hashlib.sha256(new.encode()).hexdigest())
        assert r.fingerprint == ctph.fingerprint(text) and r.edited_fingerprint == ctph.fingerprint(new)
        assert r.near_edited == ctph.likeness(r.fingerprint, r.edited_fingerprint) and 0 <= r.near_next <= 1


def test_fingerprints_of_repeats_nulls_and_none(spark):
    got = ctph.edited_fingerprints(documents(spark)).collect()
    assert len(got) == len(DOCS) and sum(r.doc_id is None for r in got) == 2
    one = ctph.edited_fingerprints(documents(spark, DOCS[:1])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert ctph.edited_fingerprints(spark.createDataFrame([], SCHEMA)).count() == 0
    assert ctph.fingerprint(None) == ctph.fingerprint("") == "3::"


def test_likeness_tells_edits_from_strangers():
    r = random.Random(4)
    word = lambda: "".join(r.choice("etaoinshrdlu") for _ in range(r.randint(2, 9)))
    near, far = [], []
    for _ in range(60):
        a, b = (" ".join(word() for _ in range(r.randint(60, 900))) for _ in range(2))
        cut = len(a) // 4
        near.append(ctph.likeness(ctph.fingerprint(a), ctph.fingerprint(a[:-cut] + b[:cut])))
        far.append(ctph.likeness(ctph.fingerprint(a), ctph.fingerprint(b)))
    assert min(near) > 0.4 and max(far) < 0.3


def render(template, **names):
    return list(chat._joined(chat.compile_template(template)(names)))


def test_template_language():
    turns = [{"role": "user", "text": "q"}, {"role": "assistant", "text": "a"}]
    assert render("{% set x = 'a' + 'b' %}{{ x | upper }}{% if 1 == 1 and not false %}y{% else %}z{% endif %}") == [("ABy", False)]
    assert render("{% for m in messages %}{{ loop.index }}{{ m['role'] if loop.first else '-' }}{% if loop.last %}!{% endif %}{% endfor %}",
                  messages=turns) == [("1user2-!", False)]
    assert render("a{% generation %}b{{ 'c' }}{% endgeneration %}d") == [("a", False), ("bc", True), ("d", False)]
    assert render("{{ missing }}{{ m.__class__ }}{{ m.text.upper }}", m=turns[0]) == []
    assert render("{% if x %}1{% elif y == 2 %}2{% else %}3{% endif %}", y=2) == [("2", False)]
    assert chat.fold(chat.parse("a{{ 'b' ~ 1 + 2 }}{% if false %}x{% endif %}c")) == ("block", [("out", ("const", "ab12c"))])
    for wrong in ("{% for m in %}", "{{ a | nothing }}", "{% if a %}", "{% import os %}", "{{ a( }}", "{{ open('x') }}"):
        with pytest.raises(chat.TemplateError):
            chat.compile_template(wrong)


def test_escapes_round_trip():
    r = random.Random(2)
    for _ in range(3000):
        t = "".join(r.choice("<|\\\nna") for _ in range(r.randint(0, 9)))
        assert chat.unescape(chat.escape(t)) == t and "<|" not in chat.escape(t)
        assert chat.unline(chat.unescape(chat.escape(chat.line(t)))) == t and "\n" not in chat.line(t)


def test_conversations_round_trip(spark):
    turns = [(1, 1, "assistant", chat.FORGED, 0), (1, 0, "user", "a\nb", 0), (2, 0, "user", None, 0), (2, None, None, "<\\|x", 0),
             (None, 0, "assistant", "no id", 0), (3, 0, "odd\nrole\\", "", 0), (3, 0, "odd\nrole\\", "", 0),
             (4, 0, "assistant", "x" * 200_000, 0), (4, 1, "assistant", "", 0)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, loss int")
    got = chat.format_conversations(df).collect()
    for conv in {t[0] for t in turns}:
        mine = sorted((r.piece, r.text, r.loss) for r in got if r.conv_id == conv)
        want = sorted(((t[1] if t[1] is not None else -1, t[2] or "", t[3] or "") for t in turns if t[0] == conv))
        assert list(chat.read_back(t for _, t, _ in mine)) == [(r, t) for _, r, t in want]
        assert "".join(chat.unescape(t) for _, t, loss in mine if loss) == "".join(t for _, r, t in want if r == "assistant")
    assert chat.format_conversations(spark.createDataFrame([], df.schema)).count() == 0


def plain_marginals(unary, links):
    """P(good) of each line by summing over all label sequences."""
    n, good, total = len(unary), np.zeros(len(unary)), 0.0
    for code in range(2**n):
        y = [code >> k & 1 for k in range(n)]
        p = np.exp(sum(u for u, v in zip(unary, y) if v) + sum(links[a][b] for a, b in zip(y, y[1:])))
        total += p
        good += p * np.array(y)
    return good / total


def test_line_scores_equal_those_of_neighbours_laid_side_by_side():
    r = np.random.default_rng(4)
    for count in ([1], [1, 1], [3, 1, 4, 1, 5]):
        count = np.array(count)
        first, own = np.concatenate([[0], np.cumsum(count)])[:-1], r.normal(size=(count.sum(), crf.N_FEATURES)).astype(np.float32)
        k = 3 * crf.N_FEATURES + 2
        field = crf.Field(r.normal(size=k), r.uniform(0.5, 2, k), r.normal(size=k), 0.3, np.zeros((2, 2)))
        want = (crf.neighbours(own, first, count) - field.mean) / field.scale @ field.weights + field.bias
        assert np.allclose(field.unary(own, first, count), want)


def test_marginals_match_enumeration():
    r = np.random.default_rng(0)
    count = np.array([3, 1, 7, 2])
    first, unary, links = np.concatenate([[0], np.cumsum(count)])[:-1], r.normal(size=13), r.normal(size=(2, 2))
    got, _, _ = crf.marginals(unary, links, first, count)
    for a, c in zip(first, count):
        assert np.allclose(got[a:a + c], plain_marginals(unary[a:a + c], links))


def test_quality_held_out_and_awkward_texts(spark):
    from conftest import SF_MID
    from pyspark.sql import functions as F
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet").select("doc_id", "quality")
    got = crf.op6(spark, SF_MID).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in got) >= 0.95 * len(got) > 50
    docs = documents(spark)
    field = crf.fit(docs, docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality")), steps=20)
    scored = crf.quality(clashing(docs), field).collect()
    assert len(scored) == len(DOCS) and all(0 <= r.score <= 1 for r in scored)
    none = crf.fit(docs, labels.where("false"))
    assert {r.score for r in crf.quality(docs, none).collect()} == {0.5}
    assert crf.quality(spark.createDataFrame([], SCHEMA), none).count() == 0
