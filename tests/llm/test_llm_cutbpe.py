"""BPE by forced boundaries against the tokenizers library."""

import hashlib
import random
import unicodedata

import numpy as np
import public_tokenizers
import pytest
from conftest import SF_SMALL
from llm_util import DOCS, clashing, documents
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from postlake.llm import cutbpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocab():
    return cutbpe.Vocabulary(open(PATH, "rb").read())


def ids(vocab, texts):
    return [np.frombuffer(p, "<u4").tolist() for p in vocab.packed(texts)]


def wanted(library, texts):
    return [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_random_texts(vocab, library):
    r = random.Random(5)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    marks = [c for c in points if unicodedata.combining(chr(c))]
    common = [ord(c) for c in "aAbBsStTrReEvVmMlLdD' 09<|>startofendtext\n\t.!éÉΣςσİıÅK가각漢字😀 "]
    texts = []
    for k in range(6000):
        s = "".join(chr(r.choice(common if (x := r.random()) < .6 else marks if x < .8 else points)) for _ in range(r.randint(0, 14)))
        texts.append(s + "<|endoftext|>" + s[:3] if k % 17 == 0 else s)
    assert ids(vocab, texts) == wanted(library, texts)


def test_code_points_of_every_class(vocab, library):
    texts = [f"a{chr(c)}1{chr(c)}{chr(c)}'s" for c in range(0, 0x110000, 7) if not 0xD800 <= c < 0xE000 and (c < 0x20000 or c % 35 == 0)]
    assert ids(vocab, texts) == wanted(library, texts)


@pytest.mark.parametrize("text", ["a" * 3000, "ab" * 5000 + "zq", "lowercaseletters" * 900, "é" * 2000, "x y " * 3000, "don't'll" * 500,
                                  "<|startoftext|>" * 40, " \t\n ", "Ǆ" * 300, "!?." * 900])
def test_long_and_odd_texts(vocab, library, monkeypatch, text):
    monkeypatch.setattr(cutbpe, "_RUN", 1000)  # runs cut before blanks
    assert ids(vocab, [text, None, "", text]) == wanted(library, [text, None, "", text])


def test_no_merge_crosses_a_cut(vocab):
    """What the cuts claim: no token holds two neighbours that were parted, and the fragments are all of the word."""
    words = ["hello", "naïve", "abc漢字", "😀😀", "zzxqj", "'re"]
    symbols, starts, heads = vocab.fragments(words)
    inside = {(a, b) for a, b in zip(*np.nonzero(vocab.inside.reshape(512, 512)))}
    word_starts = set(np.concatenate([[0], np.cumsum([len(w.encode()) for w in words])[:-1]]).tolist())
    for k in range(1, len(symbols)):
        parted = k in set(starts.tolist())
        assert parted == (k in word_starts or (symbols[k - 1], symbols[k]) not in inside)
    assert heads[0] == 0 and heads[-1] == len(starts) and any(b - a > 1 for a, b in zip(heads, heads[1:]))


def test_short_and_long_fragments_agree(vocab):
    r = np.random.default_rng(0)
    for _ in range(40):
        word = "".join(r.choice(list("etaoinsh"), int(r.integers(2, 60))))
        symbols = np.frombuffer(word.encode(), np.uint8).astype(np.int64)
        symbols[-1] += 256
        start = vocab.single[symbols]
        short, n = vocab.merge_short(start, np.array([len(start)]))
        assert short.tolist() == vocab.merge_long(start.tolist()) and n.tolist() == [len(short)]


def test_known_words_start_afresh(library, monkeypatch):
    monkeypatch.setattr(cutbpe, "_KNOWN", 50)
    vocab = cutbpe.Vocabulary(open(PATH, "rb").read())
    texts = [" ".join(f"w{k}x{j}" for j in range(30)) for k in range(20)]
    assert [ids(vocab, [t])[0] for t in texts] == wanted(library, texts) and len(vocab.known) <= 80


def test_registered_query(spark, library):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for r, tokens in zip(rows, wanted(library, [r.text for r in rows])):
        want[r.doc_id] = (len(tokens), hashlib.sha256(np.array(tokens, "<u4").tobytes()).hexdigest(),
                          hashlib.sha256(library.decode(tokens, skip_special_tokens=False).encode()).hexdigest())
    got = cutbpe.op13(spark, SF_SMALL).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want and len(got) == len(rows)


def test_awkward_rows(spark, library):
    df = clashing(documents(spark))
    done = cutbpe.decode(cutbpe.encode(df, PATH), PATH)
    assert [c for c in done.columns if c not in ("ids", "decoded")] == [c for c in df.columns if c not in ("ids", "decoded")]
    rows = done.collect()
    assert len(rows) == len(DOCS)
    for r in rows:
        (tokens,) = wanted(library, [r.text])
        assert r.ids == tokens and r.decoded == library.decode(tokens, skip_special_tokens=False)
    odd = spark.createDataFrame([(1, [5, None, 999999]), (2, None), (3, [])], "k int, ids array<int>")
    assert {r.k: r.decoded for r in cutbpe.decode(odd, PATH).collect()} == {1: library.decode([5], skip_special_tokens=False), 2: "", 3: ""}
    assert cutbpe.encode(df.where(F.lit(False)), PATH).count() == 0
