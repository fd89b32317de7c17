"""Tokens, packing, licences and language-model scores against brute force and libraries."""

import math
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import bpe, licenses, lm, packing

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    None, "", " ", "a", "  two  spaces ", "line\n \nend \n", "tab\tand\x0b\x1c\x85\xa0odd", "It's we'll THE'S <|endoftext|>",
    "naïve Straße 東京 🙂 é İ", "x" * 3000, "ab " * 4000, "=-" * 500, "the cat " * 3, "1234567 9.5%", "\x00\x7f",
]


def ids(packed) -> list[int]:
    return np.frombuffer(bytes(packed), "<u4").tolist()


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


@pytest.fixture
def texts(spark):
    """Texts with extra columns whose names clash with those of the operators."""
    rows = [(i, t, "x", 7, None) for i, t in enumerate(TEXTS)] + [(3, "a", "x", 7, None), (None, "no id", "y", 8, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, IDS string, Score int, kept boolean")


def test_transducer_equals_library_on_random_texts(library):
    encoder = bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    rng = random.Random(5)
    tokens = list(encoder.transducer.ranks)
    for i in range(4000):
        kind = i % 4
        n = rng.randint(1, 50)
        if kind == 0:
            text = "".join(rng.choice(" \n\t a'sretn1.") for _ in range(n))
        elif kind == 1:
            text = "".join(chr(rng.randint(1, 0x2FFF)) for _ in range(n))
        elif kind == 2:
            text = rng.choice(["a", "ab", "-", " ", "0", "é"]) * rng.randint(1, 200)
        else:
            text = b"".join(rng.choice(tokens) for _ in range(rng.randint(1, 9))).decode("utf8", "ignore")
        assert ids(encoder.encode(text)) == library.encode_ordinary(text), repr(text)


def test_transducer_is_the_same_when_its_tables_overflow(library):
    small = bpe.Transducer(bpe.read_ranks(RANKS), max_states=40, max_pairs=60)
    for text in ("unbelievable", "antidisestablishmentarianism" * 400, "aaaaaaaab" * 900):
        whole = [t for m in [text] for t in small.encode(m.encode())]
        assert whole == library.encode_ordinary(text)


def test_utf8_machine_equals_incremental_replacement():
    machine = bpe.Utf8Machine({r: t for t, r in bpe.read_ranks(RANKS).items()})
    rng = random.Random(6)
    for _ in range(3000):
        some = [rng.randrange(50256) for _ in range(rng.randint(0, 7))]
        want = b"".join(machine.tokens[i] for i in some).decode("utf8", "replace")
        assert machine.decode(some) == want
        assert "".join(machine.stream(some)) == want


def test_encode_and_decode_whole_texts(texts, library):
    encoded = bpe.encode(texts, RANKS, public_tokenizers.PATTERN)
    assert [c.lower() for c in encoded.columns] == ["doc_id", "text", "score", "kept", "ids"]
    decoded = bpe.decode(encoded, RANKS).collect()
    assert len(decoded) == texts.count()
    both = bpe.encode_and_decode(texts, RANKS, public_tokenizers.PATTERN)
    assert sorted(map(str, both.collect())) == sorted(map(str, decoded))
    for r in decoded:
        assert ids(r.ids) == library.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode() and r.decoded_valid and r.Score in (7, 8)


def test_decode_marks_broken_utf8_and_refuses_unknown_ids(spark):
    lone = bpe.read_ranks(RANKS)[b"\xc3"]
    df = spark.createDataFrame([(np.array([lone], "<u4").tobytes(),), (None,)], "ids binary")
    assert sorted((bytes(r.decoded), r.decoded_valid) for r in bpe.decode(df, RANKS).collect()) == [(b"", True), (b"\xc3", False)]
    bad = spark.createDataFrame([(np.array([4_000_000], "<u4").tobytes(),)], "ids binary")
    with pytest.raises(Exception, match="without a token"):
        bpe.decode(bad, RANKS).collect()


def test_word_ids_equal_library_and_pieces_cover_them(texts):
    tokenizer = Tokenizer.from_file(WORDS)
    tokenizer.encode_special_tokens = True
    encoded = packing.encode_words(texts, WORDS)
    want = {}
    for r in encoded.collect():
        assert ids(r.ids) == tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1]
        want[r.doc_id] = ids(r.ids)
    pieces = packing.cut_pieces(encoded.dropDuplicates(["doc_id"]), tokens=64)
    packed = packing.pack(pieces, ["doc_id", "start"], 8, tokens=64, group_docs=3).collect()
    back, sequences = defaultdict(list), defaultdict(list)
    for r in packed:
        assert r.doc_tokens == len(want[r.doc_id]) and 1 <= r.length <= 64
        back[r.doc_id].append((r.start, ids(r.piece)))
        sequences[r.sequence_id].append((r.offset, r.length))
    for doc, parts in back.items():
        assert sum((p for _, p in sorted(parts)), []) == want[doc]
    assert set(back) == set(want)
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 64


def test_first_fit_decreasing_equals_plain_search():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 5, 400):
        sizes = np.sort(rng.integers(1, 101, n))[::-1]
        free, want = [], []
        for s in sizes:
            at = next((i for i, f in enumerate(free) if f >= s), len(free))
            if at == len(free):
                free.append(100)
            want.append((at, 100 - free[at]))
            free[at] -= s
        bins, offsets = packing.first_fit_decreasing(sizes, 100)
        assert list(zip(bins.tolist(), offsets.tolist(), strict=True)) == want


def test_packing_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    pieces = packing.cut_pieces(packing.encode_words(none, WORDS))
    assert packing.pack(pieces, ["doc_id", "start"], 0).collect() == []


def test_scan_equals_comparison_with_every_template(spark):
    rng = random.Random(4)
    bodies = [t for ts in licenses.TEMPLATES.values() for t in ts]
    lines = [None, "", "\n\n", "MIT", "mit license"]
    for _ in range(150):
        words = rng.choice(bodies).split()
        for _ in range(rng.randint(0, 4)):
            words.insert(rng.randrange(len(words) + 1), rng.choice(["the", "foo", "License", "3"]))
        lines.append("\n".join(rng.choice(["free text of no licence", " ".join(words)]) for _ in range(rng.randint(1, 3))))
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")

    def best(line):
        scores = [(-licenses.dice(licenses.bigrams(line.encode()), licenses.bigrams(t.encode())), name)
                  for name, ts in licenses.TEMPLATES.items() for t in ts]
        score, name = min(scores)
        return (name, -score) if -score >= licenses.THRESHOLD else None

    n = 0
    for r in licenses.scan(df).collect():
        text = lines[r.doc_id] or ""
        parts = text.split("\n")
        want = [(i, *b) for i, line in enumerate(parts, 1) if (b := best(line))]
        if len(parts) > 1 and (b := best(text)):
            want.insert(0, (0, *b))
        assert [(m.line, m.license, m.dice) for m in r.licenses] == want
        n += len(want)
    assert n > 100


def brute_lm(texts, order, backoff, least):
    docs = [(t or "").encode().lower().split() for t in texts]
    counts = Counter(tuple(d[i : i + n]) for d in docs for n in range(1, order + 1) for i in range(len(d) - n + 1))
    total = sum(map(len, docs))

    def s(context, word):
        if not context:
            return counts[word,] / total
        if counts[*context, word] >= least:
            return counts[*context, word] / counts[context]
        return backoff * s(context[1:], word)

    return [(len(d), sum(math.log10(s(tuple(d[max(0, i - order + 1) : i]), w)) for i, w in enumerate(d))) for d in docs]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_lm_equals_brute_force(spark, order, monkeypatch):
    rng = random.Random(order)
    texts = [None, "", "  ", "The the THE"] + [" ".join(rng.choices("abcdefg", k=rng.randint(1, 60))) for _ in range(300)] + ["a b c"] * 50
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n_words int").repartition(5)
    want = brute_lm(texts, order, 0.4, 2)
    got = lm.score(df, order=order).collect()
    assert len(got) == len(texts)
    for r in got:
        n, score = want[r.doc_id]
        assert r.n_words == n and math.isclose(r.log10_score, score, rel_tol=1e-9, abs_tol=1e-9)
        assert (r.log10_per_word is None) == (n == 0)


def test_lm_registered_order_sees_long_contexts(spark):
    # the last word is told by the first one only, four words before
    texts = ["p x x x q", "r x x x s"] * 20 + ["p x x x s", "p x x x q"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    want = brute_lm(texts, 5, 0.4, 2)
    got = {r.doc_id: r.log10_score for r in lm.score(df).collect()}
    assert all(math.isclose(got[i], score, rel_tol=1e-9) for i, (_, score) in enumerate(want))
    assert got[41] > got[40] + 0.5


@pytest.mark.parametrize("order", [1, 2, 3, 5])
def test_lm_sql_follows_the_order(order):
    rng = random.Random(order)
    texts = ["", "a", "A b"] + [" ".join(rng.choices("abc", k=rng.randint(1, 40))) for _ in range(60)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    want = brute_lm(texts, order, 0.4, 2)
    for doc_id, n, score, _ in con.execute(lm.oracle(order)).fetchall():
        assert n == want[doc_id][0] and abs(score - want[doc_id][1]) < 1e-4


def test_lm_edges(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert lm.score(none).collect() == []
    odd = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b"), (2, None)], "doc_id long, text string")
    got = lm.score(odd).collect()
    assert sorted((r.doc_id or -1, r.n_words) for r in got) == [(-1, 2), (1, 2), (1, 2), (2, 0)]
    big = spark.createDataFrame([(1, "word " * 200_000)], "doc_id long, text string")
    assert lm.score(big).select(F.sum("n_words")).first()[0] == 200_000
