"""Operators on words and tokens of the whole corpus: languages, aligned tokenizers, spelling variants."""

import random

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from conftest import SF

from patronage.llm import alignment, languages, oracle, queries, spelling

BYTE_FILE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_FILE = public_tokenizers.path("piece_bpe_32k.model")


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


# ---------------------------------------------------------------- languages

@pytest.fixture(scope="module")
def filters(documents):
    return languages.fit(documents, queries.LANGUAGE_HELD_OUT)


def test_masks_hold_all_languages_of_each_ngram(documents, filters):
    rows = [(r["text"], r["lang"]) for r in documents.filter(f"NOT {queries.LANGUAGE_HELD_OUT}").collect()]
    want = brute.language_grams(rows, languages.ORDERS, languages.LEAST_SHARE, languages.LEAST_CONTRAST)
    assert filters.languages == sorted(want)
    every = sorted(set().union(*want.values()))
    keys = []
    for g in every:  # the hash of one n-gram
        key = np.full(1, len(g), np.uint64)
        for c in g:
            key = languages.mix(key * np.uint64(languages.BASE) + np.uint64(0 if c == "|" else ord(c)))
        keys.append(key[0])
    bits = filters.bits(filters.masks(np.array(keys, np.uint64)))
    wrong = 0
    for i, lang in enumerate(filters.languages):
        has = np.array([g in want[lang] for g in every])
        assert bits[has, i].all(), "a Bloom filter forgets nothing"
        wrong += bits[~has, i].sum()
    assert wrong <= 0.01 * bits.size and (filters.false_positives < 0.01).all()


def test_counts_are_those_of_plain_sets(documents, filters):
    rows = [(r["text"], r["lang"]) for r in documents.filter(f"NOT {queries.LANGUAGE_HELD_OUT}").collect()]
    want = brute.language_grams(rows, languages.ORDERS, languages.LEAST_SHARE, languages.LEAST_CONTRAST)
    texts = [r["text"] for r in documents.orderBy("doc_id").limit(30).collect()] + ["", "12 34", "a", "Éa b"]
    words, total, found = filters.counts(texts)
    for text, w, n, each in zip(texts, words, total, found):
        mine = brute.grams(text, languages.ORDERS)
        assert (w > 0) == any(c.isalpha() for c in text) and n == len(mine)
        for lang, c in zip(filters.languages, each):
            assert abs(c - sum(g in want[lang] for g in mine)) <= 0.01 * n + 1


def test_false_positives_are_taken_off():
    rows = np.zeros((1 << 12, 1), np.uint8)
    rows[np.random.default_rng(1).random(1 << 12) < 0.8] |= 1  # an overfull language
    rows[np.random.default_rng(2).random(1 << 12) < 0.1] |= 2
    full = languages.Filters(["x", "y"], rows, "x")
    assert full.false_positives[0] > 0.3
    texts = [" ".join("".join(random.Random(i).choices("abcdefghijklmnopqrstuvwxyz", k=8)) for i in range(4000))]
    _, total, found = full.counts(texts)
    assert (found[0] < 0.02 * total[0]).all()


def test_held_out_languages(spark, documents):
    found = queries.QUERIES["op11_language_filters"](spark, SF.replace("0.001", "0.01"))
    truth = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet").selectExpr("doc_id", "lang")
    rows = found.join(truth, "doc_id").filter("held_out").collect()
    assert len(rows) > 150 and sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_odd_texts_and_languages(spark, odd, none, filters):
    found = {(r["doc_id"], r["lang_pred"], r["score"]) for r in languages.predicted(odd, filters).collect()}
    assert languages.predicted(odd, filters).count() == odd.count()
    for doc, text in pairs(odd):
        letters = any(c.isalpha() for c in text or "")
        assert any(d == doc and (p in filters.languages if letters else (p, s) == ("und", 0.0)) for d, p, s in found)
    assert languages.predicted(none, filters).collect() == []
    empty = languages.fit(none)
    assert empty.languages == [] and {r["lang_pred"] for r in languages.predicted(odd, empty).collect()} == {"und"}
    many = spark.createDataFrame([(i, f"{chr(0x4E00 + 20 * i)}{chr(0x4E01 + 20 * i)} " * 5, f"it's\\{i:02d}") for i in range(20)], "doc_id long, text string, lang string")
    assert all(r["lang"] == r["lang_pred"] for r in languages.predicted(many, languages.fit(many)).join(many, "doc_id").collect())
    unseen = spark.createDataFrame([(1, "ЖЖЖЖ")], "doc_id long, text string")
    assert [tuple(r) for r in languages.predicted(unseen, filters).collect()] == [(1, "en", 0.0)]


def test_held_out_rows_teach_nothing(spark, documents):
    spoilt = documents.selectExpr("doc_id", f"IF({queries.LANGUAGE_HELD_OUT}, 'zzz qqq xxx', text) AS text", "lang")
    mine, other = languages.fit(documents, queries.LANGUAGE_HELD_OUT), languages.fit(spoilt, queries.LANGUAGE_HELD_OUT)
    assert (mine.rows == other.rows).all() and mine.common == other.common


# ---------------------------------------------------------------- aligned tokens

@pytest.mark.parametrize("table", ["odd", "documents", "none"])
def test_alignment(request, table):
    docs = request.getfixturevalue(table)
    rows = pairs(docs) + ([(None, None)] if table == "odd" else [])
    if table == "odd":
        docs = docs.select("doc_id", "text").union(docs.sparkSession.createDataFrame([(None, None)], "doc_id long, text string"))
    found = alignment.aligned(docs, BYTE_FILE, PIECE_FILE, chunk_bytes=50_000).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert sorted(map(tuple, found.collect()), key=str) == sorted(brute.alignments(rows, BYTE_FILE, PIECE_FILE), key=str)


def test_units_of_odd_white_space(spark):
    texts = ["a\n  b \t c  d e  　 f", "x \x1c y\x85 z \x00 w", "foo ", " ", "   ", "don't  we'll", "日本 語 ア イ", "é 🎉 x", "a▁ b", "a▁", "tail \n", "<|endoftext|> <s>", "ß ÿ ×"]
    r = random.Random(3)
    texts += ["".join(r.choices(["a", "b'", " ", "  ", "\n", "\t", " ", "é", "語", "　", "🎉", "1", ".", "\x85", "▁" if i % 9 == 0 else "x"], k=60)) for i in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = alignment.aligned(docs, BYTE_FILE, PIECE_FILE).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert sorted(map(tuple, found.collect())) == sorted(brute.alignments(list(enumerate(texts)), BYTE_FILE, PIECE_FILE))


def test_group_texts_and_link_table(spark):
    import hashlib
    rows = [(1, "hello aligned world"), (2, "hello"), (3, None), (2, "hello")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    said = {r["doc_id"]: r["groups"] for r in alignment.groups(docs, BYTE_FILE, PIECE_FILE).collect()}
    want = {r[0]: r[7] for r in brute.alignments(rows, BYTE_FILE, PIECE_FILE)}
    assert {d: hashlib.sha256(s.encode()).hexdigest() if s else "" for d, s in said.items()} == want
    links = alignment.link_counts(alignment.packed(docs, BYTE_FILE, PIECE_FILE), PIECE_FILE).collect()
    assert said[2] == "23748|6312,28709" and said[3] == ""
    assert {(r["b"], r["n"], r["best"]) for r in links if r["a"] == 23748} == {(6312, 3, True), (28709, 3, True)}
    assert len(links) == 2 + sum(len(x.split("|")[0].split(",")) + len(x.split("|")[1].split(",")) - 1 for x in said[1].split(";")[1:])


@pytest.mark.parametrize("seed", range(20))
def test_common_ends_of_any_sequences(seed):
    r = np.random.default_rng(seed)
    n = int(r.integers(1, 3000))
    dense = r.random(n) < (0.9 if seed % 2 else 0.3)
    a, b = (np.union1d(np.flatnonzero(dense | (r.random(n) < x)) + 1, [n]) for x in (0.01 * (seed % 5), 0.02))
    i, j = alignment.common_ends(a, b)
    both = np.intersect1d(a, b)
    assert (a[i] == both).all() and (b[j] == both).all() and len(i) == len(both)
    x, y = alignment.overlaps(a, b)
    assert len(x) == len(a) + len(b) - len(both)
    assert all(max(a[p - 1] if p else 0, b[q - 1] if q else 0) < min(a[p], b[q]) for p, q in zip(x, y))


def test_ends_that_do_not_meet_are_refused():
    empty = np.zeros(0, np.int64)
    assert [len(x) for x in alignment.common_ends(empty, empty)] == [0, 0]
    with pytest.raises(ValueError, match="same bytes"):
        alignment.common_ends(np.array([1, 3]), np.array([1, 2]))


# ---------------------------------------------------------------- spelling variants

def rows_of(df):
    return sorted(tuple(r) for r in df.select("word", "n", "n_near", "form", "form_n", "root").collect())


def test_variants_of_documents(spark, documents):
    docs = documents.select("doc_id", "text").union(documents.select("doc_id", "text").limit(20)).union(
        spark.createDataFrame([(None, "Straßenbau Straßenbau strasenbau straßebau"), (5, None), (6, ""), (7, "x" * 3000 + " " + "x" * 3000 + " " + "x" * 2999 + " " + "x" * 2999)], "doc_id long, text string"))
    counts = brute.vocabulary(pairs(docs))
    words = {r["word"]: r["n"] for r in spelling.vocabulary(docs).collect()}
    assert words == counts
    assert rows_of(spelling.variant_groups(docs)) == brute.variants(counts)


def test_odd_tables(odd, none):
    assert rows_of(spelling.variant_groups(odd)) == brute.variants(brute.vocabulary(pairs(odd)))
    assert spelling.variant_groups(none).collect() == []


@pytest.mark.parametrize("symbols", [1, 2, 8, 40])
def test_chains_ties_and_runs(spark, symbols):
    words = [("aaaaaaaa", 2), ("aaaaaaa", 20), ("aaaaaaab", 200), ("aaaaaabb", 2000), ("aaaaabbb", 20000), ("aaaabbbb", 200000), ("aaaaaaaaa", 2),
             ("zebrafish", 30), ("zebrafisk", 3), ("zebrafisy", 30), ("abcdefg", 2), ("bcdefgh", 2), ("ébcdefg", 2), ("èbcdefg", 19), ("0" * 30, 2)]
    df = spark.createDataFrame(words, "word string, n long")
    assert rows_of(spelling.variants(df, symbols=symbols)) == brute.variants(dict(words))


def test_neighbourhoods_are_whole_and_without_repeats():
    import itertools
    symbol = spelling._Reduced(pa.array(["abcdefgh"]), 2).symbol
    letters = "a" + "abcdefgh"[int((symbol != symbol[0]).argmax())]
    assert len(set(symbol)) == 2
    words = ["".join(w) for n in range(1, 6) for w in itertools.product(letters, repeat=n)]
    reduced = spelling._Reduced(pa.array(words), 2)
    keys = dict(zip(reduced.keys().tolist(), words))
    owner, near = reduced.neighbours()
    assert len(set(zip(owner.tolist(), near.tolist()))) == len(owner)
    found = {(words[o], keys[k]) for o, k in zip(owner.tolist(), near.tolist()) if k in keys}
    assert found == {(a, b) for a in words for b in words if a == b or brute.one_edit(a, b)}


def test_sql_of_variants(spark):
    import duckdb
    sf = SF.replace("0.001", "0.01")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = con.execute(f"SELECT word, n, n_near, form, form_n, root FROM ({oracle.ORACLES['op13_spelling_variants']})").fetchall()
    assert rows_of(queries.QUERIES["op13_spelling_variants"](spark, sf)) == sorted(want)
