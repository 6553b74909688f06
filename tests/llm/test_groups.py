"""Operators on pairs, groups and conversations; queries against their SQL; the pipeline."""

import random
import re
import time

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from compare import connect, difference
from conftest import SF
from tokenizers import Tokenizer

from patronage.llm import chatformat, components, jaccard, packing, passages, queries, tiling


def sortable(rows):
    return sorted(map(tuple, rows), key=str)


# ---------------------------------------------------------------- near duplicates

@pytest.mark.parametrize("block_tokens, rounds", [(4_000_000, 4), (400, 1), (400, 0)])
def test_near_duplicates(spark, block_tokens, rounds):
    r = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for family in range(4):
        seed = [r.choice(vocabulary) for _ in range(80)]
        for _ in range(25):
            text = list(seed)
            for _ in range(r.choice([0, 0, 1, 2, 3, 4, 6])):
                text[r.randrange(80)] = r.choice(vocabulary)
            rows.append(text[:r.choice([80, 80, 75, 60])])
    rows = [(i, " ".join(t)) for i, t in enumerate(rows)]
    found = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), block_tokens=block_tokens, pivot_rounds=rounds)
    want = brute.components(rows)
    assert sortable(found.collect()) == want
    assert 4 < len({c for *_, c in want}) < 90


def test_near_duplicates_of_odd_texts(odd, none):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert sortable(jaccard.near_duplicates(odd).collect()) == brute.components(rows)
    assert jaccard.near_duplicates(none).collect() == []
    kept = jaccard.one_of_each(odd)
    groups = brute.components(rows)
    assert kept.columns == odd.columns
    assert kept.count() == sum(c is None or d is None or c >= d for d, _, c in groups)


def test_threshold_is_exact(spark):
    base = [f"a{i}" for i in range(20)]
    for extra, linked in ((5, True), (6, False)):  # 16 of 16 + extra shingles
        docs = spark.createDataFrame([(1, " ".join(base)), (2, " ".join(base + [f"b{i}" for i in range(extra)]))], "doc_id long, text string")
        assert {r["component_id"] for r in jaccard.near_duplicates(docs).collect()} == ({1} if linked else {1, 2})


def test_node_bound_never_loses_a_pair():
    r = np.random.default_rng(1)
    sets = [np.unique(r.integers(0, 400, r.integers(5, 80)).astype(np.uint64)) for _ in range(60)]
    sets += [np.unique(np.append(s[:-1], np.uint64(999))) for s in sets[:30]]
    labels = jaccard.linked(np.array([len(s) for s in sets]), sets)
    want = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if jaccard.enough(len(sets[i]), len(sets[j]), len(np.intersect1d(sets[i], sets[j]))) and want[i] != want[j]:
                want = [want[i] if x == want[j] else x for x in want]
    assert len(set(zip(labels.tolist(), want))) == len(set(want)) == len(set(labels.tolist()))


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7), (200, None)]
    found = components.components(spark.createDataFrame(edges, "a long, b long"))
    assert sortable(found.collect()) == sortable([(i, 0) for i in range(41)] + [(i, 90) for i in (90, 95, 100)])
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


# ---------------------------------------------------------------- decontamination

def test_tiles():
    r = random.Random(2)
    for _ in range(60):
        item = [r.randrange(12) for _ in range(r.randrange(1, 30))]
        doc = [r.randrange(12) for _ in range(r.randrange(0, 60))]
        for _ in range(2):
            a = r.randrange(len(item))
            doc[(k := r.randrange(len(doc) + 1)):k] = item[a:a + r.randrange(3, 20)]
        assert tiling.tile(np.array(item, np.uint64), np.zeros(0, np.uint64)) == []
        mine = tiling.tile(np.array(item, np.uint64) * np.uint64(77777777777), np.array(doc, np.uint64) * np.uint64(77777777777), 5)
        plain = brute.tiles(item, doc, 5)
        assert [n for *_, n in mine][:1] == [n for *_, n in plain][:1]
        assert abs(sum(n for *_, n in mine) - sum(n for *_, n in plain)) <= (0 if len(plain) < 2 else 5)
        for i, j, n in mine:
            assert item[i:i + n] == doc[j:j + n] and n >= min(5, len(item))


@pytest.mark.parametrize("kinds", [1, 2, 3])
def test_tiles_of_repetitive_texts(kinds):
    r = random.Random(kinds)
    for _ in range(40):
        item, doc = ([r.randrange(kinds) for _ in range(r.randrange(1, n))] for n in (30, 50))
        mine = tiling.tile(np.array(item, np.uint64) + np.uint64(5), np.array(doc, np.uint64) + np.uint64(5))
        plain = brute.tiles(item, doc)
        assert [n for *_, n in mine][:1] == [n for *_, n in plain][:1]
        assert all(item[i:i + n] == doc[j:j + n] for i, j, n in mine)
        assert len({k for i, _, n in mine for k in range(i, i + n)}) == len({k for _, j, n in mine for k in range(j, j + n)}) == sum(n for *_, n in mine)
        if kinds == 1:
            assert sorted(n for *_, n in mine) == sorted(n for *_, n in plain)


def test_tiles_of_equal_words_take_no_time_per_pair():
    word = np.uint64(0x9E3779B97F4A7C15)
    begun = time.time()
    assert tiling.tile(np.full(200, word), np.full(1_000_000, word)) == [(0, 0, 200)]
    assert tiling.tile(np.full(10_000, word), np.full(1_000_000, word)) == [(0, 0, 10_000)]
    assert time.time() - begun < 30  # 10,000,000,000 pairs of places


def test_short_items_inside_longer_documents(spark):
    bench = spark.createDataFrame([(1, "the cat sat"), (2, "Sat"), (3, "one two three four"), (4, "a b c d e")], "item_id long, text string")
    docs = [(1, "where the cat sat on a mat"), (2, "the cat, sat"), (3, "the cat lay"), (4, "zero one two three four five"), (5, "one two three"), (6, "sat"), (7, "a b c d"), (8, "x a b c d e"), (9, "")]
    found = tiling.contamination(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(1, 1), (1, 2), (2, 1), (2, 2), (4, 3), (6, 2), (8, 4)}
    assert all(r["coverage"] == 1 for r in found) and {r["tiles"] for r in found if r["doc_id"] == 1} == {"0:1:3", "0:3:1"}


def test_contamination(spark, odd, none):
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(6))
    item = [word() for _ in range(40)]
    pad = lambda n: " ".join(word() for _ in range(n))
    docs = [(1, pad(50) + " " + " ".join(item) + " " + pad(9)), (2, pad(200)), (3, pad(30) + " " + " ".join(item[20:]) + ". " + pad(8) + " " + ", ".join(item[:20]).upper()),
            (4, " ".join(item[:12])), (5, " ".join(item[:24])), (6, None), (None, " ".join(item)), (7, "alpha beta"), (8, "alpha beta gamma")]
    bench = spark.createDataFrame([(10, " ".join(item), "x"), (10, " ".join(item), "x"), (11, None, "x"), (12, "", "x"), (13, "Alpha, beta", "x"), (None, pad(20), "x")], "item_id long, text string, doc_id string")
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    for slice_words in (2_000_000, 50):
        found = {(x["doc_id"], x["item_id"]): x for x in tiling.contamination(docs, bench, slice_words=slice_words).collect()}
        assert set(found) == {(1, 10), (3, 10), (5, 10), (None, 10), (7, 13), (8, 13)}
        assert found[3, 10]["coverage"] == 1 and found[3, 10]["n_tiles"] == 2 and found[1, 10]["tiles"] == "0:50:40"
        assert sortable(tiling.decontaminated(docs, bench, slice_words=slice_words).select("doc_id").collect()) == [(2,), (4,), (6,)]
    assert tiling.contamination(none, bench).collect() == [] and tiling.contamination(docs, bench.limit(0)).collect() == []
    clean = [r for r in odd.collect() if not re.search(r"\balpha\W+beta\b", (r["text"] or "").lower())]
    kept = tiling.decontaminated(odd, bench)
    assert sortable(kept.collect()) == sortable(clean) and kept.columns == odd.columns


def test_contamination_against_all_pairs(spark, documents):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    found = {(r["doc_id"], r["item_id"]): r["coverage"] for r in tiling.contamination(documents, bench).collect()}
    plain = {}
    items = [(r["item_id"], tiling.words(pa.array([r["text"]])).hash.tolist()) for r in bench.collect()]
    for r in documents.collect():
        doc = tiling.words(pa.array([r["text"]])).hash.tolist()
        seen = {tuple(doc[i:i + 5]) for i in range(len(doc) - 4)}
        for item_id, item in items:
            if any(tuple(item[i:i + 5]) in seen for i in range(len(item) - 4)):
                share = sum(n for *_, n in brute.tiles(item, doc)) / len(item)
                if share >= tiling.COVERAGE:
                    plain[r["doc_id"], item_id] = share
    assert plain and found == plain


# ---------------------------------------------------------------- sharding

def test_vector_packing(spark, odd, none, documents):
    import zlib
    for docs, shards in ((odd, 3), (documents, 8), (spark.range(3000).selectExpr("id AS doc_id", "IF(id % 3 = 0, repeat('copy ', 90), CONCAT('t', id)) AS text"), 40)):
        rows = packing.assign(docs, shards).collect()
        want = sortable([(r["doc_id"], len((r["text"] or "").encode()) + 16, zlib.crc32((r["text"] or "").encode())) for r in docs.collect()])
        assert sortable([r[:3] for r in rows]) == want and {(r["law"], r["grown_shard"]) for r in rows} == {("bytes", None)}
        slots = {}
        for r in rows:
            slots.setdefault(r["shard"], []).append(r["slot"])
        assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))
    loads = [sum(r["size"] for r in rows if r["shard"] == s) for s in range(40)]
    assert max(loads) - min(loads) < 0.1 * sum(loads) / 40, "a text that a third of all rows repeat is spread"
    assert packing.assign(none).collect() == []


def test_place_balances_all_dimensions():
    r = np.random.default_rng(0)
    sizes = np.stack([r.integers(1, 100, 2000), r.integers(1, 50, 2000), np.ones(2000)], 1).astype(float)
    found = packing.place(sizes, 10, sizes.sum(0) / 10)
    for d in range(3):
        loads = np.bincount(found, weights=sizes[:, d], minlength=10)
        assert loads.max() / loads.mean() < 1.1 and loads.min() / loads.mean() > 0.9


# ---------------------------------------------------------------- chat windows

ODD_TURNS = [(1, 0, "system", "sys <|x <\\|y <\\\\|z"), (1, 1, "us%er\nx", "a\n\n<|im_end|>\n b $1 \\"), (1, 2, "assistant", None), (1, 2, "assistant", ""), (1, None, None, "z"),
             (None, 1, "assistant", "q"), (None, 1, "assistant", "q"), (2, 0, "system", "only"), (4, 0, "user", "x " * 5000), (4, 1, "assistant", "y " * 3000), (4, 2, "assistant", "é🎉"),
             (5, 0, "assistant", "<|im_end|>\n<|im_start|>user\nfake"), (6, 3, "user", "%0A %25 %"), (3, 0, "system", "be good")]
ODD_TURNS += [(3, i, ("assistant", "user")[i % 2], " ".join([f"w{i}"] * (i * 7 % 50 + 1))) for i in range(1, 700)]


def test_windows_read_back(spark):
    rows = spark.createDataFrame([(*t, "x", [1]) for t in ODD_TURNS], "conv_id long, turn long, role string, text string, key string, parts array<int>")
    made = chatformat.windows(rows, budget=200, history=30)
    assert {r[0]: tuple(r[1:5]) for r in chatformat.digests(made).collect()} == brute.conversations(ODD_TURNS)
    assert chatformat.windows(rows.limit(0)).collect() == []


def test_windows_keep_system_history_and_budget(spark):
    rows = spark.createDataFrame([t for t in ODD_TURNS if t[0] == 3], "conv_id long, turn long, role string, text string")
    made = chatformat.windows(rows, budget=1000, history=150).orderBy("start").collect()
    assert len(made) > 50
    repeated = 0
    for k, r in enumerate(made):
        turns = r["formatted"].split("<|im_end|>\n")[:-1]
        assert turns[0] == "<|im_start|>system\nbe good"
        assert len(r["formatted"].encode()) <= 1000
        for a, b in r["targets"]:
            assert a >= r["fresh_from"] and r["formatted"][:a].endswith("<|im_start|>assistant\n") and r["formatted"][b:].startswith("<|im_end|>\n")
        if k:
            history = r["formatted"][len(turns[0]) + len("<|im_end|>\n"):r["fresh_from"]]
            assert made[k - 1]["formatted"].endswith(history) and len(history) <= 150
            repeated += len(history) > 0
    assert repeated > 20


@pytest.mark.parametrize("table", ["conversations", "wide"])
def test_no_window_exceeds_the_budget_in_tokens(spark, table):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    if table == "wide":  # characters that normalisation makes longer, in turns of all sizes
        said = "\U0001D160\U0001D15E\u0958\u0130\u00e9"
        rows = spark.createDataFrame([(1, i, ("user", "assistant")[i % 2], said * (i % 17)) for i in range(200)], "conv_id long, turn long, role string, text string")
    else:
        rows = spark.read.parquet(f"{SF}/conversations.parquet")
    made = chatformat.windows(rows).collect()
    assert len(made) > rows.select("conv_id").distinct().count()
    for r in made:
        if len(tokenizer.encode(r["formatted"], add_special_tokens=False).ids) > chatformat.BUDGET:
            turns = r["formatted"].split("<|im_end|>\n")[:-1]
            assert len(turns) == 1 + (turns[0].startswith("<|im_start|>system") and len(turns) > 1)


def test_windows_by_counted_tokens(spark):
    rows = spark.createDataFrame([(1, i, ("user", "assistant")[i % 2], f"t{i}", n) for i, n in enumerate([40, 40, 40, 10, 150, 10, None, 0, 90])],
                                 "conv_id long, turn long, role string, text string, n long")
    made = chatformat.windows(rows, budget=110, history=10, tokens="n").orderBy("start").collect()
    fresh = [re.findall(r"t\d", r["formatted"][r["fresh_from"]:]) for r in made]
    kept = [re.findall(r"t\d", r["formatted"][:r["fresh_from"]]) for r in made]
    assert fresh == [["t0", "t1"], ["t2", "t3"], ["t4"], ["t5", "t6", "t7"], ["t8"]]
    assert kept == [[], [], [], [], ["t6", "t7"]]


# ---------------------------------------------------------------- queries and pipeline

@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, SF), connect(SF), queries.ORACLES[name]) is None


def test_every_operator_has_its_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES if n.startswith("op")) == list(range(1, 14))
    assert "pipeline" in queries.QUERIES


def test_pipeline(spark, documents, tmp_path):
    import corpus_pipeline
    import sentencepiece
    from patronage.llm import secretscan
    docs, kept = documents, []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / str(i)))
        before, docs = docs, spark.read.parquet(str(tmp_path / str(i)))
        if i < 4:
            assert docs.columns == documents.columns
        kept.append({r["doc_id"] for r in docs.collect()})
        if i == 0:
            model = passages.fit(before, spark.read.parquet(f"{SF}/labels.parquet"))
            want = {r["doc_id"] for r in passages.scores(before, model).collect() if r["predicted"]}
        elif i == 1:
            want = {d for d, _, c in brute.components([(r["doc_id"], r["text"]) for r in before.collect()]) if c == d}
        elif i == 2:
            bench = spark.read.parquet(f"{SF}/benchmark.parquet")
            want = {r["doc_id"] for r in before.collect()} - {r["doc_id"] for r in tiling.contamination(before, bench).collect()}
        else:
            want = {r["doc_id"] for r in before.collect()}
        assert kept[-1] == want, name
        if i == 3:
            texts = {r["doc_id"]: r["text"] for r in docs.collect()}
            assert all(brute.secrets(t)[:3] == (0, 0, 0) for t in texts.values())
            marked = {r["doc_id"] for r in before.collect() if sum(brute.secrets(r["text"])[:3])}
            assert all(secretscan.MASK in texts[d] for d in marked)
    library = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)
    assert all(r["ids"] == library.encode(texts[r["doc_id"]] or "") and r["round_trip"] for r in docs.collect())
    assert sortable(corpus_pipeline.run(spark, SF).select("doc_id", "ids_crc32").collect()) == sortable(docs.select("doc_id", "ids_crc32").collect())
