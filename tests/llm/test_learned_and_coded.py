"""SimHash, toxicity, pieces, token files, suffix arrays and the pipeline."""

import hashlib
import itertools
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lumentide.llm import graph, pieces, sais, simhash, suffixes, tokens, toxicity
from lumentide.session import shared_dir

WORDS = public_tokenizers.path("word_bpe_49k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = [(1, "The same text of a few words, twice over."), (2, None), (3, ""), (4, " \n"),
       (5, "The same text of a few words, twice over."), (5, "The same text of a few words, twice over."),
       (None, "Ünïcödé 🙂 <|endoftext|> tab\there  two  spaces\n"), (7, "x" * 5000)]


def frame(spark, texts):
    return spark.createDataFrame(
        [(i, t, "en", 7) for i, t in texts], "doc_id long, text string, lang string, score long")


# --- SimHash ----------------------------------------------------------------

def brute_components(prints, ids):
    of = {i: i for i in ids}

    def root(i):
        while of[i] != i:
            i = of[i]
        return i
    for a, b in itertools.combinations(ids, 2):
        if (prints[a] ^ prints[b]).bit_count() <= 2:
            x, y = root(a), root(b)
            of[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def test_every_near_pair_meets_at_a_home_anchor():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    flips = rng.integers(0, 64, (300, 2), dtype=np.uint64)
    y = x ^ (np.uint64(1) << flips[:, 0]) ^ (np.uint64(1) << flips[:, 1])
    (rx, cx, hx), (ry, cy, _) = simhash.anchors(x, 2), simhash.anchors(y, 2)
    homes = {r: c for r, c, h in zip(rx.tolist(), cx.tolist(), hx.tolist()) if h}
    assert len(homes) == 300 and hx.sum() == 300
    there = set(zip(ry.tolist(), cy.tolist()))
    assert all((r, c) in there for r, c in homes.items())
    assert 40 < len(rx) / 300 < 80 and len(set(zip(rx.tolist(), cx.tolist()))) == len(rx)


def test_simhash_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r["doc_id"]: r for r in simhash.simhash_dedup(docs).collect()}
    prints = {i: simhash.fingerprint(t.encode()) for i, t in docs.select("doc_id", "text").collect()}
    assert {i: int(r["fingerprint"], 16) for i, r in got.items()} == prints
    assert {i: r["component_id"] for i, r in got.items()} == brute_components(prints, sorted(prints))


def test_simhash_of_odd_texts(spark):
    got = simhash.simhash_dedup(frame(spark, ODD))
    rows = got.collect()
    assert len(rows) == len(ODD)
    assert {r["component_id"] for r in rows if r["doc_id"] in (1, 5)} == {1}
    assert {(r["fingerprint"], r["component_id"]) for r in rows if r["doc_id"] in (2, 3, 4)} == {("0" * 16, 2)}
    assert [r["component_id"] for r in rows if r["doc_id"] is None] == [None]
    kept = simhash.first_of_groups(frame(spark, ODD), got).collect()
    assert sorted((r["doc_id"] for r in kept), key=str) == [1, 2, 7, None]
    assert simhash.simhash_dedup(frame(spark, [])).count() == 0


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (500, 501)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["label"] for r in graph.connected_components(df).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(60)}, 500: 500, 501: 500}
    assert graph.connected_components(df.filter("a < 0")).count() == 0


# --- toxicity ---------------------------------------------------------------

def test_segments_are_all_maximal():
    random.seed(5)
    for _ in range(300):
        scores = [random.choice([-3, -2, -1, 1, 2, 3]) for _ in range(random.randint(1, 14))]
        expected = set()

        def split(a, b):
            best = max(((sum(scores[i:j]), -(j - i), -i, i, j) for i in range(a, b)
                        for j in range(i + 1, b + 1)), default=(0,))
            if best[0] > 0:
                i, j = best[3:]
                expected.add((i, j, best[0]))
                split(a, i)
                split(j, b)
        split(0, len(scores))
        got = {(a, b, s) for a, b, s in toxicity.segments(np.array(scores, float))}
        assert sum(s for *_, s in got) == sum(s for *_, s in expected)
        assert {s for *_, s in got} == {s for *_, s in expected}


def test_toxicity_on_held_out_documents(spark):
    random.seed(2)
    plain = [f"w{i}" for i in range(300)]
    texts, labels = [], []
    for i in range(600):
        own = random.choices(plain, k=60)
        toxic = i % 4 == 0
        if toxic:
            for _ in range(6):
                own[random.randrange(60)] = random.choice(["vilest", "rotter", "blighter"])
        texts.append((i, " ".join(own)))
        labels.append((i, int(toxic)))
    texts += [(1000, None), (1001, ""), (1002, "123 !")]
    labels += [(None, 1), (5000, None), (3, 0)]
    docs = frame(spark, texts)
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, model).withColumn(
        "held", toxicity.held_out(F.col("doc_id"))).collect()}
    assert all(r["held"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    held = [i for i, r in got.items() if r["held"] and i < 600]
    assert sum(got[i]["predicted"] == (i % 4 == 0) for i in held) >= 0.97 * len(held)
    assert got[1000]["score"] == got[1001]["score"] == got[1002]["score"] < 0.5
    assert got[0]["passages"] and not got[1000]["passages"]
    assert toxicity.toxicity(docs.limit(0), model).count() == 0


def test_log_odds_of_tokens_come_from_nested_beginnings(spark):
    counts = {b"abc*": (40, 10), b"abcd*": (10, 9), b"abcde": (4, 8), b"abcdx": (6, 1),
              b"abq": (3, 3), b"xyz": (43, 0), b"abcz": (30, 1)}
    counted = spark.createDataFrame(
        [(bytearray(t), *n) for t, n in counts.items()], "token binary, clean long, toxic long")
    prior = 2.0
    words = [n for t, n in counts.items() if not t.endswith(b"*")]
    n0, n1 = (sum(n[i] for n in words) for i in (0, 1))

    def share(*rings):
        q = n1 / (n0 + n1)
        for clean, toxic in rings:
            q = (toxic + prior * q) / (clean + toxic + prior)
        return math.log(q / (1 - q)) - math.log(n1 / n0)
    expected = {
        b"abc*": share((40, 10)), b"abcd*": share((30, 1), (10, 9)),
        b"abcde": share((30, 1), (6, 1), (4, 8)), b"abcdx": share((30, 1), (4, 8), (6, 1)),
        b"abq": share((3, 3)), b"xyz": share((43, 0)), b"abcz": share((10, 9), (30, 1))}
    got = {bytes(r["token"]): r["d"] for r in toxicity.token_log_odds(counted, prior, 0.0).collect()}
    assert got == pytest.approx(expected, rel=1e-12)
    begins = {b"abcd*": share((40, 10)), b"abcz": share((40, 10)), b"abcde": expected[b"abcd*"],
              b"abcdx": expected[b"abcd*"]}
    few = toxicity.token_log_odds(counted, prior, 0.25).collect()
    assert {bytes(r["token"]) for r in few} == {
        t for t, d in expected.items() if abs(d - begins.get(t, 0.0)) > 0.25}
    scorer = toxicity.Scorer({b"abc*": 1.0, b"abcde": 2.0})
    assert [scorer.score(w) for w in (b"abcde", b"abcdef", b"abc", b"zz")] == [2.0, 1.0, 0.0, 0.0]


def test_mild_words_add_up_to_a_passage_but_not_over_a_long_text(spark):
    """No word is decisive; six of the mild ones in a row are."""
    random.seed(4)
    names = ["".join(x) for x in itertools.product("bdgklmnprst", "aeiou", "bdgklmnprst")]
    random.shuffle(names)
    plain, mild = names[:200], names[200:240]
    texts, labels = [], []
    for i in range(900):
        toxic, own = i % 3 == 0, random.choices(plain, k=80)
        if toxic:
            own[30:38] = random.choices(mild, k=8)
        else:
            for at in range(0, 80, 27):  # the same words, but apart
                own[at] = random.choice(mild)
        texts.append((i, " ".join(own)))
        labels.append((i, int(toxic)))
    docs = frame(spark, texts)
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    scorer = toxicity.Scorer(model.log_odds)
    scores = [scorer.score(w.encode()) for w in mild]
    assert sum(s > 0 for s in scores) > 30 and max(scores) < math.log(20)
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, model).collect()}
    held = [i for i in got if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(got[i]["predicted"] == (i % 3 == 0) for i in held) >= 0.95 * len(held)
    found = max(got[3]["passages"], key=lambda p: p["score"])
    assert 28 <= found["begin"] <= 32 and 36 <= found["end"] <= 40


def test_words_of_scripts_without_spaces():
    assert toxicity.words_of("Ein Café".encode()) == ["ein".encode(), "café".encode()]
    assert [w.decode() for w in toxicity.words_of("abc日本語x — ไทย".encode())] == [
        "abc", "日本", "本語", "語", "x", "—", "ไท", "ทย", "ย"]


def test_toxicity_without_labels_or_with_one_class(spark):
    docs = frame(spark, ODD)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    one = spark.createDataFrame([(i, 0) for i in range(10)], "doc_id long, toxic int")
    for labels in (none, one):
        got = toxicity.toxicity(docs, toxicity.fit(docs, labels)).collect()
        assert len(got) == len(ODD) and all(0 <= r["score"] < 0.5 for r in got)


# --- pieces -----------------------------------------------------------------

def brute_ways(lattice, chunk):
    found = []

    def go(i, ids, score):
        if i == len(chunk):
            found.append((score, tuple(ids)))
        for j in range(i + 1, len(chunk) + 1):
            piece = lattice.ids.get(chunk[i:j])
            if piece:
                go(j, [*ids, piece[0]], score + piece[1])
            elif j == i + 1:
                go(j, [*ids, *lattice._unknown(chunk[i])], score + lattice.unknown[1])
    go(0, [], 0.0)
    return sorted(found, key=lambda w: -w[0])


def test_n_best_equals_brute_force():
    lattice = pieces.PieceLattice.of(MODEL)
    random.seed(4)
    texts = ["the cat", "", " ", "\n\n", "a  b\n c ", "ñ🙂\tx"] + [
        "".join(random.choice("etaon ") for _ in range(7)) for _ in range(20)]
    for text in texts:
        marked = ("▁" + text).replace(" ", "▁") if text else ""
        ways = brute_ways(lattice, marked)
        ids, scores, changes = lattice.encode(text, 4)
        assert scores == [s for s, _ in ways[:4]], text
        made = set()
        for score, change in zip(scores, changes):
            own = ids.tolist()
            for at, n, other in reversed(change):
                own[at:at + n] = other
            assert (score, tuple(own)) in ways
            made.add(tuple(own))
        assert len(made) == len(scores) and lattice.decode(ids) == text


def test_pieces_round_trip(spark):
    got = pieces.decode_pieces(pieces.encode_pieces(frame(spark, ODD), MODEL), MODEL).collect()
    assert [r["decoded"] for r in got] == [r["text"] or "" for r in got]
    assert {len(r["ids"]) for r in got if not r["text"]} == {0} and got[0]["score"] == 7
    assert pieces.encode_pieces(frame(spark, []), MODEL).count() == 0


# --- token files ------------------------------------------------------------

@pytest.mark.parametrize("plane_bits", [1, 8])
def test_planes_round_trip(plane_bits):
    rng = np.random.default_rng(1)
    for n in (1, 7, 8, 1000):
        ids = rng.integers(0, 1 << 20, n).astype("<u4")
        planes = tokens.to_planes(ids, plane_bits, 3)
        assert len(planes) == 32 // plane_bits
        assert (tokens.from_planes(planes, plane_bits, n) == ids).all()


@pytest.mark.parametrize("block,plane_bits", [(64, 1), (1 << 16, 8)])
def test_token_files_hold_what_the_library_gives(spark, sf_dir, block, plane_bits):
    docs = frame(spark, ODD).unionByName(spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr(
        "doc_id + 10 as doc_id", "text", "lang", "n_chars as score").limit(40))
    path = shared_dir(spark, "tokens")
    tokens.write_tokens(docs, path, WORDS, block=block, plane_bits=plane_bits)
    library = Tokenizer.from_file(WORDS)
    at, expected = 0, []
    for doc, text in sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()),
                            key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library.encode(text, add_special_tokens=False).ids + [2]
        expected.append((doc, at, len(ids), np.array(ids, "<u4").tobytes()))
        at += len(ids)
    got = [tuple(r) for r in tokens.read_tokens(spark, path).orderBy("start").collect()]
    assert [(a, b, c, bytes(d)) for a, b, c, d in got] == expected


def test_no_documents_no_tokens(spark):
    path = shared_dir(spark, "tokens")
    tokens.write_tokens(frame(spark, []), path, WORDS)
    assert tokens.read_tokens(spark, path).count() == 0


# --- suffix arrays ----------------------------------------------------------

def test_suffix_arrays_and_prefixes():
    rng = np.random.default_rng(1)
    for _ in range(300):
        text = rng.integers(0, rng.integers(1, 5), rng.integers(1, 60))
        order, own = sais.suffix_array(text), text.tolist()
        expected = sorted(range(len(own)), key=lambda i: own[i:])
        assert order.tolist() == expected
        shared = sais.common_prefixes(text, order, 10)
        for before, i in zip([None, *expected], expected):
            n = 0
            while before is not None and n < 10 and max(i, before) + n < len(own) \
                    and own[i + n] == own[before + n]:
                n += 1
            assert shared[i] == n


def brute_removal(texts, length=50):
    seen, found = {}, []
    for doc, text in sorted(((i if i is not None else -1, t or "") for i, t in texts)):
        data = text.encode()
        for k in range(len(data) - length + 1):
            seen.setdefault(data[k:k + length], doc)
    for doc, text in texts:
        data, doc = (text or "").encode(), doc if doc is not None else -1
        gone = np.zeros(len(data), bool)
        for k in range(len(data) - length + 1):
            if seen[data[k:k + length]] < doc:
                gone[k:k + length] = True
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        found.append((doc, len(data), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(found)


@pytest.mark.parametrize("hot_bytes", [64 << 20, 0], ids=["shards", "windows"])
def test_substring_dedup_equals_brute_force(spark, sf_dir, hot_bytes):
    texts = ODD + [(8, "y" + "x" * 300), (9, "x" * 49), (11, "other text " + ODD[0][1] + "and " * 30)]
    texts += [(r[0] + 20, r[1]) for r in spark.read.parquet(
        f"{sf_dir}/documents.parquet").select("doc_id", "text").limit(60).collect()]
    got = suffixes.substring_dedup(
        frame(spark, texts).repartition(5), hot_bytes=hot_bytes, shard_bytes=5000).collect()
    assert sorted(
        (r["doc_id"] if r["doc_id"] is not None else -1, r["n_bytes"], r["n_removed"],
         hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in got) == brute_removal(texts)
    assert all(sum(s["end"] - s["at"] for s in r["removed"]) == r["n_removed"]
               and len(r["removed"]) == r["n_spans"] for r in got)


def test_substring_dedup_of_nothing(spark):
    assert suffixes.substring_dedup(frame(spark, [])).count() == 0


# --- pipeline ---------------------------------------------------------------

def test_pipeline_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert len(stages) == 5
    clean = corpus_pipeline.written(stages["toxicity"](spark, docs, sf_dir), "clean")
    assert clean.columns == docs.columns and 0 < clean.count() <= docs.count()
    now = {r["doc_id"]: r["text"] for r in clean.collect()}
    holders = {}
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(
        {c: c + 32 for c in range(65, 91)})
    for doc, text in now.items():
        for line in text.split("\n"):
            holders.setdefault(key(line), set()).add(doc)
    hot = {k: max(v) for k, v in holders.items() if len(v) >= 5 and len(k) >= 40}
    now = {d: "\n".join(x for x in t.split("\n") if hot.get(key(x), d) == d) for d, t in now.items()}
    prints = {d: simhash.fingerprint(t.encode()) for d, t in now.items()}
    of = brute_components(prints, sorted(prints))
    now = {d: t for d, t in now.items() if of[d] == d}
    import regex
    words = lambda t: regex.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", t.translate(
        {c: c + 32 for c in range(65, 91)}))
    grams = set()
    for (text,) in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("text").collect():
        own = words(text)
        grams |= {tuple(own[k:k + 10]) for k in range(max(1, len(own) - 9))} if own else set()
    hit = lambda own: any(tuple(own[k:k + 10]) in grams for k in range(len(own) - 9))
    now = {d: t for d, t in now.items() if not hit(words(t))}
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert {d: r["text"] for d, r in got.items()} == now
    lattice = pieces.PieceLattice.of(MODEL)
    assert all(r["round_trip"] and r["ids"] == lattice.encode(r["text"], 1)[0].tolist()
               for r in got.values())


def test_stages_leave_clashing_columns_alone(spark, sf_dir):
    docs = spark.createDataFrame(
        [(i, t, "a", "b", "c", "d", "e") for i, t in ODD if i != 5],
        "doc_id long, text string, score string, kept_text string, n_hit string, ids string, "
        "_column_0 string")
    for name, stage in corpus_pipeline.STAGES:
        for table in (docs, docs.limit(0)):
            out = stage(spark, table, sf_dir)
            assert set(docs.columns) <= set(out.columns), name
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns
            assert all(r["score"] == "a" and r["n_hit"] == "c" for r in out.collect())


def test_pipeline_keeps_the_n_best(spark, sf_dir):
    texts = [(1, "unbelievable segmentations of words"), (2, None), (3, "")]
    got = {r["doc_id"]: r for r in corpus_pipeline.pieces(spark, frame(spark, texts), sf_dir).collect()}
    lattice = pieces.PieceLattice.of(MODEL)
    ids, scores, _ = lattice.encode(texts[0][1], 4)
    assert got[1]["ids"] == ids.tolist() and [w["score"] for w in got[1]["n_best"]] == scores
    assert len(scores) == 4 and len(got[2]["n_best"]) == len(got[3]["n_best"]) == 1
    assert got[1]["round_trip"] and got[1]["score"] == 7


def test_the_model_does_not_depend_on_the_order_of_rows(spark, sf_dir):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "toxic")
    both = labels.unionByName(labels.withColumn("toxic", (F.col("doc_id") % 7 == 0).cast("int")))
    models = [toxicity.fit(docs.unionByName(docs).repartition(n), both.repartition(n))
              for n in (3, 7)]
    assert models[0].log_odds.keys() == models[1].log_odds.keys()
    assert models[0].weights == pytest.approx(models[1].weights, rel=1e-9)
    assert models[0].cut == models[1].cut
    assert models[0].decay == pytest.approx(models[1].decay, rel=1e-12)
