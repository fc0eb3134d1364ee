"""Line, sentence, licence, benchmark and quality operators on small and odd inputs."""

import collections
import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from lumentide.llm import decontaminate as decon, licences, quality, queries, spans, suffixes
from lumentide.llm.lines import line_dedup

SCHEMA = "doc_id long, text string, lang string, source string, n_lines long, kept string"
LINE = "this line is long enough to count, forty characters or more"


def frame(spark, texts):
    """Documents with columns that clash with what operators add."""
    return spark.createDataFrame(
        [(i, t, "en", "s", 77, "x") for i, t in texts], SCHEMA)


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_lines_stay_in_the_largest_document(spark):
    texts = [(i, f"  {LINE.upper()}\t\nown {i}") for i in range(5)] + [
        (9, None), (10, ""), (11, "short\nshort"), (4, f"  {LINE.upper()}\t\nown 4")]
    got = line_dedup(frame(spark, texts)).collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r["doc_id"]].append((r["n_lines"], r["n_dropped"], r["kept_text"]))
    assert by[0] == [(2, 1, "own 0")] and by[3] == [(2, 1, "own 3")]
    assert by[4] == [(2, 0, f"  {LINE.upper()}\t\nown 4")] * 2
    assert by[9] == by[10] == [(1, 0, "")] and by[11] == [(2, 0, "short\nshort")]
    assert got[0]["kept"] == "x"


def test_four_documents_and_a_null_id_are_not_enough_or_just_enough(spark):
    texts = [(i, LINE) for i in range(4)]
    assert all(r["n_dropped"] == 0 for r in line_dedup(frame(spark, texts)).collect())
    got = rows(line_dedup(frame(spark, texts + [(None, LINE), (None, LINE)])))
    assert {k: r["n_dropped"] for k, r in got.items()} == {0: 1, 1: 1, 2: 1, 3: 0, None: 1}


@pytest.mark.parametrize("apply", [
    line_dedup, spans.sentence_span_dedup, quality.quality_rules,
    lambda d: licences.license_scan(d, licences.known_licences(d.sparkSession)),
    lambda d: decon.decontaminate(d, d.sparkSession.createDataFrame(
        [(1, LINE)], "item_id long, text string")),
], ids=["lines", "spans", "quality", "licences", "benchmark"])
def test_empty_tables(spark, apply):
    assert apply(frame(spark, [])).count() == 0


PASSAGE = " ".join(f"word{i} and{i} more{i} of{i} it{i}." for i in range(12))


def test_repeated_passages_go_from_later_documents(spark):
    texts = [(1, f"First of all. {PASSAGE} The end is here."), (2, f"Other text.\n{PASSAGE}\nTail."),
             (3, PASSAGE.upper()), (4, None), (5, ""), (6, "Of. The. It."), (7, "Of. The. It.")]
    got = rows(spans.sentence_span_dedup(frame(spark, texts)))
    assert got[7]["n_removed"] == 3 and got[7]["kept_text"] == ""  # short runs count
    got = rows(spans.sentence_span_dedup(frame(spark, texts), least_words=8, least_bytes=64))
    assert got[1]["n_removed"] == 0 and got[1]["kept_text"] == texts[0][1]
    assert got[2]["kept_text"] == "Other text.\nTail." and got[2]["n_removed"] == 12
    assert got[3]["kept_text"] == "" and got[4]["kept_text"] == got[5]["kept_text"] == ""
    assert got[7]["n_removed"] == 0


def test_passages_without_stops_are_found(spark):
    words = " ".join(f"w{i}" for i in range(60))
    got = rows(spans.sentence_span_dedup(frame(spark, [(1, words), (2, f"Lead.\n{words}")])))
    assert got[2]["n_removed"] == 4 and got[2]["kept_text"] == "Lead.\n"


def brute_spans(docs, least_words, passage=None):
    """Number of sentences that lose text and the digest of what stays, by document."""
    seen, stretches, expected = set(), set(), {}
    for doc, text in docs:
        raw = (text or "").encode()
        parts = spans.units(raw, 16)
        assert b"".join(parts) == raw
        worded = [i for i, p in enumerate(parts) if p.split()]
        ends = list(itertools.accumulate(map(len, parts)))
        stays = bytearray(b"\1" * len(raw))
        for k in range(max(1, len(worded) - 2)):
            run = tuple(tuple(parts[i].lower().split()) for i in worded[k:k + 3])
            if run and sum(map(len, run)) >= least_words:
                if run in seen:
                    for i in worded[k:k + 3]:
                        stays[ends[i] - len(parts[i]):ends[i]] = bytes(len(parts[i]))
                seen.add(run)
        if passage:
            words = list(re.finditer(rb"[^ \t-\r]+", raw))
            places = [m.start() for m in words] + [len(raw)]
            assert all(len(m[0]) <= 64 for m in words)
            for k in range(len(words) - passage + 1):
                stretch = tuple(m[0].lower() for m in words[k:k + passage])
                if stretch in stretches:
                    stays[places[k]:places[k + passage]] = bytes(places[k + passage] - places[k])
                stretches.add(stretch)
        lost = sum(0 in stays[ends[i] - len(parts[i]):ends[i]] for i in worded)
        kept = bytes(itertools.compress(raw, stays))
        expected[doc] = (lost, hashlib.sha256(kept).hexdigest())
    return expected


@pytest.mark.parametrize("floor", [0, 8])
def test_spans_equal_brute_force(spark, sf_dir, floor):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    expected = brute_spans(sorted(map(tuple, docs.collect())), floor)
    got = spans.sentence_span_dedup(docs, least_words=floor, least_bytes=64 if floor else 0).select(
        "doc_id", "n_removed", F.sha2("kept_text", 256)).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == expected


def test_registered_spans_query_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    expected = brute_spans(sorted(map(tuple, docs.collect())), 0, passage=48)
    got = queries.QUERIES["op3_sentence_spans"](spark, sf_dir).collect()
    assert {r["doc_id"]: (r["n_removed"], r["kept_sha256"]) for r in got} == expected


def test_words_of_short_sentences_are_not_cut_out_one_by_one(monkeypatch):
    short = b"Fourteen words of which none has to be looked at by itself here, either.\n" * 3
    long = b"word " * 40 + b"end. "
    expected = [len(u.split()) for u in spans.units(short + long, 16)]
    assert [len(w) for w in spans.unit_words(short + long, 16)] == expected == [14, 14, 14, 16, 16, 9]
    monkeypatch.setattr(spans, "_WORD", None)
    assert b"".join(spans.units(short, 16)) == short and len(spans.units(short, 16)) == 3
    assert [len(w) for w in spans.unit_words(short + long, 16)] == expected


@pytest.mark.parametrize("text", [
    "", " \n ", "One. Two! Three?", "Pi is 3.14 (or 3.2.) so!) No.) x.y.z\nno stop\n\n last",
    "a" * 65 + ". b", "a" * 64 + ". b", "世界。你好。" * 20 + " end.", "...\n.. . )\"'. x", "a.\x1cb.\x85 c."])
def test_units_are_those_of_the_plain_expression(text):
    raw, found = text.encode(), []
    plain = re.compile(rb"[^\n]*?[.!?]+[)\]\"']*(?:\s+|\Z)|[^\n]*\n\s*|[^\n]+\Z")
    if not spans._UNSPACED.search(raw) and "。" not in text:
        assert spans._sentences(raw) == plain.findall(raw)
    for most in (2, 16):
        found = spans.units(raw, most)
        assert b"".join(found) == raw
        assert spans.unit_words(raw, most) == [w for p in found if (w := p.split())]


def test_spans_store_one_row_a_document(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    stored, written = [], spans.written

    def kept(df, *args):
        stored.append(written(df, *args))
        return stored[-1]

    monkeypatch.setattr(spans, "written", kept)
    spans.sentence_span_dedup(docs, passage=48).collect()
    assert stored and all(0 < t.count() <= docs.count() for t in stored)
    assert not any(isinstance(f.dataType, T.BinaryType) for t in stored for f in t.schema)


def test_a_batch_sends_on_one_place_of_a_digest():
    row, at = np.array([0, 0, 1, 2, 2, 0]), np.array([4, 9, 0, 7, 7, 5], np.int32)
    high, low = np.array([5, 5, 5, 5, 6, 5]), np.array([1, 1, 1, 1, 1, 0])
    anchor = low == 0
    for ranks, across, sent, known in (
            ([1, 0, 2], True, [2, 4, 5], [0, 1, 3]), ([1, 0, 2], False, [0, 2, 3, 4, 5], [1]),
            ([0, 0, 0], True, [2, 4, 5], [0, 1, 3])):
        got = spans._settled(row, at, high, low, anchor, np.array(ranks), across)
        assert (sorted(got[0].tolist()), sorted(got[1].tolist())) == (sent, known), (ranks, across)
    # Of anchors the first is known to be repeated, too; rows of one document are no copies.
    same, yes = np.zeros(3, np.int64), np.ones(3, bool)
    got = spans._settled(np.arange(3), same, same, same, yes, np.array([0, 0, 1]), True)
    assert len(got[0]) == 1 and sorted(got[1].tolist()) == [0, 1, 2]
    got = spans._settled(np.arange(3), same, same, same, yes, same, True)
    assert len(got[0]) == 1 and len(got[1]) == 0


@pytest.mark.parametrize("kind", ["long", "string", "double", "date", "array<int>"])
def test_spans_of_ids_of_any_type(spark, kind):
    draw = random.Random(9)
    words = [" ".join(draw.choices([f"w{i}" for i in range(400)], k=60)) + "." for _ in range(6)]
    texts = [(None if n == 3 else 10 + n, " ".join(words[k % 6] for k in range(n % 4, n % 4 + 3)))
             for n in range(12)]
    expected = brute_spans(sorted(texts, key=lambda t: (t[0] is not None, t[0])), 0, passage=48)
    as_kind = {"date": "date_add(date'2024-01-01', cast(doc_id as int))", "array<int>":
               "if(doc_id is null, null, array(cast(doc_id as int)))"}.get(kind, f"cast(doc_id as {kind})")
    docs = frame(spark, texts * 2).repartition(3).selectExpr("doc_id", f"{as_kind} as id", "text")
    got = spans.sentence_span_dedup(docs, id_col="id", passage=48).collect()
    assert len(got) == 24
    for r in got:
        assert (r["n_removed"], hashlib.sha256(r["kept_text"].encode()).hexdigest()) == expected[r["doc_id"]]


def test_passages_at_every_offset(spark):
    passage = " ".join(f"p{i}" for i in range(50))
    texts = [(0, f"Once. {passage} and on")] + [
        (n, f"{' '.join(f'd{n}w{i}' for i in range(n))} {passage.upper()}\tend{n}") for n in range(1, 18)]
    got = rows(spans.sentence_span_dedup(frame(spark, texts), passage=48))
    assert got[0]["kept_text"] == texts[0][1] and got[0]["n_removed"] == 0
    for n in range(1, 18):
        assert got[n]["kept_text"] == f"{' '.join(f'd{n}w{i}' for i in range(n))} end{n}"
        assert got[n]["n_removed"] > 0


def test_passages_equal_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    seen, expected = set(), {}
    for doc, text in sorted(map(tuple, docs.collect())):
        words, gone = text.encode().lower().split(), set()
        for k in range(len(words) - 47):
            run = b" ".join(words[k:k + 48])
            if run in seen:
                gone.update(range(k, k + 48))
            seen.add(run)
        expected[doc] = [w for i, w in enumerate(words) if i not in gone]
    # Runs of sentences are left out, so that passages alone are compared.
    got = spans.sentence_span_dedup(docs, least_words=1 << 30, least_bytes=1 << 30, passage=48).collect()
    assert {r["doc_id"]: r["kept_text"].encode().lower().split() for r in got} == expected
    assert sum(len(w) for w in expected.values()) < sum(len(r["text"].split()) for r in got)


@pytest.mark.parametrize("passage", [None, 48])
def test_texts_without_spaces(spark, passage):
    draw = random.Random(5)
    han = ["".join(chr(draw.randrange(0x4E00, 0x9000)) for _ in range(100)) for _ in range(30)]
    ascii_line = "".join(draw.choice("abcdefghijklmnop0123456789") for _ in range(3000))
    stops = "。".join(x[:15] for x in han) + "。"
    bodies = ["\n".join(han), "".join(han)[::-1], ascii_line, stops, "\n".join(
        f"https://example.org/{x}" for x in ("first", "second", "third", "fourth"))]
    texts = [(10 * i + k, b) for i, b in enumerate(bodies) for k in (0, 1)]
    got = rows(spans.sentence_span_dedup(frame(spark, texts), passage=passage))
    for i, body in enumerate(bodies):
        if i == 3:
            assert spans.units(body.encode(), 16) == [f"{x[:15]}。".encode() for x in han]
        assert got[10 * i]["kept_text"] == body, i
        assert got[10 * i + 1]["kept_text"] == "" and got[10 * i + 1]["n_removed"] > 0, i


def test_unspaced_passages_at_every_offset(spark):
    draw = random.Random(6)
    han = lambda n: "".join(chr(draw.randrange(0x4E00, 0x9000)) for _ in range(n))
    body = han(120)
    texts = [(0, body)] + [(n, han(40 + n)) for n in range(1, 66)]
    texts = [(0, body)] + [(n, f"{lead}{body}") for n, lead in texts[1:]]
    got = rows(spans.sentence_span_dedup(frame(spark, texts), passage=48))
    assert all(got[n]["kept_text"] == t.removesuffix(body) for n, t in texts[1:])
    for _, text in texts:
        assert b"".join(spans.units(text.encode(), 16)) == text.encode()


def test_licences(spark):
    mit = "Copyright (c) 2020 Someone\n\n" + licences.MIT.replace("\n", "  ").upper()
    texts = [(1, mit), (2, f"Some code.\n\n{licences.ISC}\n\nMore."), (3, "Text.\nreleased under the mit licence"),
             (4, None), (5, "(c) me"), (6, "A MIT License is not it, but says much more."),
             (None, "Licensed under the Apache Licence, v2.0")]
    got = rows(licences.license_scan(
        frame(spark, texts), licences.known_licences(spark)))
    assert got[1]["license"] == "MIT" and got[2]["notices"] == ["ISC"] and got[2]["license"] is None
    assert got[3]["notices"] == ["MIT"] and got[None]["license"] == "Apache-2.0"
    assert all(got[k]["n_notices"] == 0 for k in (4, 5, 6))
    own = spark.createDataFrame([("Own", "Do what you want."), ("None", None)], "license string, text string")
    got = rows(licences.license_scan(frame(spark, [(1, "do WHAT you want")]),
                                     licences.known_licences(spark, own)))
    assert got[1]["license"] == "Own"


def test_licences_of_many_blocks_inside_a_document(spark):
    long = "\n\n".join(f"Clause {i} of it\nholds some words per\ncent." for i in range(9))
    known = licences.known_licences(spark, spark.createDataFrame(
        [("Long", long), ("MIT", licences.MIT)], "license string, text string"))
    spread = licences.MIT.replace("\n\n", "\n\n\n\n")
    texts = [(1, f"Code.\n\n{long}\n\nMore."), (2, f"Code.\n{spread}\nMore."),
             (3, "Code.\n" + long.replace("\n\n", "\n")), (4, long.replace("Clause 8", "Clause 7"))]
    got = rows(licences.license_scan(frame(spark, texts), known))
    assert [got[i]["notices"] for i in (1, 2, 3, 4)] == [["Long"], ["MIT"], ["Long"], []]
    assert got[1]["license"] is None


def test_whole_licence_texts(spark):
    own = [(name, t) for name, texts in licences.whole_texts().items() for t in texts]
    assert {n for n, _ in own} == {
        "Apache-2.0", "Artistic-1.0-Perl", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "GFDL-1.2",
        "GFDL-1.3", "GPL-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0",
        "MPL-1.1", "MPL-2.0"}
    texts = [(i, t) for i, (_, t) in enumerate(own)] + [
        (100 + i, f"Code before.\n\n{t}\n\nCode behind.") for i, (_, t) in enumerate(own)]
    got = rows(licences.license_scan(frame(spark, texts), licences.known_licences(spark)))
    for i, (name, _) in enumerate(own):
        assert got[i]["license"] == name, name
        assert name in got[100 + i]["notices"] and got[100 + i]["license"] is None, name


TEN = "one two three four five six seven eight nine ten"


def test_benchmark_windows(spark):
    items = spark.createDataFrame(
        [(1, f"{TEN} eleven"), (2, "Short item"), (3, None), (4, "..."), (5, TEN), (5, TEN)],
        "item_id long, text string")
    texts = [(1, f"Say: {TEN.upper()}! end"), (2, "a short, ITEM here"), (3, None), (4, "one two three"),
             (5, f"x {TEN} eleven y"), (6, "")]
    got = rows(decon.decontaminate(frame(spark, texts), items))
    found = {k: (r["n_words"], r["n_hit"], r["items"]) for k, r in got.items()}
    assert found == {1: (12, 10, ["1", "5"]), 2: (4, 2, ["2"]), 3: (0, 0, []), 4: (3, 0, []),
                     5: (13, 11, ["1", "5"]), 6: (0, 0, [])}
    cut = rows(decon.without_spans(decon.decontaminate(frame(spark, texts), items)))
    assert cut[1]["text"] == "Say! end" and cut[2]["text"] == "a here"
    assert cut[4]["text"] == "one two three" and cut[5]["text"] == "x y"
    nothing = decon.decontaminate(frame(spark, texts), items.filter("item_id in (3, 4)"))
    assert nothing.filter("contaminated").count() == 0
    joined = rows(decon.decontaminate(frame(spark, texts), items, broadcast_bytes=0))
    assert {k: r["n_hit"] for k, r in joined.items()} == {k: v[1] for k, v in found.items()}


def test_quality_measures_and_bounds(spark):
    five = "alpha beta gamma delta epsilon"
    texts = [(1, f"{five} {five}"), (2, None), (3, ""), (4, " \n\t"), (5, "a\na\n\nb\na"),
             (6, "## $ " + " ".join(f"w{i}" for i in range(20)))]
    got = rows(quality.with_base_measures(frame(spark, texts)))
    assert (got[1]["n_words"], got[1]["word_chars"], got[1]["n_repeat_words"]) == (10, 52, 10)
    assert got[1]["base_failed"] and got[2]["n_words"] == got[4]["n_words"] == 0
    assert got[5]["n_dup_lines"] == 2 and got[6]["n_symbols"] == 3
    clean = [(i, " ".join(f"word{i}x{k}" for k in range(30))) for i in range(100, 400)]
    odd = [(1, "%%% " * 3 + " ".join(f"w$$$ord{k}" for k in range(30)))]
    judged = rows(quality.quality_rules(frame(spark, clean + odd)))
    assert all(judged[i]["kept"] for i, _ in clean) and not judged[1]["kept"]
    assert "symbols" in judged[1]["outliers"]
    assert all(not r["kept"] for r in quality.quality_rules(frame(spark, [(1, None), (2, "")])).collect())


def test_buckets_are_lower_ends_within_a_128th(spark):
    found = spark.range(0, 100_000, 7).select("id", quality.bucket(F.col("id")).alias("b")).collect()
    assert all(b <= i and (i - b) * 128 <= max(i, 1) for i, b in found)
    assert all(b == i for i, b in found if i < 256)


def test_every_run_counts_however_short(spark):
    texts = [(1, "Buy cheap watches now."), (2, "Buy cheap watches now."), (3, "Buy cheap watches.")]
    got = rows(spans.sentence_span_dedup(frame(spark, texts)))
    assert [got[i]["kept_text"] for i in (1, 2, 3)] == [texts[0][1], "", texts[2][1]]


def test_columns_named_like_the_operators_own(spark):
    names = ["_lost", "_gone", "_runs", "_items", "_spans", "_words", "_text_hash", "_key", "_doc"]
    plain = frame(spark, [(1, f"{LINE}\n{PASSAGE}"), (2, f"{LINE}\n{PASSAGE}"), (3, None)])
    docs = plain.withColumns({c: F.lit(i) for i, c in enumerate(names)})
    items = spark.createDataFrame([(1, LINE)], "item_id long, text string")
    for apply in (line_dedup, lambda d: spans.sentence_span_dedup(d, passage=48),
                  lambda d: decon.decontaminate(d, items), suffixes.substring_dedup):
        clashing, alone = apply(docs), apply(plain)
        assert clashing.drop(*names).columns == alone.columns
        assert clashing.drop(*names).exceptAll(alone).isEmpty()
        assert {tuple(r) for r in clashing.select(*names).collect()} == {tuple(range(len(names)))}


def test_a_hot_line_is_split_over_tasks(spark, plan):
    """The stored keys have an exchange of their own, so AQE can split the other side."""
    rows_ = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.concat(F.when(F.col("id") % 10 != 0, LINE + "\n").otherwise(""),
                                              F.lit("own line of this document number "), "id",
                                              F.lit(", long enough to count")).alias("text"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        got = line_dedup(rows_)
        got.collect()
        assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hits_all_over_a_long_document_take_linear_time(spark):
    item = " ".join(f"w{i}" for i in range(10))
    docs = spark.createDataFrame([(1, f"{item} x " * 20_000), (2, f"{item} " * 5)], "doc_id long, text string")
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    got = rows(decon.decontaminate(docs, items))
    assert got[1]["n_hit"] == 200_000 and len(got[1]["hit_runs"]) == 20_000
    assert got[2]["hit_runs"] == [(0, 50)]


def test_all_known_licence_texts_are_found_whole_and_inside(spark):
    known = licences.whole_texts()
    assert len(known) >= 15
    texts = [(i, own[0]) for i, own in enumerate(known.values())]
    texts += [(100 + i, f"Some words.\n\n{own[-1].upper()}\nMore words here.")
              for i, own in enumerate(known.values())]
    got = rows(licences.license_scan(frame(spark, texts), licences.known_licences(spark)))
    for i, name in enumerate(known):
        assert got[i]["license"] == name, name
        assert got[100 + i]["n_notices"] >= 1, name
