"""Removal of repeated runs of consecutive sentences."""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from lumentide.llm.common import (
    cut_batches, on_own_columns, utf8, with_arrow_columns, written,
)

#: A sentence with the white space behind it: up to a stop before white space, or a line.
#: Nothing is tried twice: a stop that ends no sentence is passed for good.
_SENTENCE = re.compile(
    rb"[^\n.!?]*+(?:[.!?]++[)\]\"']*+(?!\s|\Z)[^\n.!?]*+)*+[.!?]++[)\]\"']*+(?:\s+|\Z)"
    rb"|[^\n]*\n\s*|[^\n]+\Z")
#: The same with the full stops of scripts that put no white space behind them.
_STOPS = "。．！？｡។။።।॥؟۔"
_ANY_STOP = re.compile("|".join(_STOPS).encode())
_SENTENCE_WIDE = re.compile(
    rb"[^\n]*?(?:[.!?]+[)\]\"']*(?:\s+|\Z)|(?:" + "|".join(_STOPS).encode() + rb")+(?:"
    + "|".join("」』”’）】》〉").encode() + rb"|[)\]\"'])*\s*)|[^\n]*\n\s*|[^\n]+\Z")
_WORD = re.compile(rb"\S+\s*")
#: Longer than that in bytes without white space is no word, but text that puts none.
_LONG = 64
_UNSPACED = re.compile(rb"\S{%d,}" % (_LONG + 1))
_SPACED = re.compile(rb"\s*+(?:\S{1,%d}+(?:\s++|\Z))*+\Z" % _LONG)

#: Odd factor of the rolling hash, its inverse modulo 2^64, and a random value for each byte.
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)
_BYTES = np.random.default_rng(3).integers(0, 1 << 64, 256, np.uint64)


def _sentences(text: bytes) -> list[bytes]:
    wide = not text.isascii() and _ANY_STOP.search(text)
    return (_SENTENCE_WIDE if wide else _SENTENCE).findall(text)


def units(text: bytes, most_words: int) -> list[bytes]:
    """The text cut into sentences, longer ones after every `most_words` words; they add up to it.

    Of text without white space, 4 * `most_words` characters stand for so many words.
    """
    found = []
    unspaced = _SPACED.match(text) is None
    for sentence in _sentences(text):
        if unspaced and _UNSPACED.search(sentence):
            found += _unspaced_units(sentence, most_words)
        elif len(sentence) > 2 * most_words and len(sentence.split()) > most_words:
            words = _WORD.findall(sentence)
            lead = sentence[:len(sentence) - sum(map(len, words))]
            parts = [b"".join(words[k:k + most_words]) for k in range(0, len(words), most_words)]
            parts[0] = lead + parts[0]
            found += parts
        else:
            found.append(sentence)
    return found


def _unspaced_units(sentence: bytes, most_words: int) -> list[bytes]:
    """Units of a sentence that holds text without white space."""
    words = _WORD.findall(sentence)
    found, held = [], [sentence[:len(sentence) - sum(map(len, words))]]
    for word in words:
        chars = word.decode(errors="surrogateescape") if len(word.rstrip()) > _LONG else ""
        if chars or len(held) > most_words:
            found.append(b"".join(held))
            held = [b""]
        size = 4 * most_words
        pieces = [chars[k:k + size].encode(errors="surrogateescape")
                  for k in range(0, len(chars), size)] or [word]
        if len(pieces) > 1 and not pieces[-1].strip():
            pieces[-2:] = [b"".join(pieces[-2:])]
        found += pieces[:-1]
        held.append(pieces[-1])
        if chars:
            found.append(b"".join(held))
            held = [b""]
    found.append(b"".join(held))
    return [unit for unit in found if unit]


def unit_words(text: bytes, most_words: int) -> list[list[bytes]]:
    """The words of every unit that has any; the units themselves are not put together."""
    if _SPACED.match(text) is None:
        return [w for p in units(text, most_words) if (w := p.split())]
    found = []
    for sentence in _sentences(text):
        words = sentence.split()
        if len(words) > most_words:
            found += [words[k:k + most_words] for k in range(0, len(words), most_words)]
        elif words:
            found.append(words)
    return found


def span_digests(
    text: bytes, most_words: int, span: int, least_words: int, least_bytes: int = 64,
) -> tuple[list[int], list[bytes]]:
    """Places and digests of the runs of `span` units with enough words or bytes.

    Units without a word are passed over: they are no sentences. Fewer units are one run.
    """
    held = unit_words(text.lower(), most_words)
    if not held:
        return [], []
    lines = [b" ".join(w) for w in held]
    ends = np.cumsum([len(line) + 1 for line in lines])
    last = np.minimum(np.arange(max(1, len(held) - span + 1)) + span, len(held)) - 1
    starts = np.concatenate([[0], ends])[:len(last)]
    at = np.arange(len(last))
    if least_words > 0 and least_bytes > 0:
        words = np.concatenate([[0], np.cumsum([len(w) for w in held])])
        chars = np.concatenate([[0], np.cumsum([sum(map(len, w)) for w in held])])
        at = at[(words[last + 1] - words[at] >= least_words) | (chars[last + 1] - chars[at] >= least_bytes)]
    flat = b"\n".join(lines)
    return at.tolist(), [xxhash.xxh3_128_digest(flat[a:b]) for a, b in zip(
        starts[at].tolist(), (ends[last[at]] - 1).tolist())]


def tokens(text: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words, lower-cased and one space apart, and where each begins and ends in that.

    Of text without white space every character is a token.
    """
    flat = b" ".join(text.lower().split())
    if not flat:
        return flat, np.zeros(0, np.int64), np.zeros(0, np.int64)
    gaps = np.flatnonzero(np.frombuffer(flat, np.uint8) == 32)
    edges = np.empty(len(gaps) + 2, np.int64)
    edges[0], edges[1:-1], edges[-1] = -1, gaps, len(flat)
    starts, ends = edges[:-1] + 1, edges[1:]
    if (ends - starts).max() > _LONG:
        lead = (np.frombuffer(flat, np.uint8) & 0xC0) != 0x80
        cuts = []
        for a, b in zip(starts.tolist(), ends.tolist()):
            cuts.append([a] if b - a <= _LONG else a + np.flatnonzero(lead[a:b]))
        starts = np.concatenate(cuts)
        last = np.searchsorted(gaps, starts)
        ends = np.minimum(np.append(starts[1:], len(flat)), np.append(gaps, len(flat))[last])
    return flat, starts, ends


def token_places(text: bytes, flat: bytes, tokens_at: np.ndarray) -> np.ndarray:
    """Where each of the tokens of `flat` begins in the text itself, and the end of the text."""
    raw = np.frombuffer(text, np.uint8)
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    leads = ~space
    leads[1:] &= space[:-1]
    starts = np.flatnonzero(leads)
    if len(starts) == len(tokens_at):  # every word is one token
        return np.append(starts, len(text))
    heads = np.append(0, np.flatnonzero(np.frombuffer(flat, np.uint8) == 32) + 1)
    word = np.searchsorted(heads, tokens_at, side="right") - 1
    return np.append(starts[word] + tokens_at - heads[word], len(text))


_KEPT_POWERS = 1 << 16


@functools.cache
def _first_powers(base: int) -> np.ndarray:
    return _made_powers(base, _KEPT_POWERS)


def _made_powers(base: int, n: int) -> np.ndarray:
    made = np.full(n, base, np.uint64)
    made[0] = 1
    return np.multiply.accumulate(made)


def _powers(base: int, n: int) -> np.ndarray:
    return _first_powers(base)[:n] if n <= _KEPT_POWERS else _made_powers(base, n)


def anchors(text: bytes, passage: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the windows of `passage` // 2 tokens that stand for their surroundings.

    They are the smallest by hash in every stretch of `passage` tokens, a choice that depends
    on the stretch only: two copies of one, wherever they begin, have an anchor in common.
    """
    flat, starts, ends = tokens(text)
    if len(starts) < passage:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    size = passage // 2
    sums = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum(_BYTES[np.frombuffer(flat, np.uint8)] * _powers(_FACTOR, len(flat)), out=sums[1:])
    first, last = starts[:len(starts) - size + 1], ends[size - 1:]
    found = (sums[last] - sums[first]) * _powers(_INVERSE, len(flat))[first]
    found ^= found >> np.uint64(32)
    found *= np.uint64(0xD6E8FEB86659FD93)
    found ^= found >> np.uint64(32)
    # Each row is the one before moved by one window; smallest ones never go back.
    span = passage - size + 1
    wide = np.ndarray((len(found) - span + 1, span), np.uint64, found, strides=2 * found.strides)
    at = np.concatenate([
        wide[k:k + 65536].argmin(axis=1) + np.arange(k, min(k + 65536, len(wide)))
        for k in range(0, len(wide), 65536)])
    new = np.ones(len(at), bool)
    np.not_equal(at[1:], at[:-1], out=new[1:])
    at = at[new]
    return at, found[at]


def passage_digests(text: bytes, passage: int, near: np.ndarray) -> tuple[list[int], list[bytes]]:
    """Places and digests of the stretches of `passage` tokens that hold one of the anchors `near`."""
    flat, starts, ends = tokens(text)
    most = len(starts) - passage + 1
    back = passage - passage // 2
    edges = np.zeros(len(starts) + passage + 1, np.int64)
    np.add.at(edges, np.maximum(near - back, 0), 1)
    np.add.at(edges, near + 1, -1)
    at = np.flatnonzero(np.cumsum(edges)[:max(most, 0)] > 0)
    return at.tolist(), [xxhash.xxh3_128_digest(flat[a:b]) for a, b in zip(
        starts[at].tolist(), ends[at + passage - 1].tolist())]


#: Types of ids whose order here is Spark's.
_ORDERED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType)


def _ranks(docs: pa.Array, tags: pa.Array) -> np.ndarray:
    """Ranks of a batch's documents by id and tag, NULL first; rows of one document have one."""
    order = pc.sort_indices(
        pa.table([docs, tags], names=["doc", "tag"]), null_placement="at_start",
        sort_keys=[("doc", "ascending"), ("tag", "ascending")]).to_numpy()
    doc = docs.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)[order]
    tag = tags.to_numpy(zero_copy_only=False)[order]
    ranks = np.zeros(len(order), np.int64)
    ranks[order[1:]] = np.cumsum((doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1]))
    return ranks


def _settled(
    row: np.ndarray, at: np.ndarray, high: np.ndarray, low: np.ndarray, anchor: np.ndarray,
    ranks: np.ndarray, across: bool,
) -> tuple[np.ndarray, np.ndarray]:
    """What a batch tells by itself: which places others have to hear of, and which are settled.

    Of the places of one digest the first is sent on. All later ones are known to be repeated,
    and of an anchor's the first, too. Without `across` only places of one document are compared.
    """
    order = np.argsort(high)
    same = high[order[1:]] == high[order[:-1]]
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    some = order[twice]
    sent = np.ones(len(order), bool)
    if not len(some):
        return np.flatnonzero(sent), some
    doc = ranks[row[some]]
    keys = [at[some], doc, low[some], anchor[some], high[some]]
    if not across:
        keys.insert(2, doc)
        keys[1] = row[some]
    sort = np.lexsort(keys)
    some, keys = some[sort], [k[sort] for k in keys]
    new = np.ones(len(some), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys[2:]], axis=0)
    head = np.maximum.accumulate(np.where(new, np.arange(len(some)), 0))
    later = (ranks[row[some]] != ranks[row[some[head]]]) | (at[some] != at[some[head]])
    sent[some[~new]] = False
    group = np.cumsum(new) - 1
    near = anchor[some] & (np.bincount(group, later)[group] > 0)
    return np.flatnonzero(sent), some[later | near]


def sentence_span_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = 3,
    most_words: int = 16, least_words: int = 0, passage: int | None = None,
    least_bytes: int = 0,
) -> DataFrame:
    """Remove every sentence covered by a run of `span` sentences found earlier already.

    The first occurrence of a run, in the smallest document and there at the first place,
    keeps its sentences; those of all others go. Adds `n_sentences`, `n_removed` and
    `kept_text`; an input column of one of these names is replaced. Sentences end at a stop
    before white space, a full stop of scripts without white space, or a line break; one longer than `most_words` words counts as
    several, cut after every `most_words` words from its beginning. A repeated passage that
    begins with a sentence and has `span` times `most_words` words is therefore always found,
    with stops or without. Every run counts, however short; with `least_words` and
    `least_bytes` those that have neither as many words nor as many bytes don't. More than 64 bytes without white space are no word: they are cut
    after every 4 * `most_words` characters, and each character counts in a passage. A-Z are
    lower-cased and white space is one space; the remaining text is left as it is.

    With `passage` also every stretch of so many consecutive words found earlier already goes,
    wherever in its sentences it begins and ends; its first occurrence stays likewise. Then
    `n_removed` counts the sentences that lost text, whole or in part. A smaller window inside
    each stretch, chosen by its content alone, is looked up first; only stretches around a
    window found twice are hashed one by one, so that the result is that of hashing all.

    Only digests move, once: of those found several times in a batch of texts one goes on, so
    that a passage in very many documents is one row for each batch. The first place of each
    tells which are later. The texts move once, to meet the runs they lose; with `passage`
    those with repeated windows once more.

    NULL and empty texts have no sentences; their kept text is empty. A text with fewer
    sentences than `span` is one run. Rows of one id and text are one document; rows of one
    id and other texts are documents of their own. A NULL id is the smallest.
    """
    if passage is not None and passage < 2:
        raise ValueError("a passage has two words at least")
    return on_own_columns(
        docs, lambda own: _without_spans(
            own, id_col, text_col, span, most_words, least_words, passage, least_bytes),
        keep=(id_col, text_col), add=("n_sentences", "n_removed", "kept_text"))


def _without_spans(
    docs: DataFrame, id_col: str, text_col: str, span: int, most_words: int, least_words: int,
    passage: int | None, least_bytes: int,
) -> DataFrame:
    source = docs.select(
        F.col(id_col).alias("_doc"), F.coalesce(text_col, F.lit("")).alias("_text")
    ).withColumn("_tag", F.xxhash64("_text"))
    kind = source.schema["_doc"].dataType
    across = isinstance(kind, _ORDERED) or kind == T.StringType()
    schema = T.StructType([
        source.schema["_doc"], T.StructField("_tag", T.LongType()),
        T.StructField("_at", T.IntegerType()), T.StructField("_more", T.ArrayType(T.IntegerType())),
        T.StructField("_high", T.LongType()), T.StructField("_low", T.LongType())])

    def emitted(
        batch: pa.RecordBatch, runs: list[tuple[list[int], list[bytes]]],
        marks: list[tuple[np.ndarray, np.ndarray]],
    ) -> Iterator[pa.RecordBatch]:
        """Places to look up, by digest, and those of each document known to be repeated.

        An anchor has no lower half of a digest.
        """
        n = sum(len(at) for at, _ in runs)
        halves = np.frombuffer(b"".join(d for _, own in runs for d in own), np.int64).reshape(n, 2)
        rows = np.arange(batch.num_rows)
        row = np.concatenate([np.repeat(rows, [len(at) for at, _ in runs]),
                              np.repeat(rows[:len(marks)], [len(at) for at, _ in marks])])
        at = np.concatenate([np.array([k for own, _ in runs for k in own], np.int64),
                             *(own for own, _ in marks)]).astype(np.int32)
        high = np.concatenate([halves[:, 0], *(h.view(np.int64) for _, h in marks)])
        low = np.concatenate([halves[:, 1], np.zeros(len(at) - n, np.int64)])
        anchor = np.arange(len(at)) >= n
        docs, tags = batch.column(0), batch.column(2)
        sent, known = _settled(
            row, at, high, low, anchor, _ranks(docs, tags) if across else rows, across)
        yield pa.RecordBatch.from_arrays(
            [docs.take(pa.array(row[sent])), tags.take(pa.array(row[sent])), pa.array(at[sent]),
             pa.nulls(len(sent), pa.list_(pa.int32())), pa.array(high[sent]),
             pa.array(low[sent], mask=anchor[sent])], names=schema.names)
        if len(known):
            known = known[np.lexsort([row[known], anchor[known]])]
            new = np.ones(len(known), bool)
            new[1:] = (row[known[1:]] != row[known[:-1]]) | (anchor[known[1:]] != anchor[known[:-1]])
            heads = np.flatnonzero(new)
            own = known[heads]
            yield pa.RecordBatch.from_arrays(
                [docs.take(pa.array(row[own])), tags.take(pa.array(row[own])),
                 pa.nulls(len(own), pa.int32()),
                 pa.ListArray.from_arrays(
                     pa.array(np.append(heads, len(known)), pa.int32()), pa.array(at[known])),
                 pa.nulls(len(own), pa.int64()),
                 pa.array(np.zeros(len(own), np.int64), mask=anchor[own])], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut_batches(batches, 1):
            texts = utf8(batch.column(1))
            yield from emitted(
                batch, [span_digests(t, most_words, span, least_words, least_bytes) for t in texts],
                [anchors(t, passage) for t in texts] if passage is not None else [])

    def run_passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut_batches(batches, 1, 1 << 20):
            yield from emitted(batch, [
                passage_digests(text, passage, np.array(near, np.int64)) for text, near in zip(
                    utf8(batch.column(1)), batch.column(3).to_pylist())], [])

    place, anchor = F.struct("_doc", "_tag", "_at"), F.col("_low").isNull()

    def repeated(places: DataFrame) -> DataFrame:
        """Places of runs found earlier already, and of anchors found twice."""
        # Lists of places have no digest; they are dealt by document, to meet nothing.
        found = places.withColumn("_high", F.coalesce("_high", F.xxhash64("_doc", "_tag")))
        alike = Window.partitionBy("_high", "_low")
        return found.withColumns({
            "_first": F.min(place).over(alike), "_n": F.count("*").over(alike)}).filter(
                F.col("_more").isNotNull() | F.when(anchor, F.col("_n") > 1).otherwise(
                    ~place.eqNullSafe(F.col("_first"))))

    def listed(which: Column) -> Column:
        """The places of the rows told, one by one and in lists."""
        return F.concat(F.collect_list(F.when(which, F.col("_at"))),
                        F.flatten(F.collect_list(F.when(which, F.col("_more")))))

    runs = repeated(source.select("_doc", "_text", "_tag").mapInArrow(run, schema))
    if passage is None:
        lost = runs.groupBy("_doc", "_tag").agg(listed(~anchor).alias("_lost"))
        own = ["_lost"]
    else:
        # Stored, here and below: the shuffle files of the digests go before others are made.
        marks = written(runs.groupBy("_doc", "_tag").agg(
            listed(~anchor).alias("_lost"), listed(anchor).alias("_near")), "marks")
        near = marks.filter(F.size("_near") > 0).select(
            F.col("_doc").alias("_near_doc"), F.col("_tag").alias("_near_tag"), "_near")
        passages = source.join(
            near, F.col("_doc").eqNullSafe(F.col("_near_doc")) & (F.col("_tag") == F.col("_near_tag"))
        ).select("_doc", "_text", "_tag", "_near").mapInArrow(run_passages, schema)
        gone = written(repeated(passages).groupBy("_doc", "_tag").agg(
            listed(~anchor).alias("_gone")), "passages")
        lost = (
            marks.select("_doc", "_tag", "_lost", F.lit(None).cast("array<int>").alias("_gone"))
            .unionByName(gone.withColumn("_lost", F.lit(None).cast("array<int>")))
            .groupBy("_doc", "_tag").agg(*(
                F.flatten(F.collect_list(c)).alias(c) for c in ("_lost", "_gone"))))
        own = ["_lost", "_gone"]
    met = docs.join(
        lost, docs[id_col].eqNullSafe(lost["_doc"])
        & (F.xxhash64(F.coalesce(docs[text_col], F.lit(""))) == lost["_tag"]), "left"
    ).drop("_doc", "_tag")

    def without(text: bytes, parts: list[bytes], gone: set[int], places: list[int]) -> tuple[int, bytes]:
        """Number of parts that lose text, and the text without the parts and passages that go."""
        flat, starts, _ = tokens(text)
        at = token_places(text, flat, starts)
        ends = np.cumsum([len(p) for p in parts])
        begins = np.append(0, ends[:-1])
        whole, first = np.array(sorted(gone), np.int64), np.array(places, np.int64)
        size = len(text) + 1
        open_at = np.cumsum(
            np.bincount(np.append(begins[whole], at[first]), minlength=size)
            - np.bincount(np.append(ends[whole], at[first + passage]), minlength=size))[:-1]
        stays = open_at == 0
        lost = np.append(0, np.cumsum(~stays))
        touched = np.flatnonzero(lost[ends] > lost[begins]).tolist()
        return sum(not parts[i].isspace() for i in touched), np.frombuffer(text, np.uint8)[stays].tobytes()

    def rebuilt(texts: pa.Array, *lists: pa.Array) -> list[pa.Array]:
        n, removed, kept = [], [], []
        for text, own, places in zip(
                utf8(texts), lists[0].to_pylist(),
                lists[1].to_pylist() if passage is not None else [None] * len(texts)):
            if not own and not places:
                n.append(len(unit_words(text, most_words)))
                removed.append(0)
                kept.append(text)
                continue
            parts = units(text, most_words)
            worded = [i for i, p in enumerate(parts) if not p.isspace()]
            gone = {worded[k] for a in own or () for k in range(a, min(a + span, len(worded)))}
            n.append(len(worded))
            if places:
                lose, left = without(text, parts, gone, places)
                removed.append(lose)
                kept.append(left)
                continue
            removed.append(len(gone))
            kept.append(b"".join(p for i, p in enumerate(parts) if i not in gone))
        return [pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                pa.array(kept, pa.binary()).cast(pa.string())]

    return with_arrow_columns(
        met, rebuilt, [text_col, *own],
        [T.StructField("n_sentences", T.LongType()), T.StructField("n_removed", T.LongType()),
         T.StructField("kept_text", T.StringType())], drop=own)
