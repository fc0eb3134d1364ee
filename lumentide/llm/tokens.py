"""Token ids of a corpus in byte planes, with an index of chunks and documents.

Format, below one folder: `chunks` (Parquet) has a row per block of `block` ids, holding
`part` and `chunk` (its place), `first` (place of its first id within the part), `n_ids`,
`plane_bits`, `planes` (one zstandard frame per bit or byte plane, least significant
first) and `docs` (id, start within the part and number of tokens of every document that
has ids in the block). `parts` (Parquet) has the number of ids before each part. Parts in
order of `part`, and chunks in order of `chunk`, are the documents in ascending order.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T
from tokenizers import Tokenizer

from lumentide.llm.common import utf8

#: Bytes of memory for words and their ids that a worker remembers; the first ones it meets,
#: and so the frequent ones. Others are encoded again when they come up again.
REMEMBERED = 160 << 20
#: What an entry takes beside the bytes of the word and its ids.
_ENTRY = 180
#: A word of Latin letters between ASCII marks: the splitter makes each of the three a piece.
#: (An apostrophe before letters may be a contraction.) Up to U+024F letters are in the same
#: category and have the same lower case in all of Unicode's versions, and canonical
#: composition changes none of them.
_PLAIN = re.compile(
    r"([!-&(-/:-@[-`{-~]*+)([a-z\u00b5\u00df-\u00f6\u00f8-\u01ba\u01bd-\u01bf\u01c6\u01c9\u01cc"
    r"\u01ce-\u01f0\u01f3\u01f5-\u024f]++)([!-/:-@[-`{-~]*+)")
_ENCODERS: dict[str, WordEncoder] = {}


def _byte_letters() -> dict[int, str]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones for
    themselves, the others for the letters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


class WordEncoder:
    """Ids of texts by a tokenizer that never joins characters across white space.

    True of tokenizers that drop white space before splitting into words. The library
    encodes each distinct word. Words of Latin letters alone, which its normaliser only
    lower-cases and its splitter leaves whole, go to the library's model directly, many in
    one call and told apart by the mark of a word's end; all others go through all of it.
    Marks around such a word are split off and encoded apart, as the library does.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        special = [(i, t.content) for i, t in self.tokenizer.get_added_tokens_decoder().items()]
        self.mark_id, self.mark = special[0]
        self.specials = [s.encode() for _, s in special]
        bare = json.loads(self.tokenizer.to_str())
        suffix = bare["model"]["end_of_word_suffix"]
        bare |= {"normalizer": None, "added_tokens": [], "post_processor": None, "pre_tokenizer": {
            "type": "Split", "pattern": {"String": " "}, "behavior": "Removed", "invert": False}}
        self.model = Tokenizer.from_str(json.dumps(bare))
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        self.letters = _byte_letters()
        self.known: dict[bytes, bytes] = {}
        self.held = 0

    @classmethod
    def of(cls, path: str) -> WordEncoder:
        """The worker's encoder for this file."""
        if path not in _ENCODERS:
            _ENCODERS[path] = cls(path)
        return _ENCODERS[path]

    def _by_model(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words of plain lower-case letters."""
        made: list[bytes] = []
        for at in range(0, len(words), 5000):
            part = words[at:at + 5000]
            shown = " ".join(part).encode().decode("latin-1").replace(" ", "\n").translate(
                self.letters).replace(self.letters[10], " ")
            ids = np.array(self.model.encode_batch_fast(
                [shown], add_special_tokens=False)[0].ids, "<u4")
            stops = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(stops) != len(part):
                raise AssertionError("words can't be told apart")
            raw = ids.tobytes()
            made += [raw[a:b] for a, b in zip([0, *stops], stops)]
        return dict(zip(words, made))

    def _by_library(self, words: list[bytes]) -> Iterator[bytes]:
        """Many words in one call, told apart by a special token."""
        alone = [any(s in w for s in self.specials) for w in words]
        joined = [w.decode() for w, a in zip(words, alone) if not a]
        found: list[bytes] = []
        for at in range(0, len(joined), 2000):
            part = joined[at:at + 2000]
            ids = np.array(self.tokenizer.encode_batch_fast(
                [self.mark.join(part)], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(ids == self.mark_id)
            if len(ends) != len(part) - 1:
                raise AssertionError("words can't be told apart")
            for a, b in zip([0, *(ends + 1)], [*ends, len(ids)]):
                found.append(ids[a:b].tobytes())
        rest = iter(found)
        for word, a in zip(words, alone):
            yield np.array(self.tokenizer.encode(
                word.decode(), add_special_tokens=False).ids, np.uint32).tobytes() if a else next(rest)

    def _new(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of words that are not remembered, remembered from now on if there is room."""
        texts = b"\n".join(words).decode().lower().split("\n")
        # What may be a special token goes through the library whole.
        cut = [None if "<|" in text else _PLAIN.fullmatch(text) for text in texts]
        plain = [(word, *m.groups()) for word, m in zip(words, cut) if m]
        marks = {mark.encode() for p in plain for mark in (p[1], p[3]) if mark}
        other = list(marks.union(word for word, m in zip(words, cut) if not m))
        made = dict(zip(other, self._by_library(other)))
        cores = self._by_model(list({p[2]: None for p in plain}))
        of_mark = {mark.decode(): made[mark] for mark in marks} | {"": b""}
        made |= {word: of_mark[head] + cores[core] + of_mark[tail]
                 for word, head, core, tail in plain}
        if self.held < REMEMBERED:
            self.known |= made
            self.held += sum(map(len, made)) + sum(map(len, made.values())) + _ENTRY * len(made)
        return made

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        words: list[bytes] = []
        ends = [0]
        for text in texts:
            words += text.split()
            ends.append(len(words))
        found = list(map(self.known.get, words))
        if None in found:
            made = self._new(list({w: None for w, ids in zip(words, found) if ids is None}))
            found = [made[w] if ids is None else ids for w, ids in zip(words, found)]
        return [b"".join(found[a:b]) for a, b in zip(ends, ends[1:])]


def slices(texts: list[bytes], size: int = 2 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `size` bytes, one text at least."""
    at, held = 0, 0
    for i, text in enumerate(texts):
        if held >= size:
            yield at, i
            at, held = i, 0
        held += len(text)
    if at < len(texts):
        yield at, len(texts)


def to_planes(ids: np.ndarray, plane_bits: int, level: int) -> list[bytes]:
    """Transpose a block of 32-bit ids into bit or byte planes and compress each."""
    planes = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    if plane_bits == 1:
        bits = np.unpackbits(planes, axis=1, bitorder="little").reshape(4, -1, 8)
        planes = np.packbits(
            bits.transpose(0, 2, 1).reshape(32, -1), axis=1, bitorder="little")
    press = zstandard.ZstdCompressor(level=level)
    return [press.compress(p.tobytes()) for p in planes]


def from_planes(planes: list[bytes], plane_bits: int, n: int) -> np.ndarray:
    """The ids of a block."""
    press = zstandard.ZstdDecompressor()
    held = np.stack([np.frombuffer(press.decompress(p), np.uint8) for p in planes])
    if plane_bits == 1:
        bits = np.unpackbits(held, axis=1, count=n * 8 // 8, bitorder="little")
        held = np.packbits(
            bits.reshape(4, 8, n).transpose(0, 2, 1).reshape(4, -1), axis=1, bitorder="little")
    return np.ascontiguousarray(held.T).reshape(-1).view("<u4")


def _chunk_schema(id_type: T.DataType) -> T.StructType:
    doc = T.StructType([
        T.StructField("id", id_type), T.StructField("start", T.LongType()),
        T.StructField("n", T.LongType())])
    return T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("chunk", T.LongType()),
        T.StructField("first", T.LongType()), T.StructField("n_ids", T.IntegerType()),
        T.StructField("plane_bits", T.IntegerType()),
        T.StructField("planes", T.ArrayType(T.BinaryType())),
        T.StructField("docs", T.ArrayType(doc))])


def write_tokens(
    docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 2, id_col: str = "doc_id",
    text_col: str = "text", block: int = 65_536, plane_bits: int = 8, level: int = 3,
) -> None:
    """Encode every document, append `end_id`, and write the ids in ascending order of ids.

    The texts are dealt out by ranges of the document id (and a hash of the text, so that
    rows of one id need not stay together in one task), sorted within each range, encoded
    and cut into blocks of `block` ids as they stream by: a task holds one Arrow batch and
    one block. Ids are written once and never shuffled.

    NULL and empty texts have the end id only. NULL document ids come first. Rows of one
    document id are kept, in an order by their text's hash. An empty table writes no rows.
    """
    source = (
        docs.select(F.col(id_col).alias("_doc"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
        .withColumn("_tie", F.xxhash64("_text")))
    dealt = source.repartitionByRange("_doc", "_tie").sortWithinPartitions("_doc", "_tie")
    schema = _chunk_schema(source.schema["_doc"].dataType)
    end = np.array([end_id], "<u4").tobytes()

    def encoded(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[object, bytes]]:
        encoder = WordEncoder.of(tokenizer_path)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), utf8(batch.column(1))
            for a, b in slices(texts):
                yield from zip(ids[a:b], encoder.encode(texts[a:b]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, chunk, first, at = TaskContext.get().partitionId(), 0, 0, 0
        held, n_held, index = [], 0, []

        def flush(n: int) -> pa.RecordBatch:
            nonlocal chunk, first, held, n_held, index
            ids = np.frombuffer(b"".join(held), "<u4")
            row = {"part": part, "chunk": chunk, "first": first, "n_ids": n,
                   "plane_bits": plane_bits, "planes": to_planes(ids[:n], plane_bits, level),
                   "docs": index}
            rest = ids[n:].tobytes()
            held, n_held = ([rest] if rest else []), len(ids) - n
            chunk, first = chunk + 1, first + n
            index = [d for d in index if d["start"] + d["n"] > first]
            return pa.RecordBatch.from_pylist([row], schema=arrow)

        for doc, ids in encoded(batches):
            ids += end
            n = len(ids) // 4
            # A long document is cut as it comes, so that no more than a block is held.
            index.append({"id": doc, "start": at, "n": n})
            at += n
            for cut in range(0, len(ids), 4 * block):
                piece = ids[cut:cut + 4 * block]
                held.append(piece)
                n_held += len(piece) // 4
                while n_held >= block:
                    yield flush(block)
        if n_held:
            yield flush(n_held)

    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)
    dealt.select("_doc", "_text").mapInArrow(run, schema).write.option(
        "parquet.block.size", 16 << 20).option("compression", "none").parquet(f"{path}/chunks")
    (
        docs.sparkSession.read.schema(schema).parquet(f"{path}/chunks")
        .groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
        .withColumn("offset", F.sum("n_ids").over(  # one row per part
            Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_ids"))
        .write.parquet(f"{path}/parts"))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a written corpus: `doc_id`, `start`, `n_tokens`, `ids`.

    `start` counts the ids of all documents before; `ids` are little-endian 32-bit ids.
    Every chunk is read on its own. Documents within one chunk pass straight through,
    those that cross chunks are put together by document.
    """
    chunks = spark.read.parquet(f"{path}/chunks")
    id_type = chunks.schema["docs"].dataType.elementType["id"].dataType
    schema = T.StructType([
        T.StructField("doc_id", id_type), T.StructField("part", T.IntegerType()),
        T.StructField("at", T.LongType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("from", T.LongType()), T.StructField("ids", T.BinaryType())])
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)

    def pieces(whole: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    first, n = row["first"], row["n_ids"]
                    docs = [d for d in row["docs"] if whole == (
                        d["start"] >= first and d["start"] + d["n"] <= first + n)]
                    if not docs:
                        continue
                    ids = from_planes(row["planes"], row["plane_bits"], n).tobytes()
                    spans = [(max(d["start"], first), min(d["start"] + d["n"], first + n))
                             for d in docs]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([d["id"] for d in docs], arrow.field(0).type),
                        pa.array([row["part"]] * len(docs), pa.int32()),
                        pa.array([d["start"] for d in docs], pa.int64()),
                        pa.array([d["n"] for d in docs], pa.int64()),
                        pa.array([a for a, _ in spans], pa.int64()),
                        pa.array([ids[4 * (a - first):4 * (b - first)] for a, b in spans],
                                 pa.binary())], names=arrow.names)
        return chunks.mapInArrow(run, schema)

    crossing = (
        pieces(False).groupBy("doc_id", "part", "at", "n_tokens")
        .agg(F.array_sort(F.collect_list(F.struct("from", "ids"))).alias("_cut"))
        .withColumn("ids", F.aggregate(
            "_cut", F.lit(b""), lambda made, p: F.concat(made, p["ids"]))))
    parts = spark.read.parquet(f"{path}/parts").select("part", "offset")
    columns = ["doc_id", "part", "at", "n_tokens", "ids"]
    return (
        pieces(True).select(*columns).unionByName(crossing.select(*columns))
        .join(parts, "part")
        .select("doc_id", (F.col("offset") + F.col("at")).alias("start"), "n_tokens", "ids"))
