"""Exact substring deduplication with suffix arrays over content-defined shards.

Every window of `length` bytes is assigned to the smallest hash among the 20-byte strings
inside it, so equal windows, wherever they are, have the same hash. Consecutive windows of
one hash form a run. Windows can only repeat across documents if their hash occurs in two
of them, which is found from 6-byte digests of the runs alone. The bytes of the remaining
runs (contexts) are brought together by hash, each distinct context of a hash once, and
every shard of contexts is sorted by a suffix array; windows that share a prefix of
`length` bytes are neighbours in it, and permuted common prefixes tell where they begin.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from lumentide.llm.common import (
    cut_batches, on_own_columns, utf8, with_arrow_columns, written,
)
from lumentide.llm.sais import common_prefixes, suffix_array
from lumentide.session import remove_dir

#: Length of the hashed strings, and the most windows in one run.
GRAM, MOST = 20, 64
_MIX = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_OTHER = np.random.default_rng(21).integers(0, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
NOWHERE = -(1 << 63)
TOLD = NOWHERE + 1


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hashes of all strings of GRAM bytes, built from 1, 2, 4 … bytes."""
    mask = (1 << 64) - 1
    power = lambda n: np.uint64(pow(_BASE, n, 1 << 64) & mask)
    sizes = {1: _MIX[data]}
    size = 1
    while 2 * size <= GRAM:
        h = sizes[size]
        sizes[2 * size] = h[:-size] * power(size) + h[size:]
        size *= 2
    made, rest = sizes[size], GRAM - size
    total = size
    while rest:
        part = 1 << rest.bit_length() - 1
        tail = sizes[part][total:]
        made = made[:len(tail)] * power(part) + tail[:len(made)]
        total, rest = total + part, rest - part
    made ^= made >> np.uint64(32)
    made *= np.uint64(0xD6E8FEB86659FD93)
    made ^= made >> np.uint64(29)
    return made


def _powers(base: int, n: int) -> np.ndarray:
    row = np.full(n, base, np.uint64)
    row[0] = 1
    return np.multiply.accumulate(row)


_POWERS = (_powers(_BASE, 1 << 17), _powers(_INVERSE, 1 << 17))


def _checks(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes between `starts` and `ends`, from one running sum."""
    n = len(data) + 1
    up, down = (p[:n] if n <= len(p) else _powers(b, n)
                for p, b in zip(_POWERS, (_BASE, _INVERSE)))
    total = np.zeros(n, np.uint64)
    np.cumsum(_OTHER[data] * up[:-1], out=total[1:])
    return (total[ends] - total[starts]) * down[starts]


def _runs(data: np.ndarray, offsets: np.ndarray, sizes: np.ndarray, length: int):
    """Text, start in it, number of windows, hash and check of the runs of texts laid end to end."""
    n = len(data) - length + 1
    low, span, want = _gram_hashes(data), 1, length - GRAM + 1
    while 2 * span <= want:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if want > span:
        low = np.minimum(low[:len(low) - (want - span)], low[want - span:])
    begin = np.empty(n, bool)
    begin[0] = True
    np.not_equal(low[1:], low[:-1], out=begin[1:])
    # A run ends with its text; windows across two texts are nobody's.
    begin[offsets[offsets < n]] = True
    ends = offsets + sizes - length + 1
    begin[ends[ends < n]] = True
    starts = np.flatnonzero(begin)
    counts = np.diff(np.append(starts, n))
    of = np.searchsorted(offsets, starts, side="right") - 1
    inside = starts < ends[of]
    starts, counts, of = starts[inside], counts[inside], of[inside]
    if len(counts) and counts.max() > MOST:  # periodic text: each window stays in one piece
        times = -(-counts // MOST)
        row = np.repeat(np.arange(len(starts)), times)
        k = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
        counts = np.minimum(MOST, counts[row] - k * MOST)
        starts, of = starts[row] + k * MOST, of[row]
    checks = _checks(data, starts, starts + counts + length - 1)
    return of, starts - offsets[of], counts, low[starts], checks


def runs(texts: list[bytes], length: int, piece: int = 1 << 16):
    """Text, start, number of windows, hash and check of the runs of all texts, in order.

    The hash is that of the run's windows, the check is one of all its bytes.

    Texts are taken together up to `piece` bytes, so that short ones cost no more per byte
    than long ones and the arrays stay in the processor's cache.
    """
    long = [(i, t) for i, t in enumerate(texts) if len(t) >= length]
    made, at = [], 0
    while at < len(long):
        end, held = at, 0
        while end < len(long) and (end == at or held + len(long[end][1]) <= piece):
            held += len(long[end][1])
            end += 1
        sizes = np.array([len(t) for _, t in long[at:end]])
        offsets = np.cumsum(sizes) - sizes
        of, *rest = _runs(
            np.frombuffer(b"".join(t for _, t in long[at:end]), np.uint8), offsets, sizes, length)
        made.append((np.array([i for i, _ in long[at:end]])[of], *rest))
        at = end
    if not made:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    return tuple(np.concatenate(c) for c in zip(*made))


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(NOWHERE)).alias("_doc"),
        F.col(text_col).alias("_text"), F.xxhash64(text_col).alias("_tag"))


def shared_runs(source: DataFrame, length: int, bucket_bytes: int = 8 << 20) -> DataFrame:
    """`_doc` and `run` (its place in the document) of the runs whose hash is in two documents.

    Of the runs with the same bytes one also has `low` and `high`, the smallest and largest
    document holding them: it is the one to send its bytes. A superset is harmless: hashes
    are cut to 6 bytes besides the bucket. Each task sends, by bucket of the hash, its
    batch's hashes and checks with documents and places packed into one value. A hash with
    more than MOST runs in a batch is put out at once, and one of its runs goes on to tell
    the others, so that a frequent line sends a bounded number from each batch; the number
    of buckets follows the measured size of the texts.
    """
    total = source.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    packed = T.StructType([
        T.StructField("bucket", T.LongType()), T.StructField("found", T.BooleanType()),
        T.StructField("n", T.IntegerType()), T.StructField("hashes", T.BinaryType()),
        T.StructField("checks", T.BinaryType()), T.StructField("docs", T.BinaryType()),
        T.StructField("counts", T.BinaryType()), T.StructField("places", T.BinaryType())])

    def cut(values: np.ndarray) -> bytes:
        return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()

    def whole(data: bytes, n: int) -> np.ndarray:
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
        return wide.view("<u8").reshape(-1)

    def pack(bucket: int, found: bool, hashes, checks, docs, places) -> dict:
        edge = np.flatnonzero(np.append(True, docs[1:] != docs[:-1]))
        return {"bucket": bucket, "found": found, "n": len(docs), "hashes": cut(hashes),
                "checks": cut(checks), "docs": docs[edge].astype("<i8").tobytes(),
                "counts": np.diff(np.append(edge, len(docs))).astype("<u4").tobytes(),
                "places": places.astype("<u4").tobytes()}

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut_batches(batches, 1):
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            of, _, _, hashes, checks = runs(utf8(batch.column(1)), length)
            if not len(of):
                continue
            docs = ids[of]
            places = np.arange(len(of)) - np.searchsorted(of, np.arange(len(ids)))[of]
            bucket = ((hashes >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(hashes, kind="stable")
            edge = np.flatnonzero(np.append(True, hashes[order][1:] != hashes[order][:-1]))
            size = np.diff(np.append(edge, len(order)))
            hot = np.empty(len(order), bool)
            hot[order] = np.repeat(size > MOST, size)
            rows, rest = [], np.arange(len(docs))
            if hot.any():
                at = np.flatnonzero(hot)
                rows.append(pack(int(ids[0]) % buckets, True, hashes[at], checks[at], docs[at], places[at]))
                rest = np.sort(np.concatenate([np.flatnonzero(~hot), order[edge[size > MOST]]]))
            by = rest[np.argsort(bucket[rest], kind="stable")]
            cuts = np.flatnonzero(np.append(True, bucket[by][1:] != bucket[by][:-1]))
            for a, b in zip(cuts, np.append(cuts[1:], len(by))):
                at = by[a:b]
                # The one run of a hot hash carries no document: its runs are out.
                rows.append(pack(int(bucket[at[0]]), False, hashes[at], checks[at],
                                 np.where(hot[at], TOLD, docs[at]), places[at]))
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    def chosen(hashes, checks, docs, places, all_shared: bool) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((docs, checks, hashes))
        h, c, d = hashes[order], checks[order], docs[order]
        new_hash = np.append(True, h[1:] != h[:-1])
        edge = np.flatnonzero(new_hash)
        size = np.diff(np.append(edge, len(h)))
        shared = np.full(len(edge), True) if all_shared else (
            np.minimum.reduceat(d, edge) != np.maximum.reduceat(d, edge))
        keep = np.repeat(shared, size) & (d != TOLD)
        if not keep.any():
            return
        h, c, d, p = h[keep], c[keep], d[keep], places[order][keep]
        start = np.append(True, (h[1:] != h[:-1]) | (c[1:] != c[:-1]))
        edge = np.flatnonzero(start)
        high = np.zeros(len(d), np.int64)
        high[edge] = np.maximum.reduceat(d, edge)
        for a in range(0, len(d), 100_000):
            at = slice(a, a + 100_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(d[at]), pa.array(p[at].astype(np.int32)),
                 pa.array(d[at], mask=~start[at]), pa.array(high[at], mask=~start[at])],
                names=result.names)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            for row in batch.to_pylist():
                own = np.repeat(np.frombuffer(row["docs"], "<i8"),
                                np.frombuffer(row["counts"], "<u4").astype(np.int64))
                columns = (whole(row["hashes"], row["n"]), whole(row["checks"], row["n"]), own,
                           np.frombuffer(row["places"], "<u4"))
                if row["found"]:
                    yield from chosen(*columns, True)
                else:
                    held.append(columns)
        if held:
            yield from chosen(*(np.concatenate(c) for c in zip(*held)), False)

    result = T.StructType([
        T.StructField("_doc", T.LongType()), T.StructField("run", T.IntegerType()),
        T.StructField("low", T.LongType()), T.StructField("high", T.LongType())])
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(packed)
    return source.mapInArrow(send, packed).groupBy("bucket").applyInArrow(match, result)


def context_digest(body: bytes) -> bytes:
    """96 bits that stand for the bytes of a context."""
    return xxhash.xxh3_128_digest(body)[:12]


def contexts(source: DataFrame, shared: DataFrame, length: int) -> DataFrame:
    """A row per shared run: its document, `start` and `digest`.

    Those chosen to send their bytes also have `key` (the hash), `context`, `low` and `high`.
    """
    wanted = shared.groupBy("_doc").agg(
        F.collect_list(F.struct("run", "low", "high")).alias("_runs"))
    met = source.join(wanted, "_doc").select("_doc", "_text", "_runs", "_tag")
    schema = T.StructType([
        T.StructField("_doc", T.LongType()), T.StructField("_tag", T.LongType()),
        T.StructField("start", T.LongType()), T.StructField("digest", T.BinaryType()),
        T.StructField("key", T.LongType()), T.StructField("context", T.BinaryType()),
        T.StructField("low", T.LongType()), T.StructField("high", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut_batches(batches, 1):
            texts = utf8(batch.column(1))
            of, starts, sizes, hashes, _ = runs(texts, length)
            begins = np.searchsorted(of, np.arange(len(texts) + 1))
            lists = batch.column(2)
            fields, cuts = lists.flatten(), lists.offsets.to_numpy()
            cuts = cuts - cuts[0]
            row_of = np.repeat(np.arange(len(texts)), np.diff(cuts))
            at = begins[row_of] + fields.field(0).to_numpy()
            # Places beyond the text's runs are those of another row with this id.
            inside = np.flatnonzero(at < begins[row_of + 1])
            at, row_of = at[inside], row_of[inside]
            low, high = (fields.field(i).take(pa.array(inside)) for i in (1, 2))
            sends = low.is_valid().to_pylist()
            a = starts[at]
            bodies = [texts[r][x:y] for r, x, y in zip(
                row_of.tolist(), a.tolist(), (a + sizes[at] + length - 1).tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row_of)), batch.column(3).take(pa.array(row_of)),
                 pa.array(a), pa.array(map(context_digest, bodies), pa.binary()),
                 pa.array(hashes[at].view(np.int64), mask=~np.array(sends, bool)),
                 pa.array([b if s else None for b, s in zip(bodies, sends)], pa.binary()),
                 low, high], names=schema.names)

    return met.mapInArrow(run, schema)


def first_holders(texts: list[bytes], low: np.ndarray, high: np.ndarray, length: int):
    """For every window of the texts, the smallest and largest document holding that string.

    One suffix array over all texts: returns flat arrays over the windows, in order.
    """
    data = np.frombuffer(b"\xff".join(texts) + b"\xff", np.uint8)
    sizes = np.array([len(t) for t in texts])
    begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    windows = sizes - length + 1
    text_of = np.repeat(np.arange(len(texts)), windows)
    at = begins[text_of] + np.arange(len(text_of)) - np.repeat(np.cumsum(windows) - windows, windows)
    order = suffix_array(data)
    shared = common_prefixes(data, order, length)
    number = np.full(len(data), -1, np.int64)
    number[at] = np.arange(len(at))
    # No window holds the separator, so all suffixes that begin with it are windows.
    ranked = order[number[order] >= 0]
    edge = np.flatnonzero(shared[ranked] < length)
    rows = number[ranked]
    least = np.minimum.reduceat(low[text_of[rows]], edge)
    most = np.maximum.reduceat(high[text_of[rows]], edge)
    count = np.diff(np.append(edge, len(rows)))
    smallest, largest = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
    smallest[rows], largest[rows] = np.repeat(least, count), np.repeat(most, count)
    return smallest, largest, windows


_SPANS = T.ArrayType(T.StructType([
    T.StructField("at", T.IntegerType()), T.StructField("n", T.IntegerType()),
    T.StructField("low", T.LongType())]))


def sorted_shards(distinct: DataFrame, length: int, shard_bytes: int, tasks: int) -> DataFrame:
    """`digest` and `spans`: runs of windows (`at`, `n`) that also start in document `low`.

    `distinct` has `key`, `context`, `low`, `high`. Rows arrive sorted by key and are cut into
    shards of about `shard_bytes` between two keys. Equal windows have equal keys, so a
    context that is its key's only one shares none with any other; it needs no sorting.
    """
    schema = T.StructType([T.StructField("digest", T.BinaryType()), T.StructField("spans", _SPANS)])

    def solve(rows: dict[bytes, list]) -> pa.RecordBatch | None:
        low, high = (np.array([r[i] for r in rows.values()], np.int64) for i in (1, 2))
        smallest, largest, windows = first_holders([r[0] for r in rows.values()], low, high, length)
        ends = np.cumsum(windows)
        begin = np.zeros(len(smallest) + 1, bool)
        begin[ends - windows] = True
        begin[1:-1] |= smallest[1:] != smallest[:-1]
        # A string of one document only takes nothing from it.
        useful = smallest < largest
        begin[1:-1] |= useful[1:] != useful[:-1]
        at = np.flatnonzero(begin[:-1])
        size = np.diff(np.append(at, len(smallest)))
        keep = useful[at]
        at, size = at[keep], size[keep]
        if not len(at):
            return None
        text = np.searchsorted(ends, at, side="right")
        offsets = np.searchsorted(text, np.arange(len(rows) + 1))
        batch = spans_of(list(rows), offsets, at - (ends - windows)[text], size, smallest[at])
        return batch.filter(pa.array(np.diff(offsets) > 0))

    def spans_of(digests: list[bytes], offsets, at, size, low) -> pa.RecordBatch:
        spans = pa.ListArray.from_arrays(
            pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(
                [pa.array(np.asarray(at, np.int32)), pa.array(np.asarray(size, np.int32)),
                 pa.array(np.asarray(low, np.int64))], names=["at", "n", "low"]))
        return pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), spans], names=schema.names)

    def alone(rows: dict[bytes, list]) -> pa.RecordBatch:
        """Contexts that no other one shares a key with: all their windows have their holders."""
        n = np.array([len(r[0]) - length + 1 for r in rows.values()])
        return spans_of(list(rows), np.arange(len(rows) + 1), np.zeros(len(n)), n,
                        [r[1] for r in rows.values()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: dict[bytes, list] = {}
        single: dict[bytes, list] = {}
        own: dict[bytes, list] = {}
        held, last = 0, None

        def close() -> int:
            """The key's contexts go to the shard, a single one with two holders apart."""
            if len(own) > 1:
                shard.update(own)
                return sum(len(r[0]) for r in own.values())
            single.update({d: r for d, r in own.items() if r[1] < r[2]})
            return 0

        for batch in batches:
            for key, body, low, high in zip(*(c.to_pylist() for c in batch.columns)):
                if key != last:
                    held += close()
                    own, last = {}, key
                    if held >= shard_bytes:
                        made = solve(shard)
                        if made is not None:
                            yield made
                        shard, held = {}, 0
                    if len(single) >= 10_000:
                        yield alone(single)
                        single = {}
                digest = context_digest(body)
                row = own.get(digest)
                if row is None:
                    own[digest] = [body, low, high]
                else:
                    row[1], row[2] = min(row[1], low), max(row[2], high)
        close()
        if single:
            yield alone(single)
        made = solve(shard) if shard else None
        if made is not None:
            yield made

    return (
        distinct.select("key", "context", "low", "high")
        .repartition(tasks, "key").sortWithinPartitions("key").mapInArrow(run, schema))


def by_windows(distinct: DataFrame, length: int) -> DataFrame:
    """The same as `sorted_shards`, for keys with too many contexts for one shard.

    Every window is a row of its own, brought together by its bytes; nothing gathers a key.
    """
    each = (
        distinct.groupBy("digest").agg(
            F.min("low").alias("low"), F.max("high").alias("high"), F.first("context").alias("context"))
        .select("digest", "low", "high", F.explode(F.transform(
            F.sequence(F.lit(0), F.octet_length("context") - length),
            lambda i: F.struct(i.alias("at"), F.substring("context", i + 1, F.lit(length)).alias("w"))
        )).alias("_x"))
        .select("digest", "low", "high", "_x.*"))
    # Stored first: a join with an aggregate on its own key is not split where a key is hot.
    holders = written(each.groupBy("w").agg(
        F.min("low").alias("least"), F.max("high").alias("most")).filter("least < most"), "holders")
    return (
        each.join(holders, "w")
        .groupBy("digest").agg(F.sort_array(F.collect_list(F.struct(
            "at", F.lit(1).alias("n"), F.col("least").alias("low")))).alias("spans")))


def substring_dedup(
    docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text",
    shard_bytes: int = 1 << 19, hot_bytes: int = 64 << 20, task_bytes: int = 32 << 20,
) -> DataFrame:
    """Remove every byte covered by a `length`-byte string that starts in a smaller document too.

    Adds `n_bytes`, `n_removed`, `n_spans` (maximal removed runs), `removed` (their `at` and
    `end`) and `kept` (the remaining bytes, binary: a cut may fall inside a character); an
    input column of one of these names is replaced. Ids are cast to bigint. Overlaps count,
    and strings are judged on the input. Matches never cross documents.

    Three tables are written to the shared folder on the way: the shared runs (removed once
    read), their contexts, and the spans found; each job's shuffle files go when it ends. A
    hash whose contexts hold more than `hot_bytes` is not sorted in one shard but resolved
    window by window, with the same result. The bytes of a context in thousands of documents
    are sent once, and the join back to the documents is an equi-join that AQE splits.

    NULL and empty texts have no bytes. Rows of one id are one document: none removes
    anything from another, and a string that starts in any of them counts for larger ids.
    A NULL id is smaller than all others. An empty table gives an empty table.
    """
    return on_own_columns(
        docs, lambda own: _without_repeats(
            own, length, id_col, text_col, shard_bytes, hot_bytes, task_bytes),
        keep=(id_col, text_col), add=("n_bytes", "n_removed", "n_spans", "removed", "kept"))


def _without_repeats(
    docs: DataFrame, length: int, id_col: str, text_col: str, shard_bytes: int, hot_bytes: int,
    task_bytes: int,
) -> DataFrame:
    source = _source(docs, id_col, text_col)
    found = written(shared_runs(source, length), "shared-runs")
    held = written(contexts(source, found, length), "contexts")
    for path in {f.rpartition("/")[0] for f in found.inputFiles()[:1]}:
        remove_dir(docs.sparkSession, path)  # nothing reads it any more
    distinct = held.filter(F.col("context").isNotNull())
    sizes = written(
        distinct.groupBy("key").agg(F.sum(F.octet_length("context")).alias("_bytes"))
        .groupBy((F.col("_bytes") > hot_bytes).alias("_hot"), F.when(
            F.col("_bytes") > hot_bytes, F.col("key")).alias("key")).agg(F.sum("_bytes").alias("_bytes")),
        "key-sizes")
    hot = sizes.filter("_hot").select("key")
    total = sizes.filter("not _hot").agg(F.sum("_bytes")).first()[0] or 0
    # As many tasks as the measured bytes need, and what the cluster is set to at least.
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(least, -(-total // task_bytes))
    if hot.isEmpty():
        solved = sorted_shards(distinct, length, shard_bytes, tasks)
    else:
        solved = sorted_shards(
            distinct.join(hot, "key", "left_anti"), length, shard_bytes, tasks
        ).unionByName(by_windows(distinct.join(hot, "key", "left_semi"), length))
    solved = written(solved, "spans")
    covered = (
        held.select("_doc", "_tag", "start", "digest").join(solved, "digest")
        .select("_doc", "_tag", "start", F.filter("spans", lambda s: s["low"] < F.col("_doc")).alias("spans"))
        .filter(F.size("spans") > 0)
        .groupBy("_doc", "_tag").agg(F.collect_list(F.transform("spans", lambda s: F.struct(
            (F.col("start") + s["at"]).alias("at"), s["n"].alias("n")))).alias("_spans"))
        .select("_doc", "_tag", F.flatten("_spans").alias("_spans")))
    key = F.coalesce(docs[id_col].cast("bigint"), F.lit(NOWHERE))
    met = docs.join(
        covered, (key == covered["_doc"]) & (F.xxhash64(docs[text_col]) == covered["_tag"]), "left"
    ).drop("_doc", "_tag")
    spans = T.ArrayType(T.StructType([
        T.StructField("at", T.LongType()), T.StructField("end", T.LongType())]))

    def cut(texts: pa.Array, all_spans: pa.Array) -> list[pa.Array]:
        n_bytes, n_removed, removed, kept = [], [], [], []
        for text, own in zip(utf8(texts), all_spans.to_pylist()):
            gone, rest, at = [], [], 0
            for begin, n in sorted((s["at"], s["n"]) for s in own or ()):
                end = min(begin + n + length - 1, len(text))
                if gone and begin <= gone[-1]["end"]:
                    gone[-1]["end"] = max(gone[-1]["end"], end)
                else:
                    gone.append({"at": begin, "end": end})
            for s in gone:
                rest.append(text[at:s["at"]])
                at = s["end"]
            rest.append(text[at:])
            kept.append(b"".join(rest))
            n_bytes.append(len(text))
            n_removed.append(len(text) - len(kept[-1]))
            removed.append(gone)
        return [pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()),
                pa.array([len(g) for g in removed], pa.int64()),
                pa.array(removed, to_arrow_type(spans)), pa.array(kept, pa.binary())]

    from pyspark.sql.pandas.types import to_arrow_type
    return with_arrow_columns(
        met, cut, [text_col, "_spans"],
        [T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
         T.StructField("n_spans", T.LongType()), T.StructField("removed", spans),
         T.StructField("kept", T.BinaryType())], drop=["_spans"])
