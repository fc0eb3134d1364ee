"""SentencePiece encoding by N-best search over the piece lattice, and decoding.

The lattice of a text falls apart at white space and line breaks where no piece spans them,
so it is solved chunk by chunk: a forward Viterbi pass gives the best score up to every
position, which is the exact heuristic of an A* search backwards from the end. The N best
of the whole text differ from its best in at most the N - 1 chunks whose second best is
nearest to their best, and are merged from those.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, types as T

from lumentide.llm.common import with_arrow_columns

SPACE = "▁"
#: Bytes of memory for chunks whose best segmentation a worker remembers, and what one takes
#: beside its characters and ids.
REMEMBERED, _ENTRY = 180 << 20, 160
#: What a character without any piece costs beyond the worst piece.
UNKNOWN_PENALTY = 10.0


class PieceLattice:
    """Pieces and scores of a model and the search over them."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.byte_ids = {}
        self.ids: dict[str, tuple[int, float]] = {}
        for i, piece in enumerate(self.pieces):
            if model.is_byte(i):
                self.byte_ids[int(piece[1:-1], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.ids[piece] = (i, model.get_score(i))
        self.bytes = {i: bytes([b]) for b, i in self.byte_ids.items()}
        self.unknown = (model.unk_id(), min(s for _, s in self.ids.values()) - UNKNOWN_PENALTY)
        # A byte below 128 is a character of its own, others are put together first.
        self.shown = [
            chr(self.bytes[i][0]) if i in self.bytes and self.bytes[i][0] < 128
            else "" if model.is_control(i) else p for i, p in enumerate(self.pieces)]
        self.part = np.array([i in self.bytes and self.bytes[i][0] > 127
                              for i in range(len(self.pieces))])
        #: Pieces with id and score, and the beginnings of pieces with None.
        self.begins: dict[str, tuple[int, float] | None] = {
            p[:k]: None for p in self.ids for k in range(1, len(p))} | self.ids
        #: Neighbours within pieces: between any others the lattice falls apart.
        self.joined = {p[k:k + 2] for p in self.ids for k in range(len(p) - 1)}
        crossing = [p for p in self.ids if SPACE in p.lstrip(SPACE) or "\n" in p and len(p) > 1]
        if crossing:
            raise ValueError(f"pieces across white space: {crossing[:3]}")
        self.known: dict[str, bytes] = {}
        self.held = 0
        self.ways = lru_cache(maxsize=20_000)(self.n_best)

    @staticmethod
    @lru_cache(maxsize=2)
    def of(path: str) -> PieceLattice:
        """The worker's lattice of this model."""
        return PieceLattice(path)

    def _forward(self, chunk: str):
        """Edges by the place where they end, the two best scores up to every place, and the
        edge by which the best comes there; of equal ones the longest."""
        size, get = len(chunk), self.begins.get
        edges: list[list[tuple[int, tuple]]] = [[] for _ in range(size + 1)]
        best, second = [0.0] + [-np.inf] * size, [-np.inf] * (size + 1)
        back: list[tuple | None] = [None] * (size + 1)
        for i in range(size):
            here, other = best[i], second[i]
            j = i + 1
            found = get(chunk[i:j]) or (self._unknown(chunk[i]), self.unknown[1])
            while True:
                if found:
                    edge = (i, found)
                    edges[j].append(edge)
                    score = here + found[1]
                    if score > best[j]:
                        also = other + found[1]
                        second[j] = best[j] if best[j] > also else also
                        best[j], back[j] = score, edge
                    elif score > second[j]:
                        second[j] = score
                j += 1
                if j > size:
                    break
                found = get(chunk[i:j], 0)
                if found == 0:  # not even the beginning of a piece
                    break
        return edges, best, second, back

    def _best(self, chunk: str) -> tuple[float, float, list[int]]:
        """The forward pass without edges: best score, what the second best lacks, best ids."""
        size, get = len(chunk), self.begins.get
        worst = -np.inf
        best, second = [worst] * (size + 1), [worst] * (size + 1)
        best[0] = 0.0
        came, by = [0] * (size + 1), [None] * (size + 1)
        for i in range(size):
            here, other = best[i], second[i]
            j = i + 1
            found = get(chunk[i:j]) or (self._unknown(chunk[i]), self.unknown[1])
            while True:
                if found:
                    score = here + found[1]
                    if score > best[j]:
                        also = other + found[1]
                        second[j] = best[j] if best[j] > also else also
                        best[j], came[j], by[j] = score, i, found[0]
                    elif score > second[j]:
                        second[j] = score
                j += 1
                if j > size:
                    break
                found = get(chunk[i:j], 0)
                if found == 0:
                    break
        at, ids = size, []
        while at:
            piece = by[at]
            if isinstance(piece, tuple):
                ids += piece[::-1]
            else:
                ids.append(piece)
            at = came[at]
        return best[size], best[size] - second[size], ids[::-1]

    def n_best(self, chunk: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The `n` best segmentations of a chunk, best first, as scores and ids.

        Of equal scores that of the forward pass comes first. Characters without a piece are
        taken byte by byte, or as the unknown piece in a model without bytes.
        """
        edges, best, _, back = self._forward(chunk)
        size = len(chunk)
        made: list[tuple[float, tuple[int, ...]]] = []
        count = 0
        # Entries: minus the score of the best whole path through here, order, place, score
        # from here to the end, and the path to the end as a linked list.
        heap = [(-best[size], 0, size, 0.0, None)]
        push, pop = heapq.heappush, heapq.heappop
        while heap and len(made) < n:
            f, _, at, tail, path = pop(heap)
            if at == 0:
                flat: list[int] = []
                while path is not None:
                    flat += path[0] if isinstance(path[0], tuple) else (path[0],)
                    path = path[1]
                made.append((-f, tuple(flat)))
                continue
            for i, (piece, score) in edges[at]:
                count += 1
                push(heap, (-(tail + score + best[i]), count, i, tail + score, (piece, path)))
        first = (best[size], self._traced(back))
        made = [first, *(m for m in made if m != first)]
        return made[:n]

    @staticmethod
    def _traced(back: list) -> tuple[int, ...]:
        """The best path of the forward pass."""
        at, path = len(back) - 1, []
        while at:
            at, (piece, _) = back[at]
            if isinstance(piece, tuple):
                path += piece[::-1]
            else:
                path.append(piece)
        return tuple(path[::-1])

    def _unknown(self, char: str) -> tuple[int, ...]:
        if self.byte_ids:
            return tuple(self.byte_ids[b] for b in char.encode())
        return (self.unknown[0],)

    def chunk(self, chunk: str) -> bytes:
        """Score of the best, how much the second best is worse, and the best ids, packed.

        One object for each remembered chunk: what a frequent word costs is fetching it.
        """
        found = self.known.get(chunk)
        if found is None:
            cuts = [k for k in range(1, len(chunk)) if chunk[k - 1:k + 1] not in self.joined]
            if cuts:  # as between a word and its full stop
                parts = [self.chunk(chunk[a:b]) for a, b in zip([0, *cuts], [*cuts, len(chunk)])]
                heads = [struct.unpack_from("<2d", p) for p in parts]
                found = struct.pack("<2d", sum(h[0] for h in heads), min(h[1] for h in heads)) + (
                    b"".join(p[16:] for p in parts))
            else:
                best, gap, ids = self._best(chunk)
                found = struct.pack(f"<2d{len(ids)}i", best, gap, *ids)
            if self.held < REMEMBERED:
                self.known[chunk] = found
                self.held += _ENTRY + 2 * len(chunk) + len(found)
        return found

    def chunks(self, text: str) -> list[str]:
        """The text's chunks, spaces written as in pieces and one put in front."""
        if not text:
            return []
        marked = (SPACE + text).replace(" ", SPACE)
        if SPACE * 2 in marked or marked.endswith(SPACE):
            return re.findall(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+", marked)
        cut = marked.replace(SPACE, " " + SPACE).replace("\n", " \n ").split(" ")
        return [c for c in cut if c]

    def encode(self, text: str, n: int):
        """Ids of the best segmentation, the `n` best scores, and what those change.

        A change is (token at which a chunk begins, tokens of it in the best, ids instead).
        """
        chunks = self.chunks(text)
        if not chunks:
            return np.zeros(0, np.int32), [0.0], [[]]
        found = list(map(self.known.get, chunks))
        if None in found:
            found = [f or self.chunk(c) for f, c in zip(found, chunks)]
        packed = np.frombuffer(b"".join(found), "<i4")
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        heads = np.cumsum(sizes) - sizes
        sizes -= 4
        body = np.ones(len(packed), bool)
        for k in range(4):
            body[heads + k] = False
        ids = packed[body]
        both = packed[heads[:, None] + np.arange(4)].copy().view("<f8")
        score, gaps = float(both[:, 0].sum()), both[:, 1]
        if n == 1:
            return ids, [score], [[]]
        near = np.argsort(gaps, kind="stable")[:n - 1] if len(gaps) < 2 * n else np.sort(
            np.argpartition(gaps, n - 2)[:n - 1])
        ways: list[tuple[float, tuple]] = [(0.0, ())]
        for c in near.tolist():
            if np.isinf(gaps[c]):
                continue
            own = self.ways(chunks[c], n)
            ways = heapq.nsmallest(n, (
                (loss + own[0][0] - s, (*picks, (c, k)) if k else picks)
                for loss, picks in ways for k, (s, _) in enumerate(own)))
        ends = np.cumsum(sizes)
        changes = [[
            (int(ends[c] - sizes[c]), int(sizes[c]), self.ways(chunks[c], n)[k][1])
            for c, k in sorted(picks)] for _, picks in ways]
        return ids, [score - loss for loss, _ in ways], changes

    def decode(self, ids: np.ndarray) -> str:
        """The text of a sequence of ids; bytes that are no UTF-8 become replacement characters."""
        parts: list[str] = []
        cuts = np.flatnonzero(np.diff(self.part[ids], prepend=False, append=False)).tolist()
        for a, b in zip([0, *cuts], [*cuts, len(ids)]):
            own = ids[a:b].tolist()
            if own and self.part[own[0]]:
                parts.append(b"".join(self.bytes[i] for i in own).decode(errors="replace"))
            else:
                parts += map(self.shown.__getitem__, own)
        return "".join(parts).replace(SPACE, " ").removeprefix(" ")


_CHANGES = T.ArrayType(T.StructType([
    T.StructField("score", T.DoubleType()),
    T.StructField("changes", T.ArrayType(T.StructType([
        T.StructField("at", T.IntegerType()), T.StructField("n", T.IntegerType()),
        T.StructField("ids", T.ArrayType(T.IntegerType()))])))]))


def encode_pieces(
    docs: DataFrame, model_path: str, n_best: int = 4, text_col: str = "text",
    verify: bool = False,
) -> DataFrame:
    """Add `ids` (best segmentation) and `n_best` (scores, and what each changes in `ids`).

    With `verify` also `round_trip`: whether decoding the ids gives the text again, in the
    same pass, so that neither ids nor texts travel to a second one. An input column of one of these names is replaced. Narrow: every text is encoded whole
    where it is; a worker remembers the frequent chunks, a bounded number of them. A word
    without white space is one chunk whatever its length; its lattice has at most as many
    edges as its length times the longest piece.

    NULL and empty texts have no ids and one segmentation of score 0. A text with fewer than
    `n_best` segmentations lists those it has. Of equal scores the order is fixed by the
    text alone, so repeated rows have equal results. Characters without a piece, among them
    line breaks, are encoded as bytes. The character U+2581 stands for a space.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    def compute(texts: pa.Array) -> list[pa.Array]:
        lattice = PieceLattice.of(model_path)
        ids, ways, same = [], [], []
        for text in texts.to_pylist():
            own, scores, changes = lattice.encode(text or "", n_best)
            ids.append(own)
            if verify:
                same.append(lattice.decode(own) == (text or ""))
            ways.append([
                {"score": s, "changes": [{"at": a, "n": n, "ids": list(i)} for a, n, i in c]}
                for s, c in zip(scores, changes)])
        offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
        flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32())),
                pa.array(ways, to_arrow_type(_CHANGES)), *([pa.array(same, pa.bool_())] * verify)]

    return with_arrow_columns(
        docs, compute, [text_col],
        [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_best", _CHANGES),
         *([T.StructField("round_trip", T.BooleanType())] * verify)])


def decode_pieces(
    encoded: DataFrame, model_path: str, ids_col: str = "ids", name: str = "decoded",
) -> DataFrame:
    """Add the text of the ids; the exact text that was encoded. NULL ids are no ids."""
    def compute(lists: pa.Array) -> list[pa.Array]:
        lattice = PieceLattice.of(model_path)
        flat, at = lists.values.to_numpy(), lists.offsets.to_numpy()
        return [pa.array([
            lattice.decode(flat[a:b]) if ok else "" for a, b, ok in zip(
                at[:-1].tolist(), at[1:].tolist(), lists.is_valid().to_pylist())], pa.string())]

    return with_arrow_columns(encoded, compute, [ids_col], [T.StructField(name, T.StringType())])
