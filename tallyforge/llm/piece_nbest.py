"""N-best SentencePiece segmentation: forward Viterbi, then backward A-star over the piece lattice."""

from __future__ import annotations

import functools
import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REMEMBERED = 400_000  # stretches whose best path a task keeps at hand
KEPT = 64  # characters of a stretch up to which it is kept, so that all of them have a bound in bytes
TOGETHER = 32  # characters of a stretch up to which those of one length are solved in one numpy pass
SPACE = "▁"  # stands for a blank
LOWEST = -1e8  # scores below mark pieces that are out of use


class Pieces:
    """Pieces of a model file and the lattice of a text.

    A text is a blank and its characters, blanks written as SPACE.  Every piece found in it
    is an edge; a character that is no piece of its own is an edge of 10 below the lowest
    score, written as its bytes; pieces that the file scores below that count as much.
    The score of a path is the sum of its edges.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        self.text = [model.id_to_piece(i) for i in ids]
        self.byte = {int(self.text[i][3:5], 16): i for i in ids if model.is_byte(i)}
        value = {i: bytes([b]) for b, i in self.byte.items()}
        self.raw = [value.get(i, self.text[i].encode()) for i in ids]
        usual = [i for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.unknown = min((s for i in usual if (s := model.get_score(i)) > LOWEST), default=0.0) - 10
        self.unknown_id = model.unk_id()
        self.edges = {self.text[i]: (i, max(model.get_score(i), self.unknown)) for i in usual}
        self.prefixes = {p[:k] for p in self.edges for k in range(1, len(p) + 1)}
        within = {p for p in self.edges if SPACE in p.lstrip(SPACE)}
        alone = "".join(c for c in "\n\t\r" if not any(c in p for p in self.edges))
        # no edge leads from a character into a SPACE, nor over a character without pieces: paths part there
        pattern = rf"[{alone}]|" if alone else ""
        self.hashed = _Hashed(self.edges)
        self.searched: dict[tuple[str, int], list[tuple[bytes, float]]] = {}
        self.stretch = re.compile(rf"{pattern}{SPACE}*[^{SPACE}{alone}]+|{SPACE}+") if not within else re.compile(r"(?s).+")

    def lattice(self, text: str) -> list[list[tuple[int, float, int]]]:
        """For every start the edges (end, score, id); an unknown character has the id -1."""
        out, n, edges, prefixes = [], len(text), self.edges, self.prefixes
        for i in range(n):
            here = []
            for j in range(i + 1, n + 1):
                piece = text[i:j]
                if piece not in prefixes:
                    break
                if (edge := edges.get(piece)) is not None:
                    here.append((j, edge[1], edge[0]))
            if not here or here[0][0] != i + 1:
                here.append((i + 1, self.unknown, -1))
            out.append(here)
        return out

    def ids_of(self, text: str, path: list[tuple[int, int, int]]) -> list[int]:
        """Ids of edges (start, end, id); unknown characters as bytes, or as the unknown id if the model has none."""
        out: list[int] = []
        for i, j, piece in path:
            if piece >= 0:
                out.append(piece)
            elif self.byte:
                out += [self.byte[b] for b in text[i:j].encode("utf-8", "surrogatepass")]
            else:
                out.append(self.unknown_id)
        return out

    def best(self, text: str) -> tuple[bytes, float, float]:
        """(ids, score, gap): the best path, and how far the second best lies below it.

        Any other path has an edge off the best one, so the second best is the best over
        such edges of what leads to it, its own score and what follows.
        """
        n, lattice = len(text), self.lattice(text)
        ahead, via = [0.0] + [-np.inf] * n, [None] * (n + 1)
        for i in range(n):
            base = ahead[i]
            for j, s, piece in lattice[i]:
                if base + s > ahead[j]:
                    ahead[j], via[j] = base + s, (i, j, piece)
        behind = [-np.inf] * n + [0.0]
        for i in range(n - 1, -1, -1):
            behind[i] = max(s + behind[j] for j, s, _ in lattice[i])
        path, at = [], n
        while at:
            path.append(via[at])
            at = via[at][0]
        path.reverse()
        second, on = -np.inf, set(path)
        for i in range(n):
            for j, s, piece in lattice[i]:
                if (found := ahead[i] + s + behind[j]) > second and (i, j, piece) not in on:
                    second = found
        return np.array(self.ids_of(text, path), "<u4").tobytes(), ahead[n], ahead[n] - second

    def best_of_many(self, texts: list[str]) -> list[tuple[bytes, float, float]]:
        """best() of texts of one length, all at once; of equal scores the longer last piece wins, as there.

        Arrays have a row per character and a column per text.
        """
        n, m = len(texts[0]), len(texts)
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").reshape(m, n).T
        longest = min(n, self.hashed.longest)
        piece = list(self.hashed.look_up(np.ascontiguousarray(codes)))  # by length - 1: of the edge from every start
        score = [self.hashed.scores[found] for found in piece]  # the last entry, for -1, is minus infinity
        score[0] = np.where(piece[0] < 0, self.unknown, score[0])
        ahead, via = np.zeros((n + 1, m)), np.zeros((n + 1, m), np.int8)
        for j in range(1, n + 1):
            top = min(longest, j)
            best, size = ahead[j - top] + score[top - 1][j - top], np.full(m, top, np.int8)
            for k in range(top - 1, 0, -1):
                way = ahead[j - k] + score[k - 1][j - k]
                better = way > best
                best = np.where(better, way, best)
                size[better] = k
            ahead[j], via[j] = best, size
        behind = np.zeros((n + 1, m))
        for i in range(n - 1, -1, -1):
            best = score[0][i] + behind[i + 1]
            for k in range(2, min(longest, n - i) + 1):
                np.maximum(best, score[k - 1][i] + behind[i + k], out=best)
            behind[i] = best
        at, used = np.full(m, n), np.zeros(m, int)
        ids, off = np.zeros((m, n), "<u4"), [s.copy() for s in score]  # ids end at the right
        whole, real = np.ones(m, bool), self.hashed.ids
        columns = np.arange(m)
        while len(columns):
            size = via[at[columns], columns]
            for k in np.flatnonzero(np.bincount(size)):
                own = columns[size == k]
                start = at[own] - k
                found = piece[k - 1][start, own]
                whole[own] &= found >= 0
                used[own] += 1
                ids[own, n - used[own]] = real[found]
                off[k - 1][start, own] = -np.inf
                at[own] = start
            columns = columns[at[columns] > 0]
        second = np.full(m, -np.inf)
        for k in range(1, longest + 1):
            for i in range(n - k + 1):
                np.maximum(second, ahead[i] + off[k - 1][i] + behind[i + k], out=second)
        buffer, begin = ids.tobytes(), (4 * (n - used)).tolist()
        rows = zip(texts, whole.tolist(), begin, ahead[n].tolist(), (ahead[n] - second).tolist())
        return [
            (buffer[4 * n * row + first : 4 * n * (row + 1)], total, gap) if known else self.best(text)
            for row, (text, known, first, total, gap) in enumerate(rows)
        ]

    def learn(self, stretches: set[str], seen: dict) -> None:
        """Put the best paths of stretches into seen."""
        by_size: dict[int, list[str]] = {}
        for one in stretches:
            by_size.setdefault(len(one), []).append(one)
        for size, group in by_size.items():
            if size <= TOGETHER and len(group) > 4:
                for k in range(0, len(group), 4096):
                    seen.update(zip(group[k : k + 4096], self.best_of_many(group[k : k + 4096])))
            else:
                seen.update((one, self.best(one)) for one in group)

    def paths(self, text: str, n_best: int) -> list[tuple[bytes, float]]:
        """The n_best best paths, best first: (ids, score).

        Forward Viterbi gives the best score of every prefix.  The search runs backward
        from the end; a partial path is ranked by its score plus that of the best prefix
        before it, which is exact, so complete paths leave the agenda in order.  Ties
        leave it in the order of their making.
        """
        n, lattice = len(text), self.lattice(text)
        ahead = [0.0] + [-np.inf] * n
        into: list[list[tuple[int, float, int]]] = [[] for _ in range(n + 1)]
        for i in range(n):
            for j, s, piece in lattice[i]:
                ahead[j] = max(ahead[j], ahead[i] + s)
                into[j].append((i, s, piece))
        agenda, made, out = [(-ahead[n], 0, n, 0.0, None)], 0, []
        while agenda and len(out) < n_best:
            _, _, at, score, rest = heapq.heappop(agenda)
            if not at:
                path = []
                while rest:
                    edge, rest = rest
                    path.append(edge)
                out.append((np.array(self.ids_of(text, path), "<u4").tobytes(), score))
                continue
            for i, s, piece in into[at]:
                made += 1
                heapq.heappush(agenda, (-(ahead[i] + s + score), made, i, s + score, ((i, at, piece), rest)))
        return out

    def _paths(self, text: str, n: int) -> list[tuple[bytes, float]]:
        if len(text) > KEPT:
            return self.paths(text, n)
        if len(self.searched) >= REMEMBERED // 8:
            self.searched.clear()
        if (text, n) not in self.searched:
            self.searched[text, n] = self.paths(text, n)
        return self.searched[text, n]

    def stretches(self, text: str) -> list[str]:
        return self.stretch.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def n_best(self, text: str, n: int, seen: dict) -> list[tuple[bytes, float]]:
        """The n best segmentations of a whole text, best first: (ids, score)."""
        return self.n_best_of([text], n, seen)[0]

    def n_best_of(self, texts: list[str], n: int, seen: dict) -> list[list[tuple[bytes, float]]]:
        """n_best of every text; the new stretches of all are solved together, long ones are forgotten at the end."""
        if len(seen) >= REMEMBERED:
            seen.clear()
        stretches = [self.stretches(text) for text in texts]
        new = {one for s in stretches for one in s if one not in seen}
        self.learn(new, seen)
        found = [self.combine(s, n, seen) for s in stretches]
        for one in new:
            if len(one) > KEPT:
                del seen[one]
        return found

    def combine(self, stretches: list[str], n: int, seen: dict) -> list[tuple[bytes, float]]:
        """The n best paths through stretches that are all in seen.

        The lattice falls into stretches that no edge crosses, so a segmentation is a path
        for each.  Among the n best, only the n - 1 stretches with the smallest gap between
        their best and second path can leave their best (else n better ones exist): the
        A-star search runs on those, and their paths are combined.
        """
        if not stretches:
            return [(b"", 0.0)]
        ids, scores, gaps = zip(*map(seen.__getitem__, stretches))
        total, gaps = sum(scores), np.array(gaps)
        loose = _smallest(gaps, min(n - 1, len(gaps)))
        combined = [(0.0, ())]  # (below the best, ((stretch, ids), ...)), best first
        for k in loose:
            if not np.isfinite(gaps[k]):
                continue
            ways = [(scores[k] - score, path) for path, score in self._paths(stretches[k], n)]
            ways[0] = (0.0, ids[k])
            combined = heapq.nsmallest(
                n, ((below + more, (*moved, (int(k), path))) for below, moved in combined for more, path in ways), key=lambda x: x[0]
            )
        out = []
        for below, moved in combined[:n]:
            own = list(ids)
            for k, path in moved:
                own[k] = path
            out.append((b"".join(own), total - below))
        return out

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids: bytes are put together, SPACE is a blank, the first blank is dropped."""
        raw = b"".join(map(self.raw.__getitem__, ids.tolist()))
        return raw.decode("utf-8", "surrogatepass").replace(SPACE, " ").removeprefix(" ")


class _Hashed:
    """The pieces behind a hash table that whole arrays of substrings are looked up in."""

    BITS = 18

    def __init__(self, edges: dict[str, tuple[int, float]]):
        self.ids = np.array([i for i, _ in edges.values()] + [0])
        self.scores = np.array([s for _, s in edges.values()] + [-np.inf])
        self.longest = max(map(len, edges), default=1)
        hashes = np.zeros(len(edges), np.uint64)
        sizes = np.array([len(p) for p in edges])
        names = list(edges)
        for size in set(sizes.tolist()):
            rows = np.flatnonzero(sizes == size)
            codes = np.frombuffer("".join(names[r] for r in rows).encode("utf-32-le"), "<u4").reshape(-1, size)
            hashes[rows] = list(self._rolling(codes.T))[-1][0]
        if len(np.unique(hashes)) < len(hashes):
            raise ValueError("two pieces share a hash")
        self.slots, self.hashes = np.full(1 << self.BITS, -1), hashes
        for k, slot in enumerate(self._slot(hashes).tolist()):
            while self.slots[slot] >= 0:
                slot = (slot + 1) % len(self.slots)
            self.slots[slot] = k
        self.at_slot = np.where(self.slots >= 0, np.append(hashes, np.uint64(0))[self.slots], np.uint64(0))

    def _slot(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.BITS)).astype(np.int64)

    @staticmethod
    def _rolling(codes: np.ndarray) -> Iterator[np.ndarray]:
        """Hashes of all substrings of 1, 2, ... characters of every column, by start."""
        codes = codes.astype(np.uint64) + np.uint64(1)
        rolling = codes * np.uint64(0x9E3779B97F4A7C15)
        for size in range(1, codes.shape[0] + 1):
            if size > 1:
                rolling = (rolling[:-1] ^ (rolling[:-1] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + codes[size - 1 :]
            yield (rolling ^ (rolling >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)

    def look_up(self, codes: np.ndarray) -> Iterator[np.ndarray]:
        """For every size the positions of pieces at every start, -1 where there is none."""
        for size, hashes in enumerate(self._rolling(codes), 1):
            if size > self.longest:
                return
            slot = self._slot(hashes)
            found = np.where(self.at_slot[slot] == hashes, self.slots[slot], -1)
            seek = np.nonzero((self.slots[slot] >= 0) & (found < 0))  # taken by another piece: the next slots
            while len(seek[0]):
                slot[seek] = (slot[seek] + 1) % len(self.slots)
                at, wanted = slot[seek], hashes[seek]
                hit = (self.slots[at] >= 0) & (self.at_slot[at] == wanted)
                found[seek] = np.where(hit, self.slots[at], -1)
                on = ~hit & (self.slots[at] >= 0)
                seek = tuple(x[on] for x in seek)
            yield found


def _smallest(values: np.ndarray, n: int) -> np.ndarray:
    """Positions of the n smallest values, of equal ones the first."""
    if n <= 0:
        return np.empty(0, int)
    bound = np.partition(values, n - 1)[n - 1]
    return np.sort(np.concatenate([np.flatnonzero(values < bound), np.flatnonzero(values == bound)[: n - int((values < bound).sum())]]))


@functools.lru_cache(maxsize=2)
def pieces_of(path: str) -> Pieces:
    return Pieces(path)


def segment(docs: DataFrame, model: str, n: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, rank (1: best), score, ids (little-endian uint32) of the n best segmentations of every whole text.

    Null text counts as empty; an empty text has one empty segmentation.  A text with fewer
    than n segmentations has them all.  Null keys and repeated rows are segmented like any
    row.  Other columns are not read.  An empty table gives an empty one.
    """

    def rows(pieces: Pieces, found: list[list[tuple[bytes, float]]], keys, _texts):
        flat = [(k, r, s, i) for k, f in zip(keys.to_pylist(), found) for r, (i, s) in enumerate(f, 1)]
        k, r, s, i = zip(*flat) if flat else [()] * 4
        return [pa.array(k, keys.type), pa.array(r, pa.int32()), pa.array(s, pa.float64()), pa.array(i, pa.binary())], [key, "rank", "score", "ids"]

    return _segmented(docs, model, n, key, text, "rank int, score double, ids binary", rows)


def summary(docs: DataFrame, model: str, n: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: key, n_pieces, score and ids_crc32 of the best segmentation, the number and
    last score of the n best, a checksum over all of them, and whether the best decodes to the text again."""

    def rows(pieces: Pieces, found, keys, texts):
        best = [f[0] for f in found]
        columns = [
            pa.array([len(i) // 4 for i, _ in best], pa.int64()),
            pa.array([s for _, s in best], pa.float64()),
            pa.array([zlib.crc32(i) for i, _ in best], pa.int64()),
            pa.array([len(f) for f in found], pa.int64()),
            pa.array([f[-1][1] for f in found], pa.float64()),
            pa.array([zlib.crc32(b"".join(i for i, _ in f)) for f in found], pa.int64()),
            pa.array([pieces.decode(np.frombuffer(i, "<u4")) == (t or "") for (i, _), t in zip(best, texts)], pa.bool_()),
        ]
        return [keys, *columns], [key, "n_pieces", "score", "ids_crc32", "n_found", "last_score", "all_crc32", "round_trip"]

    fields = "n_pieces long, score double, ids_crc32 long, n_found long, last_score double, all_crc32 long, round_trip boolean"
    return _segmented(docs, model, n, key, text, fields, rows)


def _segmented(docs, model, n, key, text, fields, rows) -> DataFrame:
    source = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, seen = pieces_of(model), {}
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            for at in range(0, len(texts), 256):
                part = texts[at : at + 256]
                found = pieces.n_best_of([t or "" for t in part], n, seen)
                columns, names = rows(pieces, found, keys.slice(at, 256), part)
                yield pa.record_batch(columns, names)

    return source.mapInArrow(run, f"`{key}` {source.schema['_key'].dataType.simpleString()}, {fields}")
