"""Byte-pair merges of many pieces at once, for use inside Arrow batches.

The pieces that a batch does not know yet are merged in lockstep: a matrix of token ids, one row a
piece, and one of the ranks of neighbours. Each round every row merges its pair of the lowest rank,
first from the left; rows without a pair leave. Python runs once a round, not once a piece.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa

#: No pair.
NONE = np.int32(2**31 - 1)
#: Rows of one matrix, and the longest piece in one; longer pieces are merged one by one.
ROWS = 16_384
LONGEST = 64
#: Pieces whose ids are kept between batches.
KEPT = 150_000


class Merger:
    """Ids of pieces and bytes of ids for ranks of byte strings (the rank is the id)."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.byte_ids = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        keys, merged = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    merged.append(rank)
        keys = np.array(keys, np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = np.append(keys[order], np.int64(2**63 - 1)), np.append(np.array(merged, np.int32)[order], NONE)
        # Bytes of the ids, one after the other.
        size = max(ranks.values(), default=-1) + 1
        names = [b""] * size
        for token, rank in ranks.items():
            names[rank] = token
        self.known = np.zeros(size, bool)
        self.known[list(ranks.values())] = True
        self.name_lengths = np.fromiter(map(len, names), np.int64, size)
        self.name_starts = np.concatenate(([0], np.cumsum(self.name_lengths)))
        self.name_bytes = np.frombuffer(b"".join(names), np.uint8)
        self.kept: dict[str, bytes] = {}

    def pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids; negative ids have none."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64) & 0xFFFFFFFF
        place = np.searchsorted(self.pair_keys, keys)
        return np.where((self.pair_keys[place] == keys) & (left >= 0) & (right >= 0), self.pair_ranks[place], NONE)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids (32 bits, this machine's order) of pieces."""
        out: list[bytes] = [b""] * len(pieces)
        waiting: list[int] = []
        for i, piece in enumerate(pieces):
            rank = self.ranks.get(piece)
            if rank is not None:
                out[i] = np.uint32(rank).tobytes()
            elif len(piece) > LONGEST:
                out[i] = np.array(self.merge_long(piece), np.uint32).tobytes()
            elif piece:
                waiting.append(i)
        waiting.sort(key=lambda i: len(pieces[i]))
        for start in range(0, len(waiting), ROWS):
            some = waiting[start : start + ROWS]
            # Lengths of a part of the sorted list differ little; a new matrix begins where they double.
            first = 0
            while first < len(some):
                limit, last = 2 * len(pieces[some[first]]), first
                while last < len(some) and len(pieces[some[last]]) <= limit:
                    last += 1
                for i, ids in zip(some[first:last], self._lockstep([pieces[i] for i in some[first:last]])):
                    out[i] = ids
                first = last
        return out

    def _lockstep(self, pieces: list[bytes]) -> list[bytes]:
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        width = int(lengths.max())
        raw = np.frombuffer(b"".join(piece.ljust(width, b"\0") for piece in pieces), np.uint8).reshape(-1, width)
        ids = np.where(np.arange(width) < lengths[:, None], self.byte_ids[raw], np.int32(-1)).astype(np.int32)
        ranks = self.pairs(ids[:, :-1], ids[:, 1:]) if width > 1 else np.full((len(pieces), 1), NONE)
        rows, out = np.arange(len(pieces)), [b""] * len(pieces)
        while len(rows):
            at = ranks.argmin(axis=1)
            best = np.take_along_axis(ranks, at[:, None], 1)[:, 0]
            ready = best == NONE
            if ready.any():
                done = ids[ready]
                sizes = (done >= 0).sum(axis=1)
                for row, line, size in zip(rows[ready].tolist(), done.astype(np.uint32), sizes.tolist()):
                    out[row] = line[:size].tobytes()
                going = ~ready
                rows, ids, ranks, at, best = rows[going], ids[going], ranks[going], at[going], best[going]
                if not len(rows):
                    break
            # Every row loses a column: the right half of its pair.
            every = np.arange(len(rows))
            ids[every, at] = best
            place = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, place + (place > at[:, None]), 1)
            if ids.shape[1] == 1:
                ranks = np.full((len(rows), 1), NONE)
                continue
            place = place[:-1]
            ranks = np.take_along_axis(ranks, place + (place >= at[:, None]), 1)
            inside = at < ranks.shape[1]
            ranks[every[inside], at[inside]] = self.pairs(ids[every[inside], at[inside]], ids[every[inside], at[inside] + 1])
            inside = at > 0
            ranks[every[inside], at[inside] - 1] = self.pairs(ids[every[inside], at[inside] - 1], ids[every[inside], at[inside]])
        return out

    def merge_long(self, piece: bytes) -> list[int]:
        """Ids of one piece of any length: a heap of pairs over a linked list, n log n steps."""
        ranks, size = self.ranks, len(piece)
        if piece in ranks:
            return [ranks[piece]]
        end, before, alive = list(range(1, size + 1)), list(range(-1, size - 1)), bytearray(b"\x01") * size

        def pair(i: int) -> tuple[int, int, int, int] | None:
            """Rank and borders of the part from i and the one after it."""
            j = end[i]
            rank = ranks.get(piece[i : end[j]]) if j < size else None
            return None if rank is None else (rank, i, j, end[j])

        heap = [found for found in map(pair, range(size)) if found]
        heapq.heapify(heap)
        while heap:
            _, i, j, stop = heapq.heappop(heap)
            if not (alive[i] and end[i] == j and alive[j] and end[j] == stop):
                continue
            alive[j] = 0
            end[i] = stop
            if stop < size:
                before[stop] = i
            for k in (i, before[i]):
                found = pair(k) if k >= 0 else None
                if found:
                    heapq.heappush(heap, found)
        starts, i = [], 0
        while i < size:
            starts.append(i)
            i = end[i]
        return [ranks[piece[i : end[i]]] for i in starts]

    def encode(self, pieces: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces one after the other, and how many each piece has."""
        column = (pieces if isinstance(pieces, pa.Array) else pa.array(pieces, pa.string())).dictionary_encode()
        place, names = column.indices.to_numpy(zero_copy_only=False), column.dictionary.to_pylist()
        kept = self.kept
        found = [kept.get(name) for name in names]
        missing = [i for i, ids in enumerate(found) if ids is None]
        for i, ids in zip(missing, self.merge([names[i].encode("utf-8") for i in missing])):
            found[i] = ids
        if len(kept) + len(missing) > KEPT:
            # The frequent pieces are in every batch, so the last one's are the ones to keep.
            kept.clear()
            kept.update(zip(names[:KEPT], found))
        else:
            kept.update((names[i], found[i]) for i in missing)
        counts = np.fromiter(map(len, found), np.int64, len(found)) // 4
        ids = np.frombuffer(b"".join(found), np.uint32)
        return gather(ids, np.cumsum(counts) - counts, counts, place), counts[place]

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids one after the other, and how many each id has. An unknown id is an error."""
        if len(ids) and not (int(ids.min()) >= 0 and int(ids.max()) < len(self.known) and self.known[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        return gather(self.name_bytes, self.name_starts[:-1], self.name_lengths, ids), self.name_lengths[ids]


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The parts (start, length) of ``values`` that ``place`` names, one after the other."""
    sizes = lengths[place]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(starts[place] - (ends - sizes), sizes) + np.arange(total)]
