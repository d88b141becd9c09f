"""Best-fit packing of token sequences by bin completion.

Lengths are whole numbers up to the capacity, so the packing problem of any corpus is its
histogram: at most ``capacity`` rows, counted by Spark.  The plan is made on that
histogram: take the largest length left, enumerate fillings of the room beside it by
branch and bound, keep the one with least waste, and use it as often as the counts allow.
Each step uses up a length, so this plan has a number of steps bounded by the capacity,
not by the corpus.  If it misses the bound, the search branches over the undominated fillings
of each bin and goes back, up to a number of nodes.

The plan numbers the pieces of a length 0, 1, 2, ... and says which numbers go where.
Spark gives out these numbers (counts per length and salt, then a rank within each), so a
length that very many pieces share is numbered by many tasks.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakekit.llm.bpe_codec import encoder
from lakekit.llm.common import WordCache, focus, held, staged

CAPACITY = 2048
END_ID = 0
PIECE_CACHE = 120_000       # memoised word pieces per generation and worker
SALT_ROWS = 4096            # pieces of one length that a rank window holds at most, on average
SEARCH_NODES = 3000         # fillings looked at for one step; the best so far is then used
MOST_SHARES = 64            # dual feasible functions tried for the bound
BRANCH_NODES = 60_000       # fillings and choices looked at for a plan; the best plan so far is then used


# ---------------------------------------------------------------- planning

def best_filling(room: int, lengths: list[int], counts: dict[int, int], nodes: int = SEARCH_NODES) -> list[int]:
    """Lengths (largest first, repeats allowed up to their count) that leave least of
    ``room``.  ``lengths`` is sorted downwards.  The first descent is the best-fit filling; the
    search goes on from it and leaves out branches that can't leave less than the incumbent:
    all that is left from a length on must at least fill the room up to its waste.  Fillings
    are maximal (a level starts at the longest that fits), which leaves out dominated ones,
    and one without waste ends the search."""
    best: list[int] = []
    best_waste = room
    smallest = lengths[-1] if lengths else room + 1
    left = nodes
    rest = [0] * (len(lengths) + 1)     # sum of all pieces from a length on
    for i in range(len(lengths) - 1, -1, -1):
        rest[i] = rest[i + 1] + lengths[i] * counts[lengths[i]]

    def descend(room: int, first: int, chosen: list[tuple[int, int]]) -> bool:
        """One call for each different length in the filling, so at most about sqrt(2 * room) deep."""
        nonlocal best, best_waste, left
        if room < best_waste:
            best, best_waste = [n for n, k in chosen for _ in range(k)], room
        if best_waste == 0 or left <= 0:
            return True
        if room < smallest:
            return False
        lo, hi = first, len(lengths)        # the first length from here that fits
        while lo < hi:
            mid = (lo + hi) // 2
            if lengths[mid] > room:
                lo = mid + 1
            else:
                hi = mid
        for i in range(lo, len(lengths)):
            length = lengths[i]
            if room - rest[i] >= best_waste:
                return False
            for k in range(min(counts[length], room // length), 0, -1):
                if room - k * length - rest[i + 1] >= best_waste:
                    break       # fewer of it leave more
                left -= 1
                if descend(room - k * length, i + 1, [*chosen, (length, k)]):
                    return True
        return False

    descend(room, 0, [])
    return best


def _greedy(room: int, lengths: list[int], counts: dict[int, int]) -> list[int]:
    out = []
    for length in lengths:
        n = min(counts[length], room // length)
        out += [length] * n
        room -= n * length
    return out


def _plan(histogram: dict[int, int], capacity: int, filling) -> list[tuple[int, dict[int, int]]]:
    counts = {n: c for n, c in histogram.items() if c > 0}
    lengths = sorted(counts, reverse=True)
    steps = []
    while lengths:
        top = lengths[0]
        counts[top] -= 1
        rest = [n for n in lengths if counts[n] > 0 and n <= capacity - top]
        chosen = [top, *filling(capacity - top, rest, counts)]
        counts[top] += 1
        pattern: dict[int, int] = {}
        for n in chosen:
            pattern[n] = pattern.get(n, 0) + 1
        copies = min(counts[n] // k for n, k in pattern.items())
        for n, k in pattern.items():
            counts[n] -= copies * k
        lengths = [n for n in lengths if counts[n] > 0]
        steps.append((copies, pattern))
    return steps


def least_bins(histogram: dict[int, int], capacity: int) -> int:
    """The better of ``fewest_bins`` and the bounds by dual feasible functions: the k-th rounds
    a share x of the capacity down to floor((k + 1) x) / k (or keeps it where (k + 1) x is whole),
    which no filling's sum gets above 1 by, so the rounded sum is a bound too.  It counts
    lengths over a third, a quarter... of the capacity as the halves, thirds... that they take up."""
    best = fewest_bins(histogram, capacity)
    for k in range(1, min(MOST_SHARES, capacity) + 1):
        total = sum(c * (k * n if (k + 1) * n % capacity == 0 else (k + 1) * n // capacity * capacity) for n, c in histogram.items())
        best = max(best, -(-total // (k * capacity)))
    return best


def fewest_bins(histogram: dict[int, int], capacity: int) -> int:
    """A bound: total / capacity, and for each length s up to half the capacity the bins that
    the lengths over half need, with those of s and more that don't fit beside them."""
    total = sum(n * c for n, c in histogram.items())
    bound = -(-total // capacity)
    large = sorted((n for n in histogram if 2 * n > capacity and histogram[n]), reverse=True)
    all_large = sum(histogram[n] for n in large)
    bound = max(bound, all_large)
    beside = sum(histogram[n] * (capacity - n) for n in large)
    tops = iter(large)
    top = next(tops, None)
    small = sorted((n for n in histogram if 2 * n <= capacity and histogram[n]))
    middle = sum(n * histogram[n] for n in small)
    # upwards: fewer of the short lengths count, and fewer large ones have room for the rest
    for s in small:
        while top is not None and top > capacity - s:
            beside -= histogram[top] * (capacity - top)
            top = next(tops, None)
        bound = max(bound, all_large + max(0, -(-(middle - beside) // capacity)))
        middle -= s * histogram[s]
    return bound


def fillings(room: int, lengths: list[int], counts: dict[int, int], nodes: int) -> tuple[list[dict[int, int]], int]:
    """Undominated fillings of ``room``, least waste first, and the nodes left.  A filling is
    dominated if a piece that is left fits in, or in the place of one or two of its pieces
    that are not longer together (shorter, if one)."""
    found: list[tuple[int, dict[int, int]]] = []
    left = nodes

    def dominated(waste: int, used: dict[int, int]) -> bool:
        pieces = list(used)
        spans = [(0, waste)] + [(n + 1, n + waste) for n in pieces]
        spans += [(a + b, a + b + waste) for i, a in enumerate(pieces) for b in pieces[i:] if a != b or used[a] > 1]
        return any(lo <= n <= hi and used.get(n, 0) < counts[n] for n in lengths for lo, hi in spans)

    def descend(room: int, first: int, used: dict[int, int]) -> None:
        nonlocal left
        if not dominated(room, used):
            found.append((room, used))
        for i in range(first, len(lengths)):
            for k in range(min(counts[lengths[i]], room // lengths[i]), 0, -1):
                left -= 1
                if left <= 0:
                    return
                descend(room - k * lengths[i], i + 1, {**used, lengths[i]: k})

    descend(room, 0, {})
    return [used for _, used in sorted(found, key=lambda f: f[0])], left


def _branched(histogram: dict[int, int], capacity: int, best: int, nodes: int = BRANCH_NODES):
    """A plan of fewer than ``best`` bins, the fewest found, or None.  Each bin of the largest
    length left takes each undominated filling, as many times in turn as the counts allow, and
    the search goes back where the bound shows that no fewer bins can come out."""
    counts = {n: c for n, c in histogram.items() if c > 0}
    least, left, plan = least_bins(counts, capacity), nodes, None

    def choices():
        nonlocal left
        top = max(n for n, c in counts.items() if c)
        counts[top] -= 1
        rest = sorted((n for n, c in counts.items() if c and n <= capacity - top), reverse=True)
        found, left = fillings(capacity - top, rest, counts, left)
        counts[top] += 1
        for used in found:
            pattern = {**used, top: used.get(top, 0) + 1}
            for copies in range(min(counts[n] // k for n, k in pattern.items()), 0, -1):
                yield copies, pattern

    def use(step, sign: int) -> None:
        for n, k in step[1].items():
            counts[n] -= sign * step[0] * k

    frames, path, bins = ([choices()] if counts else []), [], 0     # a stack: plans have many steps
    while frames and left > 0 and best > least:
        step = next(frames[-1], None)
        if step is None:
            frames.pop()
            if path:
                use(path[-1], -1)
                bins -= path.pop()[0]
            continue
        left -= 1 + len(counts) // 8      # the bound's share
        use(step, 1)
        rest = any(counts.values())
        if bins + step[0] + (fewest_bins(counts, capacity) if rest else 0) >= best:
            use(step, -1)
        elif rest:
            path.append(step)
            bins += step[0]
            frames.append(choices())
        else:
            best, plan = bins + step[0], [*path, step]
            use(step, -1)
    return plan


def plan_packing(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """Steps (copies, {length: pieces in each}) that use every length's count exactly.

    The best-fit plan is the incumbent; bins filled by least waste replace it if they are
    fewer, then what bin completion with backtracking finds within ``BRANCH_NODES``.  A plan
    that reaches the bound is returned at once; one that comes out of a search that ended at
    ``BRANCH_NODES`` is valid, but may have more bins than needed.
    """
    if any(n < 1 or n > capacity for n in histogram):
        raise ValueError("a length is outside 1..capacity")
    bins = lambda plan: sum(copies for copies, _ in plan)
    least, incumbent = least_bins(histogram, capacity), None
    for filling in (_greedy, best_filling):
        plan = _plan(histogram, capacity, filling)
        if incumbent is None or bins(plan) < bins(incumbent):
            incumbent = plan
        if bins(incumbent) <= least:
            return incumbent
    return _branched(histogram, capacity, bins(incumbent)) or incumbent


def _segments(plan) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length, sorted by first rank: first ranks, first bin, pieces per bin, offset."""
    taken: dict[int, int] = {}
    found: dict[int, list[tuple[int, int, int, int]]] = {}
    first_bin = 0
    for copies, pattern in plan:
        offset = 0
        for length, k in pattern.items():
            at = taken.get(length, 0)
            found.setdefault(length, []).append((at, first_bin, k, offset))
            taken[length] = at + copies * k
            offset += k * length
        first_bin += copies
    return {n: tuple(np.array(x, dtype=np.int64) for x in zip(*rows)) for n, rows in found.items()}


# ---------------------------------------------------------------- Spark

@held
def _id_bytes(path: str):
    enc = encoder(path)
    tokenize = enc.library.model.tokenize

    def ids(piece: str) -> bytes:
        if piece in enc.special:
            return enc.special[piece].to_bytes(4, "little")
        letters = "".join([enc.letters[b] for b in piece.encode()])
        return b"".join([t.id.to_bytes(4, "little") for t in tokenize(letters)])

    cache = WordCache(ids, PIECE_CACHE)
    return lambda text: b"".join(map(cache.__getitem__, enc.pieces(text)))


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of at most ``capacity`` tokens of each text (its ids, then ``end_id``):
    id, piece, start, length, ids_crc32."""
    end = end_id.to_bytes(4, "little")

    def cut(batches):
        focus(encoder, _id_bytes)
        encode = _id_bytes(path)
        for batch in batches:
            rows, piece, start, length, crc = [], [], [], [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                ids = encode(text or "") + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at: at + 4 * capacity]
                    rows.append(row), piece.append(k), start.append(at // 4), length.append(len(part) // 4), crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))],
                names=[id_col, "piece", "start", "length", "ids_crc32"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(cut, f"`{id_col}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def pack(pieces: DataFrame, capacity: int = CAPACITY, id_col: str = "doc_id", salt_rows: int = SALT_ROWS) -> DataFrame:
    """Give each piece (a row with ``length``) a ``sequence_id`` and an ``offset`` in it.

    The pieces are read several times: hand over a written table.  Equal rows are
    interchangeable, so which of them gets which place doesn't matter.
    """
    columns = pieces.columns
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    segments = _segments(plan_packing(histogram, capacity))
    salts = max(1, math.ceil(sum(histogram.values()) / salt_rows))
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64(*columns), F.lit(salts)))
    before = (salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
              .withColumn("_before", F.sum("_n").over(Window.partitionBy("length").orderBy("_salt")) - F.col("_n")).drop("_n"))
    rank = F.row_number().over(Window.partitionBy("length", "_salt").orderBy(*columns)) - 1
    ranked = salted.withColumn("_rank", rank).join(before, ["length", "_salt"]).select(*columns, (F.col("_before") + F.col("_rank")).alias("_rank"))

    def place(batches):
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "_rank"))
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            for n in np.unique(length):
                rows = np.flatnonzero(length == n)
                firsts, bins, each, offsets = segments[int(n)]
                at = np.searchsorted(firsts, rank[rows], side="right") - 1
                q = rank[rows] - firsts[at]
                sequence[rows] = bins[at] + q // each[at]
                offset[rows] = offsets[at] + q % each[at] * n
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(sequence), pa.array(offset)], names=[*columns, "sequence_id", "offset"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(place, f"{kinds}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack all documents into as few sequences of ``capacity`` tokens as bin completion finds.

    One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.  A NULL or
    empty text is the end id alone; only documents longer than the capacity are cut; repeated
    rows are packed each; an empty table gives no rows; other columns are left out.
    """
    return pack(staged(token_pieces(docs, path, capacity, end_id, id_col, text_col), "pack-pieces"), capacity, id_col)
