"""Best-fit packing by linear grouping (operator 6).

Spark cuts the documents into pieces and counts the pieces of each length.  The histogram has at
most ``seq_len`` rows whatever the corpus; the packing is worked out on it in runs of equal
pieces, and Spark hands each piece its place by its rank among pieces of its length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import map_batches, parallelism, pick, written
from tidewater.llm.wordbpe import default_tokenizer, encoder

SEQ_LEN, END_ID = 4096, 1
#: Sizes that the large lengths are rounded up to, and the part of a sequence above which a
#: piece is large.
GROUPS, LARGE = 64, 0.25


@dataclass
class Plan:
    """Places of pieces: the pieces of ``length`` with ranks from ``rank`` on lie ``per`` to a
    sequence, from sequence ``first`` on, at ``offset`` and behind one another."""
    length: np.ndarray
    rank: np.ndarray
    first: np.ndarray
    per: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted((self.length << 44) + self.rank, (length << 44) + rank, side="right") - 1
        nth, per = rank - self.rank[at], self.per[at]
        return self.first[at] + nth // per, self.offset[at] + nth % per * length


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[np.ndarray, int]]:
    """Whole numbers of sequences of each configuration (pieces of each size), rounded down from
    the configuration programme's optimum, found by column generation: a knapsack over the sizes
    offers the configuration that the present prices undervalue most."""
    k = len(sizes)
    size, need = np.array(sizes), np.array(demand, dtype=float)
    basis = np.diag([float(capacity // s) for s in sizes])
    amount = need / np.diag(basis)
    for _ in range(40 * k):
        price = np.linalg.solve(basis.T, np.ones(k))
        best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        for i in np.argsort(size):
            if price[i] <= 1e-12:
                continue
            for _ in range(capacity // size[i]):
                better = best[:-size[i]] + price[i] > best[size[i]:] + 1e-12
                if not better.any():
                    break
                # right to left semantics are not needed: repeated passes reach every count
                best[size[i]:][better] = (best[:-size[i]] + price[i])[better]
                choice[size[i]:][better] = i
        column, w = np.zeros(k), capacity
        while w > 0 and choice[w] >= 0:
            column[choice[w]] += 1
            w -= size[choice[w]]
        if price @ column <= 1 + 1e-9:
            break
        step = np.linalg.solve(basis, column)
        usable = step > 1e-12
        ratio = np.where(usable, amount / np.where(usable, step, 1), np.inf)
        out = int(np.argmin(ratio))
        amount = np.maximum(amount - ratio[out] * step, 0)
        amount[out] = ratio[out]
        basis[:, out] = column
    return [(basis[:, j].astype(int), int(amount[j] + 1e-6)) for j in range(k) if amount[j] >= 1]


def pack_histogram(histogram: dict[int, int], capacity: int = SEQ_LEN, groups: int = GROUPS,
                   large: float = LARGE) -> Plan:
    """Pack ``{length: count}`` (lengths from 1 to ``capacity``) into as few sequences as the grouping finds.

    Coarse groups waste what they round up, fine ones leave fractions of configurations over, so the
    linear grouping is worked out with ``groups`` groups, with twice as many, and with none at all (plain
    best fit of the falling lengths); the plan with the fewest sequences counts.
    """
    plans = [grouped_plan(histogram, capacity, g, large) for g in (groups, 2 * groups, 0)]
    return min(plans, key=lambda p: p.sequences)


def grouped_plan(histogram: dict[int, int], capacity: int, groups: int, large: float = LARGE) -> Plan:
    """The plan of one linear grouping.

    Large lengths, in falling order, are cut into groups of equal cardinality and rounded up to
    their group's largest; configurations of the few sizes are optimised; the actual lengths
    take the places of their group's size; what the roundings leave free, the other pieces fill
    best-fit, longest first, into the sequence with the least room that suffices.
    """
    rows: list[tuple[int, int, int, int, int]] = []  # length, rank, first, per, offset
    used = dict.fromkeys(histogram, 0)
    room: dict[int, list[tuple[int, int]]] = {}  # free tokens: runs of (first sequence, number)
    free: list[int] = []
    made = 0

    def add_room(left: int, first: int, n: int) -> None:
        if left > 0 and n > 0:
            if left not in room:
                room[left] = []
                insort(free, left)
            room[left].append((first, n))

    def put(length: int, first: int, n: int, per: int, offset: int) -> None:
        """``n`` pieces, ``per`` to a sequence."""
        rows.append((length, used[length], first, per, offset))
        used[length] += n

    lengths = sorted((x for x in histogram if histogram[x] > 0), reverse=True)
    big = [x for x in lengths if x > capacity * large] if groups else []
    total = sum(histogram[x] for x in big)
    if total:
        # runs [length, count] of each group; a length may lie in several groups
        share = -(-total // groups)
        runs: list[list[list[int]]] = [[]]
        left = share
        for x in big:
            n = histogram[x]
            while n:
                if not left:
                    runs.append([])
                    left = share
                take = min(n, left)
                runs[-1].append([x, take])
                n, left = n - take, left - take
        sizes: dict[int, list[list[int]]] = {}
        for r in runs:  # groups of the same rounded size are one
            sizes.setdefault(r[0][0], []).extend(r)
        keys = list(sizes)
        queues = [sizes[s][::-1] for s in keys]
        for config, n in configurations(keys, [sum(c for _, c in sizes[s]) for s in keys], capacity):
            slots = [g for g in range(len(keys)) for _ in range(config[g])]
            cut = []  # per slot, runs of actual lengths over the n sequences
            for g in slots:
                got, want = [], n
                while want and queues[g]:
                    x, c = queues[g][-1]
                    take = min(c, want)
                    got.append((x, take))
                    want -= take
                    queues[g].pop() if take == c else queues[g].__setitem__(-1, [x, c - take])
                cut.append(got + ([(0, want)] if want else []))
            at = [[0, 0] for _ in slots]
            done = 0
            while done < n:
                m = min(cut[s][at[s][0]][1] - at[s][1] for s in range(len(slots)))
                offset = 0
                for s in range(len(slots)):
                    x = cut[s][at[s][0]][0]
                    if x:
                        put(x, made, m, 1, offset)
                        offset += x
                    at[s][1] += m
                    if at[s][1] == cut[s][at[s][0]][1]:
                        at[s] = [at[s][0] + 1, 0]
                add_room(capacity - offset, made, m)
                made, done = made + m, done + m
    for x in lengths:
        n = histogram[x] - used[x]
        while n:
            k = bisect_left(free, x)
            if k == len(free):
                per = capacity // x
                add_room(capacity, made, full := n // per or 1)
                made += full
                continue
            have = free[k]
            first, m = room[have].pop()
            if not room[have]:
                del room[have], free[k]
            per = min(have // x, n)
            take = min(m, n // per)
            put(x, first, take * per, per, capacity - have)
            add_room(have - per * x, first, take)
            add_room(have, first + take, m - take)
            n -= take * per
    rows.sort()
    table = np.array(rows, dtype=np.int64).reshape(-1, 5)
    return Plan(*(np.ascontiguousarray(table[:, i]) for i in range(5)), sequences=made)


def cut_pieces(docs: DataFrame, tokenizer: str, seq_len: int, end_id: int, id_col: str,
               text_col: str, tokens: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) of whole documents, ``end_id`` behind each."""
    src = pick(docs, id_col, text_col)
    id_type = src.schema[id_col].dataType.simpleString()

    def run(batches):
        enc, end = encoder(tokenizer), np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                raw = (enc.encode(t) if t else b"") + end
                for p, a in enumerate(range(0, len(raw), 4 * seq_len)):
                    part = raw[a:a + 4 * seq_len]
                    row.append(i), piece.append(p), start.append(a // 4), length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if tokens:
                        ids.append(np.frombuffer(part, dtype="<i4"))
            out = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                   pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(out + ([pa.array(ids, pa.list_(pa.int32()))] if tokens else []),
                                             names=["id", "piece", "start", "length", "ids_crc32"] + ["ids"] * tokens)

    return map_batches(src, run, f"id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint"
                       + ", ids array<int>" * tokens)


def pack(docs: DataFrame, tokenizer: str | None = None, seq_len: int = SEQ_LEN, end_id: int = END_ID,
         tokens: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``,
    ``offset`` and, with ``tokens``, the piece's ``ids``.

    Only documents longer than ``seq_len`` are cut.  A null or empty text is the end id alone;
    null ids of rows and repeated rows are packed like others; an empty table gives an empty
    result; other columns are ignored.
    """
    spark = docs.sparkSession
    pieces = written(cut_pieces(docs, tokenizer or default_tokenizer(), seq_len, end_id, id_col, text_col, tokens), "pack-pieces")
    plan = pack_histogram({r[0]: r[1] for r in pieces.groupBy("length").count().collect()}, seq_len)  # at most seq_len rows

    def rank(batches):
        part, length, n = TaskContext.get().partitionId(), -1, 0
        for batch in batches:
            x = batch.column("length").to_numpy()
            starts = np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) if len(x) else np.array([], dtype=np.int64)
            nth = np.arange(len(x)) - np.repeat(starts, np.diff(np.r_[starts, len(x)]))
            if len(x):
                nth += np.where(np.arange(len(x)) < (starts[1] if len(starts) > 1 else len(x)), n if x[0] == length else 0, 0)
                length, n = int(x[-1]), int(nth[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(x), part), pa.int32()), pa.array(nth, pa.int64())],
                                             names=[*batch.schema.names, "part", "nth"])

    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)
    order = ["length", "id", "piece", "ids_crc32"]
    ranked = written(map_batches(pieces.repartitionByRange(parallelism(spark), *order).sortWithinPartitions(*order),
                                 rank, f"{columns}, part int, nth bigint"), "pack-ranks")
    # a task holds a range of lengths: at most as many rows as tasks and lengths together
    offsets = ranked.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = offsets.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"))
    ranked = ranked.join(F.broadcast(offsets), ["length", "part"]).withColumn("nth", F.col("nth") + F.col("n0"))

    def place(batches):
        for batch in batches:
            seq, offset = plan.place(batch.column("length").to_numpy(), batch.column("nth").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f) for f in names), pa.array(seq, pa.int64()), pa.array(offset, pa.int64())],
                names=[id_col, *names[1:], "sequence_id", "offset"])

    names = pieces.columns
    return map_batches(ranked.select(*names, "nth"), place,
                       columns.replace("id ", f"`{id_col}` ", 1) + ", sequence_id bigint, offset bigint")
