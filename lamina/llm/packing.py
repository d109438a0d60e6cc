"""Best-fit packing of token pieces into sequences of a fixed length.

1. ``token_pieces``: each text becomes ids and one end id; only what is longer
   than a sequence is cut.
2. A histogram of piece lengths (at most ``capacity`` rows, so it may go to the
   driver) is all that planning sees: ``plan`` runs best-fit decreasing over
   counts, handling equal bins as one run.
3. Every piece takes the slot that its rank within its length points to.

Rows: null and empty texts give one piece (the end id).  Rows that repeat are
separate documents.  An empty table gives no pieces.  Other columns of the
input are ignored, whatever their names.
"""

from __future__ import annotations

import bisect
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.util import cut, rank_within
from lamina.session import spread

END_ID = 1
ROWS_PER_BUCKET = 200_000
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = 4096, keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every text.

    ``ids``, on request, are the piece's ids as little-endian uint32 bytes.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())] + [("ids", pa.binary())] * keep_ids)
    end = np.array([END_ID], "<u4").tobytes()

    def cut_up(batches):
        from lamina.llm.wordbpe import WordBpe

        model = WordBpe(vocabulary)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = model.encode(text.as_py()) + end
                for p, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc_id, p, at // 4, len(part) // 4, zlib.crc32(part)) + (part,) * keep_ids)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(cut_up, _PIECES + ", ids binary" * keep_ids)


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts: (length, first rank, first sequence,
    pieces per sequence, offset) rows, by length and rank.

    Sequences with the same room left form runs.  Each length fills the run
    with the least sufficient room, as many pieces to a sequence as fit, before
    it goes on to the next; new sequences are opened last.  A run is split at
    most once per length and its room at least halves whenever it is used up,
    so the rows are bounded by the capacity, not by the corpus (under
    2 * capacity * log2(capacity) + capacity).
    """
    if any(not 1 <= n <= capacity for n in histogram):
        raise ValueError("lengths must lie between 1 and the capacity")
    runs: dict[int, list[tuple[int, int]]] = {}  # room -> [(first sequence, sequences)]
    rooms: list[int] = []  # sorted keys of runs

    def put(room: int, first: int, count: int) -> None:
        if room and count:
            if room not in runs:
                runs[room] = []
                bisect.insort(rooms, room)
            runs[room].append((first, count))

    rows, opened = [], 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            i = bisect.bisect_left(rooms, length)
            if i < len(rooms):
                room = rooms[i]
                first, count = runs[room].pop()
                if not runs[room]:
                    del runs[room]
                    rooms.pop(i)
            else:
                room = capacity
                first, count = opened, math.ceil(left / (room // length))
                opened += count
            each = room // length
            full = min(count, left // each)
            if full:
                rows.append((length, rank, first, each, capacity - room))
                put(room - each * length, first, full)
            rank, left = rank + full * each, left - full * each
            if full < count:
                rest = left if left < each else 0
                if rest:  # fewer than fill one more sequence
                    rows.append((length, rank, first + full, each, capacity - room))
                    put(room - rest * length, first + full, 1)
                    rank, left = rank + rest, 0
                put(room, first + full + bool(rest), count - full - bool(rest))
    return rows


def pack(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """pieces with (sequence_id, offset): sequences are filled from 0 without gaps.

    Needs ``length`` (1 to capacity), ``doc_id`` and ``piece``.  What goes to
    the driver and back to the tasks is the histogram and the plan, both
    bounded by the capacity alone.
    """
    pieces = cut(pieces)
    counted = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = np.array(plan(counted, capacity), dtype=np.int64).reshape(-1, 5)
    # one sorted key for (length, rank): ranks stay under 2**48
    keys = (rows[:, 0] << 48) + rows[:, 1]
    order = np.argsort(keys)
    spark = pieces.sparkSession
    shared = spark.sparkContext.broadcast((keys[order], rows[order]))
    salt = F.xxhash64("doc_id", "piece")
    ranked = rank_within(pieces, ["length"], [F.col("doc_id"), F.col("piece"), F.col("ids_crc32")], salt, max(1, math.ceil(sum(counted.values()) / ROWS_PER_BUCKET)))

    def seat(batches):
        keys, rows = shared.value
        for t in batches:
            length, rank = t["length"].to_numpy(), t["rank"].to_numpy()
            hit = rows[np.searchsorted(keys, (length << 48) + rank, side="right") - 1] if len(rows) else np.zeros((len(t), 5), np.int64)
            past = rank - hit[:, 1]
            t["sequence_id"] = hit[:, 2] + past // np.maximum(hit[:, 3], 1)
            t["offset"] = hit[:, 4] + past % np.maximum(hit[:, 3], 1) * length
            yield t.drop(columns="rank")

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"
    return ranked.select(*pieces.columns, "rank").mapInPandas(seat, schema)


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = 4096) -> DataFrame:
    return pack(token_pieces(docs, vocabulary, capacity), capacity)


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")), vocabulary_path())
