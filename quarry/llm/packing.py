"""Packing tokenized documents into sequences of bounded length by swap-based local search.

A document is its token ids and an end id. One longer than the sequence
length is cut into full pieces; the first piece takes the remainder. Full
pieces fill a sequence each; the others are packed:

* pieces are dealt to groups of about ``GROUP`` by a hash, so that each group
  has the corpus's mix of lengths wherever the pieces come from. Only places
  and lengths move, no texts, and memory is bounded by the group;
* within a group, best fit in decreasing length makes the first bins. Then
  the local search goes over the underfull bins, emptiest first, and raises
  the sum of squared fills by moving a piece to another bin or by exchanging
  one or two pieces for a shorter one there, until nothing improves or the
  bins are as few as their lengths allow. Bins are indexed by room and piece
  length, so each step looks at the best fits only;
* bins of all groups that are emptier than the mean of the underfull ones are
  dealt anew and packed again, until one group holds them or a round saves
  nothing.

A sequence id is the partition and a running number for a full piece, else the
round, the group and a running number, with bit 62 set. Rounds are written
down, so ids are the same when a lost task is run again.

Defined results: null and empty texts are the end id alone; repeated rows are
packed one by one; other columns are ignored; an empty table has no pieces.
"""

from __future__ import annotations

import bisect
import json
import os
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import PerWorker, map_arrow, read_bytes, slices
from quarry.session import materialize, ship_package

GROUP = 16_384            # pieces packed together, about
BATCH = 16_384            # pieces in one batch of the tokenizer's output
LONG = 200_000            # characters; longer texts are tokenized in parts

# fixed value: the byte-level pre-tokenizer's pattern
PRE_TOKENS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

SCHEMA = ("doc_id {id}, piece int, start bigint, length bigint, ids_crc32 bigint, "
          "sequence_id bigint, offset bigint")
NAMES = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


class ByteBpe:
    """Byte-level BPE ids of a tokenizers file.

    The file's merges are run by tiktoken, which gives the same ids several
    times faster; that needs ids in merge order, which is checked. Texts
    that hold an added token, and very long ones, go to the tokenizers
    library, the latter cut where neither pre-tokenizer nor merges cross:
    before a single space between two characters that are not white space.
    """

    def __init__(self, tokenizer_json: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer

        spec = json.loads(tokenizer_json)
        pre = spec["pre_tokenizer"]
        if spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"]:
            raise ValueError("only plain byte-level tokenizers are supported")
        self.library = Tokenizer.from_str(tokenizer_json.decode("utf-8"))
        self.added = [t["content"] for t in spec["added_tokens"]]
        vocab = {k: v for k, v in spec["model"]["vocab"].items() if k not in self.added}
        merged = [vocab["".join(m) if isinstance(m, list) else m.replace(" ", "", 1)] for m in spec["model"]["merges"]]
        if merged != sorted(merged):
            raise ValueError("ids are not in merge order")
        byte_of = byte_alphabet()
        ranks = {bytes(byte_of[c] for c in piece): i for piece, i in vocab.items()}
        self.fast = tiktoken.Encoding("packing", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})

    @staticmethod
    def cut(text: str) -> list[str]:
        """Parts that are tokenized independently; they join to ``text``."""
        parts = text.split(" ")
        out = [parts[0]]
        for before, part in zip(parts, parts[1:]):
            if before and part and not before[-1].isspace() and not part[0].isspace():
                out.append(" " + part)
            else:
                out[-1] += " " + part
        return out

    def _slow(self, text: str) -> np.ndarray:
        if any(t in text for t in self.added):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")
        coded = self.library.encode_batch_fast(self.cut(text), add_special_tokens=False)
        return np.array([i for e in coded for i in e.ids], "<u4")

    def __call__(self, text: str) -> np.ndarray:
        if len(text) > LONG or any(t in text for t in self.added):
            return self._slow(text)
        return np.array(self.fast.encode_ordinary(text), "<u4")


def byte_alphabet() -> dict[str, int]:
    """Byte of each character of the byte-level alphabet: printable Latin-1 characters stand for
    themselves, the other bytes in order for the characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Bins:
    """Bins of pieces under local search."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.items: list[list[tuple[int, int]]] = []   # (length, piece index) of each bin
        self.fill: list[int] = []

    def best_fit(self, lengths: np.ndarray) -> None:
        """Longest first, each into the fullest bin that has room."""
        by_room: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        rooms: list[int] = []                            # distinct rooms with bins, ascending
        for i in np.argsort(-lengths, kind="stable").tolist():
            n = int(lengths[i])
            at = bisect.bisect_left(rooms, n)
            if at == len(rooms):
                b, room = len(self.items), self.capacity
                self.items.append([])
                self.fill.append(0)
            else:
                room = rooms[at]
                b = by_room[room].pop()
                if not by_room[room]:
                    rooms.pop(at)
            self.items[b].append((n, i))
            self.fill[b] += n
            room -= n
            if room:
                if not by_room[room]:
                    bisect.insort(rooms, room)
                by_room[room].append(b)

    def _put(self, b: int, gone: list, come: list) -> None:
        for x in gone:
            self.items[b].remove(x)
        self.items[b].extend(come)
        self.fill[b] += sum(x[0] for x in come) - sum(x[0] for x in gone)

    # An exchange of a piece of length n of bin b for a longer load a is possible if a <= room(b) + n. Underfull bins
    # are indexed by that sum, and there by n; n = 0 stands for a move.

    def _enter(self, b: int) -> None:
        room = self.capacity - self.fill[b]
        if room and self.items[b]:
            for n in {0, *(x[0] for x in self.items[b])}:
                self.index[room + n].setdefault(n, {})[b] = None
                self.used |= 1 << room + n

    def _leave(self, b: int) -> None:
        room = self.capacity - self.fill[b]
        if room and self.items[b]:
            for n in {0, *(x[0] for x in self.items[b])}:
                here = self.index[room + n]
                del here[n][b]
                if not here[n]:
                    del here[n]
                    if not here:
                        self.used &= ~(1 << room + n)

    def _target(self, load: int, low: int) -> tuple[int, int, int] | None:
        """(waste, bin, length it gives back) where ``load`` of bin ``low`` fits best and squared fill grows."""
        least = self.fill[low] - load                       # the bin's fill without what it gives back must be above
        left, key = self.used >> load, load
        while left:
            skip = (left & -left).bit_length() - 1
            key += skip
            for n in sorted(self.index[key]):
                if n >= load:
                    break
                for b in self.index[key][n]:
                    if b != low and self.fill[b] - n > least:
                        return key - load, b, n
            left >>= skip + 1
            key += 1
        return None

    def _improve(self, low: int) -> bool:
        """Shift the greatest length from ``low`` to another bin by one move, or an exchange for one or two pieces."""
        here = sorted(self.items[low], reverse=True)
        loads = {x[0]: (x,) for x in reversed(here)}
        for k, x in enumerate(here):
            for y in here[k + 1:]:
                loads.setdefault(x[0] + y[0], (x, y))
        best = None
        for load, pieces in loads.items():
            found = self._target(load, low) if load <= self.capacity else None
            if found is not None and (best is None or (load - found[2], -found[0]) > best[0]):
                best = (load - found[2], -found[0]), found[1], found[2], pieces
        if best is None:
            return False
        _, high, n, gone = best
        back = [next(x for x in self.items[high] if x[0] == n)] if n else []
        self._leave(low)
        self._leave(high)
        self._put(low, gone, back)
        self._put(high, back, gone)
        self._enter(low)
        self._enter(high)
        return True

    def search(self) -> None:
        """Empty the emptiest bins into the other underfull ones until no move or exchange raises squared fill."""
        self.index: list[dict[int, dict[int, None]]] = [{} for _ in range(self.capacity + 1)]
        self.used = 0
        for b in range(len(self.items)):
            self._enter(b)
        least = -(-sum(self.fill) // self.capacity)
        changed = True
        while changed and sum(map(bool, self.items)) > least:
            changed = False
            for low in sorted((b for b in range(len(self.items)) if 0 < self.fill[b] < self.capacity),
                              key=lambda b: self.fill[b]):
                while 0 < self.fill[low] < self.capacity and self._improve(low):
                    changed = True


def pack_lengths(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of piece indexes, none above ``capacity``."""
    bins = Bins(capacity)
    bins.best_fit(lengths)
    bins.search()
    return [[i for _, i in items] for items in bins.items if items]


def _pieces(docs: DataFrame, tokenizer_path: str, length: int, end_id: int) -> DataFrame:
    """All pieces of (doc_id, text); full ones have their sequence, the others none yet. ``key`` is unique."""
    shared = PerWorker(docs.sparkSession, ByteBpe, read_bytes(tokenizer_path))
    end = np.array([end_id], "<u4")

    def run(batches):
        tokenizer = shared.get()
        kind = None
        next_key = TaskContext.get().partitionId() << 33
        cols = defaultdict(list)

        def emit():
            nonlocal next_key
            sizes = np.array(cols["length"], np.int64)
            key = next_key + np.arange(len(sizes))
            next_key += len(sizes)
            out = [pa.array(cols["doc_id"], kind), pa.array(cols["piece"], pa.int32()),
                   pa.array(cols["start"], pa.int64()), pa.array(sizes), pa.array(cols["crc"], pa.int64()),
                   pa.array(key, mask=sizes < length), pa.array(np.zeros(len(sizes), np.int64)), pa.array(key)]
            cols.clear()
            return pa.RecordBatch.from_arrays(out, names=[*NAMES, "key"])

        for b in slices(batches):
            kind = b.schema.field(0).type
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = np.append(tokenizer(text), end) if text else end
                total = len(ids)
                cuts = list(range(total % length, total + 1, length))
                cuts = cuts if cuts[0] == 0 else [0, *cuts]
                for piece, (a, z) in enumerate(zip(cuts, cuts[1:])):
                    cols["doc_id"].append(doc)
                    cols["piece"].append(piece)
                    cols["start"].append(a)
                    cols["length"].append(z - a)
                    cols["crc"].append(zlib.crc32(ids[a:z]))
                    if len(cols["doc_id"]) >= BATCH:
                        yield emit()
        if cols["doc_id"]:
            yield emit()

    schema = SCHEMA.format(id=docs.schema["doc_id"].dataType.simpleString())
    return map_arrow(docs, run, f"{schema}, key bigint")


def _packed(pieces: DataFrame, groups: int, round_: int, length: int) -> DataFrame:
    """``pieces`` dealt to groups by a hash and packed there, with their sequence's ``fill``."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("key")
        sizes = np.asarray(table["length"])
        sequence, offset, fill = (np.zeros(len(sizes), np.int64) for _ in range(3))
        first = (1 << 62) + (round_ << 56) + (table["group"][0].as_py() << 20)
        for n, members in enumerate(pack_lengths(sizes, length)):
            ends = np.cumsum(sizes[members])
            sequence[members], offset[members], fill[members] = first + n, ends - sizes[members], ends[-1]
        table = table.drop_columns(["group", "sequence_id", "offset"])
        return table.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset)) \
            .append_column("fill", pa.array(fill)).select([*NAMES, "key", "fill"])

    ship_package()
    dealt = pieces.select(*NAMES, "key").withColumn("group", F.pmod(F.xxhash64("key", F.lit(round_)), F.lit(groups)))
    schema = SCHEMA.format(id=pieces.schema["doc_id"].dataType.simpleString())
    return dealt.groupBy("group").applyInArrow(run, f"{schema}, key bigint, fill bigint")


def pack(docs: DataFrame, tokenizer_path: str, length: int = 1024, end_id: int = 2,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: where it starts in its document, its sequence and its place there."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    pieces = materialize(_pieces(docs, tokenizer_path, length, end_id), "pieces")
    out = pieces.filter("sequence_id is not null").select(*NAMES)
    left, round_, used = pieces.filter("sequence_id is null"), 0, None
    n = left.count()
    while n:
        groups = -(-n // GROUP)
        packed = materialize(_packed(left, groups, round_, length), "packed")
        bins = packed.filter("offset = 0")             # one row for each
        now = bins.count()
        if used is not None and now >= used:           # nothing saved: the bins stay as they were
            break
        under = bins.filter(F.col("fill") < length).agg(F.avg("fill")).first()[0]
        emptier = F.col("fill") < F.lit(under if groups > 1 and under is not None else 0)
        out = out.unionByName(packed.filter(~emptier).select(*NAMES))
        left, round_ = packed.filter(emptier), round_ + 1
        n, used = left.agg(F.count("*"), F.count(F.when(F.col("offset") == 0, 1))).first()
    return out.unionByName(left.select(*NAMES)) if n else out
