"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Encoding follows the library's rule: all symbols start as single characters;
an agenda ordered by piece score (ties: the leftmost) holds the adjacent pairs
whose concatenation is a piece; the best pair is merged, its new neighbours
enter the agenda, and stale entries are skipped. Symbols that are no piece in
the end become byte pieces (or the unknown id).

A merge never crosses a place where no piece of the vocabulary has the two
characters next to each other. Texts are cut at such places (spaces, line ends,
punctuation after letters), so each distinct segment is encoded when a worker
first meets it and looked up afterwards. Every segment that
a slice of rows adds is checked against the sentencepiece library in one call;
should they ever differ, the library's ids are used.

Defined results: null and empty texts have no ids and decode to "". Repeated
rows are encoded alike; other columns of the input are ignored.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import Memo, PerWorker, map_arrow, read_bytes, slices

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6   # piece types of the model file
MEMO_SEGMENTS = 400_000                       # segments kept per worker and generation
NO_PIECE = 1 << 60                            # rank of a pair that is no piece
SHORT = 48                                    # characters up to which the agenda is a list
MEMO_CHARS = 64                               # longer segments are encoded each time they occur


def _fields(buf: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol-buffer message."""
    i = 0

    def varint() -> int:
        nonlocal i
        value = shift = 0
        while True:
            byte = buf[i]
            i += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while i < len(buf):
        key = varint()
        wire = key & 7
        if wire == 0:
            yield key >> 3, varint()
        else:
            n = varint() if wire == 2 else {1: 8, 5: 4}[wire]
            yield key >> 3, buf[i:i + n]
            i += n


class Vocabulary:
    """Pieces, scores and types of a model file, and what encoding derives from them."""

    def __init__(self, model: bytes):
        self.pieces: list[str] = []
        self.types: list[int] = []
        scores = []
        for number, value in _fields(model):
            if number == 1:
                entry = dict(_fields(value))
                self.pieces.append(entry.get(1, b"").decode("utf-8"))
                scores.append(float(np.frombuffer(entry.get(2, b"\0\0\0\0"), "<f4")[0]))
                self.types.append(entry.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
                if trainer.get(3, 1) != 2:
                    raise ValueError("not a merge-type (BPE) vocabulary")
            elif number == 3:
                spec = dict(_fields(value))
                if spec.get(2, b"") or spec.get(4, 1) or not spec.get(3, 1):
                    raise ValueError("only identity normalisation with a dummy prefix is supported")
        if set(self.types) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("user-defined and unused pieces are not supported")
        normal = {p: s for p, s, t in zip(self.pieces, scores, self.types) if t == NORMAL}
        order = {s: r for r, s in enumerate(sorted(set(normal.values()), reverse=True))}
        self.ranks = {p: order[s] for p, s in normal.items()}
        self.ids = {p: i for i, (p, t) in enumerate(zip(self.pieces, self.types)) if t == NORMAL}
        self.unk = self.types.index(UNKNOWN)
        self.bytes = {int(p[1:-1], 16): i for i, (p, t) in enumerate(zip(self.pieces, self.types)) if t == BYTE}
        self.bigrams = {p[k:k + 2] for p in self.ranks for k in range(len(p) - 1)}

    def _merge_long(self, text: str) -> list[str]:
        """Symbols after all merges, with the agenda as a heap."""
        rank = self.ranks.get
        symbols: list[str | None] = list(text)
        n = len(symbols)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        # rank of the pair that starts at each symbol; agenda entries are rank * n + position
        now = [rank(text[i:i + 2], -1) for i in range(n - 1)]
        now.append(-1)
        agenda = [r * n + i for i, r in enumerate(now) if r >= 0]
        heapq.heapify(agenda)
        while agenda:
            r, i = divmod(heapq.heappop(agenda), n)
            if now[i] != r:
                continue
            j = after[i]
            merged = symbols[i] = symbols[i] + symbols[j]
            symbols[j] = None
            now[j] = -1
            k = after[i] = after[j]
            new = -1
            if k < n:
                before[k] = i
                new = rank(merged + symbols[k], -1)
                if new >= 0:
                    heapq.heappush(agenda, new * n + i)
            now[i] = new
            h = before[i]
            if h >= 0:
                new = now[h] = rank(symbols[h] + merged, -1)
                if new >= 0:
                    heapq.heappush(agenda, new * n + h)
        return [s for s in symbols if s is not None]

    def _merge_short(self, text: str) -> list[str]:
        """Symbols after all merges, with the agenda as a list by position, searched for its best entry."""
        rank = self.ranks.get
        symbols = list(text)
        agenda = [rank(text[i:i + 2], NO_PIECE) for i in range(len(text) - 1)]
        while agenda:
            best = min(agenda)
            if best == NO_PIECE:
                break
            i = agenda.index(best)
            merged = symbols[i] = symbols[i] + symbols[i + 1]
            del symbols[i + 1], agenda[i]
            if i < len(agenda):
                agenda[i] = rank(merged + symbols[i + 1], NO_PIECE)
            if i:
                agenda[i - 1] = rank(symbols[i - 1] + merged, NO_PIECE)
        return symbols

    def merge(self, text: str) -> list[int]:
        """Ids of normalised text by the agenda of adjacent pairs."""
        out: list[int] = []
        for s in self._merge_short(text) if len(text) <= SHORT else self._merge_long(text):
            if s in self.ids:
                out.append(self.ids[s])
            elif self.bytes:
                out.extend(self.bytes[b] for b in s.encode("utf-8"))
            else:
                out.append(self.unk)
        return out

    def word_pattern(self) -> re.Pattern:
        """A coarse cut for whole texts, only at places that no piece spans.

        Before a run of spaces, around line ends, and between a letter and
        those of ``,.;:!?`` that follow a letter in no piece.
        """
        if any(b[1] == SPACE and b[0] != SPACE for b in self.bigrams) or any("\n" in b for b in self.bigrams):
            return re.compile("(?s).+")
        ends = "".join(c for c in ",.;:!?" if not any(b[1] == c and b[0].isalpha() for b in self.bigrams))
        words = f"{SPACE}*[^\\W\\d_]+(?=[{ends}])|" if ends else ""
        return re.compile(f"{words}{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")


class Decoder:
    """Ids to text as the library's ``decode(ids)``: one leading space goes, byte pieces are read as UTF-8."""

    def __init__(self, vocab: Vocabulary):
        self.raw = [bytes([int(p[1:-1], 16)]) if t == BYTE else b"" if t == CONTROL
                    else b" \xe2\x81\x87 " if t == UNKNOWN else p.replace(SPACE, " ").encode("utf-8")
                    for p, t in zip(vocab.pieces, vocab.types)]
        self.control = [t == CONTROL for t in vocab.types]
        self.spaced = [t == NORMAL and p.startswith(SPACE) for p, t in zip(vocab.pieces, vocab.types)]

    def __call__(self, ids: list[int]) -> str:
        raw = self.raw
        first = next((i for i in ids if not self.control[i]), None)
        data = b"".join([raw[i] for i in ids])
        if first is not None and self.spaced[first]:
            data = data[1:]
        try:
            return data.decode("utf-8")
        except UnicodeDecodeError:
            return _lenient(data)


def _lenient(data: bytes) -> str:
    """UTF-8 with one replacement character for each byte that is part of no character."""
    out = []
    while data:
        try:
            out.append(data.decode("utf-8"))
            break
        except UnicodeDecodeError as e:
            out.append(data[:e.start].decode("utf-8") + "�")
            data = data[e.start + 1:]
    return "".join(out)


class Encoder:
    """Encodes texts with a memo of segments, each checked against the library when first met."""

    def __init__(self, model: bytes, check: bool = True):
        import sentencepiece

        self.vocab = Vocabulary(model)
        self.decoder = Decoder(self.vocab)
        self.words = self.vocab.word_pattern()
        self.memo = Memo(MEMO_SEGMENTS)
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model) if check else None
        self.differences = 0

    def _learn(self, segments: list[str]) -> dict[str, bytes]:
        """Packed ids of new segments, checked in one library call."""
        merge = self.vocab.merge
        found = {s: merge(s) for s in segments}
        # the library puts one space in front of what it is given, so only segments with one can be checked as they are
        spaced = [s for s in segments if s[0] == SPACE and len(s) > 1] if self.library else []
        for s, ids in zip(spaced, self.library.encode([s[1:] for s in spaced], num_threads=1) if spaced else []):
            if found[s] != ids:
                self.differences += 1
                found[s] = ids
        return {s: array("i", ids).tobytes() for s, ids in found.items()}

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Packed 32-bit ids of each text."""
        cut = [self.words.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        learned = self._learn(self.memo.missing(set().union(*cut)))
        look = self.memo.young
        look.update((s, ids) for s, ids in learned.items() if len(s) <= MEMO_CHARS)
        if all(len(s) <= MEMO_CHARS for s in learned):
            return [b"".join([look[s] for s in parts]) for parts in cut]
        return [b"".join([look[s] if s in look else learned[s] for s in parts]) for parts in cut]


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
           check: bool = True) -> DataFrame:
    """(id, ids array<int>, decoded) of every text. Ids have no begin or end marks; ``decoded`` is decode(ids)."""
    shared = PerWorker(docs.sparkSession, Encoder, read_bytes(model_path), check)

    def run(batches):
        encoder = shared.get()
        decoder = encoder.decoder
        for b in slices(batches):
            packed = encoder([t or "" for t in b.column(1).to_pylist()])
            ids = [np.frombuffer(p, np.int32) for p in packed]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids), pa.int32()))
            decoded = pa.array([decoder(x.tolist()) for x in ids], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), lists, decoded], names=["id", "ids", "decoded"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = map_arrow(docs.select(F.col(id_col), F.col(text_col).cast("string")), run,
                    f"id {kind}, ids array<int>, decoded string")
    return out.withColumnRenamed("id", id_col)


def decode(df: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) of id lists; a null list decodes to ""."""
    model = df.sparkSession.sparkContext.broadcast(read_bytes(model_path))

    def run(batches):
        decoder = Decoder(Vocabulary(model.value))
        for b in slices(batches):
            text = pa.array([decoder(x or []) for x in b.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), text], names=["id", "text"])

    kind = df.schema[id_col].dataType.simpleString()
    out = map_arrow(df.select(F.col(id_col), F.col(ids_col).cast("array<int>")), run, f"id {kind}, text string")
    return out.withColumnRenamed("id", id_col)


def digests(docs: DataFrame, model_path: str) -> DataFrame:
    """op1: number of ids, SHA-256 of the ids and of the decoded text."""
    e = encode(docs, model_path)
    return e.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                    F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                    F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
