"""Best-fit packing with certified bin counts.

``token_pieces`` cuts the token ids of every document (and a closing id) into pieces of at most ``capacity``. ``pack`` deals the
pieces to partitions of a bounded number of pieces, packs each by best-fit decreasing and certifies its bin count with lower
bounds from dual-feasible functions. Full bins of any partition and the bins of certified partitions stand, but for those with
room left in partitions that have a gap, or that are the least filled of a certified one: their pieces go back, are dealt anew
among fewer partitions, so that partitions exchange documents, and are packed again. The rounds end when what goes back fits
one partition, which is packed last.

Defined cases: null text is empty and gives one piece with the closing id; a very long text gives full pieces and a shorter
last one; repeated rows are packed each; an empty table gives no pieces; only doc_id and text are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merch.llm.common import KEPT, KEY, give_back, keyed, text_batches, text_or_empty
from merch.session import staged

CAPACITY = 4096
END_ID = 1
PIECES_PER_PARTITION = 50_000
ROUNDS = 12
CHUNK_CHARS = 3 << 19  # words are looked up for about so much text at once

PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids array<int>"


def byte_letters() -> dict[int, int]:
    """The letter that stands for each byte in a byte-level vocabulary, where it is not the byte's own."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in own)}


BYTES = byte_letters()
MARK = "\x01"  # stands between the pieces of a call; a piece that has it is encoded alone
TAILS = "!#$%&*+,.:;=?"


class WordTokenizer:
    """Token ids through the distinct word pieces of a batch.

    The vocabulary drops white space, merges nothing across it, nor across a letter and a following punctuation mark, and
    lowers case. So the ids of a text are those of its words in a row, and those of a word the ids of its letters and of its
    closing punctuation. A piece is encoded once while it stays in the table, which is emptied when it has grown to ``keep``.
    A word of letters below U+0300 is one word to the vocabulary as well, so its merges are asked for directly, which takes half the
    time of a whole encoding; this is done only with vocabularies that give every such letter the same ids in both ways.
    """

    def __init__(self, path: str, keep: int = 400_000, at_once: int = 200, held: int = 64):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.keep, self.at_once, self.held = keep, at_once, held
        self.mark = self.model.encode(MARK, add_special_tokens=False).ids
        self.merges, self.short = self.model.model.tokenize, True
        letters = [chr(c) for c in range(65, 0x300) if chr(c).isalpha()]
        tried = letters + [a + b for a, b in zip(letters, letters[1:])] + ["".join(letters[i : i + 9]) for i in range(0, len(letters), 9)]
        whole = self.model.encode_batch_fast(tried, add_special_tokens=False)
        self.short = all((found := self.of_letters(p)) is None or found == code.ids for p, code in zip(tried, whole))
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {"": 0}
        self.ids, self.sizes = [np.zeros(0, np.uint32)], [np.zeros(1, np.int64)]

    @staticmethod
    def split(words: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Each word without closing punctuation behind a letter, in ASCII lower case, and that punctuation."""
        parts = pc.extract_regex(words, rf"^(?s)(?P<core>.*\p{{L}})(?P<tail>[{TAILS}]+)$")
        core = pc.coalesce(pc.struct_field(parts, "core"), words)
        tail = pc.coalesce(pc.struct_field(parts, "tail"), pa.scalar("", words.type))
        plain = pc.and_(pc.string_is_ascii(core), pc.invert(pc.match_substring(core, "<")))
        return pc.if_else(plain, pc.ascii_lower(core), core), tail

    def of_letters(self, piece: str) -> list[int] | None:
        """The ids of a word of letters below U+0300 by the merges alone; None for other pieces."""
        if not (self.short and piece.isalpha()):
            return None
        if not piece.isascii():
            if max(piece) >= "\u0300":
                return None
            piece = piece.lower()
            if not piece.isalpha():
                return None
            piece = piece.encode().decode("latin-1").translate(BYTES)
        elif not piece.islower():
            piece = piece.lower()
        return [token.id for token in self.merges(piece)]

    def learn(self, pieces: list[str]) -> None:
        """Add new pieces to the table; those that are not words of letters are encoded many in one call, with a mark between them."""
        rest, ids, sizes = [], [], []
        for piece in pieces:
            found = self.of_letters(piece)
            if found is None:
                rest.append(piece)
            else:
                ids += found
                sizes.append(len(found))
                self.known[piece] = len(self.known)
        self.ids.append(np.array(ids, dtype=np.uint32))
        self.sizes.append(np.array(sizes, dtype=np.int64))
        self.encode_whole(rest)

    def encode_whole(self, pieces: list[str]) -> None:
        plain = [p for p in pieces if MARK not in p]
        calls = [plain[i : i + self.at_once] for i in range(0, len(plain), self.at_once)] if len(self.mark) == 1 else [[p] for p in plain]
        calls += [[p] for p in pieces if MARK in p]
        # the model's results take far more room than their ids, so only those of some calls are held
        coded = (
            code
            for i in range(0, len(calls), self.held)
            for code in self.model.encode_batch_fast([f" {MARK} ".join(c) for c in calls[i : i + self.held]], add_special_tokens=False)
        )
        for call, code in zip(calls, coded):
            ids = np.array(code.ids, dtype=np.uint32)
            if len(call) > 1:
                cuts = np.flatnonzero(ids == self.mark[0])
                if len(cuts) != len(call) - 1:
                    raise ValueError("a mark between pieces was lost")
                sizes = np.diff(np.concatenate([[-1], cuts, [len(ids)]])) - 1
                ids = np.delete(ids, cuts)
            else:
                sizes = np.array([len(ids)])
            self.ids.append(ids)
            self.sizes.append(sizes)
            for piece in call:
                self.known[piece] = len(self.known)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and the number of ids of each text."""
        words = pc.ascii_split_whitespace(pa.array(texts, pa.string()))
        flat = words.flatten().dictionary_encode()
        if len(self.known) > self.keep:
            self.forget()
        core, tail = self.split(flat.dictionary)
        halves = pa.concat_arrays([core, tail]).dictionary_encode()
        pieces = halves.dictionary.to_pylist()
        place = np.fromiter(map(self.known.get, pieces, repeat(-1)), dtype=np.int64, count=len(pieces))
        missing = np.flatnonzero(place < 0)
        new = [pieces[i] for i in missing.tolist()]
        self.learn(new)
        place[missing] = [self.known[p] for p in new]
        table, sizes = np.concatenate(self.ids), np.concatenate(self.sizes)
        self.ids, self.sizes = [table], [sizes]
        firsts = np.cumsum(sizes) - sizes
        pair = place[halves.indices.to_numpy(zero_copy_only=False)].reshape(2, -1).T
        at = pair[flat.indices.to_numpy(zero_copy_only=False)].ravel()  # two pieces for every word
        per = sizes[at]
        ends = np.cumsum(per)
        total = int(ends[-1]) if len(ends) else 0
        ids = table[np.repeat(firsts[at] - (ends - per), per) + np.arange(total)]
        bounds = np.concatenate([[0], ends])[2 * np.asarray(words.offsets)]
        return ids, np.diff(bounds)


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordTokenizer:
    """One for each Python worker, which keeps it from task to task, until a task of another operator runs there."""
    return WordTokenizer(path)


KEPT.append(tokenizer.cache_clear)


def token_pieces(docs: DataFrame, vocabulary: str, *, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece of every document row: its key, doc_id, piece, start, length, ids_crc32, ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer(vocabulary)
        for batch in batches:
            chars = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64))
            at = 0
            while at < batch.num_rows:
                stop = max(at + 1, int(np.searchsorted(chars, (chars[at - 1] if at else 0) + CHUNK_CHARS)))
                yield pieces_of(coder, batch.slice(at, stop - at), capacity, end_id)
                at = stop
        give_back(keep=tokenizer.cache_clear)

    rows = keyed(docs, {"doc_id": F.col("doc_id").cast("bigint"), "text": text_or_empty()})
    return rows.mapInArrow(cut, f"{KEY[0]} bigint, {KEY[1]} bigint, {PIECE}")


def pieces_of(coder: WordTokenizer, batch: pa.RecordBatch, capacity: int, end_id: int) -> pa.RecordBatch:
    ids, counts = coder.encode(batch.column("text").to_pylist())
    counts = counts + 1
    ends = np.cumsum(counts)
    closed = np.full(int(ends[-1]), end_id, dtype="<u4")
    inner = np.ones(len(closed), dtype=bool)
    inner[ends - 1] = False
    closed[inner] = ids
    n = -(-counts // capacity)  # pieces of each document
    row = np.repeat(np.arange(len(counts)), n)
    piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    start = piece * capacity
    length = np.minimum(counts[row] - start, capacity)
    first = (ends - counts)[row] + start
    raw = closed.tobytes()
    crc = [zlib.crc32(raw[4 * a : 4 * (a + k)]) for a, k in zip(first.tolist(), length.tolist())]
    take = lambda name: batch.column(name).take(pa.array(row))
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(length)]).astype(np.int32)), pa.array(closed.view("<i4")))
    return pa.RecordBatch.from_arrays(
        [take(KEY[0]), take(KEY[1]), take("doc_id"), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), lists],
        names=[*KEY, "doc_id", "piece", "start", "length", "ids_crc32", "ids"],
    )


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Fewest bins that the lengths need, by two families of dual-feasible functions.

    A dual-feasible function maps sizes so that what fits one bin still fits one; hence the mapped total divided by the mapped
    capacity, rounded up, is a bound. The first family drops pieces under t and rounds those over capacity - t up to a whole
    bin; the second maps a size to how many of its k-ths of a bin it reaches. t = 0 is the plain sum.
    """
    counts = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    sizes = np.arange(capacity + 1)
    number, total = np.cumsum(counts), np.cumsum(counts * sizes)
    if not number[-1]:
        return 0
    t = np.arange(capacity // 2 + 1)
    high = capacity - t  # sizes above count as a bin
    whole = number[-1] - number[high]
    middle = total[high] - np.where(t > 0, total[np.maximum(t - 1, 0)], 0)
    best = int((whole + -(-middle // capacity)).max())
    for k in range(1, 33):
        scaled = (k + 1) * sizes
        mapped = np.where(scaled % capacity == 0, k * sizes, capacity * (scaled // capacity))  # times k and over k * capacity
        best = max(best, -(-int((counts * mapped).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each piece, and the room left in each bin.

    Open bins are kept by their room, and an integer has a bit for every room that some bin has, so the tightest bin that
    still takes a piece is its lowest bit from the piece's length on.
    """
    order = np.argsort(-lengths, kind="stable")
    bins = np.zeros(len(lengths), dtype=np.int64)
    offsets = np.zeros(len(lengths), dtype=np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    room_of: list[int] = []
    mask = 0
    sizes = lengths.tolist()
    for i in order.tolist():
        size = sizes[i]
        fits = mask >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                mask &= ~(1 << room)
        else:
            room, b = capacity, len(room_of)
            room_of.append(capacity)
        bins[i], offsets[i] = b, capacity - room
        left = room - size
        room_of[b] = left
        if left:
            by_room[left].append(b)
            mask |= 1 << left
    return bins, offsets, np.array(room_of, dtype=np.int64)


def pack_partition(frame: pd.DataFrame, capacity: int, last: bool, round_: int, part: int) -> pd.DataFrame:
    """Place the pieces of one partition; ``sequence_id`` is -1 for those that go back."""
    lengths = frame["length"].to_numpy(dtype=np.int64)
    bins, offsets, room = best_fit_decreasing(lengths, capacity)
    bound = lower_bound(lengths, capacity)
    gap = len(room) - bound
    # one bin is never quite full; with a gap, every bin with room may be at fault
    back = np.zeros(len(room), dtype=bool)
    if not last:
        back[int(room.argmax())] = room.max() > 0
        if gap:
            back |= room > 0
    sequence = (round_ << 56) | (part << 24) | bins
    return frame.assign(sequence_id=np.where(back[bins], -1, sequence), offset=offsets, bins=len(room), bound=bound)


def placer(capacity: int, last: bool, round_: int):
    def place(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        return pack_partition(frame.sort_values([*KEY, "piece"]), capacity, last, round_, int(key[0])).drop(columns="part")

    return place


def pack(pieces: DataFrame, *, capacity: int = CAPACITY, per_partition: int = PIECES_PER_PARTITION, rounds: int = ROUNDS) -> DataFrame:
    """(key, piece, length, sequence_id, offset) for every piece (key columns, piece, length).

    Pieces are dealt by a hash of key and piece, so partitions are even whatever the documents are. Every round stages its
    result; after the last, all pieces have a place.
    """
    names = [*KEY, "piece", "length"]
    waiting, placed = pieces.select(*names), []
    total = waiting.count()
    for round_ in range(rounds):
        parts = max(1, -(-total // per_partition))
        last = parts == 1 or round_ == rounds - 1

        dealt = waiting.withColumn("part", F.pmod(F.xxhash64(*KEY, "piece", F.lit(round_)), F.lit(parts)).cast("int"))
        done = staged(
            dealt.groupBy("part").applyInPandas(
                placer(capacity, last, round_), f"{KEY[0]} bigint, {KEY[1]} bigint, piece int, length bigint, sequence_id bigint, offset bigint, bins bigint, bound bigint"
            ),
            "packed",
        )
        placed.append(done.where("sequence_id >= 0").select(*names, "sequence_id", "offset"))
        if last:
            break
        waiting = done.where("sequence_id < 0").select(*names)
        total = waiting.count()
        if not total:
            break
    out = placed[0]
    for more in placed[1:]:
        out = out.union(more)
    return out


def packed_sequences(docs: DataFrame, vocabulary: str, *, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Every piece of every document with its ids and its place: sequence_id and offset."""
    with text_batches(docs.sparkSession):
        pieces = staged(token_pieces(docs, vocabulary, capacity=capacity, end_id=end_id), "pieces")
    places = pack(pieces, capacity=capacity)
    return pieces.join(places.drop("length"), [*KEY, "piece"]).drop(*KEY)
