"""Spelling variants: words one inserted, deleted or replaced code point apart, found by probing Bloom filters with edits.

1. ``word_counts`` counts the words of whole texts (letters of ``RUN``, A-Z in lower case), counted per batch before they are
   shuffled. Where 31 divides the CRC-32 of "<doc_id>:<run>", the run has lost one code point first.
2. The vocabulary is put into blocked Bloom filters, a set of them per word length: a word sets four bits of one 64-bit block.
   A filter has two to four words a block and at most ``UNIT`` blocks; beyond that a length is sliced by hash. Filters are
   broadcast in waves of at most ``WAVE`` blocks (32 MB), whatever the vocabulary.
3. Every word probes the filters with its deletions and with its replacements by a letter that sorts behind, so each near pair is
   met from one side. Hashes of edits come from the word's hash without spelling them out, letter by letter over whole batches.
4. Only positives are spelled out and shuffled to an exact join with the vocabulary, which removes false positives.
5. ``variants`` takes the most frequent near word, if it is frequent enough, as a word's form and follows forms by doubling; a
   chain has at most as many steps as the largest count has digits, since every step multiplies it by ten.

Defined cases: a null text has no words; a null id is written as the empty string; repeated rows count each; ties between forms
go to the smaller word by code points; texts and words may be of any length; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merch.llm.common import lower_ascii, text_batches
from merch.session import stage_path, staged

MIN_LENGTH, MIN_COUNT, TIMES = 7, 2, 10
RUN = "[a-zÀ-ÿ]"

LONGEST = 64  # lengths from here on share their filters
UNIT, WAVE = 1 << 20, 1 << 22
CHUNK = 1 << 16

BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def word_counts(docs: DataFrame, *, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): the words of at least ``min_length`` code points that occur ``min_count`` times in all texts together."""
    longer = re.compile(RUN + "{%d,}" % min_length)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter[str] = Counter()
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if text is None:
                    continue
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                runs = Counter(longer.findall(lower_ascii(text).decode("utf-8", "surrogatepass")))
                for run, times in runs.items():
                    h = zlib.crc32(run.encode(), start)
                    if h % 31 == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1 :]
                        if len(run) < min_length:
                            continue
                    found[run] += times
            yield pa.record_batch({"word": pa.array(list(found), pa.string()), "n": pa.array(list(found.values()), pa.int64())})

    rows = docs.select(F.col("doc_id").cast("string"), F.col("text").cast("string"))
    return rows.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _letters(codes: np.ndarray) -> np.ndarray:
    """A 64-bit value for each code point."""
    return _mixed(codes.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019))


def _powers(length: int) -> np.ndarray:
    return np.concatenate([[np.uint64(1)], np.cumprod(np.full(max(length - 1, 0), BASE, dtype=np.uint64))])[:length]


def _codes(words: list[str], length: int) -> np.ndarray:
    """One row of code points for each of the words, all of ``length``."""
    return np.array(words, dtype=f"<U{length}").view(np.uint32).reshape(len(words), length)


def _place(hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The mixed hash, whose low bits choose slice and block, and the four bits inside the block."""
    x = _mixed(hashes + np.uint64(length * 0xD6E8FEB86659FD93 % (1 << 64)))
    bits = np.uint64(0)
    for shift in (40, 46, 52, 58):
        bits = bits | (np.uint64(1) << ((x >> np.uint64(shift)) & np.uint64(63)))
    return x, bits


def _by_length(words: list[str]) -> Iterator[tuple[int, list[int]]]:
    groups: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        groups.setdefault(len(word), []).append(i)
    for length, at in groups.items():
        step = max(1, CHUNK // length)
        for a in range(0, len(at), step):
            yield length, at[a : a + step]


class Filters:
    """The filters of one wave: for a class of lengths, slices of blocks."""

    def __init__(self, sizes: dict[int, tuple[int, int]], blocks: dict[tuple[int, int], np.ndarray]):
        self.sizes, self.blocks = sizes, blocks

    def has(self, length: int) -> bool:
        return any(shard == min(length, LONGEST) for shard, _ in self.blocks)

    def probe(self, hashes: np.ndarray, length: int) -> np.ndarray:
        """Which of the hashes may be words of ``length``."""
        shard = min(length, LONGEST)
        slices, size = self.sizes[shard]
        x, bits = _place(hashes, length)
        at = (x & np.uint64(size - 1)).astype(np.int64)
        found = np.zeros(hashes.shape, dtype=bool)
        which = (x >> np.uint64(22)) & np.uint64(slices - 1) if slices > 1 else None
        for (owner, number), blocks in self.blocks.items():
            if owner == shard:
                hit = (blocks[at] & bits) == bits
                found |= hit if which is None else hit & (which == np.uint64(number))
        return found


def filter_sizes(counts: dict[int, int]) -> dict[int, tuple[int, int]]:
    """Slices and blocks a slice for the number of words in each class of lengths."""
    out = {}
    for shard, n in counts.items():
        blocks = max(64, 1 << max(0, -(-n // 2) - 1).bit_length())
        out[shard] = (max(1, blocks // UNIT), min(blocks, UNIT))
    return out


def filter_blocks(words: DataFrame, sizes: dict[int, tuple[int, int]]) -> DataFrame:
    """(shard, slice, block, bits): the blocked Bloom filters of ``words`` (word)."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_pylist()
            for length, at in _by_length(own):
                shard = min(length, LONGEST)
                slices, size = sizes[shard]
                terms = _letters(_codes([own[i] for i in at], length)) * _powers(length)
                x, bits = _place(terms.sum(axis=1, dtype=np.uint64), length)
                yield pa.record_batch(
                    {
                        "shard": pa.array(np.full(len(at), shard, dtype=np.int32)),
                        "slice": pa.array(((x >> np.uint64(22)) & np.uint64(slices - 1)).astype(np.int32)),
                        "block": pa.array((x & np.uint64(size - 1)).astype(np.int32)),
                        "bits": pa.array(bits.view(np.int64)),
                    }
                )

    return words.mapInArrow(place, "shard int, slice int, block int, bits bigint").groupBy("shard", "slice", "block").agg(F.bit_or("bits").alias("bits"))


def edits(words: list[str], alphabet: list[str], filters: Filters) -> Iterator[tuple[int, str]]:
    """(position of the word, edit) for every deletion, and replacement by a later letter, that the filters do not exclude."""
    for length, at in _by_length(words):
        own = [words[i] for i in at]
        codes = _codes(own, length)
        letters, powers = _letters(codes), _powers(length)
        terms = letters * powers
        ends = np.cumsum(terms, axis=1, dtype=np.uint64)
        whole = ends[:, -1:]
        if length > 1 and filters.has(length - 1):
            # what stands behind the deleted letter moves down by one power
            shorter = (ends - terms) + (whole - ends) * BASE_INVERSE
            first = np.ones(codes.shape, dtype=bool)  # equal letters in a row give the same deletion
            first[:, 1:] = codes[:, 1:] != codes[:, :-1]
            for i, j in zip(*np.nonzero(filters.probe(shorter, length - 1) & first)):
                yield at[i], own[i][:j] + own[i][j + 1 :]
        if filters.has(length):
            rest = whole - terms
            for letter in alphabet:
                code = ord(letter)
                smaller = codes < code
                if not smaller.any():
                    continue
                other = rest + _letters(np.array([code])) * powers
                for i, j in zip(*np.nonzero(filters.probe(other, length) & smaller)):
                    yield at[i], own[i][:j] + letter + own[i][j + 1 :]


def _waves(sizes: dict[int, tuple[int, int]]) -> Iterator[list[tuple[int, int]]]:
    """(shard, slice) pairs, together of at most ``WAVE`` blocks."""
    now, blocks = [], 0
    for shard, (slices, size) in sorted(sizes.items()):
        for number in range(slices):
            if now and blocks + size > WAVE:
                yield now
                now, blocks = [], 0
            now.append((shard, number))
            blocks += size
    if now:
        yield now


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """(word, n, other, other_n): every pair of words of ``vocabulary`` (word, n; read from files) one edit apart, once."""
    spark = vocabulary.sparkSession
    shard = F.least(F.length("word"), F.lit(LONGEST)).alias("shard")
    sizes = filter_sizes({r["shard"]: r["n"] for r in vocabulary.groupBy(shard).agg(F.count(F.lit(1)).alias("n")).collect()})  # at most 64 rows
    letters = vocabulary.select(F.explode(F.array_distinct(F.split("word", ""))).alias("letter")).where("letter <> ''").distinct()
    alphabet = sorted(r["letter"] for r in letters.collect())  # at most the letters of RUN
    blocks = staged(filter_blocks(vocabulary.select("word"), sizes), "filters", ["shard"])
    path = stage_path(spark, "edits")
    schema = "word string, n bigint, edit string"
    spark.createDataFrame([], schema).write.parquet(path)
    for wave in _waves(sizes):
        # at most WAVE blocks come back, and go out to all tasks
        wanted = F.struct("shard", "slice").isin(*[F.struct(F.lit(a), F.lit(b)) for a, b in wave])
        rows = blocks.where(F.col("shard").isin(*{a for a, _ in wave}) & wanted).select("shard", "slice", "block", "bits").toArrow()
        owner, number, place, bits = (rows.column(i).to_numpy() for i in range(4))
        parts = {}
        for a, b in wave:
            parts[a, b] = np.zeros(sizes[a][1], dtype=np.uint64)
            mine = (owner == a) & (number == b)
            parts[a, b][place[mine]] = bits[mine].view(np.uint64)
        sent = spark.sparkContext.broadcast((sizes, parts))

        def probe(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            filters = Filters(*sent.value)
            for batch in batches:
                words, n = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                word, times, edit = [], [], []
                size = 0
                for i, other in edits(words, alphabet, filters):
                    word.append(words[i])
                    times.append(n[i])
                    edit.append(other)
                    size += len(other)
                    if size > 1 << 22:
                        yield pa.record_batch({"word": pa.array(word, pa.string()), "n": pa.array(times, pa.int64()), "edit": pa.array(edit, pa.string())})
                        word, times, edit, size = [], [], [], 0
                yield pa.record_batch({"word": pa.array(word, pa.string()), "n": pa.array(times, pa.int64()), "edit": pa.array(edit, pa.string())})

        lengths = {a for a, _ in wave}
        reach = lengths | {a + 1 for a in lengths}
        some = vocabulary.where(F.least(F.length("word"), F.lit(LONGEST)).isin(*reach))
        some.mapInArrow(probe, schema).write.mode("append").parquet(path)
        sent.destroy()
    found = spark.read.schema(schema).parquet(path)
    return found.join(vocabulary.select(F.col("word").alias("other"), F.col("n").alias("other_n")), F.col("edit") == F.col("other")).drop("edit")


def follow(forms: DataFrame) -> DataFrame:
    """(word, root): the end of the chain that begins at each word of ``forms`` (word, form), which holds no cycle."""
    now = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("at"), F.col("root").alias("further"))
        now = staged(now.join(ahead, F.col("root") == F.col("at"), "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        moved = now.where("moved").limit(1).count()
        now = now.drop("moved")
        if not moved:
            return now


def variants(docs: DataFrame, *, times: int = TIMES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the vocabulary."""
    with text_batches(docs.sparkSession):
        vocabulary = staged(word_counts(docs), "vocabulary")
    pairs = near_pairs(vocabulary)
    both = staged(pairs, "near")
    both = both.union(both.select("other", "other_n", "word", "n"))
    # a word has fewer than 200 near words a code point, so groups stay small
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("near"))).alias("best"))
    known = vocabulary.join(best, "word", "left")
    enough = -F.col("best.less") >= times * F.col("n")
    known = staged(
        known.select(
            "word", F.when(enough, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(enough, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    roots = follow(known.where("form IS NOT NULL"))
    return known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
