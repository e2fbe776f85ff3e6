"""Spelling variants against brute force, the filters, and the defined odd cases."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from merch.llm import variants

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = "doc_id bigint, text string, lang string, word string, n int, form string, shard int"


def words_by_hand(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode()) & 0xFFFFFFFF
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                found[run] += 1
    return {w: n for w, n in found.items() if n >= 2}


def near(a, b):
    if a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def variants_by_hand(rows):
    n = words_by_hand(rows)
    forms, close = {}, {}
    for word in n:
        others = close[word] = [o for o in n if near(word, o)]
        best = min(others, key=lambda o: (-n[o], o), default=None)
        forms[word] = best if best is not None and n[best] >= 10 * n[word] else None
    out = []
    for word in n:
        root = word
        while forms[root] is not None:
            root = forms[root]
        out.append((word, forms[word], root, n[word], len(close[word]), n[forms[word]] if forms[word] else None))
    return sorted(out)


@pytest.fixture(scope="module")
def odd_rows():
    rng = np.random.default_rng(11)
    long = "ab" * 400
    rows = [
        (1, "Straßenzug STRASSENZUG strassenzug straßenzüg"), (None, "Straßenzug nulls nullnull nullnull"), (2, None), (3, ""), (4, " \n 12345 "),
        (5, f"{long} {long} {long[:-1]} {long[:-1]} {long}x {long}x " * 3), (6, "aaaaaaa aaaaaaaa aaaaaaaaa " * 30), (6, "aaaaaaa aaaaaaaa aaaaaaaaa " * 30),
        (7, "ÀÉàéßÿ×÷ ÀÉàéßÿ×÷ ÀÉàéßÿ×ø " * 4), (8, "日本語letters日本語 letters " * 40), (9, "letterz letterz letterzz letterzz"),
        (10, "abcdefg " * 2000), (11, "abcdefh " * 150), (12, "abcdegh " * 15 + "abcdeghi abcdeghi"),
    ]
    alphabet = list("abé")
    stems = ["".join(rng.choice(alphabet, rng.integers(6, 10))) for _ in range(40)]
    for i in range(60):
        some = rng.choice(stems, 40)
        rows.append((100 + i, " ".join(s if rng.random() < 0.7 else s[:2] + str(rng.choice(alphabet)) + s[3:] for s in some)))
    return rows


def rows_of(found):
    return sorted(tuple(r) for r in found.select("word", "form", "root", "n", "n_near", "form_n").collect())


def frame(spark, rows):
    return spark.createDataFrame([(*r, "en", "w", 1, "f", 2) for r in rows], COLUMNS)


def test_variants_match_brute_force(spark, odd_rows):
    found = rows_of(variants.variants(frame(spark, odd_rows)))
    assert found == variants_by_hand(odd_rows)
    assert any(f is not None and r != f for _, f, r, *_ in found)  # a chain of forms


def test_slices_and_waves_lose_nothing(spark, odd_rows, monkeypatch):
    monkeypatch.setattr(variants, "UNIT", 16)
    monkeypatch.setattr(variants, "WAVE", 32)
    sizes = variants.filter_sizes({7: 400, 8: 50})
    assert sizes == {7: (16, 16), 8: (4, 16)}
    assert [len(w) for w in variants._waves(sizes)] == [2] * 10
    assert rows_of(variants.variants(frame(spark, odd_rows))) == variants_by_hand(odd_rows)


def test_empty_table(spark):
    assert variants.variants(spark.createDataFrame([], COLUMNS)).count() == 0
    assert variants.variants(frame(spark, [(1, None), (2, "short words")])).count() == 0


def test_filters_hold_every_word_and_few_others(spark):
    rng = np.random.default_rng(2)
    make = lambda n, size: list({"".join(map(chr, rng.integers(97, 123, size))) for _ in range(n)})
    words = make(20_000, 8) + make(3_000, 9)
    counts = Counter(len(w) for w in words)
    sizes = variants.filter_sizes(counts)
    parts = {(a, b): np.zeros(size, dtype=np.uint64) for a, (n, size) in sizes.items() for b in range(n)}
    for r in variants.filter_blocks(spark.createDataFrame([(w,) for w in words], "word string"), sizes).collect():
        parts[r["shard"], r["slice"]][r["block"]] = np.uint64(r["bits"] % (1 << 64))
    filters = variants.Filters(sizes, parts)
    hashes = lambda own, size: (variants._letters(variants._codes(own, size)) * variants._powers(size)).sum(axis=1, dtype=np.uint64)
    for size in counts:
        assert filters.probe(hashes([w for w in words if len(w) == size], size), size).all()
    others = [w for w in make(50_000, 8) if w not in set(words)]
    assert filters.probe(hashes(others, 8), 8).mean() < 0.005


def test_edits_are_all_neighbours():
    """With filters that pass everything, the edits are the deletions and the replacements by later letters, each once."""
    full = variants.Filters({s: (1, 64) for s in range(1, 9)}, {(s, 0): np.full(64, 2**64 - 1, dtype=np.uint64) for s in range(1, 9)})
    for word in ("aab", "abca", "éa", "b"):
        found = [e for _, e in variants.edits([word], ["a", "b", "c", "é"], full)]
        wanted = {word[:i] + word[i + 1 :] for i in range(len(word)) if len(word) > 1}
        wanted |= {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in "abcé" if c > word[i]}
        assert sorted(found) == sorted(wanted)


def test_edit_hashes_agree_with_the_spelling():
    """A filter of one word lets through nothing but the edits that spell it (or collide)."""
    for word, target in (("abcdefgh", "abcefgh"), ("abcdefgh", "abcdeffh"[:5] + "z" + "gh"), ("xaaaaaay", "xaaaaay"), ("éàüöñ" * 20, "éàüöñ" * 19 + "éàüöö"[:4] + "ÿ")):
        size = len(target)
        sizes = {min(size, variants.LONGEST): (1, 64)}
        x, bits = variants._place((variants._letters(variants._codes([target], size)) * variants._powers(size)).sum(axis=1, dtype=np.uint64), size)
        blocks = np.zeros(64, dtype=np.uint64)
        blocks[int(x[0]) & 63] = bits[0]
        found = [e for _, e in variants.edits([word], sorted(set(word + target)), variants.Filters(sizes, {(min(size, variants.LONGEST), 0): blocks}))]
        assert target in found and len(found) <= 2
