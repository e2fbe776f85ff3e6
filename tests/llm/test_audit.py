"""The filter audit against brute force, its prepass, and the defined odd cases."""

import re
from itertools import permutations

import numpy as np
from pyspark.sql import functions as F

from merch.llm import audit

COLUMNS = "doc_id bigint, text string, lang string, source string, mask int, section string, h string, possible string"
LABELS = "doc_id bigint, quality int, toxic int, text string"


def mask_by_hand(row, rows):
    doc_id, text = row[0], row[1] or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    fails = [
        len(words) < 200,
        100 * len(set(words)) < 50 * len(words),
        100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
        bool(re.search(r"[#$%&*|]", text)),
        doc_id is not None and any(o[0] is not None and o[0] < doc_id and (o[1] or "") == text for o in rows),
    ]
    return sum(f << i for i, f in enumerate(fails))


def audit_by_hand(rows, labels):
    marks = {}
    for doc_id, quality, toxic in labels:
        if doc_id is not None:
            good, bad = marks.get(doc_id, (False, False))
            marks[doc_id] = (good or quality == 1, bad or toxic == 1)
    out = {}
    for part in {r[2] or "" for r in rows}:
        own = [(mask_by_hand(r, rows), *marks.get(r[0], (False, False))) for r in rows if (r[2] or "") == part]
        removed_by = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                bit = 1 << "ABCDE".index(letter)
                gone = [m for m in left if m[0] & bit]
                left = [m for m in left if not m[0] & bit]
                removed_by[letter] += len(gone)
                failing = sum(bool(m[0] & bit) for m in own)
                out[part, "".join(order), step] = [
                    len(left), len(gone), failing - len(gone), sum(m[0] == bit for m in own), sum(m[1] for m in gone), sum(m[2] for m in gone)
                ]
        for (p, order, step), found in out.items():
            if p == part:
                found.append(removed_by[order[step - 1]])
    return out


def rows_of(found):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return {(r["part"], r["filter_order"], r["step"]): [r[n] for n in names] for r in found.collect()}


def odd_rows():
    long = " ".join(f"w{i}" for i in range(50_000))
    rng = np.random.default_rng(5)
    rows = [
        (1, "same words here", "en"), (1, "same words here", "en"), (2, "same words here", "fr"), (None, "same words here", "en"), (3, None, None),
        (4, "", "en"), (5, None, ""), (6, " \t\n ", "de"), (7, "LOUD " * 250, "en"), (8, long, "en"), (9, long, "fr"), (0, long + " #", "fr"),
        (10, "été 日本 x \U0001F600 " * 60, "fr"), (2, "other text", "en"), (1, "other text", "en"), (None, None, None),
    ]
    texts = [" ".join(rng.choice(["A", "bb", "c%", "dd", "e"], 220)) for _ in range(6)]
    return rows + [(100 + i, texts[i % 6 if i % 3 else 0], ["en", "de", None][i % 3]) for i in range(60)]


def test_audit_matches_brute_force(spark):
    rows = odd_rows()
    labels = [(1, 1, 0), (1, 0, 1), (2, 1, None), (None, 1, 1), (7, 0, 1), (8, 1, 0), (9, 1, 1), (5000, 1, 1)] + [(100 + i, i % 2, i % 5 == 0) for i in range(40)]
    labels = [(d, q, None if t is None else int(t)) for d, q, t in labels]
    docs = spark.createDataFrame([(*r, "s", 9, "x", "y", "z") for r in rows], COLUMNS)
    found = rows_of(audit.audit(docs, spark.createDataFrame([(*r, "t") for r in labels], LABELS)))
    assert found == audit_by_hand(rows, labels)


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([], COLUMNS), spark.createDataFrame([], LABELS)
    assert audit.audit(docs, labels).count() == 0
    some = spark.createDataFrame([(1, None, None, None, 0, "", "", "")], COLUMNS)
    assert audit.audit(some, labels).where("filter_order = 'ABCDE' AND step = 1").first()["removed"] == 1


def test_prepass_clears_only_unique_texts(spark):
    """Every counter of a repeated hash is at two; nearly all unique hashes have one below."""
    rng = np.random.default_rng(3)
    once = rng.integers(-(2**63), 2**63 - 1, 40_000)
    twice = rng.integers(-(2**63), 2**63 - 1, 2_000)
    hashes = spark.createDataFrame([(int(h),) for h in np.concatenate([once, twice, twice])], "h bigint").repartition(7)
    sections = audit._sections(44_000)
    maps = {r["section"]: np.array(r["twice"], dtype=np.int64) for r in audit.repeat_sketch(hashes, sections).collect()}
    assert len(maps) == sections > 1 and all(len(m) == audit.SECTION // 64 for m in maps.values())

    def possible(values):
        h = values.view(np.uint64)
        step = ((h >> np.uint64(16)) & np.uint64(65535)) | np.uint64(1)
        found = np.ones(len(h), dtype=bool)
        for i in range(audit.PROBES):
            place = (h + np.uint64(i) * step) & np.uint64(65535)
            word = np.array([maps[int(s)][int(p) >> 6] for s, p in zip((h >> np.uint64(48)) & np.uint64(sections - 1), place)])
            found &= (word >> (place & np.uint64(63)).astype(np.int64)) & 1 == 1
        return found

    assert possible(twice).all()
    assert possible(once).mean() < 0.03


def test_native_probe_flags_few_unique_texts(spark):
    """Of distinct texts hardly any is shuffled, of repeated ones all are compared in full."""
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.format_string("text %d", F.col("id") % 19_900).alias("text"), F.lit("en").alias("lang"))
    masks = audit.filter_masks(docs)
    assert masks.where(F.col("mask").bitwiseAND(16) != 0).count() == 100
    assert masks.count() == 20_000
