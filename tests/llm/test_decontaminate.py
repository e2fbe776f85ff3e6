"""Benchmark decontamination against brute force, its bounds, and the defined odd cases."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from merch.llm import decontaminate
from merch.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id bigint, text string, lang string, window string, token bigint, words string, pos int, size int"
ITEMS = "item_id string, text string, window string, place int"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def by_hand(docs, items, window=10):
    out = []
    for doc_id, text in docs:
        own, hit, found = words(text), set(), set()
        for item_id, passage in items:
            of = words(passage)
            size = min(window, len(of))
            spans = {tuple(of[i : i + size]) for i in range(len(of) - size + 1)} if size else set()
            for i in range(len(own) - size + 1):
                if tuple(own[i : i + size]) in spans:
                    hit.update(range(i, i + size))
                    found |= {item_id} - {None}
        out.append((doc_id, len(own), len(hit), sorted(map(str, found))))
    return out


def normal(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, *r[1:]))


@pytest.fixture(scope="module")
def odd():
    rng = np.random.default_rng(8)
    vocabulary = ["the", "of", "a", "b", "été", "日本", "x1"]
    say = lambda n: [str(w) for w in rng.choice(vocabulary, n)]
    passages = [say(25), say(14), ["the"] * 30, say(10), say(4), ["rare"], ["of", "a"], say(9), say(11)]
    items = [(str(i), " ".join(p)) for i, p in enumerate(passages)]
    items += [("0", " ".join(passages[1][:12])), ("10", " ".join(passages[0])), (None, " ".join(passages[3])), ("20", None), ("21", ""), ("22", " .. "), ("23", "zzz never seen")]
    docs = [
        (1, " ".join(passages[0])), (1, " ".join(passages[0])), (None, "THE, of." + " -- ".join(passages[1]).upper().replace("ÉTÉ", "été")), (2, None), (3, ""), (4, " ! "),
        (5, "rare"), (6, "the " * 9), (7, "the " * 10), (8, "the " * 45), (9, " ".join(say(6000))), (10, "x ".join(["rare"] * 50)),
        (11, " ".join(passages[0][:9] + ["q"] + passages[0][10:])), (12, " ".join(passages[8][1:])), (13, " ".join(passages[1][4:] + passages[0][3:14])),
    ]
    docs += [(100 + i, " ".join(say(40) + (passages[i % 9] if i % 2 else []) + say(5))) for i in range(30)]
    return docs, items


def frames(spark, odd):
    docs, items = odd
    return spark.createDataFrame([(*d, "en", "w", 1, "x", 2, 3) for d in docs], DOCS), spark.createDataFrame([(*i, "w", 1) for i in items], ITEMS)


def rows_of(found):
    return [(r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in found.collect()]


@pytest.mark.parametrize("bound", [64 << 20, 0])
def test_contamination_matches_brute_force(spark, odd, bound, monkeypatch):
    """Both with a broadcast prefix table and with one beyond the bound."""
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", bound)
    found = decontaminate.contamination(*frames(spark, odd))
    assert normal(rows_of(found)) == normal(by_hand(*odd))
    assert any(r[2] for r in rows_of(found))


def test_empty_tables(spark, odd):
    docs, items = frames(spark, odd)
    assert decontaminate.contamination(docs.where("false"), items).count() == 0
    none = decontaminate.contamination(docs, items.where("false"))
    assert none.count() == docs.count() and none.where("n_hit > 0 OR size(items) > 0").count() == 0
    assert none.agg(F.sum("n_words")).first()[0] == sum(len(words(t)) for _, t in odd[0])


def test_prefix_is_the_rarest_token(spark):
    """A window is looked for only where its rarest shingle stands."""
    docs = spark.createDataFrame([(1, "a b c d e " * 50 + "a b c z e")], "doc_id bigint, text string")
    items = spark.createDataFrame([("1", "a b c z e")], "item_id string, text string")
    tokens = decontaminate.window_tokens(decontaminate.item_windows(items).select("window", "size"))
    assert tokens.count() == 3 and tokens.select("token").distinct().count() == 3
    found = rows_of(decontaminate.contamination(docs, items))
    assert found == [(1, 255, 5, ["1"])]


def test_no_python_in_the_plans(spark):
    found = QUERIES["op13_decontamination"](spark, "/root/testdata/sf0.001")
    assert not re.search("Python|Pandas|Arrow|InMemoryTableScan", found._jdf.queryExecution().executedPlan().toString())
    row = found.where("n_items = 0").first()
    assert row["items_sha256"] == hashlib.sha256(b"").hexdigest() and row["contaminated"] is False
