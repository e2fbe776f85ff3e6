"""Text operators against brute force, and the defined odd cases."""

import hashlib
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from merch.llm import chat, common, licenses, mixing, packing, quality, simhash, toxicity
from merch.llm.queries import QUERIES, table, vocabulary

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, copies int, sequence_id bigint, labels string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empties, blanks, repeated rows, equal texts, a very long text, clashing extra columns."""
    base = "the quick brown fox jumps over the lazy dog and goes home again"
    rows = [
        (1, base, "en", "a"), (1, base, "en", "a"), (2, base, "en", None), (3, None, None, "b"), (4, "", "en", "a"), (5, " \t\n ", "fr", "c"),
        (None, base + " now", "en", "a"), (6, "one", "en", "b"), (7, "mot été 日本 \U0001F600 " * 20_000, "fr", "c"), (8, "Released under the MIT License.", "en", "b"),
    ]
    return spark.createDataFrame([(*r, 0, 0.5, 1, 2, "x") for r in rows], COLUMNS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def fingerprint(text):
    own = words((text or "").translate(LOWER))
    if not own:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(own[i : i + 4]).encode(), 42) for i in range(max(1, len(own) - 3))]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def least_ids(ids, values, radius):
    """Smallest id reachable by links of at most ``radius`` bits."""
    groups = list(range(len(ids)))
    for i in range(len(ids)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius and groups[i] != groups[j]:
                old, new = groups[i], groups[j]
                groups = [new if g == old else g for g in groups]
    known = lambda g: [x for x, h in zip(ids, groups) if h == g and x is not None]
    return [min(known(g), default=None) for g in groups]


def test_simhash_components(spark):
    docs = table(spark, SF, "documents").toPandas().sort_values("doc_id")
    got = QUERIES["op6_simhash_bk_tree"](spark, SF).toPandas().sort_values("doc_id")
    values = [fingerprint(t) for t in docs["text"]]
    assert got["fingerprint"].tolist() == [f"{v:016x}" for v in values]
    assert got["component_id"].tolist() == least_ids(docs["doc_id"].tolist(), values, 4)


def test_simhash_odd_cases(odd, empty):
    got = simhash.near_copies(odd).toPandas()
    assert len(got) == 10 and simhash.near_copies(empty).count() == 0
    zero = got[got["fp"] == 0]
    assert set(zero["doc_id"]) == {3, 4, 5} and set(zero["component_id"]) == {3} and zero["kept"].sum() == 1
    same = got[got["doc_id"].isin([1, 2])]
    assert set(same["component_id"]) == {1} and same["kept"].sum() == 1


def test_large_shards_are_cut_without_losing_links(spark):
    rng = np.random.default_rng(3)
    values = [int(v) for v in rng.integers(0, 1 << 62, 40)]
    near = sorted({v ^ (1 << int(a)) ^ (1 << int(b)) for v in values for a, b in rng.integers(0, 62, (8, 2))} | set(values))
    frame = spark.createDataFrame([(v,) for v in near], "fp bigint")
    for size in (3, 20_000):
        links = [tuple(r) for r in simhash.near_links(frame, shard_size=size).collect()]
        at = {v: i for i, v in enumerate(near)}
        group = list(range(len(near)))
        for a, b in links:
            assert (a ^ b).bit_count() <= 4
            old, new = group[at[a]], group[at[b]]
            group = [new if g == old else g for g in group]
        want = least_ids(near, near, 4)
        assert [min(v for v, h in zip(near, group) if h == g) for g in group] == want


def test_license_places(spark):
    got = QUERIES["op4_license_scan"](spark, SF).toPandas().set_index("doc_id")
    for doc, text in table(spark, SF, "documents").select("doc_id", "text").collect():
        own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        places = [(i, label) for phrase, label in licenses.BASE.items() for i in range(len(own)) if own[i : i + len(phrase.split())] == phrase.split()]
        row = got.loc[doc]
        assert (row["n_words"], row["n_base"]) == (len(own), len(places))
        assert row["base_labels"] == ",".join(sorted({label for _, label in places}))
        assert not places or (row["first_word"], row["last_word"]) == (min(places)[0], max(places)[0])


@pytest.mark.parametrize(
    ("text", "labels", "kind"),
    [
        ("SPDX-License-Identifier: MIT OR GPL-2.0+", ["gpl", "mit"], "permissive"),
        ("x SPDX-License-Identifier: (MIT AND GPL-2.0-only WITH Classpath-exception-2.0) trailing prose", ["gpl", "mit"], "copyleft"),
        ("SPDX-License-Identifier: )MIT(", [], None),
        ("SPDX-License-Identifier: MIT OR", ["mit"], "permissive"),
    ],
)
def test_expressions(text, labels, kind):
    n, hits, found, (expression, obligations), score = licenses.scan_text(text, licenses.automaton(licenses.all_phrases()))
    assert [label for label in found if label in ("mit", "gpl")] == labels and obligations == kind
    assert 0 <= score <= 1 and (expression is not None) == bool(labels)


@pytest.mark.parametrize("form", ["{}", "({})"])
def test_long_expressions_are_read_whole(form):
    text = "x SPDX-License-Identifier: " + form.format(" OR ".join(["MIT"] * 2000 + ["GPL-2.0"])) + "\nOR Apache-2.0"
    found, (expression, obligations) = licenses.scan_text(text, licenses.automaton(licenses.all_phrases()))[2:4]
    assert [label for label in found if label in ("mit", "gpl", "apache")] == ["gpl", "mit"]
    assert expression.count("mit") == 2000 and expression.count("gpl-2.0") == 1 and obligations == "permissive"


def test_license_odd_cases(odd, empty):
    got = licenses.scan_licenses(odd).select("doc_id", "n_words", "labels", "score", "lang").collect()
    assert {r["doc_id"]: r["labels"] for r in got}[8] == ["mit", "notice"]
    assert {r["n_words"] for r in got if r["doc_id"] in (3, 4, 5)} == {0}
    assert licenses.scan_licenses(empty).count() == 0


def test_mixing_targets(spark):
    docs = table(spark, SF, "documents").toPandas()
    got = QUERIES["op5_pareto_mixing"](spark, SF).toPandas().set_index("doc_id").loc[docs["doc_id"]]
    size = docs["text"].map(lambda t: len(words(t))).to_numpy()
    assert got["size"].tolist() == size.tolist()
    per = {s: int(size[docs["source"] == s].sum()) for s in sorted(docs["source"].unique())}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(per)}
    free, rate = set(per), 0.0
    while True:
        rate = (1.5 * sum(per.values()) - sum(2 * per[s] for s in per if s not in free)) / sum(weight[s] for s in free)
        capped = {s for s in free if rate * weight[s] > 2 * per[s]}
        if not capped:
            break
        free -= capped
    for s in per:
        want, some = (rate * weight[s] if s in free else 2 * per[s]), got[(docs["source"] == s).to_numpy()]
        assert np.allclose(some["target"], want) and (some["source_size"] == per[s]).all()
        assert want - size[docs["source"] == s].max() <= some["taken"].sum() <= want + 1e-6
    assert (got["taken"] <= 2 * got["size"]).all()
    again = QUERIES["op5_pareto_mixing"](spark, SF).toPandas().set_index("doc_id").loc[docs["doc_id"]]
    assert again["taken"].tolist() == got["taken"].tolist()


def test_mixing_passes_over_documents_that_do_not_fit(spark):
    rng = np.random.default_rng(6)
    lengths = {s: [int(n) for n in np.exp(rng.normal(5, 1, 200)) + 1] + [40_000] for s in "abcdef"}
    rows = [(f"{s}{i}", "w " * n, s) for s, ns in lengths.items() for i, n in enumerate(ns)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, source string")
    got = mixing.mix(docs, weights=(1.0,), epochs=1.3).toPandas()
    for _, g in got.groupby("source"):
        taken, target = (g["size"] * g["copies"]).sum(), g["target"].iloc[0]
        assert 0.995 * target <= taken <= target
        most = g.groupby(np.log2(g["size"]).astype(int))["copies"].transform("max")  # in a length class all or one copy less
        assert target - taken < g["size"][g["copies"] < most].min()


def test_mixing_odd_cases(odd, empty):
    got = mixing.mix(odd).collect()
    assert len(got) == 10 and all(r["copies"] == 0 for r in got if r["size"] == 0)
    assert {r["source"] for r in got} == {"a", "b", "c", None}
    assert mixing.mix(empty).count() == 0


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(vocabulary())
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, SF, "documents").collect()}
    got = QUERIES["op3_best_fit_packing"](spark, SF).toPandas()
    want = {}
    for doc, text in texts.items():
        ids = model.encode(text, add_special_tokens=False).ids + [1]
        for at in range(0, len(ids), 4096):
            piece = np.array(ids[at : at + 4096], "<u4")
            want[doc, at // 4096] = (at, len(piece), zlib.crc32(piece.tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got.itertuples()} == want
    rows = got.sort_values(["sequence_id", "offset"])
    assert (rows.groupby("sequence_id")["length"].cumsum() - rows["length"] == rows["offset"]).all()
    assert rows.groupby("sequence_id")["length"].sum().max() <= 4096


def test_packing_odd_cases(odd, empty):
    got = packing.packed_sequences(odd, vocabulary()).toPandas()
    assert got["doc_id"].nunique() == 8 and (got["length"] == got["ids"].map(len)).all()
    assert got[got["doc_id"].isin([3, 4, 5])]["length"].tolist() == [1, 1, 1]
    assert packing.packed_sequences(empty, vocabulary()).count() == 0


def test_packing_exchanges_until_one_partition(spark):
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 60, 3000).tolist()
    frame = spark.createDataFrame([(0, i, 0, int(s)) for i, s in enumerate(sizes)], "_key_file bigint, _key_row bigint, piece int, length bigint")
    got = packing.pack(frame, capacity=100, per_partition=200).toPandas()
    assert len(got) == 3000 and got.groupby("sequence_id")["length"].sum().max() <= 100
    assert got["sequence_id"].nunique() <= packing.lower_bound(np.array(sizes), 100) + 1


def test_bounds_hold():
    assert packing.lower_bound(np.array([60, 60, 60]), 100) == 3
    assert packing.lower_bound(np.array([34, 34, 34, 34]), 100) == 2
    for seed in range(20):
        sizes = np.random.default_rng(seed).integers(1, 101, 40)
        bins, offsets, room = packing.best_fit_decreasing(sizes, 100)
        assert packing.lower_bound(sizes, 100) <= len(room) and (np.bincount(bins, sizes) <= 100).all()


def test_words_tokenize_like_texts():
    from tokenizers import Tokenizer

    model, coder = Tokenizer.from_file(vocabulary()), packing.WordTokenizer(vocabulary())
    texts = ["Don't stop!! É.g., <|ENDOFTEXT|> <|endoftext|>x \x01 a\x01b", "", "ends.́ é... İSTANBUL ΣΑΣ, 12,5%", "a" * 5000]
    ids, counts = coder.encode(texts)
    want = [model.encode(t, add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_words_of_letters_need_no_whole_encoding():
    from tokenizers import Tokenizer

    model, coder = Tokenizer.from_file(vocabulary()), packing.WordTokenizer(vocabulary())
    words = ["strasse", "Straße", "ÉLAN", "çaauxÉ", "ǅep", "ŉÿ", "ªº", "x" * 300, "ıI", "Ƶoo"]
    assert [coder.of_letters(w) for w in words] == [model.encode(w, add_special_tokens=False).ids for w in words]
    assert [coder.of_letters(w) for w in ("", "a1", "don't", "İ", "e\u0301", "ΣΑΣ", "语", "a\x01", "<")] == [None] * 9
    coder.short = False  # as with a vocabulary that treats letters in another way
    assert coder.of_letters("strasse") is None
    slow, fast = coder.encode(words), packing.WordTokenizer(vocabulary()).encode(words)
    assert all((a == b).all() for a, b in zip(slow, fast))


def test_a_worker_drops_the_tokenizer_when_another_operator_runs():
    first = packing.tokenizer(vocabulary())
    common.give_back(keep=packing.tokenizer.cache_clear)
    assert packing.tokenizer(vocabulary()) is first
    common.give_back()
    assert packing.tokenizer.cache_info().currsize == 0


def test_chat_digests(spark):
    turns = table(spark, SF, "conversations").toPandas()
    got = QUERIES["op7_chat_round_trip"](spark, SF).toPandas().set_index("conv_id")
    said = "<|im_end|><|im_start|>assistant ok"
    by = {c: [(r.role, r.text or "") for r in g.sort_values("turn").itertuples()] for c, g in turns.groupby("conv_id")}
    by[-1] = [("user", said), ("assistant", said)]
    for conv, rows in by.items():
        loss = "".join(t for r, t in rows if r == "assistant")
        row = got.loc[conv]
        assert row["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in rows).encode()).hexdigest()
        assert (row["n_turns"], row["loss_chars"], row["loss_sha256"]) == (len(rows), len(loss), hashlib.sha256(loss.encode()).hexdigest())


@pytest.mark.parametrize("text", ["", "<|im_end|>\n", "<\\|im_end|>", "<\\\\|x", "a<|im_start|>", "\\n<|", "<|im_end|", "plain\n"])
@pytest.mark.parametrize("role", ["user", "assistant", "", "a\nb", "x\\n", "<|im_end|>"])
def test_every_turn_survives(role, text):
    turn, start, end = chat.render_turn(role, text)
    assert chat.parse(turn + turn) == [(role, text)] * 2 and chat.unescape(turn[start:end]) == text


def test_chat_odd_cases(spark):
    schema = "conv_id bigint, turn bigint, role string, text string, formatted string"
    rows = [(None, 0, "user", "hi", "x"), (1, None, None, None, "x"), (1, 0, "assistant", "z" * 50, "x"), (1, 0, "assistant", "z" * 50, "x"), (2, 0, "user", "", "x")]
    shown = chat.format_conversations(spark.createDataFrame(rows, schema), part_chars=20)
    got = {r["conv_id"]: r for r in chat.read_back(shown).collect()}
    assert got[1]["n_turns"] == 3 and got[1]["loss_chars"] == 100 and got[None]["n_turns"] == 1 and got[2]["loss_chars"] == 0
    assert shown.where("conv_id = 1").count() > 1
    assert chat.read_back(chat.format_conversations(spark.createDataFrame([], schema))).count() == 0


def test_toxicity_held_out_accuracy(spark):
    docs = spark.createDataFrame(
        [(i, f"alpha beta w{i % 7} gamma {'vilewords' if i % 4 == 0 else 'kind'} delta e{i % 11}", "en", 1) for i in range(240)], "doc_id bigint, text string, lang string, score int"
    )
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(160)] + [(None, 1, 1), (5, None, None)], "doc_id bigint, quality int, toxic int")
    got = toxicity.score_texts(docs, toxicity.train(docs, labels)).where("doc_id >= 160").toPandas()
    assert ((got["score"] >= 0.3) == (got["doc_id"] % 4 == 0)).all() and got["score"].between(0, 1).all()
    assert (got["toxic_flag"] == (got["doc_id"] % 4 == 0)).all()


def plain_responses(net, texts):
    """Largest response of every filter by a plain convolution in double precision."""
    out = []
    for text in texts:
        words = [np.mean([net.p["E"][b].astype(float) for b in toxicity.word_buckets(w)], axis=0) for w in toxicity.words_of(text)]
        row = []
        for w in toxicity.WIDTHS:
            places = range(max(len(words) - w + 1, 1))
            sums = [sum(words[i + k] @ net.p[f"W{w}"][k].astype(float) for k in range(w) if i + k < len(words)) for i in places]
            row += list(np.max(sums, axis=0) + net.p[f"b{w}"].astype(float))
        out.append(row)
    return np.array(out)


def plain_loss(net, texts, labels, weights):
    z = np.maximum(plain_responses(net, texts), 0) @ net.p["out"].astype(float) + float(net.p["bias"][0])
    loss = (np.logaddexp(0, z) - labels * z) @ weights / weights.sum() + 0.5e-4 * (net.p["out"].astype(float) ** 2).sum()
    return loss + sum(0.5e-5 * (net.p[f"W{w}"].astype(float) ** 2).sum() for w in toxicity.WIDTHS)


def test_toxicity_network_is_a_convolution(monkeypatch):
    """Responses, also over slices, against a plain convolution; gradients against differences of the plain loss."""
    texts = ["vile words here and there", "kind", "", None, "a b a b c", "one two three four five six seven eight nine ten", "これは長い文です ok", "x " * 40]
    labels, weights = np.array([1, 0, 0, 1, 1, 0, 1, 0.0]), np.array([1, 2, 1, 0.5, 1, 1, 1, 1.0])
    net = toxicity.Network(3)
    net.fixed = np.zeros(toxicity.BUCKETS, dtype=bool)
    net.p = {k: (v * 3).astype(np.float32) for k, v in net.p.items()}
    want = plain_responses(net, texts)
    assert np.allclose(net.responses(*toxicity.encode(texts))[0], want, atol=1e-5)
    monkeypatch.setattr(toxicity, "SLICE", 3)
    assert np.allclose(net.responses(*toxicity.encode(texts))[0], want, atol=1e-5)
    grad, rows, ge = net.gradient(texts, labels, weights)
    grad["E"] = np.zeros_like(net.p["E"])
    grad["E"][rows] = ge
    net.p = {k: v.astype(float) for k, v in net.p.items()}
    rng = np.random.default_rng(0)
    for name, g in grad.items():
        spots = np.argwhere(np.abs(g) > 1e-3)
        assert len(spots) or name == "bias"
        for at in map(tuple, spots[rng.permutation(len(spots))[:12]]):
            held, sides = net.p[name][at], []
            for step in (1e-6, -1e-6):
                net.p[name][at] = held + step
                sides.append(plain_loss(net, texts, labels, weights))
            net.p[name][at] = held
            assert abs((sides[0] - sides[1]) / 2e-6 - g[at]) < 1e-3 * max(1, abs(g[at])), (name, at)


def test_toxicity_sample_is_bounded_and_repeatable(spark):
    rows = [(i % 40, f"text {i} " * (1 + i % 3), "en") for i in range(400)] + [(40, "long " * 200, "en"), (41, "short", None), (41, None, "de")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(42)] + [(0, 1), (None, 1), (1, None)], "doc_id bigint, toxic int")
    frames = [spark.createDataFrame(some, "doc_id bigint, text string, lang string") for some in (rows, rows[::-1])]
    got = [sorted(map(tuple, toxicity.sampled(f, labels, 15, 64 * 60).collect()), key=str) for f in frames]
    assert got[0] == got[1] and len({r[0] for r in got[0]}) == len(got[0])
    by = [[r for r in got[0] if r[1] == v] for v in (0, 1)]
    assert all(0 < len(some) <= 15 for some in by) and all(r[0] != 40 for r in got[0])
    assert all(r[1] == 1 for r in got[0] if r[0] == 0)
    few = toxicity.sampled(frames[0], labels, 15, 64 * 3).collect()
    assert all(sum(len((r["text"] or "").encode()) for r in few if r["toxic"] == v) <= 64 * 3 for v in (0, 1))


def test_toxicity_learns_from_all_labelled_texts(spark):
    """Rare vile words that only later shards hold are learned; every labelled text is used, a very long one too."""
    vile = lambda i: f"vile{'abcdefgh'[i // 75]}word"
    docs = [(i, f"alpha w{i % 7} beta {vile(i) if i % 3 == 0 else 'kind'} gamma e{i % 11}", "en") for i in range(600)]
    long = [(1000, "long " * 300_000, "en")]
    frame = spark.createDataFrame(docs + long, "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(600)] + [(1000, 0)], "doc_id bigint, toxic int")
    assert toxicity.sampled(frame, labels).count() == 601
    model = toxicity.train(frame, labels, shard_texts=100)
    got = toxicity.score_texts(frame, model).toPandas()
    want = (got["doc_id"] % 3 == 0) & (got["doc_id"] < 600)
    assert ((got["score"] >= 0.3) == want).mean() > 0.99 and (got["toxic_flag"] == want).mean() > 0.99
    assert bytes(toxicity.train(frame, labels, shard_texts=100).first()["weights"]) == bytes(model.first()["weights"])


def test_toxicity_thresholds_count_every_score(spark):
    rng = np.random.default_rng(2)
    rows = [("ab"[i % 2], float(s), int(rng.random() < s)) for i, s in enumerate(rng.integers(0, 60, 3000) / 60)] + [("c", 0.5, 1)]
    got = {r["lang"]: r["threshold"] for r in toxicity.best_thresholds(spark.createDataFrame(rows, "lang string, score double, toxic int"), ["lang"]).collect()}
    for lang in "ab":
        mine = [(s, y) for g, s, y in rows if g == lang]
        cuts = sorted({s for s, _ in mine}, reverse=True)
        f1 = [2 * sum(y for s, y in mine if s >= c) / (sum(s >= c for s, _ in mine) + sum(y for _, y in mine)) for c in cuts]
        at = f1.index(max(f1))
        assert got[lang] == (cuts[at] + (cuts[at + 1] if at + 1 < len(cuts) else 0.0)) / 2
    assert "c" not in got


def test_toxicity_reads_the_middle_of_unspaced_writing(spark):
    assert toxicity.words_of("ab これ-c ไท") == [w.encode() for w in ("ab", "こ", "れ", "-c", "ไ", "ท")]
    kind, vile = "今日は天気がとても{}良いと思います明日", "今日は天気がとても{}悪いと思います明日"
    docs = [(i, (vile if i % 3 == 0 else kind).format("一二三四五六七"[i % 7])) for i in range(180)]
    frame = spark.createDataFrame([(*d, "ja") for d in docs], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(120)], "doc_id bigint, toxic int")
    got = toxicity.score_texts(frame, toxicity.train(frame, labels)).where("doc_id >= 120").toPandas()
    assert ((got["score"] >= 0.3) == (got["doc_id"] % 3 == 0)).all()


def test_toxicity_odd_cases(spark, odd, empty):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    got = toxicity.score_texts(odd, toxicity.train(odd, none)).toPandas()
    assert len(got) == 10 and (got["score"] == 0).all()
    some = spark.createDataFrame([(1, 1, 1), (6, 1, 0)], "doc_id bigint, quality int, toxic int")
    model = toxicity.train(odd, some)
    assert toxicity.score_texts(odd, model).toPandas()["score"].between(0, 1).all()
    assert toxicity.score_texts(empty, model).count() == 0


def kneser_ney(texts, asked, order=4):
    """Plain interpolated modified Kneser-Ney over symbol tuples; p of each asked n-gram."""
    pads = lambda t: [1] * (order - 1) + quality.symbols(t).tolist() + [2]
    counts = [{} for _ in range(order + 1)]
    for row in map(pads, texts):
        for i in range(len(row) - order + 1):
            gram = tuple(row[i : i + order])
            counts[order][gram] = counts[order].get(gram, 0) + 1
    for k in range(order - 1, 0, -1):
        for gram in counts[k + 1]:
            counts[k][gram[1:]] = counts[k].get(gram[1:], 0) + 1
    cuts = []
    for k in range(order + 1):
        n = [sum(c == j for c in counts[k].values()) for j in range(5)]
        if all(n[1:]):
            y = n[1] / (n[1] + 2 * n[2])
            cuts.append([0, *(min(max(j - (j + 1) * y * n[j + 1] / n[j], 0.05), j - 0.05) for j in (1, 2, 3))])
        else:
            cuts.append([0, 0.5, 1.0, 1.5])

    def p(gram):
        k = len(gram)
        below = p(gram[1:]) if k > 1 else 1 / 4096
        after = [c for g, c in counts[k].items() if g[:-1] == gram[:-1]]
        if not after:
            return below
        cut = lambda c: cuts[k][min(c, 3)]
        own = counts[k].get(gram, 0)
        return (own - cut(own) + sum(map(cut, after)) * below) / sum(after)

    return [p(g) for g in asked]


def test_quality_model_is_modified_kneser_ney(spark):
    texts = ["the cat sat on the mat", "a cat and the rat", "the hat of the cat", "été"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, "zzz the cat!"])], "doc_id bigint, text string")
    trusted = spark.createDataFrame([(i,) for i in range(4)], "doc_id bigint")
    counts = quality.count_ngrams(docs, trusted)
    got = {r["code"]: r["p"] for r in quality.probabilities(counts).collect()}
    codes = sorted(got)
    grams = [tuple(c >> 12 * (3 - k) & 4095 for k in range(4)) for c in codes]
    assert np.allclose([got[c] for c in codes], kneser_ney(texts, grams))


def test_quality_rejects_junk(spark):
    got = QUERIES["op9_kneser_ney_quality"](spark, "/root/testdata/sf0.01").toPandas()
    labels = table(spark, "/root/testdata/sf0.01", "labels").toPandas()
    known = got.merge(labels, on="doc_id")
    assert len(got) == 1000 and known[known["quality"] == 1]["keep"].mean() > 0.98 and known[known["quality"] == 0]["keep"].mean() < 0.4


def test_quality_threshold_is_the_quantile(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    got = quality.judge(docs, labels, quantile=0.9, least=1).join(quality.trusted_ids(labels).where("judging"), "doc_id").toPandas()
    assert len(got)
    for _, g in got.groupby("lang"):
        want = sorted(g["perplexity"])[int(np.ceil(0.9 * len(g))) - 1]
        assert np.allclose(g["threshold"], want)


def test_quality_odd_cases(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, 0, 0), (None, 1, 0), (6, None, 0)], "doc_id bigint, quality int, toxic int")
    got = quality.judge(odd, labels).toPandas()
    assert len(got) == 10 and np.isfinite(got["perplexity"]).all()
    assert quality.judge(odd, labels.where("false")).where("NOT keep").count() == 0
    assert quality.judge(empty, labels).count() == 0


@pytest.mark.parametrize(
    "expression, kind, labels",
    [
        ("EUPL-1.2", "copyleft", {"eupl"}), ("OSL-3.0", "copyleft", {"osl"}), ("CC-BY-SA-4.0", "share-alike", {"cc-by-sa"}), ("CC-BY-NC-4.0", "non-commercial", {"cc-by-nc"}),
        ("CC-BY-NC-SA-4.0", "non-commercial", {"cc-by-nc-sa"}), ("CC-BY-4.0", "permissive", {"cc-by"}), ("CC-BY-ND-3.0", "no derivatives", {"cc-by-nd"}), ("LGPL-2.1+", "weak copyleft", {"lgpl"}),
        ("MITRE-1.0", "unknown", {"mitre-1.0"}), ("MIT AND Foo-1", "unknown", {"mit", "foo-1"}), ("MIT OR Foo-1", "permissive", {"mit", "foo-1"}), ("MPL-2.0 AND (MIT OR GPL-3.0-only)", "weak copyleft", {"mpl", "mit", "gpl"}),
        ("CC0-1.0 OR CC-BY-SA-4.0 AND MIT", "public-domain", {"cc0", "cc-by-sa", "mit"}), ("GPL-2.0 WITH Classpath-exception-2.0", "copyleft", {"gpl"}),
    ],
)
def test_obligations_follow_the_family(expression, kind, labels):
    machine = licenses.automaton(licenses.all_phrases())
    _, _, found, (_, obligations), _ = licenses.scan_text(f"SPDX-License-Identifier: {expression}\nText.", machine)
    assert obligations == kind and labels <= set(found)


def test_scan_keeps_columns_and_takes_phrases(spark):
    rows = spark.createDataFrame([("house rules apply here. MIT License", 7, "x")], "text string, _scan int, _SCAN2 string")
    row = licenses.scan_licenses(rows, notices={"house rules": ("house", 0.4)}).first()
    assert row["_scan"] == 7 and row["_SCAN2"] == "x"
    assert [h["label"] for h in row["hits"]] == ["house", "mit"] and row["labels"] == ["house", "mit"]
