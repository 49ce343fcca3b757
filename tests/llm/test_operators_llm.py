"""The training-data operators against brute force, on small fixtures with odd rows."""

import base64
import functools
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cardflow.llm import (chat, components, embeddings, ngram_join, packing, pii, quality_model, quality_rules, queries,
                          sharding, token_codes, unigram)
from cardflow.llm.components import connected_components
from cardflow.llm.common import ship_code
from cardflow.llm.tokens import ChunkEncoder

BPE = P.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, node long, shard string, n long"


def odd_documents():
    """Null ids and texts, empty and very long texts, ties, repeated rows, clashing column names."""
    rng = random.Random(5)
    words = ["alpha", "beta", "gam", "dé", "x1", "to", "of", "it"]
    rows = [(1, None), (2, ""), (3, " \n\t"), (None, "a b c d"), (4, "one"), (5, "two words"), (6, "w " * 40_000)]
    rows += [(k, " ".join(rng.choice(words) + str(rng.randrange(40)) for _ in range(rng.choice([3, 30, 90])))) for k in range(10, 60)]
    rows += [(k + 100, t + (" extra" if k % 2 else "")) for k, t in rows[7:40]]
    return rows + rows[7:12]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(k, t, 1, "x", 2) for k, t in odd_documents()], SCHEMA)


@functools.cache
def reference_tokenizer():
    t = Tokenizer.from_file(BPE)
    t.encode_special_tokens = True
    return t


def reference_ids(text):
    return reference_tokenizer().encode(text or "", add_special_tokens=False).ids


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    values = [int(c) for c in reversed(digits)]
    return sum(v if i % 2 == 0 else v * 2 - (9 if v > 4 else 0) for i, v in enumerate(values)) % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                    "card": lambda: 13 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 9 <= len(digits) <= 15}[kind]()
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def test_pii_base_spans_and_redaction(spark):
    rng = random.Random(5)
    parts = ["a@b.c", "x_y@e.f", "@", "1.2.3.4", "999.1.2.3.4", "4111111111111111", "4111 1111 1111 1111", " ", "é", "\n",
             "+1 (269) 555-3296", "+", "-", ".", "12", "00.01.255.256", "a@b", ".com", "5500-0000-0000-0004", "((", "+49 170"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 30))) for _ in range(600)] + [None, "", "1 " * 9000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = pii.with_spans(df, pii.fit(df)).select("text", pii.joined(F.col("__pii.base")).alias("base"),
                                                    pii.joined(F.col("__pii.all")).alias("all"),
                                                    pii.redacted(F.col("text"), F.col("__pii.all")).alias("clean")).collect()
    for r in found:
        assert r["base"] == base_spans(r["text"])
        assert not r["base"] or set(r["base"].split(",")) <= set(r["all"].split(","))
        assert r["all"] or r["clean"] == r["text"]
    one = spark.createDataFrame([("mail a@b.co or +1 (269) 555-3296 4111111111111111 now",)], "text string")
    row = pii.with_spans(one, pii.fit(df)).select(pii.redacted(F.col("text"), F.col("__pii.all")).alias("c")).first()
    assert row["c"].startswith("mail [EMAIL] or ")


def test_pii_query_counts_base_spans_by_kind(spark, tmp_path):
    texts = ["1.2.3.4", "a@b.co c@d.ef", "4111 1111 1111 1111 é", "+49 170 555 1234", "1.2.3.4 a@b.co 4111111111111111, +49 170 555 1234",
             "1.1.1.1 2.2.2.2 3.3.3.3 +1 (269) 555-3296", "none", "", None]
    rows = [*enumerate(texts), (0, texts[0]), (None, "x@y.z 1.2.3.4 1.2.3.5")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op1_pii(spark, str(tmp_path)).collect()
    expected = []
    for key, text in rows:
        spans = base_spans(text)
        kinds = [s.split(":")[0] for s in spans.split(",")]
        expected.append((key, *map(kinds.count, BASE), hashlib.sha256(spans.encode()).hexdigest()))
    got = [(r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in found]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_pii_card_between_other_numbers(spark):
    card = "4111 1111 1111 1111"
    texts = {f"order 2024 {card}": "order 2024 [CARD]", f"+1 (826) 555-4081 {card}": "[PHONE] [CARD]",
             f"é {card} 5500 0000 0000 0004 2024 x": "é [CARD] [CARD] 2024 x", f"2024 {card} +1 (826) 555-4081 {card}.": "2024 [CARD] [PHONE] [CARD].",
             "2024 2025 2026 2027 2028": "2024 2025 2026 2027 2028"}
    plain = [("mail a@b.co",), ("pay 5500 0000 0000 0004",), ("call +49 170 555 1234",), (None,)]
    mixed = [(t,) for t in texts] + [(f"{k} 2024 {card} and 1.2.3.{k}",) for k in range(40)]
    for rows in (plain, plain + mixed, [("nothing",)]):  # no candidate outside base spans; some; none at all
        model = pii.fit(spark.createDataFrame(rows, "text string"))
        df = spark.createDataFrame([(t,) for t in texts], "text string")
        got = {r["text"]: r["c"] for r in pii.with_spans(df, model).select(
            "text", pii.redacted(F.col("text"), F.col("__pii.all")).alias("c")).collect()}
        assert got == texts


def with_check_digit(digits):
    return next(digits + d for d in "0123456789" if luhn(digits + d))


def test_pii_model_rejects_valid_looking_numbers(spark):
    """Numbers that pass Luhn by chance, or that a word names as another sort: precision rises, no card is lost."""
    rng = random.Random(11)
    number = lambda first, n: first + "".join(rng.choice("0123456789") for _ in range(n - len(first)))
    # the number in front makes the base run too long: all candidates lie outside base spans
    cards = [f"pay {number('12', 6)} {with_check_digit(number('4', 15))} now" for _ in range(300)]
    random_keys = [f"key {number('12', 6)} {number('9', 16)} now" for _ in range(1500)]  # a tenth pass Luhn
    orders = [f"order no. {with_check_digit(number('4', 15))} {number('12', 6)} now" for _ in range(300)]
    training = [(t,) for t in cards + random_keys + orders]
    model = pii.fit(spark.createDataFrame(training, "text string"))
    free = pii.Boosted(0.0, (), (float("-inf"),) * 4)  # the validator alone

    def kept(texts, with_model):
        df = spark.createDataFrame([(t,) for t in texts], "text string")
        added = F.array_except("__pii.all", "__pii.base")
        return pii.with_spans(df, with_model).filter(F.exists(added, lambda s: s["kind"] == 2)).count()

    fresh_cards = [f"pay {number('12', 6)} {with_check_digit(number('4', 15))} now" for _ in range(100)]
    fresh_keys = [f"key {number('12', 6)} {with_check_digit(number('9', 15))} now" for _ in range(100)]
    assert kept(fresh_cards, free) == kept(fresh_keys, free) == 100
    assert kept(fresh_cards, model) == 100 and kept(fresh_keys, model) == 0
    assert kept(orders, free) == 300 and kept(orders, model) == 0
    # as many candidates pass without a card among them: nothing is personal
    keys_only = pii.fit(spark.createDataFrame([(t,) for t in random_keys], "text string"))
    assert kept(fresh_keys, keys_only) == 0


def test_pii_threshold_takes_the_greatest_gain():
    score, gain = np.array([3.0, 2.0, 1.0, 0.0]), np.array([5.0, -1.0, 2.0, -4.0])
    assert 0 < pii._threshold(score, gain) < 1.0
    assert pii._threshold(score, -np.abs(gain)) == float("inf")
    assert pii._threshold(np.array([1.0, 1.0]), np.array([1.0, -1.0])) < 1.0


def test_sharding_table_turns_and_stability(spark, docs):
    names = [f"s{k}" for k in range(10)]
    table = sharding.lookup_table(names, 1009)
    counts = [table.count(n) for n in names]
    assert max(counts) - min(counts) <= 1
    fewer = sharding.lookup_table(names[:-1], 1009)
    assert sum(a != b for a, b in zip(table, fewer) if a != "s9") < 0.2 * 1009
    placed = sharding.place(docs, "doc_id", names, spread=("text",), slots=1009, name="own").collect()
    assert len(placed) == docs.count()
    for r in placed:
        if r["doc_id"] is not None:
            slot = int(hashlib.md5(str(r["doc_id"]).encode()).hexdigest()[:15], 16) % 1009
            assert (r["slot"], r["own"]) == (slot, table[slot])
    assert sharding.place(docs.limit(0), "doc_id", names, slots=1009).count() == 0


def test_closest_fill_is_optimal():
    rng = random.Random(2)
    for _ in range(60):
        counts = {rng.randrange(1, 30): rng.randrange(1, 3) for _ in range(4)}
        room = rng.randrange(1, 60)
        sums = {0}
        for k, n in counts.items():
            sums = {s + k * m for s in sums for m in range(n + 1)}
        fill = packing.closest_fill(counts, room)
        assert sum(k * m for k, m in fill.items()) == max(s for s in sums if s <= room)
        assert all(m <= counts[k] for k, m in fill.items())


def test_packing_covers_every_id_without_gaps(spark, docs):
    rows = packing.pack(docs, BPE, capacity=256).collect()
    want = {}
    for key, text in odd_documents():
        ids = np.array([*reference_ids(text), 1], "<u4")
        for at in range(0, len(ids), 256):
            want.setdefault((key, at, zlib.crc32(ids[at:at + 256].tobytes()), len(ids)), []).append(len(ids[at:at + 256]))
    got = {}
    for r in rows:
        got.setdefault((r["doc_id"], r["start"], r["ids_crc32"], r["doc_tokens"]), []).append(r["length"])
    assert got == want
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 256
    assert packing.pack(docs.limit(0), BPE).count() == 0


SCHEMAS = {"f": {"a": ("integer", True), "b": ("string", False)}}


def test_tool_calls(spark):
    call = lambda i, args, name="f": f'{{"tool_calls":[{{"id":"{i}","name":"{name}","arguments":{args}}}]}}'
    messages = [(1, 0, "assistant", call("x", '{"b":"q","a":1}')), (1, 1, "tool", '{"tool_call_id":"x","content":"r\\"1"}'),
                (1, 2, "assistant", call("y", '{"a":"${x}"}')), (1, 3, "tool", '{"tool_call_id":"zz","content":"?"}'),
                (2, 0, "assistant", call("p", '{"a":1,"b":"${q}"}')), (2, 1, "assistant", call("q", '{"a":1,"b":"${p}"}')),
                (1, 4, "assistant", call("k", "[1]")), (1, 5, "assistant", call("u", "{}", "g")), (3, 0, "user", None),
                (1, 6, "assistant", "not json tool_calls"), (None, 0, "assistant", call("n", '{"a":2}')),
                (1, 0, "assistant", call("x", '{"b":"q","a":1}'))]
    df = spark.createDataFrame(messages, "conv_id long, turn long, role string, text string")
    rows = {r["call_id"]: r for r in chat.link_calls(df, SCHEMAS).collect()}
    assert rows["x"]["status"] == "ok" and rows["x"]["level"] == 0
    assert rows["x"]["canonical"] == '{"arguments":{"a":1,"b":"q"},"id":"x","name":"f","result":"r\\"1"}'
    assert rows["y"]["status"] == "invalid" and rows["y"]["errors"] == ["type of a"] and rows["y"]["level"] == 1
    assert rows["zz"]["status"] == "orphan" and rows["p"]["status"] == rows["q"]["status"] == "cyclic"
    assert rows["k"]["errors"] == ["arguments are no object"] and rows["u"]["errors"] == ["unknown tool"]
    assert rows["n"]["status"] == "no result" and len(rows) == 8


@pytest.mark.parametrize("part, cell", [(8192, 128), (16, 4)])
def test_embedding_components(spark, monkeypatch, part, cell):
    monkeypatch.setattr(embeddings, "PART_VECTORS", part)
    monkeypatch.setattr(embeddings, "CELL_VECTORS", cell)
    rng = np.random.default_rng(3)
    base = rng.standard_normal((120, 16))
    x = np.concatenate([base, base[:40] + 0.05 * rng.standard_normal((40, 16)), base[:10]])
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    rows += [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [1.0, None]), (904, [1.0, 0.0]), (None, [1.0] * 16)]
    df = spark.createDataFrame(rows + rows[:3], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embeddings.near_duplicates(df).collect()}
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    links = unit @ unit.T >= 0.9
    np.fill_diagonal(links, False)
    label = np.arange(len(x))
    for _ in range(len(x)):
        label = np.minimum(label, np.where(links, label[None, :], 10**9).min(axis=1))
    for k in range(len(x)):
        assert got[k] == (links[k].sum(), label[k], label[k] == k)
    for k in (900, 901, 902, 903, 904):
        assert got[k] == (0, k, True)
    assert got[None] == (0, None, False)


def test_embedding_leaves_and_cells_prune(spark, monkeypatch):
    """On clustered vectors far fewer pairs are compared than there are; links and forests stay those of all pairs."""
    monkeypatch.setattr(embeddings, "PART_VECTORS", 256)
    monkeypatch.setattr(embeddings, "CELL_VECTORS", 32)
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((60, 32))
    x = np.repeat(centres, 50, axis=0) + 0.35 * rng.standard_normal((3000, 32))
    x = np.concatenate([x, x[:200] + 0.01 * rng.standard_normal((200, 32))])
    classes = spark.createDataFrame([(k, 1, v.tolist()) for k, v in enumerate(x)],
                                    "class_id long, copies long, vector array<double>")
    found = embeddings.links_between(classes, 0.95).collect()
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    links = unit @ unit.T >= 0.95
    np.fill_diagonal(links, False)
    got = np.zeros(len(x), dtype=int)
    for r in found:
        if r["u"] is not None and r["v"] is None:
            got[r["u"]] += r["links"]
        elif r["u"] is not None:
            assert links[r["u"]].any() and links[r["v"]].any()
    assert (got == links.sum(axis=1)).all() and got.sum() >= 400
    compared = sum(r["links"] for r in found if r["u"] is None)
    assert compared < 0.5 * len(x) * (len(x) - 1) / 2


def test_leaf_boxes_cover_all_space():
    rng = np.random.default_rng(6)
    points = np.concatenate([rng.standard_normal((500, 4)), np.zeros((300, 4))])
    low, high = embeddings.leaf_boxes(points, 32)
    far = embeddings._outside(rng.standard_normal((2000, 4)) * 3, low, high)
    assert len(low) > 16 and (far.min(axis=1) == 0).all()
    assert len(embeddings.leaf_boxes(points[:1], 8)[0]) == len(embeddings.leaf_boxes(np.zeros((9, 4)), 8)[0]) == 1


def test_quality_model_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    ship_code(spark)
    table = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", quality_model.features("text").alias("vector")).cache()
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = quality_model.fit(quality_model.training_rows(table, labels))
    scored = table.filter(quality_model.held_out()).join(labels, "doc_id").select(
        "quality", quality_model.score_vector(model, "vector").alias("s")).collect()
    assert np.mean([(r["s"] >= 0.7) == (r["quality"] == 1) for r in scored]) > 0.95
    assert quality_model.fit(spark.createDataFrame([], "label int, vector array<double>")) is None
    empty = spark.createDataFrame([(None,), ("",)], "text string").select(quality_model.score_text(model, "text").alias("s"))
    assert len({r["s"] for r in empty.collect()}) == 1


def brute_components(rows, width, percent):
    """({id: number of shingles}, {id: least id reachable by links}) by comparing all pairs."""
    sets = {}
    for key, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        s = {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()
        if key is not None:
            sets[key] = s
    label = {k: k for k in sets}
    while True:
        new = {a: min([label[a], *(label[b] for b in sets if sets[a] and sets[b] and 100 * len(sets[a] & sets[b])
                                   >= percent * len(sets[a] | sets[b]))]) for a in sets}
        if new == label:
            return {k: len(s) for k, s in sets.items()}, label
        label = new


@pytest.mark.parametrize("width,percent", [(3, 90), (5, 80)])
def test_jaccard_components(spark, docs, width, percent):
    sizes, label = brute_components(odd_documents(), width, percent)
    rows = ngram_join.jaccard_components(docs, width=width, percent=percent).collect()
    assert len(rows) == docs.count()
    for r in rows:
        if r["doc_id"] is not None:
            assert (r["n_shingles"], r["component_id"]) == (sizes[r["doc_id"]], label[r["doc_id"]])


@pytest.mark.parametrize("width,percent", [(3, 90), (5, 80)])
def test_jaccard_large_groups(spark, monkeypatch, width, percent):
    """Shared passages tie many documents into groups of far more than one block; edited copies with
    similarities on both sides of the limit, and repeated rows, are among them."""
    rng = random.Random(percent)
    word = lambda: f"w{rng.randrange(4000)}"
    passages = [[word() for _ in range(40)] for _ in range(4)]
    rows = []
    for k in range(40):
        text = [word() for _ in range(rng.randrange(30, 90))]
        text += rng.choice(passages) + rng.choice(passages)
        rows.append((len(rows), " ".join(text)))
        for _ in range(rng.randrange(4)):
            copy = list(text)
            for _ in range(rng.randrange(7)):
                copy[rng.randrange(len(copy))] = word()
            rows.append((len(rows), " ".join(copy[:len(copy) - rng.randrange(12)])))
    monkeypatch.setattr(ngram_join, "BLOCK_DOCS", 4)
    seen = []
    refined = ngram_join.refined
    monkeypatch.setattr(ngram_join, "refined", lambda *a: seen.append((a[0].count(), refined(*a))) or seen[-1][1])
    sizes, label = brute_components(rows, width, percent)
    docs = spark.createDataFrame([*rows, *rows[:5]], "doc_id long, text string")
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"])
             for r in ngram_join.jaccard_components(docs, width=width, percent=percent, extra=1).collect()}
    assert found == {k: (sizes[k], label[k]) for k in sizes}
    assert 0 < len(set(label.values())) < len(rows)
    assert seen[0][1].count() < seen[0][0]


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(7, 7), (None, 3), (100, 99)], "u long, v long")
    got = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    assert got == {k: 0 for k in range(41)} | {99: 99, 100: 99}


def test_components_of_few_rows_take_few_tasks(spark, monkeypatch):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(400, 420)] * 2
    label = {k: k for e in edges if e[0] != e[1] for k in e}
    while any(label[a] != label[b] for a, b in edges if a != b):
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    files = {}

    def counted(df, name):
        back = write(df, name)
        files[name] = max(files.get(name, 0), len(back.inputFiles()))
        return back

    write = components.written
    monkeypatch.setattr(components, "written", counted)
    held = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        found = connected_components(spark.createDataFrame(edges, "u long, v long"))
        got = {r["node"]: r["component"] for r in found.collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == label
    assert max(files[n] for n in ("cc-edges", "cc-labels", "cc-lower")) <= spark.sparkContext.defaultParallelism


def test_rule_statistics(spark, docs):
    ship_code(spark)
    extra = spark.createDataFrame([(7, "a b c d e f g h i " * 4 + "#x*\n\nL1\nL1\n \nL1", 1, "x", 2)], SCHEMA)
    for r in quality_rules.with_verdict(docs.union(extra)).select("text", "__rules.*").collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")
        grams = [tuple(w[k:k + 8]) for k in range(len(w) - 7)]
        many = {g for g in grams if grams.count(g) > 1} if len(grams) < 2000 else set(grams)
        covered = {k + j for k, g in enumerate(grams) if g in many for j in range(8)}
        lines = [x for x in (r["text"] or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert r["n_words"] == len(w) and r["word_chars"] == sum(map(len, w)) and r["n_repeat_words"] == len(covered)
        assert r["n_symbols"] == len(re.findall(r"[#*$%&|<>]", r["text"] or ""))
        assert r["n_dup_lines"] == len(lines) - len(set(lines))
        assert r["base_failed"] == (len(w) < 20 or 100 * len(covered) > 30 * len(w))


def test_rules_reject_one_bad_stretch(spark):
    ship_code(spark)
    rng = random.Random(11)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 9))) for _ in range(2000)]

    def clean(size):
        return " ".join(rng.choice(words) for _ in range(size // 3))[:size]

    def noise(size):
        return base64.b64encode(rng.randbytes(size)).decode()[:size]

    texts = {"clean": clean(100_000), "clean with a tail": clean(4096 + 3000), "one chunk of many": clean(60_000) + noise(4096) + clean(40_000),
             "nearly half": clean(55_000) + noise(45_000), "long": clean(700_000) + noise(20_000) + clean(300_000),
             "tail": clean(4096 * 3) + noise(3000), "one of two": clean(4096) + noise(4096)}
    df = spark.createDataFrame(list(texts.items()), "name string, text string")
    got = {r["name"]: r for r in quality_rules.with_verdict(df).select("name", "__rules.*").collect()}
    kept = {k for k, r in got.items() if r["kept"]}
    assert kept == {"clean", "clean with a tail", "one chunk of many"}, {k: (r["ratio"], r["chunks_outside"]) for k, r in got.items()}
    # the whole ratio alone would have let these through
    assert all(0.2 < got[k]["ratio"] < 0.65 and 2 * got[k]["chunks_outside"] <= got[k]["chunks"] for k in ("nearly half", "long", "tail"))


def test_chunk_encoder_equals_the_library():
    rng = random.Random(3)
    parts = ["a", " ", "  ", "\n", "\n\n", ",", ".", "é", "don", "'t", "3", ".14", "\t", "\xa0", "\x1f", "日本", "!", "\x1c", "<|endoftext|>"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 14))) for _ in range(3000)] + ["", "a" * 5000]
    for text, got in zip(texts, ChunkEncoder(BPE).encode(texts)):
        assert np.frombuffer(got, "<u4").tolist() == reference_ids(text) if len(text) < 6 else True
    t = Tokenizer.from_file(BPE)
    t.encode_special_tokens = True
    want = [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(g, "<u4").tolist() for g in ChunkEncoder(BPE).encode(texts)] == want


def test_token_codes_random_access_and_files(spark, docs, tmp_path):
    ids = np.random.default_rng(0).choice([0, 5, 255, 256, 70000, 2**31, 50000], 3000).astype(np.uint32)
    codes = token_codes.Codes(token_codes.encode_codes(ids))
    assert (codes.all() == ids).all() and [codes[k] for k in range(len(ids))] == ids.tolist()
    folder = str(tmp_path / "tokens")
    token_codes.write_tokens(docs, folder, BPE)
    got = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in token_codes.read_tokens(spark, folder).collect())
    at, last = 0, None
    for start, key, n, _ in got:
        assert start == at and (last is None or key is None or key >= last)
        at, last = at + n, key if key is not None else last
    want = sorted(zlib.crc32(np.array([*reference_ids(t), 0], "<u4").tobytes()) for _, t in odd_documents())
    assert sorted(g[3] for g in got) == want


def test_unigram_viterbi_and_round_trip(spark, docs):
    model = unigram.model(P.path("piece_bpe_32k.model"))
    keys = {model.spelled[k]: s for k, s in model.scores.items()}

    def best(text):
        data = (" " + text).encode()
        score = [0.0] + [-1e300] * len(data)
        for i in range(len(data)):
            if score[i] <= -1e299:
                continue
            span = 1 if data[i] < 0x80 else 2 if data[i] < 0xE0 else 3 if data[i] < 0xF0 else 4
            for n in range(1, model.trie.depth + 1):
                if data[i:i + n] in keys and i + n <= len(data):
                    score[i + n] = max(score[i + n], score[i] + keys[data[i:i + n]])
            if data[i:i + span] not in keys:
                score[i + span] = max(score[i + span], score[i] + model.unknown)
        return score[-1] if text else 0.0

    rng = random.Random(1)
    parts = ["a", "the", "ing", " ", "  ", "é", "日", "\n", "𝒳", "▁", "\x1f", ".", "q"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 25))) for _ in range(300)]
    for text, (ids, score) in zip(texts, model.encode(texts)):
        assert model.decode(ids) == text and abs(score - best(text)) < 1e-6
    rows = unigram.encoded(docs, P.path("piece_bpe_32k.model")).collect()
    assert len(rows) == docs.count() and all(r["round_trip"] for r in rows)


def test_unigram_of_very_long_words():
    import time

    own = unigram.model(P.path("piece_bpe_32k.model"))
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzéß漢😀▁0+/") for _ in range(rng.choice([1, 7, 200, 700]))) for _ in range(60)]
    chunks = [" " + w for w in words] + ["a" * 2000, " " * 900, "\ud800" * 600, "the" * 400]
    side_by_side = list(own._viterbi([c.encode("utf-8", "surrogatepass") for c in chunks]))
    for c, (ids, score) in zip(chunks, side_by_side):
        assert own._alone(c.encode("utf-8", "surrogatepass")) == (ids, score)
    assert own.segment(chunks) == side_by_side
    text, began = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEF0123456789+/") for _ in range(300_000)), time.process_time()
    (ids, _), = own.encode([text])
    assert own.decode(ids) == text and time.process_time() - began < 30


def test_tool_calls_refer_to_calls(spark):
    from cardflow.llm.queries import TOOLS, tool_dialogue

    turns = [(c, t, "assistant" if t % 2 else "user", f"text {t}") for c in (1, 2) for t in range(12)]
    said = tool_dialogue(spark.createDataFrame(turns, "conv_id long, turn int, role string, text string"))
    found = {(r["conv_id"], r["turn"]): r for r in chat.link_calls(said, TOOLS).collect()}
    assert {k: r["level"] for k, r in found.items()} == {(c, t): t // 2 for c in (1, 2) for t in range(1, 12, 2)}
    assert not any("unresolved" in e for r in found.values() for e in r["errors"])
    call = '{"tool_calls":[{"id":"x","name":"f","arguments":{"a":1,"b":"${gone}"}}]}'
    one = spark.createDataFrame([(1, 0, "assistant", call), (None, 0, "assistant", call), (1, 1, "tool", '{"tool_call_id":"x"}')],
                                "conv_id long, turn long, role string, text string")
    assert all(r["status"] == "invalid" and r["errors"] == ["unresolved ${gone}"] for r in chat.link_calls(one, SCHEMAS).collect())


def plain_levels(needs):
    """Level of each call, None within and behind a cycle, by following the needs one by one."""
    needs = {k: {n for n in v if n in needs} for k, v in needs.items()}
    out = {}
    while True:
        ready = {k: 1 + max((out[n] for n in v), default=-1) for k, v in needs.items()
                 if k not in out and all(n in out for n in v)}
        if not ready:
            return {k: out.get(k) for k in needs}
        out.update(ready)


def test_call_levels_of_random_graphs_and_long_chains(spark):
    rng = random.Random(8)
    graphs = {c: {f"k{i}": {f"k{rng.randrange(i + (3 if c % 3 == 0 else 0)) if i else 0}" for _ in range(rng.choice([0, 1, 1, 1, 2, 3]))}
                  - ({"k0"} if not i else set()) for i in range(40)} for c in range(6)}
    graphs[10] = {f"k{i}": {f"k{i - 1}"} if i else set() for i in range(300)}
    graphs[11] = {f"k{i}": {f"k{(i + 1) % 5}"} if i < 5 else {f"k{i - 1}"} for i in range(30)}
    graphs[12] = {"k0": {"k0"}, "k1": {"k0", "k2"}, "k2": set(), "k3": {"k1"}, "k4": {"gone", "k2"}, "k5": {"gone"}}
    graphs[13] = {"k0": set(), "k1": {"k0"}, "k2": {"k0", "k1"}, "k3": {"k2"}, "k4": {"k3", "k1"}, "k5": {"k4"}}
    calls = [(c, k, '{"a":"%s"}' % " ".join(f"${{{n}}}" for n in sorted(v))) for c, g in graphs.items() for k, v in g.items()]
    df = spark.createDataFrame(calls + calls[:9] + [(None, "k1", "{}")], "conv_id long, call_id string, arguments string")
    got = {(r["conv_id"], r["call_id"]): r["level"] for r in chat.levels(df).collect()}
    assert got == {(c, k): level for c, g in graphs.items() for k, level in plain_levels(g).items()}
    assert chat.levels(df.limit(0)).count() == 0


CLASHES = "__pii int, __rules int, __stat int, __score int, __shard string, __slot long, __row long, __bits int, __likely int, __bucket int"


def test_columns_named_like_scratch_columns(spark):
    rows = [(k, t, *range(4), "s", 5, 6, 7, 8, 9) for k, t in odd_documents()[-20:]]
    df = spark.createDataFrame(rows, f"doc_id long, text string, {CLASHES}")
    placed = sharding.place(df, "doc_id", ["a", "b"], slots=101)
    assert placed.columns == [*df.columns, "slot", "shard"] and placed.filter("__shard = 's' and __slot = 5").count() == len(rows)
    again = sharding.place(placed.withColumn("slot", F.lit(3)), "doc_id", ["a", "b"], slots=101)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, placed.collect()))
    judged = quality_rules.with_verdict(df, name="verdict")
    assert judged.columns == [*df.columns, "verdict"] and judged.filter("__stat = 2 and __rules = 1").count() == len(rows)


def test_places_in_very_long_words_matter():
    """Bytes that change places at any distance make another word."""
    from cardflow.llm.textstats import shingle_set, word_hashes

    def swapped(step):
        word = bytearray(b"ab" * 200_000)
        word[10], word[11 + step] = ord("x"), ord("y")
        other = bytearray(word)
        other[10], other[11 + step] = word[11 + step], word[10]
        return bytes(word), bytes(other)

    for step in (5, 65_535, 65_536, 131_071, 196_607, 262_143):
        a, b = word_hashes(swapped(step))
        assert len(a) == len(b) == 1 and a[0] != b[0]
        assert (shingle_set(a, 3) != shingle_set(b, 3)).all()
