"""Spelling forms, the filter audit and the mix against brute force, on small fixtures with odd rows."""

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from cardflow.llm import filter_audit, mixing, queries, spelling, transducer

SCHEMA = "doc_id long, text string, source string, id long, word string, n long, part string, rank int"
WORD = "[^\x20\x09-\x0D]+"


def odd_rows():
    """(doc_id, text, source): nulls, empty and very long texts, repeated rows, ties, hot sources."""
    rng = random.Random(11)
    names = ["sentence", "sentense", "sentance", "Sentence", "sentences", "ssentence", "sentnce", "übersicht", "Übersicht",
             "uebersicht", "bookkeeper", "bokkeeper", "bookeeper", "abcdefg", "abcdefgh", "bcdefgh", "zzzzzzzz", "zzzzzzz", "x1"]
    rows = [(1, None, "a"), (2, "", "a"), (3, " \n\t", None), (None, "sentence #1 sentence", "b"), (None, None, None),
            (4, "q" * 300_000, "a"), (5, "q" * 300_000, "long"), (6, "word " * 150_000, "long"), (7, "ÀÈ÷ × ß", ""),
            (8, "日本語 テキスト & more", "a"), (9, "A B C D", "b"), (10, "tiny", "one")]
    for k in range(20, 420):
        source = "hot" if k % 3 else rng.choice(["a", "b", "Z", "é", None])
        rows.append((k, " ".join(rng.choices(names, [200, 9, 9, 20, 30, 2, 3, 20, 5, 2, 60, 3, 2, 9, 9, 9, 5, 5, 9],
                                             k=rng.choice([1, 8, 60, 90]))) + rng.choice(["", " $", " OK"]), source))
    return rows + rows[40:60] + [(k + 1000, t, "copy") for k, t, _ in rows[60:90]] + [(25, "another text of this id", "b")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(k, t, s, 7, "clash", 1, "p", 2) for k, t, s in odd_rows()], SCHEMA)


# ---------------------------------------------------------------- spelling
def brute_forms(rows):
    count = Counter()
    for k, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if k is None else k}:{low}".encode())
            if h % 31 == 0:
                low = low[:h % len(low)] + low[h % len(low) + 1:]
            count[low] += 1
    words = {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}

    def near(a, b):
        if a == b or abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    found = {}
    for w, n in words.items():
        others = [x for x in words if near(w, x)]
        best = min(others, key=lambda x: (-words[x], x), default=None)
        found[w] = (best if best and words[best] >= 10 * n else None, n, len(others))
    out = {}
    for w, (form, n, k) in found.items():
        root = w
        while found[root][0]:
            root = found[root][0]
        out[w] = (form, root, n, k, words[form] if form else None)
    return out


@pytest.mark.parametrize("partitions", [1, 4, 9])
def test_spelling_forms(spark, docs, partitions):
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        got = {r["word"]: tuple(r)[1:] for r in spelling.spelling_forms(docs).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    want = brute_forms([(k, t) for k, t, _ in odd_rows()])
    assert got == want
    assert any(v[0] for v in want.values()) and any(len(w) > 1000 for w in want)


def test_spelling_chain_of_forms(spark):
    """Forms of forms of forms, and equal letters in a run."""
    chain = ["aaaaaaaa", "aaaaaaab", "aaaaaabb", "aaaaabbb", "aaaabbbb"]
    text = " ".join(" ".join([w] * 2 * 10 ** k) for k, w in enumerate(chain))
    rows = [(3, text)]  # one document: a run of it loses its letter everywhere or nowhere
    got = {r["word"]: tuple(r)[1:] for r in spelling.spelling_forms(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_forms(rows)
    assert got["aaaaaaaa"][1] == "aaaabbbb"


def test_trie_paths_number_prefixes(spark):
    """Equal prefixes have one number and others another, across partitions."""
    words = sorted({"".join(c) for c in itertools.product("ab", repeat=5)} | {"a", "ab", "abc", "b", "bb"})
    df = spark.createDataFrame(list(enumerate(words)), "id long, word string")
    paths = {words[r["id"]]: r["path"] for r in spelling.trie_paths(df, df["word"], "test-paths").collect()}
    number = defaultdict(set)
    for w, path in paths.items():
        assert len(path) == len(w) + 1
        for k, x in enumerate(path):
            number[w[:k]].add(x)
    assert all(len(v) == 1 for v in number.values())
    assert len({min(v) for v in number.values()}) == len(number)


def test_spelling_of_empty_tables(spark, docs):
    assert spelling.spelling_forms(docs.filter("doc_id = 2")).collect() == []
    assert spelling.spelling_forms(docs.limit(0)).collect() == []


# ---------------------------------------------------------------- filter audit
def plain_counts(text):
    words = re.findall(WORD, text)
    return [len(words), len(set(words)), len(text), len(re.findall("[A-Z]", text)), len(re.findall(r"[#$%&*|]", text))]


def test_transducer_counts():
    texts = [t or "" for _, t, _ in odd_rows()] + ["x" * 700_000 + " y " + "x" * 700_000, "é " * 400_000 + "É É", "\x0b\x0c", "  nb"]
    got = transducer.text_counts([t.encode() for t in texts])
    assert got.tolist() == [plain_counts(t) for t in texts]
    assert transducer.text_counts([]).shape == (0, 5)


def test_span_table_survives_equal_hashes():
    """All words in one chain of slots: bytes decide, not hashes."""
    words = [f"w{k % 40:02d}".encode() for k in range(200)]
    buf = np.frombuffer(b" ".join(words), dtype=np.uint8)
    start = np.arange(200) * 4
    table = transducer.SpanTable(buf, 8)
    size, same = np.full(200, 3), np.zeros(200, np.uint64)
    first = np.concatenate([table.add(start[a:b], size[a:b], np.zeros(b - a, np.int64), same[a:b]) for a, b in ((0, 70), (70, 200))])
    assert first.sum() == 40 and first[:40].all() and len(table.start) == 40


def test_audit_equals_sql(spark, docs):
    labels = [(k, k % 2, int(k % 5 == 0)) for k in range(1, 400, 3)] + [(22, 0, 1), (22, 1, 0), (None, 1, 1), (25, None, None)]
    marks = spark.createDataFrame([(*r, "x") for r in labels], "doc_id long, quality int, toxic int, source string")
    got = filter_audit.audit(docs, marks)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", odd_rows())
    con.execute("CREATE TABLE labels (doc_id BIGINT, quality INT, toxic INT)")
    con.executemany("INSERT INTO labels VALUES (?, ?, ?)", labels)
    want = con.execute(queries.FILTER_AUDIT_SQL)
    names = [c[0] for c in want.description]
    assert sorted(tuple(r) for r in got.select(*names).collect()) == sorted(want.fetchall())
    assert {r["filter_order"] for r in got.select("filter_order").distinct().collect()} == set(map("".join, itertools.permutations("ABCDE")))


def test_audit_walks_every_order(spark):
    """Plain steps over the documents of one part, by every order."""
    texts = ["ok " * 3, "A B", "# x", " ".join(f"w{k}" for k in range(60)), " ".join(f"w{k}" for k in range(60)), None, ""]
    docs = spark.createDataFrame([(k, t, None) for k, t in enumerate(texts)], "doc_id long, text string, source string")
    labels = spark.createDataFrame([(0, 1, 0), (4, 1, 1)], "doc_id long, quality int, toxic int")
    fails = []
    for k, t in enumerate(texts):
        w, d, p, c, s = plain_counts(t or "")
        same = any((t or "") == (x or "") for x in texts[:k])
        fails.append({x for x, bad in zip("ABCDE", (w < 50, 100 * d < 65 * w, 100 * c > 5 * p, s > 0, same)) if bad})
    for r in filter_audit.audit(docs, labels).collect():
        assert r["part"] == ""
        before, now = set(r["filter_order"][:r["step"] - 1]), r["filter_order"][r["step"] - 1]
        removed = [k for k, f in enumerate(fails) if now in f and not f & before]
        assert r["removed"] == len(removed) and r["kept"] == sum(not f & (before | {now}) for f in fails)
        assert r["redundant"] == sum(now in f and bool(f & before) for f in fails)
        assert r["unique_fails"] == sum(f == {now} for f in fails)
        assert (r["good_lost"], r["toxic_lost"]) == (len({0, 4} & set(removed)), len({4} & set(removed)))
        assert r["shapley"] == sum(sum(now in f and not f & set(o[:o.index(now)]) for f in fails) for o in itertools.permutations("ABCDE"))


def test_audit_of_empty_tables(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs.limit(0), none).collect() == []
    assert filter_audit.audit(docs.filter("doc_id = 2"), none).count() == 600


# ---------------------------------------------------------------- mixing
def brute_targets(sizes, percent=150, epochs=2):
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    budget, full, unit = sum(sizes.values()) * percent / 100, set(), 0
    while len(full) < len(names):
        unit = (budget - sum(epochs * sizes[s] for s in full)) / sum(weight[s] for s in names if s not in full)
        over = {s for s in names if s not in full and unit * weight[s] >= epochs * sizes[s]}
        if not over:
            break
        full |= over
    return {s: epochs * sizes[s] if s in full else unit * weight[s] for s in names}


def test_mix_targets_spans_and_reruns(spark, docs):
    got = [r.asDict() for r in mixing.mixed(docs, shards=8).collect()]
    rows = odd_rows()
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((k, len(re.findall(WORD, t or ""))) for k, t, _ in rows)
    sizes, taken, target = Counter(), Counter(), {}
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert r["taken"] == sum(s["to"] - s["from"] for s in r["spans"]) <= 2 * r["size"]
        for epoch in (0, 1):  # spans of a pass don't overlap
            ends = sorted((s["from"], s["to"]) for s in r["spans"] if s["pass"] == epoch)
            assert all(0 <= a < b <= r["size"] for a, b in ends) and all(x[1] <= y[0] for x, y in zip(ends, ends[1:]))
    assert {r["source"]: r["source_size"] for r in got} == sizes
    want = brute_targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s]) and target[s] <= 2 * sizes[s]
        assert abs(taken[s] - target[s]) <= 2 * max(1, min(256, sizes[s] // 1024)), s
    again = mixing.mixed(docs.repartition(7), shards=8)
    key = lambda r: repr(sorted(r.items()))
    assert sorted(map(key, got)) == sorted(key(r.asDict()) for r in again.collect())


def test_mix_shards_hold_their_quota(spark, docs, tmp_path):
    mix = mixing.mixed(docs, shards=8)
    spans = [(r["shard"], r["source"], r["pass"], r["block"]) for r in
             mix.selectExpr("source", "explode(spans) as s").select("source", "s.*").collect()]
    per_shard = Counter(s for s, *_ in set(spans))
    assert set(per_shard) == set(range(8)) and max(per_shard.values()) - min(per_shard.values()) <= 1
    mixing.write_mix(mix, str(tmp_path / "mix"), 8)
    back = mixing.read_mix(spark, str(tmp_path / "mix"))
    assert back.count() == len(spans)
    first = [r["source"] for r in back.filter("shard = 0").collect()]
    assert first != sorted(first, key=str)  # mixed within the shard


def test_split_tree_margins_and_spread():
    rng = np.random.default_rng(3)
    counts, room = np.array([40, 0, 7, 1000, 3]), np.array([350, 350, 350])
    drawn = np.array([mixing.split_tree(counts, room, rng) for _ in range(300)])
    assert (drawn.sum(axis=2) == counts).all() and (drawn.sum(axis=1) == room).all()
    assert abs(drawn[:, 0, 0].mean() - 40 / 3) < 1
    variance = 350 * (40 / 1050) * (1010 / 1050) * (700 / 1049)  # of the hypergeometric count
    assert abs(drawn[:, 0, 0].var() - variance) < 0.4 * variance


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 1000])
def test_permutation_of_any_range(n):
    a, b = (mixing.permuted(np.arange(n), np.full(n, n), np.full(n, k)) for k in (1, 2))
    assert sorted(a) == sorted(b) == list(range(n))
    assert n < 64 or (a != b).any()


def test_mix_of_empty_tables(spark, docs):
    assert mixing.mixed(docs.limit(0)).collect() == []
    (r,) = mixing.mixed(docs.filter("doc_id = 2")).collect()
    assert (r["size"], r["target"], r["taken"], r["spans"]) == (0, 0.0, 0, [])
