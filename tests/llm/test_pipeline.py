"""Stages of the corpus pipeline on small tables."""

import random
import re

import corpus_pipeline as C
import pytest

from cardflow.llm import packing, quality_model

SCHEMA = "doc_id long, text string, n_chars int, count long"


def near_texts():
    rng = random.Random(2)
    return [" ".join(f"w{rng.randrange(5000)}" for _ in range(60)) for _ in range(5)]


def test_near_duplicates_of_repeated_ids(spark):
    a, b, c, d, e = near_texts()
    rows = [(1, a), (2, a + " more"), (2, b), (2, b), (3, c), (3, d), (4, d + " more"), (5, e), (None, a), (None, a), (6, None)]
    docs = spark.createDataFrame([(k, t, len(t or ""), 7) for k, t in rows], SCHEMA)
    got = C.near_duplicate_stage(spark, docs, "")
    assert got.columns == docs.columns
    want = [(1, a), (2, b), (3, c), (3, d), (5, e), (None, a), (None, a), (6, None)]
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_near_duplicates_of_single_ids(spark):
    a, b, c, d, _ = near_texts()
    rows = [(9, a), (2, a + " more"), (3, b), (4, c), (None, d), (None, d)]
    docs = spark.createDataFrame([(k, t, len(t), 7) for k, t in rows], SCHEMA)
    got = sorted(((r["doc_id"], r["text"]) for r in C.near_duplicate_stage(spark, docs, "").collect()), key=repr)
    assert got == sorted([(2, a + " more"), (3, b), (4, c), (None, d), (None, d)], key=repr)


def test_near_duplicates_of_short_integer_ids(spark):
    a, b, c, _, _ = near_texts()
    rows = [(9, a), (2, a + " more"), (3, b), (4, c)]
    docs = spark.createDataFrame([(k, t, len(t), 7) for k, t in rows], SCHEMA.replace("doc_id long", "doc_id int"))
    got = C.near_duplicate_stage(spark, docs, "")
    assert got.schema["doc_id"] == docs.schema["doc_id"]
    assert sorted((r["doc_id"], r["text"]) for r in got.collect()) == sorted([(2, a + " more"), (3, b), (4, c)])


ROW = ("doc_id long, text string, lang string, source string, n_chars int, __pii int, __rules int, __stat int, __score int, "
       "__row int, __likely int")
CARD = "4111 1111 1111 1111"


def corpus():
    """(doc_id, text): prose, junk, near and exact copies, personal data, nulls, repeated rows, a very long text."""
    rng = random.Random(11)
    words = [f"{a}{b}" for a in ("ran", "sel", "tor", "min", "gal", "pes", "dul", "vek", "hob", "lin") for b in ("o", "ita", "er", "um", "es", "ag", "ith")]
    prose = lambda n: " ".join(rng.choice(words) + rng.choice(["", "", "", ",", "."]) for _ in range(n))
    good = [(k, prose(rng.randrange(80, 200))) for k in range(60)]
    junk = [(k, " ".join(rng.choice(["$$", "##", "BUY", "&&", "FREE", "|"]) for _ in range(60))) for k in range(100, 150)]
    odd = [(200, None), (201, ""), (202, " \n"), (203, "one two"), (204, good[3][1]), (205, good[4][1] + " end"),
           (206, prose(100) + f" mail a.b@c.org pay {CARD} now " + prose(20)), (207, " ".join(prose(50) for _ in range(300))),
           (None, good[5][1]), (None, None), good[6], (7, prose(90))]
    return good + junk + odd


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(k, t, None, "x", len(t or ""), 1, 2, 3, 4, 5, 6) for k, t in corpus()], ROW)


@pytest.fixture(scope="module")
def folder(tmp_path_factory, spark, docs):
    path = str(tmp_path_factory.mktemp("pipeline"))
    docs.coalesce(1).write.parquet(f"{path}/documents.parquet")
    labels = [(k, int(k < 100), 0) for k, t in corpus() if k is not None and k < 200] + [(1, None, None), (None, 1, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def contents(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_quality_stage_keeps_whole_rows_above_the_threshold(spark, docs, folder):
    kept = C.quality_stage(spark, docs, folder)
    assert kept.schema == docs.schema
    vectors = docs.select("doc_id", quality_model.features("text").alias("vector"))
    model = quality_model.fit(quality_model.training_rows(vectors, spark.read.parquet(f"{folder}/labels.parquet")))
    rows = docs.withColumn("own", quality_model.features("text")).collect()
    scores = model.scores([r["own"] for r in rows])
    want = sorted((tuple(r)[:-1] for r, s in zip(rows, scores) if s >= quality_model.THRESHOLD), key=repr)
    assert contents(kept) == want
    ids = {r["doc_id"] for r in kept.collect()}
    assert set(range(60)) <= ids and not ids & set(range(100, 150))


def test_quality_stage_without_labels_rejects_nothing(spark, docs, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert contents(C.quality_stage(spark, docs, str(tmp_path))) == contents(docs)


def passes_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    starts = {}
    for k in range(len(words) - 7):
        starts.setdefault(tuple(words[k:k + 8]), []).append(k)
    repeated = {k + j for s in starts.values() if len(s) > 1 for k in s for j in range(8)}
    return len(words) >= 20 and 100 * len(repeated) <= 30 * len(words)


def test_rules_stage_keeps_whole_rows(spark, docs):
    kept = C.rules_stage(spark, docs, "")
    assert kept.schema == docs.schema
    got = {r["doc_id"] for r in kept.collect()}
    assert set(range(60)) | {204, 205, 206, 207} <= got and not got & {200, 201, 202, 203}
    assert all(passes_base(r["text"]) for r in kept.collect())
    clones = docs.filter("doc_id < 60 or doc_id >= 204")
    assert contents(C.rules_stage(spark, clones, "")) == contents(clones)


def test_pii_stage_redacts_and_keeps_the_columns(spark, docs):
    clean = C.pii_stage(spark, docs, "")
    assert clean.schema == docs.schema and clean.count() == docs.count()
    row = clean.filter("doc_id = 206").first()
    assert "[EMAIL]" in row["text"] and "[CARD]" in row["text"] and CARD not in row["text"] and row["n_chars"] == len(row["text"])
    assert contents(clean.filter("doc_id < 100 or text is null").drop("n_chars")) == contents(
        docs.filter("doc_id < 100 or text is null").drop("n_chars"))


def test_run_equals_its_stages_and_packs_what_they_keep(spark, docs, folder):
    kept = docs
    for _, stage in C.STAGES[:-1]:
        kept = stage(spark, kept, folder).cache()
    got = C.run(spark, folder).select("doc_id", "start", "length", "doc_tokens", "ids_crc32")
    want = packing.pack(kept, C.public_tokenizers.path("byte_bpe_50k.json")).select(*got.columns)
    assert sum(r["length"] for r in got.collect()) == sum(r["length"] for r in want.collect())
    assert {r["doc_id"] for r in got.collect()} == {r["doc_id"] for r in want.collect()} == {r["doc_id"] for r in kept.collect()}
    ids = {r["doc_id"] for r in got.collect()}
    # of exact and near copies the least id stays; junk and short texts are gone
    assert {3, 4, 206} <= ids and not ids & {100, 149, 200, 201, 202, 203, 204, 205}


def test_every_stage_on_an_empty_table(spark, docs, folder, tmp_path):
    none = spark.createDataFrame([], docs.schema)
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, none, folder)
        assert out.schema == docs.schema and out.count() == 0, name
    none.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert C.run(spark, str(tmp_path)).count() == 0


def test_packing_stage_hands_over_few_documents_at_a_time(spark, monkeypatch):
    from pyspark.sql import functions as F

    from cardflow.llm.common import arrow_rows

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, seen = spark.conf.get(key), []
    written = packing.written
    monkeypatch.setattr(packing, "written", lambda *args: seen.append(int(spark.conf.get(key))) or written(*args))
    docs = spark.range(1300).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("a b"), F.col("id").cast("string")).alias("text"))
    placed = C.packing_stage(spark, docs, "")
    assert seen == [C.BATCH_ROWS] and spark.conf.get(key) == before
    plain = packing.pack(docs, C.public_tokenizers.path("byte_bpe_50k.json"))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(map(tuple, placed.select(*columns).collect())) == sorted(map(tuple, plain.select(*columns).collect()))

    def sizes(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    with arrow_rows(spark, 100):
        handed = [r["n"] for r in docs.coalesce(1).select("doc_id").mapInArrow(sizes, "n long").collect()]
    assert sum(handed) == 1300 and max(handed) == 100
    assert spark.conf.get(key) == before


KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def long_table(spark, rows=1300):
    from pyspark.sql import functions as F

    words = F.concat_ws(" ", *[F.concat(F.lit(w), (F.col("id") * k % 97).cast("string")) for k, w in enumerate("abcdefgh" * 6)])
    return spark.range(0, rows, 1, 1).select(F.col("id").alias("doc_id"), words.alias("text"))


def test_text_stages_hand_over_few_documents_at_a_time(spark, monkeypatch, tmp_path):
    """Every batch of texts that the stages' own Python functions meet is short, and the session's setting comes back."""
    import pandas as pd
    from pyspark.sql import functions as F

    before = spark.conf.get(KEY)
    sizes = str(tmp_path / "sizes")

    def noted(kind, value):  # a stand-in for the text function that notes the rows of each batch
        @F.pandas_udf(kind)
        def measure(texts: pd.Series) -> pd.Series:
            with open(sizes, "a") as f:
                f.write(f"{len(texts)}\n")
            return pd.Series([value] * len(texts))

        return measure

    docs = long_table(spark)
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"), F.lit(0).alias("toxic"))
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    monkeypatch.setattr(quality_model, "features", lambda text: F.lit(None).cast("array<double>"))
    monkeypatch.setattr(quality_model, "fit", lambda rows: object())
    monkeypatch.setattr(quality_model, "score_text", lambda model, text: noted("double", 1.0)(text))
    assert C.quality_stage(spark, docs, str(tmp_path)).count() == 1300
    kept = C.quality_rules.with_verdict

    def verdict(df, name):
        return kept(df.filter(noted("boolean", True)("text")), name=name)

    monkeypatch.setattr(C.quality_rules, "with_verdict", verdict)
    C.rules_stage(spark, docs, "").count()
    found = [int(x) for x in open(sizes)]
    assert sum(found) == 2600 and max(found) <= C.BATCH_ROWS
    assert spark.conf.get(KEY) == before


def test_every_step_of_the_stages_is_planned_with_few_rows(spark, folder, monkeypatch):
    from cardflow.llm import ngram_join

    before, seen = spark.conf.get(KEY), []
    plain = ngram_join.written
    monkeypatch.setattr(ngram_join, "written", lambda df, name: seen.append(int(spark.conf.get(KEY))) or plain(df, name))
    docs = long_table(spark, 40)
    assert C.near_duplicate_stage(spark, docs, folder).count() <= 40
    assert seen and set(seen) == {C.BATCH_ROWS} and spark.conf.get(KEY) == before


@pytest.mark.parametrize("module", ["quality_model", "quality_rules"])
def test_text_functions_hand_memory_back_at_the_end(module, monkeypatch):
    import importlib

    import pandas as pd

    target, calls = importlib.import_module(f"cardflow.llm.{module}"), []
    monkeypatch.setattr(target, "give_back", lambda: calls.append(1))
    monkeypatch.setattr(target.F, "pandas_udf", lambda kind: lambda f: lambda column: f)
    monkeypatch.setattr(target.F, "coalesce", lambda *a: None)
    monkeypatch.setattr(target.F, "lit", lambda *a: None)
    monkeypatch.setattr(target.F, "col", lambda *a: None)
    run = target.features("text") if module == "quality_model" else target.statistics("text")
    assert [len(x) for x in run(iter([pd.Series(["one two"]), pd.Series([], dtype=object)]))] == [1, 0] and calls == [1]


def test_packing_plan_needs_no_python_workers(spark):
    rows = packing.plan_rows(packing.minimum_bin_slack({2000: 3, 48: 2, 7: 5}, 2048))
    plan = packing.plan_table(spark, rows)
    assert sorted(map(tuple, plan.collect())) == sorted(rows) and rows
    assert [t for _, t in plan.dtypes] == ["bigint"] * 6
    empty = packing.plan_table(spark, [])
    assert empty.count() == 0 and empty.schema == plan.schema
    assert "PythonRDD" not in plan._jdf.queryExecution().toRdd().toDebugString()
