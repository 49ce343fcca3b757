"""Spelling variants by a dictionary of trie-node pairs.

The distinct words form a forward trie (paths are prefixes) and a reversed trie (paths are
suffixes); every node has a number. A word of L letters meets, at each place i, the forward node of
its first i letters and the reversed node of the rest:

* *skip* pair: prefix node of i letters, suffix node of the letters after letter i;
* *insert* pair: prefix node of i letters, suffix node of all letters from place i on.

Two words that share a skip pair differ in that one letter. A skip pair of one word that is an insert
pair of another says that the second lacks the skipped letter. So one equi join of integer pairs finds
exactly the words at one replaced, deleted or inserted letter: nothing has to be verified afterwards.
A deleted letter within a run of equal ones is skipped at the run's first letter alone, so each
neighbour is found once.

Numbering. Words are range-partitioned in code-point order and numbered; a sequential pass over a
partition keeps the path of the last word and gives every new prefix the next number of the
partition. A prefix that the partition before has already opened takes its number from there: one
row a partition (its first and last word) goes to the driver, and the numbers come back as a
broadcast of one row a partition. Reversed words are numbered alike.

Sizes. A pair is shared by as many words as there are letters (skip) and one (insert), so groups are
bounded by the alphabet, however frequent a letter sequence is; the hot words of the corpus are
counted before the shuffle. Rows of the dictionary are two integers, a word's number and its count.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardflow.llm.common import give_back, parallelism, ship_code, written

RUN = "[A-Za-zÀ-ÿ]+"
#: One in so many runs of a document loses a letter.
DAMAGE = 31
MIN_LETTERS, MIN_COUNT, FORM_FACTOR = 7, 2, 10
#: Words counted in a task before they are handed on, and letters of text looked at together.
HELD_WORDS, SLAB = 200_000, 1 << 20


def _slabs(text: str) -> Iterator[str]:
    """Parts of at most about SLAB letters, none cut within a run."""
    at = 0
    while at < len(text):
        end = at + SLAB
        if end < len(text):
            gap = re.compile("[^A-Za-zÀ-ÿ]").search(text, end)
            end = gap.start() if gap else len(text)
        yield text[at:end]
        at = end


def document_words(doc_id: int | None, text: str | None) -> Counter:
    """The words of one document with their counts: runs of letters, A-Z in lower case, and one in
    31 of them without the letter that its checksum names. A null id is written as nothing."""
    runs: Counter = Counter()
    for part in _slabs(text or ""):
        runs.update(re.findall(RUN, part))
    salt = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    words: Counter = Counter()
    for run, n in runs.items():
        low = run.encode().lower()  # bytes: A-Z alone
        h = zlib.crc32(low, salt)
        if h % DAMAGE == 0:
            letters = low.decode()
            cut = h % len(letters)
            low = (letters[:cut] + letters[cut + 1:]).encode()
        words[low] += n
    return words


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_letters: int = MIN_LETTERS,
                min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): words of at least ``min_letters`` letters that occur ``min_count`` times overall."""

    def run(batches):
        held: Counter = Counter()

        def out():
            batch = pa.RecordBatch.from_arrays([pa.array([w.decode() for w in held], pa.string()),
                                                pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return batch

        for batch in batches:
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                for word, n in document_words(k, t.as_py()).items():
                    # bytes are at least letters: the exact length is checked below
                    if len(word) >= min_letters:
                        held[word] += n
                if len(held) >= HELD_WORDS:
                    yield out()
        if held:
            yield out()
        give_back()

    ship_code(docs.sparkSession)
    found = docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(run, "word string, n long")
    return (found.filter(F.length("word") >= min_letters).groupBy("word").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= min_count))


def _common(a: str, b: str) -> int:
    k = 0
    for x, y in zip(a, b):
        if x != y:
            break
        k += 1
    return k


def trie_paths(words: DataFrame, word: Column, name: str) -> DataFrame:
    """(id, path): the numbers of the trie nodes on each word's way from the root, length + 1 of them.

    ``words`` has an ``id`` and distinct texts ``word``. Node numbers are part << 40 plus a place.
    """
    spark = words.sparkSession
    parts = parallelism(spark)
    ordered = (words.select("id", word.alias("word")).repartitionByRange(parts, "word").sortWithinPartitions("word")
               .withColumn("part", F.spark_partition_id()))

    def number(batches):
        path, last, first, count, shared = [], None, None, 0, 0
        for batch in batches:
            ids, texts, where = (batch.column(k).to_pylist() for k in range(3))
            paths, inner = [], []
            for text, part in zip(texts, where):
                same = -1 if last is None else _common(last, text)
                shared = len(text) if last is None else min(shared, same)
                first = text if last is None else first
                path = path[:same + 1]
                fresh = len(text) + 1 - len(path)
                base = (part << 40) + count
                path = path + list(range(base, base + fresh))
                count += fresh
                last = text
                paths.append(path)
                inner.append(shared)  # nodes up to here are also those of the partition's first word
            ends = [0]
            for p in paths:
                ends.append(ends[-1] + len(p))
            flat = pa.array([x for p in paths for x in p], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(texts, pa.string()), pa.array(where, pa.int32()),
                 pa.array(inner, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)],
                names=["id", "word", "part", "shared", "path"])
        give_back()

    local = written(ordered.mapInArrow(number, "id long, word string, part int, shared long, path array<long>"), name)
    row = F.struct("word", "shared", "path")
    ends = sorted(local.groupBy("part").agg(F.min_by(row, "word").alias("first"), F.max_by(row, "word").alias("last"))
                  .collect(), key=lambda r: r["part"])  # one row a range partition
    opened = []  # (part, numbers of the nodes that its first word shares with the word before)
    before: tuple[str, list[int]] | None = None
    for r in ends:
        taken = [] if before is None else before[1][:_common(before[0], r["first"]["word"]) + 1]
        opened.append((r["part"], taken))
        last = r["last"]
        inherited = taken[:last["shared"] + 1]
        before = (last["word"], inherited + list(last["path"])[len(inherited):])
    starts = F.broadcast(spark.createDataFrame(opened, "part int, opened array<long>"))
    path = F.expr("transform(path, (x, d) -> if(d <= shared and d < size(opened), opened[d], x))")
    return local.join(starts, "part").select("id", path.alias("path"))


def dictionary(words: DataFrame) -> DataFrame:
    """(prefix, suffix, id, n, skip, heads): the skip and insert pairs of every word (id, word, n, heads).

    ``heads`` tells skips of a letter that doesn't follow an equal one.
    """
    forward = trie_paths(words, F.col("word"), "spelling-forward").withColumnRenamed("path", "prefixes")
    backward = trie_paths(words, F.reverse("word"), "spelling-reversed").select("id", F.reverse("path").alias("suffixes"))
    both = words.join(forward, "id").join(backward, "id")
    skips = F.expr("""transform(heads, (head, i) -> struct(prefixes[i] as prefix, suffixes[i + 1] as suffix,
                                                           true as skip, head as heads))""")
    inserts = F.expr("""transform(prefixes, (node, i) -> struct(node as prefix, suffixes[i] as suffix,
                                                                false as skip, false as heads))""")
    return both.select("id", "n", F.explode(F.concat(skips, inserts)).alias("pair")).select("pair.*", "id", "n")


def neighbours(words: DataFrame) -> DataFrame:
    """(id, n_near, best): the number of words at one replaced, deleted or inserted letter, and of the
    most frequent one (ties: the least number) its count and number. Words without one are absent."""
    pairs = dictionary(words).groupBy("prefix", "suffix").agg(
        F.collect_list(F.struct("id", "n", "skip", "heads")).alias("members")).filter(F.size("members") > 1)
    member = pairs.select(F.explode("members").alias("m"), "members")
    near = F.expr("""filter(members, x -> (m.skip and x.skip and x.id <> m.id) or (m.heads and not x.skip)
                                          or (not m.skip and x.heads))""")
    found = member.select("m.id", near.alias("near")).filter(F.size("near") > 0)
    best = F.array_max(F.transform("near", lambda x: F.struct(x["n"].alias("n"), (-x["id"]).alias("order"))))
    return found.select("id", F.size("near").alias("k"), best.alias("best")).groupBy("id").agg(
        F.sum("k").alias("n_near"), F.max("best").alias("best"))


def _roots(links: DataFrame) -> DataFrame:
    """(id, root): where the chain of ``links`` (id, form_id) ends. A form's count is ten times its
    word's or more, so a chain is shorter than the digits of a count and pointers double five times at most."""
    at = written(links.select("id", F.col("form_id").alias("root")), "spelling-roots")
    while True:
        onward = at.select(F.col("id").alias("root"), F.col("root").alias("next"))
        moved = written(at.join(onward, "root", "left").select("id", F.coalesce("next", "root").alias("root"),
                                                               F.col("next").isNotNull().alias("moved")), "spelling-roots")
        at = moved.select("id", "root")
        if moved.filter("moved").isEmpty():
            return at


def spelling_forms(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_letters: int = MIN_LETTERS,
                   min_count: int = MIN_COUNT, factor: int = FORM_FACTOR) -> DataFrame:
    """(word, form, root, n, n_near, form_n): every frequent word with its more frequent spelling.

    A word's form is its near word of the largest count (ties: the least in code-point order), if that
    count is at least ``factor`` times the word's own; ``root`` follows the forms to the last. Null and
    empty texts have no words; repeated rows count again; columns beyond the two named are not looked at.
    """
    counted = written(word_counts(docs, doc_id, text, min_letters, min_count), "spelling-counts")
    # numbers in code-point order: ties between words are ties between numbers
    letters = F.split("word", "")
    heads = F.zip_with(letters, F.concat(F.array(F.lit("")), letters), lambda x, before: x != before)
    words = written(counted.repartitionByRange(parallelism(docs.sparkSession), "word").sortWithinPartitions("word")
                    .select(F.monotonically_increasing_id().alias("id"), "word", "n",
                            F.slice(heads, F.lit(1), F.length("word")).alias("heads")), "spelling-words")
    near = written(neighbours(words), "spelling-near")
    chosen = words.join(near, "id").filter(F.col("best.n") >= factor * F.col("n")).select(
        "id", (-F.col("best.order")).alias("form_id"), F.col("best.n").alias("form_n"))
    links = written(chosen, "spelling-links")
    named = lambda key, out: words.select(F.col("id").alias(key), F.col("word").alias(out))
    forms = (links.join(_roots(links), "id").join(named("form_id", "form"), "form_id")
             .join(named("root", "root_word"), "root").select("id", "form", F.col("root_word"), "form_n"))
    out = words.join(near.select("id", "n_near"), "id", "left").join(forms, "id", "left")
    return out.select("word", "form", F.coalesce("root_word", "word").alias("root"), "n",
                      F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")
