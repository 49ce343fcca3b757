"""N-gram Jaccard join by vertical partitioning.

A document is the sorted set of its 64-bit word-shingle hashes; the hash order is the global
n-gram order. Documents with the same set form a class, and only one document of a class goes on.

1. Candidates. If two sets have Jaccard similarity >= t, at most ``n(1-t)`` shingles of a set of
   n are not in the other, so the first ``n(1-t) + l`` shingles of both in the global order hold
   at least ``l`` common ones. From 88 % on the keys are coarser: the global order is cut into K
   fragments (K a power of two that follows n), and a key is a fragment with all the shingles that
   the document has there. At most ``d = n(1-t)/t`` shingles are in one set only, so at most d
   fragments differ and the first ``d + l`` non-empty fragments hold ``l`` common ones; texts that
   merely share passages share few whole fragments. Documents
   with so few non-empty fragments that they or a partner may lack ``d + l`` of them use the
   shingles too. Only these keys are shuffled. A key of one document only cannot be shared; a
   document with fewer than ``l`` shared keys has no partner. Of the rest, the ``l - 1`` most
   frequent may be left out: the rarest common key of two partners is then still there.
   Documents are tied to the least document that has the key too, never to each other.
2. Counting. The documents of a connected group of such ties are compared in blocks of bounded
   size. A block cuts the global order into fragments, counts the common n-grams of all its
   pairs in each fragment separately (a product of the fragment's incidence matrices), sums
   the counts per pair and links those that reach t exactly (integers).
3. A block returns a spanning forest of its links, and the components of all forests are the
   result. No list of all pairs is ever made, and no link is lost.

A group of more than one block is grouped anew first, by step 1 on whole sets within the group: a
linked document has at least t of its shingles in one other document, so those that merely share
passages leave the group, and only the rarest 1 - t of the shared shingles tie. What is still more
than one block is cut by set size, as linked sets are of similar size; the documents of a size class
are then sent to as many blocks as the class has: work on a group grows with the square of its
distinct texts of a size, its memory does not.

A null or empty text has no shingles and links with nothing. Rows with a null id are returned with
a null component and link with nothing. Repeated rows are one document; an id that occurs with
several texts is linked by all of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardflow.llm.common import (discard, give_back, likely_in, per_group, ship_code, short_batches, unlikely_in,
                                 written)
from cardflow.llm.components import connected_components
from cardflow.llm.textstats import mix64, shingle_set, utf8, word_hashes

#: Common shingles asked of a pair's prefixes, as a share of the set in percent.
EXTRA_PERCENT = 4
BLOCK_DOCS = 768
BLOCK_SHINGLES = 1_500_000
FRAGMENT = 4096
#: Bitmap rows (of 4 KB) that tell documents with copies or repeated ids from the others.
ODD_BITMAP = 1024
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], dtype=np.uint64)
_SALT = np.uint64(0xD6E8FEB86659FD93)


def _common(n: int, extra: int) -> int:
    return n * extra // 100 + 1


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    """A list<int64> column of uint64 arrays."""
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def _sets(batch: pa.RecordBatch, width: int, lower: bool) -> Iterator[np.ndarray]:
    """The shingle set of each row's text (the last column)."""
    texts = utf8(batch.column(batch.num_columns - 1).to_pylist())
    if lower:
        texts = [t.lower() for t in texts]  # bytes: A-Z alone
    for words in word_hashes(texts):
        yield shingle_set(words, width)


def _fragments(n: int) -> int:
    """Number of fragments for sets of n shingles: a power of two, 0.45 n to 0.9 n."""
    return 1 << max(0, math.ceil(math.log2(0.45 * n)))


def _keys(s: np.ndarray, percent: int, extra: int) -> list[tuple[int, np.ndarray]]:
    """(common keys that a partner must have, keys) of each scheme a set takes part in."""
    n = len(s)
    d = n * (100 - percent) // percent
    if not d:  # only an equal set can link
        return []
    size, need = d + _common(n, extra), _common(-(-n * percent // 100), extra)
    first = s[:n + -n * percent // 100 + _common(n, extra)]
    if percent < 88:
        return [(need, first)]
    schemes = []
    least = -(-size * 100 // percent) + 2 + d  # fewer fragments: a partner may have less than its size
    plain = False
    for fragments in sorted({_fragments(n), _fragments(n * 100 // percent)}):
        where = ((s >> np.uint64(32)) * np.uint64(fragments)) >> np.uint64(32)
        starts = np.flatnonzero(np.append(True, where[1:] != where[:-1]))
        whole = np.add.reduceat(mix64(s), starts)
        schemes.append((need, mix64(whole + where[starts] * _ODD[0] + np.uint64(fragments * int(_ODD[1]) % 2**64))[:size]))
        plain |= len(starts) < least
    return [*schemes, (need, first)] if plain else schemes


def shingle_prefixes(docs: DataFrame, doc_id: str, text: str, width: int, percent: int,
                     extra: int = EXTRA_PERCENT) -> DataFrame:
    """(doc_id, n, k1, k2, need, prefixes): set size, two hashes of the whole set, common keys that a
    partner must share in a scheme, and the keys of each scheme (none where no other set can link)."""

    def run(batches):
        for batch in short_batches(batches):
            n, k1, k2, need, schemes, keys = [], [], [], [], [0], []
            for s in _sets(batch, width, lower=True):
                found = _keys(s, percent, extra)
                n.append(len(s))
                k1.append(int(mix64(s).sum().view(np.int64)))
                k2.append(int(mix64(s ^ _SALT).sum().view(np.int64)))
                need.append(found[0][0] if found else 0)
                keys.extend(k for _, k in found)
                schemes.append(len(keys))
            prefixes = pa.ListArray.from_arrays(pa.array(schemes, pa.int32()), _lists(keys))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(k1, pa.int64()),
                 pa.array(k2, pa.int64()), pa.array(need, pa.int64()), prefixes],
                names=["doc_id", "n", "k1", "k2", "need", "prefixes"])
        give_back()

    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(
        run, "doc_id long, n long, k1 long, k2 long, need long, prefixes array<array<long>>")


def candidate_ties(prefixes: DataFrame) -> DataFrame:
    """(u, v): ties between documents that may link, transitively complete (step 1).

    A key goes through three shuffles: its count and least document (partial sums before the shuffle), the
    join that marks a document's shared keys (both sides straight from a shuffle, so a key held by very
    many documents is split), and a document's marks. ``key`` only orders equally frequent keys there, in
    the same way for all documents: its lower half does.
    """
    schemes = prefixes.select("doc_id", F.posexplode("prefixes").alias("scheme", "keys"))
    rows = schemes.select("doc_id", F.col("scheme").cast("byte").alias("scheme"), F.explode("keys").alias("key"))
    shared = written(rows.groupBy("key").agg(F.count(F.lit(1)).alias("docs"), F.min("doc_id").alias("least"))
                     .filter("docs > 1"), "ngram-shared")
    mark = F.struct("scheme", "docs", F.expr("cast(key & 2147483647 as int)").alias("order"), "least")
    marked = rows.join(shared, "key").groupBy("doc_id").agg(F.sort_array(F.collect_list(mark)).alias("marks"))
    kept = F.expr("""flatten(transform(array_distinct(marks.scheme), s -> transform(array(filter(marks, m -> m.scheme = s)),
                         own -> if(size(own) >= need, slice(own, 1, cast(size(own) - need + 1 as int)).least, array()))[0]))""")
    ties = marked.join(prefixes.select("doc_id", "need"), "doc_id").select(
        F.col("doc_id").alias("u"), F.explode(F.array_distinct(kept)).alias("v")).filter("u <> v")
    out = written(ties, "ngram-ties")
    discard(shared)
    return out


def _sizes() -> tuple[Column, Column]:
    """A group's size in blocks, by documents and by shingles."""
    return F.count(F.lit(1)) / BLOCK_DOCS, F.sum("n") / BLOCK_SHINGLES


def _texts_of(members: DataFrame, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``members`` (one row a node) with the texts of their documents in ``body``."""
    texts = docs.select(F.col(doc_id).cast("long").alias("node"), F.col(text).alias("body"))
    return members.join(likely_in(texts, "node", members), "node")


def refined(groups: DataFrame, docs: DataFrame, sizes: DataFrame, doc_id: str, text: str, width: int,
            percent: int) -> DataFrame:
    """(node, component, n): ``groups`` with those of more than one block grouped anew by the whole
    sets of their documents; nodes that can't link are absent."""
    members = written(groups.join(sizes, groups["node"] == sizes["doc_id"]).select("node", "component", "n"), "ngram-members")
    large = written(members.groupBy("component").agg(F.greatest(*_sizes()).alias("size")).filter("size > 1")
                    .select("component"), "ngram-large")
    if large.isEmpty():
        return members
    again = members.join(large, "component", "left_semi")

    def whole(batches):
        for batch in short_batches(batches):
            sets = list(_sets(batch, width, lower=True))
            salt = mix64(batch.column(1).to_numpy().view(np.uint64))
            n = np.array([len(s) for s in sets], dtype=np.int64)
            keys = _lists([mix64(s ^ x) for s, x in zip(sets, salt)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(-(-n * percent // 100)),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32)), keys)],
                names=["doc_id", "need", "prefixes"])
        give_back()

    ship_code(docs.sparkSession)
    texts = _texts_of(again, docs, doc_id, text).select("node", "component", "body").distinct()
    sets = written(texts.mapInArrow(whole, "doc_id long, need long, prefixes array<array<long>>"), "ngram-again")
    anew = connected_components(candidate_ties(sets)).join(sizes, F.col("node") == F.col("doc_id")).select(
        "node", "component", "n")
    return written(members.join(large, "component", "left_anti").select("node", "component", "n").union(anew), "ngram-refined")


def _links(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Boolean matrix of the linked pairs of a block: overlaps counted fragment by fragment."""
    m = len(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    grams = np.concatenate(sets)
    owner = np.repeat(np.arange(m, dtype=np.int32), sizes)
    order = np.argsort(grams, kind="stable")
    grams, owner = grams[order], owner[order]
    first = np.empty(len(grams), dtype=bool)
    first[:1], first[1:] = True, grams[1:] != grams[:-1]
    rank = np.cumsum(first, dtype=np.int32) - 1
    often = np.bincount(rank)[rank] > 1  # an n-gram of one document overlaps with nothing
    owner, rank = owner[often], rank[often]
    first = np.append(True, rank[1:] != rank[:-1])[:len(rank)]
    rank = np.cumsum(first, dtype=np.int32) - 1
    overlap = np.zeros((m, m), dtype=np.int64)
    for low in range(0, int(rank[-1]) + 1 if len(rank) else 0, FRAGMENT):
        a, b = np.searchsorted(rank, [low, low + FRAGMENT])
        part = np.zeros((m, int(rank[b - 1]) - low + 1), dtype=np.float32)
        part[owner[a:b], rank[a:b] - low] = 1.0
        overlap += (part @ part.T).astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - overlap
    return overlap * 100 >= union * percent


def _forest(links: np.ndarray) -> np.ndarray:
    """For each row the least row reachable by links."""
    label = np.arange(len(links))
    while True:
        new = np.where(links, label[None, :], len(links)).min(axis=1, initial=len(links))
        new = np.minimum(label, new)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def verified_links(groups: DataFrame, docs: DataFrame, sizes: DataFrame, doc_id: str, text: str, width: int,
                   percent: int) -> DataFrame:
    """(u, v): a spanning forest of the exact links within candidate groups (step 2).

    ``groups``: (node, component); ``sizes``: (doc_id, n) of the same documents.
    """
    members = refined(groups, docs, sizes, doc_id, text, width, percent)
    size = _sizes()
    large = members.groupBy("component").agg(F.greatest(*size).alias("size")).filter("size > 1").select(
        "component", F.lit(True).alias("large"))
    # linked sets differ in size by a factor of at most 1 / t: their classes are the same or neighbours
    class_of = F.floor(F.log("n") / (math.log(100 / percent) * 1.001 + 1e-9))
    classed = members.join(large, "component", "left").select(
        "node", "component", "n", F.explode(F.when(F.col("large"), F.array(class_of, class_of - 1)).otherwise(
            F.array(F.lit(0).cast("long")))).alias("class"))
    blocks = classed.groupBy("component", "class").agg(F.greatest(*[F.ceil(x) for x in size]).alias("blocks"))
    split = classed.join(blocks, ["component", "class"]).groupBy("node").agg(F.collect_list(F.struct(
        "component", "class", "blocks", F.pmod(F.xxhash64("node", "class"), F.col("blocks")).alias("own"))).alias("places"))

    def expand(batches):
        for batch in short_batches(batches):
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], _lists(list(_sets(batch, width, lower=True)))],
                                             names=["node", "places", "grams"])
        give_back()

    places = "array<struct<component:long,class:long,blocks:long,own:long>>"
    sets = _texts_of(split, docs, doc_id, text).select("node", "places", "body").mapInArrow(
        expand, f"node long, places {places}, grams array<long>")
    # a block pair (i, j) gets the documents of i and j; a group of one block is compared within
    placed = sets.select("node", F.explode("places").alias("p"), "grams")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("p.blocks") - 1))
    sent = placed.withColumn("with", other).select(
        "node", F.xxhash64("p.component", "p.class", F.least("p.own", "with"), F.greatest("p.own", "with")).alias("task"),
        "grams")

    def compare(group: pa.Table) -> pa.RecordBatch:
        column = group.column("grams").combine_chunks()
        flat = column.flatten().to_numpy().view(np.uint64)
        ends = np.cumsum([0, *column.value_lengths().to_pylist()])
        node = group.column("node").to_numpy()
        keep = {}
        for k in np.argsort(node, kind="stable").tolist():
            keep.setdefault((int(node[k]), int(ends[k + 1] - ends[k]), flat[ends[k]:ends[k + 1]].tobytes()), k)
        rows = list(keep.values())
        label = _forest(_links([flat[ends[k]:ends[k + 1]] for k in rows], percent)) if len(rows) > 1 else np.zeros(1, int)
        ids = node[rows]
        found = ids[label] != ids
        return pa.RecordBatch.from_arrays([pa.array(ids[label][found]), pa.array(ids[found])], names=["u", "v"])

    return per_group(sent, "task", compare, "u long, v long")


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3,
                       percent: int = 90, extra: int = EXTRA_PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id): one row for each row of ``docs``.

    Two documents link when 100 * intersection >= ``percent`` * union of their sets of distinct
    ``width``-word shingles; ``component_id`` is the least id reachable by links.
    """
    ship_code(docs.sparkSession)
    full = written(shingle_prefixes(docs, doc_id, text, width, percent, extra), "ngram-prefixes")
    same = ["n", "k1", "k2"]
    base = written(full.select("doc_id", *same), "ngram-sets")
    classes = written(base.filter("n > 0 and doc_id is not null").groupBy(*same)
                      .agg(F.min("doc_id").alias("class_id")), "ngram-classes")
    spread = classes.filter("n > 1").select("class_id", *same)
    classed = written(base.filter("n > 0").join(classes, same).select("doc_id", *same, "class_id"), "ngram-classed")
    # one row of one document of a class goes on; only the rows of copies and repeated ids are shuffled to find it
    odd = written(classed.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"), F.max(F.col("doc_id") != F.col("class_id")).alias("copy"))
                  .filter("rows > 1 or copy").select("doc_id"), "ngram-odd")
    keyed = full.filter(F.size("prefixes") > 0)
    alone = unlikely_in(keyed, "doc_id", odd, ODD_BITMAP).filter("doc_id is not null")
    chosen = likely_in(keyed, "doc_id", odd, ODD_BITMAP).join(
        spread.withColumnRenamed("class_id", "doc_id"), ["doc_id", *same], "left_semi").dropDuplicates(["doc_id", *same])
    ties = candidate_ties(alone.unionByName(chosen))
    discard(full)
    groups = connected_components(ties)
    sizes = spread.groupBy(F.col("class_id").alias("doc_id")).agg(F.max("n").alias("n"))
    links = verified_links(groups, docs, sizes, doc_id, text, width, percent)
    # an id with several texts heads or belongs to several classes: they are one document
    several = classed.filter("doc_id <> class_id").select(F.col("class_id").alias("u"), F.col("doc_id").alias("v"))
    merged = connected_components(links.union(several))
    rows = base.select("doc_id", "n").join(
        merged.withColumnRenamed("node", "doc_id").filter("doc_id is not null"), "doc_id", "left")
    return rows.select("doc_id", F.col("n").alias("n_shingles"),
                       F.coalesce("component", "doc_id").alias("component_id"))
