"""Personal data: candidate generation and gradient boosting, in DataFrame functions alone.

Generators (regular expressions) propose spans of four kinds, with overlaps: the base pattern of
each kind, and stricter or looser ones that also find what a base match swallowed (a phone number
followed by a card number) or writes differently. Grouped card numbers are proposed at every group
start, phone numbers with every number of groups at their end, so that a number before or behind
hides neither. A validator belongs to each kind (octets, Luhn,
digit counts). Base matches that pass it are always kept.

The other candidates are chosen by boosted regression trees over format and context features that
leave the validator out. A candidate's label is whether it is personal as far as the text around it tells: it passes its
validator, and no word for another sort of number (an order, a ticket, a version) names it. A validator also lets some
foreign numbers pass by chance (Luhn's check one in ten), so where few numbers of one format and context pass, those that
do are no cards either. Trees score all of that by format and context; calibration makes it a decision: on a fifth of
the documents that grew no tree, and there outside base spans, the number of personal candidates above a score is estimated
as what passes beyond chance, and each kind's threshold is the score at which the estimate for all it lets in exceeds ``share`` of
them by the most. Where the fifth has fewer than ``CALIBRATING`` valid candidates of a kind, all documents set its threshold, and
without any at all the validator alone decides.

Training needs the counts of each feature combination only: one aggregate over all candidates of all documents, whose size is
bounded by the product of the feature ranges. A candidate is added if it passes
its validator, reaches the threshold and overlaps no base span. Of overlapping additions the one that overlaps the fewest
others stays, then the longest, then the best; a phone number (only its digits are counted) comes after the other kinds.

Offsets are code points, end exclusive. A null text has no spans. Repeated rows are treated one by one
and give equal results.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardflow.llm.common import discard, written

KINDS = ("email", "ip", "card", "phone")
_LOCAL, _HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"

#: kind -> patterns; the first is the base pattern in a form that never scans a run twice: possessive
#: repeats, and starts only where a leftmost search can start a match.
GENERATORS: dict[str, tuple[str, ...]] = {
    "email": (
        rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_HOST}++(?:\.{_HOST}++)++",
        rf"(?<!{_LOCAL}){_LOCAL}{{1,64}} ?(?:\(at\)|\[at\]) ?{_HOST}{{1,63}}"
        rf"(?: ?(?:\.|\(dot\)|\[dot\]) ?{_HOST}{{1,63}}){{1,4}}",
    ),
    "ip": (
        r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])",
    ),
    "card": (
        r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
        r"(?<![0-9A-Za-z])[0-9]{13,19}(?![0-9A-Za-z])",
        r"(?<![0-9A-Za-z])(?=([0-9]{4}(?:[\x20-][0-9]{4}){3})(?![0-9A-Za-z])((?s:.?)))[0-9]",
    ),
    "phone": (
        r"\+[0-9][\x20().0-9-]+[0-9]",
        *(rf"\+[0-9]{{1,3}}[\x20.-]?(?:\([0-9]{{2,4}}\)|[0-9]{{2,4}})(?:[\x20.-]{{1,2}}[0-9]{{2,4}}){{{n}}}(?![0-9])"
          for n in (3, 2, 1)),
        r"(?<![0-9A-Za-z+(])\([0-9]{3}\)[\x20.-]?[0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z])",
    ),
}
#: Generators whose matches may overlap: the pattern looks ahead and takes one character; group 1 is the
#: candidate, group 2 the character behind it.
LOOKING_AHEAD = {("card", 2)}
#: A text without a match of these has no candidate of the kind.
TRIGGERS = {"email": r"@|[\(\[]at[\)\]]", "ip": r"[0-9]\.[0-9]++\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}",
            "phone": r"\+[0-9]|\([0-9]{3}\)"}
_WORDS = {"email": "mail|contact|write", "ip": r"\bip\b|host|server|address", "card": "card|visa|credit|pay",
          "phone": "phone|call|tel|mobile|fax"}
#: Directly before a number: it is one of another sort.
_FOREIGN = (r"\b(?:order|invoice|ticket|tracking|parcel|serial|batch|sku|isbn|part|item|reference|ref|version|release|build|section)s?"
            r"(?: (?:no|nr|number|id|code))?[.:#\x20]{1,3}$")
CONTEXT = 24
#: Classes of ``word``: none, one of the kind nearby, one of another sort of number.
NO_WORD, OWN_WORD, FOREIGN_WORD = 0, 1, 2
FEATURES = ("kind", "generator", "length", "separators", "before", "after", "word", "lead")
#: Share of foreign numbers that pass the kind's validator by chance.
CHANCE = {"email": 0.0, "ip": 0.0, "card": 0.1, "phone": 0.0}
#: Valid candidates of a kind that the held-out documents need to set its threshold.
CALIBRATING = 50


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once: a lambda variable instead of a repeated expression."""
    return F.transform(F.array(value), body)[0]


def _running(steps: Column, block: int = 64) -> Column:
    """Prefix sums of an int array, by blocks: about n * (block + n / block**2) additions."""
    zero = F.lit(0)
    add = lambda a, x: a + x
    sums = F.transform(F.sequence(zero, F.ceil(F.size(steps) / block).cast("int") - 1),
                       lambda b: F.aggregate(F.slice(steps, b * block + 1, block), zero, add))

    def spread(starts: Column) -> Column:
        return F.transform(steps, lambda _, i: F.get(starts, F.floor(i / block).cast("int")) + F.aggregate(
            F.slice(steps, F.floor(i / block).cast("int") * block + 1, F.pmod(i, F.lit(block)) + 1), zero, add))

    return _let(sums, lambda b: _let(F.transform(b, lambda _, i: F.aggregate(F.slice(b, 1, i), zero, add)), spread))


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Luhn's check of a digit string."""
    value = F.regexp_extract_all(F.reverse(digits), F.lit("[0-9]"), F.lit(0))
    total = F.aggregate(
        F.transform(value, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0))),
        F.lit(0), lambda a, x: a + x)
    return total % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    digits = _digits(match)
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return ~F.exists(F.split(match, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) > 3)
                         | (F.substring(F.concat(F.lit("000"), p), -3, 3).cast("int") > 255))
    if kind == "card":
        return F.length(digits).between(13, 19) & F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    return F.length(digits).between(9, 15)


def _side(c: Column) -> Column:
    """Class of a neighbouring character: none, space, letter or digit, other."""
    return F.when(c == "", 0).when(c.rlike(r"\s"), 1).when(c.rlike(r"[\p{L}\p{N}]"), 2).otherwise(3)


def _found(kind: str, generator: int, text: Column) -> Column:
    """Candidates of one generator: structs with span, validity and features."""

    pattern = GENERATORS[kind][generator]
    ahead = (kind, generator) in LOOKING_AHEAD
    every = lambda group: F.regexp_extract_all(text, F.lit(pattern), F.lit(group))

    def spans(hits: Column, pieces: Column, starts: Column, behind: Column) -> Column:
        def one(hit: Column, i: Column) -> Column:
            left, right = F.get(pieces, i), F.get(behind, i if ahead else i + 1)
            first = F.greatest(F.lit(1), i - 4)
            digits = F.length(_digits(hit))
            plain = F.length(F.regexp_replace(hit, r"[0-9A-Za-z]", ""))
            near = F.substring(left, -CONTEXT, CONTEXT) if not ahead else F.substring(F.array_join(F.transform(
                F.slice(pieces, first, i + 2 - first), lambda x: F.substring(x, -CONTEXT, CONTEXT)), "0"), -CONTEXT, CONTEXT)
            return F.struct(
                F.lit(KINDS.index(kind)).alias("kind"), F.get(starts, i).alias("start"),
                (F.get(starts, i) + F.length(hit)).alias("end"), _valid(kind, hit).alias("valid"),
                F.lit(generator).alias("generator"),
                F.least(F.lit(6), F.when(digits == 0, 0).otherwise(1 + F.floor(digits / 4))).cast("int").alias("length"),
                F.least(F.lit(5), plain).alias("separators"), _side(F.substring(left, -1, 1)).alias("before"),
                _side(F.substring(right, 1, 1)).alias("after"),
                _let(F.lower(near), lambda z: F.when(z.rlike(_FOREIGN) if kind != "email" else F.lit(False), FOREIGN_WORD)
                     .when(z.rlike(_WORDS[kind]), OWN_WORD).otherwise(NO_WORD)).alias("word"),
                (F.lit(10) if kind == "email" else F.regexp_extract(hit, "[0-9]", 0).cast("int")).alias("lead"))

        return F.transform(hits, one).cast(_ARRAY)

    def placed(hits: Column) -> Column:
        def steps(pieces: Column) -> Column:
            return F.transform(hits, lambda _, i: F.length(F.get(pieces, i))
                               + F.when(i > 0, F.lit(1) if ahead else F.length(F.get(hits, i - 1))).otherwise(0))

        return F.when(F.size(hits) == 0, F.expr(f"cast(array() as {_ARRAY})")).otherwise(
            _let(F.split(text, pattern, -1), lambda pieces: _let(
                steps(pieces), lambda st: _let(_running(st), lambda starts: _let(
                    every(2) if ahead else pieces, lambda behind: spans(hits, pieces, starts, behind))))))

    return _let(every(1 if ahead else 0), placed)


_ARRAY = ("array<struct<kind:int,start:int,end:int,valid:boolean,generator:int,length:int,separators:int,"
          "before:int,after:int,word:int,lead:int>>")


def candidates(text: Column) -> Column:
    """All proposed spans of a text, base matches (generator 0) included."""
    none = F.expr(f"cast(array() as {_ARRAY})")
    return F.concat(*[
        F.when(text.rlike(TRIGGERS[kind]), _found(kind, g, text)).otherwise(none)
        for kind in KINDS for g in range(len(GENERATORS[kind]))])


@dataclass(frozen=True)
class Boosted:
    """Trees as nested tuples: a number, or (feature, value, left, right) with left for
    ``feature <= value``; and the lowest accepted score of each kind."""

    start: float
    trees: tuple
    thresholds: tuple[float, ...]

    def score(self, candidate) -> Column:
        """Score (log odds) of a candidate struct."""
        def walk(tree) -> Column:
            if not isinstance(tree, tuple):
                return F.lit(float(tree))
            name, value, left, right = tree
            return F.when(candidate[name] <= value, walk(left)).otherwise(walk(right))

        total = F.lit(self.start)
        for tree in self.trees:
            total = total + walk(tree)
        return total

    def accepts(self, candidate) -> Column:
        bound = F.lit(float("inf"))
        for kind, least in enumerate(self.thresholds):
            bound = F.when(candidate["kind"] == kind, F.lit(least)).otherwise(bound)
        return candidate["valid"] & (self.score(candidate) >= bound)


def _grow(x: np.ndarray, gradient: np.ndarray, weight: np.ndarray, depth: int, rate: float):
    """A regression tree by Newton gains over counted feature combinations."""
    g, h = gradient.sum(), weight.sum()
    best = (1e-6, None, None)
    if depth:
        for j in range(x.shape[1]):
            for value in np.unique(x[:, j])[:-1]:
                left = x[:, j] <= value
                gl, hl = gradient[left].sum(), weight[left].sum()
                gain = gl * gl / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g * g / (h + 1)
                if gain > best[0]:
                    best = (gain, j, value)
    if best[1] is None:
        return float(rate * g / (h + 1))
    left = x[:, best[1]] <= best[2]
    return (FEATURES[best[1]], int(best[2]), _grow(x[left], gradient[left], weight[left], depth - 1, rate),
            _grow(x[~left], gradient[~left], weight[~left], depth - 1, rate))


def _evaluate(tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), float(tree))
    name, value, left, right = tree
    low = x[:, FEATURES.index(name)] <= value
    return np.where(low, _evaluate(left, x), _evaluate(right, x))


def proposed(docs: DataFrame, text: str = "text", name: str = "__pii") -> DataFrame:
    """``docs`` with a struct ``name``: all ``found`` candidates, and whether the text is in the ``held`` out fifth."""
    body = F.coalesce(F.col(text), F.lit(""))
    held = F.pmod(F.crc32(body.cast("binary")), F.lit(5)) == 0
    return docs.withColumn(name, F.struct(held.alias("held"), candidates(body).alias("found")))


def fit(docs: DataFrame, text: str = "text", **settings) -> Boosted:
    """Train on all candidates of ``docs``, written once without the texts; settings as in ``fit_proposed``."""
    found = written(proposed(docs.select(text), text).select("__pii"), "pii-candidates")
    model = fit_proposed(found, **settings)
    discard(found)
    return model


def fit_proposed(found: DataFrame, name: str = "__pii", rounds: int = 24, depth: int = 3, rate: float = 0.4,
                 share: float = 0.25) -> Boosted:
    """Train on the candidates in column ``name`` (of ``proposed``); only counts per feature combination
    reach the driver. ``share``: the least part of personal data among what a threshold lets in."""
    marked = _let(F.col(f"{name}.found"), lambda every: _let(_base(every), lambda base: F.transform(
        every, lambda c: F.struct(c.alias("c"), _addable(c, base).alias("free")))))
    rows = found.select(F.col(f"{name}.held").alias("held"), F.explode(marked).alias("m")).select("held", "m.*")
    counts = rows.groupBy("held", "free", *[F.col(f"c.{f}").alias(f) for f in FEATURES]).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("c.valid").alias("valid")).collect()
    if not counts:
        return Boosted(0.0, (), (float("-inf"),) * len(KINDS))
    counts.sort(key=lambda r: tuple(r))
    x = np.array([[r[f] for f in FEATURES] for r in counts])
    n, valid = (np.array([float(r[c]) for r in counts]) for c in ("n", "valid"))
    named = x[:, FEATURES.index("word")] == FOREIGN_WORD
    good = np.where(named, 0.0, valid)
    held, free = (np.array([r[c] for r in counts]) for c in ("held", "free"))
    grown = ~held if (~held).any() else held | True
    start = float(np.log((good[grown].sum() + 1) / ((n - good)[grown].sum() + 1)))
    score = np.full(len(x), start)
    trees = []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        tree = _grow(x[grown], (good - n * p)[grown], (n * p * (1 - p))[grown], depth, rate)
        trees.append(tree)
        score += _evaluate(tree, x)
    thresholds = []
    for k, kind in enumerate(KINDS):
        chance = CHANCE[kind]
        personal = (good - chance * np.where(named, 0.0, n)) / (1 - chance)  # what passes beyond chance
        rows_of = free & (x[:, 0] == k)
        part = rows_of & held if valid[rows_of & held].sum() >= CALIBRATING else rows_of
        thresholds.append(_threshold(score[part], (personal - share * valid)[part]) if valid[part].any() else float("-inf"))
    return Boosted(start, tuple(trees), tuple(thresholds))


def _threshold(score: np.ndarray, gain: np.ndarray) -> float:
    """The score from which on the summed ``gain`` is greatest (the lowest of equals); infinity if it is never positive."""
    values, place = np.unique(-score, return_inverse=True)
    total = np.cumsum(np.bincount(place, weights=gain))
    best = np.flatnonzero(total >= total.max() - 1e-9)[-1]
    return float(-values[best] - 1e-9) if total[best] >= 0 else float("inf")


def _overlap(a, b) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def _base(found: Column) -> Column:
    return F.filter(found, lambda c: (c["generator"] == 0) & c["valid"])


def _addable(c, base: Column) -> Column:
    return (c["generator"] > 0) & ~F.exists(base, lambda b: _overlap(b, c))


def with_spans(docs: DataFrame, model: Boosted, text: str = "text", name: str = "__pii") -> DataFrame:
    """``docs`` with a struct ``name``: ``base`` and ``all`` spans, arrays of (kind, start, end) by
    kind, then start. One pass, no shuffle."""
    return chosen(proposed(docs, text, name), model, name)


def chosen(found: DataFrame, model: Boosted, name: str = "__pii") -> DataFrame:
    """The candidates in column ``name`` (of ``proposed``) replaced by the spans that stay."""
    slim = lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"))

    def choose(every: Column, base: Column) -> Column:
        added = F.filter(every, lambda c: model.accepts(c) & _addable(c, base))
        others = lambda c, all_: F.size(F.filter(all_, lambda o: _overlap(o, c) & (
            (o["start"] != c["start"]) | (o["end"] != c["end"]))))
        ranked = _let(added, lambda all_: F.array_sort(F.transform(all_, lambda c: F.struct(
            (c["kind"] == KINDS.index("phone")).alias("counted"), others(c, all_).alias("others"),
            (c["start"] - c["end"]).alias("size"), (-model.score(c)).alias("rank"), c["start"].alias("start"),
            c["end"].alias("end"), c["kind"].alias("kind")))))
        extra = F.aggregate(ranked, F.expr("cast(array() as array<struct<kind:int,start:int,end:int>>)"),
                            lambda kept, c: F.when(F.exists(kept, lambda k: _overlap(k, c)), kept)
                            .otherwise(F.concat(kept, F.array(slim(c)))))
        return _let(F.transform(base, slim), lambda spans: F.struct(
            F.array_sort(spans).alias("base"), F.array_sort(F.concat(spans, extra)).alias("all")))

    return found.withColumn(name, _let(F.col(f"{name}.found"), lambda every: _let(
        _base(every), lambda base: choose(every, base))))


def counted(spans: Column, kind: str) -> Column:
    """Number of spans of a kind. Spark hands a second parameter of the lambda, even one with a default, the index."""
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind)))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every run of overlapping spans replaced by ``[KIND]`` of its first span."""
    body = F.coalesce(text, F.lit(""))
    by_start = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                                                  s["kind"].alias("kind"))))
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state, s):
        inside = s["start"] < state["at"]
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.when(inside, state["out"]).otherwise(F.concat(
                state["out"], F.substring(body, state["at"] + 1, s["start"] - state["at"]), F.get(names, s["kind"])))
            .alias("out"))

    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(
        by_start, first, step, lambda z: F.concat(z["out"], F.substring(body, z["at"] + 1, F.length(body)))))
