"""Quality rules as a short-circuit cascade, with DataFrame functions alone.

Each rule is one boolean expression over a text. Its cost and selectivity are measured on a bounded sample of raw texts; the cascade
is one CASE expression with the rules by rejections per second, so a document that a cheap rule rejects never reaches a costly one.
:func:`quality_rules` returns counts of every document, so these are computed for all and only the rest of a rule is spared;
:func:`accepted` returns documents alone, and what a rule needs is computed when its turn comes.
The order changes what is computed, never which documents are kept.
"""

from __future__ import annotations

import dataclasses
import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BLANK = r"[\x20\x09-\x0D]+"
_SYMBOLS = r"[#*$%&|<>]"
_MADE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "__text", "__w"]
#: Rows on which rules are timed.
SAMPLE = 1_000
#: Stands among the costs of rules for that of taking texts apart into words.
SPLIT = "(words)"


class Measures:
    """What rules are made of: the counts as columns that are there already, or as expressions over a text and its words."""

    def __init__(self, text: Column | None = None, words: Column | None = None):
        self._text, self._words = text, words

    def __getattr__(self, name: str) -> Column:
        if self._text is None:
            return F.col("__text" if name == "text" else name)
        made = {"n_words": lambda: F.size(self._words).cast("long"), "n_repeat_words": lambda: n_repeat_words(self._words), "word_chars": lambda: word_chars(self._text), "n_symbols": lambda: n_symbols(self._text), "n_dup_lines": lambda: n_dup_lines(self._text), "text": lambda: self._text}
        return made[name]()


@dataclasses.dataclass(frozen=True)
class Rule:
    """fails gives a condition over measures, true for a row to reject."""

    name: str
    fails: Callable[[Measures], Column]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once though body names it often, also inside its own lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, _BLANK), "")


def word_chars(text: Column) -> Column:
    return F.length(F.regexp_replace(text, _BLANK, "")).cast("long")


def n_symbols(text: Column) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, _SYMBOLS, ""))).cast("long")


def n_dup_lines(text: Column) -> Column:
    return let(F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def n_repeat_words(w: Column) -> Column:
    """Words covered by 3-word windows found twice or more.

    Windows are sorted as longs that hold the high bits of their fingerprint and, below, their place: neighbours with equal
    high bits repeat. Should full fingerprints differ among those (a clash of the high bits), whole fingerprints are sorted.
    """
    prints = F.transform(F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))

    def covered(places: Column) -> Column:
        return let(F.sort_array(places), lambda p: F.aggregate(F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3)))), F.lit(0).cast("long"), lambda a, x: a + x))

    def exact(h: Column) -> Column:
        def repeated(s: Column) -> Column:
            return F.transform(F.filter(s, lambda x, i: (x["h"] == F.get(s, F.greatest(i - 1, F.lit(0)))["h"]) & (i > 0) | (x["h"] == F.coalesce(F.get(s, i + 1)["h"], x["h"] + 1))), lambda x: x["p"])

        return covered(let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p")))), repeated))

    def quick(h: Column) -> Column:
        bits = F.length(F.bin(F.size(h)))
        low = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1

        def of(low: Column) -> Column:
            def clash(c: Column) -> Column:
                return F.exists(F.sequence(F.lit(1), F.size(c) - 1), lambda i: (F.get(c, i).bitwiseXOR(F.get(c, i - 1)).bitwiseAND(F.bitwise_not(low)) == 0) & (F.get(h, F.get(c, i).bitwiseAND(low).cast("int")) != F.get(h, F.get(c, i - 1).bitwiseAND(low).cast("int"))))

            def decide(c: Column) -> Column:
                return F.when(F.size(c) < 2, F.lit(0).cast("long")).when(clash(c), exact(h)).otherwise(covered(F.transform(c, lambda x: x.bitwiseAND(low).cast("int"))))

            high = F.bitwise_not(low)
            packed = F.sort_array(F.transform(h, lambda x, i: x.bitwiseAND(high).bitwiseOR(i.cast("long"))))
            def alike(x: Column, y: Column) -> Column:
                return x.bitwiseXOR(F.coalesce(y, F.bitwise_not(x))).bitwiseAND(high) == 0

            near = let(packed, lambda s: F.filter(s, lambda x, i: alike(x, F.get(s, i - 1)) | alike(x, F.get(s, i + 1))))
            return let(near, decide)

        return let(low, of)

    return F.when(F.size(w) < 4, F.lit(0).cast("long")).otherwise(let(prints, quick))


def measures(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text and any others) with __text (null read as empty) and the counts that rules use."""
    docs = docs.drop(*_MADE)
    text = F.col("__text")
    counted = docs.withColumn("__text", F.coalesce("text", F.lit(""))).withColumn(
        "__w", let(words(text), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), n_repeat_words(w).alias("n_repeat_words")))
    )
    return counted.select(*docs.columns, "__text", "__w.n_words", word_chars(text).alias("word_chars"), n_symbols(text).alias("n_symbols"), n_dup_lines(text).alias("n_dup_lines"), "__w.n_repeat_words")


def base_failed() -> Column:
    """Too few words, or most words in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


#: The two base conditions as rules.
BASE = (Rule("few_words", lambda m: m.n_words < 50), Rule("repeated_windows", lambda m: 100 * m.n_repeat_words > 50 * m.n_words))

#: The rules of production. Bounds are shares of the words, of their characters or of the lines.
RULES = (
    Rule("symbols", lambda m: 10 * m.n_symbols > m.n_words),
    Rule("word_length", lambda m: let(m.word_chars, lambda c: (c < 3 * m.n_words) | (c > 12 * m.n_words))),
    Rule("exclamations", lambda m: 10 * (F.length(m.text) - F.length(F.replace(m.text, F.lit("!"), F.lit("")))) > m.n_words),
    Rule("capitals", lambda m: 2 * F.length(F.regexp_replace(m.text, r"\P{Lu}+", "")) > m.word_chars),
    Rule("repeated_lines", lambda m: 2 * m.n_dup_lines > F.length(F.regexp_replace(m.text, r"[^\n]+", "")) + 1),
)


class _Asked:
    """Stands for measures and notes which of them a rule asks for."""

    def __init__(self) -> None:
        self.names: set[str] = set()

    def __getattr__(self, name: str) -> Column:
        self.names.add(name)
        return F.col(name)


def needs_words(rule: Rule) -> bool:
    """Whether the rule needs the text taken apart into words."""
    asked = _Asked()
    rule.fails(asked)
    return not asked.names.isdisjoint({"n_words", "n_repeat_words"})


def costs(few: DataFrame, rules: Sequence[Rule], times: int = 8) -> dict[str, tuple[float, float]]:
    """Seconds that each rule takes for the rows of a small cached sample, and their spread: the difference of two runs.

    few holds the texts (__text), whose words are there before a rule is timed and are timed by themselves, as SPLIT; or what
    :func:`measures` makes, and the rules take its counts. Each rule goes through the sample and through ``times`` copies of it; the
    difference leaves out what any job costs, planning and compiling included.
    """
    counted = "n_words" in few.columns
    if not counted:
        few = few.select("__text", words(F.col("__text")).alias("__w")).persist()
    many = few.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.lit(times)))).drop("__copy").persist()

    def seconds(query: DataFrame) -> float:
        began = time.perf_counter()
        query.first()
        return time.perf_counter() - began

    m = Measures() if counted else Measures(F.col("__text"), F.col("__w"))
    timed = {rule.name: F.sum(rule.fails(m).cast("int")) for rule in rules}
    if not counted and any(map(needs_words, rules)):
        timed[SPLIT] = F.sum(F.size(words(F.col("__text"))))
    found = {}
    try:
        many.count()
        for name, made in timed.items():
            one, all_ = few.agg(made), many.agg(made)
            seconds(one)  # compiles
            least, a, b = seconds(one), seconds(all_), seconds(all_)
            found[name] = (max(min(a, b) - least, 1e-6) / (times - 1), abs(a - b) / (times - 1))
    finally:
        many.unpersist()
        if not counted:
            few.unpersist()
    return found


def plan(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE, counted: bool = True) -> list[tuple[Rule, float, float]]:
    """Rules with their share of rejections and seconds on a sample of at most sample_rows rows, best first.

    counted: the counts of :func:`measures` are there anyway and cost a rule nothing. Otherwise a rule is charged all that it computes,
    and taking a text apart into words is charged once, to the first rule that needs them. The sample is drawn once; rules are timed on
    a twentieth of it, in one partition.
    """
    n = docs.count()
    if not n or not rules:
        return [(r, 0.0, 0.0) for r in rules]
    drawn = docs.select("text").sample(min(1.0, 1.5 * sample_rows / n), seed=7).limit(sample_rows)
    sample = (measures(drawn).drop("text") if counted else drawn.select(F.coalesce("text", F.lit("")).alias("__text"))).persist()
    try:
        fails = (lambda r: r.fails(Measures())) if counted else (lambda r: let(words(F.col("__text")), lambda w: r.fails(Measures(F.col("__text"), w))))
        shares = sample.agg(F.count("*").alias("n"), *[F.sum(fails(r).cast("int")).alias(f"r{i}") for i, r in enumerate(rules)]).first()
        timed = sample.limit(max(1, sample_rows // 20)).coalesce(1).persist()
        try:
            cost = costs(timed, rules)
        finally:
            timed.unpersist()
    finally:
        sample.unpersist()
    left = [(r, (shares[f"r{i}"] or 0) / max(1, shares["n"]), cost[r.name][0]) for i, r in enumerate(rules)]
    split, found = cost.get(SPLIT, (0.0, 0.0))[0], []
    while left:
        charged = [(r, share, own + split * needs_words(r)) for r, share, own in left]
        best = max(range(len(left)), key=lambda i: charged[i][1] / max(charged[i][2], 1e-4))  # ties: the first
        found.append(charged[best])
        split *= not needs_words(left.pop(best)[0])
    return found


def _first_failed(order: Sequence[Rule], measures: Measures, rest: Column | None = None) -> Column:
    out = F.lit(None).cast("string") if rest is None else rest
    for rule in reversed(order):
        out = F.when(F.coalesce(rule.fails(measures), F.lit(False)), F.lit(rule.name)).otherwise(out)
    return out


def cascade(measured: DataFrame, order: Sequence[Rule]) -> Column:
    """Name of the first rule that rejects a row, later ones not computed; null for none."""
    return _first_failed(order, Measures())


def accepted(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE) -> DataFrame:
    """The rows of docs (text and any others) that the base conditions and every rule accept: those that quality_rules keeps.

    Nothing is computed but what the cascade comes to; texts are taken apart into words when a rule first needs them. Null and empty
    texts go; ties, repeated rows, null ids and other columns, whatever their names, do not matter. Texts are read whole. An empty table gives an empty one.
    """
    order = [r for r, _, _ in plan(docs, (*BASE, *rules), sample_rows, counted=False)]
    text = F.coalesce("text", F.lit(""))
    first = next((i for i, r in enumerate(order) if needs_words(r)), len(order))
    rest = let(words(text), lambda w: _first_failed(order[first:], Measures(text, w))) if first < len(order) else None
    return docs.filter(_first_failed(order[:first], Measures(text), rest).isNull())


def quality_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed and kept.

    kept is false if base_failed, else true unless a rule rejects. Null text reads as empty (no words, so base_failed). Ties,
    repeated rows and null ids do not matter: each row is judged alone, on its whole text. Columns of docs that bear a name made here
    are replaced, others kept. An empty table gives an empty one.
    """
    measured = measures(docs)
    order = [r for r, _, _ in plan(docs, rules, sample_rows)]
    flagged = measured.withColumn("base_failed", base_failed())
    return flagged.withColumn("kept", ~F.col("base_failed") & F.when(F.col("base_failed"), F.lit(False)).otherwise(cascade(measured, order).isNull())).drop("__text")


ORACLE = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n
      FROM (SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w))),
r AS (SELECT doc_id, count(DISTINCT j) AS n_repeat_words
      FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM g WHERE n > 1) GROUP BY doc_id),
m AS (SELECT w.doc_id, text, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN r ON w.doc_id = r.doc_id),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (
    10 * n_symbols > n_words OR word_chars < 3 * n_words OR word_chars > 12 * n_words
    OR 10 * (length(text) - length(replace(text, '!', ''))) > n_words
    OR 2 * length(regexp_replace(text, '\P{Lu}+', '', 'g')) > word_chars
    OR 2 * n_dup_lines > length(regexp_replace(text, '[^\n]+', '', 'g')) + 1) AS kept
FROM b
"""
