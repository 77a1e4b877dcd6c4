"""Quality rules as a short-circuit cascade, native Spark expressions only.

Each rule is a measure and a condition on it.  :func:`plan` estimates every rule's cost and rejection rate on
a sample and orders the rules by rejections per cost; :func:`cascade` then tests them in that order in one
nested CASE, so a row's later rules, and their measures, are not computed once one rejects it.  Measures that a
result shows anyway are computed once, before, and cost their rules nothing more.  The order changes only the work
done, never the verdict: a document is kept if no rule rejects it.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamellar.session import spread, table

from .expr import let, upto, window_hashes, words

SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: A rule that costs nothing measurable.
LEAST_SECONDS = 1e-4
#: Expected rows of the cost and selectivity sample, spread over all rows.  The sample only orders the rules.
SAMPLE_ROWS = 1000


def word_chars(text: Column) -> Column:
    """Code points in words."""
    return F.length(F.translate(F.coalesce(text, F.lit("")), " \t\n\x0b\f\r", "")).cast("long")


def n_words(text: Column) -> Column:
    return _count(words(text))


def _count(w: Column) -> Column:
    return F.size(w).cast("long")


def n_symbols(text: Column) -> Column:
    t = F.coalesce(text, F.lit(""))
    return (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long")


def _lines(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier one."""
    return let(_lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def n_lines(text: Column) -> Column:
    return F.size(_lines(text)).cast("long")


def n_repeat_words(text: Column) -> Column:
    """Words inside a 5-word window that the text has twice or more, the first one included."""
    return _repeated(words(text))


def _repeated(own: Column) -> Column:
    """The same from the words.  Most texts repeat no window; one hash set tells.  Only the others sort theirs."""

    def positions(w: Column) -> Column:
        def marked(s: Column) -> Column:
            same = lambda j, k: F.coalesce(F.get(s, k)["h"] == s[j]["h"], F.lit(False))
            return F.transform(F.filter(upto(F.size(s)), lambda j: same(j, j - 1) | same(j, j + 1)), lambda j: s[j]["i"])

        ordered = F.array_sort(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.array_sort(let(ordered, marked))

    def covered(p: Column) -> Column:
        gap = lambda j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - p[j], F.lit(WINDOW)))
        return F.aggregate(upto(F.size(p)), F.lit(0), lambda a, j: a + gap(j))

    def count(w: Column) -> Column:
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(let(positions(w), covered))

    hashes = F.transform(own, lambda x: F.xxhash64(x))
    return let(let(hashes, lambda h: window_hashes(h, WINDOW)), count).cast("long")


MEASURES = {"n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup_lines, "n_lines": n_lines, "n_repeat_words": n_repeat_words}


Measured = dict[str, Column]


@dataclass(frozen=True)
class Rule:
    """Rejects a document when ``rejects`` of the needed measures is true."""

    name: str
    needs: tuple[str, ...]
    rejects: Callable[[Measured], Column]


#: All conditions are over integers, so that every engine agrees on them.
BASE = (
    Rule("too_short", ("n_words",), lambda m: m["n_words"] < 10),
    Rule("repeated_windows", ("n_repeat_words", "n_words"), lambda m: 100 * m["n_repeat_words"] > 20 * m["n_words"]),
)
RULES = (
    *BASE,
    Rule("symbols", ("n_symbols", "n_words"), lambda m: 10 * m["n_symbols"] > m["n_words"]),
    Rule("duplicate_lines", ("n_dup_lines", "n_lines"), lambda m: 2 * m["n_dup_lines"] > m["n_lines"]),
    Rule("short_words", ("word_chars", "n_words"), lambda m: m["word_chars"] < 3 * m["n_words"]),
    Rule("long_words", ("word_chars", "n_words"), lambda m: m["word_chars"] > 12 * m["n_words"]),
)


def plan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, given: tuple[str, ...] = (), sample_rows: int = SAMPLE_ROWS) -> list[tuple[Rule, float, float]]:
    """Rules with (rejected share, marginal seconds) from a sample of the texts, best rejections per cost first.

    The sample holds what rules share, the words and the ``given`` measures; a rule's cost is the time of testing it,
    less that of reading the sample.  The first run of each test compiles it; the best of two more counts.
    """
    n_rows = docs.count()
    sample = docs.select("text").sample(min(1.0, sample_rows / max(n_rows, 1)), seed=11) if n_rows else docs.select("text")
    t, w = F.col("text"), F.col("words")
    sample = sample.withColumn("words", words(t)).select("text", "words", *(MEASURES[m](t).alias(m) for m in given)).cache()
    n = max(sample.count(), 1)
    measure = _shared(t, w) | {m: F.col(m) for m in given}

    def timed(condition: Column) -> tuple[int, float]:
        # Touching every cached column makes the empty test read what the others read.
        probe = sample.agg(F.count(F.when(condition, 1)), F.sum(F.hash("text", "words")))
        found, times = probe.head()[0], []
        for _ in range(2):
            began = time.perf_counter()
            probe.head()
            times.append(time.perf_counter() - began)
        return found, min(times)

    _, floor = timed(F.lit(False))
    out = []
    for r in rules:
        hits, seconds = timed(r.rejects(measure))
        out.append((r, hits / n, max(seconds - floor, LEAST_SECONDS)))
    sample.unpersist()
    return sorted(out, key=lambda x: (-x[1] / x[2], x[0].name))


def _shared(text: Column, own: Column) -> Measured:
    """All measures of a text whose words are known."""
    return {m: f(text) for m, f in MEASURES.items()} | {"n_words": _count(own), "n_repeat_words": _repeated(own)}


def cascade(ordered: list[Rule], measure: Measured) -> Column:
    """The first rule that rejects the row, null if none does; later rules are not evaluated."""
    out = F.when(ordered[0].rejects(measure), F.lit(ordered[0].name))
    for r in ordered[1:]:
        out = out.when(r.rejects(measure), F.lit(r.name))
    return out


#: Measures that :func:`verdicts` shows.
SHOWN = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def verdicts(docs: DataFrame) -> DataFrame:
    """doc_id, the shown measures, base_failed and kept of every document.

    The shown measures are computed once; other rules' measures only for rows that no rule before has rejected.  A
    null text has no words and is rejected.  Repeated rows are judged each for itself, texts are read
    whole, an empty table gives an empty result, and other columns are not read.
    """
    order = [r for r, _, _ in plan(docs, given=SHOWN)]
    t = F.col("text")
    measured = spread(docs.select("doc_id", "text")).select("doc_id", "text", *(MEASURES[m](t).alias(m) for m in SHOWN))
    by = {m: F.col(m) if m in SHOWN else f(t) for m, f in MEASURES.items()}
    base = BASE[0].rejects(by) | BASE[1].rejects(by)
    kept = F.when(base, False).otherwise(cascade([r for r in order if r not in BASE], by).isNull())
    return measured.select("doc_id", *SHOWN, base.alias("base_failed"), kept.alias("kept"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that no rule rejects, all columns; measures are computed only as the cascade needs them.

    The words, which several measures share, are split once.  Null texts have no words and go; texts are read whole;
    repeated rows are judged each for itself; an empty table gives an empty one.
    """
    order = [r for r, _, _ in plan(docs)]
    t = F.col("text")
    first = let(words(t), lambda w: cascade(order, _shared(t, w)))
    return spread(docs).where(first.isNull())


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: verdicts on all documents."""
    return verdicts(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM win) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM rep) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(cov.n, 0)::BIGINT AS n_repeat_words, len(ls)::BIGINT AS n_lines FROM w LEFT JOIN cov USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR 10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines
            OR word_chars < 3 * n_words OR word_chars > 12 * n_words) AS kept FROM m
"""
