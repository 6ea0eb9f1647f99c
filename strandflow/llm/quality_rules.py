"""Quality rules [native]: a threshold table compiled into one projection.

Per document the projection counts words, symbols, repeated lines, words in repeated
three-word windows and stop words; the rules are bounds on ratios of those counts. There
is no user function: windows are compared by xxhash64 of their three words, inside the row.

Defined results: a null or empty text has no words and fails the base rules; white space
alone likewise; repeated rows and equal doc_ids are judged row by row; a null doc_id
stays null; an empty table gives an empty table; further columns are not looked at, so
their names cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, words

#: Frequent words of English, French, Spanish and German.
STOP_WORDS = (
    "the of and to a in is that for it with as was on be by are this or an at from not "
    "de la le les et des du un une que qui dans en est pour par sur au il elle "
    "el los las se y con del una su al lo es "
    "der die das und den von zu mit ist ein eine auf im dem sich er sie"
).split()
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


@dataclass(frozen=True)
class Rule:
    """Keeps a document whose numerator / denominator lies within [low, high]; a zero denominator passes."""

    name: str
    numerator: str
    denominator: str
    low: float | None = None
    high: float | None = None

    def failed(self) -> Column:
        bottom = F.col(self.denominator)
        ratio = F.col(self.numerator) / F.when(bottom > 0, bottom)
        out = F.lit(False)
        if self.low is not None:
            out = out | (ratio < self.low)
        if self.high is not None:
            out = out | (ratio > self.high)
        return F.coalesce(out, F.lit(False))


RULES = (
    Rule("word_length", "word_chars", "n_words", 2.0, 15.0),
    Rule("symbols", "n_symbols", "n_words", None, 0.3),
    Rule("stop_words", "n_stop_words", "n_words", 0.02, None),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", None, 0.5),
)


def _covered(positions: Column) -> Column:
    """Words within three-word windows that begin at the given ascending positions."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    step = lambda a, p: F.struct((a["n"] + p + 3 - F.greatest(p, a["end"])).alias("n"), (p + 3).alias("end"))
    return F.aggregate(positions, start, step, lambda a: a["n"])


def measures(docs: DataFrame, *passed: str) -> DataFrame:
    """The counts of each row, beside the columns named in passed."""
    text = F.coalesce(F.col("text"), F.lit(""))
    keep = [F.col(c).alias(f"__{c}") for c in passed]
    kept = [f"__{c}" for c in passed]
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    d = docs.select(*keep, words(F.col("text")).alias("w"), lines.alias("l"), F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).alias("n_symbols"))
    stop = list(dict.fromkeys(STOP_WORDS))
    # the last two words begin no window
    grams = F.slice(F.transform("w", lambda x, i: F.xxhash64(x, F.get("w", i + 1), F.get("w", i + 2))), 1, F.greatest(F.size("w") - 2, F.lit(0)))
    d = d.select(
        *kept, "n_symbols", F.size("w").alias("n_words"), F.length(F.array_join("w", "")).alias("word_chars"),
        F.size(F.filter("w", lambda x: F.lower(x).isin(stop))).alias("n_stop_words"),
        F.size("l").alias("n_lines"), (F.size("l") - F.size(F.array_distinct("l"))).alias("n_dup_lines"), grams.alias("g"),
    )
    ordered = F.when(F.size(F.array_distinct("g")) < F.size("g"), F.sort_array(F.transform("g", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    d = d.select("*", ordered.alias("s")).drop("g")
    again = lambda x, j: F.coalesce(x["h"] == F.get("s", j)["h"], F.lit(False))
    found = F.filter(F.transform("s", lambda x, j: F.when(again(x, j - 1) | again(x, j + 1), x["i"])), lambda p: p.isNotNull())
    d = d.select("*", F.sort_array(found).alias("p")).drop("s")
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_stop_words", "n_lines")
    return d.select(*kept, *[F.col(c).cast("long").alias(c) for c in counts], F.coalesce(_covered(F.col("p")), F.lit(0)).cast("long").alias("n_repeat_words"))


def verdicts(measured: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Adds base_failed, failed_rules (names) and kept."""
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    failed = F.array_compact(F.array(*[F.when(r.failed(), F.lit(r.name)) for r in rules])) if rules else F.array().cast("array<string>")
    out = measured.withColumns({"base_failed": base, "failed_rules": failed})
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    out = verdicts(measures(docs, "doc_id"), rules)
    return out.select(F.col("__doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_stop_words", "n_lines", F.array_join("failed_rules", ",").alias("failed_rules"))


def passing(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows that the rules keep, with all their columns."""
    out = verdicts(measures(docs, *docs.columns), rules).withColumn("__row", F.monotonically_increasing_id())
    # the row number keeps the optimizer from copying the nested counts into the filter
    out = out.filter("kept AND __row >= 0")
    return out.select(*[F.col(f"__{c}").alias(c) for c in docs.columns])


def oracle_measures(source: str = "documents") -> str:
    """DuckDB SQL of measures() with verdicts, over a table with doc_id and text (doc_id is unique there)."""
    stop = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
    fails = [f"CASE WHEN coalesce({' OR '.join([f'{r.numerator} / nullif({r.denominator}, 0)::DOUBLE {op} {v}' for op, v in (('<', r.low), ('>', r.high)) if v is not None])}, false) THEN '{r.name}' END" for r in RULES]
    return rf"""
    SELECT *, NOT base_failed AND failed_rules = '' AS kept FROM (
      SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
        array_to_string(list_filter([{', '.join(fails)}], lambda x: x IS NOT NULL), ',') AS failed_rules
      FROM (
        SELECT d.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
          length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
          (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
          len(list_filter(ws, lambda x: lower(x) IN ({stop})))::BIGINT AS n_stop_words, len(ls)::BIGINT AS n_lines,
          coalesce(r.n, 0)::BIGINT AS n_repeat_words
        FROM (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
                list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM {source}) d
        LEFT JOIN (
          SELECT doc_id, sum(least(3, coalesce(nxt - i, 3))) AS n FROM (
            SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM (
              SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS k FROM (
                SELECT doc_id, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c FROM (
                  SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i
                  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM {source}))))
            WHERE k > 1) GROUP BY doc_id) r USING (doc_id)))"""
