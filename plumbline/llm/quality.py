"""Quality rules as a short-circuit cascade, in DataFrame operations alone.

Every rule is an SQL condition that rejects a document. On a bounded sample each rule is timed and its rejections are counted; the rules are
then ordered by rejections per second, and the verdict is one CASE expression, so a document that an early rule rejects never pays for the
later ones. The order changes what a run costs, never what it returns: a document is kept if no rule rejects it.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.shared import staged

#: Rows of the sample that costs and rejections are estimated on, about; it only settles the order.
SAMPLE_ROWS = 2000
SYMBOLS = "#*$%&|<>"

#: One array of whole words, one of lines that hold a word, and the hashes of all windows of five words.
SPACE = r"\t\n\u000B\u000C\r"
BASE = {
    "words": rf"filter(split(translate(text, '{SPACE}', '     '), ' ', -1), w -> w <> '')",
    "lines": rf"filter(split(text, '\n', -1), l -> translate(l, ' {SPACE}', '') <> '')",
}
WINDOWS = "transform(CASE WHEN size(words) >= 5 THEN sequence(0, size(words) - 5) ELSE array() END, i -> xxhash64(get(words, i), get(words, i + 1), get(words, i + 2), get(words, i + 3), get(words, i + 4)))"
#: Places of windows that occur again, in order; a list in a list of one is named once and used often.
REPEATED = """element_at(transform(array(array_sort(transform(windows, (h, i) -> struct(h AS h, i AS i)))), s ->
  array_sort(transform(filter(s, (x, k) -> coalesce(x.h = get(s, k - 1).h, false) OR coalesce(x.h = get(s, k + 1).h, false)), x -> x.i))), 1)"""
COVERED = """CASE WHEN size(array_distinct(windows)) = size(windows) THEN 0L ELSE
  element_at(transform(array(%s), p -> aggregate(transform(p, (x, k) -> least(5, coalesce(get(p, k + 1), x + 5) - x)), 0L, (n, x) -> n + x)), 1) END""" % REPEATED


def measured(docs: DataFrame) -> DataFrame:
    """`docs` with n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words (all long) of the whole text; NULL text is empty.

    Words are parted by ASCII white space; lines by newlines, and only lines with a word count. Columns of `docs` with these names are
    replaced.
    """
    names = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
    kept = docs.drop(*names).columns
    held = docs.drop(*names).select(*(F.col(c).alias(f"_kept_{c}") for c in kept), F.coalesce("text", F.lit("")).alias("text"))
    split = held.select("*", *(F.expr(e).alias(k) for k, e in BASE.items())).withColumn("windows", F.expr(WINDOWS))
    return split.select(
        *(F.col(f"_kept_{c}").alias(c) for c in kept),
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("text", " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr(COVERED).alias("n_repeat_words"),
    )


@dataclass(frozen=True)
class Rule:
    """`rejects` is an SQL condition over text and the measures; NULL does not reject."""

    name: str
    rejects: str


RULES = (
    Rule("few_words", "n_words < 10"),
    Rule("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("repeated_lines", "10 * n_dup_lines > 3 * n_lines"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
    Rule("exclamations", "5 * (length(text) - length(translate(text, '!', ''))) > n_words"),
    Rule("capitals", r"2 * length(regexp_replace(text, '[^\\p{Lu}]', '')) > length(regexp_replace(text, '[^\\p{L}]', ''))"),
)


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    rejected: float
    seconds: float

    @property
    def worth(self) -> float:
        return self.rejected / max(self.seconds, 1e-6)


def least_hash(share: float) -> int:
    """The 64-bit hash below which about `share` of all hashes lie."""
    return int(share * 2.0**64 - 2.0**63)


def estimates(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> list[Estimate]:
    """Share of rejections and seconds of each rule on a sample of `docs`, the most rejections per second first (ties by name)."""
    total = docs.count()
    share = min(1.0, sample_rows / max(1, total))
    picked = docs.where(F.xxhash64(F.lit(11), "doc_id", "text") < least_hash(share)) if share < 1 else docs
    few = staged(picked.select("doc_id", "text"), "rule-rows")  # the whole scan in parallel; only what it picks comes together
    sample = staged(measured(few).coalesce(1), "rule-sample")
    size = max(1, sample.count())

    def timed(condition: str) -> tuple[int, float]:
        best, found = float("inf"), 0
        for _ in range(2):
            began = time.perf_counter()
            found = sample.select(F.count_if(F.expr(condition))).first()[0]
            best = min(best, time.perf_counter() - began)
        return found, best

    _, idle = timed("length(text) < 0")
    found = []
    for rule in rules:
        rejected, seconds = timed(rule.rejects)
        found.append(Estimate(rule, rejected / size, max(seconds - idle, 1e-4)))
    return sorted(found, key=lambda e: (-e.worth, e.rule.name))


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """`docs` (doc_id, text and any others) with the measures and `rejected_by`, the first rule of the cascade that rejects (NULL: kept).

    Rows are neither dropped nor merged; NULL or empty text has no words and falls to the rule on few words. Of several rules that reject a
    document, `rejected_by` names the one that came first in this run. A column rejected_by of `docs` is replaced.
    """
    order = [e.rule for e in estimates(docs, rules, sample_rows)]
    verdict = "CASE " + " ".join(f"WHEN {r.rejects} THEN '{r.name}'" for r in order) + " END" if order else "CAST(NULL AS string)"
    return measured(docs.drop("rejected_by")).withColumn("rejected_by", F.expr(verdict))
