"""Quality rules as a short-circuit cascade, in built-in functions only.

Every rule says when a text fails. On a bounded sample the rules' failures and run times are measured, and the rules run in
the order of rejections per second, each counted among the texts that those before it leave: a text that one rule has rejected
reaches no later rule. The order changes the work, never the verdict, which is that no rule fails.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pixelspark.llm.common import stored, text_or_empty

SPACE = r"[\x20\x09-\x0D]"
BLANKS = " \t\n\x0b\x0c\r"
#: About as many rows as the order of the rules is decided on, and how often they are run through in the longer of two timings.
SAMPLE_ROWS, REPEAT = 400, 5


@dataclass(frozen=True)
class Rule:
    """``steps`` are columns the rule needs, made in turn and only for texts still in; ``fails`` is over them."""

    name: str
    fails: str
    steps: dict[str, str] = field(default_factory=dict)


_N = "size(words)"
#: A window is repeated if its words are. Hashes rule out almost every text; where two agree, the words decide.
REPEATS = {
    "word_hash": "transform(words, w -> xxhash64(w))",
    "windows": f"if({_N} < 5, cast(array() as array<bigint>), transform(sequence(0, {_N} - 5), i -> xxhash64(word_hash[i], word_hash[i + 1], word_hash[i + 2], word_hash[i + 3], word_hash[i + 4])))",
    "sorted_windows": "if(size(array_distinct(windows)) = size(windows), null, sort_array(transform(windows, (h, i) -> named_struct('h', h, 's', array(words[i], words[i + 1], words[i + 2], words[i + 3], words[i + 4]), 'i', i))))",
    "places": "if(sorted_windows is null, cast(array() as array<int>), sort_array(transform(filter(transform(sorted_windows, (x, k) -> named_struct('i', x.i, 'hit', coalesce(x.h = get(sorted_windows, k - 1).h and x.s = get(sorted_windows, k - 1).s, false) or coalesce(x.h = get(sorted_windows, k + 1).h and x.s = get(sorted_windows, k + 1).s, false))), x -> x.hit), x -> x.i)))",
    "n_repeat_words": "aggregate(transform(places, (p, k) -> least(5, coalesce(get(places, k + 1) - p, 5))), 0L, (a, x) -> a + x)",
}
WORD_CHARS = {"word_chars": "cast(length(array_join(words, '')) as bigint)"}
SYMBOLS = {"n_symbols": "cast(length(body) - length(regexp_replace(body, '[#*$%&|<>]', '')) as bigint)"}
LINES = {"lines": r"filter(split(body, '\n'), x -> x rlike '[^\\x20\\x09-\\x0D]')",
         "n_dup_lines": "cast(size(lines) - size(array_distinct(lines)) as bigint)"}
ADJACENT = {"n_stutter": f"if({_N} < 2, 0, size(filter(sequence(1, {_N} - 1), i -> words[i] = words[i - 1])))"}

RULES = (
    Rule("few_words", f"{_N} < 10"),
    Rule("repeated_windows", f"100 * n_repeat_words > 20 * {_N}", REPEATS),
    Rule("symbols", f"100 * n_symbols > 10 * {_N}", SYMBOLS),
    Rule("repeated_lines", "100 * n_dup_lines > 40 * size(lines)", LINES),
    Rule("word_length", f"word_chars < 2 * {_N} or word_chars > 15 * {_N}", WORD_CHARS),
    Rule("stutter", f"100 * n_stutter > 30 * {_N}", ADJACENT),
)


def with_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``body``, the text with null as empty, and ``words``."""
    trimmed = docs.withColumn("body", text_or_empty(text)).withColumn("trimmed", F.btrim("body", F.lit(BLANKS)))
    return trimmed.withColumn("words", F.when(F.col("trimmed") == "", F.array().cast("array<string>"))
                              .otherwise(F.split("trimmed", f"{SPACE}+"))).drop("trimmed")


def measured(df: DataFrame, steps: dict[str, str]) -> DataFrame:
    for name, text in steps.items():
        df = df.withColumn(name, F.expr(text))
    return df


def cascade(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Adds ``rejected_by``, the first rule that fails or null. Columns that exist already are not made again."""
    have, made = set(df.columns), set()
    df = df.withColumn("rejected_by", F.lit(None).cast("string"))
    still: Column = F.col("rejected_by").isNull()
    for rule in rules:
        for name, text in rule.steps.items():
            if name not in have:
                df = df.withColumn(name, F.when(still, F.expr(text)))
                made.add(name)
        df = df.withColumn("rejected_by", F.when(still, F.when(F.expr(rule.fails), F.lit(rule.name))).otherwise(F.col("rejected_by")))
    return df.drop(*made)


def ordered_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by rejections per second, each among the texts that those before it leave, then among all;
    ties keep the given order.

    The sample is a share of all rows, taken in every split, that makes about ``rows`` texts; which texts it takes changes the
    order of the rules, never a verdict. A rule's cost is what ``REPEAT`` - 1 further passes over the sample take: starting a job
    is in both times and falls out. The verdicts on the sample come to the driver, a flag for each rule and text.
    """
    total = docs.count()
    if not total:
        return list(rules)
    sample = stored(with_words(docs.select("text").sample(min(1.0, rows / total), seed=7)).select("body", "words"), "sample")
    again = sample.withColumn("_n", F.explode(F.sequence(F.lit(1), F.lit(REPEAT)))).drop("_n")
    cost = {}
    for rule in rules:
        took = []
        for df in (sample, sample, again):  # the first run compiles
            probe = measured(df, rule.steps).agg(F.count_if(F.expr(rule.fails)))
            began = time.perf_counter()
            probe.first()
            took.append(time.perf_counter() - began)
        cost[rule.name] = max(took[2] - took[1], 1e-4) / (REPEAT - 1)
    steps = {name: text for rule in rules for name, text in rule.steps.items()}
    seen = measured(sample, steps).select(*[F.coalesce(F.expr(r.fails), F.lit(False)).alias(r.name) for r in rules]).collect()
    left, out, every = list(rules), [], seen
    while left:
        best = max(left, key=lambda r: (sum(x[r.name] for x in seen) / cost[r.name], sum(x[r.name] for x in every) / cost[r.name]))
        left.remove(best)
        out.append(best)
        seen = [x for x in seen if not x[best.name]]
    return out


def scored(docs: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """All measures and the verdict of each text: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, rejected_by, kept.

    The measures are wanted for every text, so they are made before the cascade; rules that need more are cut short.
    Null and empty texts have no words and fail. Repeated rows give repeated rows; other columns are not read.
    """
    rules = ordered_rules(docs) if rules is None else rules
    df = with_words(docs.select("doc_id", "text"))
    df = measured(df, WORD_CHARS | SYMBOLS | LINES | REPEATS)
    df = cascade(df, rules)
    n = F.size("words")
    failed = (n < 10) | (100 * F.col("n_repeat_words") > 20 * n)
    return df.select("doc_id", n.cast("long").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                     failed.alias("base_failed"), "rejected_by", (~failed & F.col("rejected_by").isNull()).alias("kept"))


def kept(docs: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """The rows whose text no rule rejects, with their own columns; null and empty texts go."""
    rules = ordered_rules(docs) if rules is None else rules
    own = F.struct(*docs.columns).alias("row")
    df = with_words(docs.select(own, F.col("text")))
    # a filter is pushed through columns by writing them out, which would repeat the rules; not through a row number
    done = cascade(df, rules).select("row", "rejected_by", F.monotonically_increasing_id().alias("at"))
    return done.where(F.col("rejected_by").isNull() & (F.col("at") >= 0)).select("row.*")
