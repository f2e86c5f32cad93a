"""Host-level quality rules.

Each document is measured against rules; failures are counted by host, and the
failure rate of each rule is shrunk towards the rate over all hosts with a beta
prior fitted to the hosts (moments of the beta-binomial).  A host whose shrunk
rate exceeds ``max_rate`` for any rule is rejected, and so is a document that
fails a rule on a host whose shrunk rate for it exceeds ``doc_rate``: what is a
slip on a good host is a habit on such a one.  Verdicts are joined back to the
host's documents, which stay only if they pass their own base rules as well.

The measures are SQL functions over a text's words, held in columns that are
evaluated once a row.  Besides host counts, nothing but what the caller asked
for is moved or kept.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm._common import fresh, staged

SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\x0b\f\r"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_SYMBOL_PERCENT = 25
MAX_DUP_LINE_PERCENT = 30


def with_measures(docs: DataFrame, text_col: str, out: str, window: int = 3) -> DataFrame:
    """``docs`` with a struct ``out`` of MEASURES (bigint each); a null text is empty.

    Windows of words are told apart by 64-bit hashes within their text.  Each step is a
    column of its own that several others name, so that the planner evaluates it once.  A
    caller's filter on ``out`` would undo that, as it is moved below columns by spelling
    them out; the row number, which adds nothing, keeps it above.
    """
    text, words, lines, grams, order, again = fresh([*docs.columns, out], "text", "words", "lines", "grams", "order", "again")
    c, n = F.col, F.size(words)
    has_word = lambda x: F.ltrim(F.translate(x, SPACE, " " * len(SPACE))) != ""
    starts = F.sequence(F.lit(0), n - window)
    steps = docs.withColumn(text, F.coalesce(F.col(f"`{text_col}`"), F.lit(""))) \
        .withColumn(words, F.filter(F.split(c(text), "[\x20\x09-\x0D]+"), lambda w: w != "")) \
        .withColumn(lines, F.filter(F.split(c(text), "\n"), has_word)) \
        .withColumn(grams, F.when(n > window, F.transform(starts, lambda i: F.xxhash64(
            *[F.get(c(words), i + k) for k in range(window)])))) \
        .withColumn(order, F.when(F.size(F.array_distinct(grams)) < F.size(grams), F.array_sort(
            F.transform(grams, lambda g, i: F.struct(g.alias("gram"), i.alias("at")))))) \
        .withColumn(again, F.filter(order, lambda x, i: x["gram"].eqNullSafe(F.get(c(order), i - 1)["gram"])
                                    | x["gram"].eqNullSafe(F.get(c(order), i + 1)["gram"])))
    covered = F.array_distinct(F.flatten(F.transform(again, lambda x: F.sequence(x["at"], x["at"] + (window - 1)))))
    without = lambda chars: F.length(text) - F.length(F.translate(c(text), chars, ""))
    nothing = F.when(F.monotonically_increasing_id() < 0, 1).otherwise(0)
    values = {"n_words": n + nothing, "word_chars": F.length(text) - without(SPACE), "n_symbols": without(SYMBOLS),
              "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
              "n_repeat_words": F.coalesce(F.size(covered), F.lit(0)), "n_lines": F.size(lines)}
    measured = F.struct(*[v.cast("bigint").alias(k) for k, v in values.items()])
    return steps.select(*[F.col(f"`{x}`") for x in docs.columns], measured.alias(out))


def rules(m: str) -> dict[str, Column]:
    """Failure of each rule over a struct column of measures."""
    f = lambda name: F.col(f"{m}.{name}")
    return {
        "short": f("n_words") < MIN_WORDS,
        "repeats": 100 * f("n_repeat_words") > MAX_REPEAT_PERCENT * f("n_words"),
        "symbols": 100 * f("n_symbols") > MAX_SYMBOL_PERCENT * f("word_chars"),
        "dup_lines": 100 * f("n_dup_lines") > MAX_DUP_LINE_PERCENT * f("n_lines"),
    }


BASE_RULES = ("short", "repeats")


def beta_prior(hosts: DataFrame, failures: str, total: str = "n") -> Column:
    """Struct (a, b): the beta prior of a rate, one row, as an aggregate over hosts.

    Moments of the beta-binomial: with m the pooled rate, the spread
    S = sum n (x/n - m)^2 has mean m(1-m)[(H-1) + rho (N - sum n^2/N - H + 1)],
    which gives rho, and a + b = 1/rho - 1.
    """
    n, x = F.col(total).cast("double"), F.col(failures).cast("double")
    big_n, big_x, h = F.sum(n), F.sum(x), F.count(F.lit(1)).cast("double")
    m = big_x / big_n
    spread = F.sum(x * x / n) - big_x * big_x / big_n
    free = big_n - F.sum(n * n) / big_n - h + 1
    rho = F.try_divide(F.try_divide(spread, m * (1 - m)) - (h - 1), free)
    rho = F.least(F.greatest(F.coalesce(rho, F.lit(0.0)), F.lit(1e-4)), F.lit(0.99))
    strength = 1 / rho - 1
    return F.struct((m * strength).alias("a"), ((1 - m) * strength).alias("b"))


def verdicts_of(measured: DataFrame, host_col: str, m: str, max_rate: float = 0.8,
                doc_rate: float = 0.02) -> DataFrame:
    """One row per host (null is no host): host, n, shrunk rate of each rule, host_ok, strict rules."""
    failed = rules(m)
    hosts = staged(measured.filter(F.col(f"`{host_col}`").isNotNull()).groupBy(F.col(f"`{host_col}`").alias("host")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(c).alias(f"{k}_failed") for k, c in failed.items()]))
    prior = hosts.agg(*[F.when(F.count(F.lit(1)) > 0, beta_prior(hosts, f"{k}_failed")).alias(k)
                        for k in failed]).first()
    if prior[0] is None:  # no hosts
        return hosts.select("host", "n", *[F.lit(0.0).alias(f"{k}_rate") for k in failed],
                            F.lit(True).alias("host_ok"), *[F.lit(False).alias(f"{k}_strict") for k in failed])
    rates = {k: (F.col(f"{k}_failed") + prior[k]["a"])
             / (F.col("n") + prior[k]["a"] + prior[k]["b"]) for k in failed}
    return hosts.select("host", "n", *[c.alias(f"{k}_rate") for k, c in rates.items()],
                        (F.greatest(*rates.values()) <= max_rate).alias("host_ok"),
                        *[(c > doc_rate).alias(f"{k}_strict") for k, c in rates.items()])


def host_verdicts(docs: DataFrame, host_col: str, text_col: str, max_rate: float = 0.8,
                  doc_rate: float = 0.02) -> DataFrame:
    """:func:`verdicts_of` documents that are not measured yet."""
    m, = fresh(docs.columns, "m")
    return verdicts_of(with_measures(docs, text_col, m), host_col, m, max_rate, doc_rate)


def judge(docs: DataFrame, host_col: str = "source", text_col: str = "text", max_rate: float = 0.8,
          doc_rate: float = 0.02, out: str = "quality", keep: list[str] | None = None) -> DataFrame:
    """Rows of ``docs`` with a struct ``out``: the measures, base_failed, host_ok, strict_failed, kept.

    With ``keep`` only those columns are returned; the text is then measured once, and the measures
    and those columns are kept in a table.  Without, all columns are returned; the text is measured
    for the counts and again for the rows, which costs less than keeping a copy of it.

    A null text is empty (and fails as short).  A null host is no host: such a
    row is judged by its base rules alone.  Repeated rows are judged and counted
    each.  Columns whose names clash with the helpers' stay as they are; ``out``
    replaces a column of that name.  Empty in, empty out.
    """
    columns = docs.columns if keep is None else keep
    m, host, ok, *strict = fresh([*docs.columns, out], "m", "host", "host_ok", *[f"{k}_strict" for k in rules("m")])
    measured = with_measures(docs, text_col, m)
    if keep is not None:
        own, = fresh(columns, "own_host")
        measured = staged(measured.select(*[F.col(f"`{c}`") for c in columns], F.col(f"`{host_col}`").alias(own), m))
        host_col = own
    verdicts = verdicts_of(measured, host_col, m, max_rate, doc_rate).select(
        F.col("host").alias(host), F.col("host_ok").alias(ok),
        *[F.col(f"{k}_strict").alias(s) for k, s in zip(rules("m"), strict)])
    judged = measured.join(verdicts, F.col(f"`{host_col}`") == F.col(host), "left")
    failed = rules(m)
    base_failed = failed[BASE_RULES[0]] | failed[BASE_RULES[1]]
    fine = F.coalesce(F.col(ok), F.lit(True))
    strict_failed = reduce(lambda a, b: a | b, [c & F.coalesce(F.col(s), F.lit(False))
                                                for c, s in zip(failed.values(), strict)])
    return judged.select(
        *[F.col(f"`{c}`") for c in columns if c != out],
        F.struct(*[F.col(f"{m}.{x}").alias(x) for x in MEASURES],
                 base_failed.alias("base_failed"), fine.alias("host_ok"), strict_failed.alias("strict_failed"),
                 (~base_failed & fine & ~strict_failed).alias("kept")).alias(out))
