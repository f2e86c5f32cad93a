"""Secret scan with multipart credential linking, in DataFrame operations.

Strong patterns are reported wherever they match.  Weak candidates (a long
random token, an account name in an assignment) are reported only where the
parts of a credential come together: with at most ``scope`` code points between
them there must be an access identifier near a random token, and both a secret
and an endpoint near an account name.

The interval join of the parts is one window over each document.  A part enters
with its start, and a candidate asks at its end plus the scope: of the parts that
started by then, the farthest end shows whether one reaches back into the scope.
In the same way it asks at its last code point whether a base span touches it.
Cost and output follow the number of parts, not of pairs, and no part's length
matters.

Only positions leave the text; no secret is stored or shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm._common import once, staged, with_running_sums

_KEYS = r"(?i:password|passwd|secret|token|api_?key)"
_VALUE = r"[A-Za-z0-9+/_.=-]+"
# Leftmost matches with every run taken whole, so runs that are too short cannot match in part.
ASSIGN = _KEYS + r"""["']?\x20*[:=]\x20*["']?""" + _VALUE
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
TOKEN = r"(?<![A-Za-z0-9/+_=-])[A-Za-z0-9/+_-]{32,}+={0,2}+"
ACCOUNT = r"""(?i:access[_-]?key(?:[_-]?id)?|client[_-]?id|account[_-]?id|user(?:name)?)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{4,}"""
ENDPOINT = r"""(?i:https?|s3|ftp|postgres(?:ql)?|mysql|redis|mongodb|amqp)://[^\s"'<>]+"""

BASE = ("assign", "access", "hex")
WEAK = ("weak_account", "weak_token")
KINDS = BASE + WEAK + ("endpoint",)
STARTS, ASKS_SCOPE, ASKS_BASE = range(3)  # a part's start comes before what is asked at its place
_SPAN = "array<struct<start: bigint, kind: int, end: bigint>>"


_KEEP = {
    "assign": (ASSIGN, lambda m: F.length(F.regexp_replace(m, "^" + ASSIGN[:-len(_VALUE)], "")) >= 6),
    "access": (ACCESS, lambda m: F.length(m) >= 20),
    "hex": (HEX, lambda m: F.length(m) >= 24),
    "weak_account": (ACCOUNT, lambda m: F.length(m) >= 4),
    "weak_token": (TOKEN, lambda m: m.rlike("[0-9]") & m.rlike("[A-Z]") & m.rlike("[a-z]")),
    "endpoint": (ENDPOINT, lambda m: F.length(m) >= 8),
}


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = 300) -> DataFrame:
    """One row per row of ``docs``: (id, base, added), spans of (start, kind number, end).

    Positions are code points, end exclusive; kinds are numbered as in KINDS,
    spans sorted by start and kind.  ``added`` are the weak candidates with
    complementary parts in scope, without those that touch a base span.  A null
    text is empty and has none.  Repeated rows and null ids are rows of their
    own; extra columns are ignored.  Empty in, empty out.
    """
    narrow = staged(_matched(docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))))
    number = {k: KINDS.index(k) for k in KINDS}
    candidates = [number[k] for k in WEAK]
    parts = narrow.filter(F.exists("weak", lambda w: w["kind"].isin(candidates))) \
                  .select("row", F.explode(F.concat("base", "weak")).alias("part")).select("row", "part.*")
    ask = lambda at, role: F.struct(at.alias("at"), F.lit(role).alias("role"))
    events = parts.select("*", F.explode(F.when(F.col("kind").isin(candidates), F.array(
        ask(F.col("start"), STARTS), ask(F.col("end") + scope, ASKS_SCOPE), ask(F.col("end") - 1, ASKS_BASE)))
        .otherwise(F.array(ask(F.col("start"), STARTS)))).alias("event")).select("row", "start", "kind", "end", "event.*")
    so_far = Window.partitionBy("row").orderBy("at", "role").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reach = lambda *kinds: F.max(F.when((F.col("role") == STARTS) & F.col("kind").isin(
        [number[k] for k in kinds]), F.col("end"))).over(so_far)
    seen = events.withColumns({"identifier": reach("access", "weak_account"), "endpoint": reach("endpoint"),
                               "secret": reach("assign", "hex", "weak_token"), "strong": reach(*BASE)})
    near = lambda reached: F.coalesce(F.col(reached) >= F.col("start") - scope, F.lit(False))
    linked = F.when(F.col("kind") == number["weak_token"], near("identifier")) \
              .otherwise(near("secret") & near("endpoint"))
    touched = F.coalesce(F.col("strong") > F.col("start"), F.lit(False))
    added = seen.filter(F.col("role") != STARTS).groupBy("row", "start", "kind", "end").agg(
        F.bool_or((F.col("role") == ASKS_SCOPE) & linked).alias("linked"),
        F.bool_or((F.col("role") == ASKS_BASE) & touched).alias("touched")) \
        .filter("linked AND NOT touched").groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("added"))
    return narrow.join(added, "row", "left").select(
        F.col("id").alias(id_col), "base", F.coalesce("added", F.array().cast(_SPAN)).alias("added"))


def _matched(texts: DataFrame) -> DataFrame:
    """(id, row, base, weak) of (id, text): spans of all matches that pass.

    A match's place is the sum of the lengths of what the pattern leaves between the matches and of
    the matches before it.  Each step is a column that two others name, so that it is evaluated once
    a row (see :func:`once`).
    """
    c, kinds = F.col, list(_KEEP)
    add = lambda columns: texts.select("*", *[e.alias(n) for n, e in columns.items()])
    texts = add({f"{k}_found": F.regexp_extract_all("text", F.lit(p), F.lit(0)) for k, (p, _) in _KEEP.items()})
    texts = add({f"{k}_between": F.when(F.size(f"{k}_found") > 0, F.transform(F.split("text", p), lambda x: F.length(x)))
                 for k, (p, _) in _KEEP.items()})
    step = lambda k: once(f"{k}_between", F.transform(f"{k}_found", lambda m, i: (
        F.get(c(f"{k}_between"), i) + F.length(m)).cast("bigint")))
    texts = with_running_sums(add({f"{k}_steps": step(k) for k in kinds}), {f"{k}_steps": f"{k}_ends" for k in kinds})

    def spans_of(k: str, keep) -> Column:
        every = F.zip_with(f"{k}_found", f"{k}_ends", lambda m, end: F.when(keep(m), F.struct(
            (end - F.length(m)).alias("start"), F.lit(KINDS.index(k)).alias("kind"), end.alias("end"))))
        return F.when(F.size(f"{k}_found") > 0, F.filter(every, lambda s: s.isNotNull())).otherwise(F.array().cast(_SPAN))

    spans = {k: spans_of(k, keep) for k, (_, keep) in _KEEP.items()}
    return texts.select("id", F.monotonically_increasing_id().alias("row"),
                        F.array_sort(F.concat(*[spans[k] for k in BASE])).alias("base"),
                        F.concat(*[spans[k] for k in KINDS if k not in BASE]).alias("weak"))


def joined(spans: Column) -> Column:
    """kind:start:end of sorted spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("bigint")
