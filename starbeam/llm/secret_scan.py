"""Secret scan in DataFrame functions only: fixed patterns plus sliding-window entropy.

Base kinds (leftmost, non-overlapping, per kind): ``assign`` (a keyword, ``:`` or ``=``, a value of
6 or more characters), ``access`` (AKIA key ids of 20 or more), ``hex`` (24 or more lower-case hex digits).

Added kind ``entropy``: candidate strings are maximal runs of ``[A-Za-z0-9+/_=-]`` of at least
``WINDOW`` characters, whatever they consist of. A window of ``WINDOW`` characters slides over each;
one character leaves and one enters at a step, and only the counts of these two change the sum of
n log2 n, which is kept from step to step. The Shannon entropy
log2(W) - sum / W is compared with the threshold of the candidate's character class (decimal,
hexadecimal, letters, other). Overlapping windows above it merge to one span. Candidates that match an
allow-list pattern (identifiers such as UUIDs, dates and times, paths of words, camel-case names,
sample values) are suppressed; the base spans never are.

Positions of matches come from the lengths of the pieces between them: the pieces and matches of a
text become rows and are added up in a window over the text's rows, so cost is linear in the text
and in the matches. Positions count code points, the end is exclusive.

Defined results: null counts as empty text; no match gives counts of 0 and empty lists; repeated
rows each give a row; further columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

WINDOW = 20
THRESHOLDS = {"decimal": 3.0, "hexadecimal": 3.0, "letters": 3.8, "other": 3.8}
UNIT = 1 << 40
_MONTH, _DAY, _YEAR = "(?:0[1-9]|1[0-2])", "(?:0[1-9]|[12][0-9]|3[01])", "(?:19|20)[0-9]{2}"
_DATE = f"(?:{_YEAR}[/_-]?{_MONTH}[/_-]?{_DAY}|{_DAY}[/_-]{_MONTH}[/_-]{_YEAR}|{_MONTH}[/_-]{_DAY}[/_-]{_YEAR})"
_TIME = "(?:[01][0-9]|2[0-3])[_-]?[0-5][0-9](?:[_-]?[0-5][0-9][0-9]{0,6})?"
#: A candidate that one of these finds is no secret: UUIDs, dates and times (also ranges of them), separators, words joined by a separator or by capitals, sample values.
ALLOW = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}(?:T.*)?$",
    rf"^{_DATE}(?:[+=_/-]*{_TIME})?(?:[+=_/-]+(?:{_DATE}(?:[+=_/-]*{_TIME})?|{_TIME}))*[+=_/-]*$",
    r"^[+=_/-]+$",
    r"^[A-Z]?[a-z]{2,}(?:[A-Z][a-z]{2,})+$",
    r"^/?(?:[A-Za-z]{2,}[0-9]{0,4}[/_=-]+)+[A-Za-z]*[0-9]{0,4}$",
    r"(?i:example|sample|dummy|placeholder|changeme|xxxxxx)",
)
#: The repeating ones of these as (head, step, tail). Steps are taken off one after another, because a repeated group of
#: a pattern recurses once per repeat in the regular expressions of the JVM and a long run would exhaust its stack.
_SEPARATOR, _UNIT_END = "[+=_/-]", "(?=[+=_/-]|$)"
_MOMENT = rf"{_DATE}(?:{_TIME}|{_SEPARATOR}+(?!{_DATE}){_TIME})?{_UNIT_END}"
CHAINS = {
    ALLOW[2]: (_MOMENT, rf"{_SEPARATOR}+(?:{_MOMENT}|{_TIME}{_UNIT_END})", rf"{_SEPARATOR}*"),
    ALLOW[4]: ("[A-Z]?[a-z]{2,}[A-Z][a-z]{2,}", "[A-Z][a-z]{2,}", ""),
    ALLOW[5]: ("/?[A-Za-z]{2,}[0-9]{0,4}[/_=-]+", "[A-Za-z]{2,}[0-9]{0,4}[/_=-]+", "[A-Za-z]*[0-9]{0,4}"),
}

#: Fixed values of the contract: kind, pattern, group whose length counts, least length.
BASE = (
    ("assign", r"""(?=[pstaPSTA])((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"(?<![0-9a-f])[0-9a-f]{24,}", 0, 24),
)
_RUN = "A-Za-z0-9+/_=-"
CANDIDATE = rf"(?<![{_RUN}])[{_RUN}]{{{WINDOW},}}"


def allowed(candidate: Column, pattern: str) -> Column:
    """Does the allow-list pattern find something in the candidate?"""
    if pattern not in CHAINS:
        return candidate.rlike(pattern)
    head, step, tail = CHAINS[pattern]
    rest = F.regexp_replace(F.regexp_replace(candidate, f"^{head}", ""), rf"\G{step}", "")
    return candidate.rlike(f"^{head}") & rest.rlike(f"^{tail}$")


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once."""
    return F.get(F.transform(F.array(value), body), 0)


def high_windows(candidate: Column, window: int = WINDOW, thresholds: dict[str, float] = THRESHOLDS) -> Column:
    """Array of (first, end) of the merged windows of an ASCII string whose entropy reaches its class's threshold.

    The state is the window's text, its sum of n log2 n as an integer in units of 1 / ``UNIT`` (so that no
    step rounds), the open span and the closed ones. A step changes the sum by the counts of the leaving
    and of the entering character and costs the same in a run of any length.
    """
    weight = F.array(*[F.lit(round(n * math.log2(n) * UNIT) if n else 0).cast("long") for n in range(window + 2)])
    least = (
        F.when(candidate.rlike("^[0-9]+$"), thresholds["decimal"])
        .when(candidate.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), thresholds["hexadecimal"])
        .when(candidate.rlike("^[A-Za-z]+$"), thresholds["letters"])
        .otherwise(thresholds["other"])
    )
    most = ((F.lit(math.log2(window)) - least) * window * UNIT + UNIT * 1e-9).cast("long")
    span = "struct<first:int,end:int>"

    def change(count: Column, by: int) -> Column:
        return F.get(weight, count + by) - F.get(weight, count)

    def number(text: Column, char: Column) -> Column:
        return F.length(text) - F.length(F.replace(text, char, F.lit("")))

    def slide(state: Column, char: Column) -> Column:
        """(text, sum, end) after the leaving character went and ``char`` came."""
        full = F.length(state["text"]) == window
        left = F.when(full, F.substring(state["text"], 2, window)).otherwise(state["text"])
        kept = F.when(full, state["sum"] + change(number(state["text"], F.substring(state["text"], 1, 1)), -1)).otherwise(state["sum"])
        return _let(
            F.struct(left.alias("text"), kept.alias("sum")),
            lambda w: F.struct(F.concat(w["text"], char).alias("text"), (w["sum"] + change(number(w["text"], char), 1)).alias("sum"), (state["end"] + 1).alias("end")),
        )

    def step(state: Column, char: Column) -> Column:
        def seen(w: Column) -> Column:
            first = w["end"] - window
            high = (first >= 0) & (w["sum"] <= state["most"])
            new = high & (state["open"].isNull() | (state["open"]["end"] < first))
            opened = F.when(new, F.struct(first.alias("first"), w["end"].alias("end"))).when(high, F.struct(state["open"]["first"].alias("first"), w["end"].alias("end"))).otherwise(state["open"])
            closed = F.when(new & state["open"].isNotNull(), F.concat(state["spans"], F.array(state["open"]))).otherwise(state["spans"])
            return F.struct(w["text"].alias("text"), w["sum"].alias("sum"), w["end"].alias("end"), state["most"].alias("most"), opened.cast(span).alias("open"), closed.cast(f"array<{span}>").alias("spans"))

        return _let(slide(state, char), seen)

    start = F.struct(
        F.lit("").alias("text"), F.lit(0).cast("long").alias("sum"), F.lit(0).alias("end"), most.alias("most"), F.lit(None).cast(span).alias("open"), F.array().cast(f"array<{span}>").alias("spans")
    )
    chars = F.filter(F.split(candidate, ""), lambda c: c != "")
    return F.aggregate(chars, start, step, lambda s: F.when(s["open"].isNull(), s["spans"]).otherwise(F.concat(s["spans"], F.array(s["open"]))))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """Per row: id, ``n_assign``, ``n_access``, ``n_hex``, ``base_spans`` and ``all_spans`` (arrays of kind, start, end in order)."""
    kinds = [*BASE, ("entropy", CANDIDATE, 0, window)]
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        text.alias("text"),
        *[F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias(f"found_{kind}") for kind, pattern, _, _ in kinds],
    )

    def matches(no: int, kind: str, pattern: str, group: int, least: int) -> Column:
        """One struct per match: kind, number, length of the text before it since the last match, own length, spans relative to its start."""
        own = F.col(f"found_{kind}")
        gaps = F.transform(F.split("text", pattern, -1), lambda piece: F.length(piece))
        values = F.regexp_extract_all("text", F.lit(pattern), F.lit(group)) if group else own

        def one(m: Column, i: Column) -> Column:
            size = F.length(m["match"])
            whole = F.array(F.struct(F.lit(0).alias("first"), size.alias("end")))
            none = F.slice(whole, 1, 0)
            if kind == "entropy":
                fine = F.lit(False)
                for pattern in allow:
                    fine = fine | allowed(m["match"], pattern)
                spans = F.when(fine, none).otherwise(high_windows(m["match"], window))
            else:
                spans = F.when(F.length(m["value"]) >= least, whole).otherwise(none)
            return F.struct(F.lit(no).alias("kind"), i.alias("no"), m["gap"].alias("gap"), size.alias("size"), spans.alias("spans"))

        zipped = F.arrays_zip(F.slice(gaps, 1, F.size(own)).alias("gap"), own.alias("match"), values.alias("value"))
        return F.when(F.size(own) > 0, F.transform(zipped, one))

    per_kind = [F.coalesce(m, F.slice(F.array(F.lit(None)), 1, 0)) for m in (matches(no, *kind) for no, kind in enumerate(kinds))]
    rows = found.select("row", "id", F.explode_outer(F.concat(*per_kind)).alias("m")).select("row", "id", "m.*").repartition("row")
    so_far = Window.partitionBy("row", "kind").orderBy("no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumn("start", F.sum(F.col("gap") + F.col("size")).over(so_far) - F.col("size"))
    spans = F.transform("spans", lambda s: F.struct((F.col("start") + s["first"]).alias("start"), F.col("kind").alias("kind"), (F.col("start") + s["end"]).alias("end")))
    grouped = placed.withColumn("spans", spans).groupBy("row", "id").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))
    names = F.array(*[F.lit(kind) for kind, *_ in kinds])
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))

    def named(array: Column) -> Column:
        return F.transform(array, lambda s: F.struct(F.get(names, s["kind"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    def number(no: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == no)).cast("long")

    counts = [number(no).alias(f"n_{kind}") for no, (kind, *_) in enumerate(BASE)]
    return grouped.select(F.col("id").alias(id_col), *counts, named(base).alias("base_spans"), named(F.col("spans")).alias("all_spans"))


def report(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The digest columns: counts, hash of the base spans as ``kind:start:end`` joined by commas, all spans joined likewise."""

    def joined(column: str) -> Column:
        return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    counts = [f"n_{kind}" for kind, *_ in BASE]
    return found.select(id_col, *counts, F.sha2(joined("base_spans"), 256).alias("base_sha256"), joined("all_spans").alias("spans"))
