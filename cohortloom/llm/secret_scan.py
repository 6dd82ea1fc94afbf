"""Secret scans with DataFrame functions only.

Method. Candidate strings are the runs of LENGTH or more signs of the base-64 alphabets that hold a
digit and a letter. A window slides over each; the counts of its signs change by one sign in and one
out at each step, and with them the sum of c log2 c, from which the window's Shannon entropy follows.
The threshold depends on the candidate's character class (hexadecimal or wider). A candidate with a
window above its threshold is a secret, from the first such window to the end of the last, unless
the allow-list suppresses it or a base pattern already holds part of it.

Base patterns are matched leftmost and without overlap, each kind by itself; matches whose value is
too short are dropped afterwards.

Edge cases: a null or empty text has no spans; every text is searched whole; repeated rows give
repeated results; columns of documents other than id and text play no part. Places are code points.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import fresh

# The base patterns, the group that holds the value and its least length.
BASE = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 4, 6),
    # runs are matched whole, so the least length can stand in the pattern
    "access": (r"AKIA[A-Z0-9]{16,}", 2, 20),
    "hex": (r"[0-9a-f]{24,}", 2, 24),
}
KINDS = [*BASE, "entropy_hex", "entropy_base64"]

SIGNS = "A-Za-z0-9+/_="
LENGTH = 20
WINDOW = 20
#: Least entropy of a window, in bits, by character class.
THRESHOLDS = {"entropy_hex": 2.9, "entropy_base64": 3.6}
#: Candidates that are no secrets: digits alone with separators, placeholders, examples, paths of
#: words, words joined by signs.
ALLOWED = (
    r"(?i)example|sample|dummy|placeholder|redacted|xxxxx|00000000|12345678|abcdefgh",
    r"^[0-9+/_=]+$",
    r"^/?([A-Za-z]+[0-9]{0,2}[/_=+])+[A-Za-z]*[0-9]{0,4}$",
)



def _span(start: Column, kind: str | Column, end: Column) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    rank = F.array_position(F.array(*map(F.lit, KINDS)), kind)
    return F.struct(start.cast("int").alias("start"), rank.cast("int").alias("rank"), kind.alias("kind"), end.cast("int").alias("end"))


def located(text: Column, pattern: str, group: int) -> Column:
    """(start, end, match, value) of each match. One pattern reads the text up to each match, so
    that the lengths of what lies between give the places."""
    whole = F.lit(rf"(?s)(.*?)(?:({pattern})|\z)")
    take = lambda g: F.regexp_extract_all(text, whole, F.lit(g))
    parts = F.arrays_zip(take(1).alias("gap"), take(2).alias("match"), take(group).alias("value"))
    kind = "array<struct<start:int,end:int,match:string,value:string>>"

    def step(state: Column, p: Column) -> Column:
        start = state["at"] + F.length(p["gap"])
        end = start + F.length(p["match"])
        own = F.struct(start.alias("start"), end.alias("end"), p["match"].alias("match"), p["value"].alias("value"))
        return F.struct(end.alias("at"), F.when(F.length(p["match"]) > 0, F.concat(state["found"], F.array(own))).otherwise(state["found"]).alias("found"))

    start = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() AS {kind})").alias("found"))
    found = F.aggregate(parts, start, step, lambda s: s["found"])
    return F.when(text.rlike(pattern), found).otherwise(F.expr(f"cast(array() AS {kind})"))


def base_spans(text: Column) -> Column:
    def of_kind(kind: str, pattern: str, group: int, least: int) -> Column:
        long_enough = F.filter(located(text, pattern, group), lambda m: F.length(m["value"]) >= least)
        return F.transform(long_enough, lambda m: _span(m["start"], kind, m["end"]))

    return F.array_sort(F.concat(*[of_kind(kind, *rule) for kind, rule in BASE.items()]))


def _weight(c: Column) -> Column:
    """c log2 c."""
    return F.when(c > 1, c * F.log2(c)).otherwise(0.0)


def window_bounds(candidate: Column, threshold: Column, window: int = WINDOW) -> Column:
    """(first, last): places, from 0, of the first and last window at or above the threshold; -1
    if there is none. A sign is known by its code; the counts of all codes are the state."""
    codes = F.transform(F.split(candidate, ""), lambda s: F.ascii(s) - 32)
    begin = F.struct(
        F.array_repeat(F.lit(0), 95).alias("counts"), F.lit(0.0).alias("sum"), F.lit(0).alias("at"), F.lit(-1).alias("first"), F.lit(-1).alias("last"), codes.alias("codes")
    )

    def step(s: Column, code: Column) -> Column:
        full = s["at"] >= window
        out = F.when(full, F.get(s["codes"], s["at"] - window)).otherwise(-1)
        leaving, coming = F.coalesce(F.get(s["counts"], out), F.lit(0)), F.get(s["counts"], code)
        coming = coming - F.when(out == code, 1).otherwise(0)
        total = s["sum"] - F.when(full, _weight(leaving) - _weight(leaving - 1)).otherwise(0.0) + _weight(coming + 1) - _weight(coming)
        counts = F.transform(s["counts"], lambda v, i: v + F.when(i == code, 1).otherwise(0) - F.when(i == out, 1).otherwise(0))
        place = s["at"] - (window - 1)
        good = (place >= 0) & (F.log2(F.lit(float(window))) - total / window >= threshold)
        return F.struct(
            counts.alias("counts"),
            total.alias("sum"),
            (s["at"] + 1).alias("at"),
            F.when(good & (s["first"] < 0), place).otherwise(s["first"]).alias("first"),
            F.when(good, place).otherwise(s["last"]).alias("last"),
            s["codes"].alias("codes"),
        )

    return F.aggregate(codes, begin, step, lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last")))


def entropy_spans(text: Column, base: Column, allowed: tuple[str, ...] = ALLOWED) -> Column:
    """Spans of high entropy beside the base spans. A hyphen ends a candidate: it joins words."""
    runs = located(text, rf"(?<![{SIGNS}])[{SIGNS}]{{{LENGTH},}}", 2)
    lettered = F.filter(runs, lambda m: m["match"].rlike("[0-9]") & m["match"].rlike("[A-Za-z]"))
    if allowed:
        lettered = F.filter(lettered, lambda m: ~m["match"].rlike("|".join(f"(?:{rule})" for rule in allowed)))
    free = F.filter(lettered, lambda m: ~F.exists(base, lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))

    def judged(m: Column) -> Column:
        kind = F.when(m["match"].rlike("^([0-9a-f]+|[0-9A-F]+)$"), "entropy_hex").otherwise("entropy_base64")
        threshold = F.when(kind == "entropy_hex", THRESHOLDS["entropy_hex"]).otherwise(THRESHOLDS["entropy_base64"])
        return F.struct(m["start"].alias("start"), kind.alias("kind"), window_bounds(m["match"], threshold).alias("bounds"))

    hot = F.filter(F.transform(free, judged), lambda j: j["bounds"]["first"] >= 0)
    return F.transform(hot, lambda j: _span(j["start"] + j["bounds"]["first"], j["kind"], j["start"] + j["bounds"]["last"] + WINDOW))


def find_secrets(docs: DataFrame, text_column: str = "text", base_column: str = "base_spans", spans_column: str = "spans", allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """docs with two columns more: the base spans, and all spans in order of start and kind."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    found = docs.withColumn(base_column, base_spans(text))
    base = F.col(base_column)
    return found.withColumn(spans_column, F.array_sort(F.concat(base, entropy_spans(text, base, allowed))))


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with every span, or run of overlapping spans, replaced; null stays null."""
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(s: Column, span: Column) -> Column:
        new = span["start"] >= s["at"]
        kept = F.concat(s["out"], F.substring(text, s["at"] + 1, span["start"] - s["at"]), F.lit(mark))
        first = (s["at"] == 0) & (s["out"] == "")
        return F.struct(F.greatest(s["at"], span["end"]).alias("at"), F.when(new | first, kept).otherwise(s["out"]).alias("out"))

    done = F.aggregate(spans, begin, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def redact_secrets(docs: DataFrame, text_column: str = "text", length_column: str = "n_chars", mark: str = "[secret]") -> DataFrame:
    """The documents with all their columns; secrets are replaced, and the length, if there is a
    column of it, follows the text."""
    base, spans = fresh("_base", docs.columns), fresh("_spans", docs.columns)
    found = find_secrets(docs, text_column, base, spans)
    text = redacted(F.col(text_column), F.col(spans), mark)
    out = found.withColumn(text_column, text)
    if length_column in docs.columns:
        kind = docs.schema[length_column].dataType
        out = out.withColumn(length_column, F.when(F.size(spans) > 0, F.length(text_column).cast(kind)).otherwise(F.col(length_column)))
    return out.select(*[f"`{c}`" for c in docs.columns])
