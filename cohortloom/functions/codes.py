"""Clinical code functions: body mass class, ordinals, ATC levels, chapters, score maps."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortloom.functions.numeric import col
from cohortloom.functions.text import lookup

# Fixed values
NYHA = {"I": 0, "II": 1, "III": 2, "IV": 3}
ATC_GROUPS = list("ABCDGHJLMNRPSV")
ATC_PREFIX = {"atc_l1": 1, "atc_l2": 3, "atc_l3": 4, "atc_l4": 5}
NOT_FOUND = "NO ENCONTRADO"


def nutrition_from_bmi(bmi: Column | str) -> Column:
    """-1 under 16, 1 over 30, 0 otherwise (unknown included)."""
    b = col(bmi)
    return F.when(b < 16, -1).when(b > 30, 1).otherwise(0)


def nyha_ordinal(c: Column | str) -> Column:
    return lookup(F.trim(col(c)), NYHA)


def shift_score(c: Column | str, by: int = 1) -> Column:
    return col(c) - F.lit(by)


def deepest_code(codes: Column) -> Column:
    """Longest code of an array; on equal length the first in the array."""
    longest = F.array_max(F.transform(codes, lambda x: F.length(x)))
    return F.get(F.filter(codes, lambda x: F.length(x) == longest), 0)


def _name_of(entries: Column, code: Column) -> Column:
    """Name of a code; the last entry wins when the code is repeated."""
    same = F.filter(entries, lambda e: e["code"] == code)
    return F.try_element_at(F.transform(same, lambda e: e["name"]), F.lit(-1))


def atc_levels(entries: Column) -> dict[str, Column]:
    """Array of (code, name) structs -> code and name of each ATC level of the deepest code."""
    entries = F.filter(entries, lambda e: F.length(e["code"]) > 0)
    best = deepest_code(F.transform(entries, lambda e: e["code"]))
    out = {}
    for level, size in ATC_PREFIX.items():
        code = F.when(F.length(best) >= size, F.substring(best, 1, size))
        out[f"{level}_code"] = code
        out[f"{level}_name"] = _name_of(entries, code)
    return out


def atc_group_flags(letter: Column | str) -> dict[str, Column]:
    c = col(letter)
    return {f"atc_l1_is_{g}": F.coalesce((c == g).cast("int"), F.lit(0)) for g in ATC_GROUPS}


def mark_not_found(text: Column | str, code: Column | str) -> Column:
    """Text without a code is marked; no text leaves the code null."""
    t, c = col(text), col(code)
    return F.when(t.isNotNull() & c.isNull(), F.lit(NOT_FOUND)).otherwise(c)


def code_chapter(code: Column | str) -> Column:
    c = col(code)
    return F.when(c == NOT_FOUND, c).when(c != "", F.substring(c, 1, 1))


def scores_to_columns(
    labels_json: Column | str, scores_json: Column | str, prefix: str, labels: Sequence[str]
) -> dict[str, Column]:
    """Parallel JSON lists of labels and scores -> one column per label, 0 when absent."""
    names = F.from_json(F.replace(col(labels_json), F.lit("'"), F.lit('"')), "array<string>")
    values = F.from_json(col(scores_json), "array<double>")
    n = F.least(F.size(names), F.size(values))
    pairs = F.when(n > 0, F.map_from_arrays(F.slice(names, 1, n), F.slice(values, 1, n)))
    return {
        f"score_{prefix}_{label.replace(' ', '_')}": F.coalesce(F.try_element_at(pairs, F.lit(label)), F.lit(0.0))
        for label in labels
    }
