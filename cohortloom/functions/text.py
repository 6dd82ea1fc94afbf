"""Text standardisation and keyword functions as built-in expressions."""
from __future__ import annotations

import unicodedata
from collections.abc import Mapping, Sequence
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortloom.functions.numeric import col
from cohortloom.functions.stopwords import SPANISH

SPACES = " \t\n\r\f\x0b"
_SPACE_RUN = r"[\t-\r\x1c-\x20]+"


@lru_cache(maxsize=1)
def ascii_forms() -> dict[str, str]:
    """ASCII form of every character beyond ASCII whose compatibility decomposition has one."""
    out = {}
    for code in (*range(0x80, 0xD800), *range(0xE000, 0x110000)):
        # most characters decompose to nothing in ASCII; asking for the decomposition alone is quick
        if unicodedata.decomposition(chr(code)):
            form = unicodedata.normalize("NFKD", chr(code)).encode("ascii", "ignore").decode()
            if form:
                out[chr(code)] = form
    return out


@lru_cache(maxsize=1)
def ascii_fold_map() -> tuple[str, str]:
    """The characters whose ASCII form is one character, and these forms."""
    single = {ch: form for ch, form in ascii_forms().items() if len(form) == 1}
    return "".join(single), "".join(single.values())


@lru_cache(maxsize=1)
def ascii_fold_multi() -> dict[str, str]:
    """The characters with a longer ASCII form (ligatures, units, fractions, numbers in circles)."""
    return {ch: form for ch, form in ascii_forms().items() if len(form) > 1}


def strip(c: Column | str) -> Column:
    return F.btrim(col(c), F.lit(SPACES))


def fold_ascii(c: Column | str) -> Column:
    """Accents removed; characters without an ASCII form dropped.

    Plain ASCII text passes untouched; the few characters with a longer ASCII form
    (ligatures, ellipsis, fractions) are replaced only in texts that hold one, and only those found.
    """
    c = col(c)
    multi = ascii_fold_multi()
    src, dst = ascii_fold_map()

    def single(x: Column) -> Column:
        return F.regexp_replace(F.translate(x, src, dst), r"[^\x00-\x7F]+", "")

    def expand(x: Column) -> Column:
        # one literal that Spark folds into a table
        listed = "\x01".join(f"{ch}\x02{form}" for ch, form in multi.items())
        forms = F.str_to_map(F.lit(listed), F.lit("\x01"), F.lit("\x02"))
        found = F.array_intersect(F.split(x, ""), F.map_keys(forms))
        return F.aggregate(found, x, lambda acc, ch: F.replace(acc, ch, F.element_at(forms, ch)))

    # a table look-up per character; a character class of this length is tried one by one
    longer = F.length(F.translate(c, "".join(multi), "")) < F.length(c)
    return F.when(~c.rlike(r"[^\x00-\x7F]"), c).when(longer, single(expand(c))).otherwise(single(c))


def collapse_spaces(c: Column | str) -> Column:
    return F.btrim(F.regexp_replace(col(c), _SPACE_RUN, " "), F.lit(" "))


def ascii_lower(c: Column | str) -> Column:
    """ASCII, lower case, single spaces; null and 'nan' give null."""
    c = col(c).cast("string")
    return F.when(F.lower(strip(c)) != "nan", collapse_spaces(F.lower(fold_ascii(c))))


def letters(c: Column | str, keep: str = "", replace_char: str = "") -> Column:
    """Letters and spaces of an ascii_lower() text, and the signs to keep."""
    return F.regexp_replace(col(c), rf"[^a-zA-Z{keep} ]", replace_char)


def standardise(
    c: Column | str, letters_only: bool = True, keep: str = "", replace_char: str = ""
) -> Column:
    """ascii_lower(), then letters only.

    Spaces collapse before characters are removed, so a removed sign may leave two spaces.
    Several forms of one text are cheaper from one ascii_lower() column.
    """
    out = ascii_lower(c)
    return letters(out, keep, replace_char) if letters_only else out


def null_normalise(c: Column | str) -> Column:
    """Blank, 'nan' and 'none' texts become real nulls."""
    c = col(c)
    return F.when(~F.lower(strip(c)).isin("", "nan", "none"), c)


def words(c: Column | str) -> Column:
    return F.regexp_extract_all(F.lower(col(c)), F.lit(r"([\p{L}\p{N}_]+)"), 1)


def spanish_stopwords() -> list[str]:
    return list(SPANISH)


def remove_stopwords(c: Column | str, stopwords: Sequence[str]) -> Column:
    """Words of the text without the stop words, joined by one space; '' for null."""
    kept = F.filter(words(c), lambda w: ~w.isin(*[s.lower() for s in stopwords]))
    return F.coalesce(F.array_join(kept, " "), F.lit(""))


def lookup(c: Column, mapping: Mapping[str, str]) -> Column:
    """Value of a literal map, null when absent."""
    pairs = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.try_element_at(pairs, c)


def canonicalise(c: Column | str, mapping: Mapping[str, str]) -> Column:
    """Case-insensitive variant -> canonical value; other values pass unchanged."""
    c = col(c)
    return F.coalesce(lookup(F.lower(strip(c)), mapping), c)


def map_variants(c: Column | str, categories: Mapping[str, Sequence[str]], default: str = "otros") -> Column:
    """First category whose variant list holds the value, else the default."""
    c = col(c)
    out = F.lit(default)
    for name, variants in reversed(categories.items()):
        out = F.when(c.isin(*variants), F.lit(name)).otherwise(out)
    return out


def classify_contains(
    c: Column | str, rules: Sequence[tuple[Sequence[str], str]], default: str = "otros"
) -> Column:
    """First rule whose keywords are all contained in the text."""
    c = col(c)
    out = F.lit(default)
    for keywords, category in reversed(rules):
        hit = F.lit(True)
        for k in keywords:
            hit = hit & c.contains(k)
        out = F.when(hit, F.lit(category)).otherwise(out)
    return out


def keyword_labels(c: Column | str, labels: Sequence[str], default: str = "otros") -> Column:
    """Labels contained in the text, in label order, joined by ', '; default when none."""
    c = col(c)
    hits = F.filter(F.array(*[F.lit(x) for x in labels]), lambda x: c.contains(x))
    return F.when(F.size(hits) > 0, F.array_join(hits, ", ")).otherwise(F.lit(default))


def split_terms(c: Column | str, delimiter: str = ",") -> Column:
    if delimiter not in (",", ";"):
        return F.filter(F.transform(F.split(col(c), delimiter, -1), strip), lambda x: x != "")
    # the same in functions that Spark compiles
    around = f"[{SPACES}]*"
    return F.array_remove(F.split(F.regexp_replace(strip(c), around + delimiter + around, delimiter), delimiter, -1), "")


def resolve_contradiction(c: Column | str, delimiter: str = ",", term: str = "negativo") -> Column:
    """Distinct terms; the contradictory one is dropped when anything else is present.

    The terms come out sorted, so the text does not depend on the input order.
    """
    terms = F.array_distinct(split_terms(c, delimiter))
    kept = F.when(F.size(terms) > 1, F.array_remove(terms, term)).otherwise(terms)
    return F.array_join(F.sort_array(kept), delimiter)


def phrases_to_null(c: Column | str, phrases: Sequence[str]) -> Column:
    c = col(c)
    return F.when(~c.isin(*phrases), c)


def text_md5(c: Column | str) -> Column:
    return F.coalesce(F.md5(col(c).cast("string")), F.lit(""))


def replace_words(c: Column | str, word_map: Mapping[str, str]) -> Column:
    """Ordered whole-word replacement; later rules see the output of earlier ones."""
    import re

    out = strip(F.lower(col(c)))
    for wrong, right in word_map.items():
        out = F.regexp_replace(out, rf"\b{re.escape(wrong)}\b", right)
    return out
