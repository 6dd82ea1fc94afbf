"""License scans: identifier tags and notice phrases of whole texts, and licence expressions.

Method. One Aho-Corasick automaton over the lower-cased words of a text finds every notice phrase
and every identifier tag in one pass. What follows a tag on its line is read as an expression of
identifiers, AND, OR, WITH and brackets; a shunting-yard parser turns it into postfix order, which
is evaluated to the identifiers named and to whether some choice is permissive throughout.

Edge cases: a null or empty text has no words and no labels; a malformed expression gives the
identifiers that it names and is marked as invalid; repeated rows give repeated results; an empty
table gives none.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import TO_WORDS, batch_of, text_chunks

# Phrases that the base counts, with their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Further notices.
NOTICES = {
    "permission is hereby granted free of charge": "mit",
    "licensed under the apache license": "apache-2",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution sharealike": "cc-by-sa",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "gnu general public license version 3": "gpl-3",
    "gnu general public license version 2": "gpl-2",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd 3 clause": "bsd-3-clause",
    "bsd 2 clause": "bsd-2-clause",
    "the isc license": "isc",
    "all rights reserved": "all-rights-reserved",
}
TAGS = ("spdx license identifier", "packagelicensedeclared", "packagelicenseconcluded")
PERMISSIVE = {"mit", "apache-2", "bsd-2-clause", "bsd-3-clause", "isc", "cc0", "cc-by", "unlicense", "zlib", "0bsd"}
# Labels and exceptions that an expression may go on with inside a line of prose.
KNOWN = PERMISSIVE | set(BASE.values()) | set(NOTICES.values()) | {
    "afl-3", "agpl-1", "agpl-3", "apache-1", "apache-1.1", "artistic-1", "artistic-2", "blueoak-1", "bsd-1-clause", "bsd-4-clause",
    "bsl-1", "cc-by-nc-nd", "cc-by-nc-sa", "cc-pddc", "cddl-1", "cddl-1.1", "cecill-2", "cecill-2.1", "cpl-1", "ecl-2", "epl-1",
    "epl-2", "eupl-1.1", "eupl-1.2", "gfdl-1.2", "gfdl-1.3", "gpl-1", "gpl-2", "gpl-3", "lgpl-2", "lgpl-2.1", "lgpl-3", "mit-0",
    "mpl-1", "mpl-1.1", "mpl-2", "ms-pl", "ms-rl", "ncsa", "odbl-1", "ofl-1.1", "openssl", "osl-3", "postgresql", "python-2",
    "ruby", "upl-1", "vim", "w3c", "wtfpl", "x11", "zpl-2.1",
}
EXCEPTIONS = {"linux-syscall-note", "llgpl"}
#: Share of trust that a finding of each kind adds.
WEIGHTS = {"tag": 0.95, "base": 0.8, "notice": 0.7, "invalid tag": 0.4}

SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "findings array<struct<kind:string,label:string,word:long,n_words:int>>, "
    "expressions array<struct<expression:string,valid:boolean,permissive:boolean>>"
)
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_TERMS = re.compile(r"[()]|[A-Za-z0-9][A-Za-z0-9.+:-]*")
_RANK = {"or": 1, "and": 2, "with": 3}


def label_of(identifier: str) -> str:
    """Label of an identifier: lower case, without `-only`, `-or-later`, `+`, a final `.0`, and
    for Creative Commons (CC0 too) without the version."""
    x = re.sub(r"(-only|-or-later|\+)+$", "", identifier.lower())
    return re.sub(r"-\d[\d.]*$", "", x) if x.startswith(("cc-", "cc0-")) else re.sub(r"(\.0)+$", "", x)


def to_postfix(terms: list[str]) -> list[str] | None:
    """Shunting-yard: WITH binds closest, then AND, then OR. None if the expression is malformed."""
    out, waiting, operand_next = [], [], True
    for term in terms:
        word = term.lower()
        if word == "(":
            if not operand_next:
                return None
            waiting.append(word)
        elif word == ")":
            if operand_next:
                return None
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if not waiting:
                return None
            waiting.pop()
        elif word in _RANK:
            if operand_next:
                return None
            while waiting and _RANK.get(waiting[-1], 0) >= _RANK[word]:
                out.append(waiting.pop())
            waiting.append(word)
            operand_next = True
        else:
            if not operand_next:
                return None
            out.append(term)
            operand_next = False
    if operand_next or "(" in waiting:
        return None
    return out + waiting[::-1]


def evaluate(terms: list[str]) -> tuple[list[str], bool, bool]:
    """Labels named, whether the expression is well formed, whether a permissive choice exists."""
    names = [label_of(t) for t in terms if t not in "()" and t.lower() not in _RANK]
    postfix = to_postfix(terms)
    if postfix is None:
        return sorted(set(names)), False, False
    stack: list[tuple[set[str], bool]] = []
    for term in postfix:
        if term.lower() in _RANK:
            (right, r), (left, l) = stack.pop(), stack.pop()
            # an exception widens what its licence permits and names no licence itself
            stack.append((left, l) if term.lower() == "with" else (left | right, (l or r) if term.lower() == "or" else (l and r)))
        else:
            stack.append(({label_of(term)}, label_of(term) in PERMISSIVE))
    return sorted(stack[0][0]), True, stack[0][1]


def is_known(identifier: str) -> bool:
    x = identifier.lower()
    return label_of(x) in KNOWN or x in EXCEPTIONS or re.search(r"-exception(-[\d.]+)?$", x) is not None or x.startswith(("licenseref-", "documentref-"))


def expression_terms(line: str) -> list[str]:
    """Terms of the expression at the head of a line: operators join identifiers, prose ends it. Behind an
    operator only a known identifier counts, or one that ends the line."""
    out, depth, operand_next = [], 0, True
    for m in _TERMS.finditer(line):
        term = m.group().rstrip(".:")
        word = term.lower()
        if not operand_next and word not in _RANK and word != ")":
            break
        if word == ")" and not depth:
            break
        if any(t.lower() in _RANK for t in out) and operand_next and word != "(" and not is_known(term) and re.search(r"\w", line[m.end() :]):
            while out and (out[-1] == "(" or out[-1].lower() in _RANK):  # prose left them without an operand
                out.pop()
            break
        depth += (word == "(") - (word == ")")
        operand_next = word == "(" or word in _RANK
        out.append(term)
    return out


@lru_cache(maxsize=1)
def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for kind, phrases in (("base", BASE), ("notice", NOTICES), ("tag", dict.fromkeys(TAGS, ""))):
        for phrase, label in phrases.items():
            found.add_word(f" {phrase} ", (kind, label, len(phrase), phrase.count(" ") + 1))
    found.make_automaton()
    return found


def scan_text(text: bytes) -> dict:
    """Findings of one text (UTF-8)."""
    words = text.translate(TO_WORDS).split()
    plain = b" " + b" ".join(words) + b" "
    findings, expressions, spans = [], [], None
    for end, (kind, label, size, n) in automaton().iter(plain.decode("latin-1")):
        word = plain.count(b" ", 0, end - size)
        if kind != "tag":
            findings.append((kind, label, word - 1 if word else 0, n))
            continue
        word -= 1
        spans = spans or [m.span() for m in _WORD.finditer(text)]
        line = text[spans[word + n - 1][1] :].split(b"\n", 1)[0].decode("utf-8", "replace")
        terms = expression_terms(line)
        labels, valid, permissive = evaluate(terms)
        if terms:
            expressions.append((" ".join(terms), valid, permissive))
            findings += [("tag" if valid else "invalid tag", x, word, n) for x in labels]
    base = [f for f in findings if f[0] == "base"]
    doubt = 1.0
    for kind, label in sorted({(f[0], f[1]) for f in findings}):
        doubt *= 1 - WEIGHTS[kind]
    return {
        "n_words": len(words),
        "n_base": len(base),
        "first_word": min((f[2] for f in base), default=None),
        "last_word": max((f[2] for f in base), default=None),
        "base_labels": ",".join(sorted({f[1] for f in base})),
        "labels": ",".join(sorted({f[1] for f in findings})),
        "score": 1 - doubt,
        "findings": [dict(zip(("kind", "label", "word", "n_words"), f)) for f in findings],
        "expressions": [dict(zip(("expression", "valid", "permissive"), e)) for e in expressions],
    }


def _schema() -> pa.Schema:
    finding = pa.struct([("kind", pa.string()), ("label", pa.string()), ("word", pa.int64()), ("n_words", pa.int32())])
    expression = pa.struct([("expression", pa.string()), ("valid", pa.bool_()), ("permissive", pa.bool_())])
    kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64(), pa.list_(finding), pa.list_(expression)]
    names = "doc_id n_words n_base first_word last_word base_labels labels score findings expressions".split()
    return pa.schema(list(zip(names, kinds)))


def scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = _schema()
    for batch in batches:
        for part in text_chunks(batch):
            rows = [scan_text(t or b"") for t in part.column(1).cast(pa.large_binary()).to_pylist()]
            yield batch_of(schema, doc_id=part.column(0), **{n: [r[n] for r in rows] for n in schema.names[1:]})


def find_licenses(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """A row per document: counts and places of the base phrases, all labels, every finding with
    its kind, label and word place, and the expressions read behind tags."""
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return texts.mapInArrow(scan_batches, SCHEMA)
