"""Small document tables with the awkward cases, and plain helpers for brute-force versions."""
import random
import re

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, node long, keep string, spans string, label int"


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def prose(seed, n, stock="abcdefgh"):
    r = random.Random(seed)
    return " ".join("".join(r.choice(stock) for _ in range(r.randint(1, 7))) for _ in range(n))


def row(i, text, lang=None):
    return (i, text, lang, "src", None if text is None else len(text), "x", 1, "k", "s", 0)


def awkward():
    """Null and empty texts, no words, a null id, repeated rows, ties, a very long text."""
    base = prose(1, 60)
    long_text = prose(2, 12_000) + ". " + base
    return [
        row(1, None),
        row(2, ""),
        row(3, "   \n\t "),
        row(4, "!!! ???"),
        row(5, base, "en"),
        row(5, base, "en"),
        row(6, base, "en"),
        row(7, base.upper(), "en"),
        row(None, "one two three"),
        row(8, long_text, "en"),
        row(9, "Größe ÉÉ naïve ½ 日本語 text\nnext  line\r\n", "de"),
        row(10, "one two three", None),
    ]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)
