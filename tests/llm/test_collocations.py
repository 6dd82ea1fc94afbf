"""Phrases against plain counting, for several numbers of shards and tables too small for the phrases."""
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortloom.llm import collocations
from tests.llm.fixtures import LOWER, awkward, frame, row


def plain(rows, least, longest=3, top=2000, covered=50):
    counts, total = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        held = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        ranked = []
        for p, a in held.items():
            holders = [b for q, b in held.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * b >= covered * a for b in holders):
                continue
            score, k = min(((1_000_000 * a * a) // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def texts(seed, n=60):
    r = random.Random(seed)
    stock = ["the", "of", "Größe", "new", "york", "city", "a-b", "x y", "日本", "ß"] + [f"w{i}" for i in range(30)]
    weight = [1 / (i + 1) for i in range(len(stock))]
    rows = []
    for i in range(n):
        words = r.choices(stock, weight, k=r.randint(0, 80))
        text = "".join(w + r.choice([" ", " ", "  ", "\t", " new york city ", ". ", ",", "\x0b", "\r\n"]) for w in words)
        rows.append(row(i, text, r.choice(["en", "en", "de", None, "und"])))
    return rows


@pytest.mark.parametrize("shards,slots,least", [(1, 1 << 16, 10), (2, 1 << 24, 3), (2, 64, 4), (3, 1 << 10, 2), (5, 1 << 16, 10)])
def test_phrases_equal_plain_counting(spark, shards, slots, least):
    rows = texts(shards) + awkward()
    got = collocations.collocations(frame(spark, rows), least=least, shards=shards, slots=slots)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = plain(rows, least)
    assert sorted(tuple(x) for x in got.collect()) == want and len(want) > 20


def test_longer_phrases_and_other_parameters(spark):
    rows = texts(9, 40)
    got = collocations.collocations(frame(spark, rows), least=3, longest=4, top=7, covered=90, slots=1 << 12)
    assert sorted(tuple(x) for x in got.collect()) == plain(rows, 3, longest=4, top=7, covered=90)


def test_empty_tables_and_many_partitions(spark):
    assert collocations.collocations(frame(spark, []), slots=1 << 10).count() == 0
    assert collocations.collocations(frame(spark, [row(1, None), row(2, " . , ")]), slots=1 << 10).count() == 0
    rows = [row(i, "hot words stand here", "en") for i in range(300)]
    got = collocations.collocations(frame(spark, rows).repartition(16), slots=1 << 10).collect()
    assert [(r.phrase, r.a, r.score) for r in got] == [("hot words stand", 300, 1000000), ("words stand here", 300, 1000000)]


def test_scores_stay_exact_beyond_64_bits(spark):
    """The score's own arithmetic with counts whose products pass 64 bits."""
    a, l, r = 987_654_321_987, 987_654_321_989, 999_999_999_989
    wide = lambda v: F.lit(v).cast("decimal(15,0)")
    got = spark.range(1).select((wide(a) * wide(a) * F.lit(1_000_000).cast("decimal(8,0)")).alias("x"), (wide(l) * wide(r)).alias("y"))
    assert got.selectExpr("x div y").first()[0] == 1_000_000 * a * a // (l * r)


def test_activation_is_the_later_half(spark):
    """A phrase's step is the later one of its halves, and no phrase crosses a piece."""
    pieces = collocations.Pieces(pa.array(["a b c. a b", None, "b c"]), np.array([1, 1, 1], np.uint64))
    tables = [np.zeros(1 << 16, np.uint8), np.zeros(1 << 16, np.uint8)]
    word = pieces.phrases(1)[1]
    for h, step in zip(word[:3], (1, 3, 2)):
        tables[0][int(h) & 0xFFFF] = step
    h, born = collocations.births(pieces, tables, 2)
    assert pieces.phrases(2)[0].tolist() == [0, 1, 3, 5] and born.tolist() == [3, 3, 3, 3]
    assert h[0] == h[2] != h[1] == h[3]
    assert collocations.births(pieces, tables, 3)[1].tolist() == [0]
