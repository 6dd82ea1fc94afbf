"""Periodic runs against a plain search over all periods, and the registered query on a small table."""
import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from cohortloom.llm import periodic_runs
from cohortloom.llm.queries import QUERIES
from tests.llm.fixtures import awkward, frame, prose, row


def plain(words):
    """(start, length, period) of all runs, by start, then period."""
    n, out = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            a = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            inside = any(x <= a and i + q <= x + y and p < q for x, y, p in out)
            if i + q - a >= max(24, 3 * q) and not inside:
                out.append((a, i + q - a, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(words, found):
    gone = {i for a, n, q in found for i in range(a + q, a + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def text_of_kind(r):
    n, signs = r.randint(0, 600), r.choice([1, 2, 3, 40])
    words = [str(r.randint(1, signs)) for _ in range(n)]
    kind = r.randint(0, 4)
    if kind == 0 and n:  # one period, some words changed
        p = r.randint(1, max(1, n // 3))
        words = [words[i % p] for i in range(n)]
        for _ in range(r.randint(0, 3)):
            words[r.randrange(n)] = "x"
    elif kind == 1:  # runs inside the period of a longer run
        unit = ["a"] * r.randint(1, 90) + ["b"] * r.randint(0, 4)
        words = (words[:30] + (unit * r.randint(1, 6) + ["c"] * r.randint(0, 30)) * r.randint(1, 4))[:800]
    elif kind == 2:  # a word sequence that misleads sums modulo a power of two
        words = ["0"]
        while len(words) < n:
            words += ["1" if w == "0" else "0" for w in words]
        words = words[:n] * r.randint(1, 3)
    return words


@pytest.mark.parametrize("seed", range(12))
def test_runs_equal_a_plain_search(seed):
    r = random.Random(seed)
    texts = [text_of_kind(r) for _ in range(8)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array([" ".join(t) for t in texts])], names=["id", "text"])
    for words, got in zip(texts, periodic_runs._rows(batch).to_pylist()):
        found = [(x["start"], x["length"], x["period"]) for x in got["runs"]]
        assert found == plain(words)
        assert got["n_words"] == len(words) and got["collapsed"] == collapse(words, found)


def test_misled_hashes_are_caught(monkeypatch):
    """With hashes that are always equal every seed is extended too far; the scan word by word mends it."""
    words = [str(i % 7) for i in range(70)] + [str(i) for i in range(70)]
    ids = np.array([zlib.crc32(w.encode()) * 2 + 1 for w in words] + [0], np.uint64)
    monkeypatch.setattr(periodic_runs.Sequence, "spans", lambda self, at, n: np.zeros(len(at), np.uint64))
    seq = periodic_runs.Sequence(ids)
    start, end = seq.extend(np.array([10]), np.array([7]))
    got = periodic_runs._exact(seq, np.array([0, len(ids)]), start, end, np.array([7]), 24, 3)
    assert (0, 77, 7) in set(zip(*[x.tolist() for x in got]))


def test_unary_text_is_linear():
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["la " * 300_000])], names=["id", "text"])
    got = periodic_runs._rows(batch).to_pylist()[0]
    assert got["runs"] == [{"start": 0, "length": 300_000, "period": 1}] and got["collapsed"] == "la"


def test_awkward_rows_and_empty_table(spark):
    rows = awkward() + [row(20, "x y\x0bz " * 40), row(21, "x\u00a0y " * 30)]
    found = periodic_runs.periodic_runs(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    texts = sorted(re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t, *_ in rows)
    assert sorted(r.n_words for r in found) == sorted(len(t) for t in texts)
    by_id = {r.doc_id: r for r in found}
    assert by_id[1].collapsed == "" and by_id[1].runs == []
    assert [tuple(r) for r in by_id[20].runs] == [(0, 120, 3)] and by_id[20].collapsed == "x y z"
    assert [tuple(r) for r in by_id[21].runs] == [(0, 30, 1)]
    assert periodic_runs.periodic_runs(frame(spark, [])).count() == 0


def test_query_equals_plain_version(spark, tmp_path):
    r = random.Random(3)
    rows = awkward() + [row(100 + i, prose(i, r.randint(1, 400))) for i in range(60)]
    rows += [row(300, "k l m n o p " * 9 + "q " * 30 + "k l m n o p " * 5), row(301, "a b " * 12 + "c d " * 12)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    want, repeated = [], 0
    for i, text, *_ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h, n = zlib.crc32(str(i).encode()), len(words)
        if i is not None and h % 10 == 0 and n:
            g, repeated = h // 10, repeated + 1
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[j] if j < a else words[a + (j - a) % p] for j in range(n)]
        found = plain(words) if n < 2000 else []
        best = min(found, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2])) if found else (None, None, None)
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        milli = 1000 * best[1] // best[2] if found else None
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in found)
        want.append((i, len(found), *best, milli, digest(lines), digest(collapse(words, found))))
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = [tuple(x) for x in QUERIES["op13_periodic_runs"](spark, str(tmp_path)).select(columns).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and repeated >= 4
