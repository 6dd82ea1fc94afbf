"""Token ids, packing and Arrow files: equal to the library's ids, whole, gapless, and read back."""
import tempfile
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cohortloom.llm import packing, token_files
from cohortloom.llm.tokens import encoder, vocabulary
from tests.llm.fixtures import awkward, frame

FILES = {"byte_bpe_50k.json": True, "word_bpe_49k.json": False}


def plain(name):
    t = Tokenizer.from_file(vocabulary(name))
    return lambda text: t.encode(text, add_special_tokens=False).ids


PLAIN = {name: plain(name) for name in FILES}
SIGNS = st.sampled_from(list("abcÉñß日本'’.,!?-12½\0\n\t   ΣσİA") + ["'s", " the", "<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "é"])


@settings(max_examples=150, deadline=None)
@given(st.lists(SIGNS, max_size=30).map("".join))
@pytest.mark.parametrize("name", FILES)
def test_ids_equal_the_librarys(name, text):
    got = encoder(vocabulary(name), FILES[name]).encode([text, None, "", f"x {text}"])
    assert [g.tolist() for g in got] == [PLAIN[name](text), [], [], PLAIN[name](f"x {text}")]


def test_added_tokens_keep_their_ids():
    text = "a <|endoftext|> b"
    assert encoder(vocabulary("byte_bpe_50k.json"), True).encode([text])[0].tolist() == [64, 220, 50256, 275]
    assert encoder(vocabulary("word_bpe_49k.json"), False).encode([text])[0].tolist() == PLAIN["word_bpe_49k.json"](text)


def test_worker_forgets_and_learns_again(monkeypatch):
    import cohortloom.llm.tokens as tokens

    monkeypatch.setattr(tokens, "CACHE_ENTRIES", 3)
    e = tokens.Encoder(vocabulary("byte_bpe_50k.json"), True)
    for text in ("one two three four five", "six two", "one, two. three"):
        assert e.encode([text])[0].tolist() == PLAIN["byte_bpe_50k.json"](text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 5000), min_size=1, max_size=60))
def test_every_id_is_in_one_piece(lengths):
    windows = packing.pack_lengths(lengths)
    seen = defaultdict(list)
    padded = 0
    for tier, pieces in windows:
        total = sum(p[0] for p in pieces)
        assert 0 < total <= 2048
        if total & (total - 1):
            padded += 1
        else:
            assert total in packing.TIERS or total < 256
        for length, doc, start in pieces:
            seen[doc].append((start, length))
    assert padded <= 1
    for doc, n in enumerate(lengths):
        at = 0
        for start, length in sorted(seen[doc]):
            assert start == at
            at += length
        assert at == n


def test_step_groups_hold_one_tier_and_are_even():
    windows = packing.pack_lengths([700, 1500, 90, 2048, 4000, 33, 512, 800] * 60)
    groups = defaultdict(list)
    for w, g in zip(windows, packing.step_groups(windows, 32_768)):
        groups[g].append(w)
    assert all(len({t for t, _ in ws}) == 1 for ws in groups.values())
    assert all(sum(t for t, _ in ws) <= 32_768 for ws in groups.values())
    for t in packing.TIERS:
        sizes = [len(ws) for ws in groups.values() if ws[0][0] == t]
        assert max(sizes, default=0) - min(sizes, default=0) <= 1


def test_pieces_of_awkward_documents(spark):
    rows = awkward()
    got = packing.pack_documents(frame(spark, rows), vocabulary("byte_bpe_50k.json"), 1, group_tokens=4000).collect()
    ids, places = defaultdict(list), defaultdict(list)
    for r in got:
        ids[r.doc_id].append((r.start, np.frombuffer(r.ids, "<u4")))
        places[r.sequence_id].append((r.offset, r.length))
        assert len(r.ids) == 4 * r.length
    want = {r[0]: [*PLAIN["byte_bpe_50k.json"](r[1] or ""), 1] for r in rows}
    for doc, parts in ids.items():
        parts.sort(key=lambda p: p[0])
        copies = sum(1 for r in rows if r[0] == doc)
        whole = sorted(np.concatenate([p for _, p in parts]).tolist())
        assert whole == sorted(want[doc] * copies)
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
    assert packing.pack_documents(frame(spark, []), vocabulary("byte_bpe_50k.json"), 1).count() == 0


def test_token_files_round_trip(spark):
    rows = awkward()
    folder = tempfile.mkdtemp()
    token_files.write_token_files(frame(spark, rows), folder, vocabulary("word_bpe_49k.json"), 2, sequence=64, rows=4)
    got = token_files.read_token_files(spark, folder, limit=100).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted([r[0] for r in rows], key=lambda i: (i is not None, i))
    want = {r[0]: np.array([*PLAIN["word_bpe_49k.json"](r[1] or ""), 2], "<u4") for r in rows}
    at = 0
    for r in got:
        assert (r.start, r.n_tokens) == (at, len(want[r.doc_id]))
        assert zlib.crc32(r.ids) == zlib.crc32(want[r.doc_id].tobytes())
        at += r.n_tokens
    assert token_files.write_token_files(frame(spark, []), empty := tempfile.mkdtemp(), vocabulary("word_bpe_49k.json"), 2) == []
    assert token_files.read_token_files(spark, empty).count() == 0


def test_sequences_are_views_with_masks(spark):
    folder = tempfile.mkdtemp()
    docs = frame(spark, awkward()).coalesce(1)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        shards = token_files.write_token_files(docs, folder, vocabulary("word_bpe_49k.json"), 2, sequence=64, rows=4)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    shard = token_files.TokenFile(folder, shards[0]["shard"])
    assert len(shard) == shards[0]["n_sequences"]
    stream = np.concatenate([shard.ids(k)[shard.mask(k)] for k in range(len(shard))])
    assert len(stream) == shards[0]["n_tokens"]
    assert np.array_equal(stream, shard.stretch(0, shards[0]["n_tokens"]))
    assert not shard.ids(1).flags.owndata and not shard.mask(len(shard) - 1).all()
