import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from millrace.llm import byte_tokens
from millrace.llm import pattern_packing as p

PATH = byte_tokens.vocabulary_path()
SLOW = Tokenizer.from_file(PATH)


@pytest.mark.parametrize("text", ["", " ", "a <|endoftext|> b", "<|endoftext|>", "don't  stop\n\n\tnow ", "Élan ß 漢字 🙂🙂", "x" * 5000, " " * 4000,
                                  "1234567 a1b2 __init__(self)", "  x\r\n", "\0\x01 é", "ab " * 3000])
def test_ids_equal_the_tokenizer(text):
    assert byte_tokens.encoder(PATH)(text) == SLOW.encode(text, add_special_tokens=False).ids


def test_a_process_reads_the_vocabulary_once():
    assert byte_tokens.encoder(PATH) is byte_tokens.encoder(PATH)


def check(rows, docs, capacity):
    ids = {i: SLOW.encode(t or "", add_special_tokens=False).ids + [2] for i, t in docs}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(ids)
    for i, own in by_doc.items():
        own.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own))) and len(own) == -(-len(ids[i]) // capacity)
        at = 0
        for r in own:
            part = ids[i][at:at + r["length"]]
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
            assert r["length"] == capacity or not r["piece"]
            at += r["length"]
        assert at == len(ids[i])
    for own in by_sequence.values():
        own.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == [0, *np.cumsum([r["length"] for r in own])[:-1]]
        assert sum(r["length"] for r in own) <= capacity
    return len(by_sequence)


def test_pieces_and_places(make_docs):
    rng = np.random.default_rng(3)
    docs = [(i, "word " * int(n)) for i, n in enumerate(rng.integers(0, 90, 300))] + [(900, None), (901, ""), (902, "long text " * 5000)]
    rows = p.pack(make_docs(docs, ["piece", "length", "deal"]), capacity=64).collect()
    n = check(rows, docs, 64)
    total = sum(r["length"] for r in rows)
    assert n <= -(-total // 64) * 1.02 + 2


def test_odd_tables(make_docs):
    assert p.pack(make_docs([])).collect() == []
    rows = p.pack(make_docs([(1, "a b")] * 5 + [(None, "a b")])).collect()
    assert len(rows) == 6 and len({(r["sequence_id"], r["offset"]) for r in rows}) == 6


def lower_bound(counts, capacity):
    """Martello and Toth's: large pieces stand alone, and middling ones leave only so much room for the others."""
    sizes, best = np.arange(capacity + 1), 0
    for k in range(capacity // 2 + 1):
        alone, middle, small = sizes > capacity - k, (sizes > capacity // 2) & (sizes <= capacity - k), (sizes >= k) & (sizes <= capacity // 2)
        room = counts[middle].sum() * capacity - (counts * sizes)[middle].sum()
        rest = max(0, (counts * sizes)[small].sum() - room)
        best = max(best, counts[alone].sum() + counts[middle].sum() + -(-rest // capacity))
    return int(best)


@pytest.mark.parametrize("seed", range(6))
def test_plans_place_every_piece_and_come_near_the_bound(seed):
    rng = np.random.default_rng(seed)
    counts = np.zeros(129, np.int64)
    counts[1:] = [rng.integers(0, 300, 128), rng.integers(0, 2, 128), rng.integers(0, 9, 128) * (np.arange(1, 129) > 60),
                  rng.integers(0, 9, 128) * (np.arange(1, 129) < 20), rng.poisson(1000 / np.arange(1, 129)), np.zeros(128, int)][seed]
    packed = p.plan(counts, 128)
    placed = np.zeros(129, np.int64)
    for pattern, n in packed:
        assert sum(pattern) <= 128 and n > 0
        for length in pattern:
            placed[length] += n
    assert (placed == counts).all()
    assert sum(n for _, n in packed) <= lower_bound(counts, 128) * 1.01 + 1


def test_fitted_patterns_carry_a_large_histogram():
    counts = np.random.default_rng(8).integers(2000, 9000, 129)
    counts[0] = 0
    left = counts.copy()
    patterns = p.filling_patterns(np.flatnonzero(left[:128]), 128)
    repeats = np.floor(p.fit_repeats(patterns, np.r_[left[:128], 0].astype(float)))
    assert (patterns.sum(1) == 128).all() and repeats @ (patterns > 0).sum(1) > 0.5 * counts.sum()
