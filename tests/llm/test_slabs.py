from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from gristmill.llm.slabs import ByteHashes, slabs


def batches(texts, size):
    rows = pa.table({"id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})
    return rows.to_batches(max_chunksize=size)


@pytest.mark.parametrize("window", [1, 7, 64, 1 << 12])
@pytest.mark.parametrize("lower", [False, True])
def test_buffers_and_words_tell_the_same_words_apart(monkeypatch, window, lower):
    monkeypatch.setattr(ByteHashes, "WINDOW", window)
    draw = random.Random(window)
    letters = ["a", "b", "A", "B", "\u00e4", "\u4e2d", "\x00", " ", "\t", "\n", "\x0b", "\x0c", "\r", "\xa0"]
    texts = ["".join(draw.choices(letters, k=draw.randint(0, 60))) for _ in range(300)]
    texts += [None, "", " ", "x" * 500, "a" * 64 + " " + "a" * 65, "ab ba", "  a", "a  "]
    whole = list(slabs(batches(texts, 50), lower=lower, whole=True))
    single = list(slabs(batches(texts, 50), lower=lower))
    assert np.array_equal(whole[0][0].lens, single[0][0].lens)
    pairs = set(zip(whole[0][0].hashes.tolist(), single[0][0].hashes.tolist(), strict=True))
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def test_place_and_batch_of_a_word_do_not_matter():
    hashes = ByteHashes(lower=True)
    far = b"filler " * 100_000
    assert hashes.of(far + b"Word ")[1][-1] == hashes.of(b"wORD\n")[1][0]
    assert [len(x) for x in hashes.of(b"")] == [0, 0]
