"""The pool of token ids against a plain dictionary."""

import numpy as np

from chartloom.llm.id_pool import IdPool


def test_pool_finds_what_it_learnt_and_forgets():
    rng = np.random.default_rng(1)
    learnt = []

    def learn(words):
        learnt.extend(words)
        size = np.array([1 + w % 3 for w in words])
        return np.repeat(np.array(words, dtype=np.uint32), size), size

    pool = IdPool(learn, words_kept=400)
    for _ in range(20):
        # in no order, some of them near the end of the range
        words = rng.permutation(1000)[: rng.integers(1, 200)]
        hashes = words.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        ids, end = pool.gather(pool.places(hashes, lambda at: words[at].tolist()))
        assert ids.tolist() == [w for w in words.tolist() for _ in range(1 + w % 3)]
        assert end.tolist() == np.cumsum(1 + words % 3).tolist()
        # held as sorted arrays, looked up without a step of Python for each word
        assert pool.known.dtype == np.uint64 and (np.diff(pool.known.astype(object)) > 0).all()
        assert len(pool.known) == len(pool.number) <= 400 + 200
    assert len(learnt) > len(set(learnt)) > 900
    assert pool.places(np.zeros(0, np.uint64), lambda at: []).tolist() == []
