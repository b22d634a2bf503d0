"""Toxicity: words are hashed in arrays, examples' terms are numbered in tasks, the index is the same however it is built."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np

from cellscope.llm import toxicity_knn


def _by_hand(text: str | None) -> list[int]:
    """Sorted counts of the words and of their beginnings, told apart as text."""
    words = "".join(c if c.isascii() and c.isalnum() or ord(c) >= 128 else " " for c in text or "")
    words = [w.encode("utf-8", "surrogatepass") for w in "".join(c.lower() if c.isascii() else c for c in words).split(" ") if w]
    count = Counter(words) + Counter((w[:n], n) for w in words for n in toxicity_knn.STEMS if len(w) > n)
    return sorted(count.values())


def test_terms_are_counted_as_by_hand_and_hashed_in_arrays(monkeypatch):
    rng = random.Random(5)
    lengths = [*range(1, 20), 63, 64, 65, 66, 200]
    texts = [" ".join("aé"[rng.random() < 0.1] * rng.choice(lengths) + rng.choice("abC1") for _ in range(200)) for _ in range(20)]
    texts += ["", None, " ,", "abcdefgh abcdefghi abcdefghj abcdefgh", "a\x00b\tA b", "x" * 3000, "half \ud800 pair", " ".join(f"w{k % 700}" for k in range(300_000))]
    hashed, plain = [], toxicity_knn.xxhash.xxh3_64_intdigest
    monkeypatch.setattr(toxicity_knn.xxhash, "xxh3_64_intdigest", lambda w: hashed.append(w) or plain(w))
    text, term, n = toxicity_knn.Terms()(texts)
    assert all(len(w) > toxicity_knn.LONG_WORD for w in hashed)  # every new word was hashed by itself
    for k, given in enumerate(texts):
        assert sorted(n[text == k].tolist()) == _by_hand(given)
    hashes = np.unique(term.view(np.uint64))[::2]
    known = np.isin(term.view(np.uint64), hashes)
    want = sorted(zip(text[known].tolist(), np.searchsorted(hashes, term[known].view(np.uint64)).tolist(), n[known].tolist()))
    assert list(zip(*(a.tolist() for a in toxicity_knn.Terms(hashes)(texts)))) == want
    assert [len(a) for a in toxicity_knn.Terms(hashes[:0])(texts)] == [0] * 3


def test_driver_gets_numbered_terms(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(i, i % 2, " ".join(f"word{rng.randrange(300)}" for _ in range(400))) for i in range(200)]
    examples = spark.createDataFrame(rows, "doc_id long, toxic int, text string").repartition(4)
    taken = []
    kind = type(examples)
    plain = kind.toArrow
    monkeypatch.setattr(kind, "toArrow", lambda self: taken.append(plain(self)) or taken[-1])
    _, _, hashes, term, _, _ = toxicity_knn._read_examples(examples)
    assert len(term) > 20 * len(hashes)
    assert sum(t.nbytes for t in taken) < 10 * len(term) + 100 * len(hashes) + 20_000  # 12 bytes a term with 64-bit hashes


def test_index_holds_the_examples_in_order():
    rng = np.random.default_rng(9)
    rows = []
    for _ in range(500):
        terms = np.unique(rng.integers(0, 900, rng.integers(0, 60))).astype(np.int32)
        rows.append(((terms, rng.integers(1, 5, len(terms)).astype(np.int32)), int(rng.integers(0, 2))))
    index = toxicity_knn.Index(rows, np.linspace(1, 3, 900), {0: 1.0, 1: 2.0}, list(range(500)))
    assert sorted(index.ids) == [k for k, ((t, _), _) in enumerate(rows) if len(t)] and index.labels.tolist() == sorted(index.labels.tolist())
    for (vector, label, k) in index.rows:
        (terms, counts), given = rows[k]
        assert label == given and vector == dict(zip(terms.tolist(), index.unit(terms, counts).tolist()))
    for t in range(900):
        assert (np.diff(index.place[index.starts[t]:index.starts[t + 1]]) > 0).all()
    queries = [(t, index.unit(t, n)) for (t, n), _ in rows if len(t)]
    dense = np.zeros((len(index.ids), 900))
    for place, (vector, _, _) in enumerate(index.rows):
        dense[place, list(vector)] = list(vector.values())
    for (t, w), found in zip(queries, index.best(queries)):
        brute = np.sort(dense[:, t] @ w)[::-1][:toxicity_knn.NEIGHBOURS]
        assert np.allclose([s for s, _ in found], brute[brute > 0], atol=1e-5)
