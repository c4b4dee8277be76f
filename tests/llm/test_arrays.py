"""Hashes of words tell different words apart."""

import numpy as np

from patentloom.llm import arrays


def thue_morse(n):
    return np.array([ord("ab"[bin(i).count("1") % 2]) for i in range(n)], np.uint8)


def hashed(words, lower=False):
    data = np.frombuffer(b" ".join(words), np.uint8)
    texts = arrays.Texts(np.zeros(1, np.int64), data, np.array([0, len(data)]))
    return arrays.words_of(texts, lower)


def test_words_of_any_length():
    rng = np.random.default_rng(0)
    words = [bytes(rng.integers(97, 123, n, np.uint8)) for n in range(1, 400)] + [b"A", b"a", b"AB", b"ba"]
    words += [b"x" * n for n in (7, 8, 9, 16, 63, 64, 65, 1000)]
    found = hashed(words * 2)
    assert len(found.hash) == 2 * len(words)
    assert (found.hash[: len(words)] == found.hash[len(words) :]).all()
    assert len(set(found.hash.tolist())) == len(set(words))
    assert len(set(hashed(words, lower=True).hash.tolist())) == len({w.lower() for w in words})


def test_structured_words_do_not_clash():
    for n in (32, 64, 1024, 2048, 4096):
        word = thue_morse(n)
        other = np.where(word == ord("a"), ord("b"), ord("a")).astype(np.uint8)
        assert len(set(hashed([word.tobytes(), other.tobytes()]).hash.tolist())) == 2


def test_kept_powers_are_bounded():
    assert len(arrays.powers(3, arrays.KEPT_POWERS + 5)) == arrays.KEPT_POWERS + 5
    assert len(arrays._powers[3]) == arrays.KEPT_POWERS
    assert arrays.powers(3, 4).tolist() == [1, 3, 9, 27]


def held_mb():
    import re

    with open("/proc/self/smaps_rollup") as f:
        return int(re.search(r"\nPss_Anon:\s+(\d+)", f.read())[1]) / 1024


def scattered(n):
    """Objects of 20 KB, of which every hundredth stays."""
    return [x for i, x in enumerate([bytes([i % 256]) * 20_000 for i in range(n)]) if i % 100 == 0]


def test_workers_keep_no_freed_memory():
    kept = []

    def batches(source):
        for n in source:
            kept.extend(scattered(n))
            yield len(kept)

    before = held_mb()
    assert list(arrays.releasing(batches)([5000])) == [50]
    assert held_mb() - before < 30  # some 100 MB where the heap keeps what was freed


def test_released_workers_map_large_arrays_again(monkeypatch):
    sizes = []
    monkeypatch.setattr(arrays, "map_from", sizes.append)
    arrays.release()
    assert sizes == [arrays.MAPPED]
