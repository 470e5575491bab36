import random

import numpy as np
import pyarrow as pa

from tessera.llm.words import run_hashes, slices, window_starts, word_hashes


def test_words_and_windows_agree_with_python():
    random.seed(5)
    alphabet = ["a", "B", "é", "日", " ", "\n", "\t", "\x0b", "\x1c", " ", "xy"]
    texts = ["".join(random.choice(alphabet) for _ in range(random.randint(0, 60))) for _ in range(300)] + ["", None, " ", "end"]
    seen: dict[bytes, int] = {}
    for row, data, offsets in slices(pa.array(texts), most=500):
        hashes, first = word_hashes(data, offsets, False)
        starts, rows = window_starts(first, 3)
        runs = run_hashes(hashes, starts, 3)
        k = 0
        for i in range(len(offsets) - 1):
            words = (texts[row + i] or "").encode().split()
            assert first[i + 1] - first[i] == len(words)
            for w, h in zip(words, hashes[first[i] : first[i + 1]], strict=True):
                assert seen.setdefault(w, int(h)) == int(h)
            for j in range(len(words) - 2):
                assert rows[k] == i and seen.setdefault(b"\0".join(words[j : j + 3]), int(runs[k])) == int(runs[k])
                k += 1
        assert k == len(runs)
    assert len(set(seen.values())) == len(seen)


def test_case_folds_ascii_only():
    def one(text, fold):
        data = np.frombuffer(text.encode(), np.uint8)
        return word_hashes(data, np.array([0, len(data)]), fold)[0][0]

    assert one("WordÉ", True) == one("wordÉ", True) != one("wordé", True)
    assert one("Word", False) != one("word", False)
