import random

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from tessera.llm import token_files as tf  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_pieces_reach_from_the_beginning_to_the_end():
    for n in (0, 1, 63, 64, 65, 100, 1001):
        raw = np.arange(n, dtype="<u2").tobytes()
        got = np.frombuffer(tf._spread(raw, 16, 8, 2), "<u2").tolist()
        if n <= 64:
            assert got == list(range(n))
        else:
            assert len(got) == 64 and got == sorted(set(got)) and got[0] == 0 and got[-1] == n - 1
            assert all(got[a : a + 8] == list(range(got[a], got[a] + 8)) for a in range(0, 64, 8))


def test_the_dictionary_learns_from_the_ends_of_long_texts(spark):
    rng = random.Random(5)
    words = lambda n: " ".join("".join(rng.choice("aeinorst") for _ in range(6)) for _ in range(n))
    start, end = words(60), words(60)
    docs = [(i, " ".join([start] * 500 + [end] * 500)) for i in range(16)]
    coder = tf.encoder(PATH)
    first, last = coder.encode([" ".join([x] * 3) for x in (start, end)])
    assert len(coder.encode([docs[0][1]])[0]) > 1 << 17
    dictionary = tf.train(spark.createDataFrame(docs, "doc_id long, text string"), PATH, doc_id="doc_id", text="text")
    for x in (first, last):
        middle = x[len(x) // 2 // 2 * 2 :][:40]
        assert middle in dictionary
