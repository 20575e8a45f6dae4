import unicodedata
import zlib

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from tessera.llm import token_files as tf  # noqa: E402
from tessera.llm.common import scratch_path  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_encoder_is_the_library():
    coder = tf.Encoder(PATH)
    assert coder.odd is not None
    points = [chr(c) for c in range(0x300)]
    texts = ["".join(points), " ".join(points), "a".join(points), "It's 'sTART we'Ll don't !!'s ''ve x<|endoftext|>y", "ΑΣ Σ ς İI ﬁ é 東京 ퟿", "", " ", "\x85\xa0\x1c\x1dab", "1234 ½²", "Ünï-cödé_x __ ..."]
    texts += [f"x{p}y {p}{p} '{p}" for p in points]
    for text, raw in zip(texts, coder.encode(texts), strict=True):
        assert np.frombuffer(raw, coder.kind).tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids, ascii(text)
    other = tf.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert other.odd is None
    assert np.frombuffer(other.encode(["Some text"])[0], other.kind).tolist() == other.tokenizer.encode("Some text", add_special_tokens=False).ids


def test_round_trip(spark, messy, messy_rows):
    folder = scratch_path(spark, "tokens")
    shards = tf.write(messy, folder, PATH, shards=3)
    library = tf.Encoder(PATH).tokenizer
    ids = {t: library.encode(t, add_special_tokens=False).ids + [2] for t in {r[1] or "" for r in messy_rows}}
    got = tf.read(spark, folder, shards).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((r[0] for r in messy_rows), key=lambda i: (i is not None, i or 0))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == sorted((-1 if r[0] is None else r[0], len(x := ids[r[1] or ""]), zlib.crc32(np.array(x, "<u4").tobytes())) for r in messy_rows)
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    from tessera.llm import files

    system, name = files.at(f"{folder}/dictionary")
    with system.open_input_file(name) as f:
        dictionary = f.read()
    assert dictionary
    texts = {r[0]: r[1] for r in messy_rows}
    shard = tf.Shard(shards[-1][0], dictionary)
    for i in (0, shard.documents - 1):
        assert shard.read(i).tolist() == ids[texts[shard.doc_id[i]] or ""]
    with pytest.raises(ValueError, match="another dictionary"):
        tf.Shard(shards[0][0], b"other")


def test_empty(spark, none):
    assert tf.round_trip(none, PATH).count() == 0
    assert unicodedata.category("a") == "Ll"
