from __future__ import annotations

import random
import zlib

import pyarrow.parquet as pq

from dispersa.llm import token_files as F
from dispersa.llm.queries import vocabulary
from tests.llm import cases

PATH = vocabulary("word_bpe_49k.json")


def test_encoder_equals_the_library():
    import numpy as np
    from tokenizers import Tokenizer

    library, encoder = Tokenizer.from_file(PATH), F.Encoder(PATH)
    rng = random.Random(3)
    letters = "abcÉéßÀÿœŒǅΣσςİı'sStTlL019 .,!|<>#\n\t \u0085　́日"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 25))) for _ in range(1500)]
    for t in texts + ["<|startoftext|> a<|endoftext|>b", "ΑΣ ΑΣΑ", "", "they'll don't 'S"]:
        assert np.frombuffer(encoder.encode(t.encode()), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids


def test_files_hold_all_documents_in_order(spark):
    import numpy as np
    from tokenizers import Tokenizer

    rows = cases.awkward() + [(i, f"text number {i}") for i in range(50, 90)]
    got = F.digests(F.token_files(cases.frame(spark, rows), PATH, 2)).collect()
    library, start = Tokenizer.from_file(PATH), 0
    want = {}
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        want.setdefault(i, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert len(got) == len(rows)
    ordered = sorted(got, key=lambda r: r.start)
    keys = [-1 if r.doc_id is None else r.doc_id for r in ordered]
    assert keys == sorted(keys)
    for r in ordered:
        assert r.start == start
        start += r.n_tokens
    for i in want:
        assert sorted(want[i]) == sorted((r.n_tokens, r.ids_crc32) for r in got if r.doc_id == i)


def test_encodings_and_page_index(spark, tmp_path):
    F.write_tokens(cases.frame(spark, [(i, "some words " * 50) for i in range(200)]), str(tmp_path / "t"), PATH, 2)
    for file in (tmp_path / "t").glob("part-*"):
        meta = pq.ParquetFile(file).metadata.row_group(0)
        for c in range(meta.num_columns):
            column = meta.column(c)
            if column.path_in_schema.startswith("tokens"):
                assert "DELTA_BINARY_PACKED" in column.encodings
            elif column.path_in_schema == "doc_id":
                assert column.has_column_index and column.has_offset_index


def test_empty_table(spark):
    assert F.digests(F.token_files(cases.empty(spark), PATH, 2)).count() == 0


def test_a_large_vocabulary_of_words_is_encoded_once():
    encoder, asked = F.Encoder(PATH), []
    make = encoder._word_ids
    encoder._word_ids = lambda words: asked.extend(words) or make(words)
    letters = "abcdefghijklmnopqrst"
    words = ["".join(letters[i // 20 ** k % 20] for k in range(4)) for i in range(95_000)]
    for _ in range(2):
        for i in range(0, len(words), 1000):
            encoder.encode(" ".join(words[i: i + 1000]).encode())
    assert len(asked) == len(words)
