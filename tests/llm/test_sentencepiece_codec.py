from __future__ import annotations

import hashlib
import random
from collections import Counter

import sentencepiece

from dispersa.llm import sentencepiece_codec as C
from dispersa.llm.queries import vocabulary
from tests.llm import cases

PATH = vocabulary("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_codec_equals_the_library():
    codec, rng = C.Codec(PATH), random.Random(1)
    texts = ["", " ", "  ", "a  b", "\n\n a", "   x   y  ", "▁a ▁▁ b", "ﬁ é 𝒳 日本語\u0000 x\ty\r\n z", "<s> <unk> <0x0A>",
             " " * 40 + "b", "a" + " " * 33, "t" * 40, "==== ----- ,,,,,,", "    def f(x):\n        return x**2\n"]
    for letters in ("abcdefghijklmnopqrstuvwxyzétion .,-=()\n 0123456789ABC日本のд", "aein t="):
        texts += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 30))) for _ in range(1500)]
    for t in texts:
        ids = LIBRARY.encode(t)
        assert codec.encode(t) == ids
        assert codec.decode(ids) == LIBRARY.decode(ids)


def test_round_trip_digests(spark):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = Counter()
    for i, t in cases.awkward():
        ids = LIBRARY.encode(t or "")
        want[(i, len(ids), sha(",".join(map(str, ids))), sha(LIBRARY.decode(ids)))] += 1
    assert cases.rows_of(C.round_trip(cases.frame(spark, cases.awkward()), PATH)) == want
    assert C.round_trip(cases.empty(spark), PATH).count() == 0


def test_encode_and_decode_columns(spark):
    coded = C.encode(cases.frame(spark, cases.awkward()), PATH, ids_col="tokens")
    assert sorted(coded.columns) == sorted(cases.empty(spark).columns)
    back = C.decode(coded, PATH, ids_col="tokens", text_col="back")
    assert all(r.back == (r.text or "") for r in back.collect())


def test_marks_are_chunks_of_their_own():
    """A word is one cached chunk whatever marks follow it."""
    codec, rng = C.Codec(PATH), random.Random(2)
    text = "a word word. word, (word) word;» word² word!!"
    assert Counter(codec.chunks(text))[" word"] == 6
    assert "".join(codec.chunks(text)) == " " + text
    letters = "ab de.,;»“…²–†«()'$\n▁ 漢é19"
    for t in [text] + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 40))) for _ in range(3000)]:
        assert codec.encode(t) == LIBRARY.encode(t)


def test_models_with_pieces_across_marks_keep_words_whole():
    assert C._chunk_pattern(["a", ".", "▁.", ".»"]).findall(" a.» a") == [" a", ".»", " a"]
    assert C._chunk_pattern(["a", ".", "»a", ".»"]).findall(" a.» a") == [" a.»", " a"]
