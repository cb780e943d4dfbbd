from __future__ import annotations

import random

import public_tokenizers
import pytest
import sentencepiece

from fleetlake.llm.pieces import CharMap, Encoder, encode_pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "", " ", "   ", "a", " a", "a ", "hello  world", "\n\n tab\tx", "▁", "▁▁a ▁b", "naïve café 😀😀 漢字", "\x00\x01", "<s></s><0x0A>",
    "á ë", "x" * 3000, " " * 500, "ﬁ ① Ａ", "​　",
]


@pytest.fixture(scope="module")
def encoder():
    return Encoder(MODEL)


def random_texts(n):
    rng = random.Random(5)
    letters = "ab the re \n\t▁é😀漢.,!0123AB  "
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(n)]


def test_ids_as_the_library(encoder):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = TEXTS + random_texts(3000)
    for text, (ids, _, _) in zip(texts, encoder.encode(texts)):
        assert ids.tolist() == library.encode(text), repr(text)


def test_spans_cover_the_text(encoder):
    for text, (ids, starts, ends) in zip(TEXTS + random_texts(500), encoder.encode(TEXTS + random_texts(500))):
        raw = text.encode()
        assert ends.tolist()[-1:] == [len(raw)] * bool(raw)
        assert starts.tolist() == [0, *ends.tolist()[:-1]][: len(ids)]
        for i, s, e in zip(ids.tolist(), starts.tolist(), ends.tolist()):
            piece = encoder.library.id_to_piece(i)
            if encoder.library.is_byte(i):
                assert raw[s:e] == bytes([int(piece[3:-1], 16)])
            else:
                assert raw[s:e].decode().replace(" ", "▁") in (piece, piece[1:])


def test_character_map_as_the_library():
    normaliser = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    spec = normaliser.serialized_normalizer_spec()
    from sentencepiece import sentencepiece_model_pb2 as M

    parsed = M.NormalizerSpec()
    parsed.ParseFromString(spec)
    own = Encoder(MODEL)
    own.map = CharMap(parsed.precompiled_charsmap)
    for trim in (True, False):
        own.trim, own.prefix = trim, False
        for text in TEXTS + random_texts(300):
            normal, places = own.normalise(text)
            library = sentencepiece.SentencePieceNormalizer(
                rule_name="nmt_nfkc", add_dummy_prefix=False, remove_extra_whitespaces=trim, escape_whitespaces=True
            )
            assert normal == library.normalize(text), repr(text)
            assert len(places) == len(normal.encode()) + 1
            assert places.tolist() == sorted(places.tolist())


def test_table(spark, encoder):
    rows = [(i, t, "x") for i, t in enumerate([None, *TEXTS, "very long " * 40_000])] + [(1, "twice", "x")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = encode_pieces(df, MODEL).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.ids == encoder.library.encode(r.text or "")
        assert r.decoded == encoder.library.decode(r.ids) and r.ids_ == "x"
        assert len(r.ids) == len(r.starts) == len(r.ends)
    assert encode_pieces(df.limit(0), MODEL).count() == 0
