from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from fleetlake.llm import alignment
from fleetlake.llm.alignment import Aligner, Vocabularies, align, align_tokens, byte_letters, link_pairs, token_links
from fleetlake.llm.csr import Csr
from fleetlake.llm.queries import QUERIES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "", " ", "   ", "a", " a", "a ", "hello  world", "\n\n tab\tx", "a ▁ b", "▁", "naïve café 😀😀 漢字 x", "\x00\x01 y", "<|endoftext|> a",
    "<s> <0x0A>", "á ë", "x" * 3000, " " * 500, "a b c​ d ᠎ e", "it's we'll 12345 67 ... ?!", "a 　 b", "\x1c \x1f a", "don 't",
]


def random_texts(n, seed=5):
    rng = random.Random(seed)
    letters = "ab the re \n\té😀漢.,!'s0123AB   ̀"
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(n)]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def by_hand(libraries, text):
    """(start, end, id) of the tokens of both sides over the bytes of a blank and the text."""
    a, b = libraries
    if not text:
        return [], []
    letters = byte_letters()
    side_a = [(bytes(letters[c] for c in a.id_to_token(i)), i) for i in a.encode(" " + text, add_special_tokens=False).ids]
    side_b = [
        (bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode(), i)
        for i in b.encode(text)
    ]
    out = []
    for side in (side_a, side_b):
        if b"".join(t for t, _ in side) != (" " + text).encode():
            return [], []
        at, placed = 0, []
        for t, i in side:
            placed.append((at, at + len(t), i))
            at += len(t)
        out.append(placed)
    return out[0], out[1]


def groups_by_hand(side_a, side_b):
    """Places of the tokens of each group, from the ends that both sides have."""
    ends = {e for _, e, _ in side_a} & {e for _, e, _ in side_b}
    sides = []
    for side in (side_a, side_b):
        groups = [[]]
        for k, (_, e, _) in enumerate(side):
            groups[-1].append(k)
            if e in ends:
                groups.append([])
        sides.append(groups[:-1])
    return list(zip(*sides))


def expected(libraries, rows):
    placed = [by_hand(libraries, t) for _, t in rows]
    links = []
    for a, b in placed:
        at = {e: j for _, e, j in b}
        links.append([(i, at[e]) for _, e, i in a if e in at])
    counts = Counter(pair for own in links for pair in own)
    highest = {}
    for (_, j), n in counts.items():
        highest[j] = max(highest.get(j, 0), n)
    out = []
    for (doc, _), (a, b), own in zip(rows, placed, links):
        groups = groups_by_hand(a, b)
        spelled = ";".join("|".join(",".join(str(side[k][2]) for k in g) for side, g in zip((a, b), pair)) for pair in groups)
        n_best = sum(counts[p] == highest[p[1]] for p in own)
        digest = hashlib.sha256(spelled.encode()).hexdigest() if a else ""
        out.append((doc, len(a), len(b), len(groups), len(own), n_best, sum(counts[p] for p in own), digest))
    return out


def test_products_as_dense(monkeypatch):
    rng = np.random.default_rng(1)
    for n, k, m in [(1, 1, 1), (7, 5, 3), (40, 30, 50), (3, 0, 4), (0, 3, 2)]:
        left, right = (rng.integers(-2, 3, s) * (rng.random(s) < 0.4) for s in ((n, k), (k, m)))
        made = [Csr.of_entries(*np.nonzero(x), x.shape, x[np.nonzero(x)]) for x in (left, right)]
        for block in (1, 17, 10**6):
            monkeypatch.setattr("fleetlake.llm.csr.BLOCK", block)
            got, dense = made[0].times(made[1]), np.zeros((n, m), np.int64)
            dense[got.row_of_entries(), got.indices] = got.data
            assert (dense == left @ right).all() and got.rows == n
        back = made[0].transposed()
        assert back.rows == k and back.columns == n and (np.sort(back.data) == np.sort(made[0].data)).all()


def test_links_of_each_kind(spark, libraries):
    texts = TEXTS + random_texts(150)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    got = {k: {r.doc_id: [tuple(x) for x in r.links] for r in token_links(df, A, B, k).collect()} for k in ("overlap", "ends", "group")}
    for n, text in enumerate(texts):
        a, b = by_hand(libraries, text)
        shared = [
            (i, j, min(e, f) - max(s, t)) for i, (s, e, _) in enumerate(a) for j, (t, f, _) in enumerate(b) if min(e, f) > max(s, t)
        ]
        assert got["overlap"][n] == shared
        assert got["ends"][n] == [x for x in shared if a[x[0]][1] == b[x[1]][1]]
        assert sorted(got["group"][n]) == [(i, j, 1) for own, other in groups_by_hand(a, b) for i in own for j in other]


def test_units_as_whole_texts(libraries):
    aligner = Aligner(Vocabularies(A, B))
    texts = TEXTS + random_texts(2000)
    want = expected(libraries, list(enumerate(texts)))
    sizes, groups, links = aligner.texts(texts)
    for n, w in enumerate(want):
        assert (*sizes[n].tolist(), len(links[n]) // 4) == w[1:5], repr(texts[n])
        assert (hashlib.sha256(groups[n]).hexdigest() if groups[n] else "") == w[7], repr(texts[n])
    known = len(aligner.slot)
    aligner.texts(texts)
    assert len(aligner.slot) == known


def test_pairs_hold_all_that_can_be_linked(libraries):
    pair_a, pair_b = link_pairs(A, B)
    v = alignment._vocabularies(A, B)
    assert len(pair_a) <= int(v.width_a.sum() + v.width_b.sum()) * 2
    known = set(zip(pair_a.tolist(), pair_b.tolist()))
    for text in random_texts(200, 9):
        a, b = by_hand(libraries, text)
        assert {(i, j) for _, e, i in a for _, f, j in b if e == f} <= known


def test_equal_widths_and_none():
    made = align(np.array([2, 2, 1]), np.array([1, 3, 1]))
    assert made.group_a.tolist() == [0, 0, 1] and made.group_b.tolist() == [0, 0, 1]
    assert align(np.zeros(0, np.int64), np.zeros(0, np.int64)).shared().rows == 0


def test_query_as_by_brute_force(spark, libraries, tmp_path):
    texts = [None, *TEXTS, *random_texts(300, 6), "very long " * 20_000]
    rows = [*enumerate(texts), (3, "twice"), (3, "twice")]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op11_alignment"].run(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "n_links", "n_best", "count_sum"]
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.select(names).collect())) == sorted(expected(libraries, rows))


def test_table(spark):
    df = spark.createDataFrame([(1, "a b", "own"), (2, None, "own")], "doc_id long, text string, links string")
    got = align_tokens(df, A, B).collect()
    assert [r.links_ for r in got] == ["own", "own"] and [len(r.links) for r in got] == [2, 0]
    assert align_tokens(df.limit(0), A, B).count() == 0
