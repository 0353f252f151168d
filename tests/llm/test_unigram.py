"""Codec and counts against the public library, run as a unigram model over the same pieces."""

import random

import pyarrow as pa
import pytest

from ringlens.llm.sentencepiece_codec import MODEL, _lists, decode, encode
from ringlens.llm.sentencepiece_codec import _texts as _texts_of
from ringlens.llm.token_counts import token_counts
from ringlens.llm.unigram import SPACE, Pieces, Recent, Segmenter, load_pieces

ODD = ["", " ", "  ", "a", "\n", "Hello  world\n\n", " lead", "trail ", "ñoño 你好 😀", "x" * 3000, "a\tb\r\nc", "0123456789 " * 7,
       "ß" * 50, "\u0000", "the" * 30, "  \n \n  ", "日本語テキスト"]


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as proto

    m = proto.ModelProto()
    with open(MODEL, "rb") as f:
        m.ParseFromString(f.read())
    m.trainer_spec.model_type = 1  # unigram search over the same pieces and scores
    return sentencepiece.SentencePieceProcessor(model_proto=m.SerializeToString())


@pytest.fixture(scope="module")
def seg():
    return Segmenter(load_pieces(MODEL))


def _texts(n=400):
    rnd = random.Random(5)
    parts = ["th", "er", "ing", " ", " ", "\n", "ñ", "é", "ou", "1", "2", "%", "Ç", "a", "b", "z", "  ", ".", "你", "\t", "tion", "😀"]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 60))) for _ in range(n)]


def test_ids_equal_the_library(seg, library):
    for t in ODD + _texts():
        assert seg.encode(t) == library.encode(t), t


def test_counts_and_round_trip(seg):
    for t in ODD + _texts():
        assert seg.count(t) == len(seg.encode(t))
        assert seg.decode(seg.encode(t)) == t


def _plain_search(table, text):
    """Ids of the best path over the whole text, without automaton and chunks: every end tries all sizes, longest first."""
    text = (SPACE if table.dummy_prefix and text else "") + text.replace(" ", SPACE)
    known = {p: (i, score) for p, i, score in table.pieces}
    longest, lowest = max(map(len, known)), min(score for _, score in known.values())
    best = [(0.0, 0, 0)]
    for end in range(1, len(text) + 1):
        found = []
        for size in range(min(longest, end), 0, -1):
            if (hit := known.get(text[end - size : end])) is not None:
                found.append((best[end - size][0] + hit[1], size, hit[0]))
        if not any(size == 1 for _, size, _ in found):
            found.append((best[end - 1][0] + lowest - 10.0, 1, -1))
        best.append(max(found, key=lambda f: f[0]))  # the first of equal ones
    ids, end = [], len(text)
    while end:
        _, size, i = best[end]
        ids[:0] = [i] if i >= 0 else [table.byte_ids[b] for b in text[end - 1].encode()]
        end -= size
    return ids


def test_long_mixed_texts_equal_a_plain_search(seg):
    """The library adds in 32-bit floats and is no measure at this length."""
    rnd = random.Random(6)
    parts = ODD + _texts(40)
    for n in (1, 3, 400):
        t = "".join(rnd.choice(parts) for _ in range(n))
        assert seg.encode(t) == _plain_search(seg.table, t)
        assert seg.count(t) == len(seg.encode(t)) and seg.decode(seg.encode(t)) == t
    assert len(t) > 20_000


def test_batches_of_ids_decode_like_single_lists(seg):
    texts = [None, "", None] + ODD + [None] + _texts(50) + ["", None]
    spelling = pa.array([s or b"" for s in seg.table.spelling], pa.large_binary())
    ids = _lists([None if t is None else seg.encode_bytes(t) for t in texts])
    for start, size in [(0, len(texts)), (1, 0), (2, 9), (19, 40), (len(texts) - 1, 1)]:
        assert list(_texts_of(seg, spelling, ids.slice(start, size))) == texts[start : start + size]
    broken = [[seg.table.byte_ids[0xE4]], [1, 2], list(seg.encode("é"))[:1]]  # half a character, control ids
    lists = pa.array(broken, pa.list_(pa.int32()))
    assert list(_texts_of(seg, spelling, lists)) == [seg.decode(b) for b in broken]


def test_longer_last_piece_wins_ties():
    table = Pieces((("a", 0, -1.0), ("b", 1, -1.0), ("ab", 2, -2.0), ("c", 3, -1.0), ("bc", 4, -2.0)),
                   (b"a", b"b", b"ab", b"c", b"bc"), (), 9, False, "ties")
    s = Segmenter(table)
    assert s.encode("ab") == [2] and s.encode("abc") == [0, 4] and s.count("abc") == 2


def test_runs_of_unknown_are_one_piece_without_bytes():
    s = Segmenter(Pieces((("a", 1, -1.0),), (b"?", b"a"), (), 0, False, "unknown"))
    assert s.encode("xxaxyz") == [0, 1, 0] and s.count("xxaxyz") == 3


def test_recent_forgets():
    r = Recent(len, limit=3)
    assert [r["a" * i] for i in range(20)] == list(range(20))
    assert len(r) <= 3 and len(r.old) <= 3


def test_frames(spark):
    rows = [(1, "Hello  world"), (2, None), (3, ""), (4, "x" * 20_000), (4, "x" * 20_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "text AS token_ids", "1 AS n_tokens")
    out = decode(encode(df)).collect()
    assert [r.decoded for r in out] == [t for _, t in rows]
    assert [r.token_ids is None for r in out] == [False, True, False, False, False] and out[2].token_ids == []
    counts = [r.n_tokens for r in token_counts(df).collect()]
    assert counts == [len(r.token_ids or []) for r in out]
    empty = decode(encode(df.limit(0)))
    assert empty.count() == 0 and token_counts(df.limit(0)).count() == 0
