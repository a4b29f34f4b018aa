import base64
import hashlib

import public_tokenizers as P
import tiktoken
from hypothesis import given, settings, strategies as st

from ledgerline.llm import bpe
from tests.llm.conftest import ODD

PATH = P.path("byte_bpe_multi_50k.tiktoken")
MODEL = bpe.MergeReplay(bpe.load_ranks(PATH), P.PATTERN)
ENC = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=MODEL.ranks, special_tokens={})


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=60), st.text("ab", max_size=200), st.text("the in'g\n ", max_size=80)),
                max_size=6))
def test_replay_is_the_sequential_encoding(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    got = list(MODEL.block(texts).ids())
    assert got == [ENC.encode_ordinary(t) for t in texts]
    assert [MODEL.decode(i).decode() for i in got] == texts


def test_any_rank_table():
    """Ranks in which a later merge can be lower than the one that made it possible."""
    tokens = [bytes([i]) for i in range(256)] + [b"bc", b"abc", b"ab", b"aa", b"abab", b"ba", b"bab", b"aaa"]
    ranks = {t: i for i, t in enumerate(tokens)}
    model = bpe.MergeReplay(ranks, P.PATTERN)
    enc = tiktoken.Encoding("x", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    import itertools
    texts = ["".join(x) for n in range(1, 8) for x in itertools.product("abc", repeat=n)]
    assert list(model.block(texts).ids()) == [enc.encode_ordinary(t) for t in texts]


def test_digests_round_trip_and_odd_rows(spark, docs_of):
    docs = docs_of(ODD)
    rows = bpe.digests(docs, PATH, P.PATTERN, with_ids=True).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        ids = ENC.encode_ordinary(r.text or "")
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    ids = bpe.encode(docs, PATH, P.PATTERN)
    back = bpe.decode(ids, PATH, P.PATTERN).collect()
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in back)
    assert bpe.digests(docs_of([]), PATH, P.PATTERN).count() == 0


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "hi there", "mine", 5)], "doc_id long, text string, ids string, n_tokens int")
    r = bpe.encode(df, PATH, P.PATTERN).first()
    assert r.ids == ENC.encode_ordinary("hi there") and r.n_tokens == 5


def test_rank_file_format(tmp_path):
    f = tmp_path / "r"
    f.write_bytes(b"\n".join(base64.b64encode(bytes([i])) + b" %d" % i for i in range(256)))
    assert bpe.load_ranks(str(f))[b"a"] == 97
