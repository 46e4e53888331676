import base64
import hashlib
import random
from collections import Counter

import public_tokenizers as P
import tiktoken
from smudgelex.llm import byte_bpe as b

PATH = P.path("byte_bpe_50k.tiktoken")


def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_like_the_library(spark, docs, texts):
    encoding = library()
    out = b.decode_ids(b.encode_texts(docs)).collect()
    want = Counter((i, tuple(encoding.encode_ordinary(t or "")), (t or "").encode()) for i, t, *_ in texts)
    assert Counter((r.doc_id, tuple(r.ids), bytes(r.bytes)) for r in out) == want


def test_random_pieces():
    encoding, merges, rng = library(), b.merges_of(PATH), random.Random(3)
    parts = ["a", "b", "aa", "the", "in", "é", "日本", "🙂", "1", ".", "--", "ing", "zzz", "\x00", "ab" * 9]
    for _ in range(500):
        piece = "".join(rng.choices(parts, k=rng.randint(1, 30)))
        assert merges.encode(piece.encode()) == encoding._encode_single_piece(piece.encode())


def test_empty(no_docs):
    assert b.decode_ids(b.encode_texts(no_docs)).count() == 0
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")
