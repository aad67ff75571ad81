import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from eventlake.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check(rows, got, capacity=1024):
    plain = Tokenizer.from_file(PATH)
    want = []
    for i, t in rows:
        ids = np.array([*plain.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        n, at, k = len(ids), 0, 0
        while at < n:
            stop = min(n, at + capacity) if n <= capacity else at + ((n - 1) % capacity + 1 if k == 0 else capacity)
            want.append((i, k, at, stop - at, zlib.crc32(ids[at:stop].tobytes())))
            at, k = stop, k + 1
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(want, key=key)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), sum(x[3] for x in want)


def test_pack_round_trip(spark, docs_df, rng):
    words = ["Hello", "world", "größe", "x1", "don't", "--", "ñandú", "the", "of"]
    rows = [(0, ""), (1, None), (2, " "), (3, "a\n\nb"), (4, "word " * 9000), (5, "a  b\tc\x1c d"), (5, "again"), (None, "null id")]
    rows += [(k, " ".join(rng.choice(words, int(rng.integers(1, 900))))) for k in range(10, 200)]
    df = docs_df([(i, t, "s") for i, t in rows])
    n, tokens = check(rows, packing.pack(packing.pieces(df, PATH)).collect())
    assert n <= 1.02 * -(-tokens // 1024) + 1
    n, tokens = check(rows, packing.pack(packing.pieces(df, PATH, 64), 64, open_bins=8, group_rows=50).collect(), 64)
    assert n <= 1.2 * -(-tokens // 64) + 8
    assert packing.pack(packing.pieces(df.where("false"), PATH)).count() == 0


def test_fullest_closes_first():
    p = packing.BestFit(10, 2)
    assert [p.put(n) for n in (6, 7, 8)] == [(0, 0), (1, 0), (2, 0)]  # the third bin closes at once: it is the fullest
    assert p.put(2) == (1, 7) and p.put(4) == (0, 6) and p.put(2) == (3, 0)
