import io
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from tokenizers import Tokenizer

from eventlake.llm import seekable
from eventlake.llm.common import shared_dir
from eventlake.llm.files import open_file

PATH = public_tokenizers.path("word_bpe_49k.json")


def rows_of(rng):
    words = ["Hello", "World", "GRÖSSE", "x1", "don't", "--", "İstanbul", "ΟΔΟΣ", "9.99", "e\u0301"]
    rows = [(5, ""), (3, None), (-7, "  \n"), (4, "a\tb\x1cc\x01d"), (2, "w " * 60000), (3, "again"), (3, "again"), (None, "no id"), (None, None)]
    return rows + [(int(k), " ".join(rng.choice(words, int(rng.integers(1, 200))))) for k in rng.permutation(np.arange(100, 250))]


def test_round_trip(spark, docs_df, rng):
    rows = rows_of(rng)
    plain = Tokenizer.from_file(PATH)
    ids = [(i, np.array([*plain.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes()) for i, t in rows]
    df = docs_df([(i, t, "s") for i, t in rows])
    path = shared_dir(spark, "seekable-test")
    manifest = seekable.write(df, path, PATH)
    got = seekable.read(manifest).collect()
    none_first = lambda x: (x is not None, x)
    got.sort(key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=none_first)
    at = 0
    for r in got:
        assert r.start == at and r.n_tokens * 4 == len(r.ids) and r.ids_crc32 == zlib.crc32(r.ids)
        at += r.n_tokens
    key = lambda x: (none_first(x[0]), x[1])
    assert sorted(((r.doc_id, bytes(r.ids)) for r in got), key=key) == sorted(ids, key=key)

    wanted = spark.createDataFrame([(3,), (240,), (-7,), (99999,), (None,)], "doc_id bigint")
    found = sorted((r.doc_id, bytes(r.ids)) for r in seekable.lookup(manifest, wanted).collect())
    assert found == sorted(x for x in ids if x[0] in (3, 240, -7))

    # a plain zstandard decoder reads the whole file; a damaged frame is found
    name = manifest.orderBy("file").first().path
    with open_file(name) as f:
        raw = f.read()
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read()
    assert whole == b"".join(bytes(r.ids) for r in got)[: len(whole)]


class Source(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def test_damage_is_found():
    out = Source()
    w = seekable.SeekableWriter(out)
    for k in range(5):
        w.add(k, np.arange(k * 50, dtype="<u4").tobytes())
    w.close()
    raw = bytearray(out.getvalue())
    assert [len(x) for _, x in seekable.SeekableReader(Source(bytes(raw)))] == [0, 200, 400, 600, 800]
    bad = raw.copy()
    bad[int(seekable.SeekableReader(Source(bytes(raw))).offset[3]) + 12] ^= 0x55
    with pytest.raises((ValueError, zstandard.ZstdError)):
        seekable.SeekableReader(Source(bytes(bad))).frame(3)
    with pytest.raises(ValueError):
        seekable.SeekableReader(Source(bytes(raw[:-1])))


def test_empty(spark, docs_df):
    assert seekable.round_trip(docs_df([]).where("false"), PATH).count() == 0
