import io
import zlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from tests.llm.helpers import ODD, docs
from tests.llm.test_packing import Tokenizer_
from touchline.llm.token_files import DamagedFile, TokenFileReader, TokenFileWriter, op5_token_frames, read_token_files, write_token_files


def written(entries, **options):
    out = io.BytesIO()
    w = TokenFileWriter(out, **options)
    for doc_id, ids in entries:
        w.add(doc_id, np.array(ids, "<u4").tobytes())
    w.finish()
    return out.getvalue()


def reader(data):
    return TokenFileReader(pa.BufferReader(data))


def test_round_trip_random_access_and_standard_decoding():
    r = np.random.default_rng(1)
    entries = [(i if i % 7 else None, r.integers(0, 50_000, size=int(r.integers(0, 90)))) for i in range(300)]
    data = written(entries, frame_ids=64)
    got = [(d, np.frombuffer(x, "<u4").tolist()) for d, x in reader(data).documents()]
    assert got == [(d, x.tolist()) for d, x in entries]
    some = dict(reader(data).documents({3, 250}))
    assert {d: np.frombuffer(x, "<u4").tolist() for d, x in some.items()} == {d: dict(entries)[d].tolist() for d in (3, 250)}
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert plain == b"".join(np.asarray(x, "<u4").tobytes() for _, x in entries)


def test_only_wanted_frames_are_decompressed():
    data = written([(i, [i] * 50) for i in range(100)], frame_ids=100)
    r = reader(data)
    frames, own = [], r._frame
    r._frame = lambda k: frames.append(k) or own(k)
    assert [d for d, _ in r.documents({42})] == [42]
    assert len(frames) == 1 and len(r.frames) > 10


def test_damage_is_noticed():
    data = bytearray(written([(1, range(1000))]))
    data[20] ^= 1
    with pytest.raises((DamagedFile, zstandard.ZstdError)):
        list(reader(bytes(data)).documents())


def test_no_documents():
    assert list(reader(written([])).documents()) == []


def test_files_of_odd_rows(spark, scratch):
    manifest = write_token_files(docs(spark, ODD), f"{scratch}/t")
    got = read_token_files(manifest, f"{scratch}/t").orderBy("start").collect()
    want = [(d, [*Tokenizer_.encode(t or "", add_special_tokens=False).ids, 1]) for d, t in ODD]
    assert sorted(map(str, want)) == sorted(str((r.doc_id, np.frombuffer(bytes(r.ids), "<u4").tolist())) for r in got)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in got]
    assert [i for i in ids if i is not None] == sorted(i for i in ids if i is not None)
    empty = write_token_files(docs(spark, []), f"{scratch}/e")
    assert read_token_files(empty, f"{scratch}/e").collect() == []


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in op5_token_frames(spark, sf_dir).collect()}
    at, want = 0, {}
    for d, t in sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()):
        ids = np.array([*Tokenizer_.encode(t, add_special_tokens=False).ids, 1], dtype="<u4")
        want[d] = (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert got == want
