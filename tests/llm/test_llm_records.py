"""Record files: checksums, order, reads in any order, against the tokenizers library."""

import glob
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from basketline.llm import records

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [None, "", "   ", "One text.", "One text.", "<|endoftext|> inside", "naïve 日本 \U0001f600", "long words " * 9000]


def plain_crc32c(raw: bytes) -> int:
    crc = 0xFFFFFFFF
    for b in raw:
        crc ^= b
        for _ in range(8):
            crc = crc >> 1 ^ (0x82F63B78 if crc & 1 else 0)
    return crc ^ 0xFFFFFFFF


def plain_masked(crc: int) -> int:
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def library_ids(text):
    tok = Tokenizer.from_file(PATH)
    tok.no_truncation()
    tok.no_padding()
    return [*tok.encode(text or "", add_special_tokens=False).ids, 2]


def test_checksums():
    assert records.crc32c(np.frombuffer(b"123456789", np.uint8), np.array([0, 9])).tolist() == [0xE3069283]
    rng = random.Random(2)
    parts = [rng.randbytes(n) for n in (4, 5, 255, 256, 257, 511, 512, 513, 1000, 2049, 5000, 8)]
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    got = records.crc32c(np.frombuffer(b"".join(parts), np.uint8), offsets)
    assert got.tolist() == [plain_crc32c(p) for p in parts]
    assert records.masked(got).tolist() == [plain_masked(plain_crc32c(p)) for p in parts]
    assert len(records.crc32c(np.zeros(0, np.uint8), np.zeros(1, np.int64))) == 0


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(3)
    rows = list(enumerate(TEXTS)) + [(100 + i, " ".join(rng.choice(["ab", "cd", "efg"]) for _ in range(rng.randrange(60)))) for i in range(300)]
    rows += [(None, "no id"), (None, None), (3, "another text of an id"), (4, "One text.")]
    rng.shuffle(rows)
    frame = spark.createDataFrame([(i, t, 0, "x", "y") for i, t in rows], "doc_id long, text string, start int, file string, mark string")
    return rows, frame.repartition(5)


def test_digests(docs):
    rows, frame = docs
    got = [tuple(r) for r in records.record_digests(frame, PATH).collect()]
    want = sorted((i is not None, i or 0, (ids := library_ids(t)), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, t in rows)
    assert sorted((d is not None, d or 0, n, c) for d, _, n, c in got) == sorted((a, b, len(ids), c) for a, b, ids, c in want)
    # Starts follow each other in the order of doc_id, nulls first, without a gap.
    at = 0
    for doc_id, start, n, _ in sorted(got, key=lambda r: r[1]):
        assert start == at
        at += n
    order = [(d is not None, d or 0) for d, *_ in sorted(got, key=lambda r: r[1])]
    assert order == sorted(order)


def test_files_and_shuffled_reads(spark, docs, tmp_path):
    rows, frame = docs
    folder = str(tmp_path / "out")
    index = records.write_records(frame, PATH, folder)
    assert {r.file for r in index.select("file").distinct().collect()} == {p.split("/")[-1] for p in glob.glob(folder + "/*")}
    # The frames as plain Python reads them.
    found = []
    for path in sorted(glob.glob(folder + "/*.records")):
        raw = open(path, "rb").read()
        while raw:
            (n,) = struct.unpack("<Q", raw[:8])
            assert struct.unpack("<I", raw[8:12])[0] == plain_masked(plain_crc32c(raw[:8]))
            payload = raw[12 : 12 + n]
            if n < 5000:
                assert struct.unpack("<I", raw[12 + n : 16 + n])[0] == plain_masked(plain_crc32c(payload))
            doc_id, width, known, count = struct.unpack("<qHHI", payload[:16])
            found.append((doc_id if known else None, np.frombuffer(payload, f"<u{width}", offset=16).tolist()))
            assert count == len(found[-1][1])
            raw = raw[16 + n :]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted(found, key=key) == sorted(((i, library_ids(t)) for i, t in rows), key=key)
    plain = [(r.doc_id, r.ids) for r in records.read_records(index, folder).collect()]
    assert plain == found
    shuffled = [[(r.doc_id, r.ids) for r in records.read_records(index, folder, seed).collect()] for seed in (1, 1, 2)]
    assert shuffled[0] == shuffled[1] != shuffled[2] and plain not in shuffled
    assert all(sorted(s, key=key) == sorted(found, key=key) for s in shuffled)
    few = index.where("doc_id in (3, 5, 200)")
    assert sorted(r.doc_id for r in records.read_records(few, folder).collect()) == [3, 3, 5, 200]


def test_damage_is_found(spark, tmp_path):
    frame = spark.createDataFrame([(1, "a text that will be damaged")], "doc_id long, text string")
    folder = str(tmp_path / "out")
    index = records.write_records(frame, PATH, folder)
    (path,) = glob.glob(folder + "/*.records")
    raw = bytearray(open(path, "rb").read())
    raw[-6] ^= 1
    open(path, "wb").write(raw)
    with pytest.raises(Exception, match="does not match its checksum"):
        records.read_records(index, folder).collect()


def test_empty_table(spark):
    assert records.record_digests(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
