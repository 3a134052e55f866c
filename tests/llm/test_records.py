"""Record files: checksums, frames, order, shuffled reads, damage, and ids equal to the library's."""

import json
import zlib

import numpy as np
import pyarrow as pa
import pytest

from echowire.llm import checksums, record_files

VOCABULARY = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


def plain_crc32c(data):
    register = 0xFFFFFFFF
    for byte in data:
        register ^= byte
        for _ in range(8):
            register = (register >> 1) ^ (0x82F63B78 if register & 1 else 0)
    return register ^ 0xFFFFFFFF


def library_ids(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.encode_special_tokens = True
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]


def test_checksum_is_castagnoli():
    assert plain_crc32c(b"123456789") == 0xE3069283
    words = np.random.default_rng(3).integers(0, 2**32, 4000, dtype=np.uint32)
    starts, ends = np.array([0, 1, 65, 200, 264]), np.array([1, 65, 200, 264, 4000])
    expected = [plain_crc32c(words[a:b].tobytes()) for a, b in zip(starts, ends)]
    assert checksums.crc32c(words, starts, ends).tolist() == expected


def test_frame_bytes():
    doc_ids, lists = pa.array([-2, None], pa.int64()), pa.array([[5, 6, 7], []], pa.list_(pa.int32()))
    words, starts, counts = record_files.framed(doc_ids, lists)
    assert counts.tolist() == [3, 0]
    data = words.astype("<u4").tobytes()
    payload = (-2).to_bytes(8, "little", signed=True) + (2 + 4).to_bytes(4, "little") + bytes([5, 0, 6, 0, 7, 0, 0, 0])

    def masked(part):
        crc = plain_crc32c(part)
        return (((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF).to_bytes(4, "little")

    length = len(payload).to_bytes(8, "little")
    assert data[: 4 * starts[1]] == length + masked(length) + payload + masked(payload)
    doc_ids, ids = record_files.unframed(words, starts[:-1], np.array([2, 0]))
    assert doc_ids.to_pylist() == [-2, None] and ids.to_pylist() == [[5, 6, 7], []]


def test_wide_and_narrow_records_together():
    both = [[1, 2, 3], [], [70_000, 5], [65_535], [2**31 - 1]]
    parts = [record_files.framed(pa.array([i], pa.int64()), pa.array([x], pa.list_(pa.int32()))) for i, x in enumerate(both)]
    words = np.concatenate([p[0] for p in parts])
    starts = np.cumsum([0, *(len(p[0]) for p in parts[:-1])])
    doc_ids, ids = record_files.unframed(words, starts, np.array([len(p[0]) - 7 for p in parts]))
    assert ids.to_pylist() == both and doc_ids.to_pylist() == list(range(5))


@pytest.mark.parametrize("text", [
    "It's 12 o'clock, we'll GO!!", "ÉCOLE café école Σίσυφος ΣΑΣ", "中文字 text　に x", "a\x1cb\x85c \x00 ​", "",
    "<|endoftext|> is text", "İstanbul ǅ ß ﬁ", "x" * 5000 + " " + "é" * 5000, "don'T 'S 'Re", "١٢٣ ½ Ⅳ 1.5e-3",
])
def test_ids_equal_the_library(text):
    assert [*record_files.WordEncoder(VOCABULARY).encode(text).tolist(), 1] == library_ids([text])[0]


def test_ids_of_every_simple_sign_equal_the_library():
    """Each sign that skips the library's normaliser, alone, doubled and beside others."""
    signs = [chr(c) for c in range(0x21, 0xD7A4) if record_files._SIMPLE.fullmatch(chr(c))]
    assert not [s for s in signs if s.isspace()]
    words = [f"{a}{a} x{a}1{b}" for a, b in zip(signs, [*signs[7:], *signs[:7]])]
    encoder = record_files.WordEncoder(VOCABULARY)
    for between in ("\u2003", "\n"):  # word by word, and as a whole
        text = between.join(words)
        assert len(signs) > 30_000 and [*encoder.encode(text).tolist(), 1] == library_ids([text])[0]


def test_round_trip_in_order(spark, documents, odd_rows, tmp_path):
    rows = [(i, t[:20_000] if t else t) for i, t in odd_rows]
    docs = documents(rows).repartition(5)
    path = str(tmp_path / "records")
    record_files.write_records(record_files.encode(record_files.in_order(docs), VOCABULARY), path)
    held = record_files.read_records(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in held] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i))
    ids = library_ids([t for _, t in rows])
    expected = sorted(((i, x) for (i, _), x in zip(rows, ids)), key=lambda r: (r[0] is not None, r))
    assert sorted(((r.doc_id, r.ids) for r in held), key=lambda r: (r[0] is not None, r)) == expected
    assert [r.start for r in held] == np.cumsum([0, *(len(r.ids) for r in held[:-1])]).tolist()

    shuffled = record_files.read_records(spark, path, seed=7).collect()
    assert sorted(map(repr, shuffled)) == sorted(map(repr, held)) and [r.start for r in shuffled] != [r.start for r in held]
    assert shuffled == record_files.read_records(spark, path, seed=7).collect()

    for r in record_files.digests(record_files.read_records(spark, path)).collect():
        same = next(h for h in held if h.start == r.start)
        assert (r.n_tokens, r.ids_crc32) == (len(same.ids), zlib.crc32(np.array(same.ids, "<u4").tobytes()))


def test_unlisted_files_are_not_read_and_damage_is_found(spark, documents, tmp_path):
    path = str(tmp_path / "records")
    record_files.write_records(record_files.encode(documents([(1, "a b"), (2, "c")]).coalesce(1), VOCABULARY), path)
    (tmp_path / "records" / "part-000000-lost.rec").write_bytes(b"half a record")
    assert record_files.read_records(spark, path).count() == 2
    name = json.loads((tmp_path / "records" / record_files.MANIFEST).read_text())[0]["name"]
    file = tmp_path / "records" / f"{name}.rec"
    data = bytearray(file.read_bytes())
    data[-6] ^= 1
    file.write_bytes(data)
    with pytest.raises(Exception, match="checksum"):
        record_files.read_records(spark, path).collect()


def test_empty_table(spark, documents, tmp_path):
    path = str(tmp_path / "records")
    record_files.write_records(record_files.encode(record_files.in_order(documents([])), VOCABULARY), path)
    assert record_files.digests(record_files.read_records(spark, path)).collect() == []
