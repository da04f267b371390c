import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gaugeworks.llm import bit_packing, queries
from odd_documents import SF, docs, nothing, texts  # noqa: F401

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("width", range(1, 33))
def test_round_trip_of_any_width(width):
    rng = np.random.default_rng(width)
    for n in (0, 1, 31, 32, 33, 1000):
        ids = rng.integers(0, 2**width, n, dtype=np.uint64).astype(np.uint32)
        raw = bit_packing.pack(ids, width)
        assert len(raw) == -(-n // 32) * 4 * width and np.array_equal(bit_packing.unpack(raw, width, n), ids)


def test_width_is_the_least():
    assert [bit_packing.bit_width(v) for v in (1, 2, 3, 256, 257, 50257, 65536, 65537)] == [1, 1, 2, 8, 9, 16, 16, 17]
    with pytest.raises(ValueError):
        bit_packing.file_bytes([1], [np.array([8], np.uint32)], 3)


def test_file_reads_only_the_blocks_it_needs():
    rng = np.random.default_rng(0)
    parts = [rng.integers(0, 2000, n).astype(np.uint32) for n in (5, 0, 700, 64, 1, 3000, 0)]
    raw = bit_packing.file_bytes([None, 3, 3, -9, 2**60, 7, 8], parts, 11, 64)
    asked = []

    def fetch(at, n):
        asked.append(n)
        return raw[at:at + n]

    f = bit_packing.BitFile(fetch)
    assert f.n_blocks == 59 and f.valid.tolist() == [False] + [True] * 6 and f.doc_ids[4] == 2**60
    for k, p in enumerate(parts):
        asked.clear()
        assert np.array_equal(f.document(k), p) and sum(asked) <= (len(p) + 126) // 64 * 88
    assert np.array_equal(f.ids(0, f.n_ids), np.concatenate(parts))
    with pytest.raises(ValueError):
        bit_packing.BitFile(lambda at, n: b"x" * n)


def test_pieces_give_the_ids_of_whole_texts(texts):  # noqa: F811
    odd = ["", " ", "  a  b ", "\n a\n\n  b\t c", "it's  ok 's <|endoftext|> x<|endoftext|>y", "\x00 a", "\x00", "a \x1c b", "é  ü 　 x\xa0 y", "12 34  56 !!  ?"]
    many = [t or "" for t in texts] + odd
    tok = Tokenizer.from_file(FILE)
    for special in (False, True):
        tok.encode_special_tokens = special
        want = [tok.encode(t, add_special_tokens=False).ids for t in many]
        for enc in (bit_packing.PieceEncoder(FILE, special), bit_packing.PieceEncoder(FILE, special, whole=True)):
            assert [e.tolist() for k in (0, 1) for e in enc(many)] == want * 2


def test_cache_stays_bounded(monkeypatch):
    monkeypatch.setattr(bit_packing, "CACHE_PIECES", 50)
    enc, tok = bit_packing.PieceEncoder(FILE), Tokenizer.from_file(FILE)
    for k in range(40):
        text = " ".join(f"w{k}x{j}" for j in range(20))
        assert enc([text])[0].tolist() == tok.encode(text).ids and len(enc._known) <= 71


def expected(rows):
    tok, at, out = Tokenizer.from_file(FILE), 0, []
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize("file_ids", [bit_packing.FILE_IDS, 500])
def test_files_hold_all_documents_in_order(spark, docs, file_ids):  # noqa: F811
    folder = bit_packing.fresh_folder(spark)
    made = bit_packing.write_files(docs.repartition(5), folder, FILE, file_ids=file_ids, block_ids=96).collect()
    got = bit_packing.read_documents(spark, folder).orderBy("start").collect()
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0)) and sum(m["n_docs"] for m in made) == len(got) == docs.count()
    assert [r["start"] for r in got] == np.cumsum([0] + [r["n_tokens"] for r in got])[:-1].tolist()
    want = expected([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got), key=str) == sorted(((i, n, c) for i, _, n, c in want), key=str)
    assert len(made) > (20 if file_ids == 500 else 0)
    first = min(made, key=lambda m: m["file"])
    assert zlib.crc32(bit_packing.read_ids(f"{folder}/{first['file']}", 0).astype("<u4").tobytes()) == got[0]["ids_crc32"]


def test_empty_table(spark, nothing):  # noqa: F811
    folder = bit_packing.fresh_folder(spark)
    assert bit_packing.write_files(nothing, folder, FILE).count() == 0
    assert bit_packing.read_documents(spark, folder).count() == 0


def test_query_equals_the_library(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]
    got = queries.op12_bit_packed_ids(spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == expected(rows)
