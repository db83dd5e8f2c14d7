"""Binary records: encoding, framing, order and reading back."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from logweir.llm import records
from logweir.llm.queries import tokenizer_path

ODD = [
    "",
    " ",
    "a  b\n\nc \t d",
    "x  y z  ",
    "  lead",
    "it's  don't 'll\n\n\n",
    "<|endoftext|> a<|endoftext|>",
    "a \u0085b",
    " \n a",
    "​ a　 b",
    " " * 50 + "a",
    "\na b\n c\n",
    "a\nb\nc\nd",
    "a\n\nb",
    "a\n\n\nb c",
    "x\n  b",
    "it's, a... b!? c$$$ 3## é,, -- ._. \n",
    "a1. é! x;\ny. Z\nW! ʰ. ǅ, ß.\n\nq",
    "word " * 40_000 + "end",
    "x" * 30_000,
]


@pytest.fixture(scope="module")
def encoder():
    return records.Encoder(tokenizer_path())


def plain(encoder, texts):
    return [x.ids for x in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_encoder_equals_the_tokenizer(encoder, spark, sf):
    texts = ODD + [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    want = plain(encoder, texts)
    for _ in range(2):  # the second time from memory
        assert [x.tolist() for x in encoder(pa.array(texts))] == want
    known, records.KNOWN = records.KNOWN, 10
    try:
        assert [x.tolist() for x in encoder(pa.array(texts))] == want
    finally:
        records.KNOWN = known


def test_added_tokens_are_encoded_as_the_file_says(encoder):
    from tokenizers import Tokenizer

    texts = ["a<|endoftext|>b", "a <|endoftext|> b", "<|endoftext|>", "a <|endof text|> b", "a b", "a b.<|endoftext|>", *ODD]
    own = Tokenizer.from_file(tokenizer_path())
    want = [x.ids for x in own.encode_batch(texts, add_special_tokens=False)]
    assert want[0] == [64, 50256, 65]
    assert [x.tolist() for x in encoder(pa.array(texts))] == want


def test_frame_and_damage():
    data = records.frame(5, b"\x01\x00\x02\x00", False) + records.frame(None, b"\x01\x00\x01\x00", True)
    found = list(records.records(data))
    assert [(d, ids.tolist()) for _, _, d, ids in found] == [(5, [1, 2]), (None, [65537])]
    assert found[1][0] == found[0][1] and found[0][1] + found[1][1] == len(data)
    for at in (0, 9, 14, 26, len(data) - 3):
        hurt = bytearray(data)
        hurt[at] ^= 4
        with pytest.raises(ValueError, match="damaged|has"):
            list(records.records(bytes(hurt)))


def brute(encoder, data):
    rows, start = [], 0
    def digest(text):
        x = xxhash.xxh64_intdigest((text or "").encode(), 42)
        return x - (1 << 64) if x >> 63 else x

    order = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, digest(r[1])))
    for (doc_id, *_), ids in zip(order, plain(encoder, [r[1] or "" for r in order]), strict=True):
        ids = [*ids, records.END]
        rows.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return rows


def test_records_come_back_in_order(spark, encoder, tmp_path):
    data = [(k * 37 % 101 - 20, t, "x") for k, t in enumerate(ODD)] + [(3, None, "x"), (None, "a b", "x"), (3, "b", "x")]
    data += [(9, "same text.", "x")] * 3
    docs = spark.createDataFrame(data, "doc_id long, text string, start string").repartition(3)
    found = records.token_records(docs, tokenizer_path())
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, found.collect()), key=lambda r: r[1]) == brute(encoder, data)
    index = records.write_records(docs, str(tmp_path / "small"), tokenizer_path(), shard_records=2)
    rows = index.collect()
    assert sorted((r[:4] for r in rows), key=lambda r: r[1]) == brute(encoder, data)
    for r in rows:  # the index finds each record
        with open(r["shard"].removeprefix("file:"), "rb") as f:
            f.seek(r["offset"])
            ((_, _, doc_id, ids),) = records.records(f.read(r["bytes"]))
        assert (doc_id, len(ids)) == (r["doc_id"], r["n_tokens"])


def test_shards_are_bounded_in_bytes(spark, encoder, tmp_path):
    data = [(k, "word " * (20_000 if k % 5 == 0 else 3)) for k in range(40)]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(2)
    records.write_shards(docs, str(tmp_path / "s"), tokenizer_path(), shard_bytes=100_000)
    sizes = [f.stat().st_size for f in (tmp_path / "s").glob("part-*")]
    one = max(len(records.frame(0, x.tobytes(), False)) for x in encoder(pa.array([t for _, t in data])))
    assert len(sizes) >= 3 and max(sizes) < 100_000 + one + 64
    found = records.read_shards(spark, str(tmp_path / "s")).orderBy("shard", "position").collect()
    assert sorted(r["doc_id"] for r in found) == list(range(40))


def test_empty_table(spark):
    assert records.token_records(spark.createDataFrame([], "doc_id long, text string"), tokenizer_path()).count() == 0
