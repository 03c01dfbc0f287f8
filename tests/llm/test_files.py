import base64
import hashlib
import io
import json
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loomfeed.llm import cutting_stock, packing, rans, token_files, warc
from loomfeed.llm import tokens
from loomfeed.llm.tokens import Encoder
from loomfeed.session import fresh_path

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "a  b", "  a", " a", "a\n  b", "a\t b  ", "", " ", "x's 's  y  z\n\n q", "<|endoftext|> hi", "  é  ü",
    "no blanks" * 3000, "word " * 9000, "日本語 テキスト", "\x1c \x1d x", "1234 5678!! ?", "trailing \n ",
    "a<|endoftext|> b", "end.\nNext it's\n's\n\nlast", "a\n b", "a \nb", "x.\n.y\nz", "\n", "a\r\nb", "don't, won't; 'll",
    "naïve, été.\nÜber;", "a\x85b\n\u2003c", "A1\nb2 c_d", "ǅ ªº ² ½", "\n\n a\n",
]


@pytest.fixture(scope="module")
def tokenizer():
    one = Tokenizer.from_file(PATH)
    return lambda text: one.encode(text or "", add_special_tokens=False).ids


def little(ids):
    return np.array(ids, dtype="<u4").tobytes()


def test_pieces_encode_as_the_whole(tokenizer):
    encoder = Encoder(PATH)
    for _ in range(2):
        assert encoder.encode(TEXTS) == [little(tokenizer(t)) for t in TEXTS]


def test_random_texts_encode_as_by_the_plain_call(tokenizer):
    rng, encoder = random.Random(5), Encoder(PATH)
    parts = ["a", "the", "Über", " ", " ", "  ", "\n", "\n", "\t", ".", ",", "'s", "'", "1", "é", "日", "\x1c", "\u00a0", "<|endoftext|>"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(30))) for _ in range(4000)]
    assert encoder.encode(texts) == [little(tokenizer(t)) for t in texts]


def test_blanks_and_unsettled_characters_encode_as_by_the_plain_call(tokenizer):
    rng, encoder = random.Random(7), Encoder(PATH)
    parts = ["a", "re", "ll", "'", "'s", "'re", "'Ve", "\xdc", " ", " ", "  ", "\n", "\r\n", "!!", "23", "\xb2", "\xa0", " \xa0"]
    parts += ["\x1c", "\x85", "\u3000", "\u65e5\u672c", "\u0301", "\u01c5", "\u0416", "\x00", "\u200b", "\u2010", "\u0250"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(25))) for _ in range(4000)]
    assert " \xa0 \xa0" in "".join(texts)
    assert encoder.encode(texts) == [little(tokenizer(t)) for t in texts]


def test_words_are_encoded_once_and_in_rows(tokenizer):
    encoder, calls = Encoder(PATH), []
    tokenize = encoder.tokenize
    encoder.tokenize = lambda row: calls.append(row) or tokenize(row)
    texts = [" one two, three", " two three (\xfcber) one", "  one  two 12"] * 50
    assert encoder.encode(texts) == [little(tokenizer(t)) for t in texts]
    # the blank-led ones in one row, then one by one the others, the blank and the byte behind texts
    assert len(calls) == 6
    assert encoder.encode(texts) == [little(tokenizer(t)) for t in texts] and len(calls) == 6


def test_rows_are_not_used_where_tokens_reach_over_blanks(tmp_path):
    with open(PATH, encoding="utf-8") as file:
        rules = json.load(file)
    rules["model"]["vocab"]["a\u0120"] = len(rules["model"]["vocab"]) + 1
    merges = rules["model"]["merges"]
    merges.insert(0, ["a", "\u0120"] if isinstance(merges[0], list) else "a \u0120")
    path = str(tmp_path / "reaching.json")
    with open(path, "w", encoding="utf-8") as file:
        json.dump(rules, file)
    encoder, plain = Encoder(path), Tokenizer.from_file(path)
    texts = [" sea tea", "a a a", " a\n a  a"]
    assert encoder.encode(texts) == [little(plain.encode(t, add_special_tokens=False).ids) for t in texts]


def test_remembered_pieces_are_bounded(tokenizer, monkeypatch):
    monkeypatch.setattr(tokens, "MEMORY_BYTES", 10_000)
    encoder = Encoder(PATH)
    for at in range(0, 4000, 100):
        texts = [f"w{i} x{i}.\ny{i}" for i in range(at, at + 100)]
        assert encoder.encode(texts) == [little(tokenizer(t)) for t in texts]
        assert len(encoder.memory) + len(encoder.words) < 1000


def test_rans_round_trips_from_any_checkpoint():
    rng = np.random.default_rng(0)
    for n, lanes, every in ((0, 4, 2), (1, 4, 2), (7, 4, 1), (5000, 16, 32)):
        ids = np.minimum(rng.zipf(1.2, n), 999).astype(np.uint32)
        table = rans.Table(rans.quantize(np.bincount(ids, minlength=1000)))
        block = rans.encode(ids, table, lanes, every)
        assert (rans.decode(block, table) == ids).all()
        marks = -(-(-(-n // lanes)) // every)
        parts = [rans.decode(block, table, i, i + 1) for i in range(marks)]
        assert n == 0 or (np.concatenate(parts) == ids).all()
        if n:
            damaged = bytearray(block)
            damaged[-6] ^= 1
            with pytest.raises(ValueError, match="checksum"):
                rans.decode(bytes(damaged), table)


def test_quantized_frequencies_keep_every_id():
    for counts in ([1, 0, 10**9], [5], [1] * 50_000, [0, 0]):
        out = rans.quantize(np.array(counts))
        assert ((out > 0) == (np.array(counts) > 0)).all() and out.sum() in (0, 1 << rans.SCALE_BITS)


@pytest.mark.parametrize("file_ids", [50, 1 << 22])
def test_token_files_round_trip(spark, tokenizer, file_ids):
    texts = [*TEXTS, None, "same", "same"]
    order = list(range(len(texts)))
    random.Random(1).shuffle(order)
    rows = [(i * 3 if i else None, texts[i], "x") for i in order] + [(900, "again", "y")] * 2
    folder = fresh_path(spark, "files")
    docs = spark.createDataFrame(rows, "doc_id long, text string, part string")
    manifest = token_files.write(docs, folder, PATH, 2, file_ids=file_ids).collect()
    assert len({r["path"] for r in manifest}) == len(manifest)
    found = token_files.digests(token_files.read(spark, folder)).collect()
    got = sorted(found, key=lambda r: r["start"])
    at = 0
    expected = sorted(rows, key=lambda r: -1 if r[0] is None else r[0])
    for r, (key, text, _) in zip(got, expected, strict=True):
        ids = [*tokenizer(text), 2]
        assert tuple(r) == (key, at, len(ids), zlib.crc32(little(ids)))
        at += len(ids)


def test_token_files_of_an_empty_table(spark):
    folder = fresh_path(spark, "files")
    token_files.write(spark.createDataFrame([], "doc_id long, text string"), folder, PATH, 2)
    assert token_files.digests(token_files.read(spark, folder)).count() == 0


def test_patterns_cut_the_histogram():
    rng = np.random.default_rng(3)
    for kinds, most in ((1, 5), (10, 40), (128, 900), (128, 2)):
        sizes = rng.choice(np.arange(1, 129), kinds, replace=False)
        histogram = {int(s): int(n) for s, n in zip(sizes, rng.integers(1, most, kinds))}
        cut, bins = dict.fromkeys(histogram, 0), 0
        for content, times in cutting_stock.patterns(histogram, 128):
            assert sum(s * n for s, n in content.items()) <= 128
            bins += times
            for s, n in content.items():
                cut[s] += n * times
        assert cut == histogram
        material = sum(s * n for s, n in histogram.items()) / 128
        lower = max(material, sum(n for s, n in histogram.items() if s > 64))
        assert bins <= 1.1 * lower + 5
    assert cutting_stock.patterns({}, 128) == []


def check_packing(rows, texts, tokenizer, length):
    seen, places = {}, {}
    for r in rows:
        ids = [*tokenizer(texts[r["doc_id"]]), 0]
        part = ids[r["start"] : r["start"] + r["length"]]
        assert (zlib.crc32(little(part)), len(ids), len(part)) == (r["ids_crc32"], r["doc_tokens"], r["length"])
        seen.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert seen.keys() == texts.keys()
    for doc, parts in seen.items():
        at = 0
        for start, size in sorted(parts):
            assert start == at
            at += size
        assert at == len(tokenizer(texts[doc])) + 1
    assert sorted(places) == list(range(len(places)))
    for parts in places.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length


def test_packing(spark, tokenizer):
    rng = random.Random(7)
    texts = {i: " ".join(f"w{rng.randrange(99)}" for _ in range(rng.choice([3, 50, 400]))) for i in range(150)}
    texts |= {200 + i: t for i, t in enumerate(TEXTS)} | {300: None, 301: "same", 302: "same"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("row", docs_row())
    cut = packing.pieces(docs, PATH, 0, 64)
    rows = packing.digests(cut, packing.place(cut, 64, 2, bucket_rows=20)).collect()
    check_packing(rows, texts, tokenizer, 64)
    packed = packing.pack(docs, PATH, 0, 64, 2)
    for r in packing.sequences(packed, 64, pad_id=9).collect():
        n, size = r["n_tokens"], len(r["ids"]) // 4
        assert size == (n if n & (n - 1) == 0 else 64) and r["ids"][4 * n :] == little([9]) * (size - n)
    empty = packing.pieces(docs.filter("false"), PATH, 0)
    assert packing.place(empty).count() == 0


def docs_row():
    from pyspark.sql import functions as F

    return F.lit("clash")


PAGES = "page_id long, url string, html string, key string"


def test_archives_round_trip(spark):
    bodies = ["<p>a</p>", "<p>a</p>", None, "", "é" * 50_000, "<p>a</p>", "b"]
    rows = [(i, f"http://x/{i}\r\nbad", b, "k") for i, b in enumerate(bodies)] + [(None, None, "n", "k")] * 2
    folder = fresh_path(spark, "warc")
    manifest = warc.write(spark.createDataFrame(rows, PAGES), folder)
    assert sum(r["records"] for r in manifest.collect()) == len(rows)
    # an attempt that was not committed left an archive beside the others
    stray = b"".join(warc.archive([warc.record(0, "http://x", b"again", None)]))
    with open(f"{folder}/pages-0000000-00000-stray.warc.zst", "wb") as out:
        out.write(stray)
    found = warc.read(manifest).collect()
    assert len(found) == len(rows)
    with pytest.raises(Exception, match="records, .* written"):
        warc.read(manifest.withColumn("records", F.col("records") + 1)).collect()
    top = {}
    for i, b in enumerate(bodies):
        top[b or ""] = i
    got = {r["page_id"]: r for r in found if r["page_id"] is not None}
    for i, b in enumerate(bodies):
        data, last = (b or "").encode(), top[b or ""]
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        kind = ("response", None, data) if i == last else ("revisit", last, None)
        r = got[i]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(data), digest)
        assert (r["record_type"], r["refers_to"], r["payload"] and bytes(r["payload"])) == (*kind[:2], kind[2] and data)
    assert [r["record_type"] for r in found if r["page_id"] is None] == ["response"] * 2
    nothing = warc.write(spark.createDataFrame([], PAGES), fresh_path(spark, "warc"))
    assert nothing.count() == 0 and warc.read(nothing).count() == 0


def test_damaged_archives_are_refused():
    good = b"".join(warc.archive([warc.record(i, "http://x", b"text" * i, None) for i in range(9)]))
    assert len(list(warc.read_archive(io.BytesIO(good)))) == 9
    with pytest.raises(warc.Damaged):
        list(warc.read_archive(io.BytesIO(good[:-3])))
    broken = bytearray(good)
    broken[-20] ^= 255
    with pytest.raises(warc.Damaged):
        list(warc.read_archive(io.BytesIO(bytes(broken))))
    one = warc.record(1, "u", b"abc", None)
    for bad in (one.replace(b"WARC/1.1", b"FOO"), one[:-2], one.replace(b"Content-Length: 3", b"Content-Length: 4")):
        plain = zstandard.ZstdCompressor().compress(bad)
        with pytest.raises(warc.Damaged):
            for fields, block in warc.read_archive(io.BytesIO(plain)):
                warc.payload_of(fields, block)
