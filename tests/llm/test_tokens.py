"""BPE against the tokenizers library, and the record files."""

from __future__ import annotations

import hashlib
import json
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from railloom.llm import bpe, queries, records
from tests.llm import cases

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


def odd_texts(n: int) -> list[str]:
    rng = random.Random(5)
    letters = "ab eé\n\t  ßñÑ日本'sll12.!?<|> 　\x1c\x85ΣİÉ́ſﬁ"
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 50))) for _ in range(n)] + [
        "", " ", "a  b", "a \n b ", "<|endoftext|>x<|startoftext|>", "ΑΣ ΟΔΟΣ.", "a" * 5000, "<|endoftext|><|endoftext|>",
    ]


@pytest.mark.parametrize("path,make", [(BYTE, lambda: bpe.WordTable(bpe.Merges(BYTE), 500)), (WORD, lambda: records.WordTokenizer(WORD, 500))])
def test_ids_equal_the_librarys(path, make):
    """The tables are so small that they are emptied again and again."""
    library, table, texts = Tokenizer.from_file(path), make(), odd_texts(1500)
    for k in range(0, len(texts), 100):
        part = texts[k : k + 100]
        ids, counts = table.encode(part)
        ends = np.cumsum(counts)
        got = [ids[e - c : e].tolist() for e, c in zip(ends, counts, strict=True)]
        assert got == [e.ids for e in library.encode_batch(part, add_special_tokens=False)]


def test_encode_decode_round_trip(spark):
    docs = cases.documents(spark)
    out = bpe.encode_decode(docs, BYTE, keep=tuple(docs.columns))
    assert out.columns == [c for c in docs.columns if c not in ("ids", "decoded")] + ["ids", "decoded"]
    rows = out.collect()
    assert len(rows) == len(cases.TEXTS)
    for row in rows:
        assert row["decoded"] == (row["text"] or "")
        assert (len(row["ids"]) == 0) == (not row["text"])
    assert bpe.encode_decode(cases.empty(spark), BYTE).count() == 0


def test_broken_sequences_decode_to_replacement_characters():
    merges = bpe.Merges(BYTE)
    lone = int(merges.of_byte[0xC3])
    data, lengths = merges.decode(np.array([lone, lone]), np.array([1, 1, 0]))
    assert data.tobytes().decode() == "��" and lengths.tolist() == [3, 3, 0]


def test_op1_against_the_library(spark):
    library = Tokenizer.from_file(BYTE)
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op1_bpe(spark, SF).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row["doc_id"]], add_special_tokens=False).ids
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_op9_against_the_library(spark):
    library = Tokenizer.from_file(WORD)
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = {r["doc_id"]: r for r in queries.op9_records(spark, SF).collect()}
    start = 0
    for doc_id in sorted(texts):
        ids = library.encode(texts[doc_id], add_special_tokens=False).ids + [1]
        row = rows.pop(doc_id)
        assert (row["start"], row["n_tokens"]) == (start, len(ids))
        assert row["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert not rows


def test_records_of_odd_documents(spark, tmp_path):
    path = str(tmp_path / "records")
    records.write(cases.documents(spark), path, WORD, end_id=70_000, files=3)
    read = records.read(spark, path).orderBy("file", "record").collect()
    ids = [r["doc_id"] for r in read]
    assert ids[0] is None and ids[1:] == sorted(i for i, _, _ in cases.TEXTS if i is not None)
    assert all(r["ids"][-1] == 70_000 for r in read)
    assert next(r["ids"] for r in read if r["doc_id"] == 6) == [70_000]
    index = {(r["file"], r["record"]): r for r in records.read_index(spark, path).collect()}
    start = 0
    for r in read:
        assert index[r["file"], r["record"]]["start"] == start and index[r["file"], r["record"]]["n_tokens"] == len(r["ids"])
        start += len(r["ids"])
    shuffled = [(r["file"], r["record"], bytes(r["payload"])) for r in records.read_shuffled(spark, path, 3).collect()]
    assert len(shuffled) == len(read) and [s[:2] for s in shuffled] != [(r["file"], r["record"]) for r in read]
    by_place = {(r["file"], r["record"]): r for r in read}
    for file, record, payload in shuffled:
        doc_id, known, width, count = records.META.unpack_from(payload)
        assert np.frombuffer(payload, f"<u{width}", count, records.META.size).tolist() == by_place[file, record]["ids"]
    records.write(cases.empty(spark), str(tmp_path / "none"), WORD, end_id=1)
    assert records.read(spark, str(tmp_path / "none")).count() == 0 and records.read_index(spark, str(tmp_path / "none")).count() == 0


def test_shuffled_reads_of_large_files(spark, tmp_path):
    """10,000 records a file: no join in the plan, so no file content in one, and the order depends on the seed alone."""
    path = str(tmp_path / "large")
    records.write(cases.documents(spark, [(n, f"word {n}", None) for n in range(20_000)]), path, WORD, end_id=1, files=2)
    shuffled = records.read_shuffled(spark, path, 5)
    assert "Join" not in shuffled._jdf.queryExecution().executedPlan().toString()
    rows = [(r["file"], r["record"], r["doc_id"]) for r in shuffled.select("file", "record", "doc_id").collect()]
    index = [(r["file"], r["record"], r["doc_id"]) for r in records.read_index(spark, path).collect()]
    assert sorted(rows) == sorted(index) and len(rows) == 20_000 and rows != sorted(rows)
    # neighbours come from anywhere: half of them from the other file
    assert 0.45 < np.mean([a[0] != b[0] for a, b in zip(rows, rows[1:])]) < 0.55
    again = records.read_shuffled(spark, path, 5).select("doc_id").head(50)
    other = records.read_shuffled(spark, path, 6).select("doc_id").head(50)
    assert [r["doc_id"] for r in again] == [r[2] for r in rows[:50]] != [r["doc_id"] for r in other]


@pytest.mark.parametrize(
    "of, change",
    [
        ("byte", lambda s: s.update(normalizer={"type": "NFC"})),
        ("byte", lambda s: s["pre_tokenizer"].update(add_prefix_space=True)),
        ("byte", lambda s: s["model"].update(byte_fallback=True)),
        ("byte", lambda s: s["added_tokens"][0].update(lstrip=True)),
        ("word", lambda s: s["normalizer"]["normalizers"].pop()),
        ("word", lambda s: s["pre_tokenizer"]["pretokenizers"][0]["pattern"].update(Regex="x")),
        ("word", lambda s: s["model"].update(end_of_word_suffix=None)),
    ],
)
def test_vocabularies_with_other_rules_are_refused(tmp_path, of, change):
    source, build = (BYTE, bpe.Merges) if of == "byte" else (WORD, records.WordTokenizer)
    with open(source, encoding="utf-8") as file:
        spec = json.load(file)
    change(spec)
    other = tmp_path / "other.json"
    other.write_text(json.dumps(spec))
    with pytest.raises(ValueError, match="supported"):
        build(str(other))


def test_damage_is_found():
    data = records.frame(7, np.arange(5)) + b"\n" + records.frame(None, np.array([70_000])) + b"\n"
    assert [(d, i.tolist()) for d, i, _, _ in records.unframe(data)] == [(7, [0, 1, 2, 3, 4]), (None, [70_000])]
    for at in (0, 9, 15, 30, len(data) - 8):
        broken = bytearray(data)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            list(records.unframe(bytes(broken)))
    with pytest.raises(ValueError):
        list(records.unframe(data[:-9]))


def test_files_follow_the_bytes_of_text(spark, tmp_path, monkeypatch):
    """Rows without id, which are no range of their own, are spread over files, too."""
    monkeypatch.setattr(records, "FILE_BYTES", 2000, raising=False)
    texts = [(None if n < 100 else n, f"word{n} " * 20, None) for n in range(200)]
    path = str(tmp_path / "records")
    records.write(cases.documents(spark, texts), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    rows = records.read_index(spark, path).orderBy("file", "record").collect()
    per_file = Counter(r["file"] for r in rows)
    assert len(rows) == 200 and max(per_file.values()) <= 60 and len(per_file) >= 10
    assert [r["doc_id"] for r in rows] == [None] * 100 + list(range(100, 200))
    assert [r["start"] for r in rows] == [sum(r["n_tokens"] for r in rows[:k]) for k in range(200)]
