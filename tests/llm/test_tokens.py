import io
import json
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from sigloom.llm import tokens as t


@pytest.fixture(scope="module")
def encoder():
    return t.Encoder(t.default_vocabulary()[0])


@pytest.mark.parametrize("width", [1, 3, 7, 8, 13, 16, 17, 31, 32])
def test_packing_comes_back(width):
    x = np.random.default_rng(width).integers(0, 1 << width, 1001).astype(np.uint32)
    assert (t.unpack(t.pack(x, width), 1001, width) == x).all() and len(t.unpack(b"", 0, width)) == 0
    assert len(t.pack(x, width)) == -(-1001 * width // 64) * 8


def test_bits():
    assert [t.bits_for(n) for n in (1, 2, 3, 49408, 65536, 65537)] == [1, 1, 2, 16, 16, 17]


def test_shards_give_any_document(monkeypatch):
    monkeypatch.setattr(t, "BLOCK", 64)
    r = np.random.default_rng(0)
    docs = [(k if k else None, r.integers(0, 5000, r.integers(0, 200)).astype(np.uint32)) for k in range(30)]
    raw = io.BytesIO()
    w = t.ShardWriter(raw, 13)
    for k, x in docs:
        w.add(k, x)
    assert w.close() == (30, sum(len(x) for _, x in docs))

    class File(io.BytesIO):
        def size(self):
            return len(self.getvalue())

    s = t.Shard(File(raw.getvalue()))
    assert s.nulls.tolist() == [True] + [False] * 29
    for k in (29, 0, 7, 13):
        assert (s.document(k) == docs[k][1]).all()
    with pytest.raises(ValueError):
        t.Shard(File(raw.getvalue()[:-1] + b"?"))


ODD = ["", "  ", "<|endoftext|>", "a<|endoftext|>b", "x <|EndOfText|> y", "H̱ é É.", "it's IT'S we'll, 'sfoo can't!", 'x"### "###', "a b c\x1cd\x85e", "foo\x1c.bar", "ΑΣ ΑΣ. Σ", "İstanbul DIŞ ß ẞ", "１２ 12 3.4 ½", "日本語テキスト。", "👩‍👩‍👧 ok", "!!!???...", "a" * 3000, "​zero", "don't, 's 't", "&amp; <b> #$%", "|<|startoftext|>|", "≠."]


def altered(folder, change):
    """A vocabulary file whose tokenizer differs from the default one."""
    with open(t.default_vocabulary()[0]) as f:
        own = json.load(f)
    change(own)
    (folder / "own.json").write_text(json.dumps(own))
    return str(folder / "own.json")


def cased(own):
    own["normalizer"]["normalizers"].pop()


def joins(own):
    own["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = r"\S+\s+\S+|\S+"


def test_words_equal_whole_texts(encoder):
    want = [encoder.tok.encode(x, add_special_tokens=False).ids for x in ODD]
    assert encoder.by_words and [x.tolist() for x in encoder.encode(ODD)] == [x.tolist() for x in encoder.encode(ODD)] == want


@pytest.mark.parametrize("change,by_words", [(cased, True), (joins, False)])
def test_other_vocabularies_give_the_ids_of_the_library(tmp_path, change, by_words):
    e = t.Encoder(altered(tmp_path, change))
    texts = ODD + ["One two Three, FOUR. five"]
    assert e.by_words is by_words and [x.tolist() for x in e.encode(texts)] == [e.tok.encode(x, add_special_tokens=False).ids for x in texts]


def test_a_byte_level_vocabulary_is_encoded_by_whole_texts(spark, edges, edge_rows):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    assert not t.Encoder(path).by_words
    rows = sorted(((r[0], r[1]) for r in edge_rows), key=lambda r: (r[0] is not None, r[0] or 0))
    got = sorted(map(tuple, t.pack_documents(edges, path, 50_257).collect()), key=lambda r: r[1])
    assert got == slow(rows, path)


@pytest.mark.parametrize("joined", [1, 3, 256])
def test_words_are_encoded_many_to_a_call(monkeypatch, joined):
    """Each word's ids are its own, next to special tokens, marks and accents too; the library is called
    for groups of words."""
    monkeypatch.setattr(t, "JOINED", joined)
    e = t.Encoder(t.default_vocabulary()[0])
    texts = [*ODD, "<", "a< <b |x|> endoftext|>", "\u0338abc >\u0338 \u0301e", " ".join(f"w{k}x{k * k}" for k in range(1000))]
    sent, own = [], e.tok

    class Watched:
        def encode_batch_fast(self, texts, **more):
            sent.append(len(texts))
            return own.encode_batch_fast(texts, **more)

    e.tok = Watched()
    assert [x.tolist() for x in e.encode(texts)] == [own.encode(x, add_special_tokens=False).ids for x in texts]
    assert joined != 256 or sum(sent) < 200


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(t, "MEMORY", 3)
    e = t.Encoder(t.default_vocabulary()[0])
    x = "one two three, four. five one two"
    assert [e.encode([x])[0].tolist() for _ in range(3)] == [e.tok.encode(x, add_special_tokens=False).ids] * 3


def test_shards_follow_from_the_bytes(spark, data, tmp_path):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    path, vocabulary = t.default_vocabulary()
    folder = f"file://{tmp_path}/shards"
    manifest = t.write_shards(docs, folder, path, vocabulary, shard_bytes=40_000)
    assert manifest.count() > 5 and manifest.agg({"n_docs": "sum"}).first()[0] == docs.count()
    got = sorted(tuple(r) for r in t.read_shards(manifest, folder).collect())
    assert got == slow(sorted((r.doc_id, r.text) for r in docs.collect()), path)


def slow(rows, path):
    tok, at, out = Tokenizer.from_file(path), 0, []
    for i, x in rows:
        ids = [*tok.encode(x or "", add_special_tokens=False).ids, 1]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_whole_table_equals_the_library(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    got = sorted(tuple(r) for r in t.pack_documents(docs).collect())
    assert got == slow(rows, t.default_vocabulary()[0])


def test_edges(edges, edge_rows, no_docs):
    got = sorted(map(tuple, t.pack_documents(edges).collect()), key=lambda r: r[1])
    rows = sorted(((r[0], r[1]) for r in edge_rows), key=lambda r: (r[0] is not None, r[0] or 0))
    assert got == slow(rows, t.default_vocabulary()[0])
    assert t.pack_documents(no_docs).count() == 0
