"""Token counts and packing against the tokenizer library itself."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from hourgrid.llm import packing, pretokens, queries, token_counts

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None,
    "",
    " ",
    "\n\n\t x",
    "Don't <|endoftext|> stop'S <|startoftext|><|endoftext|>",
    "<|endoftext|",
    "İSTANBUL Σίσυφος ΣΑΣ J̌ ǅ K Å",
    "ﬁ é ́é 你好，世界 한글 ١٢٣ ½ 🙂👍🏽\u200b\u00a0x",
    "a\x00b\x1cc\x85d\u2028e\u3000f",
    "x" * 5000 + "!" * 300 + " " * 300,
    "\u0558 \u088f \ua7ce \U0003fc3f",
]


def whole(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTES, WORDS])
@pytest.mark.parametrize("text", ODD)
def test_pieces_give_the_ids_of_the_whole_text(path, text):
    cut = pretokens.cutter(path)
    assert [i for ids in cut.encode(cut.in_order(text or "")) for i in ids] == whole(path, text)
    special, pieces = cut.cut(text or "")
    assert sorted(special + pieces) == sorted(cut.in_order(text or ""))


def test_words_are_encoded_together():
    cut = pretokens.cutter(WORDS)
    pieces = list(dict.fromkeys(p for t in ODD for p in cut.pieces(t or "")))
    assert [np.frombuffer(x, "<u4").tolist() for x in cut.encode_words(pieces)] == cut.encode(pieces) and cut.encode_words([]) == []


def test_words_are_told_apart_without_the_library(monkeypatch):
    """op9_packing: 403 CPU seconds a GB, of which the library's offsets and its second cut of the words were a large part."""
    cut = pretokens.Cutter(WORDS)
    pieces = list(dict.fromkeys(p for t in ODD for p in cut.pieces(t or ""))) + ["</", "w", ">", "w>", "</"]
    want = [np.array(ids, "<u4").tobytes() for ids in cut.encode(pieces)]
    literal = [*pieces, "</w>", "a</w>b"]
    assert cut.encode_words(literal)[: len(pieces)] == want and cut.encode_words(literal)[-2:] == [
        np.array(ids, "<u4").tobytes() for ids in cut.encode(literal[-2:])
    ]
    cut.is_last[:] = False
    assert cut.encode_words(pieces) == want  # no token says that it is the last one
    cut = pretokens.Cutter(WORDS)
    monkeypatch.setattr(cut, "tokenizer", Only(cut.tokenizer))
    assert cut.encode_words(pieces) == want and cut.encode_words([]) == []


class Only:
    """A tokenizer that does nothing but encode without offsets."""

    def __init__(self, tokenizer):
        self.encode_batch_fast = tokenizer.encode_batch_fast


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_characters_held_to_be_safe_are_cut_alike(path):
    cut = pretokens.cutter(path)
    tokenizer = Tokenizer.from_file(path)
    rng = random.Random(3)
    safe = pretokens.SAFE
    for c in safe:
        text = f"A{c}1{c}!{c}  {c}{rng.choice(safe)}{rng.choice(safe)}b"
        assert not pretokens.UNSAFE.search(text)
        plain = tokenizer.normalizer.normalize_str(text) if tokenizer.normalizer else text
        assert cut.pieces(text) == [plain[a:b] for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(plain)]


def test_counts_of_odd_texts(documents, clashing):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (3, "again"), (3, "again")]
    got = token_counts.token_counts(clashing(documents(rows), "chunk", "piece", "at", "times"), BYTES, limit=3).collect()
    want = [(i, len((t or "").encode()), n := len(whole(BYTES, t)), n > 3) for i, t in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert token_counts.token_counts(documents([]), BYTES).count() == 0


def test_a_chunk_is_unpacked_as_it_was_packed():
    chunk = token_counts._Chunk()
    texts = [["a", "b", "a"], [], ["é", "b", "b", "b"]]
    for t in texts:
        chunk.add(t)
    found = {}
    for bucket, packed in chunk.rows(3):
        (sizes, held, at, times), text = token_counts._unpacked(packed, *["<u4"] * 4)
        ends, k = np.cumsum(sizes), 0
        for a, b, n in zip([0, *ends[:-1]], ends, held, strict=True):
            assert zlib.crc32(text[a:b]) % 3 == bucket
            for _ in range(n):
                found[text[a:b].decode(), int(at[k])] = int(times[k])
                k += 1
    assert found == {("a", 0): 2, ("b", 0): 1, ("é", 2): 1, ("b", 2): 3}


def test_chunks_are_summed(documents):
    rows = [(i, "the cat " * (i % 7)) for i in range(200)]
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(documents(rows).repartition(5), BYTES).collect()}
    assert got == {i: len(whole(BYTES, t)) for i, t in rows}


def test_counts_of_the_documents(spark, sf_dir, read):
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in queries.queries()["op2_token_counts"](spark, sf_dir).collect()}
    for doc_id, text in read("documents").select("doc_id", "text").collect():
        n = len(whole(BYTES, text))
        assert got[doc_id] == (len((text or "").encode()), n, n > 1024)


@pytest.mark.parametrize("n", [1, 2, 3, 2047, 2048, 2049, 5000, 6144])
def test_binary_lengths(n):
    lengths = packing.binary_lengths(n, 2048)
    assert sum(lengths) == n and all(x & (x - 1) == 0 and x <= 2048 for x in lengths)
    assert lengths == sorted(lengths, reverse=True) and len({x for x in lengths if x < 2048}) == sum(x < 2048 for x in lengths)


def test_size_is_a_power_of_two(documents):
    with pytest.raises(ValueError, match="power of two"):
        packing.pack(documents([]), WORDS, size=1000)


def check_pieces(rows, texts):
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    assert by_doc.keys() == texts.keys()
    for doc_id, text in texts.items():
        ids = np.array([*whole(WORDS, text), 1], "<u4")
        at = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"], r["offset"]) == (at, len(ids), 0)
            assert r["length"] & (r["length"] - 1) == 0 and r["length"] == 1 << r["bucket"]
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    assert len({r["sequence_id"] for r in rows}) == len(rows)


def test_pieces_of_odd_texts(documents, clashing):
    texts = dict(enumerate(ODD)) | {None: "no id"}
    check_pieces(packing.pack(clashing(documents(list(texts.items()))), WORDS, size=64).collect(), texts)
    assert packing.pack(documents([]), WORDS).count() == 0
    twice = packing.pack(documents([(1, "one two three"), (1, "one two three")]), WORDS).collect()
    assert len({r["sequence_id"] for r in twice}) == len(twice) == 2


def test_memo_is_emptied_when_full(monkeypatch):
    monkeypatch.setattr(packing, "MEMO_ENTRIES", 3)
    memo = packing._Memo(pretokens.cutter(WORDS))
    for text in ("a b c", "d e f g h", "a d"):
        pieces = text.split()
        memo.learn(set(pieces))
        assert b"".join(memo[p] for p in pieces) == np.array(whole(WORDS, text), "<u4").tobytes()


def test_a_worker_remembers_the_first_words(monkeypatch):
    """op9_packing: each task encoded the frequent words again."""
    monkeypatch.setattr(packing, "KEPT_ENTRIES", 4)
    packing._memo.cache_clear()
    run = packing._pack(WORDS, 64, 1, True)
    encoded, encode = [], pretokens.Cutter.encode_words
    monkeypatch.setattr(pretokens.Cutter, "encode_words", lambda self, some: encoded.extend(some) or encode(self, some))
    for text in ("the the cat", "the cat sat on a mat <|endoftext|>", "mat sat cat the", ""):
        batch = pa.RecordBatch.from_arrays([pa.array([7], pa.int64()), pa.array([text])], ["doc_id", "text"])
        (out,) = run(iter([batch]))
        assert [i for ids in out.column(5).to_pylist() for i in ids] == [*whole(WORDS, text), 1]
        assert len(packing._memo(WORDS)) <= 4 and packing._memo(WORDS).keys() >= packing._memo(WORDS).special.keys()
    assert encoded.count("the") == encoded.count("cat") == 1
    packing._memo.cache_clear()


def test_pieces_of_the_documents(spark, sf_dir, read, tmp_path):
    pieces = queries.queries()["op9_packing"](spark, sf_dir)
    check_pieces(pieces.collect(), {r["doc_id"]: r["text"] for r in read("documents").collect()})
    packing.write_buckets(pieces, f"{tmp_path}/buckets")
    back = spark.read.parquet(f"{tmp_path}/buckets")
    assert back.count() == pieces.count() and back.where("length <> pow(2, bucket)").isEmpty()


def test_ids_come_with_the_pieces(documents):
    got = packing.pack(documents([(1, "Hello hello world")]), WORDS, with_ids=True).orderBy("start").collect()
    assert [i for r in got for i in r["ids"]] == [*whole(WORDS, "Hello hello world"), 1]
