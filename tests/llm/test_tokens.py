"""Packing, SentencePiece, chat formatting and the pipeline: exact round trips and odd rows."""

import hashlib
import random
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from docketry.llm import bpe, chat, packing, sentencepiece
from docketry.llm.queries import ORACLE, QUERIES
from llm_cases import prose

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

# --- packing ---------------------------------------------------------------------


def test_words_give_the_tokenizer_s_ids():
    words, whole = packing._WordIds(WORD_BPE), Tokenizer.from_file(WORD_BPE)
    rng = random.Random(0)
    odd_texts = ["it's Don't we'll 'S", "<|endoftext|>a <|ENDOFTEXT|>", "A\x1cb  x", "ÉCOLE É!", "I'M, x''s a,b A.B. ...", "İstanbul ΣΑΣ ﬁ 漢字🙂,", "a b　c\x0bd"]
    for text in odd_texts + [prose(rng) for _ in range(20)]:
        assert words.of(text.encode()).tolist() == whole.encode(text, add_special_tokens=False).ids


def test_hilbert_curve_visits_every_cell_and_steps_to_a_neighbour():
    for dims, bits in ((2, 3), (3, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), -1).reshape(-1, dims)
        keys = packing.hilbert_key(cells, bits)
        assert sorted(keys) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("length", [16, 4096])
def test_pieces_give_back_every_id_once(odd, length):
    whole = Tokenizer.from_file(WORD_BPE)
    rows = packing.pack(odd, WORD_BPE, length).collect()
    by_row, sequences = {}, {}
    for r in rows:
        by_row.setdefault(r["row"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    got = Counter()
    for pieces in by_row.values():
        pieces.sort(key=lambda r: r["start"])
        ids = np.frombuffer(b"".join(r["ids"] for r in pieces), "<u4")
        assert [r["start"] for r in pieces] == [0, *np.cumsum([r["length"] for r in pieces])[:-1]]
        assert all(r["doc_tokens"] == len(ids) for r in pieces)
        got[(pieces[0]["doc_id"], tuple(ids))] += 1
    want = Counter()
    for r in odd.collect():
        want[(r["doc_id"], (*whole.encode(r["text"] or "", add_special_tokens=False).ids, packing.END_ID))] += 1
    assert got == want
    assert sorted(sequences) == list(range(len(sequences)))
    for pieces in sequences.values():
        size = sum(n for _, n in pieces)
        assert [o for o, _ in sorted(pieces)] == [0, *np.cumsum([n for _, n in sorted(pieces)])[:-1]]
        # Nothing is padded: each sequence is full or a smaller power of two.
        assert size <= length and size & (size - 1) == 0


def test_copies_are_neighbours(spark):
    rng = random.Random(2)
    texts = [prose(rng, 3) for _ in range(50)]
    docs = spark.createDataFrame(list(enumerate(texts + texts)), "doc_id long, text string")
    made = packing.tokenised(docs, WORD_BPE)
    keys = {}
    for r in made.collect():
        keys.setdefault(texts[r["doc_id"] % 50], set()).add(r["key"])
    assert all(len(k) == 1 for k in keys.values())


# --- SentencePiece ---------------------------------------------------------------


def unigram(vocabulary):
    """The library's own search over the same pieces and scores."""
    import sentencepiece as library

    proto_module = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    proto = proto_module.ModelProto()
    with open(PIECES, "rb") as file:
        proto.ParseFromString(file.read())
    proto.trainer_spec.model_type = 1
    for piece in proto.pieces:
        if piece.type == 1:
            piece.score = vocabulary.scores[piece.piece]
    return library.SentencePieceProcessor(model_proto=proto.SerializeToString())


def path_score(ids, vocabulary, model):
    return sum(vocabulary.scores.get(model.id_to_piece(i), 0.0) for i in ids)


def test_best_paths_equal_the_library_s():
    encoder = sentencepiece.Encoder(sentencepiece.Vocabulary(PIECES))
    model = unigram(encoder.v)
    rng = random.Random(3)
    for text in [prose(rng, 2) for _ in range(60)] + ["Ünïcode 漢字🙂 x", "a  b\n c\td", "x" * 300]:
        got, want = encoder.of(text), model.encode(text)
        # The library adds up in single precision, so paths of equal score may differ.
        assert got == want or abs(path_score(got, encoder.v, model) - path_score(want, encoder.v, model)) < 1e-2


def test_streaming_gives_the_ids_of_a_whole_search():
    vocabulary = sentencepiece.Vocabulary(PIECES)
    rng = random.Random(4)
    for text in ["▁" + prose(rng, 6).replace(" ", "▁"), "x" * 500, "abcdefgh" * 200, "漢字🙂" * 60]:
        whole = sentencepiece.StreamingViterbi(vocabulary)
        want = whole.finish(text)
        search, got, at, widest = sentencepiece.StreamingViterbi(vocabulary), [], 0, 0
        while at < len(text):
            step = rng.randrange(1, 30)
            got += search.feed(text[at : at + step])
            widest = max(widest, len(search.text))
            at += step
        got += search.finish()
        assert got == want
        assert widest < max(len(text) * 0.9, 200)


def test_round_trip_of_odd_texts(spark, odd, empty):
    texts = [r["text"] for r in odd.collect()] + [" lead", "trail ", "a▁b ▁", "\n\n x", "𝔘🙂\u0000é", "▁", " "]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    decoded = sentencepiece.decode(sentencepiece.encode(docs, PIECES), PIECES).collect()
    assert {r["doc_id"]: r["text"] for r in decoded} == {i: t or "" for i, t in enumerate(texts)}
    assert sentencepiece.encode(empty, PIECES).collect() == []


# --- chat ------------------------------------------------------------------------


def conversations(spark):
    said = "<|im_end|><|im_start|>assistant ok"
    rows = [
        (1, 0, "system", "Be kind."), (1, 1, "user", " hi\n"), (1, 2, "assistant", "\n\n  yes <|im_sep|> <\\|x"), (1, 3, "assistant", ""),
        (2, 1, "assistant", said), (2, 0, "user", said), (3, 0, None, None), (3, None, "assistant", "last 🙂é"), (3, 1, "assistant", "first"),
        (None, 0, "user", "nobody"), (4, 0, "assistant", "same"), (4, 0, "assistant", "same"), (5, 0, "a<|b", "<<|\\|"),
    ]
    rows += [(6, i, "user" if i % 2 else "assistant", f"turn {i} " * 5) for i in range(700)]
    return rows, spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, ids string")


def test_conversations_read_back(spark):
    rows, turns = conversations(spark)
    formatted = chat.format_conversations(turns, BYTE_BPE)
    got = {r["conv_id"]: r for r in chat.digest(formatted, BYTE_BPE).collect()}
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is None, turn or 0, role or "", text or ""))
    assert got.keys() == by.keys()
    for conv, said in by.items():
        said.sort()
        loss = "".join(t for *_, role, t in said if role == "assistant")
        assert got[conv]["n_turns"] == len(said)
        assert got[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for *_, r, t in said).encode()).hexdigest()
        assert (got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.format_conversations(turns.limit(0), BYTE_BPE).collect() == []


def test_blocks_give_the_ids_of_the_whole():
    turns = [("user", "one <|im_end|> two"), ("assistant", " \n three"), ("user", "四🙂")]
    mill = chat.tokenizer_of(BYTE_BPE)
    whole, _ = chat.render(turns)
    parts = [i for t in turns for i in mill.encode(chat.render([t])[0], add_special_tokens=False).ids]
    assert mill.encode(whole, add_special_tokens=False).ids == parts
    assert chat.parse(whole) == turns


@pytest.mark.parametrize("text", ["", "<|", "<\\|", "<\\\\|a<|", "<<||>", "\\<|im_start|>\\"])
def test_escapes_are_reversible(text):
    assert "<|" not in chat.escape(text) and chat.unescape(chat.escape(text)) == text


def test_masks_equal_brute_force():
    rng = random.Random(5)
    for _ in range(100):
        cuts = sorted(rng.sample(range(60), 12))
        offsets = np.array([(a, b) for a, b in zip(cuts, cuts[1:])])
        ends = sorted(rng.sample(range(60), 6))
        spans = np.array(ends).reshape(-1, 2)
        want = [any(a < e and s < b for s, e in spans) for a, b in offsets]
        assert chat.mask_of(offsets, spans).tolist() == want


# --- pipeline and queries --------------------------------------------------------


def test_pipeline_stages_keep_columns_and_clean_rows(spark, odd, sf):
    docs = odd
    for name, apply in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.stage(apply(spark, docs, sf), name)
        assert after.columns == odd.columns, name
        docs = after
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    # 13 has the most code points of the equal texts; then 3 is the smallest id near it.
    assert {3, 6, 7, 9, 10, 12, 14, 15} == kept.keys()
    assert "AKIA" not in kept[15]
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert {r["doc_id"] for r in pieces} == kept.keys()
    none = odd.limit(0)
    for _, apply in corpus_pipeline.STAGES:
        assert apply(spark, none, sf).collect() == []


def test_pipeline_over_the_table(spark, sf):
    ids = {r["doc_id"] for r in corpus_pipeline.table(spark, sf, "documents").collect()}
    got = corpus_pipeline.run(spark, sf).collect()
    assert got and {r["doc_id"] for r in got} < ids
    assert all(len(r["ids"]) == 4 * r["length"] for r in got)


def test_packing_query(spark, sf):
    whole = Tokenizer.from_file(WORD_BPE)
    texts = {r["doc_id"]: r["text"] for r in corpus_pipeline.table(spark, sf, "documents").collect()}
    for r in QUERIES["op5_packing"](spark, sf).collect()[:50]:
        ids = np.array([*whole.encode(texts[r["doc_id"]], add_special_tokens=False).ids, 2], "<u4")
        assert zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"]


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLE])
def test_queries_give_a_row_for_each_document(spark, sf, name):
    rows = QUERIES[name](spark, sf).toPandas()
    n = corpus_pipeline.table(spark, sf, "documents").count()
    if name != "op5_packing" and "doc_id" in rows:
        assert len(rows) == n and rows["doc_id"].is_unique


# --- byte-level BPE ----------------------------------------------------------------


def _bpe_texts():
    rng = random.Random(3)
    pool = [*range(1, 0xD800), *range(0xE000, 0x110000)]
    odd_texts = [
        "", " ", "  \n\n a  b\t\tc \n", "it's I'll we'VE 's", "<|endoftext|>", " <|endoftext|> a<|endoftext|><|endoftext|>  <|endoftext",
        "aaab" * 333, " " * 777 + "x", "漢字🙂 ü É\x85\xa0　x 　y", "\x1c\x1d \x1e a\x1f b᠎﻿ x​ y", "0123456789" * 50,
        "".join(chr(rng.choice(pool)) for _ in range(20_000)),
    ]
    return odd_texts + ["".join(rng.choice("ab \n1.'sé²") for _ in range(200)) for _ in range(100)]


def test_pair_index_gives_the_library_s_ids_and_text():
    whole, mill = Tokenizer.from_file(BYTE_BPE), bpe.Encoder(BYTE_BPE)
    said = _bpe_texts()
    for text, ids in zip(said, mill.encode(said)):
        want = whole.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert bpe.decode_ids(ids, mill.vocabulary.bytes) == whole.decode(want, skip_special_tokens=False) == text
    # Broken sequences and unknown ids.
    some = np.array([162, 120, 50256, 162, 49999, 99999, 95], "<u4")
    assert bpe.decode_ids(some.tobytes(), mill.vocabulary.bytes) == whole.decode(some.tolist(), skip_special_tokens=False)


@pytest.mark.parametrize("unbroken", ["a", "ab", "=", "日本", "x1"])
def test_an_unbroken_text_of_a_megabyte_takes_seconds(unbroken):
    mill = bpe.Encoder(BYTE_BPE)
    text = unbroken * (1_000_000 // len(unbroken))
    begun = time.process_time()
    (ids,) = mill.encode([text])
    assert time.process_time() - begun < 20
    assert bpe.decode_ids(ids, mill.vocabulary.bytes) == text
    assert np.frombuffer(ids, "<u4").tolist() == Tokenizer.from_file(BYTE_BPE).encode(text, add_special_tokens=False).ids
    assert not any(len(c) > bpe.CACHED_CHARS for c in mill)


def test_caches_and_groups_do_not_change_ids(monkeypatch):
    said = _bpe_texts()
    want = bpe.Encoder(BYTE_BPE).encode(said)
    monkeypatch.setattr(bpe, "CACHE", 5)
    monkeypatch.setattr(bpe, "INDEXED", 7)
    mill = bpe.Encoder(BYTE_BPE)
    assert [mill.encode([text])[0] for text in said] == want


def test_bpe_of_odd_rows(odd, empty):
    whole = Tokenizer.from_file(BYTE_BPE)
    rows = bpe.digest(bpe.decode(bpe.encode(odd, BYTE_BPE), BYTE_BPE)).collect()
    want = []
    for r in odd.collect():
        text = r["text"] or ""
        ids = np.array(whole.encode(text, add_special_tokens=False).ids, "<u4")
        want.append((r["doc_id"], len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)
    assert bpe.decode(bpe.encode(empty, BYTE_BPE), BYTE_BPE).collect() == []


def test_bpe_of_the_whole_table(spark, sf):
    whole = Tokenizer.from_file(BYTE_BPE)
    want = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        ids = np.array(whole.encode(r["text"] or "", add_special_tokens=False).ids, "<u4")
        want[r["doc_id"]] = (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest())
    assert {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op13_byte_bpe"](spark, sf).collect()} == want


def test_files_the_index_cannot_follow_are_refused(tmp_path):
    with pytest.raises(ValueError, match="plain byte-level"):
        bpe.Vocabulary(WORD_BPE)


@pytest.mark.parametrize("unbroken", ["=", "-", "a", " ", "x1"])
def test_sentencepiece_is_linear_in_unbroken_text(unbroken):
    """The paths of such a text never meet; looking for that must not cost more with each step."""
    encoder = sentencepiece.Encoder(sentencepiece.Vocabulary(PIECES))

    def seconds(n):
        begun = time.process_time()
        ids = encoder.of(unbroken * (n // len(unbroken)))
        spent = time.process_time() - begun
        assert sentencepiece.decode_ids(ids, encoder.v) == unbroken * (n // len(unbroken))
        return spent

    short = seconds(50_000)
    assert seconds(400_000) < 16 * short + 1
