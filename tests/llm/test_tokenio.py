"""Exact round trips of the coder and of whole files."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from assayframe.llm import codec, tokenio

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
ENCODER = tokenio.ChunkEncoder(LIBRARY.to_str())


def ids_of(text):
    return np.array(LIBRARY.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("seed", range(6))
def test_blocks_round_trip(seed):
    rng = np.random.default_rng(seed)
    ids = [2, 300, 50_000][seed % 3]
    blocks = [rng.integers(0, rng.integers(1, ids + 1), n) for n in rng.integers(0, 600, 30)]
    blocks += [np.zeros(0, int), np.full(4096, ids - 1), np.arange(4096) % ids, np.tile(np.arange(7) % ids, 500)]
    frames = codec.encode_blocks(blocks, ids)
    back = codec.decode_blocks(codec.split_frames(b"".join(frames)), ids)
    assert all((a == b).all() for a, b in zip(blocks, back, strict=True))
    # a block is read alone, and is the same in any company
    for k in (3, 31):
        assert (codec.decode_blocks(codec.split_frames(frames[k]), ids)[0] == blocks[k]).all()
        assert codec.decode_blocks(codec.split_frames(codec.encode_blocks([blocks[k]], ids)[0]), ids)[0].tolist() == blocks[k].tolist()


def test_predictable_ids_cost_little():
    rng = np.random.default_rng(0)
    repeated = np.tile(rng.integers(0, 5000, 50), 80)
    skewed = rng.choice(200, 4000, p=np.arange(200, 0, -1) ** 3 / (np.arange(200, 0, -1) ** 3).sum())
    sizes = [len(f) * 8 / len(b) for f, b in zip(codec.encode_blocks([repeated, skewed], 50_000), (repeated, skewed))]
    assert sizes[0] < 1 and sizes[1] < 8.3


def test_damage_is_found():
    frame = codec.encode_blocks([np.arange(500) % 77], 100)[0]
    for at in (20, len(frame) - 1):
        hurt = frame[:at] + bytes([frame[at] ^ 4]) + frame[at + 1:]
        with pytest.raises(ValueError):
            codec.decode_blocks(codec.split_frames(hurt), 100)
    with pytest.raises(ValueError):
        codec.encode_blocks([np.array([100])], 100)


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\t'stdΣσa1.,")), max_size=50))
def test_chunks_are_whole_texts(text):
    assert ENCODER.encode([text]) == [ids_of(text)]


def test_special_strings_and_memory(monkeypatch):
    texts = ["<|endoftext|>", "a<|startoftext|>b c <|endoftext|> d", "it's <|endoftext|", "", " ", "\n\n", "x" * 3000, "İstanbul ΟΔΟΣ ΣΑΣ"]
    assert ENCODER.encode(texts) == [ids_of(t) for t in texts]
    assert tokenio.chunks_hold(LIBRARY)
    assert not tokenio.chunks_hold(Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")))
    monkeypatch.setattr(tokenio, "MEMO_SIZE", 5)
    for t in ("one two three four", "five six seven", "one eight nine ten"):
        assert ENCODER.encode([t]) == [ids_of(t)]
    assert len(ENCODER.memo) < 12


@pytest.mark.parametrize("text", ["End. Next, word", "a.. b., c,", "é. ½, ́. x.", "it's. 'S, don't.", "A.\nB,\n", "x.<|endoftext|>, y", "3. 4, 5"])
def test_stops_and_commas(text):
    assert ENCODER.encode([text]) == [ids_of(text)]
    assert tokenio.ChunkEncoder(LIBRARY.to_str(), "<u2").encode([text]) == [np.frombuffer(ids_of(text), "<u4").astype("<u2").tobytes()]


def test_memory_has_two_ages(monkeypatch):
    monkeypatch.setattr(tokenio, "MEMO_SIZE", 3)
    encoder = tokenio.ChunkEncoder(LIBRARY.to_str())
    for t in ("one two three", "four one", "one five", "six seven eight", "nine one"):
        assert encoder.encode([t]) == [ids_of(t)]
    assert len(encoder.memo) + len(encoder.older) < 12


def test_many_ranges(spark, tmp_path, monkeypatch):
    """A hot id, a hot row and null ids over many ranges: order, places and checksums hold."""
    monkeypatch.setattr(tokenio, "PART_BYTES", 300)
    rows = [(i, f"text number {i}, again. {i % 7}") for i in range(150)] + [(40, f"hot {i}") for i in range(100)] + [(60, "the same row")] * 100 + [(None, f"none {i}") for i in range(20)]
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    path = str(tmp_path / "ids")
    tokenio.write_ids(docs, path, PATH, segment=50, block=20)
    parts = spark.read.parquet(path)
    assert parts.select("part").distinct().count() > 4
    got = sorted(tokenio.read_checksums(spark, path, tokenio.vocabulary(PATH)).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((k for k, _ in rows), key=lambda k: (k is not None, k or 0))
    assert [r["start"] for r in got] == [0, *np.cumsum([r["n_tokens"] for r in got])[:-1].tolist()]
    end = np.array([2], "<u4").tobytes()
    assert sorted((str(r["doc_id"]), r["ids_crc32"]) for r in got) == sorted((str(k), zlib.crc32(ids_of(t) + end)) for k, t in rows)
    # the hot row is spread over ranges
    assert parts.selectExpr("part", "explode(doc_ids) as k").filter("k = 60").select("part").distinct().count() > 1


def test_files(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["alpha", "beta.", "Gamma", "dé", "12", "x-y"]) for _ in range(rng.randint(0, 60)))) for i in range(300)]
    rows += [(1000, None), (1001, ""), (7, rows[7][1]), (7, "other"), (None, "no id"), (None, None), (-5, "first"), (2000, "long one " * 40_000)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'q' as start", "1 as part")
    path = str(tmp_path / "ids")
    tokenio.write_ids(docs.repartition(5), path, PATH, segment=500, block=200)
    size = tokenio.vocabulary(PATH)
    got = sorted(tokenio.read_checksums(spark, path, size).collect(), key=lambda r: r["start"])
    assert len(got) == len(rows)
    at, last = 0, None
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
        assert last is None or r["doc_id"] >= last
        last = r["doc_id"]
    end = np.array([2], "<u4").tobytes()
    want = sorted((str(k), len(x) // 4, zlib.crc32(x)) for k, x in ((k, ids_of(t) + end) for k, t in rows))
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in got) == want
    full = {r["doc_id"]: r["ids"] for r in tokenio.read_ids(spark, path, size).filter("doc_id in (-5, 1000)").collect()}
    assert full == {-5: [*LIBRARY.encode("first", add_special_tokens=False).ids, 2], 1000: [2]}
    empty = str(tmp_path / "empty")
    assert tokenio.through_files(docs.limit(0), empty, PATH).count() == 0
    with pytest.raises(ValueError):
        tokenio.write_ids(docs, str(tmp_path / "no"), public_tokenizers.path("byte_bpe_50k.json"))


def test_new_plain_words_go_to_the_model_alone(monkeypatch):
    """Words of letters, with signs behind them, need no pass of the whole tokenizer."""
    encoder, seen = tokenio.ChunkEncoder(LIBRARY.to_str()), []
    whole = encoder._each
    monkeypatch.setattr(encoder, "_each", lambda chunks: seen.extend(chunks) or whole(chunks))
    text = "Plain words, Ärger über ÉTÉ! Привет, λόγος... it's 12 ΣΑΣ a.b <|endoftext|> end.\nPlain"
    assert encoder.encode([text]) == [ids_of(text)]
    assert not {"Plain", "words,", "Ärger", "ÉTÉ!", "Привет,", "λόγος...", "end."} & set(seen)
    assert {"it's", "12", "ΣΑΣ", "a.b", "<|endoftext|>"} <= set(seen)


def test_every_letter_that_counts_as_plain():
    letters = [c for c in map(chr, range(0x3000)) if c.isprintable() and tokenio._PLAIN.fullmatch(c)[1]]
    signs = [chr(c) for c in range(33, 127) if not chr(c).isalnum()]
    texts = [c + c.upper() + c for c in letters] + [f"{c}{s} {c}ab{s}{s}" for c in "aÉя" for s in signs] + [a + s + b for a in ("a", "Éa") for s in signs for b in signs]
    assert len(letters) > 380
    assert tokenio.ChunkEncoder(LIBRARY.to_str()).encode(texts) == [ids_of(t) for t in texts]


def test_other_tokenizers_have_no_plain_words():
    import json

    made = json.loads(LIBRARY.to_str())
    assert ENCODER.model is not None
    for change in ({"normalizer": None}, {"added_tokens": [*made["added_tokens"], {**made["added_tokens"][0], "id": 49408, "content": "ab"}]}):
        other = Tokenizer.from_str(json.dumps(made | change))
        encoder = tokenio.ChunkEncoder(other.to_str())
        assert encoder.model is None
        assert encoder.encode(["cab ab. x", "y"]) == [np.array(other.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in ("cab ab. x", "y")]


def test_many_texts_at_once_share_a_small_memory(monkeypatch):
    monkeypatch.setattr(tokenio, "WORDS", 7)
    rng = random.Random(5)
    texts = [" ".join(rng.choice("ab de'f Ü. 9 . ,x \n\n İ <|endoftext|> ﬁn ab, ab.".split(" ")) + rng.choice(["", "q", "R."]) for _ in range(rng.randint(0, 40))) for _ in range(60)]
    encoder = tokenio.ChunkEncoder(LIBRARY.to_str(), "<u2")
    for _ in range(2):
        ids, bounds = encoder.together(texts)
        assert [ids[lo:hi].tolist() for lo, hi in zip(bounds[:-1], bounds[1:])] == [np.frombuffer(ids_of(t), "<u4").tolist() for t in texts]
    assert isinstance(encoder.memo.names.to_pylist(), list) and encoder.memo.ids.dtype == np.dtype("<u2")


def test_coding_tasks_hold_no_encoder():
    """Workers live on through later tasks and stages, which do without the tokenizer's memory."""
    tokenio.chunked(LIBRARY.to_str(), "<u2")
    assert tokenio._ENCODERS
    assert list(tokenio.unencoding(lambda batches: iter(batches))([1, 2])) == [1, 2]
    assert not tokenio._ENCODERS
