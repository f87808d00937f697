"""Token output, packing and token counts against plain recomputation."""

import functools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from podium.llm import packing, simple8b, token_counts, token_files
from podium.llm.common import segments, shared_path
from podium.llm.tokens import TokenEncoder, vocabulary_path
from tests.conftest import SMOKE

SCHEMA = "doc_id long, text string, lang string, source string, extra string, ids string, part string"
LONG = " ".join(f"word{i % 97}" for i in range(30000))
ROWS = [(1, "a plain text", "en", "s0", "x", "y", "z"), (2, None, None, None, None, None, None),
        (3, "", "en", "s1", "x", "y", "z"), (4, "two  spaces \n \n and\ttabs ", "en", "s0", "x", "y", "z"),
        (4, "two  spaces \n \n and\ttabs ", "en", "s0", "x", "y", "z"),
        (5, LONG, "de", "s0", "x", "y", "z"), (6, "<|endoftext|> ünï日本 \U0001f600", "fr", "s2", "x", "y", "z")]


@functools.lru_cache
def tokenizer():
    return TokenEncoder().tokenizer


def ids_of(text, end=None):
    ids = tokenizer().encode(text or "", add_special_tokens=False).ids
    return ids + ([] if end is None else [end])


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_piecewise_ids_equal_whole_ids():
    rng = random.Random(1)
    alphabet = "ab  \n\t'sé1! 　\x1c日"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    encoder = TokenEncoder(memo_bytes=50_000)
    for size in (50, 2_000_000):
        ids, counts = encoder.encode(texts, len(texts), size=size)
        at = np.concatenate([[0], np.cumsum(counts)])
        for i, text in enumerate(texts):
            assert ids[at[i]:at[i + 1]].tolist() == ids_of(text), repr(text)


def test_borders_of_all_kinds_are_sure(monkeypatch):
    """Any mix of letters, digits, signs, contractions and white space, cut in tiny windows too."""
    from tokenizers import Tokenizer

    from podium.llm import tokens

    plain = Tokenizer.from_file(vocabulary_path())
    rng = random.Random(9)
    parts = ["don't", "'s", "'ll", "''", "!'s", "it's5", "a1", "1a", "x.y", "\u00e9", "\u00d7", "\u00c3\u00a0", "\u00aa", "\u0142",
             "\u00b2", "\u2003", "\u00a0", "\u3000", "\x85", "\u200b", "\u00c3", "_", "-", ".", "word", "Wort", "9", " ", " ", " ",
             "  ", "\n", "\n\n", "\t", "\r\n", "\x1c", "\x7f", "\U0001f600", "<|endoftext|>", "\u0301"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(4000)]
    texts += ["    indented\n        code(x)\n" * 200, "x" * 700 + " " + "1a" * 400, "a b " * 300]
    want = [x.ids for x in plain.encode_batch(texts, add_special_tokens=False)]
    for window in (tokens.WINDOW, 61):
        monkeypatch.setattr(tokens, "WINDOW", window)
        ids, counts = TokenEncoder(memo_bytes=200_000).encode(texts, len(texts), size=1 << 16)
        at = np.concatenate([[0], np.cumsum(counts)])
        for i, text in enumerate(texts):
            assert ids[at[i]:at[i + 1]].tolist() == want[i], repr(text)


def test_single_pre_tokens_go_to_the_model(monkeypatch):
    rng = random.Random(5)
    letters = [*"abcxyzABCXYZ", *map(chr, range(0xC0, 0x100))]  # the two signs among them are no letters
    texts = [" ".join("".join(rng.choices(letters, k=rng.randint(1, 12))) for _ in range(50)) + f" {rng.randint(0, 10**9)}7 x1"
             for _ in range(200)]
    encoder, whole = TokenEncoder(), []
    monkeypatch.setattr(encoder, "_whole_ids", lambda pieces, f=encoder._whole_ids: whole.extend(pieces) or f(pieces))
    ids, counts = encoder.encode(texts, len(texts))
    at = np.concatenate([[0], np.cumsum(counts)])
    for i, text in enumerate(texts):
        assert ids[at[i]:at[i + 1]].tolist() == ids_of(text), repr(text)
    assert whole and all("\u00d7" in p or "\u00f7" in p for p in map(bytes.decode, whole))


def test_other_vocabularies_take_the_whole_tokenizer(tmp_path):
    from tokenizers import AddedToken, Tokenizer, normalizers, pre_tokenizers

    changes = [lambda t: t.add_tokens([AddedToken("word")]), lambda t: setattr(t, "normalizer", normalizers.Lowercase()),
               lambda t: setattr(t, "pre_tokenizer", pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)),
               lambda t: t.enable_truncation(1)]
    for i, change in enumerate(changes):
        other = Tokenizer.from_file(vocabulary_path())
        change(other)
        other.save(str(tmp_path / f"{i}.json"))
        encoder = TokenEncoder(str(tmp_path / f"{i}.json"))
        assert encoder.model is None
        text = "Swordfish"
        assert encoder.encode([text], 1)[0].tolist() == other.encode(text, add_special_tokens=False).ids


def test_batches_are_cut_by_bytes():
    import pyarrow as pa

    from podium.llm.common import row_slices
    texts = ["a" * 70, None, "", "\u00e9" * 60, "b" * 500, "c", "d" * 99, None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(texts, pa.string())], ["n", "text"])
    got = [x.column("n").to_pylist() for x in row_slices([batch, batch.slice(0, 0), batch.slice(6)], "text", 100)]
    assert got == [[0, 1, 2, 3], [4], [5, 6], [7], [6, 7]]


def test_memory_of_the_memo_is_bounded_by_bytes():
    encoder = TokenEncoder(memo_bytes=300_000)
    rng = random.Random(3)
    for _ in range(20):
        encoder.encode([" ".join("".join(rng.choices("abcdefghij", k=9)) for _ in range(1500)) + "  " + "z" * 5000], 1)
        assert encoder.size < 900_000 and max(map(len, encoder.index)) <= 256


def test_pieces_met_again_stay_in_the_memo(monkeypatch):
    encoder, encoded, held = TokenEncoder(memo_bytes=300_000), [], 0
    monkeypatch.setattr(encoder, "_ids", lambda pieces, f=encoder._ids: encoded.extend(pieces) or f(pieces))
    rng = random.Random(4)
    usual = [f"usual{''.join(rng.choices('abcdefghij', k=6))}" for _ in range(500)]
    for _ in range(40):  # far more rare words than the memo holds
        rare = ["".join(rng.choices("klmnopqrst", k=9)) for _ in range(1500)]
        text = " ".join(["x", *usual, *rare])
        assert encoder.encode([text], 1)[0].tolist() == ids_of(text)
        held = max(held, len(encoder.index))
    assert sorted(p for p in encoded if p.startswith(b" usual")) == sorted(f" {w}".encode() for w in usual)
    assert len(encoded) > 50_000 and held > 3000


def test_pieces_of_equal_hash_are_told_apart(monkeypatch):
    from podium.llm import tokens
    monkeypatch.setattr(tokens, "span_hashes", lambda data, a, b, f=tokens.span_hashes: f(data, a, b) & np.uint64(7))
    rng = random.Random(6)
    texts = [" ".join(rng.choices(["one", "two", "One", "Three", "straße", "1234", "x.", "\u65e5"], k=30)) + f" {i} q{i}" for i in range(300)]
    encoder = TokenEncoder(memo_bytes=4000)
    for first in range(0, 300, 20):
        part = texts[first:first + 20]
        ids, counts = encoder.encode(part, len(part))
        assert ids.tolist() == [i for t in part for i in ids_of(t)]
        assert counts.tolist() == [len(ids_of(t)) for t in part]


def test_added_tokens_keep_their_id():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(vocabulary_path())  # as the library reads the file
    rng = random.Random(2)
    parts = ["<|endoftext|>", "<|endoftext|", "a", "b.", " ", "  ", "\n", "\t", "é!", "日"]
    texts = ["a <|endoftext|> b"] + ["".join(rng.choices(parts, k=rng.randint(0, 20))) for _ in range(3000)]
    ids, counts = TokenEncoder(memo_bytes=50_000).encode(texts, len(texts))
    at = np.concatenate([[0], np.cumsum(counts)])
    assert ids[:at[1]].tolist() == [64, 220, 50256, 275]
    for i, text in enumerate(texts):
        want = plain.encode(text, add_special_tokens=False).ids
        assert ids[at[i]:at[i + 1]].tolist() == want, repr(text)


def test_segments_join_to_the_text():
    text = "a b  c\n d " * 50 + "x" * 500
    for size in (1, 7, 100, 10_000):
        assert "".join(segments(text, size)) == text


@pytest.mark.parametrize("seed", range(40))
def test_simple8b_round_trip(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(0, 1500))
    bits = rng.integers(0, 65 if seed % 2 else 18, n).astype(np.uint64)
    values = np.where(bits == 0, 0, rng.integers(0, 2**64 - 1, n, dtype=np.uint64, endpoint=True)
                      >> (np.uint64(64) - np.maximum(bits, 1)))
    if seed % 5 == 0:
        values = np.where(rng.random(n) < 0.5, np.uint64(2**64 - 1), values)
    words, offsets = simple8b.encode(values)
    assert (simple8b.decode(words, n, offsets) == values).all()
    if n > 2 * simple8b.BLOCK:
        part = simple8b.decode(words, n, offsets, 1, 2)
        assert (part == values[simple8b.BLOCK:2 * simple8b.BLOCK]).all()


def test_token_files_edge_rows(spark, docs):
    path = token_files.write_token_files(docs, shared_path(spark, "t"), end_id=2, files=3)
    got = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"])
                 for r in token_files.token_digests(spark, path).collect())
    want, start = [], 0
    for row in sorted(ROWS, key=lambda r: (r[0], r[1] or "")):
        ids = ids_of(row[1], 2)
        want.append((start, row[0], len(ids), crc(ids)))
        start += len(ids)
    assert got == want
    read = {r["doc_id"]: r["ids"] for r in token_files.read_token_files(spark, path).collect()}
    assert read[5] == ids_of(LONG, 2)


def test_token_files_empty_table(spark, docs):
    path = token_files.write_token_files(docs.limit(0), shared_path(spark, "t"))
    assert token_files.token_digests(spark, path).count() == 0


def check_pieces(pieces, rows, end, length=packing.LENGTH):
    docs = {}
    for p in pieces:
        docs.setdefault((p["doc_id"], p["source"]), []).append(p)
    stream = sorted((p["sequence_id"], p["offset"], p["length"]) for p in pieces)
    at = 0
    for sequence, offset, size in stream:
        assert sequence * length + offset == at and offset + size <= length
        at += size
    want = {}
    for r in rows:
        want.setdefault((r[0], r[3]), []).append(ids_of(r[1], end))
    assert at == sum(len(i) for v in want.values() for i in v)
    for key, copies in want.items():
        got = sorted((p["start"], p["length"], p["ids_crc32"]) for p in docs.get(key, []))
        assert sum(g[1] for g in got) == sum(map(len, copies))
        for start, size, digest in got:
            assert digest == crc(copies[0][start:start + size])


def test_packing_edge_rows(spark, docs):
    check_pieces(packing.pack(docs, end_id=0).collect(), ROWS, 0)
    check_pieces(packing.pack(docs, end_id=0, length=64, quantum=16, targets={"s0": 5}).collect(),
                 ROWS, 0, 64)
    assert packing.pack(docs.limit(0)).count() == 0


def test_packing_ids_are_the_documents(spark, docs):
    rows = packing.pack(docs.where("doc_id = 5"), end_id=0, with_ids=True).orderBy("start").collect()
    assert [i for r in rows for i in r["ids"]] == ids_of(LONG, 0)


def test_windows_hold_the_target_mixture(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in docs.collect()]
    pieces = packing.pack(docs, end_id=0, quantum=64).collect()
    check_pieces(pieces, rows, 0)
    total = sum(p["length"] for p in pieces)
    share, by_window = {}, {}
    for p in pieces:
        share[p["source"]] = share.get(p["source"], 0) + p["length"] / total
        window = by_window.setdefault(p["sequence_id"], {})
        window[p["source"]] = window.get(p["source"], 0) + p["length"]
    whole = total // packing.LENGTH - 1 - 64 * len(share) // packing.LENGTH - 1
    served = dict.fromkeys(share, 0)
    for w in range(whole):
        for s, n in by_window[w].items():
            served[s] += n
        for s in share:  # the carried deficit stays within a few granules at every window
            assert abs(served[s] - share[s] * (w + 1) * packing.LENGTH) <= 3 * 64


def test_schedule_equals_a_sequential_round_robin():
    totals, q = [1000, 130, 64, 700, 15], 32
    schedule = packing.Schedule(totals, quantum=q)
    turns = sorted(((2 * k + 1) / max(1, w), s, k) for s, (t, w) in
                   enumerate(zip(totals, schedule.weights)) for k in range(t // q))
    for rank, (_, s, k) in enumerate(turns):
        assert schedule.rank(np.array([s]), np.array([k]))[0] == rank
    big = packing.Schedule(totals, quantum=q)
    big.kind = object
    for rank, (_, s, k) in enumerate(turns):
        assert big.rank(np.array([s]), np.array([k]))[0] == rank


def test_vocabulary_is_a_parameter(spark, docs):
    path = vocabulary_path()
    a = token_counts.counted(docs, path).agg(F.sum("tokens")).first()[0]
    assert a == sum(len(ids_of(r[1])) for r in ROWS)


def test_rollup_deltas(spark, docs):
    rollup = token_counts.Rollup(spark, shared_path(spark, "r"))
    assert rollup.totals().count() == 0
    first = token_counts.estimated(docs)
    exact = token_counts.counted(docs)
    rollup.commit(0, token_counts.signed(first, 1))
    rollup.commit(1, token_counts.signed(first, -1), token_counts.signed(exact, 1))
    rollup.commit(1, token_counts.signed(first, -1), token_counts.signed(exact, 1))
    rollup.commit(0, token_counts.signed(first, 1))
    rollup.commit(2, token_counts.signed(exact.where("doc_id = 4"), -1))
    rollup.commit(3, token_counts.signed(exact.limit(0), 1))
    got = {(r["source"], r["lang"]): (r["docs"], r["tokens"], r["chars"])
           for r in rollup.totals().collect()}
    want = {}
    for r in ROWS:
        if r[0] != 4:
            a = want.get((r[3], r[2]), (0, 0, 0))
            want[(r[3], r[2])] = (a[0] + 1, a[1] + len(ids_of(r[1])), a[2] + len(r[1] or ""))
    assert got == want
    assert rollup.batches() == [0, 1, 2, 3]
    with pytest.raises(ValueError, match="other sums"):
        rollup.commit(1, token_counts.signed(exact, 1))
    # totals of the last mark are lost with the driver: the batches behind the mark before it are added
    jvm = spark.sparkContext._jvm
    mark = jvm.org.apache.hadoop.fs.Path(f"{rollup.path}/totals_to=3/_SUCCESS")
    mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(mark, False)
    rollup.commit(7, token_counts.signed(exact.where("doc_id = 4"), 1))
    assert rollup.totals().agg(F.sum("docs")).first()[0] == len(ROWS)
    with pytest.raises(ValueError, match="must rise"):
        rollup.commit(5, token_counts.signed(exact, 1))
