import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tessera.llm.packing import best_fit, pack, pack_documents
from tessera.llm.token_counts import count_tokens, read_cache
from tessera.llm.tokens import TextEncoder

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "\n", "  two  blanks ", "tab\tand\r\nline", "nbsp  and   em", "á é", "́lead", "I'll've it's WE'RE", "x<|endoftext|>y <|startoftext|> z",
    "12345 6.7,8", "***$$$ &&& word*** Éa.", "日本語 テキスト", "\x1c!\x1c ?\x0b", "ﬁ ß ẞ İ Σς", "a" * 3000, "😀 😀😀", "end ", "\n\n para\n\n\n x", "e ́ x", "don't, 'tis", "ΣΑΣ. ΟΔΟΣ", "İstanbul. ÀÉ Ǆ, ǆ", "각. 각", "X𞀰. ꟊ!", "a.b.c ...", "###x### é.é",
]


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_ids_equal_the_library(spark, sf, path):
    lib, own = Tokenizer.from_file(path), TextEncoder(path)
    texts = ODD + [r[0] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    for _ in range(2):  # cold, then warm cache
        for t, ids in zip(texts, own.ids(texts)):
            assert np.frombuffer(ids, "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids, t[:60]


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_random_strings_equal_the_library(path):
    rng = random.Random(17)
    pool = list("aAbzZ  \n\t.,;:!?*$%&#|'-_09") + list("İıŉǆǅßéÉẞﬁΣς각日😀́̇̈\u00a0\u200b\ufeff") + ["e\u0301", "İ!", "I\u0307", "'s", "ll've", "<|endoftext|>"]
    texts = ["".join(rng.choices(pool, k=rng.randint(1, 14))) for _ in range(30_000)]
    lib, own = Tokenizer.from_file(path), TextEncoder(path)
    want = lib.encode_batch(texts, add_special_tokens=False)
    wrong = [t for t, ids, w in zip(texts, own.ids(texts), want) if np.frombuffer(ids, "<u4").tolist() != w.ids]
    assert not wrong, wrong[:5]


def test_cache_is_bounded(monkeypatch):
    import tessera.llm.tokens as m

    monkeypatch.setattr(m, "CACHE_CHUNKS", 50)
    lib, own = Tokenizer.from_file(WORDS), TextEncoder(WORDS)
    for _ in range(2):
        texts = [" ".join(f"word{chr(97 + i % 26)}{chr(97 + k)}." for i in range(20)) for k in range(20)]
        for t in texts:
            [ids] = own.ids([t])
            assert np.frombuffer(ids, "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids
            assert len(own.cache.now) <= 50 + 41


def test_best_fit_against_plain_search():
    rng = np.random.default_rng(1)
    for _ in range(30):
        lengths = np.sort(rng.integers(1, 65, 80))[::-1]
        bins, offsets = best_fit(lengths, 64)
        rooms = []  # plain best-fit decreasing: same number of sequences
        for n in lengths:
            fit = [i for i, r in enumerate(rooms) if r >= n]
            if fit:
                rooms[min(fit, key=lambda i: rooms[i])] -= n
            else:
                rooms.append(64 - n)
        assert bins.max() + 1 == len(rooms)
        for b in range(bins.max() + 1):
            own = sorted(zip(offsets[bins == b], lengths[bins == b]))
            at = 0
            for o, n in own:
                assert o == at
                at += n
            assert at <= 64


def test_one_pass_over_all_tasks(spark):
    """Many tasks give as many sequences as one plain pass, gapless, and reruns agree."""
    rng = np.random.default_rng(4)
    lengths = np.concatenate([rng.integers(1, 200, 3000), np.full(500, 64), rng.integers(1, 9, 1500), [200] * 20])
    rows = [(int(i % 700), int(i), 0, int(n), int(i * 7)) for i, n in enumerate(lengths)]
    df = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    got = pack(df, 200, pieces_per_task=100).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, pack(df.repartition(7), 200, pieces_per_task=100).collect()))
    rooms, plain = [0] * 201, 0
    for n in sorted(lengths.tolist(), reverse=True):
        fit = next((r for r in range(n, 201) if rooms[r]), None)
        plain += fit is None
        if fit is not None:
            rooms[fit] -= 1
        rooms[(fit or 200) - n] += 1
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert len(got) == len(rows) and len(by) == plain
    for own in by.values():
        ends = [0, *np.cumsum([n for _, n in sorted(own)]).tolist()]
        assert [o for o, _ in sorted(own)] == ends[:-1] and ends[-1] <= 200


def test_pack_whole_and_gapless(spark):
    lib = Tokenizer.from_file(WORDS)
    texts = [(1, None), (2, ""), (3, "one two three"), (3, "one two three"), (None, "no id"), (5, "long " * 700), (6, "x y " * 30)]
    df = spark.createDataFrame([(i, t, 9, "s") for i, t in texts], "doc_id long, text string, sequence_id int, offset string")
    rows = pack_documents(df, WORDS, capacity=64).collect()
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append(r)
    for own in by.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 64
    for doc, text in texts:
        ids = lib.encode(text or "", add_special_tokens=False).ids + [0]
        pieces = sorted((r.piece, r.start, r.length, r.ids_crc32) for r in rows if r.doc_id == doc)
        want = [(k, at, len(ids[at : at + 64]), zlib.crc32(np.array(ids[at : at + 64], "<u4").tobytes())) for k, at in enumerate(range(0, len(ids), 64))]
        assert pieces == sorted(want * sum(1 for t in texts if t[0] == doc))
    total = sum(r.length for r in rows)
    assert len(by) <= -(-total // 64) + 2
    assert pack_documents(df.limit(0), WORDS).count() == 0


def test_counts_and_cache(spark, tmp_path):
    lib = Tokenizer.from_file(BYTES)
    texts = [(i, t) for i, t in enumerate(ODD)] + [(50, None), (51, ODD[3]), (51, ODD[3]), (None, "x")]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in texts], "doc_id long, text string, n_tokens int, content int")
    path = str(tmp_path / "cache")
    got = sorted((tuple(r) for r in count_tokens(df, BYTES, path, 512).collect()), key=str)
    want = sorted(((i, len((t or "").encode()), n := len(lib.encode(t or "", add_special_tokens=False).ids), n > 512) for i, t in texts), key=str)
    assert got == want
    stored = read_cache(spark, path).count()
    assert stored == len({t or "" for _, t in texts})
    # a second table: only its new text is encoded, and the file digest keeps tokenizers apart
    more = df.unionByName(spark.createDataFrame([(60, "brand new", 0, 0)], df.schema))
    assert count_tokens(more, BYTES, path).count() == len(texts) + 1
    assert read_cache(spark, path).count() == stored + 1
    count_tokens(df.limit(1), WORDS, path).collect()
    assert read_cache(spark, path).count() == stored + 2
    assert count_tokens(df.limit(0), BYTES, path).count() == 0


def test_query_uses_the_cache_that_the_session_names(spark, sf, tmp_path):
    from tessera.llm.queries import op10_token_counts

    path = str(tmp_path / "lasting")
    spark.conf.set("spark.tessera.tokenCache", path)
    try:
        first = sorted(op10_token_counts(spark, sf).collect())
        stored = read_cache(spark, path).count()
        assert sorted(op10_token_counts(spark, sf).collect()) == first
        assert read_cache(spark, path).count() == stored > 0  # the second call met hits only
    finally:
        spark.conf.unset("spark.tessera.tokenCache")
