import hashlib
import re

import pytest

from tessera.llm import chat, mixing
from tessera.llm.queries import op5_chat_formatting, op6_source_mixing

TURNS = [
    (1, 0, "system", "be\nkind"), (1, 1, "user", "a <|turn|> b \\ <\\| c"), (1, 2, "assistant", "</s>[INST] ok [/INST] \\\\"), (1, 3, "user", "<|end|>"), (1, 4, "assistant", ""),
    (2, 1, "assistant", "first"), (2, 0, "user", None), (2, None, None, "no turn"), (3, 0, "user", "never answered"), (4, 0, "user", "q"), (4, 1, "assistant", "r"), (4, 2, "user", "tail"),
    (5, 0, "assistant", "same"), (5, 0, "assistant", "same"), (5, 0, "assistant", "other"), (None, 0, "user", "x"), (None, 1, "assistant", "\U0001f600"),
]


def brute(rows):
    by = {}
    for c, t, r, x in rows:
        by.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    out = []
    for c, own in by.items():
        own.sort()
        turns = "".join(f"{r}\n{x}\n" for _, _, r, x in own)
        lost = "".join(x for _, _, r, x in own if r == "assistant")
        out.append((c, len(own), hashlib.sha256(turns.encode()).hexdigest(), len(lost), hashlib.sha256(lost.encode()).hexdigest()))
    return sorted(out, key=str)


def test_round_trip(spark):
    df = spark.createDataFrame([(*r, "e") for r in TURNS], "conv_id long, turn long, role string, text string, example string")
    examples = chat.format_chat(df)
    got = chat.read_back(examples).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == brute(TURNS)
    for r in examples.collect():
        # outside its marks a text has no control string left
        body = re.sub(r"<\|(turn|body|end)\|>", "", r.text)
        assert not any(c in body for c in chat.CONTROL)
        if r.loss_start is not None:
            assert r.text[r.loss_start + r.loss_length :] == chat.END
    n = {(r.conv_id, r.example): r.n_turns for r in examples.collect()}
    assert n[1, 0] == 3 and n[1, 1] == 5 and n[3, 0] == 1 and n[4, 1] == 3
    assert chat.format_chat(df.limit(0)).count() == 0


def test_query_on_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    assert sorted((tuple(r)[:5] for r in op5_chat_formatting(spark, sf).collect()), key=str) == brute(rows)


def test_targets():
    sizes = {"a": 10, "b": 1000, "c": 40}
    got = mixing.capped_targets(sizes, {"a": 5, "b": 2, "c": 1}, 1.5 * 1050, 2)
    assert got["a"] == 20 and got["c"] == 80 and abs(sum(got.values()) - 1575) < 1e-9
    assert mixing.capped_targets({"a": 10, "b": 10}, {"a": 1, "b": 1}, 60, 2) == {"a": 20, "b": 20}


def test_flow_shares_overlapping_patterns():
    patterns = [(("a",), 100), (("a", "b"), 100), (("b",), 10)]
    taken = mixing.min_cost_flow(patterns, {"a": 120, "b": 90}, 2)
    assert sum(taken) == 210 and taken[0] == 100 and taken[1] == 100 and taken[2] == 10  # nobody repeats
    taken = mixing.min_cost_flow(patterns, {"a": 100, "b": 200}, 2)
    assert sum(taken) == 300 and all(t <= 2 * s for t, (_, s) in zip(taken, patterns))
    assert mixing.min_cost_flow(patterns, {"a": 1000, "b": 1000}, 2) == [200, 200, 20]


def test_mix_of_table(spark, sf):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op6_source_mixing(spark, sf).collect()
    assert len(rows) == len(docs)
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", d.text or "")) for i, d in docs.items()}
    source, taken, target = {}, {}, {}
    for r in rows:
        s = docs[r.doc_id].source
        assert r.size == size[r.doc_id] and r.taken in (0, r.size, 2 * r.size)
        source[s] = source.get(s, 0) + r.size
        taken[s] = taken.get(s, 0) + r.taken
        target[s] = r.target
    names = sorted(source, key=lambda s: (s is None, s or ""))
    want = mixing.capped_targets({s: source[s] for s in names}, {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}, 1.5 * sum(source.values()), 2)
    for r in rows:
        assert r.source_size == source[docs[r.doc_id].source]
    for s in names:
        assert target[s] == pytest.approx(want[s])
        longest = max(size[i] for i, d in docs.items() if d.source == s)
        assert abs(taken[s] - want[s]) <= longest / 2 + 1
    again = {(r.doc_id, r.taken) for r in op6_source_mixing(spark, sf).collect()}
    assert again == {(r.doc_id, r.taken) for r in rows}


def test_mix_edges(spark):
    schema = "doc_id long, text string, source string, _copies int, size string"
    rows = [(1, "a b c", None, 0, ""), (2, None, "x", 0, ""), (3, "", "x", 0, ""), (4, "d e", "x", 0, ""), (4, "d e", "x", 0, ""), (None, "f", "y", 0, "")]
    df = spark.createDataFrame(rows, schema)
    found, mix = mixing.mix_documents(df.drop("_copies"))
    got = mixing.with_targets(found, mix).collect()
    assert len(got) == 6 and all(r.taken <= 2 * r.size for r in got)
    assert list(mix.sizes) == ["x", "y", None]
    assert set(mixing.take(df.drop("_copies")).columns) == {"doc_id", "text", "source", "size"}
    found, mix = mixing.mix_documents(df.limit(0))
    assert found.count() == 0


def test_overlapping_sources(spark):
    from pyspark.sql import functions as F

    rows = [(i, " ".join(["w"] * (10 + i % 7)), ["a"] if i % 3 == 0 else ["a", "b"] if i % 3 == 1 else ["b"]) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, sources array<string>")
    found, mix = mixing.mix_documents(df, sources=F.col("sources"))
    total = found.selectExpr("sum(size * _copies)").first()[0]
    assert abs(total - sum(mix.targets.values())) <= 50


def test_flow_is_the_cheapest_of_the_largest():
    """All integer flows of small networks, tried one by one."""
    from itertools import product
    from random import Random

    rng = Random(6)
    for _ in range(60):
        names = ["a", "b", "c"][: rng.randint(1, 3)]
        patterns = [(tuple(sorted(rng.sample(names, rng.randint(1, len(names))))), rng.randint(0, 2)) for _ in range(rng.randint(1, 3))]
        quotas = {s: rng.randint(0, 4) for s in names}
        best = None
        routes = [(i, s) for i, (members, _) in enumerate(patterns) for s in members]
        for amounts in product(*[range(min(2 * patterns[i][1], quotas[s]) + 1) for i, s in routes]):
            taken, filled = [0] * len(patterns), dict.fromkeys(names, 0)
            for (i, s), n in zip(routes, amounts):
                taken[i] += n
                filled[s] += n
            if all(t <= 2 * size for t, (_, size) in zip(taken, patterns)) and all(filled[s] <= quotas[s] for s in names):
                value = -sum(taken), sum(max(0, t - size) for t, (_, size) in zip(taken, patterns))
                best = value if best is None else min(best, value)
        got = mixing.min_cost_flow(patterns, quotas, 2)
        assert all(0 <= t <= 2 * size for t, (_, size) in zip(got, patterns))
        assert (-sum(got), sum(max(0, t - size) for t, (_, size) in zip(got, patterns))) == best
