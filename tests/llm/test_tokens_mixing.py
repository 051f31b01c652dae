import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import mixing, queries, tokens

pytestmark = pytest.mark.skipif(not os.path.exists(tokens.TOKENIZER), reason="no vocabulary here")
TEXTS = [
    None, "", " ", "\n\n  \t", "Hello world's  end 12345 — café naïve", "<|endoftext|> plain", "日本語のテキスト。売上高は17.2%増", "👍🏽📈 ok​", "a" * 50_000, "word " * 20_000, "x\r\ny\x0cz\x85", "M%S&!)'\n" * 500,
    "Straßé ﬁ ǅ ½ ²", "don't they'll we've I'd", "　 mixed spaces ", "a1b22c333", "тест Ελληνικά",
]


@pytest.fixture(scope="module")
def codec():
    with open(tokens.TOKENIZER, encoding="utf-8") as f:
        return tokens.Codec(f.read())


def test_pieces_give_the_library_ids(codec):
    r = random.Random(4)
    alphabet = "ab Z9.'\n\té漢😀ß _-"
    texts = TEXTS + ["".join(r.choice(alphabet) for _ in range(r.randrange(0, 60))) for _ in range(400)]
    want = [e.ids for e in codec.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert codec.by_piece and [x.tolist() for x in codec.encode(texts)] == want


def test_the_store_of_pieces_is_bounded(codec, monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_PIECES", 50)
    codec.memo.clear()
    texts = [f"w{k} " + "x" * (40 + k) for k in range(200)]
    want = [e.ids for e in codec.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [codec.encode([t])[0].tolist() for t in texts] == want
    assert len(codec.memo) <= 50 and max(map(len, codec.memo)) <= tokens.MEMO_CHARS
    codec.memo.clear()


def test_spans_and_decoding(codec):
    for t in TEXTS[1:]:
        (ids,) = codec.encode([t])
        assert codec.decode(ids) == t
        starts, ends = codec.spans(t, ids)
        assert len(starts) == len(ids) and (len(ids) == 0 or (starts[0] == 0 and ends[-1] == len(t)))
        assert all(b <= c for b, c in zip(starts[1:], ends)) and all(a <= b for a, b in zip(starts, starts[1:]))
    (ids,) = codec.encode(["😀"])
    assert len(ids) > 1 and set(zip(*(x.tolist() for x in codec.spans("😀", ids)))) == {(0, 1)}
    assert codec.decode(ids[:1]) == "�" and codec.decode([]) == ""
    assert sorted(tokens.byte_table().values()) == list(range(256))


def test_columns(spark):
    words = tokens.vocabulary(spark)
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").withColumn("ids", F.lit("clash"))
    out = df.select("doc_id", "text", tokens.encode(F.col("text"), words).alias("t"), tokens.count_tokens(F.col("text"), words).alias("n"), tokens.encode_with_spans(F.col("text"), words).alias("s"))
    got = out.withColumn("back", tokens.decode(F.col("t"), words)).collect()
    assert len(got) == len(TEXTS) and all(r.back == (r.text or "") and r.n == len(r.t) and r.s.ids == r.t for r in got)
    assert got[0].t == [] and got[1].t == []
    assert df.filter("false").select(tokens.encode(F.col("text"), words)).count() == 0
    assert spark.sql("SELECT CAST(NULL AS array<int>) x").select(tokens.decode(F.col("x"), words)).head()[0] is None


def targets(spark, data):
    return spark.createDataFrame(data, "source string, target_pct int, max_repeats int, total_tokens long")


def test_shares_copies_and_shortfalls(spark):
    r = random.Random(2)
    docs = [(k, ["big", " BIG ", "Mid", "small"][r.choice([0, 0, 0, 0, 1, 2, 2, 3])], r.randrange(1, 400)) for k in range(6000)] + [(90_000, None, 5), (90_001, "other", 5), (90_002, "mid", 0)]
    sized = spark.createDataFrame(docs, "doc_id long, source string, n_tokens long")
    t = targets(spark, [("Big", 50, 1, 400_000), ("mid", 30, 2, 400_000), (" small", 19, 2, 4_000_000), ("none", 1, 3, 400_000), (None, 9, 9, 9)])
    mixed, report = mixing.mix(sized, t, blocks=20)
    rep = {x.source.strip().lower(): x for x in report.collect()}
    have = {s: sum(n for _, q, n in docs if (q or "").strip().lower() == s) for s in rep}
    for s, pct, cap, total in (("big", 50, 1, 400_000), ("mid", 30, 2, 400_000), ("small", 19, 2, 4_000_000), ("none", 1, 3, 400_000)):
        x = rep[s]
        assert x.available_tokens == have[s] and x.short == (have[s] * cap < pct * total / 100)
        reach = min(pct * total / 100, have[s] * cap)
        assert abs(x.mixed_tokens - reach) <= max(0.01 * reach, 400), s
    assert abs(sum(x.actual_share for x in rep.values()) - 1) < 1e-9
    counts = {}
    for x in mixed.collect():
        counts[x.source.strip().lower(), x.doc_id] = max(counts.get((x.source.strip().lower(), x.doc_id), 0), x.copy)
    assert max(n for (s, _), n in counts.items() if s == "big") == 1 and {n for (s, _), n in counts.items() if s == "small"} == {2}
    for s, x in rep.items():  # floor or ceiling of the rate, the boundary rule over one order
        assert {n for (q, _), n in counts.items() if q == s} <= {int(np.floor(x.rate)), int(np.ceil(x.rate))}
    assert sorted(map(tuple, mixed.collect())) == sorted(map(tuple, mixing.mix(sized, t, blocks=20)[0].collect()))


def test_empty_mixes(spark):
    sized = spark.createDataFrame([(1, "a", 0), (2, "a", None)], "doc_id long, source string, n_tokens long")
    t = targets(spark, [("a", 100, 2, 10)])
    mixed, report = mixing.mix(sized, t)
    assert mixed.count() == 0 and report.select("available_tokens", "actual_share", "short").head() == (0, 0.0, True)
    assert mixing.mix(sized.filter("false"), t)[1].count() == 1 and mixing.mix(sized, t.filter("false"))[1].count() == 0


def test_the_shortfalls_come_from_the_emitted_mix(spark, tmp_path):
    docs = [(k, "a" if k % 3 else "b", "word " * (k % 7)) for k in range(60)]
    spark.createDataFrame(docs, "doc_id long, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    targets(spark, [("A", 50, 1, 100), ("b", 50, 2, 1_000_000)]).write.parquet(f"{tmp_path}/mix_targets.parquet")
    found = queries.p8_found(spark, str(tmp_path))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "_rank" in plan and "_copies" in plan and "Window" in plan  # ranks and emission are part of what tells the shortfalls
    assert [x.source for x in found.collect()] == ["b"]


def test_order_does_not_depend_on_blocks_and_caps_hold(spark):
    r = random.Random(6)
    docs = [(k, "a" if k % 3 else "b", r.choice([0, 1, 7, 8, 9, 400])) for k in range(900)]
    sized = spark.createDataFrame(docs, "doc_id long, source string, n_tokens long")
    t = targets(spark, [("a", 80, 3, 90_000), ("b", 20, None, 10**9)])
    one, many = (sorted(map(tuple, mixing.mix(sized, t, blocks=n)[0].collect())) for n in (1, 64))
    assert one == many
    by = [d for d, s, _, _ in one if s == "b"]
    assert sorted(by) == [k for k, s, _ in docs if s == "b"]  # at the cap every document stands as often as it may, null being once
    sizes = spark.createDataFrame([(n,) for n in (None, 0, 1, 2, 3, 7, 8, 2**40)], "n long")
    assert [x[0] for x in sizes.select(mixing.size_class(F.col("n"))).collect()] == [0, 0, 4, 6, 8, 12, 12, 160]
