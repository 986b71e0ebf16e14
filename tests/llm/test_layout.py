"""Sharding, mixing, token files, nearest neighbours, and the pipeline."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corvina.llm import mixing, neighbours, sharding, token_store

SF = "/root/testdata/sf0.001"


def test_room_tree():
    r, tree, rooms = random.Random(1), sharding.RoomTree(), []
    for i in range(500):
        if r.random() < 0.6:
            rooms.append((r.randrange(50), i))
            tree.insert(rooms[-1])
        else:
            size = r.randrange(50)
            want = min((x for x in rooms if x[0] >= size), default=None)
            assert tree.take(size) == want
            if want:
                rooms.remove(want)


def test_best_fit_decreasing():
    assert sharding.best_fit_decreasing([6, 5, 4, 3, 2], 10) == [0, 1, 0, 1, 1]
    assert sharding.best_fit_decreasing([12, 3], 10) == [0, 1]
    assert sorted(set(sharding.even_bins([100, 5, 5, 4, 4, 3, 3], 3))) == [0, 1, 2]
    assert max(sharding.best_fit_decreasing([9, 9, 9], 10, bins=2)) == 1


def test_shards(spark, docs, texts, none):
    got = sharding.shard(docs, 4).collect()
    assert len(got) == len(texts)
    for k in {r["shard"] for r in got}:
        assert sorted(r["slot"] for r in got if r["shard"] == k) == list(range(sum(r["shard"] == k for r in got)))
    by = {r["id"]: r for r in got}
    assert by[1]["shard"] == by[2]["shard"] and by[4]["size"] == 8 and by[4]["text_crc32"] == 0 and by[8]["size"] == len("Ünïcode wörds İ ß é".encode()) + 8 and by[8]["text_crc32"] == zlib.crc32("Ünïcode wörds İ ß é".encode())
    assert sharding.shard(none, 3).isEmpty()
    assert len({r["shard"] for r in sharding.shard(docs, capacity=10**9).collect()}) == 1
    with pytest.raises(ValueError, match="either"):
        sharding.shard(docs)


def test_shards_are_even(spark):
    got = sharding.op4_sharding(spark, "/root/testdata/sf0.01").groupBy("shard").agg(F.sum("size").alias("b")).toPandas()
    assert len(got) == 24 and got.b.max() < 1.05 * got.b.mean()


def test_mix_hits_targets(spark):
    got = mixing.op5_mixing(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "source"), "doc_id").toPandas()
    g = got.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"), size=("size", "sum"), top=("size", "max"))
    assert ((g.taken - g.target).abs() <= g.top / 2 + 1e-6).all() and (got.taken <= 2 * got["size"]).all()
    assert abs(g.target.sum() - 1.5 * g["size"].sum()) < 1e-6 * g["size"].sum() and (g.target <= 2 * g["size"] + 1e-9).all()
    again = mixing.op5_mixing(spark, "/root/testdata/sf0.01").toPandas()
    assert got.sort_values("doc_id").taken.tolist() == again.sort_values("doc_id").taken.tolist()


def test_mix_edges(spark, docs, none):
    got = mixing.mix(docs).collect()
    assert len(got) == docs.count() and all(r["copies"] in (0, 1, 2) for r in got)
    assert mixing.mix(none).isEmpty() and mixing.repeat(none).columns == none.columns
    assert mixing.repeat(docs.withColumn("n", F.lit(1))).columns == [*docs.columns, "n"]
    assert mixing.repeat(docs).count() == sum(r["copies"] for r in mixing.mix(docs, payload=F.xxhash64(*docs.columns)).collect())


def test_mix_of_many_equal_rows(spark, monkeypatch):
    """A source of 10,000 equal rows and some others: targets are met, no row exceeds its cap, equal rows in any layout give the same counts."""
    monkeypatch.setattr(mixing, "PART_ROWS", 700)
    rows = [(None, "a b c", "hot")] * 10_000 + [(i, "w " * (1 + i % 9), "cold") for i in range(500)] + [(7, "same text", None)] * 30
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    counts = []
    for n in (3, 5):
        got = mixing.mix(df.repartition(n)).groupBy("source", "id", "size", "target", "source_size", "copies").count().collect()
        assert sum(r["count"] for r in got) == len(rows)
        for source in ("hot", "cold", None):
            mine = [r for r in got if r["source"] == source]
            assert abs(sum(r["size"] * r["copies"] * r["count"] for r in mine) - mine[0]["target"]) <= max(r["size"] for r in mine) / 2 + 1e-6
            x = mine[0]["target"] / mine[0]["source_size"]
            assert all(int(x) <= r["copies"] <= -int(-x // 1) for r in mine)
        counts.append(sorted(map(str, got)))
        again = mixing.repeat(df.repartition(n)).groupBy("doc_id", "source").count().collect()
        assert {(r["doc_id"], r["source"]): r["count"] for r in again if r["doc_id"] is None or r["source"] is None} == {k: v for k in ((None, "hot"), (7, None)) if (v := sum(r["copies"] * r["count"] for r in got if (r["id"], r["source"]) == k))}
    assert counts[0] == counts[1]


def test_mix_against_plain_sums(spark, db):
    """Size, the source's size and its target by DuckDB and a plain levelling of targets."""
    sizes = dict(db.sql(r"SELECT source, sum(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))) FROM documents GROUP BY source").fetchall())
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, target, open_ = 1.5 * sum(sizes.values()), {}, set(names)
    while over := [s for s in open_ if left * weight[s] / sum(weight[x] for x in open_) > 2 * sizes[s]]:
        target |= {s: 2.0 * sizes[s] for s in over}
        open_ -= set(over)
        left = 1.5 * sum(sizes.values()) - sum(target.values())
    target |= {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = mixing.op5_mixing(spark, SF).join(docs.select("doc_id", "source"), "doc_id").collect()
    assert {(r["source"], r["source_size"]) for r in got} == set(sizes.items())
    assert all(abs(r["target"] - target[r["source"]]) < 1e-6 * r["target"] for r in got)


def test_wavelet_matrix():
    ids = np.random.default_rng(1).integers(0, 50257, 3000).astype(np.uint16)
    ids[::7] = 5
    w = token_store.WaveletMatrix.frombytes(token_store.WaveletMatrix.build(ids, 16).tobytes())
    assert (w.decode() == ids).all() and all(w.access(i) == ids[i] for i in range(0, 3000, 37))
    assert w.count(5) == (ids == 5).sum() and w.count(5, 100, 900) == (ids[100:900] == 5).sum() and w.count(50256 + 1) == 0
    assert w.locate(5, 50, 400) == [i for i in range(50, 400) if ids[i] == 5]
    assert token_store.WaveletMatrix.frombytes(token_store.WaveletMatrix.build(ids[:0], 16).tobytes()).decode().size == 0


ODD = ["", "a", " a", "a  b", "a \n b", "  lead", "trail  ", "x\n\ny  z\t w", "<|endoftext|> hi", None, "it's we'll don't 12 34,5 €uro", "x y", "é é a\r\n b", "a b", "a　 b", "hello world foo, bar. baz", "a \n, b, \n,", "x, y \n,z"]


def _library(literal: bool, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(token_store.byte_bpe())
    t.encode_special_tokens = literal
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


def _encoded(encoder, texts):
    ids, sizes = encoder.encode(pa.array(texts, pa.string()))
    return [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] if texts else []


def test_encoder_equals_library():
    for literal in (True, False):
        encoder, want = token_store.Encoder(token_store.byte_bpe(), literal), _library(literal, ODD)
        assert _encoded(encoder, ODD) == want
        # Again with pieces known, and each text by itself.
        assert _encoded(encoder, ODD) == want and [_encoded(encoder, [x])[0] for x in ODD] == want
        assert _encoded(encoder, []) == []


def test_encoder_equals_library_on_chance_texts(monkeypatch):
    r = random.Random(3)
    letters = [*" \n\t,.a'é1-|", " ", " ", "\u2003", "\x1c", "\x85", "日", "<|endoftext|>", "word", "ſ", "ª", "̈", "😀", "'s", "Ⅷ", ".,"]
    texts = ["".join(r.choices(letters, k=r.randrange(12))) for _ in range(4000)]
    for literal in (True, False):
        want = _library(literal, texts)
        assert _encoded(token_store.Encoder(token_store.byte_bpe(), literal), texts) == want
        monkeypatch.setattr(token_store, "KNOWN_PIECES", 5)
        encoder = token_store.Encoder(token_store.byte_bpe(), literal)
        assert _encoded(encoder, texts) == want and _encoded(encoder, texts) == want
        monkeypatch.undo()


def test_special_tokens_as_the_library(spark):
    """Files hold the ids of plain library encoding, special tokens' wording included."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(token_store.byte_bpe())
    odd = ["a <|endoftext|> hi", "<|endoftext|>", "<|endoftext|> hi you", "x<|endoftext|>y z", "a  <|endoftext|>. b", "a |endoftext| <|endoftext", "a \n<|endoftext|>\n b", "plain words only", None]
    ids = [t.encode(x or "", add_special_tokens=False).ids for x in odd]
    assert 50256 in ids[0] and len(ids[0]) == 4
    assert _encoded(token_store.Encoder(token_store.byte_bpe(), literal=False), odd) == ids
    df = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_tokens"], r["ids_crc32"]) for r in token_store.encode_and_read(df, tokenizer=token_store.byte_bpe()).collect()}
    assert got == {i: (len(x) + 1, zlib.crc32(np.array([*x, 0], "<u4").tobytes())) for i, x in enumerate(ids)}


def test_files_answer_without_decoding(spark, tmp_path):
    """Access, count and locate in the written blocks, against plain lists; a vocabulary too large for the depth is an error."""
    texts = [f"one two two three {i % 7} two" for i in range(50)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    path = str(tmp_path / "tokens")
    token_store.write_tokens(df, path, tokenizer=token_store.byte_bpe(), partitions=3, block_tokens=40)
    blocks = {(r["part"], r["seq"]): token_store.WaveletMatrix.frombytes(bytes(r["block"])).decode().tolist() for r in spark.read.parquet(path).collect()}
    assert len(blocks) > 5 and sum((blocks[k] for k in sorted(blocks)), []) == sum(([*x, 0] for x in _library(False, texts)), [])
    two = _library(False, [" two"])[0][0]
    want = {(*k, i) for k, ids in blocks.items() for i, x in enumerate(ids) if x == two}
    assert len(want) == 150 and {(r["part"], r["seq"], r["within"]) for r in token_store.find_token(spark, path, two).collect()} == want
    assert {(r["part"], r["seq"]): r["n"] for r in token_store.count_token(spark, path, two).collect()} == {k: ids.count(two) for k, ids in blocks.items()}
    places = spark.createDataFrame([(*k, i) for k in blocks for i in (0, 3, 10**6)], "part int, seq int, within long")
    assert {(r["part"], r["seq"], r["within"]): r["token"] for r in token_store.tokens_at(spark, path, places).collect()} == {(*k, i): ids[i] for k, ids in blocks.items() for i in (0, 3)}
    with pytest.raises(Exception, match="need more than 12 bits"):
        token_store.write_tokens(df, str(tmp_path / "small"), tokenizer=token_store.byte_bpe(), depth=12)


def test_token_files(spark, texts, none):
    from tokenizers import Tokenizer

    df = spark.createDataFrame(texts, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = {(r["doc_id"], r["start"]): (r["n_tokens"], r["ids_crc32"]) for r in token_store.encode_and_read(df, tokenizer=token_store.byte_bpe(), block_tokens=100).collect()}
    t = Tokenizer.from_file(token_store.byte_bpe())
    at, want = 0, {}
    for i, text in sorted(((x[0], x[1] or "") for x in texts), key=lambda x: (x[0] is not None, x[0] or 0)):
        ids = [*t.encode(text, add_special_tokens=False).ids, 0]
        want[i, at] = (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert got == want
    assert token_store.encode_and_read(none, tokenizer=token_store.byte_bpe()).isEmpty()


def brute(rows, k, every):
    use = {}
    for i, v in rows:
        if i is not None and v is not None and len(v) == 4 and all(x is not None and np.isfinite(x) for x in v) and any(v):
            use[i] = v
    out = {}
    for q, v in use.items():
        if q % every == 0:
            s = sorted((-float(np.cumsum(np.array(v) * np.array(w))[-1]), i) for i, w in use.items() if i != q)
            out[q] = [(i, -x) for x, i in s[:k]]
    return out


@pytest.mark.parametrize("shard, block", [(8192, 2048), (40, 3)])
def test_nearest_by_brute_force(spark, shard, block):
    r = random.Random(5)
    rows = [(i, [r.gauss(0, 1) * (1 + i % 3) for _ in range(4)]) for i in range(300)]
    rows += [(1000 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(100)]  # one common vector
    rows += [(2000, None), (2001, []), (2002, [0.0] * 4), (2003, [1.0, None, 0.0, 0.0]), (2004, [float("nan")] * 4), (2005, [float("inf"), 1.0, 1.0, 1.0]), (2020, [1.0, 2.0]), (None, [1.0] * 4), (7, rows[7][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x"))
    got = neighbours.nearest(df, F.col("vec_id") % 20 == 0, k=5, shard=shard, block=block).collect()
    by = {}
    for x in sorted(got, key=lambda x: (x["query_id"], x["rank"])):
        by.setdefault(x["query_id"], []).append((x["id"], x["score"]))
    assert by == brute(rows, 5, 20)


def test_nearest_of_few(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in neighbours.nearest(df, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 0.5)]
    assert neighbours.nearest(df.where("false"), F.col("vec_id") == 0).isEmpty()


def test_relaxed_pruning_recall():
    r = np.random.default_rng(2)
    x = r.normal(size=(4000, 16))
    tree = neighbours.build_tree(x, 64)
    assert sorted(tree["order"].tolist()) == list(range(4000))
    exact, _ = neighbours.search_tree(x, tree, x[:50], 10, 1.0, 0.0)
    near, _ = neighbours.search_tree(x, tree, x[:50], 10, 1.3, 0.0)
    d = np.sort(np.sqrt(((x[:50, None] - x[None]) ** 2).sum(2)), 1)[:, :10]
    assert np.allclose(np.sort(exact, 1), d, atol=1e-6)
    assert (np.sort(near, 1) <= d[:, -1:] + 1e-9).mean() >= 0.9


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "mixing", "token_output"]
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    kept = out.toPandas().sort_values("start")
    assert 0 < kept.doc_id.nunique() <= docs.count() and kept.doc_id.value_counts().max() <= 2
    assert (kept.start.diff().dropna().to_numpy() == kept.n_tokens.to_numpy()[:-1]).all() and kept.doc_id.is_monotonic_increasing
