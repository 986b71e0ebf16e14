"""Every operator on nulls, empty and long texts, repeated rows, empty tables and columns whose names could clash with its own."""

import pytest
from pyspark.sql import functions as F

from corvina.llm import decontaminate, license_scan, line_dedup, mixing, near_dedup, quality, sharding, token_store, toxicity
from corvina.llm.common import connected_components
from corvina.llm.labelled import sample

NAMES = ("score", "size", "id", "key", "row", "rows", "n", "code", "g", "__id", "__p", "line", "node", "toxicity", "rid")


def clashing(docs):
    return docs.select("*", *[F.lit(i).alias(name) for i, name in enumerate(NAMES)])


def labels(spark):
    return spark.createDataFrame([(1, 0, 0), (3, 1, 1), (9, 0, 1), (8, 1, 0), (None, 1, 1), (10, None, None)], "doc_id long, quality int, toxic int")


def bench(spark):
    return spark.createDataFrame([(1, " ".join(f"word{i}" for i in range(12))), (2, None), (3, "")], "item_id long, text string")


OPERATORS = {
    "decontaminate": lambda spark, docs: decontaminate.decontaminate(docs, bench(spark)),
    "keep_one": lambda spark, docs: near_dedup.keep_one(docs),
    "near_duplicates": lambda spark, docs: near_dedup.near_duplicates(docs, words=2),
    "shard": lambda spark, docs: sharding.shard(docs, 3),
    "repeat": lambda spark, docs: mixing.repeat(docs),
    "mix": lambda spark, docs: mixing.mix(docs),
    "drop_lines": lambda spark, docs: line_dedup.drop_lines(docs),
    "tokens": lambda spark, docs: token_store.encode_and_read(docs, tokenizer=token_store.byte_bpe()),
    "licenses": lambda spark, docs: license_scan.scan_licenses(docs),
    "reject_toxic": lambda spark, docs: toxicity.reject_toxic(docs, labels(spark)),
    "toxicity": lambda spark, docs: toxicity.score(docs, toxicity.train(docs, labels(spark))),
    "quality": lambda spark, docs: quality.score(docs, quality.train(docs, labels(spark))),
}
#: Operators that return each row once.
WHOLE = {"near_duplicates", "shard", "mix", "drop_lines", "tokens", "licenses", "toxicity", "quality"}


@pytest.mark.parametrize("name", OPERATORS)
def test_awkward_rows_and_names(spark, docs, texts, none, name):
    got = OPERATORS[name](spark, clashing(docs))
    rows = got.collect()
    assert len(set(got.columns)) == len(got.columns)
    assert name not in WHOLE or len(rows) == len(texts)
    assert OPERATORS[name](spark, clashing(none)).isEmpty()


def test_samples_stay_bounded(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(50)] + [(i, "x") for i in range(2, 9)], "doc_id long, text string")
    known = spark.createDataFrame([(i, 1) for i in range(1, 9)], "doc_id long, toxic int")
    got = sample(docs, known, "toxic", folds=1000, held_out=999, per_class=(2, 8)).collect()
    assert len(got) == 8 and sum(r["text"].startswith("text") for r in got) == 1


def test_components_either_way(spark):
    """Chains, stars, loops and null ends, in one Arrow task, one partition, and by exchanges."""
    from corvina.llm import common

    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(5)] + [(7, 7), (None, 3), (200, 150), (150, 199)]
    df = spark.createDataFrame(edges, "a long, b long")
    want = {i: 0 for i in range(31)} | {i: 100 for i in range(100, 105)} | {i: 150 for i in (150, 199, 200)}
    limit = common.EDGES_OF_A_TASK
    for arrow, most in ((True, limit), (False, limit), (False, 1)):
        common.EDGES_OF_A_TASK = most
        try:
            assert {r["node"]: r["root"] for r in connected_components(df, arrow=arrow).collect()} == want
            assert connected_components(df.where("a < 0"), arrow=arrow).isEmpty()
        finally:
            common.EDGES_OF_A_TASK = limit


def test_odd_sketch_is_a_lower_bound():
    import random

    import numpy as np

    r = random.Random(2)
    for n in (0, 1, 5, 170, 3000):
        a = {r.getrandbits(64) for _ in range(n)}
        b = {x for x in a if r.random() < 0.8} | {r.getrandbits(64) for _ in range(n // 10)}
        x, y = (near_dedup._odd(np.array(sorted(s), np.uint64)) for s in (a, b))
        assert len(x) == near_dedup.ODD_BITS // 64 and sum(bin((p ^ q) & (2**64 - 1)).count("1") for p, q in zip(x, y)) <= len(a ^ b)


def test_encoder_asks_what_the_tokenizer_does(spark):
    """Tokenizers that normalise or part texts by another rule encode whole texts: ids as the library gives them."""
    import public_tokenizers
    import pyarrow as pa
    from tokenizers import Tokenizer

    texts = ["Hello  World again", "ÀÉ fi  x", "", "one", " lead and trail ", "a\nb"]
    for name, parted in (("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)):
        path = public_tokenizers.path(name)
        encoder, library = token_store.Encoder(path), Tokenizer.from_file(path)
        library.encode_special_tokens = True
        ids, sizes = encoder.encode(pa.array([*texts, None]))
        want = [library.encode(t, add_special_tokens=False).ids for t in [*texts, ""]]
        assert encoder.parted == parted and ids.tolist() == [i for w in want for i in w] and sizes.tolist() == [len(w) for w in want]


def test_license_places_in_a_long_text():
    """Two million words are gone through once for each phrase."""
    import time

    began = time.process_time()
    n, base, _ = license_scan.Scanner().scan("x mit license " * 300_000 + "apache license")
    assert time.process_time() - began < 30
    assert n == 900_002 and len(base) == 300_001
    assert sorted(b[0] for b in base)[:2] == [1, 4] and max(b[0] for b in base) == 900_000


def test_nearest_on_awkward_vectors(spark):
    """Squares that overflow or vanish, nulls, zeros, other lengths, ties, repeated rows: as comparing all."""
    from corvina.llm import neighbours

    rows = [(i, [float((i * 7) % 11 - 5), float(i % 5), 1.0]) for i in range(60)]
    rows += [(100, [1e180, 1.0, 0.0]), (101, [-1e180, 2.0, 0.0]), (102, [1e-200, 0.0, 0.0]), (103, None), (104, [0.0, 0.0, 0.0]), (105, [1.0, None, 0.0]), (106, [float("nan"), 1.0, 1.0]), (107, [1.0, 2.0]), (108, [float("inf"), 1.0, 1.0]), (5, [float((5 * 7) % 11 - 5), 0.0, 1.0]), (None, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in ("id", "v", "q", "d", "shard")})
    some = {i: v for i, v in rows if i is not None and v and len(v) == 3 and None not in v and any(v) and all(abs(x) < 1e300 for x in v)}
    dot = lambda a, b: a[0] * b[0] + a[1] * b[1] + a[2] * b[2]
    for shard in (16, 8192):
        got = neighbours.nearest(df, F.col("vec_id") % 20 == 0, k=5, shard=shard, block=2).collect()
        for q in (i for i in some if i % 20 == 0):
            want = sorted(((-dot(some[q], v), i) for i, v in some.items() if i != q))[:5]
            assert [(r["id"], r["score"]) for r in sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])] == [(i, -s) for s, i in want], q
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 20 == 0).isEmpty()
