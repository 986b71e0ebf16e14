"""The pipeline's stages on one table and on awkward documents, each against a plain version on its own input."""

import re
import zlib

import corpus_pipeline
from corvina.llm.token_store import byte_bpe

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def one_of_each_group(rows):
    """ids that stay: the smallest of each connected group of 80 % of shingles in common; blank documents all."""
    sets = {r["doc_id"]: shingles(r["text"]) for r in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            if min(len(x), len(y)) * 100 >= 80 * max(len(x), len(y)) and 100 * len(x & y) >= 80 * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i for i in sets if not sets[i] or find(i) == i}


def clean(rows, benchmark):
    """ids of documents that hold no window of ten words of an item, nor a whole shorter item."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words = lambda t: word.findall((t or "").translate(LOWER))
    windows = {}
    for item in map(words, benchmark):
        n = min(10, len(item))
        windows.setdefault(n, set()).update(tuple(item[i : i + n]) for i in range(len(item) - n + 1) if n)
    hit = lambda w: any(tuple(w[i : i + n]) in some for n, some in windows.items() for i in range(len(w) - n + 1))
    return {r["doc_id"] for r in rows if not hit(words(r["text"]))}


def test_stages_against_plain_versions(spark):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    kept = lambda name, df: [r for r in stages[name](spark, df, SF).collect()]
    frame = lambda rows: spark.createDataFrame(rows, docs.schema).repartition(4)
    everything = docs.collect()
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    mild = kept("toxicity", docs)
    gone = {r["doc_id"] for r in everything} - {r["doc_id"] for r in mild}
    known = [labels[i] for i in gone if i in labels]
    assert set(mild) <= set(everything) and sum(known) >= 0.8 * len(known) and sum(labels.get(r["doc_id"]) == 0 for r in mild) >= 0.9 * sum(v == 0 for v in labels.values())
    single = kept("near_dedup", frame(mild))
    assert {r["doc_id"] for r in single} == one_of_each_group(mild) and len(single) == len({r["doc_id"] for r in single})
    benchmark = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    fresh = kept("decontamination", frame(single))
    assert {r["doc_id"] for r in fresh} == clean(single, benchmark) and set(fresh) <= set(single)
    mixed = kept("mixing", frame(fresh))
    assert set(mixed) <= set(fresh) and max(mixed.count(r) for r in set(mixed)) <= 2
    size = lambda rows, s: sum(len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in rows if r["source"] == s)
    assert all(size(mixed, s) <= 2 * size(fresh, s) for s in {r["source"] for r in fresh})
    got = stages["token_output"](spark, frame(mixed), SF).orderBy("start").collect()
    encoder = Tokenizer.from_file(byte_bpe())
    encoder.encode_special_tokens = True
    start = 0
    for r, d in zip(got, sorted(mixed, key=lambda r: r["doc_id"]), strict=True):
        ids = [*encoder.encode(d["text"] or "", add_special_tokens=False).ids, 0]
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (d["doc_id"], start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids)))
        start += len(ids)
    assert columns == docs.columns


def test_awkward_documents_go_through(spark, docs, none):
    """Nulls, empty and long texts, repeated rows, and no documents at all: every stage keeps the columns of documents."""
    for df, some in ((docs, True), (none, False)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, df, SF)
            assert out.columns == df.columns, name
            rows = out.collect()
            assert bool(rows) == some, name
            df = spark.createDataFrame(rows, none.schema)
        assert (corpus_pipeline.token_output(spark, df, SF).count() > 0) == some
