"""Filter audit, Merkle manifest and token counts against plain versions and SQL."""

import hashlib
import re
import zlib
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from corvina.llm import filter_audit, manifest, token_counts
from corvina.llm.common import checkpoint_dir

SF = "/root/testdata/sf0.001"
#: Texts that fail each filter and that pass all.
FINE = " ".join(f"w{i}" for i in range(220))


def plain_rows(frame, columns):
    return sorted((tuple(str(v) for v in r) for r in frame[columns].itertuples(index=False)))


@pytest.mark.parametrize("name, part", [("op11_filter_audit", filter_audit), ("op12_manifest", manifest)])
def test_queries_against_sql(spark, db, name, part):
    got, want = part.QUERIES[name](spark, SF).toPandas(), db.sql(part.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain_rows(got, sorted(want.columns)) == plain_rows(want, sorted(want.columns))


def audited(texts, labels):
    """The audit by applying every order of filters to every document."""
    failed, parts = [], set()
    for id_, text, lang, *_ in texts:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), "D": bool(re.search(r"[#$%&*|]", t))}
        fails["E"] = id_ is not None and any(i is not None and i < id_ and (x or "") == t for i, x, *_ in texts)
        known = [(q, x) for i, q, x in labels if i is not None and i == id_]
        failed.append((lang or "", fails, any(q == 1 for q, _ in known), any(x == 1 for _, x in known)))
        parts.add(lang or "")
    out = {}
    for part in parts:
        removed = {}
        for order in map("".join, permutations("ABCDE")):
            left = [d for d in failed if d[0] == part]
            for step, f in enumerate(order, 1):
                gone = [d for d in left if d[1][f]]
                left = [d for d in left if not d[1][f]]
                all_ = [d for d in failed if d[0] == part and d[1][f]]
                out[part, order, step] = [len(left), len(gone), len(all_) - len(gone), sum(sum(d[1].values()) == 1 for d in all_), sum(d[2] for d in gone), sum(d[3] for d in gone)]
                removed[f] = removed.get(f, 0) + len(gone)
        for order in map("".join, permutations("ABCDE")):
            for step, f in enumerate(order, 1):
                out[part, order, step].append(removed[f])
    return out


def test_audit_by_brute_force(spark, docs, texts, none):
    """Nulls, empty and repeated texts, repeated ids and labels, all five filters failing and passing."""
    more = [(20, FINE, "en", "a", 1), (21, FINE, None, "a", 1), (22, FINE + " 5 %", "", "a", 1), (23, "LOUD " * 300, "en", "a", 1), (23, "LOUD " * 300, "de", "a", 1), (24, FINE.upper() + "|", "de", "a", 1)]
    known = [(1, 1, 0), (1, 0, 1), (21, 1, 1), (23, 0, 1), (None, 1, 1), (24, None, None), (9, 1, 0), (99, 1, 1)]
    rows = spark.createDataFrame(more, docs.schema)
    labels = spark.createDataFrame(known, "doc_id long, quality int, toxic int")
    clash = [F.lit(i).alias(c) for i, c in enumerate(("part", "mask", "digest", "id", "n", "good", "toxic", "first"))]
    got = filter_audit.audit(docs.unionByName(rows).select("*", *clash), labels.withColumn("id", F.lit(1)))
    assert {(r["part"], r["filter_order"], r["step"]): list(r)[3:] for r in got.collect()} == audited(texts + more, known)
    assert filter_audit.audit(none, labels).isEmpty()
    bare = filter_audit.audit(docs, labels.limit(0)).collect()
    assert bare and not any(r["good_lost"] or r["toxic_lost"] for r in bare)


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def climbed(nodes):
    """(root, each node's siblings) of a plain binary tree."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf, i in enumerate(at):
            other = nodes[i ^ 1] if i ^ 1 < len(nodes) else ""
            paths[leaf].append(("", other) if i % 2 == 0 else (other, ""))
        nodes = [sha("".join(nodes[i : i + 2])) for i in range(0, len(nodes), 2)]
        at = [i // 2 for i in at]
    return nodes[0], paths


def leaf(row, more=0):
    id_, text, lang, source, n = row
    n = n + more if n is not None else None
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (id_, source, lang, n, text)))


def manifested(texts):
    trees = {}
    for row in texts:
        trees.setdefault((row[2] is not None, (row[2] or "").encode()), []).append(row)
    names, per = sorted(trees), {}
    for name in names:
        rows = sorted(trees[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        per[name] = rows, *climbed([leaf(r) for r in rows])
    root, tops = climbed([per[name][1] for name in names])
    out = []
    for name, top in zip(names, tops, strict=True):
        rows, sub, paths = per[name]
        for row, path in zip(rows, paths, strict=True):
            bad = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            h = leaf(row, int(bad))
            for before, after in path + top:
                h = sha(before + h + after)
            out.append((row[0], leaf(row), sub, root, sha("".join(a + b for a, b in path + top)), h, h == root))
    return out


@pytest.mark.parametrize("bits", [1, 2, 12])
def test_manifest_by_brute_force(spark, tmp_path, bits):
    """Nulls in every column, repeated rows and ids, an empty and a null part, one-row parts, buckets of 2 and 4 in several stages."""
    rows = [(i, f"text {i % 5}", "en", None if i % 4 == 0 else "s", i) for i in range(37)] + [(i, "x" * i, f"l{i}", "s", None) for i in range(7)]
    rows += [(3, "again", "en", "s", 1), (3, "text 3", "en", "s", 3), (None, None, None, None, None), (None, None, "", "é", 2**63 - 1), (7, "", None, "", -1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    odd = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    clash = df.select("*", F.lit(1).alias("tree"), F.lit(2).alias("h"), F.lit(3).alias("pos"), F.lit(4).alias("n"))
    got = manifest.manifest(clash, tamper=("n_chars", F.when(odd, F.col("n_chars").cast("decimal(20,0)") + 1).otherwise(F.col("n_chars"))), bits=bits)
    proof = F.sha2(F.array_join(F.transform("path", lambda s: F.concat(s["before"], s["after"])), ""), 256)
    got = got.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", F.col("folded_root") == F.col("root")).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, manifested(rows)))


def test_manifest_of_one_row_and_of_none(spark, none):
    one = spark.createDataFrame([(1, "t", "en", "s", 1)], none.schema)
    r = manifest.manifest(one).first()
    assert r["leaf"] == r["subroot"] == r["root"] == r["folded_root"] == leaf((1, "t", "en", "s", 1)) and r["path"] == []
    assert manifest.manifest(none).isEmpty()


AWKWARD = ["", " ", "  two  blanks ", "a\x00b", "<s>special</s>", "<|endoftext|> x", "\U0001f600 　 ﬁ é", "tab\tnew\nline\r\n", "x" * 5000, "word " * 30_000]


def library_counts(texts, path):
    if path.endswith(".model"):
        import sentencepiece

        return [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=path).encode(texts)]
    import tokenizers

    t = tokenizers.Tokenizer.from_file(path)
    return [len(t.encode(x, add_special_tokens=False).ids) for x in texts]


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json", "word_bpe_49k.json"])
def test_counts_equal_the_library(spark, docs, texts, none, name):
    import public_tokenizers

    path, cache = public_tokenizers.path(name), f"{checkpoint_dir(spark)}/counts-test-{name}"
    rows = texts + [(100 + i, t, "en", "a", 1) for i, t in enumerate(AWKWARD)]
    got = token_counts.count_tokens(spark.createDataFrame(rows, docs.schema).withColumn("digest", F.lit(1)).repartition(3), cache, tokenizer=path).collect()
    want = library_counts([t or "" for _, t, *_ in rows], path)
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((r[0], len((r[1] or "").encode()), n)) for r, n in zip(rows, want, strict=True))
    assert token_counts.count_tokens(none, cache, tokenizer=path).isEmpty()


@pytest.mark.parametrize("broadcast", [token_counts.BROADCAST_DIGESTS, 0])
def test_only_misses_are_encoded(spark, tmp_path, monkeypatch, broadcast):
    monkeypatch.setattr(token_counts, "BROADCAST_DIGESTS", broadcast)
    path, cache = token_counts.piece_bpe(), str(tmp_path / "cache")
    held = lambda: spark.read.parquet(cache).count()
    first = spark.createDataFrame([(1, "one two"), (2, "one two"), (3, None), (4, "")], "doc_id long, text string")
    count = lambda df, **how: {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(df, cache, tokenizer=path, **how).collect()}
    a = count(first)
    assert a[1] == a[2] > 0 and a[3] == a[4] == 0 and held() == 2
    more = first.unionByName(spark.createDataFrame([(5, "three")], first.schema))
    assert count(more)[5] > 0 and held() == 3
    assert count(more) and held() == 3
    # A cached count is taken, not made again; two appended ones of a digest are one; another version's isn't seen.
    of = token_counts.tokenizer_version(path, "sentencepiece")
    fake = spark.createDataFrame([("known", 77, of), ("known", 77, of), ("three", 5, "other")], "t string, n_tokens long, version string")
    fake.select(F.unhex(F.sha2("t", 256)).alias("digest"), "n_tokens", "version").write.mode("append").partitionBy("version").parquet(cache)
    asked = spark.createDataFrame([(1, "known"), (2, "KNOWN"), (3, "three")], "doc_id long, text string")
    got = count(asked)
    assert got[1] == 77 and got[2] != 77 and got[3] != 5
    assert count(asked, normalise=lambda t: F.lower(token_counts.null_is_empty(t)))[2] == 77


def test_unknown_tokenizer_files(spark, none):
    with pytest.raises(ValueError, match="no library"):
        token_counts.count_tokens(none, "/nowhere", tokenizer="/x/y.vocab")
