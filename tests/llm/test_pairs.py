"""Near duplicates, decontamination, lines: against SQL or brute force."""

import math
import re
import time
from itertools import combinations
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from corvina.llm import decontaminate, line_dedup, near_dedup
from corvina.llm.common import CLEAN_UP, connected_components, cut

SF = "/root/testdata/sf0.001"


def same(got, want):
    columns = sorted(want.columns)
    plain = lambda v: None if v is None or isinstance(v, float) and math.isnan(v) else v.item() if hasattr(v, "item") else v
    rows = lambda f: sorted((tuple(plain(v) for v in r) for r in f[columns].itertuples(index=False)), key=repr)
    assert sorted(got.columns) == columns and rows(got) == rows(want)


@pytest.mark.parametrize("part, name", [(decontaminate, "op1_decontaminate"), (near_dedup, "op2_near_dedup")])
def test_against_sql(spark, db, part, name):
    same(part.QUERIES[name](spark, SF).toPandas(), db.sql(part.ORACLES[name]).df())


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (10, 11), (5, 5), (None, 1), (4, 1), (1, 2)], "a long, b long")
    assert {tuple(r) for r in connected_components(edges).collect()} == {(1, 1), (2, 1), (3, 1), (4, 1), (10, 10), (11, 10)}
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long")
    assert {r["root"] for r in connected_components(chain).collect()} == {0}
    assert connected_components(edges.where("false")).isEmpty()


def test_cut_leaves_no_shuffle_files(spark):
    dirs = list(spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString())
    files = lambda: {f for d in dirs for f in Path(d).rglob("shuffle_*")}
    before, setting = files(), spark.conf.get(CLEAN_UP)
    df = spark.range(10_000).repartition(5, "id").groupBy((F.col("id") % 7).alias("m")).count()
    out = cut(df)
    assert sorted(r["count"] for r in out.collect()) == sorted(r["count"] for r in df.collect())
    held = spark.range(10_000).repartition(5, "id").groupBy((F.col("id") % 7).alias("m")).count()
    alone = files()
    cut(held)
    # The frame is still referred to, and its files are gone.
    until = time.time() + 10
    while (left := files() - alone - before) and time.time() < until:
        time.sleep(0.2)
    assert not left and held is not None and spark.conf.get(CLEAN_UP) == setting


def test_sketch_values_are_dealt_once(spark):
    values = spark.createDataFrame([(i, i % 7 if i < 50 else i) for i in range(100)], "node long, v long")
    found = near_dedup._shared(cut(values), 5)
    assert {(r["node"], r["v"], r["df"]) for r in found.collect()} == {(i, i % 7, 8 if i % 7 == 0 else 7) for i in range(50)}
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("ReusedExchange") == 1


def test_decontaminate_edges(spark, docs, none):
    items = spark.createDataFrame([("s", "one"), ("n", None), ("e", ""), (None, "no id here"), ("w", "WORD0 word1, word2 word3 word4 word5 word6 word7 word8 word9 word10"), ("w", "one")], "item_id string, text string")
    got = {(r["id"], r["code"]): r for r in decontaminate.find_windows(docs, items).collect()}
    by = {r["id"]: r for r in got.values()}
    assert by[1]["n_hit"] == 11 and by[1]["items"] == ["w"] and [tuple(s) for s in by[1]["spans"]] == [(0, 11)]
    assert by[3]["n_hit"] == 0 and by[4]["n_words"] == 0 and by[5]["n_words"] == 0
    assert by[7]["n_hit"] == 1 and by[7]["copies"] == 2 and sorted(by[7]["items"]) == ["s", "w"]
    assert by[None]["n_hit"] == 3 and by[None]["items"] == []
    assert sum(r["copies"] for r in got.values()) == docs.count()
    kept = decontaminate.decontaminate(docs.withColumn("__id", F.lit(1)), items)
    assert kept.columns == [*docs.columns, "__id"] and sorted(r["doc_id"] for r in kept.select("doc_id").collect()) == [3, 4, 5, 6, 8, 9, 10]
    spans = {r["doc_id"]: r["text"] for r in decontaminate.decontaminate(docs, items, mode="spans").collect()}
    assert spans[1].split()[0] == "word11" and spans[7] == "" and spans[4] is None and spans[None] == "at all" and spans[8] == "Ünïcode wörds İ ß é"
    assert decontaminate.find_windows(none, items).isEmpty() and decontaminate.decontaminate(docs, items.where("false")).count() == docs.count()
    # Blocks of the benchmark give the same as one broadcast.
    a = decontaminate.find_windows(docs, items).select("id", "code", "n_hit", F.array_sort("items").alias("i"))
    b = decontaminate.find_windows(docs, items, block_windows=1).select("id", "code", "n_hit", F.array_sort("items").alias("i"))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def jaccard_components(rows, words):
    def shingles(t):
        w = re.sub("[A-Z]", lambda m: m[0].lower(), t or "").encode().split()
        n = min(words, len(w))
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()

    sets = [(i, shingles(t)) for i, t in rows]
    root = list(range(len(sets)))
    for a, b in combinations(range(len(sets)), 2):
        x, y = sets[a][1], sets[b][1]
        if x and y and 100 * len(x & y) >= 80 * len(x | y):
            ra, rb = root[a], root[b]
            root = [ra if r == rb else r for r in root]
    out = []
    for k, (i, s) in enumerate(sets):
        ids = [sets[j][0] for j in range(len(sets)) if root[j] == root[k] and sets[j][0] is not None]
        out.append((i, len(s), (min(ids) if ids else None) if s else i))
    return sorted(out, key=repr)


@pytest.mark.parametrize("words", [2, 5])
def test_near_duplicates_by_brute_force(spark, docs, texts, words):
    got = near_dedup.near_duplicates(docs, words=words).collect()
    assert sorted(((r["id"], r["n_shingles"], r["component_id"]) for r in got), key=repr) == jaccard_components([(t[0], t[1]) for t in texts], words)


def test_large_near_group(spark):
    """One hot group whose members are alike in different degrees, among texts with a common passage."""
    import random

    r = random.Random(3)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(300):
        w = list(base)
        for _ in range(r.randrange(0, 9)):
            w[r.randrange(120)] = f"x{i}_{r.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join([*base[:60], *(f"y{i}_{j}" for j in range(60))])) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = near_dedup.near_duplicates(df, words=2).collect()
    assert sorted(((x["id"], x["n_shingles"], x["component_id"]) for x in got), key=repr) == jaccard_components(rows, 2)


def test_keep_one(spark, docs, none):
    kept = near_dedup.keep_one(docs.withColumn("key", F.lit(1)))
    assert kept.columns == [*docs.columns, "key"]
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted([1, 4, 5, 6, 7, 8, 9, 10, None], key=repr)
    assert near_dedup.keep_one(none).isEmpty()


def test_keep_one_tells_components_apart(spark):
    """Null and repeated ids are no components: texts that aren't alike all stay."""
    rows = [(None, "alpha beta gamma delta epsilon zeta"), (None, "one two three four five six"), (None, "one two three four five six"), (None, "red green blue black white grey"), (7, "north east south west up down"), (7, "spring summer autumn winter again"), (8, "spring summer autumn winter again"), (9, " ")]
    got = sorted(((r["doc_id"], r["text"]) for r in near_dedup.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()), key=repr)
    assert got == sorted({r for r in rows if r[0] != 8}, key=repr)


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_lines_by_brute_force(spark):
    line = "the quick brown fox jumps over the lazy dog and runs away from all of the hounds that follow it home tonight"
    rows = [(i, "\n".join([f"own line number {chr(97 + i)} {'z' * i}", line.replace("quick", "quack") if i % 3 == 0 else line.upper(), "", "!!"])) for i in range(20)] + [(50, None), (None, line), (51, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    lines = sorted(line_dedup.lines_of(df, "doc_id", "text").collect(), key=lambda r: (r["id"] is None, r["id"] or 0, r["line_no"]))
    root = list(range(len(lines)))
    for a, b in combinations(range(len(lines)), 2):
        x, y = lines[a], lines[b]
        if edit(x["line"], y["line"]) <= math.floor(0.15 * max(len(x["line"]), len(y["line"])) + 1e-9):
            ra, rb = root[a], root[b]
            root = [ra if r == rb else r for r in root]
    want = {}
    for k, r in enumerate(lines):
        if root.index(root[k]) != k:
            want.setdefault(r["id"], []).append(r["line_no"])
    assert {r["id"]: r["removed"] for r in line_dedup.removed_lines(df).collect()} == {i: sorted(k) for i, k in want.items()}
    assert len(want) >= 19
    clean = {r["doc_id"]: r["text"] for r in line_dedup.drop_lines(df).collect()}
    assert clean[50] is None and clean[51] == "" and "fox" in clean[0] and clean[1].endswith("\n\n!!")
    assert line_dedup.removed_lines(df.where("false")).isEmpty()


def test_lines_by_edit_similarity_alone(spark):
    """Lines of many lengths with a word changed, or letters up to the similarity: all short pairs and all with one word are found."""
    import random

    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(r.randrange(2, 9)))
    rows, near = [], []
    for i in range(240):
        words = [word() for _ in range(1 + i % 40)]
        new, line = list(words), " ".join(words)
        k = r.randrange(len(words))
        new[k] = "".join(r.choice("qrstuvwxyz") for _ in words[k]) if i % 2 else words[k][:-1] + "z"
        rows += [(2 * i, line), (2 * i + 1, " ".join(new))]
        if edit(line, rows[-1][1]) <= math.floor(0.15 * max(len(line), len(rows[-1][1])) + 1e-9):
            near.append((2 * i + 1, len(line)))
    rows += [(1000, "a bb"), (1001, "a bc"), (1002, "seven letters"), (1003, "seven letter"), (1004, None), (1005, ""), (1006, " ,; \n!"), (1007, "x " * 5000), (1008, "x " * 5000 + "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    gone = {x["id"] for x in line_dedup.removed_lines(df).collect()}
    short = [(i, t) for i, t in rows if t and len(t) <= 40]
    must = {b for k, (b, y) in enumerate(short) for a, x in short[:k] if edit(x, y) <= math.floor(0.15 * max(len(x), len(y)) + 1e-9)}
    assert must - {1006} <= gone and 1003 in gone and 1001 not in gone and 1008 in gone and not gone & {i for i, _ in rows if i % 2 == 0 and i < 1000} - must
    long_ = [i in gone for i, n in near if n > 40]
    assert len(long_) > 150 and sum(long_) >= 0.97 * len(long_)


def test_confirming_moves_one_copy_of_a_line(spark, monkeypatch):
    texts = ["some words of a line that is repeated", "some words of a line that is repeatet", "nothing like the other two at all"]
    lines = spark.createDataFrame([(i, str(i % 3).encode(), texts[i % 3]) for i in range(60)], "row long, key binary, line string")
    uniq = lines.groupBy("key").agg(F.min("row").alias("row")).withColumn("node", F.col("row") + 100)
    moved = []
    monkeypatch.setattr(line_dedup, "cut", lambda df: moved.append(df) or cut(df))
    pairs = spark.createDataFrame([(100, 101), (100, 102), (101, 102)], "a long, b long")
    assert [tuple(r) for r in line_dedup._confirm(pairs, uniq, lines, 0.85).collect()] == [(100, 101)]
    # Copies would be told apart by an aggregation of the texts, after a move of them all.
    assert "first(line" not in moved[-1]._jdf.queryExecution().optimizedPlan().toString()


def test_long_lines_with_some_changes(spark):
    """Lines of 200 to 900 letters with two words changed: nine of ten are found, and of lines with one word changed all."""
    import random

    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(r.randrange(4, 10)))
    rows = []
    for i in range(60):
        words = [word() for _ in range(35 + 2 * i)]
        touched = set(r.sample(range(len(words)), 1 + i % 2))
        new = [w[:-1] + "z" if k in touched else w for k, w in enumerate(words)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(new))]
    gone = {x["id"] for x in line_dedup.removed_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert not any(i % 2 == 0 for i in gone)
    assert sum(i % 4 == 1 for i in gone) == 30 and sum(i % 4 == 3 for i in gone) >= 27


def test_simhash_of_long_lines(spark):
    """Narrow and wide lanes agree with plain counts by class; a line beyond the narrow lanes keeps its count."""
    words = [[f"w{i}" for i in range(n)] for n in (1, 2, 255, 256, 700)]
    for lanes in (line_dedup.NARROW, line_dedup.WIDE):
        for turn in range(2):
            first, second, sums = line_dedup.bit_counts(F.col("x"), turn, lanes)
            each = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, w array<string>").select("i", F.explode("w").alias("x")).select("i", *first)
            plain = {}
            for row in each.collect():
                plain.setdefault(row["i"], []).append((row[1], row[2] % 2**64))
            got = each.select("i", *second).groupBy("i").agg(*sums).select("*", *line_dedup.class_words(turn, lanes)).select("*", line_dedup.simhash(turn, lanes)).collect()
            for r in got:
                at, want = 0, 0
                for b, n in enumerate(line_dedup.BLOCKS):
                    mine = [h for kind, h in plain[r["i"]] if kind == b]
                    assert r[f"n{turn}_{b}"] == len(mine)
                    want |= sum(1 << k for k in range(at, at + n) if 2 * sum(h >> k & 1 for h in mine) > len(mine))
                    at += n
                assert r[f"sim{turn}"] % 2**64 == want
    assert line_dedup._hashed(spark.createDataFrame([(1, "w " * 9000 + "w")], "row long, line string")).select("sim0").first()[0] is not None


def test_unlike_long_lines_of_common_words_do_not_meet(spark, monkeypatch):
    """Lines that share their short words and nothing else are hardly compared; near ones among them are found."""
    import random

    r = random.Random(10)
    common = "the of and in to a is en that it on for de was be as la with er by this an re are at".split()
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(r.randrange(6, 10)))
    rows = []
    for i in range(300):
        words = common * 4 + [word() for _ in range(20)]
        r.shuffle(words)
        rows.append((i, " ".join(words)))
        if i % 10 == 0:
            words[r.randrange(len(words))] = "changed"
            rows.append((1000 + i, " ".join(words)))
    seen, confirm = [], line_dedup._confirm
    monkeypatch.setattr(line_dedup, "_confirm", lambda pairs, *how: seen.append(pairs.count()) or confirm(pairs, *how))
    gone = {x["id"] for x in line_dedup.removed_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert gone == {i for i, _ in rows if i >= 1000}
    assert sum(seen) < 100


def test_near_texts_are_those_of_the_edit_distance(spark):
    """The bounds before the distance change no answer: letters beyond the BMP, inserted words, changes around the limit."""
    import random

    r = random.Random(11)
    pairs = []
    for i in range(300):
        text = [r.choice("aabcdeé😀  ") for _ in range(r.choice((5, 90, 100, 150, 240)))]
        new = list(text)
        for _ in range(int(len(text) * r.uniform(0, 0.3))):
            at = r.randrange(len(new) + 1)
            new[at : at + r.randrange(2)] = r.choice(("", "x", "x", " ", "😀"))
        pairs.append(("".join(text), "".join(new) if i % 5 else "".join(r.sample(text, len(text)))))
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    got = {x["i"]: x["near"] for x in df.select("i", line_dedup._near_texts(F.col("a"), F.col("b"), 0.85).alias("near")).collect()}
    want = {i: edit(a, b) <= math.floor(0.15 * max(len(a), len(b)) + 1e-9) for i, (a, b) in enumerate(pairs)}
    assert got == want and 60 < sum(want.values()) < 240
