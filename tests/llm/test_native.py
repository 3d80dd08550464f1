"""Source mix, adaptive quality, winnowing and sharding against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from sparkmart.llm import common, mixing, quality, sharding, winnow
from tests.llm.cases import DOCS, FOLDER, awkward, frame, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def spark_docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def rows_of(spark, seed=1):
    rng = random.Random(seed)
    return [*awkward(rng), *((100 + i, prose(rng, rng.randint(1, 300)), "de", f"s{rng.randint(0, 4)}", 1) for i in range(60))]


def test_ranks_cross_chunks_without_gap(spark):
    df = spark.createDataFrame([(i, i % 3 if i % 7 else None, (i * 2654435761) % 2**32) for i in range(3000)], "k long, g long, h long")
    got = common.rank_within(df, ["g"], "h", ["k"], "r").collect()
    by = defaultdict(list)
    for r in got:
        by[r["g"]].append((r["h"], r["k"], r["r"]))
    assert len(got) == 3000
    for held in by.values():
        assert [x[2] for x in sorted(held)] == list(range(1, len(held) + 1))


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 101), (101, 102), (200, 100)] + [(300, 301 + i) for i in range(20)]
    got = {r["id"]: r["label"] for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(51)) and all(got[i] == 100 for i in (100, 101, 102, 200)) and got[320] == 300
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 500, None: 30, "c": 0}, {"a": 7}, {"a": 100, "b": 100, "c": 100, "d": 1}, {"a": 0}])
def test_targets_by_resharing(spark, sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, rest, free = dict.fromkeys(order, 0.0), 1.5 * sum(sizes.values()), list(order)
    while free and rest > 1e-9:
        total = sum(weight[s] for s in free)
        for s in free:
            target[s] += rest * weight[s] / total
        rest = sum(max(0, target[s] - 2 * sizes[s]) for s in order)
        target = {s: min(target[s], 2 * sizes[s]) for s in order}
        free = [s for s in free if target[s] < 2 * sizes[s]]
    got = mixing.targets(spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")).collect()
    assert {r["source"]: pytest.approx(r["target"]) for r in got} == target


def test_mix_takes_near_its_targets(spark):
    rows = rows_of(spark)
    got = mixing.digest(frame(spark, rows, extra=True)).collect()
    again = mixing.digest(frame(spark, rows[::-1])).collect()
    plain = lambda rs: sorted((r["doc_id"] is None, r["doc_id"], r["size"], r["taken"]) for r in rs)
    assert len(got) == len(rows) and plain(got) == plain(again)
    taken, goal, largest = Counter(), {}, Counter()
    src = {r[0]: r[3] for r in rows}
    for r in got:
        assert r["taken"] <= 2 * r["size"]
        key = r["source_size"]
        taken[key] += r["taken"]
        goal[key] = r["target"]
        largest[key] = max(largest[key], r["size"])
    assert sum(goal.values()) == pytest.approx(1.5 * sum(len(WORD.findall(r[1] or "")) for r in rows))
    for key in goal:
        assert abs(taken[key] - goal[key]) <= largest[key] + 1
    assert {r["doc_id"]: r["size"] for r in got if r["doc_id"] is not None} == {r[0]: len(WORD.findall(r[1] or "")) for r in rows if r[0] is not None}
    assert src and mixing.digest(spark.createDataFrame([], DOCS)).count() == 0


def plain_measures(text):
    w = WORD.findall(text or "")
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_quality_measures(spark):
    rows = [*rows_of(spark), (900, "a b c a b c x a b c # $", "en", "s", 1), (901, "# a\n# a\n\n\n# a \nb", "en", "s", 1), (902, "a a a a a", "en", "s", 1)]
    got = quality.digest(frame(spark, rows, extra=True)).collect()
    want = sorted((r[0] is None, r[0] or 0, *plain_measures(r[1])) for r in rows)
    assert want == sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in got)
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    assert quality.digest(spark.createDataFrame([], DOCS)).count() == 0


def test_quality_fences_follow_the_group(spark):
    rng = random.Random(5)
    rows = []
    for i in range(500):
        text = prose(rng, 150) if i % 2 else " ".join(x + "#" for x in prose(rng, 150).split())
        rows.append((i, text, "en", "plain" if i % 2 else "code", 1))
    rows.append((1000, " ".join(x + "#" for x in prose(rng, 150).split()), "en", "plain", 1))
    kept = {r["doc_id"]: r["kept"] for r in quality.digest(frame(spark, rows)).collect()}
    assert sum(kept[i] for i in range(500)) >= 495 and kept[1000] is False


def test_sketches_merge(spark):
    rng = random.Random(2)
    values = [int(rng.lognormvariate(5, 2)) for _ in range(3000)]
    df = spark.createDataFrame([(i % 2, v) for i, v in enumerate(values)], "g int, word_chars long")
    df = df.selectExpr("*", "100L AS n_words", "0L AS n_symbols", "0L AS n_repeat_words", "0L AS n_dup_lines", "1L AS n_lines")
    parts = quality.sketch(df, ["g"])
    whole = quality.merge(parts.selectExpr("1 AS a", "metric", "cell", "n"), ["a"])
    got = quality.quantiles(whole, ["a"], {"q": 0.5, "r": 0.9}).filter("metric = 'word_length'").first()
    for name, share in (("q", 0.5), ("r", 0.9)):
        true = sorted(values)[int(len(values) * share) - 1]
        assert true <= got[name] <= true * (1 + 1 / quality.CELLS) + 1


def winnowed(text, k=winnow.K, window=winnow.WINDOW):
    """Fingerprint by the definition."""
    tokens = [c for w in WORD.findall(text or "") for c in (w if len(w) > winnow.LONGEST else [w])]
    t = [zlib.crc32(x.encode()) % winnow.PRIME for x in tokens]
    h = [0] * max(0, len(t) - k + 1) if len(t) >= k else ([0] if t else [])
    for i in range(len(h)):
        for x in t[i : i + k]:
            h[i] = (h[i] * winnow.BASE + x) % winnow.PRIME
    chosen = []
    for a in range(max(1, len(h) - window + 1) if h else 0):
        low = min(h[a : a + window])
        at = max(i for i in range(a, min(a + window, len(h))) if h[i] == low)
        if (low, at) not in chosen:
            chosen.append((low, at))
    return " ".join(f"{x:x}@{i:x}" for x, i in chosen)


def test_winnowing(spark):
    rng = random.Random(4)
    rows = [r for r in [*awkward(rng), *((100 + i, prose(rng, rng.randint(1, 150)), None, None, 1) for i in range(700))] if r[0] is not None and r != awkward(random.Random(4))[5]]
    rows = list({r[0]: r for r in rows}.values())
    got = {r["doc_id"]: r for r in winnow.digest(frame(spark, rows, extra=True)).collect()}
    ordered = sorted(rows)
    assert sorted(got) == [r[0] for r in ordered]
    sets = lambda f: {x.split("@")[0] for x in f.split()}
    like = lambda a, b: 1.0 if not a | b else len(a & b) / len(a | b)
    for i, row in enumerate(ordered):
        r, text, after = got[row[0]], row[1] or "", ordered[(i + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] == winnowed(text) and r["edited_fingerprint"] == winnowed(edited)
        assert r["near_edited"] == pytest.approx(like(sets(winnowed(text)), sets(winnowed(edited))))
        assert r["near_next"] == pytest.approx(like(sets(winnowed(text)), sets(winnowed(after))))


def test_winnowing_edge_tables(spark):
    assert winnow.digest(spark.createDataFrame([], DOCS)).count() == 0
    one = winnow.digest(frame(spark, [(7, "abcdef", None, None, 6)])).first()
    assert one["edited_sha256"] == hashlib.sha256(b"abcabc").hexdigest() and one["near_next"] == 1.0
    rows = awkward(random.Random(1))
    assert winnow.digest(frame(spark, rows)).count() == len(rows)


def test_guaranteed_match(spark):
    rng = random.Random(8)
    shared = " ".join(prose(rng, winnow.K + winnow.WINDOW - 1).split())
    rows = [(i, f"{prose(rng, 40)} {shared} {prose(rng, 40)}", None, None, 1) for i in range(2)]
    df = winnow.add_fingerprint(frame(spark, rows).select("doc_id", "text"), "text", "fp").select(winnow.grams("fp").alias("g"), winnow.positions("fp").alias("p")).collect()
    assert set(df[0]["g"]) & set(df[1]["g"]) and df[0]["p"] == sorted(df[0]["p"])


def test_rendezvous(spark):
    df = sharding.digest(spark_docs(spark)).collect()
    by = defaultdict(list)
    for r in df:
        by[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 24)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    rows = rows_of(spark)
    got = sharding.digest(frame(spark, rows, extra=True)).collect()
    text = {r[0]: r[1] or "" for r in rows}
    assert len(got) == len(rows) and len({r["shard"] for r in got if r["doc_id"] is None}) == 1
    for r in got:
        if r["doc_id"] is not None:
            raw = text[r["doc_id"]].encode()
            assert r["size"] == len(raw) + 8 and r["text_crc32"] == zlib.crc32(raw)
    assert sharding.digest(spark.createDataFrame([], DOCS)).count() == 0


def test_weighted_shards(spark):
    keys = spark.range(20000).withColumnRenamed("id", "k")
    n = Counter(r["shard"] for r in sharding.assign(keys, "k", [1.0, 3.0], slot=None).collect())
    assert abs(n[1] / 20000 - 0.75) < 0.02
    with pytest.raises(ValueError):
        sharding.rendezvous(keys.k, [1.0, 0.0])
