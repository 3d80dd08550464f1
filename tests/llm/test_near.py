"""Near-duplicates and line dedup against brute force."""

import random
import re
import time
from collections import defaultdict

from sparkmart.llm import line_dedup, minhash, scan
from tests.llm.cases import DOCS, FOLDER, awkward, frame, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def labels(nodes, edges):
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in edges:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def check_near(spark, rows):
    sets = defaultdict(list)
    for r in rows:
        if r[0] is not None:
            sets[r[0]].append(shingles(r[1]))
    ids = sorted(sets)
    edges = [(a, b) for i, a in enumerate(ids) for b in ids[:i] if any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b])]
    want = labels(ids, edges)
    got = minhash.near_duplicates(frame(spark, rows, extra=True)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["component_id"] == want.get(r["doc_id"])
        assert r["kept"] == (r["doc_id"] == r["component_id"] or r["doc_id"] is None)
    return want


def edited(rng, text, share):
    return " ".join("q" + w[1:] + "x" if rng.random() < share else w for w in text.split())


def test_near_duplicates_on_hard_cases(spark):
    rng = random.Random(11)
    rows = awkward(rng)
    base = prose(rng, 150)
    rows += [(100 + i, edited(rng, base, 0.02), None, None, 1) for i in range(70)]  # a large group of near copies
    rows += [(300 + i, f"{base} {prose(rng, 60)}", None, None, 1) for i in range(20)]  # a passage in many documents
    for i in range(40):  # pairs around the threshold
        t = prose(rng, rng.randint(3, 90))
        rows += [(400 + 2 * i, t, None, None, 1), (401 + 2 * i, edited(rng, t, rng.choice((0.01, 0.02, 0.03, 0.04))), None, None, 1)]
    chain = prose(rng, 200).split()
    rows += [(600 + i, " ".join(chain[8 * i : 8 * i + 100]), None, None, 1) for i in range(12)]  # reach along a chain
    rows += [(700, "One two THREE four", None, None, 1), (701, "one two three\tfour", None, None, 1), (702, base, None, None, 1), (702, prose(rng, 50), None, None, 1)]
    want = check_near(spark, rows)
    assert want[611] == 600 and want[701] == 700 and len({want[100 + i] for i in range(70)}) < 70


def test_near_duplicates_on_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    check_near(spark, rows)


def test_keep_one_and_empty(spark):
    empty = spark.createDataFrame([], DOCS)
    assert minhash.near_duplicates(empty).count() == 0 and minhash.keep_one(empty).count() == 0
    rows = awkward(random.Random(3))
    assert {r["doc_id"] for r in minhash.keep_one(frame(spark, rows)).collect()} >= {None, 0, 1, 5}


def test_scan_words_and_long_texts():
    rng = random.Random(6)
    texts = ["", None, "one", prose(rng, 30), "a\x0bb\x0cc\rd e f", prose(rng, 60000), "É é x  y z q"]
    for text, got in zip(texts, scan.shingle_sets(texts)):
        assert len(got) == len(shingles(text))


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_banded_distance():
    rng = random.Random(9)
    for _ in range(3000):
        a = "".join(rng.choice("ab漢") for _ in range(rng.randint(0, 12)))
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            k, at = rng.randint(0, 2), rng.randint(0, len(b))
            if k == 0:
                b.insert(at, rng.choice("ab"))
            elif at < len(b):
                b[at : at + 1] = [] if k == 1 else [rng.choice("ab")]
        b = "".join(b)
        for t in (0, 1, 2, 3):
            assert line_dedup.within(a, b, t) == (distance(a, b) <= t), (a, b, t)


def normal(line, least):
    w = WORD.findall(line.translate(LOWER))
    return " ".join(w) if len(w) >= least else None


def plain_repeats(rows, threshold, least):
    """Keeper and number of links of every repeated line, by comparing all lines with all."""
    at = defaultdict(set)
    for doc, text, *_ in rows:
        for i, line in enumerate((text or "").split("\n")):
            if (f := normal(line, least)) is not None:
                at[f].add((doc is not None, doc or 0, i))
    forms = sorted(at)
    edges = [(a, b) for i, a in enumerate(forms) for b in forms[:i] if abs(len(a) - len(b)) <= threshold and distance(a, b) <= threshold]
    first = {f: min(at[f]) for f in forms}
    by = labels(sorted(forms), edges)
    groups, degree = defaultdict(list), defaultdict(int)
    for f in forms:
        groups[by[f]].append(f)
    for a, b in edges:
        degree[a] += 1
        degree[b] += 1
    out = {}
    for held in groups.values():
        keeper = min(first[f] for f in held)
        if sum(len(at[f]) for f in held) > 1:
            out |= {place: (keeper, degree[f]) for f in held for place in at[f]}
    return out


def lines_case(rng):
    base = "the quick brown fox jumps over one lazy dog"
    rows = [r for r in awkward(rng) if not (r[1] and len(r[1]) > 3000)]
    crowd = set()
    while len(crowd) < 60:  # one long list: all of them one replacement apart, some one insertion
        i = rng.randrange(len(base) // 2)
        crowd.add(base[:i] + rng.choice("xyzw") + base[i + rng.randint(0, 1) :])
    rows += [(100 + i, f"{c}\n{prose(rng, 12)}", None, None, 1) for i, c in enumerate(sorted(crowd))]
    for i in range(30):
        line = " ".join(prose(rng, 10).split())
        k = rng.randrange(len(line))
        other = rng.choice((line[:k] + "q" + line[k:], line[:k] + line[k + 1 :], line.upper(), line.replace(" ", "  ", 2), line[:k] + "é" + line[k + 1 :]))
        rows += [(300 + 2 * i, f"intro\n{line}", None, None, 1), (301 + 2 * i, f"{other}\nshort end", None, None, 1)]
    return rows


def test_line_join_against_all_pairs(spark):
    rows = lines_case(random.Random(21))
    for threshold in (0, 1, 2):
        want = plain_repeats(rows, threshold, 6)
        got = line_dedup.repeated(frame(spark, rows), threshold, 6).collect()
        have = {(r["doc_id"] is not None, r["doc_id"] or 0, r["line"]): ((r["keeper_doc"] is not None, r["keeper_doc"] or 0, r["keeper_line"]), r["n_links"]) for r in got}
        assert have == want, threshold


def test_dedup_lines_texts(spark):
    line = "a passage of quite enough words that several documents hold in full"
    rows = [(1, f"Head one\n{line}\ntail", "en", "s", 9), (2, f"own words first\n{line.upper()}x\nshort", None, None, 1), (3, line, "en", "s", 1), (4, None, "en", "s", 1), (5, "", "en", "s", 1), (6, "Head one", "en", "s", 1)]
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(frame(spark, rows, extra=True)).collect()}
    assert sorted(got) == [1, 2, 4, 5, 6]
    assert got[1]["text"] == rows[0][1] and got[2]["text"] == "own words first\nshort" and got[2]["n_chars"] == 21 and got[2]["kept"] == "mine"
    assert got[4]["text"] is None and got[6]["text"] == "Head one"
    empty = spark.createDataFrame([], DOCS)
    assert line_dedup.dedup_lines(empty).count() == 0 and line_dedup.digest(empty).count() == 0


def test_line_digest_is_whole(spark):
    rows = lines_case(random.Random(4))
    got = line_dedup.digest(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    want = plain_repeats(rows, line_dedup.THRESHOLD, line_dedup.LEAST_WORDS)
    for r in got:
        if r["doc_id"] is not None:
            drop = sorted(i for (known, doc, i), (keeper, _) in want.items() if known and doc == r["doc_id"] and keeper != (known, doc, i))
            assert r["dropped"] == drop and r["n_dropped"] == len(drop)


def test_short_lines_lose_exact_copies(spark):
    short = "all rights reserved."
    rows = [(1, f"{short}\nowned", "en", "s", 9), (2, "One\n  All  Rights reserved. \nall rights reserved!", None, None, 1), (3, short, "en", "s", 1), (None, "owned\nx", None, None, 1)]
    df = frame(spark, rows)
    got = {r["doc_id"]: r for r in line_dedup.digest(df, line_dedup.LEAST_EXACT).collect()}
    assert {d: r["dropped"] for d, r in got.items()} == {None: [], 1: [1], 2: [1], 3: [0]} and not any(r["n_links"] for r in got.values())
    texts = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(df, exact=line_dedup.LEAST_EXACT).collect()}
    assert texts == {None: "owned\nx", 1: short, 2: "One\nall rights reserved!"}
    rows = lines_case(random.Random(4))
    short = plain_repeats(rows, 0, 1)
    with_short = line_dedup.repeated(frame(spark, rows), exact=line_dedup.LEAST_EXACT).collect()
    assert {(r["doc_id"] is not None, r["doc_id"] or 0, r["line"]) for r in with_short} == set(short) | set(plain_repeats(rows, line_dedup.THRESHOLD, line_dedup.LEAST_WORDS))


def test_lines_cost_little_more_than_their_hashes():
    """Measured against the hashes of the same text, the least of several runs each."""
    rng = random.Random(21)
    texts = ["\n".join(prose(rng, rng.randint(1, 30)) for _ in range(40)) for _ in range(40)]
    points = scan.code_points("\n".join(texts))

    def least(f):
        took = []
        for _ in range(9):
            t = time.process_time()
            f()
            took.append(time.process_time() - t)
        return min(took)

    assert least(lambda: line_dedup.Lines(texts, 1)) < 2 * least(lambda: scan.Hasher(points))
    found = line_dedup.Lines([*texts, "", " \n a  B\t\n\nc ", "\nD"], 1)
    want = [(i, n, normal(x, 1)) for i, t in enumerate([*texts, "", " \n a  B\t\n\nc ", "\nD"]) for n, x in enumerate(t.split("\n")) if normal(x, 1)]
    assert list(zip(found.text.tolist(), found.number.tolist(), found.forms())) == want


def test_families_around_the_threshold_pair_few(spark, monkeypatch):
    """Copies that lack words which others lack too share nearly all they have; only few pairs can be alike enough."""
    rng = random.Random(31)
    base = prose(rng, 150).split()
    share = [rng.uniform(0.02, 0.14) for _ in range(150)]
    rows = [(10 + i, " ".join(w for w in base if rng.random() >= p), None, None, 1) for i, p in enumerate(share)]
    rows += [(300, base[0], None, None, 1), (300, " ".join(base), None, None, 1), (301, " ".join(base[:120]), None, None, 1)]
    pairs, across = [], minhash.across

    def counted(known, sigs):
        pairs.append(across(known, sigs).count())
        return across(known, sigs)

    monkeypatch.setattr(minhash, "across", counted)
    want = check_near(spark, rows)
    assert len(set(want.values())) > 20
    assert pairs[0] < 2500, pairs
