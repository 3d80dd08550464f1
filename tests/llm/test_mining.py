"""Phrase collocations, tokens aligned across vocabularies, and terms that disclose personal data."""

import hashlib
import math
import random
import re
from collections import Counter

import pytest
import sentencepiece
import tokenizers

from sparkmart.llm import alignment, disclosure, phrases
from tests.llm.cases import DOCS, FOLDER, awkward, frame


def every_phrase(rows):
    """f(phrase) per language, by its definition."""
    count, words = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang or "und"] += len(w)
            for n in range(1, 5):
                count.update((lang or "und", tuple(w[i : i + n])) for i in range(len(w) - n + 1))
    return count, words


def best_phrases(rows, least, inside, places):
    f, words = every_phrase(rows)
    out = []
    for (lang, p), a in f.items():
        if len(p) < 2 or a < least:
            continue
        if any(l2 == lang and len(q) > len(p) and 100 * b >= inside * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for (l2, q), b in f.items() if b >= least):
            continue
        score, _, l, r = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out.append((lang, -score, -a, " ".join(p).encode(), l, r))
    ranks, rows = Counter(), []
    for lang, score, a, p, l, r in sorted(out):
        ranks[lang] += 1
        if ranks[lang] <= places:
            rows.append((lang, ranks[lang], p.decode(), -a, l, r, words[lang], -score))
    return rows


def chatter(rng, n):
    """Texts of few words, with breaks, ties, shared passages and copies."""
    passage = " ".join(rng.choice("ab cd ef gh ij kl".split()) for _ in range(120))
    rows = []
    for i in range(n):
        text = "".join(rng.choice(["a", "B", "c", "dd", "é", "x\t", " ", ", ", ".\n"]) + rng.choice([" ", "  ", "\t"]) for _ in range(rng.randrange(0, 120)))
        rows.append((i, text + (" " + passage if i % 5 == 0 else ""), rng.choice(["en", "de", None]), "s", 1))
    return rows


def test_collocations_equal_the_definition(spark):
    rng = random.Random(3)
    rows = chatter(rng, 60) + awkward(rng)[:8] + [(99, None, None, None, None)]
    got = phrases.collocations(frame(spark, rows, extra=True).withColumn("phrase", phrases.F.lit(1)), least=6, places=40).collect()
    assert sorted(map(tuple, got)) == sorted(best_phrases(rows, 6, phrases.INSIDE, 40)) and len(got) > 80
    assert phrases.collocations(spark.createDataFrame([], DOCS)).count() == 0


def test_parse_covers_every_phrase_once():
    rng = random.Random(8)
    plain = [re.sub("[.,\n]", " ", t) for _, t, *_ in chatter(rng, 30)]
    for texts in (plain, ["a b c"], ["a"], ["", None], ["same " * 5000]):
        found, want = Counter(), Counter()
        for t, chunk, last in phrases.chunks(texts):
            w = chunk.split()
            found.update((t, tuple(w[i : i + 4])) for i in range(len(w) - (0 if last else phrases.OVERLAP)) if i + 4 <= len(w))
        for t, text in enumerate(texts):
            w = (text or "").lower().split()
            want.update((t, tuple(w[i : i + 4])) for i in range(len(w) - 3))
        assert found == want


@pytest.mark.parametrize("least", [1, 3])
def test_frequencies_of_copies(spark, least):
    rows = [(i, "one two three four five six " * 30, "en", "s", 1) for i in range(40)] + [(100, "one two", None, "s", 1)]
    got = {(r["lang"], r["phrase"]): r["f"] for r in phrases.frequencies(frame(spark, rows), least=least).collect()}
    want, words = every_phrase(rows)
    assert got == {(lang, " ".join(p)): n for (lang, p), n in want.items() if n >= least}


def linked_by_definition(texts):
    """Per text (n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), and documents and links of every pair."""
    path_a, path_b = alignment.default_files()
    a_file, b_file = tokenizers.Tokenizer.from_file(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
    a_file.encode_special_tokens = True
    letters = alignment.byte_letters()
    spelled = {i: bytes(letters[c] for c in t) for t, i in a_file.get_vocab(with_added_tokens=False).items()}

    def piece(i):
        p = b_file.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b_file.is_byte(i) else p.replace("\u2581", " ").encode()

    every, docs, links = [], Counter(), Counter()
    for t in texts:
        groups = []
        if t:
            a, b = a_file.encode(" " + t, add_special_tokens=False).ids, b_file.encode(t)
            say_a, say_b = [spelled[i] for i in a], [piece(i) for i in b]
            if b"".join(say_a) == b"".join(say_b) == (" " + t).encode():
                ends = lambda said: [sum(map(len, said[: i + 1])) for i in range(len(said))] if len(said) < 3000 else list(running(said))
                end_a, end_b = ends(say_a), ends(say_b)
                x = y = 0
                for cut in sorted(set(end_a) & set(end_b)):
                    p, q = x, y
                    while x < len(a) and end_a[x] <= cut:
                        x += 1
                    while y < len(b) and end_b[y] <= cut:
                        y += 1
                    groups.append((a[p:x], b[q:y]))
        pairs = Counter((i, j) for p, q in groups for i in p for j in q)
        docs.update(pairs.keys())
        links.update(pairs)
        every.append((groups, pairs))
    top = Counter()
    for (i, _), n in docs.items():
        top[i] = max(top[i], n)
    out = []
    for groups, pairs in every:
        said = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        out.append((sum(len(p) for p, _ in groups), sum(len(q) for _, q in groups), len(groups), sum(pairs.values()), sum(n for k, n in pairs.items() if docs[k] == top[k[0]]),
                    sum(n * docs[k] for k, n in pairs.items()), hashlib.sha256(said.encode()).hexdigest() if groups else ""))
    return out, docs, links


def running(said):
    total = 0
    for x in said:
        total += len(x)
        yield total


ODD = ["<|endoftext|> <s> <unk> <0x41>", "a\u2581b", "\x00\x01", " two  blanks ", "\u00e9\u6f22\U0001f600" * 30, "=" * 3000 + " x" * 50, "it's we'll I'D 12345678 \n\n\t x", "\ufb01 \u212b", "q" * 999 + "\n" * 77]


@pytest.mark.parametrize("docs, entries, wide", [(alignment.DOCS, alignment.ENTRIES, alignment.WIDE), (5, 300, 2)])
def test_links_equal_the_definition(spark, monkeypatch, docs, entries, wide):
    monkeypatch.setattr(alignment, "DOCS", docs)
    monkeypatch.setattr(alignment, "ENTRIES", entries)
    monkeypatch.setattr(alignment, "WIDE", wide)
    given = [r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60).collect()]
    rows = awkward(random.Random(5)) + [(200 + i, t, None, "s", 1) for i, t in enumerate([*ODD, *given, *given[:9]])]
    df = frame(spark, rows, extra=True).withColumn("block", phrases.F.lit("mine")).withColumn("n_best", phrases.F.lit("mine")).repartition(3)
    want, docs_of, links = linked_by_definition([r[1] for r in rows])
    got = alignment.align(df).collect()
    assert {r["block"] for r in got} == {"mine"} and len(got) == len(rows)
    said = Counter((r["doc_id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"]) for r in got)
    assert said == Counter((r[0], *w) for r, w in zip(rows, want))
    table = {(r["a"], r["b"]): (r["n_docs"], r["n_links"]) for r in alignment.pair_table(df).collect()}
    assert table == {k: (n, links[k]) for k, n in docs_of.items()}


def test_alignment_of_nothing(spark):
    assert alignment.digest(spark.createDataFrame([], DOCS)).count() == 0
    assert [tuple(r)[1:] for r in alignment.digest(spark.createDataFrame([(1, None, None, None, None)], DOCS)).collect()] == [(0, 0, 0, 0, 0, 0, "")]


def patterns_by_definition(text):
    """(start, kind, end, entity) by plain regular expressions."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end(), "email:" + m.group().lower()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append((m.start(), 1, m.end(), "ip:" + ".".join(str(int(x)) for x in m.group().split("."))))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[ -]", "", m.group())
        odd = sum(int(c) for c in d[::-2]) + sum(sum(map(int, str(2 * int(c)))) for c in d[-2::-2])
        if 14 <= len(d) <= 19 and odd % 10 == 0:
            out.append((m.start(), 2, m.end(), "card:" + d))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        d = re.sub("[^0-9]", "", m.group())
        if 10 <= len(d) <= 15:
            out.append((m.start(), 3, m.end(), "phone:" + d))
    return sorted(out)


def terms_by_definition(texts):
    """Spans of every text by the measure's definition, from whole lists."""
    occurrences, near, around, every = Counter(), Counter(), {}, []
    for text in texts:
        spans = patterns_by_definition(text)
        words = [(m.start(), m.end(), "".join(c.lower() if "A" <= c <= "Z" else c for c in m.group())) for m in re.finditer(r"[0-9A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u1fff\u2070-\u2fff\u3040-\U0010ffff]+", text)]
        occurrences.update(w for *_, w in words)
        free = [w for w in words if not any(a < w[1] and w[0] < b for a, _, b, _ in spans)]
        met = {}
        for a, _, b, name in spans:
            before, after = [w for w in free if w[1] <= a], [w for w in free if w[0] >= b]
            window = before[max(0, len(before) - disclosure.NEAR) :] + after[: disclosure.NEAR]
            for w in window:
                around.setdefault((name, w[2]), set())
                if (name, w) not in met:
                    around[name, w[2]].add(tuple(x[2] for x in window))
                    near[name, w[2]] += 1
                met[name, w] = True
        every.append((spans, free, met))
    total, heard = sum(occurrences.values()), Counter()
    for (c, _), n in near.items():
        heard[c] += n
    ratio = {(c, t): 1 - math.log(n / occurrences[t]) / math.log(heard[c] / total) for (c, t), n in near.items() if len(around[c, t]) >= disclosure.SUPPORT and heard[c] < total}
    removed = {t for (_, t), r in ratio.items() if r >= disclosure.REMOVE}
    out = []
    for spans, free, met in every:
        more = {(a, 4, b) for c, (a, b, t) in met if ratio.get((c, t), 0) >= disclosure.GENERALISE}
        gone = {(a, 5, b) for a, b, t in free if t in removed}
        more = {x for x in more if (x[0], 5, x[2]) not in gone} | gone
        out.append(",".join(f"{disclosure.KINDS[k]}:{a}:{b}" for a, k, b in sorted({x[:3] for x in spans} | more)))
    return out


def letters(rng, shown):
    """Texts about persons, whose address stands among words that only they bring along."""
    people = [(f"{n}.Ray@mail.example.org", [f"{n}villeo", f"{n}xa\u00e9", f"Kr{n}l"]) for n in ("ann", "bob", "cid")]
    plain = ["the", "a", "of", "house", "road", "sky", "and", "it", "is", "not", "here", "12", "run"]
    out = []
    for i in range(shown):
        mail, own = rng.choice(people)
        w = [rng.choice(plain) for _ in range(60)]
        if i % 3 == 0:
            at = rng.randrange(5, 50)
            w[at : at + 1] = [w[at], rng.choice(own), mail, rng.choice(own) + ","]
        if i % 7 == 0:
            w.insert(3, own[0])
        if i % 11 == 0:
            w.insert(9, rng.choice(["+1 (017) 555-7713", "10.0.0.1", "4736 9625 7309 9581", "4111-1111-1111-1111", "999.1.1.1"]))
        out.append(" ".join(w))
    return out


TRICKY = ["a@b@c.d.e x..@y.z. @q.r a@b", "1.2.3.4.5.6.7.8 1.2.3 256.1.1.1 001.02.3.255 1..2.3.4", "4111111111111111 4111 1111-1111 1111 4111  1111", "+1 (2) 345-678-90. +12 +1234567890123456 ++1 234 567 89 01) +1-", "1" * 4000, "a" * 3000 + "@" + "b" * 2000, "9.8.7.6@h.i-j.k 5555555555554444@x.y", "\u00e9t\u00e9@x.fr \u6f22+1 234 567 8901\u6f22", "+1 2345678901\n23 4.4.\n4.4", "." * 50 + "+" * 50 + "@" * 50]


def test_disclosing_terms_by_definition(spark):
    rng = random.Random(4)
    texts = letters(rng, 240) + TRICKY + [r[1] for r in awkward(rng)] + ["".join(rng.choice("12.+ -@a()") for _ in range(rng.randrange(60))) for _ in range(300)]
    texts += [texts[0]] * 5
    rows = [(i, t, None, "s", 1) for i, t in enumerate(texts)]
    df = frame(spark, rows, extra=True).withColumn("id", phrases.F.lit("mine")).withColumn("spans", phrases.F.lit("mine"))
    got = {r["doc_id"]: r for r in disclosure.sanitise(df).collect()}
    want = terms_by_definition([t or "" for t in texts])
    assert len(got) == len(texts) and sum("remove" in w for w in want) > 20 and sum("generalise" in w for w in want) > 20
    for i, (text, said) in enumerate(zip(texts, want)):
        r = got[i]
        base = patterns_by_definition(text or "")
        assert r["spans"] == said, text
        assert [r[f"n_{k}"] for k in disclosure.KINDS[:4]] == [sum(s[1] == k for s in base) for k in range(4)]
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{disclosure.KINDS[k]}:{a}:{b}" for a, k, b, _ in base).encode()).hexdigest()
        assert r["id"] == "mine" and r["sanitised"] == disclosure.written(text, said)
    assert disclosure.written("Ann of x@y.z", "remove:0:3,email:7:12") == "[removed] of [email]" and disclosure.written("Bo 12", "generalise:0:2,generalise:3:5") == "[name] [number]"


def test_disclosure_of_nothing(spark):
    assert disclosure.digest(spark.createDataFrame([], DOCS)).count() == 0
    assert [tuple(r) for r in disclosure.digest(spark.createDataFrame([(1, None, None, None, None)], DOCS)).collect()] == [(1, 0, 0, 0, 0, hashlib.sha256(b"").hexdigest(), "")]


def test_copies_prove_nothing(spark):
    """A passage that stands in many documents unchanged discloses none of its words."""
    rows = [(i, "hapaxone hapaxtwo wrote to me@where.example.com about hapaxthree", "en", "s", 1) for i in range(50)] + [(99, "plain words " * 40, "en", "s", 1)]
    assert {r["spans"] for r in disclosure.found(frame(spark, rows)).collect()} == {"email:27:47", ""}
