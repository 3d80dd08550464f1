"""Personal data by patterns, and the terms that give it away by their company in the corpus.

Protected entities are the e-mail addresses, IP addresses, card and phone numbers of the texts. The
corpus tells how much a term reveals about an entity: with p(c) the chance that a term stands near
entity c (within NEAR terms), the entity's information is -ln p(c), and a term t discloses
PMI(c; t) = ln(p(c | t) / p(c)) of it. Their ratio is 1 for a term that is never met without c.

* A term of ratio REMOVE or more for any entity is removed wherever it stands: it gives the entity
  away even where that is not named.
* One of ratio GENERALISE or more is generalised where it stands near that entity.

Only terms met near an entity in SUPPORT different surroundings are judged, so that copies of one
passage, which hold every word of it together, prove nothing.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from sparkmart.llm.common import stored
from sparkmart.llm.scan import Hasher, U, by_bytes, code_points, groups, lower, mixed

#: Kinds of spans in the order in which they stand where they begin together.
KINDS = ("email", "ip", "card", "phone", "generalise", "remove")
#: Terms on either side of an entity; surroundings a judgement needs; ratios from which terms go.
NEAR, SUPPORT, GENERALISE, REMOVE = 10, 3, 0.5, 0.9
#: Bits of the bitmaps by which tasks pass over terms that nobody asks for, in bitmaps of 2**15 bits each.
BITS, PAGE = 24, 15

DIGIT, LOCAL, DIALLED, TERM = 1, 2, 4, 8
FLAGS = np.zeros(129, np.uint8)
for _c in range(128):
    _s = chr(_c)
    _alnum = _s.isascii() and _s.isalnum()
    FLAGS[_c] = DIGIT * _s.isdigit() | LOCAL * (_alnum or _s in "._%+-") | DIALLED * (_s.isdigit() or _s in " ().-") | TERM * _alnum
FLAGS[128] = TERM

DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
FOUR = re.compile(r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def entities(points: np.ndarray, said: str, flags: np.ndarray) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, entity) of the four patterns, leftmost first and without overlap within a kind.

    Nothing is tried twice, so the time is linear in the text whatever it holds.
    """
    out = []
    digits = np.flatnonzero(flags & DIGIT)
    at = np.flatnonzero(points == 64)
    if len(at):
        other = np.flatnonzero(~(flags & LOCAL).astype(bool))
        done = 0
        for k, p in zip(at.tolist(), np.searchsorted(other, at).tolist()):
            begin = max(int(other[p - 1]) + 1 if p else 0, done)
            m = DOMAIN.match(said, k + 1) if begin < k else None
            if m:
                done = m.end()
                out.append((begin, 0, done, "email:" + said[begin:done].lower()))
    if not len(digits):
        return out
    joined = np.diff(digits)
    run = digits[np.append(True, joined != 1)]
    dots = np.flatnonzero(points == 46)
    dots = dots[(dots > 0) & (dots < len(points) - 1)]
    dots = dots[(flags[dots - 1] & DIGIT & flags[dots + 1]).astype(bool)]
    done = 0
    for d, begin in zip(dots.tolist(), run[np.searchsorted(run, dots) - 1].tolist() if len(dots) else ()):
        m = FOUR.match(said, begin) if begin >= done else None
        if m:
            done = m.end()
            parts = [p.lstrip("0") or "0" for p in m.group().split(".")]
            if all(len(p) <= 3 and int(p) <= 255 for p in parts):
                out.append((begin, 1, done, "ip:" + ".".join(parts)))
    gap = points[np.minimum(digits[:-1] + 1, len(points) - 1)]
    linked = (joined == 1) | ((joined == 2) & ((gap == 32) | (gap == 45)))
    first = np.flatnonzero(np.append(True, ~linked))
    size = np.diff(np.append(first, len(digits)))
    for i in np.flatnonzero((size >= 14) & (size <= 19)).tolist():
        own = digits[first[i] : first[i] + size[i]]
        number = "".join(map(said.__getitem__, own.tolist()))
        if luhn(number):
            out.append((int(own[0]), 2, int(own[-1]) + 1, "card:" + number))
    plus = np.flatnonzero(points[:-1] == 43)
    plus = plus[(flags[plus + 1] & DIGIT).astype(bool)]
    if len(plus):
        other = np.append(np.flatnonzero(~(flags & DIALLED).astype(bool)), len(points))
        end = other[np.searchsorted(other, plus + 1)]
        low, high = np.searchsorted(digits, plus), np.searchsorted(digits, end)
        last = digits[high - 1]
        for p, a, b, z in zip(plus.tolist(), low.tolist(), high.tolist(), last.tolist()):
            if z >= p + 3 and 10 <= b - a <= 15:
                out.append((p, 3, z + 1, "phone:" + "".join(map(said.__getitem__, digits[a:b].tolist()))))
    return out


class Page:
    """Entities and terms of some texts, one after the other in one array of code points."""

    def __init__(self, held: list[str]):
        self.held = held
        raw = "\n".join(held)
        points = code_points(raw)
        flags = FLAGS[np.minimum(points, 128)]
        odd = points >= 128
        if odd.any():  # spaces and punctuation beyond ASCII are no letters
            p = points[odd]
            flags[odd] = np.where((p < 0xC0) | (p == 0xD7) | (p == 0xF7) | ((p >= 0x2000) & (p < 0x2070)) | ((p >= 0x3000) & (p < 0x3040)), 0, TERM)
        size = np.fromiter((len(t) + 1 for t in held), np.int64, len(held))
        self.base = np.cumsum(size) - size
        self.spans = sorted(entities(points, raw, flags))
        edge = np.diff(np.concatenate(([0], (flags & TERM != 0).view(np.int8), [0])))
        self.starts, self.ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.points = lower(points)
        self.said = self.points.tobytes().decode("utf-32-le", "surrogatepass")
        self.total = len(self.starts)
        self._free = None

    def hashes(self) -> np.ndarray:
        return mixed(Hasher(self.points)(self.starts, self.ends) + (self.ends - self.starts).astype(U))

    def text_of(self, position) -> np.ndarray:
        return np.searchsorted(self.base, position, "right") - 1

    def free(self) -> np.ndarray:
        """Terms that lie in no entity."""
        if self._free is None:
            cover = np.zeros(len(self.points) + 1, np.int64)
            for a, _, b, _ in self.spans:
                cover[a] += 1
                cover[b] -= 1
            inside = np.concatenate(([0], np.cumsum(np.cumsum(cover)[:-1] > 0)))
            self._free = np.flatnonzero(inside[self.ends] == inside[self.starts])
        return self._free

    def term(self, i: int) -> str:
        return self.said[self.starts[i] : self.ends[i]]

    def company(self) -> Iterator[tuple[int, str, str, list[int]]]:
        """(text, entity, surroundings, terms near it) of every entity."""
        free = self.free()
        left, right = self.ends[free], self.starts[free]
        stop = np.append(self.base[1:], len(self.points) + 1)
        for a, _, b, name in self.spans:
            t = int(self.text_of(a))
            lo, hi = np.searchsorted(right, self.base[t]), np.searchsorted(right, stop[t])
            before, after = np.searchsorted(left, a, "right"), np.searchsorted(right, b)
            near = [*free[max(lo, before - NEAR) : before].tolist(), *free[after : min(hi, after + NEAR)].tolist()]
            shown = "\n".join(map(self.term, near))
            yield t, name, hashlib.blake2b(shown.encode("utf-8", "surrogatepass"), digest_size=8).hexdigest(), near


def company(df: DataFrame) -> DataFrame:
    """(c, t, around, n): terms near entities, by surroundings; a term in several windows of an entity counts once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text"):
            count: dict[tuple[str, str, str], int] = {}
            for _, held in groups(batch.column("text").to_pylist()):
                page = Page(held)
                met = set()
                for _, name, around, near in page.company() if page.spans else ():
                    for i in near:
                        if (name, i) not in met:
                            met.add((name, i))
                            key = name, page.term(i), around
                            count[key] = count.get(key, 0) + 1
            c, t, around = zip(*count) if count else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()), pa.array(t, pa.string()), pa.array(around, pa.string()), pa.array(count.values(), pa.int64())], ["c", "t", "around", "n"])

    found = df.mapInArrow(run, "c string, t string, around string, n long")
    # Summed by surroundings first: an entity that a third of all texts name is spread over many keys.
    return found.groupBy("c", "t", "around").agg(F.sum("n").alias("n")).groupBy("c", "t").agg(F.sum("n").alias("n_ct"), F.count("n").alias("support"))


def string_hashes(said: list[str]) -> np.ndarray:
    """The hash that a term has in a text."""
    points = code_points("\n".join(said))
    size = np.fromiter(map(len, said), np.int64, len(said))
    first = np.cumsum(size + 1) - size - 1
    return mixed(Hasher(points)(first, first + size) + size.astype(U))


def bitmap(keys: DataFrame) -> np.ndarray:
    """Bitmap of the hashes of one column of strings: 2**BITS bits whatever their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                h = string_hashes(batch.column(0).to_pylist()) & U(2**BITS - 1)
                yield pa.RecordBatch.from_arrays([pa.array((h >> U(PAGE)).astype(np.int64)), pa.array((h & U(2**PAGE - 1)).astype(np.int64))], ["page", "bit"])

    out = np.zeros(2**BITS >> 3, np.uint8)
    for row in keys.mapInArrow(run, "page long, bit long").groupBy("page").agg(F.bitmap_construct_agg("bit").alias("bits")).toLocalIterator():
        at = row["page"] << PAGE >> 3
        out[at : at + (1 << PAGE >> 3)] = np.frombuffer(row["bits"], np.uint8)
    return out


def holds(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    h = hashes & U(2**BITS - 1)
    return (bits[(h >> U(3)).astype(np.int64)] >> (h & U(7)).astype(np.uint8) & 1).astype(bool)


def term_counts(df: DataFrame, asked: np.ndarray) -> DataFrame:
    """(t, n_t) of the terms in the bitmap, and of all terms as t NULL."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text"):
            count: dict[str | None, int] = {None: 0}
            for _, held in groups(batch.column("text").to_pylist()):
                page = Page(held)
                count[None] += page.total
                for i in np.flatnonzero(holds(asked, page.hashes())).tolist():
                    t = page.term(i)
                    count[t] = count.get(t, 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array(count.keys(), pa.string()), pa.array(count.values(), pa.int64())], ["t", "n"])

    return df.mapInArrow(run, "t string, n long").groupBy("t").agg(F.sum("n").alias("n_t"))


def disclosure(df: DataFrame, support: int = SUPPORT) -> DataFrame:
    """(c, t, ratio): how much of an entity's information each term near it discloses, over the column `text`."""
    near = stored(company(df))
    judged = near.filter(F.col("support") >= support)
    counts = stored(term_counts(df, bitmap(judged.select("t").distinct())))
    total = counts.filter("t IS NULL").first()
    heard = near.groupBy("c").agg(F.sum("n_ct").alias("m_c"))
    chance = F.col("m_c") / F.lit(float(total["n_t"]) if total else 1.0)
    ratio = F.lit(1.0) - F.log(F.col("n_ct") / F.col("n_t")) / F.log(chance)
    return judged.join(counts.filter("t IS NOT NULL"), "t").join(heard, "c").filter(chance < 1).select("c", "t", ratio.alias("ratio"))


FOUND = {"id": "long", "n_email": "long", "n_ip": "long", "n_card": "long", "n_phone": "long", "base_sha256": "string"}
SPANS = T.ArrayType(T.StructType().add("start", "integer").add("kind", "integer").add("end", "integer"))
TERMS = T.ArrayType(T.StructType().add("key", "string").add("start", "integer").add("end", "integer"))


def marked(df: DataFrame, removed: np.ndarray, general: np.ndarray) -> DataFrame:
    """Per row its entities, and the terms that the bitmaps of removed terms and of (entity, term) pairs hold."""
    span = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
    term = pa.list_(pa.struct([("key", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        any_removed, any_general = bool(removed.any()), bool(general.any())
        for batch in by_bytes(batches, "text"):
            texts = batch.column("text").to_pylist()
            spans, hits, near = ([[] for _ in texts] for _ in range(3))
            for first, held in groups(texts):
                page = Page(held)
                base = page.base.tolist()
                for a, kind, b, _ in page.spans:
                    t = int(page.text_of(a))
                    spans[first + t].append({"start": a - base[t], "kind": kind, "end": b - base[t]})

                def at(i: int, t: int, key: str) -> dict:
                    return {"key": key, "start": int(page.starts[i]) - base[t], "end": int(page.ends[i]) - base[t]}  # noqa: B023

                if any_removed:
                    free = page.free()
                    found = free[holds(removed, page.hashes()[free])]
                    for i, t in zip(found.tolist(), page.text_of(page.starts[found]).tolist()):
                        hits[first + t].append(at(i, t, page.term(i)))
                if any_general and page.spans:
                    met, places = [], set()
                    for t, name, _, around in page.company():
                        for i in around:
                            if (name, i) not in places:
                                places.add((name, i))
                                met.append((t, i, f"{name}\n{page.term(i)}"))
                    keep = holds(general, string_hashes([x[2] for x in met])) if met else []
                    for (t, i, key), good in zip(met, keep):
                        if good:
                            near[first + t].append(at(i, t, key))
            named = {"row": batch.column("row"), "id": pa.array(np.arange(number, number + len(texts)))}
            number += len(texts)
            for k, kind in enumerate(KINDS[:4]):
                named[f"n_{kind}"] = pa.array([sum(s["kind"] == k for s in own) for own in spans], pa.int64())
            said = (",".join(f"{KINDS[s['kind']]}:{s['start']}:{s['end']}" for s in own) for own in spans)
            named["base_sha256"] = pa.array([hashlib.sha256(x.encode()).hexdigest() for x in said])
            named |= {"spans": pa.array(spans, span), "hits": pa.array(hits, term), "near": pa.array(near, term)}
            yield pa.RecordBatch.from_arrays(list(named.values()), list(named))

    out = T.StructType().add("row", df.schema["row"].dataType)
    for name, kind in FOUND.items():
        out = out.add(name, kind)
    return df.mapInArrow(run, out.add("spans", SPANS).add("hits", TERMS).add("near", TERMS))


def found(df: DataFrame, text: str = "text", keep: list[str] | None = None, support: int = SUPPORT, generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """Add n_email, n_ip, n_card, n_phone, base_sha256 and spans to every row; columns of these names are replaced.

    `spans` lists kind:start:end in code points, by start, then kind: the four patterns, and the terms
    that disclose what they found. NULL and empty texts have none. Repeated rows count each; equal
    windows around an entity are one surrounding. Texts are taken whole. An empty table stays empty.
    `keep` names the columns to return besides, all by default.
    """
    added = [c for c in FOUND if c != "id"] + ["spans"]
    carried = [c for c in (keep or df.columns) if c not in added] or [text]
    texts = df.select(F.col(f"`{text}`").cast("string").alias("text"))
    reveals = stored(disclosure(texts, support).filter(F.col("ratio") >= min(generalise, remove)))
    strong = reveals.filter(F.col("ratio") >= remove).select(F.col("t").alias("key")).distinct()
    weak = reveals.filter(F.col("ratio") >= generalise).select(F.concat_ws("\n", "c", "t").alias("key"))
    rows = df.select(F.struct(*(F.col(f"`{c}`") for c in carried)).alias("row"), F.col(f"`{text}`").cast("string").alias("text"))
    docs = stored(marked(rows, bitmap(strong), bitmap(weak)))

    def met(column: str, keys: DataFrame, kind: str) -> DataFrame:
        each = docs.filter(F.size(column) > 0).select("id", F.explode(column).alias("x")).select("id", "x.key", "x.start", "x.end")
        return each.join(keys, "key").select("id", "start", "end", F.lit(KINDS.index(kind)).alias("kind"))

    terms = met("hits", strong, "remove").unionByName(met("near", weak, "generalise"))
    terms = terms.groupBy("id", "start", "end").agg(F.max("kind").alias("kind"))
    terms = terms.groupBy("id").agg(F.collect_list(F.struct(F.col("start"), F.col("kind"), F.col("end"))).alias("more"))
    touched = (F.size("hits") > 0) | (F.size("near") > 0)
    plain = docs.filter(~touched).withColumn("all", F.col("spans"))
    mixed_in = docs.filter(touched).join(terms, "id", "left").withColumn("all", F.array_sort(F.concat("spans", F.coalesce("more", F.array().cast(SPANS)))))
    names = F.array(*map(F.lit, KINDS))
    said = F.array_join(F.transform("all", lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")
    out = plain.unionByName(mixed_in.drop("more"))
    return out.select(*(F.col(f"row.`{c}`").alias(c) for c in carried), *added[:-1], said.alias("spans"))


def shape(term: str) -> str:
    """What a generalised term turns into."""
    return "[number]" if term.isdigit() else "[name]" if term[:1].isupper() else "[word]"


def written(text: str | None, spans: str) -> str | None:
    """The text with its spans replaced; of overlapping spans the first decides."""
    if not text or not spans:
        return text
    out, done = [], 0
    for s in spans.split(","):
        kind, a, b = s.split(":")
        a, b = int(a), int(b)
        if a >= done:
            out += [text[done:a], shape(text[a:b]) if kind == "generalise" else "[removed]" if kind == "remove" else f"[{kind}]"]
        done = max(done, b)
    return "".join(out) + text[done:]


def sanitise(df: DataFrame, text: str = "text", name: str = "sanitised", **limits) -> DataFrame:
    """Add what `found` adds, and the text with entities named by kind, terms generalised or removed. NULL texts stay NULL."""
    rows = found(df.drop(name), text, **limits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, text):
            said = map(written, batch.column(text).to_pylist(), batch.column("spans").to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(said, pa.string())], [*batch.schema.names, name])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields]).add(name, "string"))


def digest(docs: DataFrame) -> DataFrame:
    """Spans of every document."""
    return found(docs, keep=["doc_id"])
