"""Nested and semi-structured data. All operators are narrow: no shuffle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from sparkmart.functions import as_col, json_path, null_negative, regexp_to_array, tokens


def flatten_levels(df, json_col, schema: str, levels, outputs: dict) -> DataFrame:
    """Rows of a nested document.

    levels: [(alias, array path)], each exploded outer under the one before; `outputs`
    maps a column to the paths tried in order, deepest first.
    """
    out = df.withColumn("__doc", F.from_json(as_col(json_col), schema))
    for alias, path in levels:
        out = out.withColumn(alias, F.explode_outer(path))
    out = out.select(*df.columns, *[F.coalesce(*[F.col(p) for p in paths]).alias(n) for n, paths in outputs.items()])
    return out


def flatten_paths(df, key, json_col, max_depth=None, containers=False) -> DataFrame:
    """(key, path, value) leaves of a document with unknown keys, whatever its depth.

    Each level explodes containers and passes leaves on unchanged, so the whole
    document is one chain over a single scan; levels are added until no container is
    left, or `max_depth` is reached: `too_deep` then marks leaves that still are
    containers. With `containers`, objects and arrays are rows too, as JSON text.
    """
    container = "substr(schema_of_variant(__v), 1, 6) IN ('OBJECT', 'ARRAY<')"
    out = df.select(as_col(key).alias("__key"), F.lit("").alias("__path"), F.try_parse_json(as_col(json_col)).alias("__v"))
    boxes, depth = [], 0
    while (max_depth is None or depth < max_depth) and not out.filter(container).isEmpty():
        if containers and depth:
            boxes.append(out.filter(container))
        out = out.withColumn("__box", F.expr(f"CASE WHEN {container} THEN __v END"))
        out = out.lateralJoin(out.sparkSession.tvf.variant_explode_outer(F.col("__box").outer()))
        step = F.coalesce(F.col("key"), F.concat(F.lit("["), F.col("pos").cast("string"), F.lit("]")))
        glue = F.when((F.col("__path") == "") | F.col("key").isNull(), "").otherwise(".")
        out = out.select(
            "__key", F.when(F.col("pos").isNull(), F.col("__path")).otherwise(F.concat("__path", glue, step)).alias("__path"),
            F.when(F.col("pos").isNull(), F.col("__v")).otherwise(F.col("value")).alias("__v"))
        depth += 1
    final = lambda d, deep: d.filter("__v IS NOT NULL").select(
        F.col("__key").alias(key), F.col("__path").alias("path"), F.expr("coalesce(try_cast(__v AS string), to_json(__v))").alias("value"), deep.alias("too_deep"))
    return reduce(lambda a, b: a.union(b), [final(b, F.lit(False)) for b in boxes], final(out, F.expr(container)))


def extract_context(df, contexts, schema_like, fields: dict) -> DataFrame:
    """Fields of the event contexts whose schema name matches: one row per match."""
    names = list(fields)
    body = ", ".join(f"{n}: string" for n in names)
    doc = F.from_json(as_col(contexts), f"data array<struct<schema: string, data: struct<{body}>>>")
    match = F.filter(doc["data"], lambda c: c["schema"].like(schema_like))
    rows = df.withColumn("__c", F.explode(match))
    return rows.select(*[c for c in df.columns if c != contexts], *[F.col("__c")["data"][n].try_cast(t).alias(n) for n, t in fields.items()])


def unpack_event(df, event, payload, name, cols, prefix, masked=("value", "elements")) -> DataFrame:
    """Payload fields of one event type as columns; sensitive event types are masked."""
    for c in cols:
        field = F.get_json_object(as_col(payload), f"$.data.data.{c}")
        df = df.withColumn(f"{prefix}_{c}", F.when(as_col(event).isin(*masked), "masked").when(as_col(event) == name, field))
    return df


def parse_kv_text(df, col, spec: dict, sep=": ") -> DataFrame:
    """Typed columns of 'key: value' lines.

    A timestamp may stand three or four lines below its key and may carry a leading
    '&1 ' marker. Lines are looked up inside the row's own array, so nothing is
    shuffled or windowed. spec: {key: (output, type)}.
    """
    out = df.withColumn("__l", F.split(as_col(col), "\n"))
    out = out.withColumn("__k", F.transform("__l", lambda x: F.split_part(x, F.lit(sep), F.lit(1))))
    out = out.withColumn("__v", F.transform("__l", lambda x: F.nullif(F.trim(F.regexp_replace(
        F.when(F.contains(x, F.lit(sep)), F.substring(x, F.position(F.lit(sep), x) + len(sep), F.length(x))).otherwise(F.lit("")), "^'|'$", "")), F.lit(""))))
    for key, (name, kind) in spec.items():
        at = F.array_position("__k", F.lit(key))
        own = F.get("__v", (at - 1).cast("int"))
        if kind == "timestamp":
            stamp = lambda c: F.regexp_replace(F.trim(c), r"^&1 ", "").try_cast("timestamp_ntz")
            below = [stamp(F.get("__l", (at - 1 + n).cast("int"))) for n in (3, 4)]
            c = F.coalesce(stamp(own), *below)
        elif kind == "digits":
            c = F.regexp_replace(own, "[^0-9]+", "").try_cast("long")
        elif kind == "boolean":
            c = F.coalesce(own.try_cast("boolean"), F.lit(False))
        else:
            c = own.try_cast(kind)
        out = out.withColumn(name, F.when(at > 0, c))
    return out.drop("__l", "__k", "__v")


def extract_refs(df, text, patterns: dict) -> DataFrame:
    """One row per reference found in free text: {link type: (pattern, group)}."""
    def tagged(kind, pattern, group):
        found = F.coalesce(F.regexp_extract_all(as_col(text), F.lit(pattern), F.lit(group)), F.array().cast("array<string>"))
        return F.transform(found, lambda m: F.struct(F.lit(kind).alias("link_type"), m.alias("link_id")))

    rows = df.withColumn("__r", F.explode(F.concat(*[tagged(kind, p, g) for kind, (p, g) in patterns.items()])))
    return rows.select(*[c for c in df.columns if c != text], "__r.*")


def matches(df, text, pattern, out) -> DataFrame:
    return df.withColumn(out, regexp_to_array(text, pattern))


def explode_tags(df, col, out="tag", delimiters=" ") -> DataFrame:
    return df.withColumn(out, F.explode(tokens(col, delimiters))).drop(col)


def name_dimensions(df, seed, index, seed_index, name) -> DataFrame:
    """Numbered dimensions get their names from a seed."""
    return df.join(seed.select(as_col(seed_index).alias("__i"), name), df[index] == F.col("__i"), "left").drop("__i")


def project_payload(df, col, spec: dict) -> DataFrame:
    """Known payload paths as typed columns, negative counters NULL: {output: (path, type)}."""
    out = []
    for name, (path, kind) in spec.items():
        c = json_path(col, path, kind)
        out.append((null_negative(c) if kind in ("int", "bigint", "long", "double") else c).alias(name))
    return df.select(*[c for c in df.columns if c != col], *out)
